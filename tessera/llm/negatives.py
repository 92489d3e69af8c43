"""Hard negatives by shared, certified candidate lists of anchor clusters.

An anchor's positives are the rows of its label that score highest with it;
its hard negatives, for each positive, are the best rows of other labels
whose score lies in a band below the positive's.  Scores are inner products
of ``floor(scale * x)``, exact integers.

Lists
    Anchors are clustered by direction (centres learned from a bounded
    sample of anchors).  For a cluster and a block of candidates one list is
    made: every member lies within the angle ``theta`` of the cluster's mean
    direction, so a candidate at the angle ``phi`` from it and of length
    ``r`` scores at most ``|anchor| * r * cos(max(0, phi - theta))`` with
    any member.  The list is sorted once, by ``r * cos(...)``; all members
    walk it from the top, a stride at a time.
Termination
    A member stops when the bound of the next entry cannot reach the last
    of the best that it has found (or the lower end of its band): nothing
    further down the list can change its result.  A tie with the last of
    the best is still reached, so ties go to the smaller id.
Placement
    Candidates are dealt into blocks of bounded size and shuffled once; the
    anchors (1 row in ``every``) are copied to the blocks.  A task reads its
    rows in order, a block first and then that block's anchors, cluster by
    cluster, so that it holds one block and one batch of members whatever
    the number of anchors.  Positives are searched in blocks of one label,
    negatives in blocks of all rows; the bests of the blocks are merged by
    rank, and an executor lost costs only the tasks it ran.

Defined results: rows with a NULL id, label or vector, with NULL or
non-finite components or of another length than most take no part (zero
vectors do); of rows with the same id the one with the smallest vector and
label counts; an anchor is never its own positive or negative; an anchor
without positives, or a positive without negatives in its band, gives no
row; scores beyond a long are clipped to its range, also where they set a
band; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Candidates of a block, and of the smallest that a table is cut into to
#: keep all cores busy.
BLOCK, LEAST = 32_768, 1_024
#: Members that walk a list together, and entries of a stride.
MEMBERS, STRIDE = 512, 512
#: Anchors that the cluster centres are learned from, and the centres.
SAMPLE, CENTRES, ROUNDS = 4_096, 64, 8
LONG = np.iinfo(np.int64)
#: What rounding may add to an angle (radians) and, relatively, to a bound.
SLACK, GUARD = 1e-6, 1e-9


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` in a type in which a hundred inner products add
    up exactly: doubles, or Python's integers where those do not hold them."""
    with np.errstate(over="ignore"):
        z = np.floor(scale * x)
    top = float(np.abs(z).max(initial=0))
    if top * top * max(x.shape[1], 1) * 128 < 1 << 53:
        return z
    return np.array([[int(Fraction(v) * scale // 1) for v in row] for row in x.tolist()], object)


def exact(z: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in z.tolist()], object).reshape(z.shape)


#: Bounds of scores beyond doubles are integers in units of 1 / ``UNIT``.
UNIT = 1 << 40


def lengths(z: np.ndarray) -> np.ndarray:
    """Lengths of the rows, or integers not below them."""
    if z.dtype == object:
        return np.array([isqrt(sum(v * v for v in row)) + 1 for row in z.tolist()], object)
    return np.sqrt((z * z).sum(axis=1))


def directions(z: np.ndarray) -> np.ndarray:
    """Unit vectors; the zero vector stays as it is."""
    if z.dtype == object:
        most = [max(map(abs, row), default=0) or 1 for row in z.tolist()]
        z = np.array([[v * UNIT // m for v in row] for row, m in zip(z.tolist(), most)], float).reshape(z.shape)
    most = np.abs(z).max(axis=1, initial=0)[:, None]
    f = z / np.where(most > 0, most, 1)
    n = np.sqrt((f * f).sum(axis=1))[:, None]
    return f / np.where(n > 0, n, 1)


def centres(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Mean directions of clusters of the rows (spherical k-means)."""
    u = directions(x)
    if not len(u):
        return np.zeros((1, x.shape[1] if x.ndim == 2 else 0))
    k = max(1, min(CENTRES, len(u) // 8))
    c = u[np.random.default_rng(seed).choice(len(u), k, replace=False)]
    for _ in range(ROUNDS):
        near = (u @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        n = np.sqrt((total * total).sum(axis=1))[:, None]
        c = np.where(n > 0, total / np.where(n > 0, n, 1), c)
    return c


class Block:
    """A block of candidates; ``ranked`` sorts them for a cluster."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, z: np.ndarray):
        self.ids, self.labels, self.z = ids, labels, z
        self.unit, self.length = directions(z), lengths(z)

    def ranked(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the candidates in descending order of the bound, and
        the bounds for an anchor of length one."""
        u = directions(members)
        c = u.sum(axis=0)
        n = np.sqrt(c @ c)
        share = np.ones(len(self.ids))
        if n > 0:
            c = c / n
            # a zero member scores 0 with all and needs no angle
            some = np.abs(u).max(axis=1, initial=0) > 0
            theta = np.arccos(np.clip(u[some] @ c, -1, 1)).max(initial=0)
            phi = np.arccos(np.clip(self.unit @ c, -1, 1))
            share = np.cos(np.clip(phi - theta - SLACK, 0, np.pi))
        share = share + np.abs(share) * GUARD
        if self.length.dtype == object:
            bound = self.length * np.array([ceil(x * UNIT) for x in share.tolist()], object)
        else:
            bound = self.length * share
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]


def best_scores(kept: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The largest scores of each row of both, as many as ``kept`` has."""
    k = kept.shape[1]
    both = np.concatenate([kept, new], axis=1)
    return np.partition(both, both.shape[1] - k, axis=1)[:, -k:]


def walk(block: Block, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, k: int, same: bool,
         low: np.ndarray | None = None, high: np.ndarray | None = None):
    """Walk one list with all members.  Returns arrays of member, band,
    candidate (places) and score: every band's best ``k`` of the block and
    what ties with them, bands being columns of ``low`` and ``high`` (the
    hundredfold scores allowed; none: one band with all scores).  ``same``
    takes candidates of the member's label, else those of other labels."""
    order, bound = block.ranked(q)
    bands = 1 if low is None else low.shape[1]
    kind = object if q.dtype == object or block.z.dtype == object else float
    least = -np.inf if kind is float else -(1 << 2200)
    best = np.full((len(q), bands, k), least, dtype=kind)
    # a bound of a block beyond doubles is in units, and so is one of such members
    unit = UNIT if bound.dtype == object else 1
    length = lengths(q)
    open_ = np.arange(len(q))
    if low is not None:
        open_ = open_[(low <= high).astype(bool).any(axis=1)]
    member, band, place, score = [], [], [], []
    for start in range(0, len(order), STRIDE):
        here = order[start:start + STRIDE]
        if start:
            reach = bound[start] * length[open_]
            reach = reach * (1 + GUARD * np.sign(reach)) if unit == 1 else reach
            last = best[open_].min(axis=2)  # of each band
            if low is not None:
                floor = low[open_] / 100 if kind is float else np.array(
                    [[x // 100 for x in row] for row in low[open_]], object).reshape(len(open_), bands)
                last = np.maximum(last, floor)
                last = np.where(low[open_] <= high[open_], last, -least)
            open_ = open_[(reach[:, None] >= last * unit).astype(bool).any(axis=1)]
        if not len(open_):
            break
        s = q[open_] @ block.z[here].T
        usable = (labels[open_, None] == block.labels[here]) == same
        usable &= ids[open_, None] != block.ids[here]
        for b in range(bands):
            fits = usable
            if low is not None:
                fits = usable & (100 * s >= low[open_, b, None]) & (100 * s <= high[open_, b, None])
            fits = fits & (s >= best[open_, b].min(axis=1)[:, None])
            rows = np.flatnonzero(fits.any(axis=1))
            if not len(rows):
                continue
            masked = np.where(fits[rows], s[rows], least)
            best[open_[rows], b] = best_scores(best[open_[rows], b], masked)
            i, j = np.nonzero(fits[rows] & (masked >= best[open_[rows], b].min(axis=1)[:, None]))
            member.append(open_[rows[i]])
            band.append(np.full(len(i), b))
            place.append(here[j])
            score.append(masked[i, j])
    if not member:
        return (np.zeros(0, int),) * 3 + (np.zeros(0, kind),)
    member, band, place, score = (np.concatenate(x) for x in (member, band, place, score))
    stay = score >= best[member, band].min(axis=1)
    return member[stay], band[stay], place[stay], score[stay]


def first(k: int, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the first ``k`` of every group, by score and id."""
    if score.dtype == object:
        order = np.array(sorted(range(len(score)), key=lambda i: (group[i], -score[i], ids[i])), int)
    else:
        order = np.lexsort([ids, -score, group])
    g = group[order]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    return order[rank < k]


def clipped(score: np.ndarray) -> np.ndarray:
    if score.dtype == object:
        return np.array([min(max(int(x), LONG.min), LONG.max) for x in score], np.int64)
    return score.astype(np.int64)


def vectors_of(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                   ("id", pa.int64()), ("score", pa.int64())])


def search(k: int, scale: int, lower: int, upper: int, same: bool):
    """The function of a task: rows sorted by part, block, kind (candidates
    first), cluster and id -> the best of every anchor (and positive) in
    every block."""

    def found(block: Block, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        ids = t.column("id").to_numpy()
        q = integers(vectors_of(t, "v"), scale)
        if (q.dtype == object) != (block.z.dtype == object):  # both exact integers, or both doubles
            q, block = exact(q), block if block.z.dtype == object else Block(block.ids, block.labels, exact(block.z))
        labels = t.column("label").to_numpy()
        low = high = None
        if not same:
            wide = t.column("positives").combine_chunks()
            counts = wide.value_lengths().to_numpy()
            flat = wide.flatten()
            ps = np.zeros((len(ids), max(counts.max(initial=1), 1)), object if q.dtype == object else float)
            at = np.zeros(ps.shape, np.int64)
            row = np.repeat(np.arange(len(ids)), counts)
            col = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            values = flat.field("score").to_numpy()
            ps[row, col] = [int(x) for x in values] if ps.dtype == object else values
            at[row, col] = flat.field("id").to_numpy()
            low, high = lower * ps, upper * ps
            none = np.ones(ps.shape, bool)
            none[row, col] = False
            low[none], high[none] = 1, 0
        m, b, c, s = walk(block, ids, labels, q, k, same, low, high)
        pick = first(k, m * (1 if low is None else low.shape[1]) + b, s, block.ids[c])
        m, b, c, s = m[pick], b[pick], c[pick], s[pick]
        if same:
            p = ps_ = pa.nulls(len(m), pa.int64())
        else:
            p, ps_ = pa.array(at[m, b], pa.int64()), pa.array(clipped(ps[m, b]), pa.int64())
        return pa.record_batch([pa.array(ids[m], pa.int64()), p, ps_, pa.array(block.ids[c], pa.int64()),
                                pa.array(clipped(s), pa.int64())], schema=FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # (part, block)
        block, waiting, cluster = None, [], None  # candidates that wait for their block's end; members
        members: list[pa.RecordBatch] = []

        def built() -> Block:
            t = pa.Table.from_batches(waiting)
            return Block(t.column("id").to_numpy(), t.column("label").to_numpy(), integers(vectors_of(t, "v"), scale))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("part", "block", "kind", "cluster")], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, z in zip([0, *edges], [*edges, len(keys)]):
                part, where, kind, near = keys[a].tolist()
                if members and (state != (part, where) or near != cluster):
                    yield found(block, members)
                    members = []
                if state != (part, where):
                    state, block, waiting = (part, where), None, []
                if kind == 0:
                    waiting.append(batch.slice(a, z - a))
                    continue
                if not waiting and block is None:
                    continue  # a block without candidates
                if block is None:
                    block, waiting = built(), []
                cluster = near
                while a < z:
                    take = min(z - a, MEMBERS - sum(x.num_rows for x in members))
                    members.append(batch.slice(a, take))
                    a += take
                    if sum(x.num_rows for x in members) >= MEMBERS:
                        yield found(block, members)
                        members = []
        if members:
            yield found(block, members)

    return run


def meet(candidates: DataFrame, anchors: DataFrame, run) -> DataFrame:
    """Deal candidates and anchors (columns ``part`` and ``block`` tell
    where) to tasks and apply ``run`` to the rows in order."""
    none = F.lit(None).cast("array<struct<id:long,score:long>>")
    left = candidates.select("part", "block", F.lit(0).alias("kind"), F.lit(-1).alias("cluster"), "id", "label", "v",
                             none.alias("positives"))
    right = anchors.select("part", "block", F.lit(1).alias("kind"), "cluster", "id", "label", "v",
                           (F.col("positives") if "positives" in anchors.columns else none).alias("positives"))
    rows = left.unionByName(right).repartition("part", "block")
    rows = rows.sortWithinPartitions("part", "block", "kind", "cluster", "id")
    return rows.mapInArrow(run, "anchor_id long, positive_id long, positive_score long, id long, score long")


def best(found: DataFrame, key: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(df: DataFrame, id_column: str, label: str, column: str) -> DataFrame:
    """``id``, ``label`` and ``v`` of the rows that take part, one an id."""
    named = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                      F.col(f"`{column}`").cast("array<double>").alias("v"))
    kept = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    sizes = kept.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    top = sizes.orderBy(F.col("rows").desc(), F.col("n").desc()).first()
    kept = kept.where(F.size("v") == F.lit(top["n"] if top else 0))
    one = kept.groupBy("id").agg(F.min(F.struct("v", "label")).alias("r"))
    return one.select("id", "r.label", "r.v")


def mine(df: DataFrame, anchor: Column | None = None, positives: int = 5, negatives: int = 10, lower: int = 30,
         upper: int = 90, scale: int = 256, id_column: str = "vec_id", label: str = "label",
         column: str = "embedding") -> DataFrame:
    """Hard negatives of the rows that ``anchor`` (a condition on ``id``)
    names; every hundredth id by default.  A negative's score lies between
    ``lower`` and ``upper`` hundredths of the positive's.  Labels are
    integers.  Columns: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``."""
    rows = cut(usable(df, id_column, label, column))
    anchor = F.pmod("id", F.lit(100)) == 0 if anchor is None else anchor
    chosen = rows.where(anchor)
    sample = chosen.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    middle = centres(np.array([r["v"] for r in sample]) if sample else np.zeros((0, 1)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = (directions(vectors_of(batch, "v")) @ middle.T).argmax(axis=1) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where, pa.int32())],
                                             names=["id", "label", "v", "cluster"])

    chosen = cut(chosen.select("id", "label", "v").mapInArrow(near, "id long, label long, v array<double>, cluster int"))
    cores = max(1, int(df.sparkSession.sparkContext.defaultParallelism))

    def blocks(n: Column) -> Column:
        """Blocks that ``n`` candidates are dealt into."""
        return F.greatest(F.ceil(n / BLOCK), F.least(F.ceil(n / LEAST), F.lit(cores)), F.lit(1)).cast("int")

    deal = F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int").alias("block")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    # positives: blocks of one label, met by the anchors of that label
    sizes = rows.groupBy("label").agg(blocks(F.count(F.lit(1))).alias("blocks"))
    of_label = rows.join(sizes, "label").select(F.col("label").alias("part"), deal, "id", "label", "v")
    to_label = chosen.join(sizes, "label").select(F.col("label").alias("part"), every, "cluster", "id", "label", "v")
    found = best(meet(of_label, to_label, search(positives, scale, lower, upper, True)), ["anchor_id"], positives)
    mine_ = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    mine_ = mine_.select(F.col("anchor_id").alias("id"), F.transform(
        "p", lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))).alias("positives"))
    # negatives: blocks of all rows, met by the anchors that have positives
    count = rows.agg(blocks(F.count(F.lit(1))).alias("blocks")).first()["blocks"]
    whole = F.lit(0).cast("long").alias("part")
    dealt = rows.withColumn("blocks", F.lit(count)).select(whole, deal, "id", "label", "v")
    sent = chosen.join(cut(mine_), "id").withColumn("blocks", F.lit(count)).select(
        whole, every, "cluster", "id", "label", "v", "positives")
    hard = best(meet(dealt, sent, search(negatives, scale, lower, upper, False)), ["anchor_id", "positive_id"], negatives)
    return hard.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                       F.col("score").alias("negative_score"))


def mine_sql(anchor: int = 100, moved: int = 7, scale: int = 256, positives: int = 5, negatives: int = 10) -> str:
    """DuckDB SQL for ``op13_hard_negatives``: all inner products."""
    return f"""
WITH named AS (SELECT vec_id, CASE WHEN vec_id % {moved} = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
               FROM embeddings WHERE label IS NOT NULL),
parts AS (SELECT vec_id, label, i, floor({scale} * embedding[i]::DOUBLE)::BIGINT AS x
          FROM named, (SELECT unnest(range(1, 65)) AS i)),
scores AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, sum(q.x * c.x)::BIGINT AS score
           FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id AND q.vec_id % {anchor} = 0
           GROUP BY ALL),
positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives}),
ranked AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
           FROM positive p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
                AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {negatives}
"""
