"""Searching vectors block by block.

Candidates are dealt into blocks of bounded size by a hash of their id and
shuffled once; the queries, few of the rows, are copied to every block.  A
task reads its rows in order, a block first and then its queries, so that
it builds a block's index once and holds one block and one batch of queries
whatever the table's size.  The bests of the blocks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates of a block, and of the smallest that a table is cut into to
#: keep all cores busy; queries that are searched for together.
BLOCK, LEAST, QUERIES = 16_384, 1_024, 256


def clean(df: DataFrame, id_column: str = "vec_id", column: str = "embedding", zero: bool = True) -> DataFrame:
    """``id`` and ``v`` (array<double>) of the vectors that take part: not
    NULL, without NULL or non-finite components, of the most frequent
    length (of two, the longer), and not all zero unless ``zero``."""
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                     F.col(f"`{column}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    top = lengths.orderBy(F.col("rows").desc(), F.col("n").desc()).first()
    return rows.where(F.size("v") == F.lit(top["n"] if top else 0))


def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and their vectors; of rows with the same id
    the one with the smallest vector."""
    ids = table.column("id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    v = flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))
    order = np.argsort(ids, kind="stable")
    same = np.flatnonzero(np.diff(ids[order]) == 0)
    if len(same):
        order = np.lexsort([*v.T[::-1], ids])
    order = order[np.concatenate([[True], np.diff(ids[order]) != 0])[:len(order)]]
    return ids[order], v[order]


def one_each(rows: DataFrame) -> DataFrame:
    """One row for each id, with its smallest vector."""
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def by_blocks(queries: DataFrame, candidates: DataFrame, k: int, score: str, build: Callable[[np.ndarray, np.ndarray], Any],
              find: Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """The best ``k`` candidates of each query: ``query_id``, ``rank``,
    ``vec_id``, ``score``.  Ids are unique on both sides.

    ``build(ids, vectors)`` makes a block's index; ``find(index, query_ids,
    queries)`` returns arrays of the query's row, the candidate's row in the
    block and the score.  Larger scores come first if ``score`` is ``long``,
    smaller ones if it is ``double`` (distances); ties go to the smaller
    ``vec_id``.
    """
    n = candidates.count()
    cores = max(1, int(candidates.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, -(-n // BLOCK), min(-(-n // LEAST), cores))
    left = candidates.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v")
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v")
    rows = left.unionByName(right).repartition("block").sortWithinPartitions("block", "kind", "id")
    kind = pa.int64() if score == "long" else pa.float64()

    def found(ids: np.ndarray, index: Any, members: list[pa.RecordBatch]) -> pa.RecordBatch:
        q_ids, q = arrays(pa.Table.from_batches(members))
        a, b, s = find(index, q_ids, q)
        return pa.record_batch([pa.array(q_ids[a], pa.int64()), pa.array(ids[b], pa.int64()), pa.array(s).cast(kind)],
                               names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, members = None, [], []  # block, its candidates so far, queries that wait
        ids = index = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "kind")], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, z in zip([0, *edges], [*edges, len(keys)]):
                if a == z:
                    continue
                if current != keys[a, 0]:
                    if members:
                        yield found(ids, index, members)
                    current, waiting, members, index = keys[a, 0], [], [], None
                if not keys[a, 1]:
                    waiting.append(batch.slice(a, z - a))
                    continue
                if index is None:
                    if not waiting:
                        continue  # a block without candidates
                    ids, v = arrays(pa.Table.from_batches(waiting))
                    index, waiting = build(ids, v), []
                while a < z:
                    take = min(z - a, QUERIES - sum(m.num_rows for m in members))
                    members.append(batch.slice(a, take))
                    a += take
                    if sum(m.num_rows for m in members) >= QUERIES:
                        yield found(ids, index, members)
                        members = []
        if members:
            yield found(ids, index, members)

    best = F.col("score").desc() if score == "long" else F.col("score").asc()
    order = Window.partitionBy("query_id").orderBy(best, "vec_id")
    return (rows.mapInArrow(run, f"query_id long, vec_id long, score {score}")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest scores, ties to the smaller id."""
    if len(scores) > k:
        limit = np.partition(scores, k - 1)[k - 1]
        near = np.flatnonzero(scores <= limit)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort([ids[near], scores[near]])[:k]]
