"""Removal of repeated passages by per-shard suffix arrays.

A byte is removed if it lies in a string of ``span`` bytes (a window) that
also starts anywhere else, in the same text or another; matches never cross
texts and are judged on the input.

Anchors
    Which windows can be equal at all?  The place in a window whose ``GRAM``
    bytes have the smallest hash, of equal ones the leftmost, depends on the
    window's bytes alone: equal windows have equal anchors at the same place.
    Consecutive windows of a text with one anchor form an entry (their bytes
    overlap), and every window is in one entry.  Entries whose anchor hash
    occurs once hold no repeated window; nothing else is decided here.
Shards
    Different entries with repeated anchors are dealt into shards of bounded
    size by anchor hash (an anchor with over an eighth of a shard has its
    own); equal entries are one with their number as weight.
    A shard's text is the entries' bytes.  Its suffix array comes from
    Larsson-Sadakane refinement: suffixes are sorted by eight bytes, then
    those of unsorted groups by the rank of what follows, at doubled depth
    each round, until the depth reaches a window.  Common prefixes come from
    Kasai's walk (each prefix is at most one byte shorter than its
    predecessor's in the text), taken by all stretches of the text at once.
    Neighbours that share ``span`` bytes form a class; the windows of a class
    of weight two or more are repeated.
Merging
    The entries of an anchor that fill more than a shard are dealt over
    several.  Each makes a sorted run of the classes of such entries: a
    128-bit digest of the window, its weight and, where that is one, its
    place.  The runs are cut at the same digests, and a task merges what lies
    in one range, by binary search of every run's digests among all; a class
    that weighs one in its shard and two or more in the sum is repeated.  A
    digest stands for 400 bytes, so merging costs the entries' size, not its
    square.
Texts
    The repeated windows of the entries go back to the texts by the texts'
    128-bit hash; texts travel compressed.  A text that over a thousandth of
    the rows share is split over as many keys as it has thousandths.

Defined results: NULL texts are empty; texts shorter than a window lose
nothing and repeat nothing; every row is a text of its own, so that repeated
rows (with the same id, too) repeat each other whole; rows with a NULL id
stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

from .common import BATCH_BYTES, runs, utf8

SPAN, GRAM = 400, 32
#: Bytes of the entries of a shard (its arrays take some hundred times as much).
SHARD = 1 << 18
#: Bytes of text that are hashed together (a longer text comes in pieces).
PIECE = 1 << 16
#: Windows of split anchors that a task merges.
MERGED = 1 << 19
#: Texts with more copies than a ``HOT``-th of the rows are split.
HOT = 1000

_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# -- anchors -------------------------------------------------------------------

def grams(x: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two) from each place."""
    h, k = _BYTE[x], 1
    while k < size:
        h = h[:-k] * _ODD + h[k:]
        h ^= h >> np.uint64(31)
        k *= 2
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def anchors(x: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes at all places and the anchor's place of every window."""
    h, wide = grams(x, gram), span - gram + 1
    low = np.uint64((1 << 20) - 1)
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost
    k = 1
    while 2 * k <= wide:
        best = np.minimum(best[:-k], best[k:])
        k *= 2
    if k < wide:
        best = np.minimum(best[:len(best) - (wide - k)], best[wide - k:])
    return h, (best & low).astype(np.int64)


def pieces(texts: list[bytes], span: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (number of the text, place in it, bytes) of about ``PIECE``
    bytes; the pieces of a long text overlap so that each window is in one."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - span + 1, 0), PIECE):
            part = text[at:at + PIECE + span - 1]
            if group and size + len(part) > PIECE:
                yield group
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        yield group


def entries(texts: list[bytes], span: int, gram: int, digest: bool = True):
    """Entries of the texts: text number, anchor hash, digest of the bytes,
    place of the first window and number of windows."""
    found = []
    for group in pieces(texts, span):
        joined = b"".join(part for _, _, part in group)
        h, place = anchors(np.frombuffer(joined, np.uint8), span, gram)
        inside = np.zeros(len(place), bool)
        edge = np.zeros(len(place) + 1, bool)
        edge[1:-1] = place[1:] != place[:-1]
        begin, starts = 0, []
        for _, _, part in group:
            inside[begin:begin + len(part) - span + 1] = True
            edge[begin] = edge[begin + len(part) - span + 1] = True
            starts.append(begin)
            begin += len(part)
        edge[-1] = True
        first = np.flatnonzero(edge[:-1] & inside)
        edges = np.flatnonzero(edge)
        count = edges[np.searchsorted(edges, first, side="right")] - first
        which = np.searchsorted(starts, first, side="right") - 1
        number = np.array([i for i, _, _ in group])[which]
        offset = first - np.array(starts)[which] + np.array([at for _, at, _ in group])[which]
        digests = np.array([xxhash.xxh3_64_intdigest(joined[a:a + n + span - 1])
                            for a, n in zip(first.tolist(), count.tolist())] if digest else [0] * len(first), np.uint64)
        found.append((number, h[place[first]].view(np.int64), digests.view(np.int64), offset, count))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


# -- suffix arrays -------------------------------------------------------------

def words(x: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a number, zeros after the end."""
    w = np.concatenate([x, np.zeros(7, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        w = (w[:-k] << np.uint64(8 * k)) | w[k:]
    return w


def suffix_array(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of (at least) their first ``depth`` bytes, and
    whether each is the first of those that share that many:
    Larsson-Sadakane refinement of unsorted groups."""
    n = len(x)
    w = words(x)
    sa = np.argsort(w, kind="stable")
    first = np.ones(n + 1, bool)  # is this place the first of its group?
    first[1:n] = w[sa][1:] != w[sa][:-1]
    group = np.maximum.accumulate(np.where(first[:n], np.arange(n), 0))
    rank = np.zeros(n + max(depth, 8), np.int64)  # after the end: before all
    rank[sa] = group + 1
    h = 8
    while h < depth:
        slots = np.flatnonzero(~(first[:n] & first[1:]))
        if not len(slots):
            break
        at = sa[slots]
        key = rank[at] * (n + 2) + rank[at + h]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        sa[slots] = at
        first[slots] = new
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))] + 1
        h *= 2
    return sa, first[:n]


#: Bytes of a stretch that is walked along with the others.
STRETCH = 256


def common_prefixes(x: np.ndarray, sa: np.ndarray, first: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in
    the array, up to ``most``: Kasai's walk over all stretches of the text at
    once.  Suffixes that the array leaves in one group (they share ``most``
    bytes or more, in any order) need no walk, and give no bound for the next
    place of the text."""
    n = len(x)
    w = np.concatenate([words(x), np.zeros(most + 16, np.uint64)])
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    tied = np.zeros(n, bool)
    tied[sa] = ~first
    out = np.zeros(n, np.int64)
    at = np.arange(0, n, STRETCH)
    end = np.minimum(at + STRETCH, n)
    h = np.zeros(len(at), np.int64)
    while len(at):
        j, tie = before[at], tied[at]
        room = np.where(j < 0, 0, np.minimum(most, n - np.maximum(at, j)))  # the end of the text ends a prefix
        differ = w[at + h] ^ w[np.maximum(j, 0) + h]
        equal = np.full(len(at), 8)
        some = np.flatnonzero(differ)
        if len(some):
            d = differ[some]
            equal[some] = sum((d < np.uint64(1 << 8 * b)).astype(np.int64) for b in range(1, 8))
        h = np.minimum(h + equal, room)
        done = (equal < 8) | (h >= room) | tie
        out[at[done]] = np.where(tie, room, h)[done]
        at = at + done
        h = np.where(done, np.where(tie, 0, np.maximum(h - 1, 0)), h)
        going = at < end
        if not going.all():
            at, end, h = at[going], end[going], h[going]
    return out[sa]


def classes(x: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the number of each one's class: suffixes
    that share ``span`` bytes."""
    sa, first = suffix_array(x, span)
    new = common_prefixes(x, sa, first, span) < span
    return sa, np.cumsum(new) - 1


# -- shards --------------------------------------------------------------------

#: A class of a run: digest (in two halves), weight, entry and window.
CLASS = np.dtype([("high", ">u8"), ("low", ">u8"), ("weight", "<i8"), ("a", "<i8"), ("c", "<i8"), ("offset", "<i4")])


def shard(span: int, ranges: int):
    """The function of a shard: its entries -> a bit for each window
    (``flags``), and the run of its classes of split anchors, a row for each
    of ``ranges`` ranges of digests."""

    def run(table: pa.Table) -> pa.Table:
        parts = table.column("bytes").to_pylist()
        weight = table.column("weight").to_numpy()
        a, c = table.column("a").to_numpy(), table.column("c").to_numpy()
        # an entry that was taken from two rows with the same id and text is one
        _, only = np.unique(np.stack([a, c]), axis=1, return_index=True)
        parts, a, c, weight = [parts[i] for i in only], a[only], c[only], weight[only]
        split = table.column("split").to_numpy(zero_copy_only=False)[only]
        size = np.array([len(p) for p in parts])
        begin = np.cumsum(size) - size
        text = b"".join(parts)
        x = np.frombuffer(text, np.uint8)
        entry = np.repeat(np.arange(len(parts)), size)
        starts = np.arange(len(x)) - begin[entry] <= size[entry] - span  # windows that the entries hold
        sa, number = classes(x, span)
        mine = starts[sa]
        at, number = sa[mine], number[mine]
        weighs = np.bincount(number, weights=weight[entry[at]])
        again = np.zeros(len(x), bool)
        again[at] = weighs[number] >= 2
        flags = [np.packbits(again[b:b + n - span + 1]).tobytes() for b, n in zip(begin.tolist(), size.tolist())]
        some = [i for i, bits in enumerate(flags) if split[i] or any(bits)]
        found = {"a": a[some].tolist(), "c": c[some].tolist(), "flags": [flags[i] for i in some],
                 "range": [None] * len(some), "run": [None] * len(some)}
        one = split[entry[at]]
        if one.any():
            at, number = at[one], number[one]
            number, first = np.unique(number, return_index=True)
            at = at[first]
            sorted_ = np.zeros(len(at), CLASS)
            digest = b"".join(xxhash.xxh3_128_digest(text[i:i + span]) for i in at.tolist())
            halves = np.frombuffer(digest, ">u8").reshape(-1, 2)
            sorted_["high"], sorted_["low"], sorted_["weight"] = halves[:, 0], halves[:, 1], weighs[number]
            sorted_["a"], sorted_["c"], sorted_["offset"] = a[entry[at]], c[entry[at]], at - begin[entry[at]]
            sorted_ = sorted_[np.lexsort([halves[:, 1], halves[:, 0]])]
            edges = np.searchsorted(sorted_["high"].astype(np.uint64), _cuts(ranges))
            for i, (m, n) in enumerate(zip([0, *edges], [*edges, len(sorted_)])):
                if n > m:
                    for column, value in (("a", None), ("c", None), ("flags", None), ("range", i), ("run", sorted_[m:n].tobytes())):
                        found[column].append(value)
        return pa.table(found, schema=_SHARD)

    return run


def _cuts(ranges: int) -> np.ndarray:
    """The digests' first halves at which runs are cut."""
    return np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)


_SHARD = pa.schema([("a", pa.int64()), ("c", pa.int64()), ("flags", pa.binary()), ("range", pa.int64()), ("run", pa.binary())])
_SHARD_DDL = "a long, c long, flags binary, range long, run binary"


def merge(table: pa.Table) -> pa.Table:
    """The runs of one range of digests, one a shard -> the windows that
    weigh one in their shard and more in all."""
    runs_ = [np.frombuffer(r, CLASS) for r in table.column("run").to_pylist()]
    keys = [r[["high", "low"]].astype([("high", np.uint64), ("low", np.uint64)]) for r in runs_]
    every = np.unique(np.concatenate(keys))
    places = [np.searchsorted(every, k) for k in keys]  # each run's digests among all
    total = np.zeros(len(every), np.int64)
    for r, place in zip(runs_, places):
        total[place] += r["weight"]  # a run holds a digest once
    found = np.concatenate([r[(r["weight"] < 2) & (total[place] >= 2)] for r, place in zip(runs_, places)])
    return pa.table({"a": found["a"].astype(np.int64), "c": found["c"].astype(np.int64),
                     "offset": found["offset"].astype(np.int32)})


# -- texts ---------------------------------------------------------------------

def cover(spans: list[dict], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of bytes that repeated windows cover;
    ``spans`` holds entries' packed places, flags and further windows."""
    place = np.array([s["place"] for s in spans], np.int64)
    size = np.array([len(s["flags"]) for s in spans], np.int64)
    begin = (np.cumsum(size) - size) * 8
    bits = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(s["flags"] for s in spans), np.uint8)))
    of = np.searchsorted(begin, bits, side="right") - 1
    starts = [(place[of] >> 9) + bits - begin[of]]
    starts += [(s["place"] >> 9) + np.array(s["more"], np.int64) for s in spans if s["more"]]
    starts = np.unique(np.concatenate(starts))
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > span)
    return starts[np.concatenate([[0], gap + 1])], starts[np.concatenate([gap, [len(starts) - 1]])] + span


def packed_place(offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Place of an entry's first window and their number (under 512)."""
    return offset.astype(np.int64) << 9 | count


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _anchored(docs: DataFrame, span: int, gram: int, whole: bool) -> DataFrame:
    """Entries of all texts: anchor hashes alone, or all that is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, z in runs(map(len, texts)):
                number, h, c, offset, count = entries(texts[a:z], span, gram, whole)
                if not whole:
                    yield pa.RecordBatch.from_arrays([pa.array(h)], names=["a"])
                    continue
                d1, d2 = (batch.column(k).slice(a, z - a).to_numpy()[number] for k in ("d1", "d2"))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, c, d1, d2, packed_place(offset, count))],
                                                 names=["a", "c", "d1", "d2", "place"])

    return docs.select("d1", "d2", "text").mapInArrow(run, "a long, c long, d1 long, d2 long, place long" if whole else "a long")


def _compressed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The texts as zstandard frames, ``z``."""
    schema = docs.select(*keep).schema.add("z", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = pa.array([press.compress(t) for t in utf8(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), z], names=[*keep, "z"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


_TAKEN = pa.schema([("shard", pa.int64()), ("a", pa.int64()), ("c", pa.int64()), ("weight", pa.int64()),
                    ("split", pa.bool_()), ("bytes", pa.binary())])


def _take(span: int):
    """Texts with the entries wanted of them -> the entries' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            wanted = batch.column("wanted").to_pylist()
            rows, size = [], 0
            for z, want in zip(batch.column("z"), wanted):
                text = expand.decompress(z.as_py())
                for w in want:
                    offset, count = w["place"] >> 9, w["place"] & 511
                    part = text[offset:offset + count + span - 1]
                    rows.append((w["shard"], w["a"], w["c"], w["weight"], w["split"], part))
                    size += len(part)
                    if size > BATCH_BYTES:
                        yield _batch(rows, _TAKEN)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, _TAKEN)

    return run


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])


def _cut(span: int):
    """Texts with their repeated windows -> spans and kept bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, size = [], 0
            for i, z, spans in zip(*(batch.column(c) for c in ("id", "z", "spans"))):
                text = expand.decompress(z.as_py())
                found = spans.as_py()
                starts, stops = (x.tolist() for x in cover(found, span)) if found else ([], [])
                kept = b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)])) if starts else text
                rows.append((i.as_py(), len(text), [{"start": a, "stop": b} for a, b in zip(starts, stops)], kept))
                size += len(text)
                if size > BATCH_BYTES:
                    yield _batch(rows, _KEPT)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _KEPT)

    return run


def joined(many: DataFrame, few: DataFrame, keys: list[str], counts: DataFrame, row: Column, how: str = "inner",
           total: int | None = None) -> DataFrame:
    """``many`` joined with ``few`` (one row a key).  ``counts`` (keys, ``k``)
    tells the rows of ``many`` by key (those of large keys suffice if the
    ``total`` is given): a key with over a ``HOT``-th of all is
    split by the hash ``row`` over as many keys as it has ``HOT``-ths; there
    are fewer than ``HOT`` of these, which bounds the broadcast."""
    if total is None:
        total = counts.agg(F.sum("k").alias("s")).first()["s"] or 0
    hot = F.broadcast(counts.where(F.col("k") * HOT > total).select(
        *keys, F.ceil(F.col("k") * HOT / F.lit(max(total, 1))).cast("long").alias("ways")))
    ways = F.coalesce("ways", F.lit(1).cast("long"))
    left = many.join(hot, keys, "left").withColumn("salt", F.pmod(row, ways)).drop("ways")
    right = few.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), ways - 1))).drop("ways")
    return left.join(right, [*keys, "salt"], how).drop("salt")


def shard_of(total: int) -> Column:
    """The shard of an entry by its anchor ``a``, digest ``c`` and, where the
    anchor's entries have over ``SHARD // 8`` bytes, those bytes ``all``: such
    an anchor shares its shards with no other, so that the small ones alone
    are dealt by hash and no shard grows far over ``SHARD``."""
    part = F.pmod("c", F.ceil(F.col("all") / SHARD).cast("long"))
    small = F.pmod(F.xxhash64("a"), F.lit(max(1, -(-total * 2 // SHARD))))
    return F.when(F.col("all").isNull(), small).otherwise(F.xxhash64("a", part))


def repeated(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """The repeated windows of all texts of ``docs`` (``id``, ``text``, ``n``,
    ``d1``, ``d2``): ``d1``, ``d2`` and ``spans``."""
    long = docs.where(F.col("n") >= span)
    hot = _anchored(long, span, gram, False).groupBy("a").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    hot = written(hot, "anchors")
    found = joined(_anchored(long, span, gram, True), hot.select("a"), ["a"], hot, F.xxhash64("d1", "d2", "place"))
    found = written(found.groupBy("a", "c", "d1", "d2", "place").agg(F.count(F.lit(1)).alias("k")), "entries")
    # one text for each different entry, and its shard
    one = found.groupBy("a", "c").agg(F.sum("k").alias("weight"), *[F.first(x).alias(x) for x in ("d1", "d2", "place")])
    one = written(one.withColumn("size", F.col("place").bitwiseAND(511) + (span - 1)), "different")
    total, rows = one.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    large = one.groupBy("a").agg(F.sum("size").alias("all"), F.count(F.lit(1)).alias("k")).where(F.col("all") * 8 > SHARD)
    large = written(large, "large")
    split = F.col("all") > SHARD
    windows = large.where(split).agg(F.sum(F.col("all") - F.col("k") * (span - 1)).alias("s")).first()["s"] or 0
    one = joined(one, large.select("a", "all"), ["a"], large, F.xxhash64("c"), "left", rows).select(
        "d1", "d2", F.struct(shard_of(total).alias("shard"), "a", "c", "weight",
                             F.coalesce(split, F.lit(False)).alias("split"), "place").alias("w"))
    row = long.groupBy("d1", "d2").agg(F.min("id").alias("i"))
    wanted = one.groupBy("d1", "d2").agg(F.collect_list("w").alias("wanted")).join(row, ["d1", "d2"])
    texts = _compressed(long, ["id", "d1", "d2"]).alias("t").join(
        wanted.alias("w"), (F.col("t.d1") == F.col("w.d1")) & (F.col("t.d2") == F.col("w.d2")) & F.col("t.id").eqNullSafe(F.col("w.i")))
    taken = texts.select("z", "wanted").mapInArrow(
        _take(span), "shard long, a long, c long, weight long, split boolean, bytes binary")
    judge = shard(span, max(1, -(-windows // MERGED)))
    judged = written(taken.groupBy("shard").applyInArrow(judge, _SHARD_DDL), "judged")
    # classes of anchors that fill several shards
    more = (judged.where(F.col("run").isNotNull()).select("range", "run").groupBy("range")
            .applyInArrow(merge, "a long, c long, offset int")
            .groupBy("a", "c").agg(F.collect_set("offset").alias("more")))
    flags = judged.where(F.col("flags").isNotNull()).select("a", "c", "flags").join(more, ["a", "c"], "left")
    texts = found.groupBy("a", "c").agg(F.count(F.lit(1)).alias("k"))
    spans = joined(found.select("a", "c", "d1", "d2", "place"), flags, ["a", "c"], texts, F.xxhash64("d1", "d2", "place"))
    return spans.groupBy("d1", "d2").agg(F.collect_list(F.struct("place", "flags", "more")).alias("spans"))


def remove(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) without the repeated
    passages: ``doc_id``, ``n_bytes``, ``spans`` (the bytes removed, as
    ``start`` and ``stop``) and ``kept`` (the other bytes)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"))
    rows = rows.select("id", "text", F.octet_length("text").alias("n"), F.xxhash64("text").alias("d1"),
                       F.xxhash64(F.lit("text"), "text").alias("d2"))
    long = F.col("n") >= span
    copies = rows.where(long).groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("k"))
    cut_ = joined(_compressed(rows.where(long), ["id", "d1", "d2"]), repeated(rows, span, gram), ["d1", "d2"], written(
        copies, "copies"), F.xxhash64("id"), "left").select("id", "z", "spans").mapInArrow(
        _cut(span), "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    short = rows.where(~long).select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:long,stop:long>>").alias("spans"), F.col("text").cast("binary").alias("kept"))
    return cut_.unionByName(short)
