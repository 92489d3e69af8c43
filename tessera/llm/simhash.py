"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints
    A text's words are hashed in shingles (XXH64, seed 42); bit ``b`` of the
    fingerprint is 1 if it is set in over half of the hashes.
Links
    Equal fingerprints are one row from here on (with the smallest
    ``doc_id``), so a group of copies of any size costs nothing.  Two
    fingerprints within the radius agree on at least ``BLOCKS - radius`` of
    ``BLOCKS`` blocks of bits: every choice of that many blocks is a table,
    and only rows that share a table's key are compared.
Comparison
    The rows of a key are laid out as vertical bit planes: one long integer
    for each of the 64 bits, one lane a row.  Plane XOR plane-shifted-by-d
    compares every row with the one ``d`` places on; carry-save counters
    (again long integers) add the 64 results for all lanes at once, and a
    block of lanes is abandoned as soon as every lane is over the radius.
    Of the pairs found only those that join two parts of a run are put out
    (a spanning forest), never all pairs of a group.
    A key with more than ``TILE`` rows is cut into tiles of about that size
    by hash, and every two tiles are compared by a task of their own.
Components
    Large-star / small-star rounds over the links, each materialised in the
    shared checkpoint folder, until nothing changes.

Defined results: NULL and empty texts have no words, fingerprint zero, and
are linked like any other.  Rows with a NULL ``doc_id`` are kept, each with
its fingerprint's component (NULL if no row of the component has an id).
Repeated rows are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, utf8

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64
#: Blocks of 16 bits; for radius 2 that makes 6 tables keyed by 32 bits.
BLOCKS = 4
#: Rows of a key that one task compares with each other, at most about.
TILE = 4096
#: Lanes of a block of short runs; a run of over a sixteenth of it is a block of its own.
LANES = 1 << 14
#: Hashes turned into bits at a time.
HASHES = 1 << 14


def words(data: bytes) -> list[bytes]:
    """Words between ASCII white space (0x20, 0x09-0x0D), A-Z in lower case."""
    return data.lower().split()


def shingle_hashes(data: bytes, n: int) -> list[int]:
    """XXH64 of every run of ``n`` words, joined by one space; of the whole
    sequence if it is shorter."""
    from xxhash import xxh64_intdigest as xxh

    found = words(data)
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= n:
        return [xxh(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = [0, *ends[:len(found) - n].tolist()]
    return [xxh(joined[a:b], SEED) for a, b in zip(starts, (ends[n - 1:] - 1).tolist())]


def fingerprint(data: bytes, n: int = SHINGLE) -> int:
    hashes = shingle_hashes(data, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), HASHES):
        part = np.array(hashes[i:i + HASHES], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, n) for t in utf8(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (the 64 bits as a long),
    materialised: 24 bytes a document, so texts are hashed once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("text_hash"))
    return cut(rows.mapInArrow(_fingerprints(n), "doc_id long, text_hash long, fp long"))


# ---- comparison within runs of equal keys ------------------------------

class Forest:
    """Labels of rows that hang together so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join pairs; returns those that joined two parts."""
        kept = []
        apart = self.label[a] != self.label[b]
        a, b = a[apart], b[apart]
        while len(a):
            # one pair for each part that is hooked to a smaller one at a time
            x, y = self.label[a], self.label[b]
            high, low = np.maximum(x, y), np.minimum(x, y)
            _, first = np.unique(high, return_index=True)
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            kept.append((a[first], b[first]))
            while True:  # to the roots
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            self.label = parent[self.label]
            apart = self.label[a] != self.label[b]
            a, b = a[apart], b[apart]
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *(k[i] for k in kept)]) for i in (0, 1))


def planes(fps: np.ndarray, which: list[int]) -> list[int]:
    """Bit planes of fingerprints: lane ``i`` of the plane of bit ``b`` is
    bit ``b`` of row ``i``."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return [int.from_bytes(np.packbits(bits[:, b], bitorder="little").tobytes(), "little") for b in which]


def near(vertical: list[int], shift: int, valid: int, radius: int) -> int:
    """Lanes of ``valid`` whose row is within ``radius`` bits of the row
    ``shift`` places on."""
    counters = [0] * max(radius.bit_length(), 1)
    over = 0
    for plane in vertical:
        carry = (plane ^ (plane >> shift)) & valid
        full = carry  # lanes that differ here and were at the radius already
        for i, c in enumerate(counters):
            full &= c if radius >> i & 1 else ~c
        over |= full
        if over == valid:
            return 0  # the block is abandoned
        for i, c in enumerate(counters):
            counters[i], carry = c ^ carry, c & carry
    return valid & ~over


def lanes(mask: int, n: int) -> np.ndarray:
    raw = np.frombuffer(mask.to_bytes(-(-n // 8), "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")[:n])


def pack(flags: np.ndarray) -> int:
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def links_of_block(fps: np.ndarray, sizes: np.ndarray, which: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows laid out in runs of the given sizes; pairs within the radius
    that span what hangs together in each run."""
    n = len(fps)
    vertical = planes(fps, which)
    behind = np.repeat(np.cumsum(sizes), sizes) - np.arange(n) - 1  # rows of the run still to come
    forest, found = Forest(n), []
    for shift in range(1, int(sizes.max())):
        hit = near(vertical, shift, pack(behind >= shift), radius)
        if hit:
            a = lanes(hit, n)
            found.append(forest.join(a, a + shift))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *(f[i] for f in found)]) for i in (0, 1))


def blocks_of(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut runs into blocks ``[start, stop)`` of runs: a long run alone,
    short ones together up to ``LANES`` rows."""
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (total + size > LANES or size > LANES >> 4):
            yield start, i
            start, total = i, 0
        total += size
        if size > LANES >> 4:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def key_masks(radius: int) -> list[int]:
    """Of every table the bits that make its key."""
    width = BITS // BLOCKS
    block = [((1 << width) - 1) << i * width for i in range(BLOCKS)]
    return [sum(c) for c in combinations(block, max(BLOCKS - radius, 0))]


def _comparer(radius: int):
    masks = key_masks(radius)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _ended(batches):
            if batch is None:
                rows, done = held, len(held[0]) if held is not None else 0
            else:
                rows = batch if held is None else tuple(np.concatenate(x) for x in zip(held, batch))
                changes = _changes(rows)
                done = changes[-1] if len(changes) else 0  # the last run may go on
                held = tuple(x[done:] for x in rows)
            if not done:
                continue
            rows = tuple(x[:done] for x in rows)
            ends = np.append(_changes(rows), done)
            starts = np.concatenate([[0], ends[:-1]])
            tables = rows[0][starts]
            for t in np.unique(tables):
                mine = np.flatnonzero(tables == t)
                which = [b for b in range(BITS) if not masks[t] >> b & 1]
                for i, j in blocks_of((ends - starts)[mine]):
                    lo, hi = starts[mine[i]], ends[mine[j - 1]]
                    fps = rows[-1][lo:hi]
                    a, b = links_of_block(fps, (ends - starts)[mine[i:j]], which, radius)
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["a", "b"])

    return compare


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple | None]:
    """The batches' columns as arrays, then None."""
    for batch in batches:
        if batch.num_rows:
            yield tuple(c.to_numpy() for c in batch.columns)
    yield None


def _changes(rows: tuple) -> np.ndarray:
    """Where a row's key differs from that of the row before."""
    new = np.zeros(max(len(rows[0]) - 1, 0), bool)
    for column in rows[:-1]:
        new |= column[1:] != column[:-1]
    return np.flatnonzero(new) + 1


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a``, ``b`` between different fingerprints of ``prints`` (fp)
    that span everything within ``radius`` bits."""
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"the tables hold a radius from 0 to {BLOCKS - 1}")
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for t, m in enumerate(key_masks(radius))])
    rows = prints.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    tiles = F.ceil(F.col("n") / F.lit(TILE)).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    pairs = F.when(tiles == 1, F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi")))).otherwise(
        F.transform(F.sequence(F.lit(0), tiles - 1),
                    lambda o: F.struct(F.least(own, o).alias("lo"), F.greatest(own, o).alias("hi"))))
    tiled = (rows.join(sizes, ["t", "key"]).select("t", "key", F.explode(pairs).alias("p"), "fp")
             .select("t", "key", "p.lo", "p.hi", "fp"))
    key = ["t", "key", "lo", "hi"]
    return (tiled.repartition(*key).sortWithinPartitions(*key, "fp")
            .mapInArrow(_comparer(radius), "a long, b long"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


# ---- components --------------------------------------------------------

def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def components(found: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node that hangs together with
    it) of every node of the links ``a``, ``b``."""
    edges = cut(found.where(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges, before = cut(small), state
        state = _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (the
    smallest ``doc_id`` that can be reached) of every document."""
    prints = fingerprints(docs, n)
    different = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    members = cut(components(links(different.select("fp"), radius)).withColumnRenamed("node", "fp"))
    lowest = members.join(different, "fp").groupBy("root").agg(F.min("rep").alias("component_id"))
    linked = members.join(lowest, "root").select("fp", "component_id")
    label = different.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))
    return prints.join(label, "fp").select("doc_id", hex16("fp").alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id`` and ``text_hash`` of one row of every component: the
    smallest ``doc_id`` (NULL last), of its texts the one with the smallest
    hash."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = fingerprints(docs, n).groupBy("fp").agg(F.min(row).alias("row"))
    members = components(links(best.select("fp"), radius)).withColumnRenamed("node", "fp")
    whole = best.join(members, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("row").alias("row"))
    return whole.select("row.doc_id", "row.text_hash")


def hex16(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
