"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: centred, turned onto their principal axes and
then by a rotation learned so that the signs lose as little as possible
(iterative quantisation).  A code is split into substrings of 8 or, where a
block of rows fills them, 16 bits, and each substring is an index of its
own: its value's bucket lists the rows.  By the pigeonhole principle a code within ``r = m q + a`` bits of
the query (``m`` substrings, ``0 <= a < m``) is within ``q`` bits of it in
one of the first ``a + 1`` substrings or within ``q - 1`` in one of the
others; probing all buckets that near retrieves every such code.  Those
whose whole code is within ``r`` are ranked by the distance of the vectors.

Mean, axes, rotation and radius are fitted on a sample by hash of about
``SAMPLE`` vectors (the only bound; every vector is indexed): the radius is
the one that holds the share ``TARGET`` of the true neighbours of the
sample's queries.  A query that finds fewer than ``k`` within the radius is
searched again with the radius that holds every code.

Defined results: vectors that are NULL, zero, hold NULL or non-finite
components, have a NULL id or another length than most take no part; of
rows with the same id one counts, and none is its own neighbour; fewer than
``k`` candidates are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .common import cut

BITS = 64
#: Rows of a block from which on its substrings have 16 bits.
WIDE = 1 << 13
SAMPLE = 4096
SAMPLE_QUERIES = 256
TARGET = 0.98
ROUNDS = 30

@cache
def masks(width: int) -> tuple[np.ndarray, np.ndarray]:
    """All values of ``width`` bits in order of the bits that are set, and
    how many have at most 0, 1, 2, ... of them."""
    values = np.arange(1 << width)
    bits = np.bitwise_count(values)
    return values[np.argsort(bits, kind="stable")], np.cumsum(np.bincount(bits))


class Coder(NamedTuple):
    mean: np.ndarray
    turn: np.ndarray  # dimension x bits

    def codes(self, v: np.ndarray) -> np.ndarray:
        """One row of substrings (bytes) for each vector."""
        return np.packbits((v - self.mean) @ self.turn > 0, axis=1)


def learn(sample: np.ndarray) -> Coder:
    """Principal axes and the rotation that brings the projections nearest
    to their signs."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    bits = min(BITS, sample.shape[1])
    axes = np.linalg.svd(centred.T @ centred)[0][:, :bits]
    projected = centred @ axes
    rotation = np.linalg.qr(np.random.default_rng(0).standard_normal((bits, bits)))[0]
    for _ in range(ROUNDS):
        signs = np.where(projected @ rotation > 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(signs.T @ projected)
        rotation = (u @ w).T
    return Coder(mean, axes @ rotation)


def hamming(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


def distances(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((v - q) ** 2).sum(axis=1))


def learn_radius(coder: Coder, ids: np.ndarray, v: np.ndarray, k: int) -> int:
    """Radius that holds ``TARGET`` of the true neighbours in the sample."""
    codes, apart = coder.codes(v), []
    for i in range(0, len(v), max(1, len(v) // SAMPLE_QUERIES)):
        d = distances(v, v[i])
        d[i] = np.inf
        apart.append(hamming(codes[vectors.best_of(d, ids, min(k, len(v) - 1))], codes[i]))
    apart = np.sort(np.concatenate([np.zeros(0, np.int64), *apart]))
    return int(apart[min(len(apart) - 1, int(np.ceil(TARGET * len(apart))))]) if len(apart) else BITS


class Index:
    """Buckets of every substring over one block of codes."""

    def __init__(self, codes: np.ndarray, width: int | None = None):
        self.codes = codes
        wide = len(codes) >= WIDE and not codes.shape[1] % 2
        self.width = width or (16 if wide else 8)
        self.rows, self.starts = [], []
        for column in self._split(codes).T:
            self.rows.append(np.argsort(column, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(column, minlength=1 << self.width))]))

    def _split(self, codes: np.ndarray) -> np.ndarray:
        return codes if self.width == 8 else np.ascontiguousarray(codes).view(np.uint16)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` bits, in ascending order."""
        parts = self._split(code[None, :])[0]
        q, a = divmod(radius, len(parts))
        values, most = masks(self.width)
        seen = np.zeros(len(self.codes), bool)
        for j, value in enumerate(parts):
            near = q if j <= a else q - 1
            if near < 0:
                continue
            buckets = values[:most[min(near, self.width)]] ^ int(value)
            begin, end = self.starts[j][buckets], self.starts[j][buckets + 1]
            full = end > begin
            begin, size = begin[full], (end - begin)[full]
            at = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
            seen[self.rows[j][at]] = True
        found = np.flatnonzero(seen)
        return found[hamming(self.codes[found], code) <= radius]


def _search(coder: Coder, radius: int, k: int):
    """How a block is indexed and how its index is asked."""

    def build(ids, v):
        return Index(coder.codes(v)), ids, v

    def find(block, q_ids, qs):
        index, ids, v = block
        codes = coder.codes(qs)
        rows, places, scores = [], [], []
        for i, q in enumerate(qs):
            found = index.within(codes[i], radius)
            found = found[ids[found] != q_ids[i]]
            d = distances(v[found], q)
            best = vectors.best_of(d, ids[found], k)
            rows.append(np.full(len(best), i))
            places.append(found[best])
            scores.append(d[best])
        return np.concatenate(rows), np.concatenate(places), np.concatenate(scores)

    return build, find


def nearest(df: DataFrame, k: int = 10, every: int = 100, id_column: str = "vec_id",
            column: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors found for every row whose id is divisible
    by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score`` (Euclidean
    distance)."""
    rows = cut(vectors.one_each(vectors.clean(df, id_column, column, zero=False)))
    n, wide = rows.count(), 1 << 30
    limit = min(wide, wide * SAMPLE // max(n, 1))
    some = rows.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(wide)) < F.lit(limit))
    ids, v = vectors.arrays(some.toArrow())
    queries = rows.where(F.pmod("id", F.lit(every)) == 0)
    if len(ids) < 2:  # too few to learn from: every code counts
        size = len(rows.first()["v"]) if n else 1
        coder, radius = Coder(np.zeros(size), np.eye(size)[:, :BITS]), BITS
    else:
        coder = learn(v)
        radius = learn_radius(coder, ids, v, k)
    found = cut(vectors.by_blocks(queries, rows, k, "double", *_search(coder, radius, k)))
    others = n - 1
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    few = (queries.select(F.col("id").alias("query_id")).join(counts, "query_id", "left")
           .where(F.coalesce("n", F.lit(0)) < F.lit(min(k, others))).select("query_id"))
    if radius >= BITS or few.isEmpty():
        return found
    again = queries.join(few, queries["id"] == few["query_id"], "left_semi")
    return found.join(few, "query_id", "left_anti").unionByName(
        vectors.by_blocks(again, rows, k, "double", *_search(coder, BITS, k)))
