"""Exact top-k inner products by no-random-access aggregation.

Every component is a list of the candidates sorted by that component, read
sequentially: from the top for queries whose weight is positive, from the
bottom for negative ones.  At some depth, a candidate's score is the sum of
what was read of it, plus between the lowest (the list's last entry) and the
highest (the entry at the depth) of what was not.  A candidate whose upper
bound is below the k-th largest lower bound cannot qualify and is dropped.
Once a query has no more candidates than are asked for, its reading stops;
others read on to the next depth.  What is left of a query is then resolved:
the rest of its own candidates' entries is read from the lists and added to
what was read before.

A task does this for a block of candidates, whose lists are sorted once, and
a batch of queries at a time; sums and bounds of a batch at a depth are
matrix products over the entries read (``DEPTHS`` are the shares of the
lists at which the bounds are looked at).

Components are ``floor(scale * x)``.  Sums are taken in the smallest type
that holds every one of them exactly, Python's integers beyond doubles;
scores beyond a long are clipped to its range, and rank as such.

Defined results: vectors that are NULL, hold NULL or non-finite components,
have a NULL id or another length than most take no part (zero vectors do);
of rows with the same id one counts, and none is its own candidate; fewer
than ``k`` candidates are all returned; an empty table gives an empty
result.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .common import cut

#: Shares of the lists read between two looks at the bounds.
DEPTHS = (0.125, 0.5, 0.75, 0.9)
LONG = np.iinfo(np.int64)


def exact_type(q: np.ndarray, v: np.ndarray):
    """The smallest type in which inner products of ``q`` and ``v`` and
    their partial sums are exact."""
    if q.dtype == object or v.dtype == object:
        return object
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(q.shape[1], 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    return q @ v.T


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: doubles, or Python's integers where doubles do
    not hold all sums of products."""
    with np.errstate(over="ignore"):
        z = np.floor(scale * x)
    if exact_type(z, z) is not object:
        return z
    return np.array([[int(Fraction(v) * scale // 1) for v in row] for row in x.tolist()], object).reshape(x.shape)


class Lists:
    """The sorted lists of a block of candidates, read to a depth."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        self.ids, self.v, self.n = ids, v, len(v)
        order = np.argsort(v, axis=0, kind="stable")
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(self.n)[:, None].repeat(v.shape[1], axis=1), axis=0)
        self.sorted = np.take_along_axis(v, order, axis=0)

    def astype(self, kind) -> Lists:
        """The same lists in another type of numbers."""
        if self.v.dtype == kind:
            return self
        other = object.__new__(Lists)
        other.ids, other.n, other.rank = self.ids, self.n, self.rank
        other.v, other.sorted = converted(self.v, kind), converted(self.sorted, kind)
        return other

    def read(self, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of all queries and
        candidates when ``depth`` entries of each list have been read: sums
        of what was read and of the lowest and highest that the rest can be;
        ``up`` and ``down`` are the queries' positive and negative weights."""
        top, bottom = self.rank >= self.n - depth, self.rank < depth
        last, first = self.sorted[-1], self.sorted[0]
        at_top, at_bottom = self.sorted[self.n - depth], self.sorted[depth - 1]
        low = product(up, np.where(top, self.v, first)) + product(down, np.where(bottom, self.v, last))
        high = product(up, np.where(top, self.v, at_top)) + product(down, np.where(bottom, self.v, at_bottom))
        return low, high

    def rest(self, q: np.ndarray, places: np.ndarray, low: np.ndarray, depth: int) -> np.ndarray:
        """Scores of some candidates with one query, from their lower bounds
        at ``depth``: the rest of their entries is read, each in place of the
        lowest that it could be."""
        rank, v = self.rank[places], self.v[places]
        unread = np.where(q > 0, rank < self.n - depth, rank >= depth)
        lowest = np.where(q > 0, self.sorted[0], self.sorted[-1])
        return low + product(np.where(unread, v - lowest, 0), q[None, :])[:, 0]


def converted(x: np.ndarray, kind) -> np.ndarray:
    if kind is object and x.dtype != object:
        return np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)
    return x.astype(kind)


def clipped(x: np.ndarray) -> np.ndarray:
    """Integers clipped to the range of a long."""
    return np.array([[min(max(int(v), LONG.min), LONG.max) for v in row] for row in x.tolist()], object).reshape(x.shape)


def top(lists: Lists, q_ids: np.ndarray, q: np.ndarray, k: int):
    """Rows of queries and candidates and the scores of each query's best
    ``k`` of a block (whose ids ascend)."""
    kind = exact_type(q, lists.v)
    q, lists, ids = converted(q, kind), lists.astype(kind), lists.ids
    n = lists.n
    alive = q_ids[:, None] != ids[None, :]
    up, down = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
    lowest = product(up, lists.sorted[:1]) + product(down, lists.sorted[-1:])
    least = np.broadcast_to(lowest, alive.shape).copy()  # lower bounds at the depth read
    read = np.zeros(len(q), int)
    open_ = np.arange(len(q))
    for depth in sorted({int(share * n) for share in DEPTHS} - {0}):
        if not len(open_):
            break
        low, high = lists.read(up[open_], down[open_], depth)
        least[open_], read[open_] = low, depth
        if kind is object:  # scores are compared as they are returned
            low, high = clipped(low), clipped(high)
        here = alive[open_]
        for i in range(len(open_)):
            bounds = low[i][here[i]]
            if len(bounds) > k:
                kth = sorted(bounds)[-k] if kind is object else np.partition(bounds, len(bounds) - k)[-k]
                here[i] &= (high[i] >= kth).astype(bool)
        alive[open_] = here
        open_ = open_[here.sum(axis=1) > k]
    rows, places, scores = [], [], []
    for i in range(len(q)):
        mine = np.flatnonzero(alive[i])
        s = lists.rest(q[i], mine, least[i, mine], read[i])
        if kind is object:
            s = clipped(s[:, None])[:, 0]
            best = np.array(sorted(range(len(s)), key=lambda j: (-s[j], ids[mine[j]]))[:k], int)
        else:
            best = vectors.best_of(-s, ids[mine], k)
        rows.append(np.full(len(best), i))
        places.append(mine[best])
        scores.append(s[best].astype(np.int64))
    return np.concatenate(rows), np.concatenate(places), np.concatenate(scores)


def search(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_column: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """The ``k`` largest integer inner products for every row whose id is
    divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    rows = cut(vectors.one_each(vectors.clean(df, id_column, column)))

    def build(ids, v):
        return Lists(ids, integers(v, scale))

    def find(lists, q_ids, q):
        return top(lists, q_ids, integers(q, scale), k)

    return vectors.by_blocks(rows.where(F.pmod("id", F.lit(every)) == 0), rows, k, "long", build, find)
