"""Language identification by language-bitmask n-gram filters.

Training gathers, for every language, the character n-grams that occur in
at least ``MIN_SHARE`` of its training documents.  They are put into one
bit-sliced Bloom filter: a row for each hash slot, a bit in it for each
language.  The AND of an n-gram's rows has the bit of every language that
contains it, so one lookup answers for all languages.

A text's n-grams are looked up and the bits counted by language.  A filter
of which the share ``f`` of rows has a language's bit says yes to a foreign
n-gram with probability ``f ** HASHES``; a count ``x`` of ``n`` is corrected
to ``(x - n p) / (1 - p)``.  The language with the largest corrected count
wins (ties: the first by name); the score is that count over ``n``.

N-grams are taken over the letters, in lower case, with every run of other
characters as one blank, over whole texts.  The training rows are a sample
by hash of about ``SAMPLE`` documents a language (all, where there are
fewer): the only bound, and the same at every size of the table.

Defined results: NULL text, empty text and text without a letter are
``und`` with score 0; a text that shares no n-gram with any language gets
the first language by name with score 0; without training rows every text
is ``und``.  Repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import packed

SIZES = (2, 3, 4)
HASHES = 3
#: Filter rows for each n-gram kept.
ROWS_PER_GRAM = 8
#: Training documents a language, about; n-grams kept of a language, at most.
SAMPLE = 2000
KEPT = 50_000
MIN_SHARE = 0.01
UNKNOWN = "und"
#: Characters worked on at a time; a longer text is taken in pieces that overlap.
CHARS = 1 << 18

_LOWER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point of the basic plane: its lower case, 0 if it is
    no letter."""
    if not _LOWER:
        codes = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(1 << 16)]
        _LOWER.append(np.array([ord(c.lower()[0]) if c.isalpha() else 0 for c in codes], np.uint32))
    return _LOWER[0]


def letter_runs(text: str) -> np.ndarray:
    """Lower-case letters as code points, every run of other characters as
    one 0; a 0 at both ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    low = _letters()[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        other, place = np.unique(codes[beyond], return_inverse=True)
        low[beyond] = np.array([c if chr(c).isalpha() else 0 for c in other.tolist()], np.uint32)[place]
    low = np.concatenate([[0], low, [0]]).astype(np.uint32)
    return low[np.concatenate([[True], (low[1:] != 0) | (low[:-1] != 0)])]


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the windows of ``n`` code points."""
    h = np.full(max(len(codes) - n + 1, 0), n, np.uint64)
    for i in range(n):
        h = (h ^ codes[i:i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of a text's n-grams, in pieces of bounded size."""
    overlap = max(SIZES) - 1
    for start in range(0, max(len(text), 1), CHARS):
        # the pieces' ends are blanks of their own: a handful of n-grams of each piece of a very long text
        codes = letter_runs(text[start:start + CHARS + (overlap if start + CHARS < len(text) else 0)])
        if len(codes) > 1:
            for n in SIZES:
                yield gram_hashes(codes, n)


class Filter(NamedTuple):
    """Languages by bit, and the bit-sliced filter (rows x words)."""

    languages: list[str]
    rows: np.ndarray

    @staticmethod
    def slots(hashes: np.ndarray, size: int) -> list[np.ndarray]:
        """The rows of n-grams; ``size`` is a power of two."""
        low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
        return [((low + np.uint64(i) * high) & np.uint64(size - 1)).astype(np.int64) for i in range(HASHES)]

    @classmethod
    def build(cls, found: list[tuple[str, np.ndarray]]) -> Filter:
        """From each language's n-grams, ordered by name."""
        total = len(np.unique(np.concatenate([h for _, h in found]))) if found else 0
        size = 1 << max(10, int(np.ceil(np.log2(max(total, 1) * ROWS_PER_GRAM))))
        rows = np.zeros((size, -(-len(found) // 64) or 1), np.uint64)
        for i, (_, hashes) in enumerate(found):
            for slot in cls.slots(hashes, size):
                np.bitwise_or.at(rows[:, i // 64], slot, np.uint64(1 << i % 64))
        return cls([name for name, _ in found], rows)

    def false_positives(self) -> np.ndarray:
        fill = [((self.rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
                for i in range(len(self.languages))]
        return np.array(fill) ** HASHES

    def counts(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each run of n-grams from ``starts``: those that each language
        contains."""
        slots = self.slots(hashes, len(self.rows))
        out = np.zeros((len(starts), len(self.languages)), np.int64)
        for w in range(self.rows.shape[1]):
            column = self.rows[:, w]
            masks = column[slots[0]]
            for slot in slots[1:]:
                masks &= column[slot]
            for i in range(w * 64, min(len(self.languages), w * 64 + 64)):
                bits = ((masks >> np.uint64(i % 64)) & np.uint64(1)).astype(np.uint8)
                out[:, i] = np.add.reduceat(bits, starts, dtype=np.int64)
        return out


def decide(counts: np.ndarray, n: np.ndarray, false: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The language and the score from raw counts."""
    n = np.maximum(n, 1)[:, None]
    share = np.clip((counts - n * false) / np.maximum(1 - false, 1e-9) / n, 0, 1)
    best = share.argmax(axis=1)
    return best, share[np.arange(len(share)), best]


def _hash_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of documents by language and n-gram, within a task's batch."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(langs, batch.column(1).to_pylist()):
            if parts := list(grams(text)):
                by_lang.setdefault(lang, []).append(np.unique(np.concatenate(parts)))
        for lang, parts in by_lang.items():
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(h), pa.string()),
                                              "h": pa.array(h.view(np.int64)), "n": pa.array(n.astype(np.int64))})


def fit(train: DataFrame, sample: int = SAMPLE) -> Filter:
    """Learn the filter from ``train`` (doc_id, text, lang).

    Two jobs: documents by language (one row a language), then the n-grams
    of the sample.  What reaches the driver is bounded by ``KEPT`` n-grams
    a language.
    """
    train = train.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    size = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not size:
        return Filter([], np.zeros((1024, 1), np.uint64))
    wide = 1 << 30
    limit = F.coalesce(*[F.when(F.col("lang") == F.lit(name), F.lit(min(wide, wide * sample // n)))
                         for name, n in size.items()])
    some = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(wide)) < limit).select("lang", "text")
    counted = (some.mapInArrow(_hash_docs, "lang string, h long, n long")
               .groupBy("lang", "h").agg(F.sum("n").alias("n")))
    floor = F.coalesce(*[F.when(F.col("lang") == F.lit(name), F.lit(MIN_SHARE * min(n, sample)))
                         for name, n in size.items()])
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "h")
    kept = (counted.where(F.col("n") >= floor).withColumn("r", F.row_number().over(order))
            .where(F.col("r") <= KEPT).select("lang", "h").toPandas())
    return Filter.build([(name, kept.loc[kept["lang"] == name, "h"].to_numpy().view(np.uint64))
                         for name in sorted(size)])


def _predictor(filter: Filter, text: int):
    names = np.array([*filter.languages, UNKNOWN], dtype=object)
    false = filter.false_positives()

    def results(waiting: list[np.ndarray], owner: list[int], counts: np.ndarray, n: np.ndarray) -> None:
        sizes = np.array([len(h) for h in waiting])
        got = filter.counts(np.concatenate(waiting), np.cumsum(sizes) - sizes)
        np.add.at(counts, owner, got)
        np.add.at(n, owner, sizes)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field(text).to_pylist()
            counts = np.zeros((len(texts), len(filter.languages)), np.int64)
            n = np.zeros(len(texts), np.int64)
            waiting, owner, held = [], [], 0
            for i, t in enumerate(texts):
                for h in grams(t or ""):
                    if len(h):
                        waiting.append(h)
                        owner.append(i)
                        held += len(h)
                if held >= CHARS:
                    results(waiting, owner, counts, n)
                    waiting, owner, held = [], [], 0
            if waiting:
                results(waiting, owner, counts, n)
            if filter.languages:
                best, score = decide(counts, n, false)
            else:
                best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            best, score = np.where(n > 0, best, len(filter.languages)), np.where(n > 0, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score, pa.float64())],
                names=["row", "lang_pred", "score"])

    return predict


def predict(df: DataFrame, filter: Filter, text: str = "text") -> DataFrame:
    """The columns of ``df`` in a struct ``row``, ``lang_pred`` and
    ``score``.  No shuffle."""
    rows, place = packed(df, text)
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return rows.mapInArrow(_predictor(filter, place), schema)
