"""Quality scores by regularised quadratic discriminant analysis.

Every document becomes a vector of transformed statistics of its whole
text (``FEATURES``).  For each class the labelled documents give a mean and
a covariance that is shrunk twice: towards the covariance pooled over the
classes, and towards its own diagonal.  The Cholesky factor of each is
computed once and cached in the model, so a document's log-density under a
class is one triangular solve (the squared Mahalanobis distance) and the
cached log-determinant.  The difference of the two log-densities, passed
through a logistic curve fitted to the labels, is the score.

The model is fitted on a sample by hash of about ``SAMPLE`` labelled
documents (all, where there are fewer): the only bound.  Statistics are
computed for every document, and labels, language, source and id are never
among them.

Defined results: NULL text is the empty text, which has a score like any
other (all statistics 0).  A document with several labels counts once for
each.  If a class has no labelled document, every score is the share of
label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import packed, utf8

SAMPLE = 20_000
#: Shrinkage towards the pooled covariance and towards the diagonal; floor of a variance.
POOLED, DIAGONAL, FLOOR = 0.05, 0.10, 1e-4
THRESHOLD = 0.7
#: Weight of the prior of the curve: keeps it finite where the sample is separable.
PRIOR = 1.0

FEATURES = ["word_length", "words_a_line", "upper", "digit", "mark", "end_mark", "high", "different_words",
            "same_neighbour", "different_lines", "marked_words", "short_words", "different_pairs"]

#: Pseudo-counts (words, lines, letters) that keep the shares of very short texts near the usual ones.
WORDS, LINES, LETTERS = 20, 4, 40
#: Mean letters of a word and words of a line that the pseudo-counts stand for.
USUAL_WORD, USUAL_LINE = 6.0, 20.0

#: Character classes of a byte.
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _b = bytes([_c])
    _CLASS[_c] = (1 if _b.isupper() else 2 if _b.islower() else 3 if _b.isdigit() else 4 if _b.isspace()
                  else 5 if _b in (b".", b",") else 7 if _c >= 128 else 6)
_LETTERS = frozenset(range(65, 91)) | frozenset(range(97, 123)) | frozenset(range(128, 256))


def _share(part: float, whole: float, pseudo: float) -> float:
    """A share on a scale that spreads small values."""
    return float(np.sqrt(part / (whole + pseudo)))


def features(data: bytes) -> list[float]:
    """The transformed statistics of one text."""
    if not data:
        return [0.0] * len(FEATURES)
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=by_byte, minlength=8)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x]
    n = len(words)
    visible = len(data) - kinds[4]
    letters = kinds[1] + kinds[2] + kinds[7]
    lengths = sum(map(len, words))
    ends = [w[-1] for w in words]
    marked = sum(e not in _LETTERS and e not in b".,0123456789" for e in ends)
    # the number of different words grows as a power of the number of words: compare logarithms
    pairs = len(set(zip(words, words[1:])))
    return [
        float(np.log((lengths + WORDS * USUAL_WORD) / (n + WORDS))),
        float(np.log((n + LINES * USUAL_LINE) / (len(lines) + LINES))),
        _share(kinds[1], letters, LETTERS),
        _share(kinds[3], visible, LETTERS),
        _share(kinds[6], visible, LETTERS),
        _share(kinds[5], n, WORDS),
        _share(kinds[7], visible, LETTERS),
        float(np.log(len(set(words)) + WORDS) / np.log(n + WORDS)),
        _share(sum(map(eq, words, words[1:])), n, WORDS),
        _share(len(lines) - len(set(lines)), len(lines), LINES),
        _share(marked, n, WORDS),
        _share(sum(len(w) == 1 for w in words), n, WORDS),
        float(np.log(pairs + WORDS) / np.log(n + WORDS)),
    ]


class Model(NamedTuple):
    """Class means, cached factors of their covariances, and the curve."""

    means: np.ndarray       # class x feature
    factors: np.ndarray     # class x feature x feature, lower triangular
    log_dets: np.ndarray    # class
    curve: tuple[float, float]

    def log_density(self, x: np.ndarray, k: int) -> np.ndarray:
        """Up to a constant: minus half the squared Mahalanobis distance and
        the log-determinant."""
        solved = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
        return -0.5 * (solved ** 2).sum(axis=0) - 0.5 * self.log_dets[k]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-density difference, compressed so that far outliers do not
        rule the curve."""
        d = self.log_density(x, 1) - self.log_density(x, 0)
        return np.sign(d) * np.log1p(np.abs(d))

    def score(self, x: np.ndarray) -> np.ndarray:
        a, b = self.curve
        if not len(self.means):
            return np.full(len(x), 1 / (1 + np.exp(-b)))
        return 1 / (1 + np.exp(-np.clip(a * self.margin(x) + b, -700, 700)))


def fit_model(x: np.ndarray, y: np.ndarray) -> Model:
    """Means, shrunk covariances and the logistic curve."""
    share = y.mean() if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        prior = np.clip(share, 1e-6, 1 - 1e-6)
        return Model(np.zeros((0, 0)), np.zeros((0, 0, 0)), np.zeros(0), (0.0, float(np.log(prior / (1 - prior)))))
    groups = [x[y == k] for k in (0, 1)]
    means = np.array([g.mean(axis=0) for g in groups])
    own = [np.cov(g, rowvar=False, bias=True) if len(g) > 1 else np.zeros((x.shape[1],) * 2) for g in groups]
    pooled = sum(len(g) * s for g, s in zip(groups, own)) / len(x)
    factors, dets = [], []
    for s in own:
        s = (1 - POOLED) * s + POOLED * pooled
        s = (1 - DIAGONAL) * s + DIAGONAL * np.diag(np.diag(s)) + FLOOR * np.eye(len(s))
        factors.append(np.linalg.cholesky(s))
        dets.append(2 * np.log(np.diag(factors[-1])).sum())
    model = Model(means, np.array(factors), np.array(dets), (1.0, 0.0))
    # logistic regression of the label on the margin (Newton, with a weak prior that keeps it finite)
    m, w = model.margin(x), np.array([1.0, 0.0])
    design = np.column_stack([m, np.ones(len(m))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -700, 700)))
        grad = design.T @ (y - p) - PRIOR * w
        hess = design.T @ (design * (p * (1 - p))[:, None]) + PRIOR * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return model._replace(curve=(float(w[0]), float(w[1])))


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _matrix(utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "hash", "quality")), *(pa.array(c) for c in rows.T)],
                                         names=["doc_id", "hash", "quality", *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality): a
    sample by hash of about ``sample`` labelled ids.  An id counts once, with
    its smaller label and the text of the smallest hash, which bounds what is
    broadcast (ids) and collected (statistics) however often ids repeat."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    labels = labels.groupBy("doc_id").agg(F.min(F.col("quality").cast("double")).alias("quality"))
    n, wide = labels.count(), 1 << 30
    limit = min(wide, wide * sample // max(n, 1))
    some = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(wide)) < F.lit(limit))
    text = F.col("text").cast("string")
    texts = docs.select("doc_id", F.coalesce(F.xxhash64(text), F.lit(0)).alias("hash"), text.alias("text")).join(F.broadcast(some), "doc_id")
    schema = texts.select("doc_id", "hash", "quality").schema
    for f in FEATURES:
        schema = schema.add(f, DoubleType())
    columns = ["quality", *FEATURES]
    rows = (texts.select("doc_id", "hash", "quality", "text").mapInArrow(_measure, schema)
            .groupBy("doc_id").agg(F.min(F.struct("hash", *columns)).alias("r")).select(*[f"r.{c}" for c in columns]).toPandas())
    rows = rows.sort_values(columns)  # sums in one order: the same model on every run
    return fit_model(rows[FEATURES].to_numpy(float), rows["quality"].to_numpy(float))


def _scorer(model: Model, text: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(utf8(batch.column(0).field(text)))
            s = model.score(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["row", "score"])

    return score


def scores(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``df`` in a struct ``row``, and ``score``.  No
    shuffle."""
    rows, place = packed(df, text)
    return rows.mapInArrow(_scorer(model, place), StructType([rows.schema["row"], StructField("score", DoubleType())]))
