"""Column expressions: JVM-side building blocks used by the operators.

All of these return ``Column`` objects built from ``pyspark.sql.functions``
so they stay inside whole-stage code generation; none calls Python per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas as S


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def idiv(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (SQL ``div``); exact for
    long and decimal(38,0) operands.  Use on non-negative values."""
    return F.call_function("div", a, b)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body
    uses it (a lambda variable, which the optimizer does not inline)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- parsing -----------------------------------------------------------------

def clean_numeric(col: Column | str, keep_exponent: bool = False) -> Column:
    """Strip everything but digits, ``.`` and ``-`` and parse as double.

    Unparseable leftovers (``""``, ``"-"``, ``"9.5-4"`` from an exponent)
    become NULL instead of failing the query (``try_cast``).  With
    ``keep_exponent`` the characters ``e``, ``E`` and ``+`` are kept too,
    so ``9.5E-4`` parses to the number.
    """
    pattern = S.NUMERIC_KEEP_PATTERN_EXP if keep_exponent else S.NUMERIC_KEEP_PATTERN
    return F.regexp_replace(_c(col), pattern, "").try_cast(T.DoubleType())


def nan_to_null(col: Column | str) -> Column:
    """NaN -> NULL, so that ordering and comparisons never see NaN."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def py_strip(col: Column | str) -> Column:
    """Leading and trailing whitespace removed (all of it, not only blanks)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def epoch_micros(col: Column | str, data_type: T.DataType | None = None) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ.

    For a zone-less timestamp the wall clock is read as UTC, independent
    of the session time zone.
    """
    c = _c(col)
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_micros(c)


# -- arrays ------------------------------------------------------------------

def finite_array(col: Column | str, check_inf: bool = True) -> Column:
    """True when the array holds no NULL, no NaN and (optionally) no +-Inf."""
    inf = float("inf")

    def bad(v: Column) -> Column:
        cond = v.isNull() | F.isnan(v)
        if check_inf:
            cond = cond | (F.abs(v) == F.lit(inf))
        return cond

    return ~F.exists(_c(col), bad)


def reshape(col: Column | str, width: int) -> Column:
    """Flat row-major array -> array of rows of ``width`` elements."""
    c = _c(col)
    rows = F.sequence(F.lit(0), (F.size(c) / width).cast("int") - 1)
    return F.transform(rows, lambda i: F.slice(c, i * width + 1, width))


def flatten_rows(col: Column | str) -> Column:
    """Array of rows -> flat row-major array."""
    return F.flatten(_c(col))


# -- scores ------------------------------------------------------------------

def log_sum_exp(logits: Column | str) -> Column:
    c = _c(logits)
    m = F.array_max(c)
    return m + F.log(F.aggregate(c, F.lit(0.0), lambda acc, v: acc + F.exp(v - m)))


def softmax(logits: Column | str) -> Column:
    c = _c(logits)
    lse = log_sum_exp(c)
    return F.transform(c, lambda v: F.exp(v - lse))


def argmax(values: Column | str) -> Column:
    """0-based position of the largest value; the first one wins ties."""
    c = _c(values)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def max_probability(logits: Column | str) -> Column:
    c = _c(logits)
    return F.exp(F.array_max(c) - log_sum_exp(c))


def cross_entropy(logits: Column | str, target: Column | str) -> Column:
    """-log softmax(logits)[target], target 0-based."""
    c = _c(logits)
    return log_sum_exp(c) - F.element_at(c, _c(target) + 1)


def round6(col: Column | str) -> Column:
    """Round half up to 6 places as ``floor(x * 1e6 + 0.5) / 1e6`` in
    IEEE doubles (the same arithmetic any SQL engine does, unlike the
    decimal rounding of ``round``); NaN and +-Inf pass through."""
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(
        F.floor(c * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6))
