"""Code and label lookups.

The activity table is fixed and small (18 entries), so lookups against it
are map literals and CASE chains evaluated inside the projection: no join,
no shuffle, no broadcast.  Data-derived dimension tables (label indexes)
are joined normally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import schemas as S
from tessera.functions.columns import py_strip
from tessera.operators.order import global_rank


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _code_map() -> Column:
    return F.create_map(*[F.lit(x) for pair in S.ACTIVITY_NAMES for x in pair])


def _name_map() -> Column:
    return F.create_map(*[F.lit(x) for code, name in S.ACTIVITY_NAMES for x in (name, code)])


def trim_code(code) -> Column:
    return py_strip(_c(code))


def code_to_name(code) -> Column:
    """Activity name of a code, ``Unknown (<code>)`` when absent."""
    c = _c(code)
    return F.coalesce(F.try_element_at(_code_map(), c), F.concat(F.lit("Unknown ("), c, F.lit(")")))


def name_to_code(name) -> Column:
    return F.try_element_at(_name_map(), _c(name))


def resolve_class(name, index) -> Column:
    """Class name -> activity code: the name itself when it is a code, else
    the code of an exactly equal activity name, else the first code (table
    order) whose name contains the class name or is contained in it, else
    ``Class-<index>``."""
    n = _c(name)
    codes = [code for code, _ in S.ACTIVITY_NAMES]
    contains = None
    for code, act in reversed(S.ACTIVITY_NAMES):
        hit = F.contains(n, F.lit(act)) | F.contains(F.lit(act), n)
        contains = F.when(hit, F.lit(code)) if contains is None else F.when(hit, F.lit(code)).otherwise(contains)
    return F.coalesce(F.when(n.isin(*codes), n), name_to_code(n), contains,
                      F.concat(F.lit("Class-"), _c(index).cast("string")))


def label_index(df: DataFrame, label: str = "label", index: str = "idx") -> DataFrame:
    """Distinct labels in ascending order -> 0..k-1 (one index for the
    whole label table, joined everywhere)."""
    d = df.select(label).where(F.col(label).isNotNull()).distinct()
    return global_rank(d, [F.col(label)], index)


def class_table(index: DataFrame, label: str = "label", idx: str = "idx") -> DataFrame:
    """Label index -> (idx, class_name, letter, activity_name)."""
    letter = resolve_class(F.col(label).cast("string"), F.col(idx))
    return index.select(F.col(idx), F.col(label).cast("string").alias("class_name"), letter.alias("letter")) \
        .withColumn("activity_name", F.coalesce(F.try_element_at(_code_map(), F.col("letter")), F.col("class_name")))


def predicted_labels(pred: DataFrame, classes: DataFrame, pred_col: str = "y_pred") -> DataFrame:
    """Predicted index -> letter and display name; an index outside the
    class table gives ``?`` and ``Unknown``."""
    c = classes.select(F.col("idx").alias(pred_col), F.col("letter").alias("pred_letter"),
                       F.col("activity_name").alias("pred_name"))
    j = pred.join(c, pred_col, "left")
    return (j.withColumn("pred_letter", F.coalesce("pred_letter", F.lit("?")))
             .withColumn("pred_name", F.coalesce("pred_name", F.lit("Unknown"))))
