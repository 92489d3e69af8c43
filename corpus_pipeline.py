"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as
the next one's documents; all but the last return the columns of
``documents``.

1. language ID: texts without a letter, and those of which under
   ``MIN_LANGUAGE`` of the n-grams belong to the language found, go;
2. quality: documents that score under ``quality.THRESHOLD`` go;
3. SimHash near-duplicates: of each component one row stays, the one with
   the smallest ``doc_id`` (rows without one last) and then text hash;
4. mixing: each document is taken as often as its rate says, which is more
   than once only where scarce domains have to be repeated;
5. SentencePiece: ids and their number are added, as ``ids`` and
   ``n_tokens`` (in place of columns that have these names), and the ids are
   decoded again: how many texts come back byte for byte is observed.

Rows are told apart by ``doc_id`` and text: rows without a ``doc_id`` are
deduplicated and drawn like any other, and different texts under one
``doc_id`` are different documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.llm import language, mixing, quality, queries, simhash, spm_codec
from tessera.llm.common import ROW_KEY, crc_mod, row_key, ship, table
from tessera.session import scratch_path

#: Share of a text's n-grams that its language must contain.
MIN_LANGUAGE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = language.predict(docs, language.fit(docs.where(crc_mod("doc_id", 5) != 0)))
    keep = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE)
    return found.where(keep).select("row.*")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 4) != 2))
    return quality.scores(docs, model).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    one = simhash.survivors(docs).select(*row_key(F.col("text_hash")))
    # repeated rows are one before the join, so no key of it is hot
    rows = docs.select("*", *row_key(F.xxhash64("text"))).dropDuplicates(ROW_KEY)
    return rows.join(one, ROW_KEY, "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rates, _ = mixing.mix(docs, queries.labelled(spark, sf_dir), queries.TARGETS)
    taken = (rates.withColumn("__n", mixing.copies(F.col("rate"), F.coalesce("doc_id", "text_hash")))
             .select(*row_key(F.col("text_hash")), "__n").groupBy(*ROW_KEY).agg(F.max("__n").alias("__n")).where("__n > 0"))
    kept = docs.select("*", *row_key(F.xxhash64("text"))).join(taken, ROW_KEY)
    return kept.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__n"))).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str, seen: Observation | None = None) -> DataFrame:
    """``seen`` has, after the rows are written: documents (``n_docs``), their
    ids (``n_ids``), and texts that the ids decode to unchanged (``n_same``)."""
    ship(spark)
    coded = spm_codec.encode(docs, queries.tokenizer(queries.PIECES))
    same = F.col("decoded") == F.coalesce(F.col("row").getField("text").cast("string"), F.lit(""))
    coded = coded.observe(seen or "sentencepiece", F.count(F.lit(1)).alias("n_docs"),
                          F.sum(F.size("ids").cast("long")).alias("n_ids"), F.count(F.when(same, 1)).alias("n_same"))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("ids", "n_tokens")]
    return coded.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is
    written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
