"""Registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

from . import ann, language, licenses, mixing, negatives, quality, repair, sharding, simhash, spm_codec, suffix_dedup, token_files, topk
from .common import crc_mod, ship, table

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"

#: Shares of tokens that a training mix aims at.
TARGETS = {"clean": 0.90, "low": 0.06, "toxic": 0.04}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def domain() -> Column:
    """The domain of a row of ``labels``."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
            .when(F.col("quality") == 1, "clean"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", domain().alias("domain"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate, tokens and domain posteriors of every document."""
    rates, domains = mixing.mix(_documents(spark, sf_dir), labelled(spark, sf_dir), TARGETS)
    return rates.select("doc_id", "tokens", *[F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(domains)],
                        "rate", mixing.copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice of every document."""
    return licenses.notices(_documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    scored = quality.scores(docs, quality.fit(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 4) != 2)))
    return scored.select("row.doc_id", F.coalesce(crc_mod("row.doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.place(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, digest of what they decode to, and
    digest of the byte span of every piece."""
    coded = spm_codec.encode(_documents(spark, sf_dir), tokenizer(PIECES))
    return coded.select(F.col("row.doc_id").alias("doc_id"),
                        (F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids_le", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                        F.sha2("spans_le", 256).alias("spans_sha256"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found for every hundredth vector."""
    ship(spark)
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, and its ids' checksum read from them."""
    docs = _documents(spark, sf_dir)
    files = token_files.write_token_files(docs, scratch_path(spark, "tokens"), tokenizer(WORDS))
    return token_files.read_documents(files)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned outside the held-out fold."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    learned = language.fit(docs.where(crc_mod("doc_id", 5) != 0))
    found = language.predict(docs.select("doc_id", "text"), learned)
    return found.select("row.doc_id", F.coalesce(crc_mod("row.doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest inner products for every fiftieth vector."""
    ship(spark)
    return topk.search(table(spark, sf_dir, "embeddings"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to passages of 400 bytes that start elsewhere too."""
    cut = suffix_dedup.remove(_documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    ship(spark)
    return repair.report(repair.edits(repair.damage(table(spark, sf_dir, "conversations"))))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector's label is moved on by one."""
    ship(spark)
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_license_scan, op3_quality, op4_sharding, op5_sentencepiece,
                                    op6_nearest, op7_simhash, op8_token_files, op9_language, op10_topk,
                                    op11_suffix_dedup, op12_conversation_repair, op13_hard_negatives)}


def topk_sql(k: int = 5, every: int = 50, scale: int = 256) -> str:
    """DuckDB SQL for ``op10_topk``: all inner products."""
    return f"""
WITH parts AS (SELECT vec_id, i, floor({scale} * embedding[i]::DOUBLE)::BIGINT AS x
               FROM embeddings, (SELECT unnest(range(1, 65)) AS i)),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
           FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id AND q.vec_id % {every} = 0
           GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""


def all_sql() -> dict[str, str]:
    """Queries that SQL expresses; the others are tested against
    brute-force versions."""
    return {"op4_sharding": sharding.place_sql(), "op10_topk": topk_sql(), "op13_hard_negatives": negatives.mine_sql()}
