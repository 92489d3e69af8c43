"""Shards of bounded size by extendible hashing.

A row's key is hashed; a bucket is a prefix of the hash's bits.  Starting
from one bucket for everything, only buckets over the byte limit are split
on another bit, until every one fits.  The directory is therefore a trie
whose leaves are the shards: a row's shard is the shortest prefix of its
hash whose bucket fits.

Sizes of all prefixes come from one aggregation by a fine prefix (``SPARE``
bits more than equal shards would need), summed up the trie; buckets that
are still too large at that depth go into a further round over their rows
alone.  The hash has 60 bits of the key, then 60 bits of the whole row, so
a key shared by any number of rows is split too.  Rows that are equal in
everything are interchangeable and are dealt out by number.  A single row
over the limit is a shard of its own.

Nothing is gathered on the driver but the total size and the number of
buckets to go on with; the directory is a table and rows meet it by an
equality join.

Defined results: NULL text counts 0 bytes, a NULL key is a key; an empty
table has no shard.  Further columns of the input are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Bits of each of the two hash words, and bits beyond an even split in one round.
WORD = 60
SPARE = 3
LIMIT = 1 << 20

PLACED = ["id", "shard", "depth", "shard_bytes", "shard_rows"]


def hash60(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def bits(word: Column, depth: Column) -> Column:
    """The first ``depth`` bits of a hash word as a string."""
    return F.substring(F.lpad(F.bin(word), WORD, "0"), F.lit(1), depth)


def hashed(df: DataFrame, key: str, id_column: str, text: str) -> DataFrame:
    """``id``, the two hash words and the bytes of every row."""
    whole = F.to_json(F.struct(F.col(f"`{id_column}`").alias("i"), F.md5(F.col(f"`{text}`").cast("binary")).alias("t")))
    return df.select(F.col(f"`{id_column}`").alias("id"),
                     hash60(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("-"))).alias("h1"),
                     hash60(whole).alias("h2"),
                     F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("long").alias("bytes"))


def _prefix(depth: int) -> list[Column]:
    """Columns that name a row's bucket at ``depth``."""
    if depth <= WORD:
        return [F.shiftright("h1", WORD - depth).alias("p1"), F.lit(0).cast("long").alias("p2")]
    return [F.col("h1").alias("p1"), F.shiftright("h2", 2 * WORD - depth).alias("p2")]


def _round(rows: DataFrame, start: int, stop: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Split buckets from ``start`` to ``stop`` bits.  Returns the leaves by
    fine bucket, and the fine buckets that are still over the limit."""
    fine = cut(rows.select(*_prefix(stop), "bytes").groupBy("p1", "p2")
               .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")))
    word = "p1" if stop <= WORD else "p2"
    up = (fine.select("p1", "p2", "bytes", "rows", F.explode(F.sequence(F.lit(start), F.lit(stop))).alias("depth"))
          .withColumn("q", F.expr(f"shiftright({word}, {stop} - depth)")))
    at = ["depth", "q"] + (["p1"] if word == "p2" else [])
    sizes = (up.groupBy(*at).agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
             .where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)))
    leaves = (up.join(sizes, at).groupBy("p1", "p2")
              .agg(F.min(F.struct("depth", "shard_bytes", "shard_rows")).alias("leaf")).select("p1", "p2", "leaf.*"))
    leaves = cut(leaves)
    return leaves, fine.join(leaves, ["p1", "p2"], "left_anti")


def place(df: DataFrame, limit: int = LIMIT, key: str = "doc_id", id_column: str = "doc_id",
          text: str = "text") -> DataFrame:
    """The shard of every row: ``id``, ``shard`` (the bits of its prefix,
    and a number for parts of equal rows), ``depth``, and the bytes and
    rows of the shard."""
    rows = cut(hashed(df, key, id_column, text))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    step = max(1, min(WORD, math.ceil(math.log2(max(total / limit, 1))) + SPARE))
    placed, start = [], 0
    left = rows
    while start < 2 * WORD:
        stop = min(start + step, WORD if start < WORD else 2 * WORD)
        leaves, over = _round(left, start, stop, limit)
        now = left.select("*", *_prefix(stop))
        depth = F.col("depth")
        name = F.concat(bits(F.col("h1"), F.least(depth, F.lit(WORD))),
                        bits(F.col("h2"), F.greatest(depth - WORD, F.lit(0))))
        placed.append(now.join(leaves, ["p1", "p2"]).select("id", name.alias("shard"), *PLACED[2:]))
        over = cut(over.select("p1", "p2", "bytes", "rows"))
        if over.isEmpty():
            return reduce(DataFrame.unionByName, placed)
        left = cut(now.join(over.select("p1", "p2"), ["p1", "p2"], "left_semi").drop("p1", "p2"))
        start = stop
    # equal rows: as many in a part as fit, dealt out by number
    alike = left.groupBy("h1", "h2", "id").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("b"))
    fit = F.greatest(F.floor(F.lit(limit) / F.greatest(F.col("b"), F.lit(1))), F.lit(1))
    each = alike.select("h1", "h2", "id", "n", "b", fit.alias("fit"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    part = F.floor(F.col("i") / F.col("fit"))
    size = F.least(F.col("fit"), F.col("n") - part * F.col("fit"))
    name = F.concat(bits(F.col("h1"), F.lit(WORD)), bits(F.col("h2"), F.lit(WORD)), F.lit("-"), part.cast("string"))
    placed.append(each.select("id", name.alias("shard"), F.lit(2 * WORD).alias("depth"),
                              (size * F.col("b")).cast("long").alias("shard_bytes"), size.cast("long").alias("shard_rows")))
    return reduce(DataFrame.unionByName, placed)


def write(df: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id", text: str = "text") -> None:
    """Write rows as one Parquet folder for each shard, ``shard=s<prefix>``
    (in place of a column ``shard``).  Rows are numbered for it, so that
    repeated and NULL ids, and rows equal in everything, are rows of their
    own: each is written once, and every shard with more than one row is
    within the limit.  (A shard is one file: its rows meet in one task.)"""
    rows = cut(df.drop("shard").withColumn("__n", F.monotonically_increasing_id()))
    shards = place(rows, limit, id_column, "__n", text).select(F.col("id").alias("__n"), "shard")
    (rows.join(shards, "__n").drop("__n").withColumn("shard", F.concat(F.lit("s"), "shard")).repartition("shard")
     .write.partitionBy("shard").parquet(path))


def place_sql(limit: int = LIMIT) -> str:
    """DuckDB SQL for ``place`` over ``documents`` by ``doc_id``, for rows
    with different ids: the size of every prefix of every hash, and for
    each row the shortest that fits."""
    return f"""
WITH rows AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-')), 1, 15))::BIGINT AS h
  FROM documents),
prefixes AS (SELECT doc_id, bytes, h, d.depth, h >> ({WORD} - d.depth) AS p
             FROM rows, (SELECT unnest(range(0, {WORD + 1}))::INTEGER AS depth) d),
sizes AS (SELECT depth, p, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM prefixes GROUP BY ALL
          HAVING sum(bytes) <= {limit} OR count(*) = 1),
leaves AS (SELECT doc_id, h, depth, shard_bytes, shard_rows,
                  row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS r
           FROM prefixes JOIN sizes USING (depth, p))
SELECT doc_id, substr(lpad(bin(h), {WORD}, '0'), 1, depth) AS shard, depth, shard_bytes, shard_rows
FROM leaves WHERE r = 1
"""
