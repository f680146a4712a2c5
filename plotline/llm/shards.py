"""Proportional stratified interleaving: shards that all match the mixture.

Rows of each source are put in a seeded random order. Row r of the n rows of
its source gets the fractional rank (2r - 1) / 2n; sorted by it, every run of
rows holds each source in proportion. The sorted rows are cut into shards of
equal counts.

Both numberings are two-level: rows are bucketed by their sort key (a hash,
then the fractional rank, both evenly spread whatever the source sizes),
counts per bucket give each bucket's first number, and rows are only numbered
inside a bucket. No window spans a source or the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import shared_table

#: Buckets of a source's hash order and of the global order.
BUCKETS = 4096


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """60 hash bits of the id (a null id hashes like an empty one)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def starts(counts: DataFrame, within: list[str], bucket: str) -> DataFrame:
    """First number of each bucket, and the total, inside ``within``."""
    w = Window.partitionBy(*(within or [F.lit(0)]))
    before = w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *within, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(w).alias("total")
    )


def interleave(rows: DataFrame, shards: int = 24, seed: int = 8) -> DataFrame:
    """``rows`` (doc_id, source and compact other columns) with ``shard``
    (0 to shards - 1, counts at most one apart) and ``slot`` (gapless from 0
    inside a shard). A null source is a source of its own. Rows that repeat an
    id are numbered one by one; rows equal in all columns are interchangeable."""
    others = sorted(c for c in rows.columns if c not in ("doc_id", "source"))
    keyed = rows.select(
        *rows.columns,
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"),
        shuffle_key(F.col("doc_id"), seed).alias("_key"),
    ).withColumn("_bucket", F.shiftright("_key", 48))
    keyed = shared_table(keyed, "shuffled")
    firsts = starts(keyed.groupBy("_source", "_bucket").agg(F.count("*").alias("n")), ["_source"], "_bucket")
    own = Window.partitionBy("_source", "_bucket").orderBy("_key", "doc_id", *others)
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(own))
        .join(firsts, ["_source", "_bucket"])
        .withColumn("_share", (2 * (F.col("start") + F.col("_rank")) - 1) / (2 * F.col("total")))
        .withColumn("_bucket", F.floor(F.col("_share") * BUCKETS))
        .drop("start", "total")
    )
    ranked = shared_table(ranked, "ranked")
    firsts = starts(ranked.groupBy("_bucket").agg(F.count("*").alias("n")), [], "_bucket")
    whole = Window.partitionBy("_bucket").orderBy("_share", "_source", "_rank")
    at = F.col("start") + F.col("_at") - 1
    return (
        ranked.withColumn("_at", F.row_number().over(whole))
        .join(firsts, "_bucket")
        .withColumn("_at", at)
        .withColumn("shard", F.expr(f"cast((_at * {shards}) div total as int)"))
        .withColumn("slot", F.expr(f"_at - (shard * total + {shards - 1}) div {shards}"))
        .select(*rows.columns, "shard", "slot")
    )


def compact(text: Column) -> tuple[Column, Column]:
    """Size in UTF-8 bytes plus 8, and crc32 (null texts count as empty)."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    return (F.octet_length(data) + 8).cast("long"), F.crc32(data)


def digest(docs: DataFrame) -> DataFrame:
    """The columns that sharding carries: id, source, size, crc32 of the text."""
    size, crc = compact(F.col("text"))
    return docs.select("doc_id", "source", size.alias("size"), crc.alias("text_crc32"))


def sharded(docs: DataFrame, shards: int = 24, seed: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    return interleave(digest(docs), shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_shards(docs: DataFrame, shards: int = 24, seed: int = 8) -> DataFrame:
    """``docs`` (doc_id, source, text, any others) with shard and slot, which
    replace columns of these names. The rows are numbered in compact form; the
    numbers of rows that repeat an id and a text go to these rows in any
    order."""
    keys = ["_pl_id", "_pl_size", "_pl_crc", "_pl_nth"]
    same = Window.partitionBy(*keys[:3])
    key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    names = {"size": keys[1], "text_crc32": keys[2]}
    numbers = interleave(digest(docs), shards, seed).withColumnsRenamed(names).withColumn("_pl_id", key)
    numbers = numbers.withColumn("_pl_nth", F.row_number().over(same.orderBy("shard", "slot"))).select(*keys, "shard", "slot")
    rows = docs.drop("shard", "slot")
    kept = rows.columns
    size, crc = compact(F.col("text"))
    rows = rows.withColumns({"_pl_id": key, "_pl_size": size, "_pl_crc": crc})
    rows = rows.withColumn("_pl_nth", F.row_number().over(same.orderBy("_pl_id")))
    return rows.join(numbers, keys).select(*kept, "shard", "slot")
