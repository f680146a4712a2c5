"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotline.session import checkpoint_dir

#: White space of the word rules: space and U+0009 to U+000D.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/plotline-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str, parts: int, rest: int) -> Column:
    """True where crc32 of the id's text leaves ``rest`` modulo ``parts``.
    A null id is never held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(parts) == F.lit(rest), F.lit(False))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that for pure ASCII text; other
    text goes through ``translate``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def bounded_labels(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """Rows whose key hash falls in the share that keeps about ``bound`` of
    them: all rows while there are at most ``bound``. One counting job, no
    sort and no shuffle; the same rows whatever the partitioning."""
    n = rows.count()
    if n <= bound:
        return rows
    buckets = 1 << 30
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(buckets)) < F.lit(int(buckets * bound / n)))
