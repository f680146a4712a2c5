"""From raw documents to shards of a training mixture.

Each stage is one operator of ``plotline.llm``; it takes (spark, docs,
sf_dir) and returns documents, which are written as Parquet and read back as
the next stage's ``docs``. The last returns every row of the mix with its
shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotline.llm.common import read, shared_table
from plotline.llm.decontaminate import without_contaminated
from plotline.llm.mixing import mixed
from plotline.llm.near_dup import one_of_each
from plotline.llm.quality import without_rejects
from plotline.llm.shards import with_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking rejects go."""
    return without_rejects(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make a twentieth or more go."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target mixture takes it."""
    taken = mixed(docs).where("_copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")
    return taken.select(*docs.columns, copies).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """24 shards of the same mixture, counts at most one apart."""
    return with_shards(docs)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("target_mixing", mix),
    ("sharding", shard),
]

#: The first stage fits a classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
