"""The registered queries of this subpackage: each applies one operator with
its production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotline.llm.common import held_out, read
from plotline.llm.context_mixing import language_model_scores
from plotline.llm.decontaminate import decontaminated
from plotline.llm.language import languages
from plotline.llm.merkle import manifest
from plotline.llm.mixing import mixed
from plotline.llm.near_dup import near_duplicates
from plotline.llm.pages import main_texts
from plotline.llm.quality import quality_scores
from plotline.llm.rules import quality_rules
from plotline.llm.shards import sharded
from plotline.llm.token_counts import token_counts
from plotline.llm.toxicity import toxicity_scores
from plotline.llm.trie import conversation_trie
from plotline.operators.joins import spread

Query = Callable[[SparkSession, str], DataFrame]


def texts(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table whose texts are worked on row by row: a small one of fewer splits
    than cores is dealt over the cores."""
    return spread(read(spark, sf_dir, table))


def op1_token_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(texts(spark, sf_dir))


def op2_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(texts(spark, sf_dir), read(spark, sf_dir, "labels"))


def op3_nearest_url_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(texts(spark, sf_dir, "pages"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminated(texts(spark, sf_dir), read(spark, sf_dir, "benchmark"))


def op5_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(texts(spark, sf_dir))


def op6_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def op7_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(texts(spark, sf_dir), read(spark, sf_dir, "labels"))


def op8_proportional_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(read(spark, sf_dir, "documents"))


def op9_word_first_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(texts(spark, sf_dir))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(texts(spark, sf_dir))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return conversation_trie(read(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests and proofs of every document; every seventh id (by checksum)
    is checked with ``n_chars`` one higher."""
    seventh = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    return manifest(read(spark, sf_dir, "documents"), seventh)


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's and the unigram baseline's log probability of every document."""
    return language_model_scores(texts(spark, sf_dir), held_out("doc_id", 7, 2))


QUERIES: dict[str, Query] = {
    "op1_token_length_histogram": op1_token_length_histogram,
    "op2_counterfactual_toxicity": op2_counterfactual_toxicity,
    "op3_nearest_url_text": op3_nearest_url_text,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_divergence_rules": op5_divergence_rules,
    "op6_pareto_mixing": op6_pareto_mixing,
    "op7_bradley_terry_quality": op7_bradley_terry_quality,
    "op8_proportional_sharding": op8_proportional_sharding,
    "op9_word_first_language": op9_word_first_language,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_context_mixing": op13_context_mixing,
}
