"""Annotation decoding: label lines -> flat / nested / merged records.

Input lines have ``article_id``, ``narrative`` and ``subnarrative`` (``;``-
lists of labels); any further columns (content, language, ...) are carried.
All work is per row with native expressions: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotline.functions import labels as L


def decode(lines: DataFrame, domain_from: str = "subnarrative") -> DataFrame:
    """Arrays of narratives, subnarratives and narrative: subnarrative
    names plus the article domain, and a ``reject_reason`` (null when fine).

    ``domain_from`` picks the label list whose first label gives the domain:
    ``subnarrative`` as the CSV job, ``narrative`` as the JSON job.
    """
    nar_cell, sub_cell = F.col("narrative"), F.col("subnarrative")
    first = F.get(L.split_list(sub_cell if domain_from == "subnarrative" else nar_cell), 0)
    extra = [c for c in lines.columns if c not in ("narrative", "subnarrative")]
    # test and split every label once; the three decoded lists read the parts
    d = lines.select(
        *extra,
        L.map_labels(nar_cell, L.label_parts).alias("__n"),
        L.map_labels(sub_cell, L.label_parts).alias("__s"),
        L.domain_of(first).alias("domain"),
    )
    d = d.select(
        *extra,
        F.transform("__n", L.narrative_from_parts).alias("narratives"),
        F.transform("__s", L.subnarrative_from_parts).alias("subnarratives"),
        F.transform("__s", L.narrative_subnarrative_from_parts).alias("narratives_subnarratives"),
        "domain",
    )
    reason = (
        F.when(F.col("narratives").isNull() | F.col("subnarratives").isNull(), F.lit("missing label cell"))
        .when(F.exists("narratives", lambda x: x.isNull()), F.lit("domain label without narrative part"))
        .when(F.exists("subnarratives", lambda x: x.isNull()), F.lit("domain label without subnarrative part"))
    )
    return d.withColumn("reject_reason", reason)


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a ``decode`` result (Q2: no job failure)."""
    good = decoded.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = decoded.where(F.col("reject_reason").isNotNull())
    return good, bad


def flat_records(decoded: DataFrame) -> DataFrame:
    """The 6-column record ``article_id, content, narrative, subnarrative,
    narrative_subnarrative, domain`` (lists joined by ``;``)."""
    content = F.col("content") if "content" in decoded.columns else F.lit(None).cast("string")
    return decoded.select(
        "article_id",
        content.alias("content"),
        F.array_join("narratives", L.LABEL_SEP).alias("narrative"),
        F.array_join("subnarratives", L.LABEL_SEP).alias("subnarrative"),
        F.array_join("narratives_subnarratives", L.LABEL_SEP).alias("narrative_subnarrative"),
        "domain",
    )


def nested_records(decoded: DataFrame, keep=()) -> DataFrame:
    """``article_id, content, domain, labels{narrative[], subnarrative[]}``
    (plus the ``keep`` columns, e.g. for partitioned writes)."""
    content = F.col("content") if "content" in decoded.columns else F.lit(None).cast("string")
    return decoded.select(
        "article_id",
        content.alias("content"),
        "domain",
        F.struct(F.col("narratives").alias("narrative"), F.col("subnarratives").alias("subnarrative")).alias(
            "labels"
        ),
        *keep,
    )


def merge_records(nested: DataFrame, codes=L.LANGUAGE_CODES) -> DataFrame:
    """Add combined ``label`` list and ``language`` to nested records."""
    return nested.withColumn(
        "label", L.combined_labels(F.col("labels.narrative"), F.col("labels.subnarrative"))
    ).withColumn("language", L.language_of("article_id", codes))


def to_json_records(df: DataFrame) -> DataFrame:
    """P10: one JSON text per record (non-ASCII kept)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def with_title_body(df: DataFrame, col: str = "content") -> DataFrame:
    """Title (first line) and body (third line on)."""
    return df.withColumn("title", L.title_of(col)).withColumn("body", L.body_of(col))


def with_class(df: DataFrame, domain: str = "domain", out: str = "class_id") -> DataFrame:
    """Domain -> class id."""
    return df.withColumn(out, L.domain_class(domain))
