"""Gapless places of rows inside their groups, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import shared_table


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality of all ``columns``."""
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(right[c])
    return on


def ranked(
    df: DataFrame, key: list[str], order: list[str], name: str, place: str = "_pos", about: DataFrame | None = None
) -> DataFrame:
    """``df`` plus ``place``: the 0-based rank of each row among the rows of its
    ``key`` by ``order`` (nulls first; rows equal in both take any of their ranks),
    and the other columns of ``about``, a table with one row for each key.

    No window over a group: rows are dealt by ranges of (key, order), so that a
    large group spreads over many tasks, and written in order with their number;
    the ranks of a range follow from the counts of the ranges before it. ``df``
    is a table that has been written (its rows are numbered as they are read)."""
    by = [F.col(c).asc_nulls_first() for c in [*key, *order, "_tie"]]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    # the id counts the sorted rows of a range: range number in the high bits
    rows = shared_table(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    runs = rows.groupBy(part.alias("_part"), *key).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).drop("_rows", "_first")
    more = [c for c in about.columns if c not in key] if about is not None else []
    if more:  # joined to the few rows of the ranges, not to the rows of a large group
        starts = starts.join(about, same(starts, about, key)).select(*[starts[c] for c in starts.columns], *more)
    rows = rows.withColumn("_part", part)
    out = rows.join(starts, same(rows, starts, ["_part", *key]))
    return out.select(*[rows[c] for c in df.columns], (rows["_at"] + starts["_start"]).alias(place), *[starts[c] for c in more])
