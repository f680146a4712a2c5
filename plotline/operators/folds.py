"""Stratified k-fold assignment and fold statistics.

Rows are ordered within their class by ``md5(seed:id)`` (then id). The
global index of a row is the number of rows of smaller classes plus its
rank inside its class; ``fold = index mod k + 1``. So every fold has
``n / k`` rows (within one) and every class is spread evenly (within one).

No window spans a whole class: the rank is computed per *hash bucket*
(the first ``bucket_hex`` hex digits of the md5, which keep md5 order),
and the start index of each (class, bucket) comes from a running sum
over the small ``(class, bucket) -> count`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_key(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_folds(
    df: DataFrame,
    class_col: str,
    id_col: str,
    k: int = 5,
    seed: int = 42,
    bucket_hex: int = 4,
    out: str = "fold",
) -> DataFrame:
    """Add ``out`` in ``1..k``; ids must be unique. Rows without a class form a
    class of their own (the first)."""
    h = "__h"
    b = "__b"
    # a class inside a struct equals itself also when null, so that the join below has
    # plain keys, those of the window: whole rows are shuffled once
    c = "__k"
    d = df.withColumn(h, order_key(id_col, seed)).withColumn(
        b, F.conv(F.substring(F.col(h), 1, bucket_hex), 16, 10).cast("int")
    ).withColumn(c, F.struct(class_col))
    counts = d.groupBy(class_col, b).agg(F.count(F.lit(1)).alias("__n"))
    # start of each class: rows of smaller classes (one row per class)
    sizes = counts.groupBy(class_col).agg(F.sum("__n").alias("__cn"))
    class_start = sizes.select(
        class_col,
        (F.sum("__cn").over(Window.orderBy(class_col).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__cn"))
        .alias("__cs"),
    )
    # start of each bucket inside its class (at most 16**bucket_hex rows per class)
    bucket_start = counts.select(
        class_col,
        b,
        (
            F.sum("__n").over(
                Window.partitionBy(class_col).orderBy(b).rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("__n")
        ).alias("__bs"),
    )
    bucket_start = bucket_start.join(
        class_start.withColumnRenamed(class_col, "__c"), F.col(class_col).eqNullSafe(F.col("__c"))
    ).select(F.struct(class_col).alias(c), b, "__bs", "__cs")
    rank = F.row_number().over(Window.partitionBy(c, b).orderBy(h, id_col))
    d = d.withColumn("__r", rank).join(bucket_start, [c, b])
    idx = F.col("__cs") + F.col("__bs") + F.col("__r") - 1
    return d.withColumn(out, (F.pmod(idx, F.lit(k)) + 1).cast("int")).drop(h, b, c, "__r", "__cs", "__bs")


def fold_split(df: DataFrame, fold: int, col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(train, validation) for one fold."""
    return df.where(F.col(col) != fold), df.where(F.col(col) == fold)


def fold_value_counts(df: DataFrame, col: str, fold_col: str = "fold", pivot: bool = False) -> DataFrame:
    """Value counts of ``col`` in the validation part of each fold; with
    ``pivot`` one row per fold and one column per value."""
    if pivot:
        return df.groupBy(fold_col).pivot(col).agg(F.count(F.lit(1))).na.fill(0)
    return df.groupBy(fold_col, col).agg(F.count(F.lit(1)).alias("count"))
