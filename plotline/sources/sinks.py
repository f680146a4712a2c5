"""Sinks K1-K3, K5, K6. Writes are directories of part files (no single
shard). The one global JSON document (K4) is not built: it would pass every
record through one value; JSON lines hold the same records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotline.sources import readers as R

def write_csv(df: DataFrame, path: str, mode: str = "overwrite", quote_all: bool = True) -> None:
    """K1 / K2: header, quoted fields, standard ``"`` escaping (Q18), null apart
    from empty: ``read_csv_by_name`` gives back the frame. Nested columns are
    written as JSON text."""
    cols = []
    for c, t in df.dtypes:
        cell = F.to_json(F.col(f"`{c}`")) if t.startswith(("struct", "array", "map")) else F.col(f"`{c}`")
        cols.append((R.escaped_cell(cell) if t == "string" else cell).alias(c))
    options = {**R.CSV_CELLS, "emptyValue": "" if quote_all else '""'}
    df.select(*cols).write.mode(mode).option("header", True).option("quoteAll", quote_all).options(**options).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> None:
    """K3: JSON lines, non-ASCII kept."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def metrics_log_lines(long: DataFrame, metrics=("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """K5: ``fold, metric, value`` (fold ``avg`` for the means) -> ordered log
    lines: ``Fold n Metrics:`` then ``metric: 0.1234`` per metric and a blank
    line per fold, then ``Average Metrics Across All Folds:`` and the means.
    Returns ``block, pos, line``; write with ``orderBy("block", "pos")``."""
    order = F.create_map(*[x for i, m in enumerate(metrics) for x in (F.lit(m), F.lit(i + 1))])
    is_avg = F.col("fold") == "avg"
    line = F.struct(
        F.coalesce(F.try_element_at(order, F.col("metric")), F.lit(len(metrics) + 1)).alias("pos"),
        F.format_string("%s: %.4f", F.col("metric"), F.col("value")).alias("line"),
    )
    # one row per fold (a handful of metric lines each), then lines in order
    g = long.groupBy("fold").agg(F.array_sort(F.collect_list(line)).alias("ls"))
    block = F.when(is_avg, F.lit(1 << 30)).otherwise(F.col("fold").cast("int"))
    head = F.struct(
        F.lit(0).alias("pos"),
        F.when(is_avg, F.lit("Average Metrics Across All Folds:"))
        .otherwise(F.format_string("Fold %s Metrics:", F.col("fold")))
        .alias("line"),
    )
    blank = F.struct(F.lit(1 << 20).alias("pos"), F.lit("").alias("line"))
    lines = F.concat(F.array(head), F.col("ls"), F.when(is_avg, F.array().cast("array<struct<pos:int,line:string>>")).otherwise(F.array(blank)))
    return g.select(block.alias("block"), F.inline(lines))


def append_batch(df: DataFrame, path: str) -> None:
    """K6: append one finished batch (keyed by id) to the results table."""
    df.write.mode("append").parquet(path)
