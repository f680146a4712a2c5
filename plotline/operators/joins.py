"""Join and partition helpers.

Broadcasts are left to Spark, which decides by bytes: the planner's threshold
on known sizes, and adaptive execution on the measured size of a shuffled
side. So no side is hinted, nothing is counted at plan time, and a table that
has grown since the last query is planned anew.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` tasks (default: the
    cluster's parallelism) when it is read in fewer splits than that, for
    CPU-heavy per-row work (regex over texts, model calls) on small inputs.

    Counts the splits of the plan, without running it; an input of as many
    splits or more, and any frame that has been shuffled (adaptive execution
    sizes its tasks), is returned as is."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if re.search(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()):  # a broadcast moves no rows of ``df``
        return df
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
