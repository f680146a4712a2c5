"""Session helpers.

Everything in the package takes a ``SparkSession`` from the caller; these
helpers only fill in settings that are unset, so a cluster's own
configuration (shuffle partitions, checkpoint folder, ...) always wins.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. Applied only where the session leaves them unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plotline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Keep planner broadcasts to sides that are small by nature (nation,
        # taxonomy, class lists). At the default 10 MB a two-column lineitem
        # projection of the small test tables qualifies, a side that grows
        # with the data.
        .config("spark.sql.autoBroadcastJoinThreshold", str(2 * 1024 * 1024))
        # AQE merges small shuffle partitions down to 1 MB each by default,
        # which leaves local cores idle on CPU-heavy stages of small inputs
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", str(256 * 1024))
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is read as is;
    unset, it is an error there. Only a local session (one JVM) gets a private
    temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if current and not path:
        return current
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="plotline-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - a core setting may be read-only at run time
            pass
    if not current:
        sc.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A new path of this name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/plotline-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back:
    what is read several times is worked out once."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
