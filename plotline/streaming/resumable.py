"""Resumable model runs as a Structured Streaming query.

The reference rewrites a progress file after every row and restarts from a
row index. Here the inputs are a folder of Parquet files read as a stream, and each
micro-batch runs the caller's model over Arrow batches and keeps the answers. The
streaming checkpoint records which input files are done, so a restarted query
continues where it stopped. With ``availableNow`` the query processes what is there
and stops. Two layouts of the results:

* flat: answers are appended; the first micro-batch of a run drops ids that have a
  result (anti-join against the whole table), which makes a batch that was cut
  short and run again add no duplicates.
* ``by_epoch``: answers go to the batch's own partition ``run=<checkpoint>/
  epoch=<batch>``, which a repeated batch replaces. The first batch of a run looks
  for finished ids only in its own partition and in those of other checkpoints:
  answers of this checkpoint's earlier batches belong to other input files and are
  not read. Appends cost nothing that grows with the answers so far.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plotline.operators import infer as IN
from plotline.session import checkpoint_dir
from plotline.sources.readers import read_results


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint's answers: kept beside its offsets, so that a
    checkpoint that was removed and begun anew has another."""
    path = f"{checkpoint.rstrip('/')}/plotline-run"
    kept = read_results(spark, path)
    if kept is None:
        spark.createDataFrame([(uuid.uuid4().hex,)], "run string").coalesce(1).write.mode("overwrite").parquet(path)
        kept = spark.read.parquet(path)
    return "r" + kept.first()["run"]


def run_resumable(
    spark: SparkSession,
    source: str,
    schema: StructType,
    results: str,
    model: Callable[[list[str]], list[str]] | None,
    id_col: str,
    input_col: str,
    output_col: str = "output",
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    batch_size: int = 16,
    load: Callable[[], Callable[[list[str]], list[str]]] | None = None,
    errors: bool = False,
    by_epoch: bool = False,
) -> None:
    """Run ``model`` over every row of the Parquet files in ``source`` that
    has no row in ``results`` yet; append answers to ``results``. Ids are
    unique in ``source``. ``max_files_per_trigger`` bounds a micro-batch
    (default: all files present). ``load`` and ``errors`` as in
    ``infer.apply_model``; rows with an error are no answers: a run under another
    checkpoint asks them again. ``by_epoch``: see the module."""
    # one checkpoint per (source, results), whatever their last path parts
    name = hashlib.sha256(f"{source}\n{results}".encode()).hexdigest()[:32]
    checkpoint = checkpoint or os.path.join(checkpoint_dir(spark), "resumable", name)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    first = [True]
    run = run_of(spark, checkpoint) if by_epoch else None

    def finished(epoch: int) -> DataFrame | None:
        # only a batch cut short by the end of an earlier run can have answers of
        # its own, and such a batch is the first of this run
        done = read_results(spark, results) if first else None
        first.clear()
        if done is not None and by_epoch:  # prunes the partitions of earlier batches
            done = done.where((F.col("run") != run) | (F.col("epoch") == epoch))
        return done

    def batch(df: DataFrame, epoch: int) -> None:
        done = finished(epoch)
        answered = done
        if done is not None and "error" in done.columns:
            answered = done.where(F.col("error").isNull())
        out = IN.apply_model(IN.pending(df, answered, id_col), model, id_col, input_col, output_col, batch_size, load, errors)
        if not by_epoch:
            out.write.mode("append").parquet(results)
            return
        if answered is not None:
            # answers of the attempt that was cut short stay, written anew with the rest
            checkpoint_dir(spark)
            out = answered.where(F.col("run") == run).select(*out.columns).checkpoint().unionByName(out)
        out = out.withColumns({"run": F.lit(run), "epoch": F.lit(epoch)})
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "epoch").parquet(results)

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
