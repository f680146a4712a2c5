"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words; a document's expected number of copies
is target / source size. Its whole part is allocated for certain. For the
rest p in (0, 1), documents are ranked by (u / (1 - u)) / (p / (1 - p)), random odds
over inclusion odds, and the lowest ranked are taken until the source's
remaining words are reached (a sample fixed in words, off by half a document
at most). u is a hash of the id, so reruns agree.

Only sums per source and per bucket of the rank are shuffled. The cut of a
source falls inside one bucket; only that bucket's keys (rank, id, size) are
sorted, and the cut then decides every row on its own. Where it falls among
rows of one key, as many of them as fit are taken, in order of their texts'
hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import WORD, shared_table

#: Source weights by code point order of the names, repeating.
WEIGHTS = (5, 2, 1)
#: A source's words are taken at most this many times.
MOST_COPIES = 3
BUCKETS = 4096
#: Up to this many sources the plan (a row each) is broadcast.
BROADCAST_SOURCES = 50_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``sizes`` (source, size) with ``target``: all sizes shared by weight,
    stopping at ``most`` times a size, the excess shared again by weight until
    no target is above its stop. Sources ordered by stop / weight are stopped
    in that order, so running sums give the final share per unit of weight.
    The windows span the list of sources (a row each)."""
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*[F.lit(w) for w in weights])
    rows = sizes.withColumn("weight", F.get(pick, (F.row_number().over(by_name) - 1) % len(weights)).cast("long"))
    rows = rows.withColumn("stop", F.col("size") * most)
    every = Window.partitionBy(F.lit(0))
    by_stop = every.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("left_words", F.sum("size").over(every) - F.coalesce(F.sum("stop").over(before), F.lit(0)))
    rows = rows.withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    exact = "decimal(19,0)"
    open_ = F.col("stop").cast(exact) * F.col("left_weight").cast(exact) >= F.col("weight").cast(exact) * F.col("left_words").cast(exact)
    # sources before the first open row are stopped; that row holds the final share
    rows = rows.withColumn("at", F.row_number().over(by_stop))
    share = F.struct("at", (F.col("left_words") / F.col("left_weight")).alias("unit"))
    return rows.withColumn("unit", F.min(F.when(open_, share)).over(every)["unit"]).select(
        "source", "size", F.least(F.col("stop").cast("double"), F.col("weight") * F.col("unit")).alias("target")
    )


def uniform(doc_id: Column, seed: int) -> Column:
    """In (0, 1), from 52 hash bits of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def rank(u: Column, p: Column) -> Column:
    return (u / (1 - u)) / (p / (1 - p))


def name_key(source: Column) -> Column:
    """A source name that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def with_plan(rows: DataFrame, plan: DataFrame, key: str = "_source") -> DataFrame:
    small = plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(plan) if small else plan, key)


def mixing_plan(docs: DataFrame, seed: int) -> DataFrame:
    """One row per source: size, target, certain copies, and the cut (rank,
    doc_id, size) up to which one more copy is taken, with ``take``, the number
    of rows taken at the cut itself, if not all."""
    rows = docs.select(
        "doc_id", "source", name_key(F.col("source")).alias("_source"), words(F.col("text")).alias("size"),
        uniform(F.col("doc_id"), seed).alias("u"),
    )
    rows = shared_table(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    goal = targets(sizes).withColumn("copies", F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0))
    goal = goal.select(
        name_key(F.col("source")).alias("_source"), F.col("size").alias("source_size"), "target",
        F.floor("copies").alias("whole"), (F.col("copies") - F.floor("copies")).alias("p"),
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = shared_table(goal, "targets")
    part = with_plan(rows, goal.where("p > 0").select("_source", "p", "rest"))
    part = part.withColumn("rank", rank(F.col("u"), F.col("p")))
    part = part.withColumn("bucket", F.least(F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS), F.lit(BUCKETS - 1)))
    ends = part.groupBy("_source", "bucket").agg(F.sum("size").alias("n"), F.first("rest").alias("rest"))
    ends = ends.withColumn("end", F.sum("n").over(Window.partitionBy("_source").orderBy("bucket")))
    crossed = ends.where("end - n < rest and rest <= end").select(
        "_source", "bucket", (F.col("end") - F.col("n")).alias("before")
    )
    crossed = shared_table(crossed, "crossed")
    cuts = (
        part.join(crossed.withColumnRenamed("bucket", "at"), "_source")
        .where("bucket <= at")
        .withColumn("inside", F.col("bucket") == F.col("at"))
    )
    key = ["rank", "doc_id", "size"]
    order = Window.partitionBy("_source").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    inside = cuts.where("inside").groupBy("_source", *key).agg(
        F.count("*").alias("n"), F.first("before").alias("before"), F.first("rest").alias("rest")
    )
    inside = inside.withColumn("before", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(order), F.lit(0)))
    inside = inside.withColumn("fit", rows_that_fit(*map(F.col, ("before", "size", "n", "rest"))))
    cut = F.struct("rank", F.col("doc_id").alias("id"), "size")
    taken = inside.where("fit > 0").groupBy("_source").agg(
        F.max(F.struct(cut.alias("cut"), F.when(F.col("fit") < F.col("n"), F.col("fit")).alias("take"))).alias("at")
    )
    # a bucket whose first row is already past the middle leaves the cut at the last row before it
    earlier = cuts.where("not inside").groupBy("_source").agg(F.max(cut).alias("last"))
    return (
        goal.join(taken, "_source", "left").join(earlier, "_source", "left")
        .withColumn("cut", F.coalesce("at.cut", "last")).withColumn("take", F.col("at.take")).drop("at", "last", "rest")
    )


def rows_that_fit(before: Column, size: Column, n: Column, rest: Column) -> Column:
    """How many of ``n`` rows of one size have their middle before ``rest``."""
    def fits(k: Column) -> Column:
        return before + k * size - size / 2 < rest

    k = F.when(size > 0, F.floor((rest - before) / size + F.lit(0.5)).cast("long")).otherwise(n)
    k = F.greatest(F.lit(0), F.least(n, k))
    up = F.when((k < n) & fits(k + 1), k + 1).otherwise(k)
    return F.when((up > 0) & ~fits(up), F.when(size > 0, up - 1).otherwise(0)).otherwise(up)


def last_taken(tied: DataFrame) -> DataFrame:
    """_pl_source, _pl_to_hash, _pl_to_at: place of the row numbered ``_pl_take`` of each
    source in order of text hash. Found level by level (hash prefix, hash,
    part of the table, row), so no task sorts all rows of a source."""
    left = tied.select(
        "_pl_source", F.col("_pl_take").alias("need"), "_pl_hash", "_pl_at",
        F.shiftright("_pl_hash", 52).alias("prefix"), F.shiftright("_pl_at", 33).alias("part"),
    )
    for level in ("prefix", "_pl_hash", "part", "_pl_at"):
        counts = left.groupBy("_pl_source", level).agg(F.count("*").alias("n"), F.first("need").alias("need"))
        counts = counts.withColumn("end", F.sum("n").over(Window.partitionBy("_pl_source").orderBy(level)))
        here = counts.where("end - n < need and need <= end").select("_pl_source", level, (F.col("need") - F.col("end") + F.col("n")).alias("need"))
        left = shared_table(left.drop("need").join(here, ["_pl_source", level]), "tied")
    return left.select("_pl_source", F.col("_pl_hash").alias("_pl_to_hash"), F.col("_pl_at").alias("_pl_to_at"))


def mixed(docs: DataFrame, seed: int = 6) -> DataFrame:
    """``docs`` (doc_id, source, text, any others) with _size, _source_size,
    _target and _copies (how often the mix takes the row), which replace
    columns of these names. Null texts and texts without words have size 0.
    A null source is a source of its own, last in order. Rows that repeat a
    doc_id share its random number, but are taken one by one."""
    plan = shared_table(mixing_plan(docs, seed), "plan").select(
        F.col("_source").alias("_pl_source"),
        *[F.col(c).alias(f"_pl_{c}") for c in ("source_size", "target", "whole", "p", "cut", "take")],
    )
    out = ["_size", "_source_size", "_target", "_copies"]
    rows = docs.drop(*out)
    kept = rows.columns
    rows = rows.withColumn("_pl_source", name_key(F.col("source"))).withColumn("_size", words(F.col("text")))
    p, cut = F.col("_pl_p"), F.col("_pl_cut")
    q = F.struct(
        rank(uniform(F.col("doc_id"), seed), p).alias("rank"), F.col("doc_id").alias("id"), F.col("_size").alias("size")
    )
    more = F.when((p > 0) & cut.isNotNull(), q <= cut).otherwise(F.lit(False))
    rows = with_plan(rows, plan, "_pl_source").withColumnsRenamed({"_pl_source_size": "_source_size", "_pl_target": "_target"})

    def out_rows(rows: DataFrame, more: Column) -> DataFrame:
        return rows.withColumn("_copies", F.col("_pl_whole") + more.cast("long")).select(*kept, *out)

    if plan.where("_pl_take is not null").isEmpty():
        return out_rows(rows, more)
    at_cut = F.coalesce((p > 0) & F.col("_pl_take").isNotNull() & (q == cut), F.lit(False))
    tied = rows.where(at_cut).withColumn("_pl_hash", F.xxhash64("text")).withColumn("_pl_at", F.monotonically_increasing_id())
    tied = shared_table(tied.drop("_pl_cut"), "at_cut")
    first = F.struct("_pl_hash", "_pl_at") <= F.struct("_pl_to_hash", "_pl_to_at")
    return out_rows(rows.where(~at_cut), more).union(out_rows(with_plan(tied, shared_table(last_taken(tied), "last_taken"), "_pl_source"), first))
