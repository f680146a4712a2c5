"""Merkle manifest of a table: leaf digests, subroots per language, one root,
and for every row a proof that is climbed by a recursive query.

``H`` is the lowercase hex SHA-256 of its inputs concatenated (digests as hex
text). A leaf is ``H`` of the columns, each ``-`` if null, else its UTF-8 byte
count, ``:`` and its value. Leaves of one language ascend by id; every two
consecutive nodes become their ``H`` (a last one alone too) until one remains,
the subroot; the subroots, by language (null first, then bytewise), give the
root in the same way.

1. ``levels``: rounds of ``LEVELS`` levels. A round groups the nodes below one
   ancestor (at most ``2 ** LEVELS``) and stores the levels between as a row,
   which names the ancestor; the next round works on the ancestors.
2. ``links``: rows high in a tree would be read by very many leaves, so they are
   stored once for each run of ``RUN`` leaves: no key of the climb is shared by
   more of them.
3. ``CLIMB``: a recursive Spark query. Each leaf starts with its own (or tampered)
   digest, joins the stored levels it stands below, appends its siblings there
   as a row, folds them into its digest and goes on from the ancestor. A leaf's
   rows together are its proof.

Defined results: rows with equal id stand in the order of their leaf digests;
equal rows have equal leaves and share one proof digest each by their places; a
null id comes first and is never tampered with; a null and an empty language are
two languages; an empty table gives no rows. Texts of any length are hashed
whole, once. Further columns are not part of a leaf.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotline.llm.common import shared_table
from plotline.llm.order import ranked, same

#: Levels of the tree that one step of the climb goes up.
LEVELS = 9
#: Leaves (as a power of two) that share one stored copy of the levels above the
#: first step.
RUN_BITS = 12
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """H as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def cell(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, tamper: Column, columns=COLUMNS, group: str = "lang") -> DataFrame:
    """``doc_id, lang, leaf, bad``: the digest of every row, and where ``tamper``
    holds its digest with 1 added to ``n_chars`` (null elsewhere)."""
    more = {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    leaf = digest(*[cell(F.col(c)) for c in columns])
    bad = digest(*[cell(more.get(c, F.col(c))) for c in columns])
    return docs.select("doc_id", group, leaf.alias("leaf"), F.when(tamper, bad).alias("bad"))


def height(count: Column) -> Column:
    """Levels above ``count`` leaves until one node remains."""
    return F.when(count > 1, F.length(F.bin(count - 1))).otherwise(0)


def pairs(nodes: Column) -> Column:
    """The level above an array of digests."""
    at = lambda i: F.coalesce(as_hex(F.get(nodes, i)), F.lit(""))
    firsts = F.sequence(F.lit(0), F.size(nodes) - 1, F.lit(2))
    return F.transform(firsts, lambda i: digest(at(i), at(i + 1)))


def levels(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels of each round, and ``tree, hash`` of the top of every tree.

    ``nodes`` has ``tree, pos, hash, high`` (the height of its tree; 0 for a
    single node), ``most`` is the largest height. A round's rows: ``tree, up``
    (the ancestor's place on its level) and ``levels``, arrays of digests."""
    rounds: list[DataFrame] = []
    current, tops = nodes, None
    for done in range(0, most + LEVELS, LEVELS):
        top = current.where(F.col("high") <= done).select("tree", "hash")
        tops = top if tops is None else tops.unionByName(top)
        if done >= most:
            break
        # the nodes below one ancestor: at most 2 ** LEVELS
        below = current.where(F.col("high") > done).groupBy("tree", "high", F.shiftright("pos", LEVELS).alias("up")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"]).alias("nodes")
        )
        between = F.least(F.lit(LEVELS), F.col("high") - done)
        every = F.aggregate(
            F.array_repeat(F.lit(0), between - 1),
            F.array("nodes"),
            lambda acc, _: F.concat(acc, F.array(pairs(F.element_at(acc, -1)))),
        )
        built = below.select("tree", "high", "up", every.alias("levels"))
        built = built.withColumn("hash", F.get(pairs(F.element_at("levels", -1)), F.lit(0)))
        built = shared_table(built, f"merkle_level_{done}")
        rounds.append(built.select("tree", "up", "levels"))
        current = built.select("tree", F.col("up").alias("pos"), "hash", "high")
    return rounds, tops


def links(rounds: list[DataFrame], upper: list[DataFrame], trees: DataFrame) -> DataFrame:
    """``tree, step, spot, levels``: the levels that a leaf climbs in ``step``.
    Spot is the ancestor's place in step 0, later the run of leaves."""
    out = trees.sparkSession.createDataFrame([], "tree long, step int, spot long, levels array<array<binary>>")
    last = F.shiftright(F.col("size") - 1, RUN_BITS)
    for k, rows in enumerate(rounds):
        if k == 0:
            spots = rows.select("tree", F.col("up").alias("spot"), "levels")
        else:
            wide = LEVELS * (k + 1) - RUN_BITS
            runs = F.explode(F.sequence(F.shiftleft("up", wide), F.least(F.shiftleft(F.col("up") + 1, wide) - 1, last)))
            spots = rows.join(trees.select("tree", "size"), "tree").select("tree", runs.alias("spot"), "levels")
        out = out.unionByName(spots.withColumn("step", F.lit(k)))
    # above its own levels a tree goes on as one node of the tree of subroots
    runs = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("spot")
    for k, rows in enumerate(upper):
        here = trees.withColumn("up", F.shiftright("tree", LEVELS * (k + 1))).join(rows.select("up", "levels"), "up")
        out = out.unionByName(here.select("tree", (F.col("own") + k).alias("step"), runs, "levels"))
    return out


def climb_sql() -> str:
    """The recursive query; ``i`` is a node's place among those below its ancestor."""
    return f"""
WITH RECURSIVE climb AS (
  SELECT tree, pos, own, steps, 0 AS step, coalesce(bad, leaf) AS folded, CAST(NULL AS ARRAY<BINARY>) AS siblings, doc_id, leaf
  FROM {{start}}
  UNION ALL
  SELECT tree, pos, own, steps, step + 1,
    aggregate(sequence(0, size(siblings) - 1), folded, (x, k) -> unhex(sha2(lower(hex(
      CASE WHEN siblings[k] IS NULL THEN x
           WHEN shiftright(i, k) & 1 = 1 THEN concat(siblings[k], x) ELSE concat(x, siblings[k]) END)), 256))),
    siblings, CAST(NULL AS BIGINT), CAST(NULL AS BINARY)
  FROM (
    SELECT tree, pos, own, steps, step, folded, i, transform(levels, (x, k) -> get(x, shiftright(i, k) ^ 1)) AS siblings
    FROM (
      SELECT c.tree, c.pos, c.own, c.steps, c.step, c.folded, l.levels,
        CAST((CASE WHEN c.step < c.own THEN shiftright(c.pos, {LEVELS} * c.step)
                   ELSE shiftright(c.tree, {LEVELS} * (c.step - c.own)) END) & {(1 << LEVELS) - 1} AS INT) AS i
      FROM climb c JOIN {{links}} l ON l.tree = c.tree AND l.step = c.step
        AND l.spot = CASE WHEN c.step = 0 THEN shiftright(c.pos, {LEVELS}) ELSE shiftright(c.pos, {RUN_BITS}) END)))
SELECT * FROM climb
"""


CLIMB = climb_sql()


@contextmanager
def unlimited_recursion(spark: SparkSession):
    """Rows of a recursive query are not limited inside this block."""
    name = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def manifest(docs: DataFrame, tamper: Column, columns=COLUMNS, group: str = "lang") -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row of ``docs``; rows where ``tamper`` holds are checked with
    ``n_chars`` one higher. Levels and climb are written as tables on the way."""
    spark = docs.sparkSession
    base = shared_table(leaves(docs, tamper, columns, group), "merkle_leaves")
    sizes = shared_table(base.groupBy(group).agg(F.count(F.lit(1)).alias("size")), "merkle_sizes")
    high = height(F.col("size"))
    n, most = sizes.agg(F.count(F.lit(1)), F.max(high)).first()
    over = (n - 1).bit_length() if n > 1 else 0  # height of the tree of subroots
    trees = ranked(sizes, [], [group], "merkle_sorted_trees", "tree").withColumns(
        {"high": high, "own": F.ceil(high / F.lit(LEVELS)).cast("int")}
    )
    trees = shared_table(trees.withColumn("steps", F.col("own") + -(-over // LEVELS)), "merkle_trees")
    about = trees.select(group, "tree", "high", "own", "steps")
    start = shared_table(ranked(base, [group], ["doc_id", "leaf"], "merkle_sorted_leaves", "pos", about).drop(group), "merkle_start")

    rounds, tops = levels(start.select("tree", "pos", F.col("leaf").alias("hash"), "high"), most or 0)
    tops = shared_table(tops, "merkle_subroots")
    upper, top = levels(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(over).alias("high")), over)
    found = top.first()
    root = F.lit(found["hash"].hex() if found else None).cast("string")

    stored = shared_table(links(rounds, upper, trees), "merkle_links")
    with unlimited_recursion(spark):
        climbed = shared_table(spark.sql(CLIMB, start=start.withColumn("doc_id", F.col("doc_id").cast("long")), links=stored), "merkle_climb")
    proof = F.aggregate(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("step", "siblings"))), lambda x: F.coalesce(x["siblings"], F.array().cast("array<binary>")))),
        F.lit(bytearray()),
        lambda acc, x: F.concat(acc, F.coalesce(x, F.lit(bytearray()))),
    )
    leaf = climbed.groupBy("tree", "pos").agg(
        F.max("doc_id").alias("doc_id"), F.max("leaf").alias("leaf"), proof.alias("proof"), F.max_by("folded", "step").alias("folded")
    )
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("size") - 1, RUN_BITS))).alias("run")
    subroots = trees.join(tops, "tree").select("tree", run, as_hex(F.col("hash")).alias("subroot"))
    folded = as_hex(F.col("folded"))
    return leaf.withColumn("run", F.shiftright("pos", RUN_BITS)).join(subroots, ["tree", "run"]).select(
        "doc_id",
        as_hex(F.col("leaf")).alias("leaf"),
        "subroot",
        root.alias("root"),
        F.sha2(as_hex(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )
