"""Views over the driver's parquet tables that stand in for the reference's
unshipped inputs (annotation files, taxonomy, outline, gold / predictions).

Each view exists twice: as a Spark DataFrame and as DuckDB SQL (a ``WITH``
clause) for the oracle. Both are built from whole tables.

* label items: one per line item; article = order; language = region of the
  customer's nation (regions 0-4 -> BG EN HI PT RU); domain URW for order
  priorities 1 and 2, CC for 3, else a bare ``Other`` label; narrative
  label ``DOM: p_type``, subnarrative label ``DOM: p_type: name``, where every
  third part goes by its brand (a name that many entries share), items of
  some parts carry a bare ``Other`` (so their entries have gaps), and some
  labels have four parts (rejected).
* annotations: one line per article, labels ordered by
  ``l_linenumber, l_partkey, l_suppkey``. The per-article gather is bounded
  by the labels of one article (one line of the input format); counting
  jobs use the label items directly and never gather.
* taxonomy: theme by part size (<= 25 Ukraine War, else Climate Change),
  narrative p_type, subnarratives as above (for parts of size 50 the brand
  before both, which no label uses) plus ``Other``.
* outline pages: conversations; user turns are headings, assistant lines
  are ``- `` items, system turns are ``Figure n:`` captions, every third
  without text.
* phrase taxonomy: benchmark passages as narratives, their lines as
  subnarratives, without closing punctuation (documents contain passages, so
  there are hits). Documents are routed by quality label, those without
  by id: a fifth to class 2, the others to 0 and 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotline.functions import labels as L

REGION_LANGS = ("BG", "EN", "HI", "PT", "RU")
SMALL_PART_MAX_SIZE = 25
PRED_MIN_DISCOUNT = 0.05


# Fixed schemas of the driver tables (the columns the jobs read). A given
# schema spares the footer read for schema inference on every plan.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_discount double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read
    if name in TABLE_SCHEMAS:
        r = r.schema(TABLE_SCHEMAS[name])
    return r.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# Spark views
# ---------------------------------------------------------------------------

def _order_lang_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, lang, dom`` (dom null for a bare ``Other`` article)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cust_lang = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey",
        F.try_element_at(F.array(*[F.lit(x) for x in REGION_LANGS]), (F.col("n_regionkey") + 1).cast("int")).alias(
            "lang"
        ),
    )
    return o.join(cust_lang, o.o_custkey == cust_lang.c_custkey).select(
        "o_orderkey",
        "lang",
        F.when(F.col("o_orderpriority").startswith("1") | F.col("o_orderpriority").startswith("2"), F.lit("URW"))
        .when(F.col("o_orderpriority").startswith("3"), F.lit("CC"))
        .alias("dom"),
    )


def part_name() -> F.Column:
    return F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.col("p_name"))


def item_labels() -> list[F.Column]:
    """``nar_label, sub_label`` from ``dom, p_partkey, p_type, p_name``."""
    other = F.col("dom").isNull() | (F.col("p_partkey") % 20 == 7)
    long = F.when(F.col("p_partkey") % 50 == 9, F.lit("extra"))
    return [
        F.when(other, F.lit("Other")).otherwise(F.concat_ws(": ", "dom", "p_type")).alias("nar_label"),
        F.when(other, F.lit("Other")).otherwise(F.concat_ws(": ", "dom", "p_type", "p_name", long)).alias("sub_label"),
    ]


def label_items(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """One row per line item with its article, language and the two labels.

    ``by_order``: join parts first and orders last, so the rows come out
    partitioned by order key and a per-article aggregate that follows needs
    no further shuffle. Otherwise orders come first and parts last (the
    same two item-sized shuffles at scale; no per-article step follows)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount"
    )
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", part_name().alias("p_name"))
    orders = _order_lang_domain(spark, sf_dir)
    if by_order:
        items = li.join(p, li.l_partkey == p.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)
    else:
        items = li.join(orders, li.l_orderkey == orders.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return items.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_discount",
        "lang",
        F.concat(F.col("lang"), F.lit("_"), F.col("l_orderkey").cast("string"), F.lit(".txt")).alias("article_id"),
        *item_labels(),
    )


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lang, nar_label, sub_label, n``: line items counted per (language,
    domain, part) right after the order join, before parts are joined. The
    count is map-side combined, so the part join and everything after it
    see one row per distinct (language, domain, part), however hot a key."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", part_name().alias("p_name"))
    orders = _order_lang_domain(spark, sf_dir)
    per_part = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .groupBy("lang", "dom", "l_partkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_part.join(p, per_part.l_partkey == p.p_partkey).select(
        "lang",
        *item_labels(),
        "n",
    )


def _ordered_join(col: str, keep=None) -> F.Column:
    """``;``-join of a label column in line order (per-article gather)."""
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col(col).alias("v"))
    if keep is not None:
        item = F.when(keep, item)
    return F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]), L.LABEL_SEP)


def annotations(spark: SparkSession, sf_dir: str, items: DataFrame | None = None) -> DataFrame:
    """``article_id, lang, o_orderkey, narrative, subnarrative``."""
    items = items if items is not None else label_items(spark, sf_dir, by_order=True)
    return items.groupBy("o_orderkey").agg(
        F.first("article_id").alias("article_id"),
        F.first("lang").alias("lang"),
        _ordered_join("nar_label").alias("narrative"),
        _ordered_join("sub_label").alias("subnarrative"),
    )


def gold_and_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold = all labels of the article; prediction = labels of line items
    with ``l_discount >= 0.05`` (empty cell when none): ``article_id,
    narrative, subnarrative, p_narrative, p_subnarrative``."""
    items = label_items(spark, sf_dir, by_order=True)
    keep = F.col("l_discount") >= PRED_MIN_DISCOUNT
    return items.groupBy("o_orderkey").agg(
        F.first("article_id").alias("article_id"),
        _ordered_join("nar_label").alias("narrative"),
        _ordered_join("sub_label").alias("subnarrative"),
        _ordered_join("nar_label", keep).alias("p_narrative"),
        _ordered_join("sub_label", keep).alias("p_subnarrative"),
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``theme, narrative, subnarrative`` from part."""
    p = table(spark, sf_dir, "part")
    theme = F.when(F.col("p_size") <= SMALL_PART_MAX_SIZE, F.lit(L.THEME_NAMES["URW"])).otherwise(
        F.lit(L.THEME_NAMES["CC"])
    )
    unused = F.col("p_size") == 50
    narrative = F.when(unused, F.concat_ws(" ", "p_brand", "p_type")).otherwise(F.col("p_type"))
    sub = F.when(unused, F.concat_ws(" ", "p_brand", "p_name")).otherwise(part_name())
    pairs = p.select(theme.alias("theme"), narrative.alias("narrative"), sub.alias("subnarrative"))
    others = pairs.select("theme", "narrative", F.lit("Other").alias("subnarrative"))
    return pairs.union(others).distinct()


def theme_abbr_labels(tax: DataFrame) -> DataFrame:
    """Class lists for the scorer: ``level, class`` with labels in the
    annotation form (``ABBR: narrative`` / ``ABBR: narrative: sub``) plus
    ``Other``."""
    abbr = F.when(F.col("theme") == L.THEME_NAMES["URW"], F.lit("URW")).when(
        F.col("theme") == L.THEME_NAMES["CC"], F.lit("CC")
    )
    coarse = tax.select(F.lit("coarse").alias("level"), F.concat_ws(": ", abbr, F.col("narrative")).alias("class"))
    fine = tax.select(
        F.lit("fine").alias("level"), F.concat_ws(": ", abbr, F.col("narrative"), F.col("subnarrative")).alias("class")
    )
    spark = tax.sparkSession
    other = spark.createDataFrame([("coarse", "Other"), ("fine", "Other")], "level string, class string")
    return coarse.union(fine).union(other).distinct()


def outline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, page, text`` from conversations."""
    cv = table(spark, sf_dir, "conversations")
    text = (
        F.when(F.col("role") == "user", F.col("text"))
        .when(F.col("role") == "assistant", F.concat(F.lit("- "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n- "))))
        .when(F.col("role") == "system", F.concat(F.lit("Figure "), F.col("turn").cast("string"), F.lit(": "), F.when(F.col("conv_id") % 3 == 0, F.lit("")).otherwise(F.col("text"))))
    )
    return cv.select(
        F.col("conv_id").cast("string").alias("doc"), F.col("turn").cast("int").alias("page"), text.alias("text")
    )


def phrase_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``theme, narrative, subnarrative``: passage -> each non-blank line."""
    b = table(spark, sf_dir, "benchmark")
    lines = b.select(unclosed("text").alias("narrative"), F.explode(F.split("text", "\n", -1)).alias("subnarrative"))
    return lines.select(
        F.lit("benchmark").alias("theme"), "narrative", unclosed(L.strip_py("subnarrative")).alias("subnarrative")
    ).where(F.col("subnarrative") != "")


def unclosed(col) -> F.Column:
    """Without closing punctuation, so that a phrase ends in a word."""
    return F.regexp_replace(col, r"[\s.,!?]+$", "")


def documents_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents + ``p_domains`` (labels.quality where labelled, else by id: a
    fifth 2, the others 0 or 1)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    route = F.when(F.col("doc_id") % 5 == 0, F.lit(L.OTHER_CLASS)).otherwise(F.col("doc_id") % 2)
    return d.join(lab, "doc_id", "left").select(
        "doc_id", "text", "lang", F.coalesce(F.col("quality"), route).cast("int").alias("p_domains")
    )


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL (WITH-clause members)
# ---------------------------------------------------------------------------

SQL_ITEMS = f"""
items AS (
  SELECT l.l_orderkey AS o_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_discount,
         ['BG','EN','HI','PT','RU'][n.n_regionkey + 1] AS lang,
         CASE WHEN o.o_orderpriority LIKE '1%' OR o.o_orderpriority LIKE '2%' THEN 'URW'
              WHEN o.o_orderpriority LIKE '3%' THEN 'CC' END AS dom,
         p.p_partkey, p.p_type, CASE WHEN p.p_partkey % 3 = 0 THEN p.p_brand ELSE p.p_name END AS p_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
label_items AS (
  SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, lang,
         lang || '_' || CAST(o_orderkey AS VARCHAR) || '.txt' AS article_id,
         CASE WHEN dom IS NULL OR p_partkey % 20 = 7 THEN 'Other' ELSE dom || ': ' || p_type END AS nar_label,
         CASE WHEN dom IS NULL OR p_partkey % 20 = 7 THEN 'Other' ELSE dom || ': ' || p_type || ': ' || p_name
              || CASE WHEN p_partkey % 50 = 9 THEN ': extra' ELSE '' END END AS sub_label
  FROM items
)"""

SQL_ANNOTATIONS = (
    SQL_ITEMS
    + """,
annotations AS (
  SELECT article_id, lang, o_orderkey,
         string_agg(nar_label, ';' ORDER BY l_linenumber, l_partkey, l_suppkey) AS narrative,
         string_agg(sub_label, ';' ORDER BY l_linenumber, l_partkey, l_suppkey) AS subnarrative
  FROM label_items GROUP BY article_id, lang, o_orderkey
)"""
)

SQL_GOLD_PRED = (
    SQL_ITEMS
    + """,
gp AS (
  SELECT article_id,
         string_agg(nar_label, ';' ORDER BY l_linenumber, l_partkey, l_suppkey) AS narrative,
         string_agg(sub_label, ';' ORDER BY l_linenumber, l_partkey, l_suppkey) AS subnarrative,
         coalesce(string_agg(nar_label, ';' ORDER BY l_linenumber, l_partkey, l_suppkey)
                  FILTER (WHERE l_discount >= 0.05), '') AS p_narrative,
         coalesce(string_agg(sub_label, ';' ORDER BY l_linenumber, l_partkey, l_suppkey)
                  FILTER (WHERE l_discount >= 0.05), '') AS p_subnarrative
  FROM label_items GROUP BY article_id
)"""
)

SQL_TAXONOMY = """
taxonomy AS (
  SELECT DISTINCT theme, narrative, subnarrative FROM (
    SELECT CASE WHEN p_size <= 25 THEN 'Ukraine War label taxonomy' ELSE 'Climate Change label taxonomy' END AS theme,
           CASE WHEN p_size = 50 THEN p_brand || ' ' || p_type ELSE p_type END AS narrative,
           CASE WHEN p_size = 50 THEN p_brand || ' ' || p_name WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END
             AS subnarrative FROM part
    UNION ALL
    SELECT CASE WHEN p_size <= 25 THEN 'Ukraine War label taxonomy' ELSE 'Climate Change label taxonomy' END,
           CASE WHEN p_size = 50 THEN p_brand || ' ' || p_type ELSE p_type END, 'Other' FROM part)
)"""

SQL_OUTLINE_PAGES = """
pages AS (
  SELECT CAST(conv_id AS VARCHAR) AS doc, CAST(turn AS INTEGER) AS page,
         CASE role WHEN 'user' THEN text
                   WHEN 'assistant' THEN '- ' || replace(text, chr(10), chr(10) || '- ')
                   WHEN 'system' THEN 'Figure ' || CAST(turn AS VARCHAR) || ': ' || CASE WHEN conv_id % 3 = 0 THEN '' ELSE text END END AS text
  FROM conversations
)"""

# Python str.strip() / Java (?U)\\s: Unicode white space at both ends.
SQL_STRIP = "regexp_replace({x}, '^[\\s\\p{{Z}}\\x{{0b}}\\x{{85}}]+|[\\s\\p{{Z}}\\x{{0b}}\\x{{85}}]+$', '', 'g')"


def sql_strip(x: str) -> str:
    return SQL_STRIP.format(x=x)


UNCLOSED = "regexp_replace({x}, '[\\s.,!?]+$', '')"

SQL_PHRASE_TAXONOMY = f"""
phrase_tax AS (
  SELECT 'benchmark' AS theme, narrative, subnarrative FROM (
    SELECT {UNCLOSED.format(x='text')} AS narrative, {UNCLOSED.format(x=sql_strip('unnest(string_split(text, chr(10)))'))} AS subnarrative
    FROM benchmark) WHERE subnarrative <> ''
)"""

SQL_DOCS_ROUTED = """
docs_routed AS (
  SELECT d.doc_id, d.text, d.lang, CAST(coalesce(l.quality, CASE WHEN d.doc_id % 5 = 0 THEN 2 ELSE d.doc_id % 2 END) AS INTEGER) AS p_domains
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""
