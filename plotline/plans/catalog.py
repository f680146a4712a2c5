"""Registered queries over the driver tables, each with its DuckDB oracle.

Every entry reads whole tables (or views Spark derives from them). Floats
are rounded to 6 places in both engines; lists are compared as joined
strings. ``SQL`` holds the oracle for every query that has one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotline.functions import labels as L
from plotline.operators import classify as CL
from plotline.operators import detect as DT
from plotline.operators import folds as FO
from plotline.operators import infer as IN
from plotline.operators import labels as LB
from plotline.operators import score as SC
from plotline.operators import taxonomy as TX
from plotline.session import stored, work_path
from plotline.sources import driver as D
from plotline.sources import readers as R
from plotline.sources import schemas
from plotline.sources import sinks as K
from plotline.sources.readers import join_articles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# Shared SQL fragments --------------------------------------------------------
HAS_DOM = r"regexp_matches({x}, '^\w*:')"
LANG_SQL = (
    "CASE WHEN regexp_extract({x}, '(BG|EN|HI|PT)', 1) = '' THEN 'Unknown' "
    "ELSE regexp_extract({x}, '(BG|EN|HI|PT)', 1) END"
)


def nar_sql(x: str) -> str:
    return f"CASE WHEN {HAS_DOM.format(x=x)} THEN string_split({x}, ': ')[2] ELSE {x} END"


def sub_sql(x: str) -> str:
    return f"CASE WHEN {HAS_DOM.format(x=x)} THEN string_split({x}, ': ')[3] ELSE {x} END"


def ns_sql(x: str) -> str:
    return f"CASE WHEN {HAS_DOM.format(x=x)} THEN array_to_string(string_split({x}, ': ')[2:], ': ') ELSE {x} END"


def dom_sql(x: str) -> str:
    return f"CASE WHEN {HAS_DOM.format(x=x)} THEN string_split({x}, ': ')[1] ELSE '' END"


THEME_SQL = (
    "CASE {x} WHEN 'URW' THEN 'Ukraine War label taxonomy' "
    "WHEN 'CC' THEN 'Climate Change label taxonomy' WHEN 'Other' THEN 'Other' END"
)

# label cube over label items: theme, narrative, subnarrative, language, count
SQL_CUBE = (
    "WITH "
    + D.SQL_ITEMS
    + f""",
occ AS (SELECT {LANG_SQL.format(x='lang')} AS language, unnest([nar_label, sub_label]) AS label FROM label_items),
dec AS (SELECT language, label, string_split(label, ':') AS parts FROM occ),
dec2 AS (SELECT language, len(parts) AS n,
                CASE WHEN len(parts) = 1 THEN label ELSE parts[1] END AS abbr,
                CASE WHEN len(parts) = 1 THEN label ELSE parts[2] END AS nar,
                CASE WHEN len(parts) = 3 THEN parts[3] END AS sub FROM dec),
cube AS (SELECT {THEME_SQL.format(x=D.sql_strip('abbr'))} AS theme, {D.sql_strip('nar')} AS narrative,
                CASE WHEN sub <> '' THEN {D.sql_strip('sub')} END AS subnarrative, language, count(*) AS count
         FROM dec2 WHERE n <= 3 GROUP BY ALL)"""
)


def _cube(spark, sf):
    # label items counted per (language, domain, part) before the part join
    counts = D.label_counts(spark, sf)
    occ = counts.select(
        L.language_of("lang").alias("language"), F.explode(F.array("nar_label", "sub_label")).alias("label"), "n"
    )
    return TX.cube_from_occurrences(occ)


# ---------------------------------------------------------------------------
# Decoding, records
# ---------------------------------------------------------------------------

@register(
    "decode_flat",
    f"""WITH {D.SQL_ANNOTATIONS}
SELECT article_id,
  array_to_string(list_transform(string_split(narrative, ';'), lambda l: {nar_sql('l')}), ';') AS narrative,
  array_to_string(list_transform(string_split(subnarrative, ';'), lambda l: {sub_sql('l')}), ';') AS subnarrative,
  array_to_string(list_transform(string_split(subnarrative, ';'), lambda l: {ns_sql('l')}), ';') AS narrative_subnarrative,
  {dom_sql("string_split(subnarrative, ';')[1]")} AS domain
FROM annotations""",
)
def q_decode_flat(spark, sf):
    ann = D.annotations(spark, sf).select("article_id", "narrative", "subnarrative")
    good, _ = LB.split_rejects(LB.decode(ann))
    return LB.flat_records(good).drop("content")


@register(
    "articles_joined",
    f"""WITH {D.SQL_ANNOTATIONS},
a AS (SELECT doc_id, regexp_replace(text, '["“”]', '''', 'g') AS content FROM documents)
SELECT n.article_id, a.content,
  string_split(a.content, chr(10))[1] AS title,
  array_to_string(string_split(a.content, chr(10))[3:], chr(10)) AS body
FROM annotations n LEFT JOIN a ON n.o_orderkey = a.doc_id""",
)
def q_articles_joined(spark, sf):
    ann = D.annotations(spark, sf).select("article_id", "o_orderkey")
    docs = D.table(spark, sf, "documents").select(F.col("doc_id").alias("o_orderkey"), F.col("text").alias("content"))
    j = join_articles(ann, docs, keys=("o_orderkey",))
    return LB.with_title_body(j).select("article_id", "content", "title", "body")


_MERGED_SQL = f"""WITH {D.SQL_ANNOTATIONS},
dec AS (SELECT article_id,
  list_transform(string_split(narrative, ';'), lambda l: {nar_sql('l')}) AS nars,
  list_transform(string_split(subnarrative, ';'), lambda l: {sub_sql('l')}) AS subs,
  {dom_sql("string_split(narrative, ';')[1]")} AS domain
FROM annotations)"""


@register(
    "merged_labels",
    _MERGED_SQL
    + f"""
SELECT article_id, {LANG_SQL.format(x='article_id')} AS language,
  array_to_string(list_transform(range(1, least(len(nars), len(subs)) + 1),
     lambda i: replace(nars[i], ' ', '_') || '__' || replace(subs[i], ' ', '_')), ';') AS label,
  domain,
  CAST(CASE domain WHEN 'URW' THEN 0 WHEN 'CC' THEN 1 ELSE 2 END AS INTEGER) AS class_id
FROM dec""",
)
def q_merged_labels(spark, sf):
    ann = D.annotations(spark, sf).select("article_id", "narrative", "subnarrative")
    good, _ = LB.split_rejects(LB.decode(ann, domain_from="narrative"))
    merged = LB.merge_records(LB.nested_records(good))
    return LB.with_class(merged).select(
        "article_id", "language", F.array_join("label", ";").alias("label"), "domain", "class_id"
    )


@register(
    "records_json",
    _MERGED_SQL
    + """
SELECT article_id, to_json({'article_id': article_id, 'domain': domain,
                            'labels': {'narrative': nars, 'subnarrative': subs}}) AS value
FROM dec""",
)
def q_records_json(spark, sf):
    ann = D.annotations(spark, sf).select("article_id", "narrative", "subnarrative")
    good, _ = LB.split_rejects(LB.decode(ann, domain_from="narrative"))
    nested = LB.nested_records(good).drop("content")
    return nested.select("article_id", F.to_json(F.struct("article_id", "domain", "labels")).alias("value"))


@register(
    "language_counts",
    f"""WITH {D.SQL_ANNOTATIONS}
SELECT {LANG_SQL.format(x='article_id')} AS language, count(*) AS count FROM annotations GROUP BY 1""",
)
def q_language_counts(spark, sf):
    arts = D.label_items(spark, sf).select("article_id").distinct()
    return arts.groupBy(L.language_of("article_id").alias("language")).agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------------
# Counts, rollup, validity, gaps
# ---------------------------------------------------------------------------

@register(
    "theme_counts",
    SQL_CUBE
    + """
SELECT theme, language, CAST(sum(count) AS BIGINT) AS count FROM cube WHERE theme IS NOT NULL GROUP BY ALL""",
)
def q_theme_counts(spark, sf):
    return TX.theme_counts(_cube(spark, sf))


@register(
    "label_rejects",
    "WITH "
    + D.SQL_ITEMS
    + f""",
occ AS (SELECT {LANG_SQL.format(x='lang')} AS language, unnest([nar_label, sub_label]) AS label FROM label_items)
SELECT language, label, 'more than three '':'' parts' AS reject_reason FROM occ
WHERE len(string_split(label, ':')) >= 4""",
)
def q_label_rejects(spark, sf):
    items = D.label_items(spark, sf)
    lines = items.select(
        L.language_of("lang").alias("language"), F.col("nar_label").alias("narrative"), F.col("sub_label").alias("subnarrative")
    )
    return TX.label_rejects(lines)


@register(
    "theme_rollup",
    SQL_CUBE
    + """
SELECT theme, language, CAST(sum(count) AS BIGINT) AS count FROM cube WHERE theme IS NOT NULL
GROUP BY ROLLUP (theme, language)""",
)
def q_theme_rollup(spark, sf):
    return TX.theme_rollup(_cube(spark, sf))


_VALID_N = """EXISTS (SELECT 1 FROM taxonomy t WHERE t.theme = cube.theme AND t.narrative = cube.narrative)"""
_VALID_S = (
    "EXISTS (SELECT 1 FROM taxonomy t WHERE t.theme = cube.theme AND t.narrative = cube.narrative "
    "AND t.subnarrative = cube.subnarrative)"
)


@register(
    "narrative_counts",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f"""
SELECT narrative, language, CAST(sum(count) AS BIGINT) AS count FROM cube WHERE {_VALID_N} GROUP BY ALL""",
)
def q_narrative_counts(spark, sf):
    return TX.narrative_counts(_cube(spark, sf), D.taxonomy(spark, sf))


@register(
    "narrative_counts_by_theme",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f"""
SELECT theme, narrative, language, CAST(sum(count) AS BIGINT) AS count FROM cube WHERE {_VALID_N} GROUP BY ALL""",
)
def q_narrative_counts_by_theme(spark, sf):
    return TX.narrative_counts(_cube(spark, sf), D.taxonomy(spark, sf), by_theme=True)


@register(
    "subnarrative_counts",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f"""
SELECT subnarrative, language, CAST(sum(count) AS BIGINT) AS count FROM cube
WHERE subnarrative IS NOT NULL AND {_VALID_S} GROUP BY ALL""",
)
def q_subnarrative_counts(spark, sf):
    return TX.subnarrative_counts(_cube(spark, sf), D.taxonomy(spark, sf))


@register(
    "narrative_gaps",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f""",
counted AS (SELECT DISTINCT narrative FROM cube WHERE {_VALID_N})
SELECT DISTINCT theme, narrative, CAST(0 AS BIGINT) AS count FROM taxonomy
WHERE narrative NOT IN (SELECT narrative FROM counted)""",
)
def q_narrative_gaps(spark, sf):
    tax = D.taxonomy(spark, sf)
    return TX.narrative_gaps(tax, TX.narrative_counts(_cube(spark, sf), tax))


@register(
    "subnarrative_gaps",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f""",
counted AS (SELECT DISTINCT subnarrative FROM cube WHERE subnarrative IS NOT NULL AND {_VALID_S})
SELECT DISTINCT theme, narrative, subnarrative, CAST(0 AS BIGINT) AS count FROM taxonomy
WHERE subnarrative NOT IN (SELECT subnarrative FROM counted)""",
)
def q_subnarrative_gaps(spark, sf):
    tax = D.taxonomy(spark, sf)
    return TX.subnarrative_gaps(tax, TX.subnarrative_counts(_cube(spark, sf), tax))


@register(
    "subnarrative_gaps_by_theme",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f""",
counted AS (SELECT DISTINCT theme, narrative, subnarrative FROM cube WHERE subnarrative IS NOT NULL AND {_VALID_S})
SELECT DISTINCT t.theme, t.narrative, t.subnarrative, CAST(0 AS BIGINT) AS count FROM taxonomy t
WHERE NOT EXISTS (SELECT 1 FROM counted c WHERE c.theme = t.theme AND c.narrative = t.narrative
                  AND c.subnarrative = t.subnarrative)""",
)
def q_subnarrative_gaps_by_theme(spark, sf):
    tax = D.taxonomy(spark, sf)
    return TX.subnarrative_gaps(tax, TX.subnarrative_counts(_cube(spark, sf), tax, by_theme=True))


@register(
    "narrative_gaps_by_language",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f""",
counted AS (SELECT DISTINCT narrative, language FROM cube WHERE {_VALID_N}),
langs AS (SELECT DISTINCT language FROM cube)
SELECT t.theme, t.narrative, l.language, CAST(0 AS BIGINT) AS count
FROM (SELECT DISTINCT theme, narrative FROM taxonomy) t CROSS JOIN langs l
WHERE NOT EXISTS (SELECT 1 FROM counted c WHERE c.narrative = t.narrative AND c.language = l.language)""",
)
def q_narrative_gaps_by_language(spark, sf):
    tax = D.taxonomy(spark, sf)
    cube = _cube(spark, sf)
    return TX.gaps_by_language(tax, TX.narrative_counts(cube, tax), cube, "narrative")


@register(
    "subnarrative_gaps_by_language",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f""",
counted AS (SELECT DISTINCT subnarrative, language FROM cube WHERE subnarrative IS NOT NULL AND {_VALID_S}),
langs AS (SELECT DISTINCT language FROM cube)
SELECT t.theme, t.narrative, t.subnarrative, l.language, CAST(0 AS BIGINT) AS count
FROM (SELECT DISTINCT theme, narrative, subnarrative FROM taxonomy) t CROSS JOIN langs l
WHERE NOT EXISTS (SELECT 1 FROM counted c WHERE c.subnarrative = t.subnarrative AND c.language = l.language)""",
)
def q_subnarrative_gaps_by_language(spark, sf):
    tax = D.taxonomy(spark, sf)
    cube = _cube(spark, sf)
    return TX.gaps_by_language(tax, TX.subnarrative_counts(cube, tax), cube, "subnarrative")


@register(
    "top_narratives",
    SQL_CUBE
    + ","
    + D.SQL_TAXONOMY
    + f""",
c AS (SELECT narrative, language, CAST(sum(count) AS BIGINT) AS count FROM cube WHERE {_VALID_N} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY count DESC, narrative) AS rank FROM c)
SELECT narrative, language, count, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""",
)
def q_top_narratives(spark, sf):
    c = TX.narrative_counts(_cube(spark, sf), D.taxonomy(spark, sf))
    return IN.top_rank(c, ["language"], [F.desc("count"), "narrative"], 3, rank_col="rank")


@register(
    "label_vocabulary",
    "WITH "
    + D.SQL_TAXONOMY
    + """
SELECT replace(narrative, ' ', '_') || '__' || replace(subnarrative, ' ', '_') AS combination
FROM taxonomy WHERE theme = 'Ukraine War label taxonomy'
UNION ALL
SELECT replace(narrative, ' ', '_') || '__' || replace(subnarrative, ' ', '_')
FROM taxonomy WHERE theme = 'Climate Change label taxonomy'""",
)
def q_label_vocabulary(spark, sf):
    return TX.label_vocabulary(D.taxonomy(spark, sf))


# ---------------------------------------------------------------------------
# Outline (W2, W3)
# ---------------------------------------------------------------------------

_STRIP_LINE = D.sql_strip("ls[line_no + 1]")


@register(
    "outline_taxonomy",
    f"""WITH {D.SQL_OUTLINE_PAGES},
pl AS (SELECT doc, page, string_split(text, chr(10)) AS ls FROM pages WHERE text IS NOT NULL AND text <> ''),
pl2 AS (SELECT doc, page, ls, unnest(range(len(ls))) AS line_no FROM pl),
lines AS (SELECT doc, page, CAST(line_no AS INTEGER) AS line_no, {_STRIP_LINE} AS line FROM pl2),
caps AS (SELECT doc, page, min(line_no) AS cap FROM lines WHERE contains(line, 'Figure') GROUP BY doc, page),
capt AS (SELECT l.doc, l.page,
                CASE WHEN contains(l.line, ':') THEN nullif({D.sql_strip("split_part(l.line, ':', 2)")}, '') END AS page_theme
         FROM lines l JOIN caps c ON l.doc = c.doc AND l.page = c.page AND l.line_no = c.cap),
pth AS (SELECT p.doc, p.page, t.page_theme FROM (SELECT DISTINCT doc, page FROM pl) p
        LEFT JOIN capt t ON p.doc = t.doc AND p.page = t.page),
pth2 AS (SELECT doc, page, last_value(page_theme IGNORE NULLS) OVER
           (PARTITION BY doc ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS theme FROM pth),
kept AS (SELECT l.* FROM lines l LEFT JOIN caps c ON l.doc = c.doc AND l.page = c.page
         WHERE c.cap IS NULL OR l.line_no < c.cap),
k2 AS (SELECT *, CASE WHEN line <> '' AND NOT starts_with(line, '-') THEN line END AS head FROM kept),
k3 AS (SELECT *, last_value(head IGNORE NULLS) OVER
           (PARTITION BY doc ORDER BY page, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur FROM k2),
o AS (SELECT k3.doc, k3.page, k3.line_no, pth2.theme,
             CASE WHEN head IS NOT NULL THEN head ELSE cur END AS narrative,
             CASE WHEN head IS NOT NULL THEN 'Other'
                  WHEN starts_with(line, '-') THEN {D.sql_strip("regexp_replace(line, '^[- ]+', '')")} END AS subnarrative
      FROM k3 JOIN pth2 ON k3.doc = pth2.doc AND k3.page = pth2.page)
SELECT * FROM o WHERE narrative IS NOT NULL AND subnarrative IS NOT NULL""",
)
def q_outline_taxonomy(spark, sf):
    out = TX.parse_outline(D.outline_pages(spark, sf))
    return out.select("doc", "page", F.col("line_no").cast("int").alias("line_no"), "theme", "narrative", "subnarrative")


# ---------------------------------------------------------------------------
# Folds (W1, A6) and class metrics
# ---------------------------------------------------------------------------

def _fold_sql(table: str, cls: str, idc: str, k: int = 5, seed: int = 42, cols: str = "") -> str:
    return f"""r AS (SELECT {idc}, {cls}{cols}, row_number() OVER (PARTITION BY {cls}
                 ORDER BY md5('{seed}:' || CAST({idc} AS VARCHAR)), {idc}) AS rn FROM {table}),
s AS (SELECT {cls}, count(*) AS n FROM {table} GROUP BY {cls}),
o AS (SELECT {cls}, sum(n) OVER (ORDER BY {cls} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS start FROM s),
f AS (SELECT r.*, CAST((o.start + r.rn - 1) % {k} + 1 AS INTEGER) AS fold FROM r JOIN o ON r.{cls} = o.{cls})"""


@register("stratified_folds", "WITH " + _fold_sql("documents", "lang", "doc_id") + "\nSELECT doc_id, lang, fold FROM f")
def q_stratified_folds(spark, sf):
    d = D.table(spark, sf, "documents").select("doc_id", "lang")
    return FO.stratified_folds(d, "lang", "doc_id", k=5, seed=42).select("doc_id", "lang", "fold")


@register(
    "fold_value_counts",
    "WITH " + _fold_sql("documents", "lang", "doc_id") + "\nSELECT fold, lang, count(*) AS count FROM f GROUP BY ALL",
)
def q_fold_value_counts(spark, sf):
    d = D.table(spark, sf, "documents").select("doc_id", "lang")
    return FO.fold_value_counts(FO.stratified_folds(d, "lang", "doc_id"), "lang")


@register(
    "fold_value_counts_wide",
    "WITH " + _fold_sql("documents", "lang", "doc_id")
    + "\nSELECT fold, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in ("de", "en", "es", "fr")) + " FROM f GROUP BY fold",
)
def q_fold_value_counts_wide(spark, sf):
    d = D.table(spark, sf, "documents").select("doc_id", "lang")
    return FO.fold_value_counts(FO.stratified_folds(d, "lang", "doc_id"), "lang", pivot=True)


@register(
    "fold_split",
    "WITH " + _fold_sql("documents", "lang", "doc_id")
    + "\nSELECT CASE WHEN fold = 2 THEN 'validation' ELSE 'train' END AS part, lang, count(*) AS count FROM f GROUP BY ALL",
)
def q_fold_split(spark, sf):
    d = stored(FO.stratified_folds(D.table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id"), "folds")
    train, validation = FO.fold_split(d, 2)
    both = train.withColumn("part", F.lit("train")).unionByName(validation.withColumn("part", F.lit("validation")))
    return both.groupBy("part", "lang").agg(F.count(F.lit(1)).alias("count"))


_EMB_SQL = """emb AS (SELECT vec_id, label, CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS INTEGER) AS pred
        FROM embeddings)"""


def _class_metrics_sql(keys: str) -> str:
    k = keys + ", " if keys else ""
    return f"""cc AS (SELECT {k}c, sum(t) AS n_true, sum(p) AS n_pred, sum(tp) AS tp FROM (
        SELECT {k}label AS c, 1 AS t, 0 AS p, CASE WHEN label = pred THEN 1 ELSE 0 END AS tp FROM src
        UNION ALL SELECT {k}pred, 0, 1, 0 FROM src) GROUP BY ALL),
m AS (SELECT {k}CAST(sum(tp) AS DOUBLE) / sum(n_true) AS accuracy,
        avg(CASE WHEN n_pred > 0 THEN CAST(tp AS DOUBLE) / n_pred ELSE 1.0 END) AS precision,
        avg(CASE WHEN n_true > 0 THEN CAST(tp AS DOUBLE) / n_true ELSE 1.0 END) AS recall,
        avg(2.0 * CAST(tp AS DOUBLE) / (n_pred + n_true)) AS f1 FROM cc {"GROUP BY " + keys if keys else ""})"""


def _emb(spark, sf):
    e = D.table(spark, sf, "embeddings")
    return e.select("vec_id", "label", (L.argmax("embedding") % 10).cast("int").alias("pred"))


@register(
    "class_metrics",
    f"""WITH {_EMB_SQL}, src AS (SELECT * FROM emb), {_class_metrics_sql('')}
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM m""",
)
def q_class_metrics(spark, sf):
    m = SC.class_metrics(_emb(spark, sf), "label", "pred")
    return m.select(*[r6(c).alias(c) for c in SC.METRICS])


@register(
    "fold_class_metrics",
    f"""WITH {_EMB_SQL}, {_fold_sql('emb', 'label', 'vec_id', cols=', pred')},
src AS (SELECT fold, label, pred FROM f), {_class_metrics_sql('fold')},
lng AS (UNPIVOT m ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)
SELECT CAST(fold AS VARCHAR) AS fold, metric, round(value, 6) AS value FROM lng
UNION ALL
SELECT 'avg', metric, round(avg(value), 6) FROM lng GROUP BY metric""",
)
def q_fold_class_metrics(spark, sf):
    e = FO.stratified_folds(_emb(spark, sf), "label", "vec_id")
    wide = SC.class_metrics(e, "label", "pred", keys=["fold"])
    both = SC.with_metric_means(SC.metrics_long(wide, keys=["fold"]))
    return both.select("fold", "metric", r6("value").alias("value"))


@register(
    "fold_metrics_log",
    f"""WITH {_EMB_SQL}, {_fold_sql('emb', 'label', 'vec_id', cols=', pred')},
src AS (SELECT fold, label, pred FROM f), {_class_metrics_sql('fold')},
lng AS (UNPIVOT m ON accuracy, precision, recall, f1 INTO NAME metric VALUE value),
allm AS (SELECT CAST(fold AS INTEGER) AS block, metric, value FROM lng
         UNION ALL SELECT 1073741824, metric, avg(value) FROM lng GROUP BY metric),
pos AS (SELECT * FROM (VALUES ('accuracy', 1), ('precision', 2), ('recall', 3), ('f1', 4)) t(metric, pos))
SELECT block, CAST(pos AS INTEGER) AS pos, printf('%s: %.4f', metric, value) AS line FROM allm JOIN pos USING (metric)
UNION ALL
SELECT DISTINCT block, 0, CASE WHEN block = 1073741824 THEN 'Average Metrics Across All Folds:'
                              ELSE printf('Fold %d Metrics:', block) END FROM allm
UNION ALL
SELECT DISTINCT block, 1048576, '' FROM allm WHERE block <> 1073741824""",
)
def q_fold_metrics_log(spark, sf):
    from plotline.sources.sinks import metrics_log_lines

    e = FO.stratified_folds(_emb(spark, sf), "label", "vec_id")
    wide = SC.class_metrics(e, "label", "pred", keys=["fold"])
    return metrics_log_lines(SC.with_metric_means(SC.metrics_long(wide, keys=["fold"])))


# ---------------------------------------------------------------------------
# Scoring (J4, J5, U4, A7, A8, A12, A15)
# ---------------------------------------------------------------------------

_CLASSES_SQL = """classes AS (SELECT DISTINCT level, class FROM (
  SELECT 'coarse' AS level, CASE theme WHEN 'Ukraine War label taxonomy' THEN 'URW'
         WHEN 'Climate Change label taxonomy' THEN 'CC' END || ': ' || narrative AS class FROM taxonomy
  UNION ALL
  SELECT 'fine', CASE theme WHEN 'Ukraine War label taxonomy' THEN 'URW'
         WHEN 'Climate Change label taxonomy' THEN 'CC' END || ': ' || narrative || ': ' || subnarrative FROM taxonomy
  UNION ALL SELECT 'coarse', 'Other' UNION ALL SELECT 'fine', 'Other'))"""


@register(
    "scorer_f1",
    f"""WITH {D.SQL_GOLD_PRED}, {D.SQL_TAXONOMY}, {_CLASSES_SQL},
sides AS (SELECT article_id, 'coarse' AS level, list_distinct(string_split(narrative, ';')) AS g,
                 list_distinct(string_split(p_narrative, ';')) AS p FROM gp
          UNION ALL
          SELECT article_id, 'fine', list_distinct(string_split(subnarrative, ';')),
                 list_distinct(string_split(p_subnarrative, ';')) FROM gp),
occ AS (SELECT article_id, level, unnest(g) AS label, 1 AS ig, 0 AS ip FROM sides
        UNION ALL SELECT article_id, level, unnest(p), 0, 1 FROM sides),
known AS (SELECT o.* FROM occ o WHERE EXISTS (SELECT 1 FROM classes c WHERE c.level = o.level AND c.class = o.label)),
lab AS (SELECT article_id, level, label, max(ig) AS ig, max(ip) AS ip FROM known GROUP BY ALL),
agg AS (SELECT article_id, level, sum(ig) AS ng, sum(ip) AS np, sum(ig * ip) AS tp FROM lab GROUP BY ALL),
per AS (SELECT s.level, coalesce(a.ng, 0) AS ng, coalesce(a.np, 0) AS np, coalesce(a.tp, 0) AS tp
        FROM sides s LEFT JOIN agg a ON s.article_id = a.article_id AND s.level = a.level),
f AS (SELECT level, CASE WHEN ng + np > 0 THEN 2.0 * CAST(tp AS DOUBLE) / (ng + np) ELSE 0.0 END AS f1 FROM per)
SELECT level, round(avg(f1), 6) AS f1_mean, round(stddev_pop(f1), 6) AS f1_sd, count(*) AS n FROM f GROUP BY level""",
)
def q_scorer_f1(spark, sf):
    # Gold = every label of an article, prediction = labels of discounted
    # items: computed from the label items in long form (no per-article
    # gather); the DuckDB oracle builds and splits the annotation lines.
    items = D.label_items(spark, sf)
    classes = D.theme_abbr_labels(D.taxonomy(spark, sf))
    long = items.select(
        "article_id",
        (F.col("l_discount") >= D.PRED_MIN_DISCOUNT).alias("is_pred"),
        F.explode(
            F.array(
                F.struct(F.lit("coarse").alias("level"), F.col("nar_label").alias("label")),
                F.struct(F.lit("fine").alias("level"), F.col("sub_label").alias("label")),
            )
        ).alias("x"),
    ).select("article_id", "is_pred", "x.*")
    occ = long.select("level", "article_id", "label", F.lit(True).alias("in_gold"), F.col("is_pred").alias("in_pred"))
    counts = SC.set_counts_flagged(occ, keys=["level"], classes=classes)
    s = SC.summarize_f1(SC.f1_from_counts(counts), keys=["level"])
    return s.select("level", r6("f1_mean").alias("f1_mean"), r6("f1_sd").alias("f1_sd"), "n")


def _decoded_list_sql(cell: str, part: str) -> str:
    fn = nar_sql if part == "narrative" else sub_sql
    return (
        f"list_distinct(list_filter(list_transform(string_split({cell}, ';'), lambda l: {fn('l')}), "
        "lambda l: l <> ''))"
    )


@register(
    "sample_prf",
    f"""WITH {D.SQL_GOLD_PRED},
sides AS (SELECT 'narrative' AS level, {_decoded_list_sql('narrative', 'narrative')} AS g,
                 {_decoded_list_sql('p_narrative', 'narrative')} AS p FROM gp
          UNION ALL
          SELECT 'subnarrative', {_decoded_list_sql('subnarrative', 'subnarrative')},
                 {_decoded_list_sql('p_subnarrative', 'subnarrative')} FROM gp),
per AS (SELECT level, CAST(len(list_intersect(g, p)) AS DOUBLE) AS tp, len(g) AS ng, len(p) AS np FROM sides)
SELECT level,
  round(avg(CASE WHEN np > 0 THEN tp / np ELSE 0.0 END), 6) AS precision,
  round(avg(CASE WHEN ng > 0 THEN tp / ng ELSE 0.0 END), 6) AS recall,
  round(avg(CASE WHEN ng + np > 0 THEN 2.0 * tp / (ng + np) ELSE 0.0 END), 6) AS f1,
  count(*) AS n
FROM per GROUP BY level""",
)
def q_sample_prf(spark, sf):
    items = D.label_items(spark, sf)
    long = items.select(
        "article_id",
        (F.col("l_discount") >= D.PRED_MIN_DISCOUNT).alias("is_pred"),
        F.explode(
            F.array(
                F.struct(F.lit("narrative").alias("level"), L.narrative_of("nar_label").alias("label")),
                F.struct(F.lit("subnarrative").alias("level"), L.subnarrative_of("sub_label").alias("label")),
            )
        ).alias("x"),
    ).select("article_id", "is_pred", "x.*")
    occ = long.select("level", "article_id", "label", F.lit(True).alias("in_gold"), F.col("is_pred").alias("in_pred"))
    counts = SC.set_counts_flagged(occ, keys=["level"])
    s = SC.prf_from_counts(counts, keys=["level"])
    return s.select("level", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "n")


@register(
    "observed_labels",
    f"""WITH {D.SQL_GOLD_PRED}
SELECT DISTINCT label FROM (
  SELECT unnest(list_transform(string_split(narrative, ';'), lambda l: {nar_sql('l')})) AS label FROM gp
  UNION ALL
  SELECT unnest(list_transform(string_split(p_narrative, ';'), lambda l: {nar_sql('l')})) FROM gp)
WHERE label <> ''""",
)
def q_observed_labels(spark, sf):
    items = D.label_items(spark, sf)
    label = L.narrative_of("nar_label").alias("label")
    return SC.observed_labels(items.select(label), items.where(F.col("l_discount") >= D.PRED_MIN_DISCOUNT).select(label))


@register(
    "set_metrics_by_fold",
    f"""WITH {D.SQL_GOLD_PRED}, {D.SQL_TAXONOMY}, {_CLASSES_SQL},
sides AS (SELECT article_id, 'coarse' AS level, list_distinct(string_split(narrative, ';')) AS g,
                 list_distinct(string_split(p_narrative, ';')) AS p FROM gp
          UNION ALL
          SELECT article_id, 'fine', list_distinct(string_split(subnarrative, ';')),
                 list_distinct(string_split(p_subnarrative, ';')) FROM gp),
fol AS (SELECT *, CAST(length(article_id) % 3 + 1 AS VARCHAR) AS fold FROM sides),
occ AS (SELECT article_id, level, fold, unnest(g) AS label, 1 AS ig, 0 AS ip FROM fol
        UNION ALL SELECT article_id, level, fold, unnest(p), 0, 1 FROM fol),
lab AS (SELECT o.article_id, o.level, o.fold, o.label, max(ig) AS ig, max(ip) AS ip, max((c.class IS NOT NULL)::INT) AS known, max((o.label <> '')::INT) AS named
        FROM occ o LEFT JOIN classes c ON c.level = o.level AND c.class = o.label GROUP BY ALL),
agg AS (SELECT article_id, level, fold, sum(ig * known) AS kg, sum(ip * known) AS kp, sum(ig * ip * known) AS kt,
        sum(ig * named) AS ng, sum(ip * named) AS np, sum(ig * ip * named) AS nt FROM lab GROUP BY ALL),
fig AS (SELECT level, fold, CASE WHEN kg + kp > 0 THEN 2.0 * kt::DOUBLE / (kg + kp) ELSE 0.0 END AS kf,
        CASE WHEN np > 0 THEN nt::DOUBLE / np ELSE 0.0 END AS pr, CASE WHEN ng > 0 THEN nt::DOUBLE / ng ELSE 0.0 END AS re,
        CASE WHEN ng + np > 0 THEN 2.0 * nt::DOUBLE / (ng + np) ELSE 0.0 END AS f FROM agg),
m AS (SELECT level, coalesce(fold, 'all') AS fold, avg(kf) AS f1_mean, stddev_pop(kf) AS f1_sd, avg(pr) AS precision, avg(re) AS recall, avg(f) AS f1, count(*) AS n
      FROM fig GROUP BY GROUPING SETS ((level, fold), (level))),
v AS (SELECT level, coalesce(fold, 'all') AS fold, count(DISTINCT label) AS n_labels FROM lab WHERE named = 1 GROUP BY GROUPING SETS ((level, fold), (level)))
SELECT m.level, m.fold, round(f1_mean, 6) AS f1_mean, round(f1_sd, 6) AS f1_sd, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, n, n_labels FROM m JOIN v USING (level, fold)""",
)
def q_set_metrics_by_fold(spark, sf):
    """Every set metric of both levels, by fold and over all, in one pass (the fold
    of an article: the length of its id)."""
    items = D.label_items(spark, sf)
    is_pred = F.col("l_discount") >= D.PRED_MIN_DISCOUNT
    sides = F.array(
        F.struct(F.lit("coarse").alias("level"), F.col("nar_label").alias("label")),
        F.struct(F.lit("fine").alias("level"), F.col("sub_label").alias("label")),
    )
    occ = items.select("article_id", is_pred.alias("in_pred"), F.explode(sides).alias("x")).select(
        "x.*", "article_id", (F.length("article_id") % 3 + 1).alias("fold"), F.lit(True).alias("in_gold"), "in_pred"
    )
    m = SC.set_metrics(occ, D.theme_abbr_labels(D.taxonomy(spark, sf)))
    return m.select("level", "fold", *[r6(c).alias(c) for c in ("f1_mean", "f1_sd", "precision", "recall", "f1")], "n", "n_labels")


@register(
    "misaligned_ids",
    """WITH g AS (SELECT c_custkey AS id, count(*) AS n FROM customer GROUP BY 1),
p AS (SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(g.id, p.id) AS id,
       CASE WHEN p.n IS NULL THEN 'only gold' WHEN g.n IS NULL THEN 'only predicted' ELSE 'repeated' END AS problem
FROM g FULL JOIN p ON g.id = p.id WHERE p.n IS NULL OR g.n IS NULL OR g.n > 1 OR p.n > 1""",
)
def q_misaligned_ids(spark, sf):
    gold = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return SC.misaligned_ids(gold, D.table(spark, sf, "events").select(F.col("user_id").alias("id")), "id")


@register(
    "id_alignment",
    """SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS n_gold,
       (SELECT count(DISTINCT doc_id) FROM labels) AS n_pred,
       (SELECT count(*) FROM (SELECT DISTINCT doc_id FROM documents INTERSECT SELECT DISTINCT doc_id FROM labels)) AS n_common""",
)
def q_id_alignment(spark, sf):
    return SC.alignment(D.table(spark, sf, "documents"), D.table(spark, sf, "labels"), "doc_id")


@register(
    "ids_without_result",
    """SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels""",
)
def q_ids_without_result(spark, sf):
    docs = D.table(spark, sf, "documents").select("doc_id")
    return docs.subtract(D.table(spark, sf, "labels").select("doc_id"))


# ---------------------------------------------------------------------------
# Phrase detection
# ---------------------------------------------------------------------------

# Java (?U)\w as an RE2 class, and \b around a phrase as look-free RE2 parts.
_W = r"\p{L}\p{Nl}\p{Nd}\p{Mn}\p{Mc}\p{Me}\p{Pc}\x{200C}\x{200D}"
_PHRASE_SQL = f"""phrases AS (SELECT DISTINCT kind, phrase FROM (
     SELECT 'narrative' AS kind, narrative AS phrase FROM phrase_tax
     UNION ALL SELECT 'subnarrative', subnarrative FROM phrase_tax) WHERE phrase IS NOT NULL AND phrase <> ''),
pp AS (SELECT kind, phrase,
         '(?i)' || (CASE WHEN regexp_matches(phrase, '^[{_W}]') THEN '(^|[^{_W}])' ELSE '[{_W}]' END)
         || regexp_replace(phrase, '([\\\\.^$|?*+()\\[\\]{{}}])', '\\\\\\1', 'g')
         || (CASE WHEN regexp_matches(phrase, '[{_W}]$') THEN '($|[^{_W}])' ELSE '[{_W}]' END) AS pat
       FROM phrases),
cand AS MATERIALIZED (SELECT d.doc_id, d.text, p.kind, p.phrase, p.pat FROM docs_routed d JOIN pp p
         ON d.p_domains <> 2 AND contains(lower(d.text), lower(p.phrase))),
hits AS (SELECT doc_id, kind, phrase FROM cand WHERE regexp_matches(text, pat)),
per AS (SELECT doc_id,
          list_sort(list_distinct(list(phrase) FILTER (WHERE kind = 'narrative'))) AS n,
          list_sort(list_distinct(list(phrase) FILTER (WHERE kind = 'subnarrative'))) AS s
        FROM hits GROUP BY doc_id),
det AS (SELECT d.doc_id, d.p_domains,
          CASE WHEN d.p_domains = 2 OR len(coalesce(per.n, [])) = 0 THEN ['Other'] ELSE per.n END AS p_narrative,
          CASE WHEN d.p_domains = 2 OR len(coalesce(per.s, [])) = 0 THEN ['Other'] ELSE per.s END AS p_subnarrative
        FROM docs_routed d LEFT JOIN per ON d.doc_id = per.doc_id)"""

PHRASE_SEP = " ||| "


def _detected(spark, sf):
    docs = D.documents_routed(spark, sf)
    return DT.detect(docs, D.phrase_taxonomy(spark, sf), id_col="doc_id", text_col="text", class_col="p_domains")


@register(
    "detect_phrases",
    f"""WITH {D.SQL_DOCS_ROUTED}, {D.SQL_PHRASE_TAXONOMY}, {_PHRASE_SQL}
SELECT doc_id, p_domains, array_to_string(p_narrative, '{PHRASE_SEP}') AS p_narrative,
       array_to_string(p_subnarrative, '{PHRASE_SEP}') AS p_subnarrative FROM det""",
)
def q_detect_phrases(spark, sf):
    d = _detected(spark, sf)
    return d.select(
        "doc_id",
        "p_domains",
        F.array_join("p_narrative", PHRASE_SEP).alias("p_narrative"),
        F.array_join("p_subnarrative", PHRASE_SEP).alias("p_subnarrative"),
    )


_SCOPED_SQL = _PHRASE_SQL.replace(
    "per AS (SELECT doc_id,",
    """scoped AS (SELECT * FROM hits h WHERE kind = 'narrative' OR EXISTS (SELECT 1 FROM phrase_tax t, hits n
     WHERE t.subnarrative = h.phrase AND n.kind = 'narrative' AND n.phrase = t.narrative AND n.doc_id = h.doc_id)),
per AS (SELECT doc_id,""",
).replace("FROM hits GROUP BY doc_id)", "FROM scoped GROUP BY doc_id)")


@register(
    "detect_phrases_scoped",
    f"""WITH {D.SQL_DOCS_ROUTED}, {D.SQL_PHRASE_TAXONOMY}, {_SCOPED_SQL}
SELECT doc_id, array_to_string(p_narrative, '{PHRASE_SEP}') AS p_narrative,
       array_to_string(p_subnarrative, '{PHRASE_SEP}') AS p_subnarrative FROM det""",
)
def q_detect_phrases_scoped(spark, sf):
    """A subnarrative counts only with one of its narratives in the text."""
    d = DT.detect(
        D.documents_routed(spark, sf), D.phrase_taxonomy(spark, sf), id_col="doc_id", text_col="text", class_col="p_domains", scoped=True
    )
    return d.select(
        "doc_id", F.array_join("p_narrative", PHRASE_SEP).alias("p_narrative"), F.array_join("p_subnarrative", PHRASE_SEP).alias("p_subnarrative")
    )


@register(
    "other_counts",
    f"""WITH {D.SQL_DOCS_ROUTED}, {D.SQL_PHRASE_TAXONOMY}, {_PHRASE_SQL}
SELECT count(*) FILTER (WHERE p_narrative = ['Other'] AND p_subnarrative = ['Other']) AS n_all_other,
       count(*) FILTER (WHERE NOT (p_narrative = ['Other'] AND p_subnarrative = ['Other'])) AS n_with_labels
FROM det""",
)
def q_other_counts(spark, sf):
    return DT.other_counts(_detected(spark, sf))


# ---------------------------------------------------------------------------
# Routing, prompts, model runs, resume
# ---------------------------------------------------------------------------

_PROMPT_SQL = f"""subs AS (SELECT theme, narrative,
          string_agg('- ' || subnarrative, chr(10) ORDER BY (subnarrative = 'Other'), subnarrative) AS s
        FROM (SELECT DISTINCT theme, narrative, subnarrative FROM taxonomy) GROUP BY theme, narrative),
opts AS (SELECT theme, string_agg(narrative || chr(10) || s, chr(10) || chr(10) ORDER BY narrative) AS options
         FROM subs GROUP BY theme),
tpl AS (SELECT c.class_id, {sql_lit(IN.PROMPT_HEAD)} || coalesce(o.options, '') || {sql_lit(IN.PROMPT_TEXT_HEAD)} AS head,
               c.tail
        FROM (SELECT 0 AS class_id, 'Ukraine War label taxonomy' AS theme, {sql_lit(IN.PROMPT_TAIL_WAR)} AS tail
              UNION ALL
              SELECT 1, 'Climate Change label taxonomy', {sql_lit(IN.PROMPT_TAIL_CLIMATE)}) c
        LEFT JOIN opts o ON c.theme = o.theme),
prompts AS (SELECT d.doc_id, d.p_domains, d.text,
                   CASE WHEN t.head IS NOT NULL THEN t.head || d.text || t.tail END AS prompt
            FROM docs_routed d LEFT JOIN tpl t ON d.p_domains = t.class_id)"""


def _prompts(spark, sf):
    return IN.route_prompts(
        D.documents_routed(spark, sf), D.taxonomy(spark, sf), text_col="text", class_col="p_domains"
    )


@register(
    "route_prompts",
    f"""WITH {D.SQL_DOCS_ROUTED}, {D.SQL_TAXONOMY}, {_PROMPT_SQL}
SELECT doc_id, p_domains, prompt FROM prompts""",
)
def q_route_prompts(spark, sf):
    return _prompts(spark, sf).select("doc_id", "p_domains", "prompt")


@register(
    "routed_answers",
    f"""WITH {D.SQL_DOCS_ROUTED}, {D.SQL_TAXONOMY}, {_PROMPT_SQL}
SELECT doc_id, CASE WHEN prompt IS NULL THEN '{IN.NO_MODEL_ANSWER}'
                    ELSE 'len=' || CAST(length(prompt) AS VARCHAR) END AS gpt_output
FROM prompts""",
)
def q_routed_answers(spark, sf):
    return IN.answer_routed(_prompts(spark, sf), IN.length_stub, "doc_id")


@register(
    "resume_translate",
    f"""SELECT d.doc_id,
  CASE WHEN upper(d.lang) IN ('EN', 'HI') THEN d.text
       ELSE 'len=' || CAST(length({sql_lit(IN.TRANSLATE_HEAD)} || d.text) AS VARCHAR) END AS en_content
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def q_resume_translate(spark, sf):
    docs = D.table(spark, sf, "documents")
    finished = D.table(spark, sf, "labels").select("doc_id")
    return IN.translate(
        docs, IN.length_stub, "doc_id", text_col="text", lang_col="lang", finished=finished
    )


@register(
    "resume_merged",
    f"""SELECT d.doc_id,
  CASE WHEN l.doc_id IS NOT NULL THEN 'finished ' || coalesce(CAST(l.quality AS VARCHAR), '')
       WHEN upper(d.lang) IN ('EN', 'HI') THEN d.text
       ELSE 'len=' || CAST(length({sql_lit(IN.TRANSLATE_HEAD)} || d.text) AS VARCHAR) END AS en_content
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def q_resume_merged(spark, sf):
    """Every document, with its finished answer or a new one."""
    docs = D.table(spark, sf, "documents")
    old = F.concat(F.lit("finished "), F.coalesce(F.col("quality").cast("string"), F.lit("")))
    finished = D.table(spark, sf, "labels").select("doc_id", old.alias("en_content"))
    new = IN.translate(docs, IN.length_stub, "doc_id", text_col="text", lang_col="lang", finished=finished)
    return finished.join(docs.select("doc_id"), "doc_id", "left_semi").unionByName(new)


# ---------------------------------------------------------------------------
# File layer: round trips with the readers' and writers' own options
# (S1, S2, S5, S6, S9, K1, K3), language of a path (P13), class vectors
# ---------------------------------------------------------------------------

_CELLS_SQL = """cells AS (SELECT CAST(doc_id AS VARCHAR) AS article_id,
  text || chr(10) || 'say "hi", ' || chr(92) || ' end' AS content,
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE '"q" ' || source || ', é' END AS domain FROM documents)"""


def _cells(spark, sf):
    """Texts with line breaks, quotes, commas, backslashes and empty cells."""
    d = D.table(spark, sf, "documents")
    domain = F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit('"q" '), "source", F.lit(", é")))
    return d.select(
        F.col("doc_id").cast("string").alias("article_id"),
        F.concat("text", F.lit('\nsay "hi", \\ end')).alias("content"),
        domain.alias("domain"),
    )


@register(
    "csv_round_trip",
    f"""WITH {_CELLS_SQL} SELECT article_id, CASE CAST(article_id AS BIGINT) % 7 WHEN 0 THEN NULL WHEN 1 THEN chr(92) || 'N' WHEN 2 THEN chr(92) || chr(92) || 'N'
  WHEN 3 THEN ' ' WHEN 4 THEN chr(9) || domain || chr(13) || chr(10) ELSE domain END AS domain, content,
  CASE WHEN CAST(article_id AS BIGINT) % 3 > 0 THEN CAST(article_id AS BIGINT) % 3 END AS p_domains FROM cells""",
)
def q_csv_round_trip(spark, sf):
    """K1 / S6 through the sink and the reader: null, empty, blank and marker-like
    cells stay what they are."""
    k, id_ = F.col("article_id").cast("long") % 7, F.col("article_id").cast("long") % 3
    domain = (
        F.when(k == 0, F.lit(None)).when(k == 1, F.lit("\\N")).when(k == 2, F.lit("\\\\N")).when(k == 3, F.lit(" "))
        .when(k == 4, F.concat(F.lit("\t"), "domain", F.lit("\r\n"))).otherwise(F.col("domain"))
    )
    cells = _cells(spark, sf).select("article_id", domain.alias("domain"), "content", F.when(id_ > 0, id_).alias("p_domains"))
    path = work_path(spark, "records.csv")
    K.write_csv(cells, path)
    return R.read_csv_by_name(spark, path, cells.schema).drop("file_path")


@register(
    "fold_files_by_name",
    """SELECT CAST(doc_id AS VARCHAR) AS article_id, CASE WHEN doc_id % 11 <> 0 THEN text END AS content,
  CASE WHEN doc_id % 4 < 3 THEN CAST(doc_id % 3 AS INTEGER) END AS p_domains, CAST(doc_id % 4 + 1 AS INTEGER) AS fold FROM documents""",
)
def q_fold_files_by_name(spark, sf):
    """Four fold files, in the schema's order, permuted, with a column
    more, and with one less, written by the sink and stacked by name. A file is a
    folder of part files, one from each split of the input: cells of several lines
    keep a reader from splitting a file, so a fold in one file is one task."""
    d = D.table(spark, sf, "documents").withColumn("k", F.col("doc_id") % 4)
    d = d.select(
        "k",
        F.col("doc_id").cast("string").alias("article_id"),
        F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("content"),
        (F.col("doc_id") % 3).cast("int").alias("p_domains"),
        F.col("source").alias("note"),
    )
    layouts = (["article_id", "content", "p_domains"], ["p_domains", "content", "article_id"], ["note", "p_domains", "article_id", "content"], ["content", "article_id"])
    folder = work_path(spark, "folds")
    for k, columns in enumerate(layouts):
        K.write_csv(d.where(F.col("k") == k).select(*columns), f"{folder}/fold{k + 1}_predictions.csv")
    return R.read_fold_files(spark, folder)


_LINE_SQL = """line AS (SELECT doc_id, CASE doc_id % 10 WHEN 3 THEN '{"article_id": "' || doc_id || '", "content": "cut of' WHEN 5 THEN '[' || doc_id || ']'
  WHEN 7 THEN '{"article_id": "' || doc_id || '", "labels": "none"}' WHEN 9 THEN 'line ' || doc_id END AS spoiled FROM documents)"""


@register(
    "jsonl_rejects",
    f"""WITH {_LINE_SQL}
SELECT CASE WHEN spoiled IS NULL THEN CAST(doc_id AS VARCHAR) END AS article_id, spoiled AS record,
  CASE doc_id % 10 WHEN 7 THEN 'does not fit the schema' WHEN 3 THEN 'no field can be read' WHEN 5 THEN 'no field can be read' WHEN 9 THEN 'no field can be read' END AS reason,
  CASE WHEN spoiled IS NULL THEN length(text) + length('line') END AS n FROM line JOIN documents USING (doc_id)""",
)
def q_jsonl_rejects(spark, sf):
    """Cut lines, arrays, text and wrong types among records written by the
    sink: every line is a record or a reject."""
    k, id_ = F.col("doc_id") % 10, F.col("doc_id").cast("string")
    spoiled = (
        F.when(k == 3, F.concat(F.lit('{"article_id": "'), id_, F.lit('", "content": "cut of')))
        .when(k == 5, F.concat(F.lit("["), id_, F.lit("]")))
        .when(k == 7, F.concat(F.lit('{"article_id": "'), id_, F.lit('", "labels": "none"}')))
        .when(k == 9, F.concat(F.lit("line "), id_))
    )
    d = D.table(spark, sf, "documents").withColumn("spoiled", spoiled)
    labels = F.struct(F.array(F.col("source")).alias("narrative"), F.array(F.lit("")).alias("subnarrative"))
    folder = work_path(spark, "lines")
    good = d.where("spoiled IS NULL").select(id_.alias("article_id"), F.concat("text", F.lit("\nend")).alias("content"), F.lit(None).cast("string").alias("domain"), labels.alias("labels"))
    K.write_jsonl(good, f"{folder}/good")
    d.where("spoiled IS NOT NULL").select("spoiled").write.text(f"{folder}/spoiled")
    records, rejects = R.read_jsonl_checked(spark, [f"{folder}/good", f"{folder}/spoiled"])
    none = F.lit(None).cast("string")
    kept = records.select("article_id", none.alias("record"), none.alias("reason"), F.length("content").cast("long").alias("n"))
    return kept.unionByName(rejects.select(none.alias("article_id"), "record", "reason", F.lit(None).cast("long").alias("n")))


@register(
    "tsv_rejects",
    """WITH l AS (SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN doc_id || chr(9) || source WHEN 3 THEN doc_id || chr(9) || source || chr(9) || lang || chr(9) || 'x' END AS bad,
  source, lang FROM documents)
SELECT CASE WHEN bad IS NULL THEN CAST(doc_id AS VARCHAR) END AS article_id, CASE WHEN bad IS NULL THEN source || chr(9) || 'tab' END AS narrative,
  CASE WHEN bad IS NULL THEN lang END AS subnarrative, bad AS record FROM l""",
)
def q_tsv_rejects(spark, sf):
    """Lines with two and four fields among lines with three, one of them quoted."""
    k, tab = F.col("doc_id") % 5, F.lit("\t")
    line = (
        F.when(k == 1, F.concat("doc_id", tab, "source"))
        .when(k == 3, F.concat("doc_id", tab, "source", tab, "lang", F.lit("\tx")))
        .otherwise(F.concat("doc_id", F.lit('\t"'), "source", F.lit('\ttab"\t'), "lang"))
    )
    path = work_path(spark, "lines.tsv")
    D.table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    records, rejects = R.read_quoted_checked(spark, path)
    none = F.lit(None).cast("string")
    return records.select("article_id", "narrative", "subnarrative", none.alias("record")).unionByName(
        rejects.select(none.alias("article_id"), none.alias("narrative"), none.alias("subnarrative"), "record")
    )


@register(
    "quoted_tsv_round_trip",
    f"""WITH {_CELLS_SQL} SELECT article_id, 'a' || chr(9) || replace(content, chr(10), ';') AS narrative, domain AS subnarrative FROM cells""",
)
def q_quoted_tsv_round_trip(spark, sf):
    cells = _cells(spark, sf).select(
        "article_id",
        F.concat(F.lit("a\t"), F.replace("content", F.lit("\n"), F.lit(";"))).alias("narrative"),
        F.col("domain").alias("subnarrative"),
    )
    line = F.to_csv(F.struct(*cells.columns), {"sep": "\t", "escape": '"', "quoteAll": "true"})
    back = F.from_csv(line, "article_id string, narrative string, subnarrative string", R.QUOTED_TSV)
    return cells.select(back.alias("r")).select("r.*")


@register(
    "raw_tsv_lines",
    f"""WITH {_CELLS_SQL}, l AS (SELECT string_split(article_id || CASE WHEN CAST(article_id AS BIGINT) % 3 = 0 THEN '' ELSE
  chr(9) || replace(content, chr(10), ';') || chr(9) || domain || CASE WHEN CAST(article_id AS BIGINT) % 3 = 1 THEN chr(9) || 'x' || chr(9) ELSE '' END END, chr(9)) AS f FROM cells)
SELECT f[1] AS article_id, f[2] AS narrative, f[3] AS subnarrative, array_to_string(f[4:], '|') AS more FROM l""",
)
def q_raw_tsv_lines(spark, sf):
    """Lines with one, three and five fields."""
    k = F.col("article_id").cast("long") % 3
    tail = F.when(k == 1, F.lit("\tx\t")).otherwise(F.lit(""))
    rest = F.concat(F.lit("\t"), F.replace("content", F.lit("\n"), F.lit(";")), F.lit("\t"), F.col("domain"), tail)
    lines = _cells(spark, sf).select(F.concat("article_id", F.when(k == 0, F.lit("")).otherwise(rest)).alias("value"))
    cells = lines.select(*R.annotation_fields(F.col("value")))
    return cells.withColumn("more", F.array_join("more", "|"))


@register(
    "jsonl_round_trip",
    f"""WITH {_CELLS_SQL} SELECT article_id, content, domain, 'n|' || domain AS narrative, '' AS subnarrative FROM cells""",
)
def q_jsonl_round_trip(spark, sf):
    """K3 / S5 on the whole record, S9 on its nested column kept as text."""
    labels = F.struct(F.array(F.lit("n"), F.col("domain")).alias("narrative"), F.array(F.lit("")).alias("subnarrative"))
    records = _cells(spark, sf).select("*", labels.alias("labels"))
    path = work_path(spark, "records.jsonl")
    K.write_jsonl(records, path)
    back = R.read_jsonl(spark, path, schemas.NESTED_RECORD)
    back = R.parse_struct(back.withColumn("labels", F.to_json("labels")), "labels")
    return back.select(
        "article_id", "content", "domain",
        F.array_join("labels.narrative", "|").alias("narrative"), F.array_join("labels.subnarrative", "|").alias("subnarrative"),
    )


@register(
    "python_literals",
    """SELECT doc_id, text AS first, 'it''s' || chr(10) || source || ' "' || lang || '"' AS second, doc_id % 3 = 0 AS none, 2 AS n FROM documents""",
)
def q_python_literals(spark, sf):
    """Nested cells kept as Python literals (quotes of both kinds, escapes,
    None, a tuple) back to structs."""
    d = D.table(spark, sf, "documents")
    slash = F.replace("text", F.lit("\\"), F.lit("\\\\"))
    said = F.replace(F.replace(F.replace(slash, F.lit("'"), F.lit("\\'")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    second = F.concat(F.lit("'it\\'s\\n"), "source", F.lit(" \\x22"), "lang", F.lit("\"'"))
    sub = F.when(F.col("doc_id") % 3 == 0, F.lit("None")).otherwise(F.lit("('a', \"b\",)"))
    literal = F.concat(F.lit("{'narrative': ['"), said, F.lit("', "), second, F.lit("], 'subnarrative': "), sub, F.lit("}"))
    back = R.parse_struct(d.select("doc_id", literal.alias("labels")), "labels", literal=True)
    return back.select(
        "doc_id", F.get("labels.narrative", F.lit(0)).alias("first"), F.get("labels.narrative", F.lit(1)).alias("second"),
        F.col("labels.subnarrative").isNull().alias("none"), F.size("labels.narrative").alias("n"),
    )


@register(
    "language_of_paths",
    f"""WITH p AS (SELECT doc_id, '/data/' || source || '/' || upper(lang) || CASE doc_id % 5 WHEN 0 THEN '/PT' WHEN 1 THEN '/BG_HI' ELSE '' END AS path FROM documents)
SELECT doc_id, {LANG_SQL.format(x='path')} AS language FROM p""",
)
def q_language_of_paths(spark, sf):
    k = F.col("doc_id") % 5
    end = F.when(k == 0, F.lit("/PT")).when(k == 1, F.lit("/BG_HI")).otherwise(F.lit(""))
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), F.upper("lang"), end)
    return D.table(spark, sf, "documents").select("doc_id", L.language_of(path).alias("language"))


@register(
    "class_vectors",
    f"""WITH {D.SQL_ANNOTATIONS}, s AS (SELECT article_id, string_split(narrative, ';') AS l FROM annotations)
SELECT article_id, concat(CASE WHEN list_contains(l, 'Other') THEN 1 ELSE 0 END,
  CASE WHEN list_contains(l, 'URW: ECONOMY') THEN 1 ELSE 0 END, CASE WHEN list_contains(l, 'CC: PROMO') THEN 1 ELSE 0 END) AS vector FROM s""",
)
def q_class_vectors(spark, sf):
    ann = D.annotations(spark, sf)
    classes = ["Other", "URW: ECONOMY", "CC: PROMO"]
    vector = L.multi_hot(L.split_list("narrative"), classes)
    return ann.select("article_id", F.array_join(F.transform(vector, lambda x: x.cast("string")), "").alias("vector"))


# ---------------------------------------------------------------------------
# Out-of-fold classifier (M1)
# ---------------------------------------------------------------------------

_NB_SQL = rf"""WITH {_fold_sql('documents', 'lang', 'doc_id', cols=', text')},
rows AS (SELECT doc_id AS id, fold AS f, lang AS c,
         list_filter(regexp_split_to_array(lower(text), '[^{_W}]+'), lambda x: x <> '') AS w FROM f),
words AS (SELECT id, f, c, t, count(*) AS n FROM (SELECT id, f, c, unnest(w) AS t FROM rows) GROUP BY ALL),
own AS (SELECT f, c, t, sum(n) AS n FROM words GROUP BY ALL),
total AS (SELECT c, t, sum(n) AS n FROM own GROUP BY ALL),
folds AS (SELECT DISTINCT f FROM rows),
cls AS (SELECT f, c, count(*) AS d, sum(len(w)) AS m FROM rows GROUP BY ALL),
allc AS (SELECT c, sum(d) AS d, sum(m) AS m FROM cls GROUP BY ALL),
train AS (SELECT folds.f, allc.c, allc.d - coalesce(cls.d, 0) AS docs,
                 allc.m - coalesce(cls.m, 0) + (SELECT count(DISTINCT t) FROM own) AS mass
          FROM folds CROSS JOIN allc LEFT JOIN cls ON cls.f = folds.f AND cls.c = allc.c),
base AS (SELECT id, train.c, ln(docs) - len(w) * ln(mass) AS s FROM rows JOIN train USING (f) WHERE docs > 0),
gain AS (SELECT words.id, total.c, sum(words.n * ln(total.n - coalesce(own.n, 0) + 1)) AS g
         FROM words JOIN total USING (t) LEFT JOIN own ON own.f = words.f AND own.c = total.c AND own.t = words.t GROUP BY ALL),
best AS (SELECT id, min({{'s': -round(s + coalesce(g, 0), 9), 'c': base.c}}).c AS p_domains
         FROM base LEFT JOIN gain USING (id, c) GROUP BY id)
SELECT rows.id AS doc_id, rows.c AS lang, CAST(rows.f AS INTEGER) AS fold, p_domains FROM rows LEFT JOIN best USING (id)"""


@register("domain_classifier", _NB_SQL)
def q_domain_classifier(spark, sf):
    docs = D.table(spark, sf, "documents").select("doc_id", "text", "lang")
    d = stored(FO.stratified_folds(docs, "lang", "doc_id"), "folds")
    return IN.out_of_fold_predictions(d, "text", "lang", "doc_id").select("doc_id", "lang", "fold", "p_domains")


@register("trained_classifier")
def q_trained_classifier(spark, sf):
    """The trained variant on the same folds (no SQL: a fitted model; held-out
    accuracy and fold separation are tested)."""
    docs = D.table(spark, sf, "documents").select("doc_id", "text", "lang")
    d = stored(FO.stratified_folds(docs, "lang", "doc_id"), "folds")
    return CL.trained_out_of_fold(d, "text", "lang", "doc_id").select("doc_id", "lang", "fold", "p_domains")
