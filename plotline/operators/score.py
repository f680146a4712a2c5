"""Multi-label and class scoring.

Gold and prediction tables carry an id and a ``labels`` array. Sides are
joined on the id (Q9: never by row order). All set metrics go through one
operator, ``set_counts_flagged``, on (id, label) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AlignmentError(ValueError):
    pass


def _ids(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(id_col)


def repeated_ids(df: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Q11: ids given more than once."""
    return df.groupBy(id_col).count().where(F.col("count") > 1).select(id_col, "count")


def mistaken_ids(pred: DataFrame, gold: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Ids only in the predictions."""
    return _ids(pred, id_col).join(_ids(gold, id_col), id_col, "left_anti")


def alignment(gold: DataFrame, pred: DataFrame, id_col: str = "article_id") -> DataFrame:
    """``n_gold, n_pred, n_common`` (id sets)."""
    g = _ids(gold, id_col).distinct().withColumn("__g", F.lit(1))
    p = _ids(pred, id_col).distinct().withColumn("__p", F.lit(1))
    j = g.join(p, id_col, "full")
    return j.agg(
        F.count("__g").alias("n_gold"),
        F.count("__p").alias("n_pred"),
        F.count_if(F.col("__g").isNotNull() & F.col("__p").isNotNull()).alias("n_common"),
    )


def misaligned_ids(gold: DataFrame, pred: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Every offending id with its ``problem``: ``only gold``,
    ``only predicted`` or ``repeated`` (on either side)."""
    g = gold.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_gold"))
    p = pred.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_pred"))
    problem = (
        F.when(F.col("n_pred").isNull(), F.lit("only gold"))
        .when(F.col("n_gold").isNull(), F.lit("only predicted"))
        .when((F.col("n_gold") > 1) | (F.col("n_pred") > 1), F.lit("repeated"))
    )
    return g.join(p, id_col, "full").select(id_col, problem.alias("problem")).where(F.col("problem").isNotNull())


def check_alignment(gold: DataFrame, pred: DataFrame, id_col: str = "article_id") -> None:
    """J4 + Q11: raise when an id is repeated or on one side only. The error's
    ``ids`` is the table of all of them; its text gives their numbers and an
    example each."""
    bad = misaligned_ids(gold, pred, id_col)
    seen = bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("id")).orderBy("problem").collect()
    if seen:
        error = AlignmentError("; ".join(f"{r['n']} ids {r['problem']}, e.g. {r['id']}" for r in seen))
        error.ids = bad
        raise error


def align(gold: DataFrame, pred: DataFrame, id_col: str = "article_id", labels: str = "labels") -> DataFrame:
    """``id, gold, pred`` by id (inner join; run ``check_alignment`` for the
    strict reference behaviour)."""
    g = gold.select(F.col(id_col), F.col(labels).alias("gold"))
    p = pred.select(F.col(id_col), F.col(labels).alias("pred"))
    return g.join(p, id_col, "inner")


# --------------------------------------------------------------------------
# Sample F1 over a fixed class list (scorer variant)
# --------------------------------------------------------------------------

def sample_f1_by_class_list(
    aligned: DataFrame, classes: DataFrame, id_col: str = "article_id", keys=()
) -> DataFrame:
    """Per article ``keys..., id, n_gold, n_pred, tp, f1``: labels outside
    ``classes`` (column ``class``, plus ``keys`` when the class list differs
    per key) are ignored, repeats count once (P21, F5); F1 is 0 when both
    sides are empty."""
    return f1_from_counts(set_counts_aligned(aligned, id_col, keys, classes))


def set_counts_aligned(
    aligned: DataFrame, id_col: str = "article_id", keys=(), classes: DataFrame | None = None, empty: bool = False
) -> DataFrame:
    """``set_counts_long`` for aligned rows with label arrays. Only labels are
    exploded, never beside their array; a row without labels keeps a row."""
    gold = aligned.select(*keys, id_col, F.explode_outer("gold").alias("label"))
    pred = aligned.select(*keys, id_col, F.explode_outer("pred").alias("label"))
    return set_counts_long(gold, pred, id_col, keys, classes, empty)


def set_counts_long(
    gold: DataFrame, pred: DataFrame, id_col: str = "article_id", keys=(), classes: DataFrame | None = None,
    empty: bool = False,
) -> DataFrame:
    """Per ``keys..., id``: ``n_gold, n_pred, tp`` over distinct labels, from
    long tables ``keys..., id, label`` (one row per label occurrence). See
    ``set_counts_flagged``."""
    occ = gold.select(*keys, id_col, "label", F.lit(True).alias("in_gold"), F.lit(False).alias("in_pred")).unionByName(
        pred.select(*keys, id_col, "label", F.lit(False).alias("in_gold"), F.lit(True).alias("in_pred"))
    )
    return set_counts_flagged(occ, id_col, keys, classes, empty=empty)


def set_counts_flagged(
    occ: DataFrame, id_col: str = "article_id", keys=(), classes: DataFrame | None = None,
    gold_flag: str = "in_gold", pred_flag: str = "in_pred", empty: bool = False,
) -> DataFrame:
    """Per ``keys..., id``: ``n_gold, n_pred, tp`` over distinct labels, from
    one long table ``keys..., id, label, in_gold, in_pred`` (a label row may
    be on both sides, so gold and prediction come from one pass).

    Nothing is gathered per article: (id, label) rows are aggregated
    (map-side combined), so one article with very many labels is spread over
    tasks. With ``classes`` (column ``class``, plus any of ``keys``) unknown
    labels are ignored; without, empty labels are (unless ``empty``). Every id seen gets a row
    (zeros when it has no known label)."""
    keys = list(keys)
    # distinct (id, label) rows first: they spread a hot label over tasks before
    # the class list is joined, and the last aggregate is by id
    per_label = occ.groupBy(*keys, id_col, "label").agg(
        F.max(F.col(gold_flag).cast("int")).alias("g"), F.max(F.col(pred_flag).cast("int")).alias("p")
    )
    if classes is not None:
        cls_keys = [c for c in keys if c in classes.columns]
        cls = classes.where(F.col("class").isNotNull() & (F.col("class") != "")).select(
            *cls_keys, F.col("class").alias("label"), F.lit(1).alias("known")
        ).distinct()
        per_label = per_label.join(cls, [*cls_keys, "label"], "left")
        known = F.coalesce("known", F.lit(0))
    else:
        named = F.col("label").isNotNull() if empty else F.coalesce(F.col("label") != "", F.lit(False))
        known = named.cast("int")
    g, p = F.col("g") * known, F.col("p") * known
    return per_label.groupBy(*keys, id_col).agg(F.sum(g).alias("n_gold"), F.sum(p).alias("n_pred"), F.sum(g * p).alias("tp"))


def f1_from_counts(counts: DataFrame) -> DataFrame:
    """Adds sample ``f1`` (0 when both sides are empty)."""
    den = F.col("n_gold") + F.col("n_pred")
    return counts.withColumn("f1", F.when(den > 0, 2.0 * F.col("tp") / den.cast("double")).otherwise(0.0))


def prf_from_counts(counts: DataFrame, keys=()) -> DataFrame:
    """A8 from per-row counts: averaged ``precision, recall, f1, n``."""
    tp, ng, np_ = (F.col(c).cast("double") for c in ("tp", "n_gold", "n_pred"))
    per = counts.select(
        *keys,
        F.when(np_ > 0, tp / np_).otherwise(0.0).alias("p"),
        F.when(ng > 0, tp / ng).otherwise(0.0).alias("r"),
        F.when(ng + np_ > 0, 2.0 * tp / (ng + np_)).otherwise(0.0).alias("f"),
    )
    return per.groupBy(*keys).agg(
        F.avg("p").alias("precision"), F.avg("r").alias("recall"), F.avg("f").alias("f1"), F.count(F.lit(1)).alias("n")
    )


def set_metrics(
    occ: DataFrame, classes: DataFrame, id_col: str = "article_id", level: str = "level", fold: str = "fold",
    gold_flag: str = "in_gold", pred_flag: str = "in_pred", all_label: str = "all",
) -> DataFrame:
    """A7, A8, A12 in one pass: ``level, fold, f1_mean, f1_sd, precision, recall, f1,
    n, n_labels`` for every (level, fold), and for every level over all folds (fold
    ``all``), from one long table ``level, fold, id, label, in_gold, in_pred``.

    The distinct (level, id, label) rows are made once. ``f1_mean`` and ``f1_sd``
    count the labels of ``classes`` (``level, class``) only, ``precision``, ``recall``
    and ``f1`` all labels that are not empty; ``n_labels`` is the number of those
    observed. Grouping sets, not a query for each figure."""
    named = F.coalesce(F.col("label") != "", F.lit(False)).cast("int")
    cls = classes.where(F.col("class").isNotNull() & (F.col("class") != "")).select(level, F.col("class").alias("label"), F.lit(1).alias("known")).distinct()
    rows = occ.groupBy(level, fold, id_col, "label").agg(
        F.max(F.col(gold_flag).cast("int")).alias("g"), F.max(F.col(pred_flag).cast("int")).alias("p")
    )
    rows = rows.join(cls, [level, "label"], "left").withColumns({"known": F.coalesce("known", F.lit(0)), "named": named})
    sums = {}
    for kind in ("known", "named"):
        g, p = F.col("g") * F.col(kind), F.col("p") * F.col(kind)
        sums |= {f"{kind}_g": F.sum(g), f"{kind}_p": F.sum(p), f"{kind}_tp": F.sum(g * p)}
    # the figures of an article, and below them a row for each label that is observed
    # in a fold: labels are counted where articles are averaged
    per_id = rows.groupBy(level, fold, id_col).agg(*[c.alias(k) for k, c in sums.items()])
    f, a, b, tp = (lambda k: F.col(k).cast("double")), "named_g", "named_p", "named_tp"
    known = f("known_g") + f("known_p")
    figures = per_id.select(
        level, fold,
        F.when(known > 0, 2.0 * f("known_tp") / known).otherwise(0.0).alias("known_f1"),
        F.when(f(b) > 0, f(tp) / f(b)).otherwise(0.0).alias("precision"),
        F.when(f(a) > 0, f(tp) / f(a)).otherwise(0.0).alias("recall"),
        F.when(f(a) + f(b) > 0, 2.0 * f(tp) / (f(a) + f(b))).otherwise(0.0).alias("f1"),
    )
    figures = figures.groupingSets([[level, fold], [level]], level, fold).agg(
        F.avg("known_f1").alias("f1_mean"), F.stddev_pop("known_f1").alias("f1_sd"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.count(F.lit(1)).alias("n"), F.grouping(fold).alias("__g"),
    )
    observed = rows.where("named = 1").groupBy(level, fold, "label").agg(F.lit(1).alias("seen"))
    labels = observed.groupingSets([[level, fold], [level]], level, fold).agg(F.count_distinct("label").alias("n_labels"), F.grouping(fold).alias("__g"))
    out = figures.join(labels, on=same_group(figures, labels, [level, fold, "__g"]), how="left")
    return out.select(
        figures[level], F.when(figures["__g"] == 1, F.lit(all_label)).otherwise(figures[fold].cast("string")).alias(fold),
        "f1_mean", "f1_sd", "precision", "recall", "f1", "n", F.coalesce("n_labels", F.lit(0)).alias("n_labels"),
    )


def same_group(left: DataFrame, right: DataFrame, columns: list[str]):
    """Null-safe equality of the columns."""
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(right[c])
    return on


def summarize_f1(per_article: DataFrame, keys=()) -> DataFrame:
    """``keys..., f1_mean, f1_sd`` (population sd) and ``n``."""
    return per_article.groupBy(*keys).agg(
        F.avg("f1").alias("f1_mean"),
        F.stddev_pop("f1").alias("f1_sd"),
        F.count(F.lit(1)).alias("n"),
    )


# --------------------------------------------------------------------------
# Samples-averaged precision, recall, F1 over observed labels
# --------------------------------------------------------------------------

def sample_prf(aligned: DataFrame, keys=(), id_col: str = "article_id") -> DataFrame:
    """Per-row set metrics, averaged (per ``keys``): ``precision, recall,
    f1, n``. Undefined values count as 0 (the library default)."""
    return prf_from_counts(set_counts_aligned(aligned, id_col, keys, empty=True), keys)


def observed_labels(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Every non-empty ``label`` of the long tables gold and predictions."""
    both = gold.select("label").union(pred.select("label"))
    return both.where(F.col("label") != "").distinct()


# --------------------------------------------------------------------------
# Single-label class metrics
# --------------------------------------------------------------------------

def class_counts(df: DataFrame, true_col: str = "label", pred_col: str = "pred", keys=()) -> DataFrame:
    """Per class (and ``keys``): ``tp, n_true, n_pred`` in one pass (each
    row adds to its true class and to its predicted class)."""
    keys = list(keys)
    sides = F.explode(
        F.array(
            F.struct(F.col(true_col).alias("class"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                     (F.col(true_col) == F.col(pred_col)).cast("int").alias("tp")),
            F.struct(F.col(pred_col).alias("class"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("tp")),
        )
    )
    return (
        df.select(*keys, sides.alias("s"))
        .select(*keys, "s.*")
        .groupBy(*keys, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"))
    )


def class_metrics(df: DataFrame, true_col: str = "label", pred_col: str = "pred", keys=()) -> DataFrame:
    """Accuracy and macro precision / recall / F1 over classes seen on
    either side; undefined precision or recall counts as 1."""
    keys = list(keys)
    c = class_counts(df, true_col, pred_col, keys)
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(1.0)
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(1.0)
    f1 = 2.0 * F.col("tp") / (F.col("n_pred") + F.col("n_true"))
    return c.groupBy(*keys).agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        F.avg(prec).alias("precision"),
        F.avg(rec).alias("recall"),
        F.avg(f1).alias("f1"),
    )


METRICS = ("accuracy", "precision", "recall", "f1")


def metrics_long(wide: DataFrame, keys=("fold",)) -> DataFrame:
    """``keys..., metric, value`` from a wide metric row per key."""
    stack = F.expr(
        "stack({n}, {pairs}) as (metric, value)".format(
            n=len(METRICS), pairs=", ".join(f"'{m}', cast({m} as double)" for m in METRICS)
        )
    )
    return wide.select(*keys, stack)


def metric_means(long: DataFrame) -> DataFrame:
    """A10: mean of each metric over folds."""
    return long.groupBy("metric").agg(F.avg("value").alias("value"))


def with_metric_means(long: DataFrame, fold_col: str = "fold", avg_label: str = "avg") -> DataFrame:
    """Per-fold rows plus one ``avg`` row per metric, in one pass (grouping
    sets over (metric, fold) and (metric)); ``fold`` becomes a string."""
    r = long.rollup("metric", fold_col).agg(F.avg("value").alias("value"), F.grouping_id().alias("__g"))
    return r.where(F.col("__g") < 3).select(
        F.when(F.col("__g") == 1, F.lit(avg_label)).otherwise(F.col(fold_col).cast("string")).alias(fold_col),
        "metric",
        "value",
    )
