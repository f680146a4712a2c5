"""End-to-end jobs (the reference's four entry points), built from the
operators. Each returns DataFrames; writing is optional.

* ``annotate``  (E1): label TSV + article texts -> flat CSV / JSON lines,
  with rejects instead of a failing job.
* ``audit``     (E2): outline pages or a taxonomy table + label files ->
  theme / narrative / subnarrative counts per language and gaps.
* ``predict_and_score`` (E3): merged records -> folds -> out-of-fold domain
  -> routed prompts -> model answers -> phrase detection -> metrics.
* ``score_files`` (E4): gold and prediction TSV + class lists -> F1.

Shared prefixes that feed several outputs are written once to the shared
checkpoint folder (``spark.checkpoint.dir``), which also cuts lineage.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plotline.functions import labels as L
from plotline.operators import detect as DT
from plotline.operators import folds as FO
from plotline.operators import infer as IN
from plotline.operators import labels as LB
from plotline.operators import score as SC
from plotline.operators import taxonomy as TX
from plotline.session import checkpoint_dir, work_path
from plotline.sources import readers as R
from plotline.sources import sinks as K
from plotline.sources.readers import read_results

MISSING_TEXT = "article text missing"
COUNTS = ("decoded", "rejected", "missing")
_RELEASE_LANG = r"([^/]+)/([^/]+)/[^/]+$"


def annotate(
    spark: SparkSession,
    annotations_path,
    articles_root: str,
    out_csv: str | None = None,
    out_jsonl: str | None = None,
    domain_from: str = "subnarrative",
    partition_by: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """E1. Lines are matched to articles by (release, language, article id)
    taken from ``{root}/{release}/{lang}/subtask-2-annotations.txt``.
    ``partition_by`` (e.g. ``("release", "lang")``) writes the JSON lines
    in folders per value, so later reads prune by path. ``counts`` has the numbers
    of lines ``decoded``, ``rejected`` and ``missing`` an article; with an output
    they come from the pass that writes, without another scan."""
    lines = R.read_annotations(spark, annotations_path)
    lines = lines.select(
        "article_id",
        "narrative",
        "subnarrative",
        F.regexp_extract("file_path", _RELEASE_LANG, 1).alias("release"),
        F.regexp_extract("file_path", _RELEASE_LANG, 2).alias("lang"),
    )
    articles = R.read_articles(spark, articles_root)
    joined = R.join_articles(lines, articles, keys=("release", "lang", "article_id"))
    decoded = LB.decode(joined, domain_from=domain_from)
    lost = F.when(F.col("content").isNull(), F.lit(MISSING_TEXT)).otherwise(F.col("reject_reason"))
    decoded = decoded.withColumn("reject_reason", lost)
    counts = None
    if out_csv or out_jsonl:
        # every output shares the read, join and decode: written once to the shared
        # checkpoint folder, and counted by that write
        seen, why = Observation(), F.col("reject_reason")
        n_missing = F.count_if(why == MISSING_TEXT)
        decoded = decoded.observe(
            seen, F.count_if(why.isNull()).alias("decoded"), (F.count_if(why.isNotNull()) - n_missing).alias("rejected"), n_missing.alias("missing")
        )
        path = work_path(spark, "decoded")
        decoded.write.parquet(path)
        decoded = spark.read.schema(decoded.schema).parquet(path)
        counts = spark.createDataFrame([tuple(seen.get[c] for c in COUNTS)], ", ".join(f"{c} long" for c in COUNTS))
    if counts is None:
        why = F.col("reject_reason")
        counts = decoded.agg(
            F.count_if(why.isNull()).alias("decoded"), F.count_if(why != MISSING_TEXT).alias("rejected"), F.count_if(why == MISSING_TEXT).alias("missing")
        )
    good, bad = LB.split_rejects(decoded)
    rejects = bad.select("release", "lang", "article_id", "reject_reason")
    flat = LB.flat_records(good)
    nested = LB.nested_records(good)
    if out_csv:
        K.write_csv(flat, out_csv)
    if out_jsonl:
        K.write_jsonl(LB.nested_records(good, keep=partition_by), out_jsonl, partition_by=partition_by)
    return {"flat": flat, "nested": nested, "rejects": rejects, "counts": counts}


def audit(
    spark: SparkSession,
    annotations_root: str,
    taxonomy: DataFrame | None = None,
    outline_pages: DataFrame | None = None,
    columns: str = "both",
    by_theme: bool = False,
    release: str | None = None,
    out_dir: str | None = None,
) -> dict[str, DataFrame]:
    """E2. Give either a taxonomy table or outline pages (parsed with W2 / W3).
    ``release`` keeps only label files under that release folder (Q5: the
    reference counts every nested release); ``columns`` picks the label
    cells counted."""
    if taxonomy is None:
        if outline_pages is None:
            raise ValueError("give a taxonomy or outline pages")
        taxonomy = TX.outline_taxonomy(outline_pages)
    checkpoint_dir(spark)
    taxonomy = taxonomy.checkpoint()  # parsed once, read by every output
    lines = R.read_annotations(spark, annotations_root, recursive=True)
    if release is not None:
        # the folder below the root, not one that the root itself lies in
        below = F.element_at(F.split("file_path", re.escape(quote(annotations_root.rstrip("/"), safe="/:")) + "/", 2), -1)
        lines = lines.where(F.concat(F.lit("/"), below).contains(f"/{quote(release)}/"))
    cube = TX.label_cube(lines, columns=columns).checkpoint()  # small, read five times
    nar = TX.narrative_counts(cube, taxonomy, by_theme)
    sub = TX.subnarrative_counts(cube, taxonomy, by_theme)
    out = {
        "theme_counts": TX.theme_counts(cube),
        "theme_totals": TX.theme_rollup(cube),
        "narrative_counts": nar,
        "subnarrative_counts": sub,
        "narrative_gaps": TX.narrative_gaps(taxonomy, nar),
        "subnarrative_gaps": TX.subnarrative_gaps(taxonomy, sub),
        "narrative_gaps_by_language": TX.gaps_by_language(taxonomy, nar, cube, "narrative"),
        "subnarrative_gaps_by_language": TX.gaps_by_language(taxonomy, sub, cube, "subnarrative"),
        "taxonomy": taxonomy,
        "rejects": TX.label_rejects(lines, columns=columns),
    }
    if out_dir:
        for name, df in out.items():
            K.write_csv(df, f"{out_dir}/{name}", quote_all=False)
    return out


def answered_once(
    todo: DataFrame, answer: Callable[[DataFrame], DataFrame], id_col: str, output_col: str, results: str,
    finished: DataFrame | None = None,
) -> DataFrame:
    """J8 + K6: ``id, output`` of every row of ``todo``, each answered once.

    Answers in the Parquet folder ``results`` and in ``finished`` (id and
    output) are kept; ``answer`` gets the other rows, and its answers are
    appended to ``results`` in one write. What is returned is read back from
    there, so no later use runs the model again, and a rerun goes on."""
    spark = todo.sparkSession
    old = read_results(spark, results)
    kept = [x.select(id_col, output_col) for x in (old, finished) if x is not None]
    done = None
    for x in kept:
        done = x if done is None else done.unionByName(x.join(done.select(id_col), id_col, "left_anti").select(id_col, output_col))
    if done is not None:
        done = done.join(todo.select(id_col), id_col, "left_semi").select(id_col, output_col).checkpoint()
    K.append_batch(answer(IN.pending(todo, done, id_col)).select(id_col, output_col), results)
    new = spark.read.parquet(results).select(id_col, output_col)
    if done is None:
        return new
    return done.unionByName(new.join(done.select(id_col), id_col, "left_anti").select(id_col, output_col))


def predict_and_score(
    spark: SparkSession,
    merged: DataFrame,
    taxonomy: DataFrame,
    model: Callable[[list[str]], list[str]] = IN.length_stub,
    k: int = 5,
    seed: int = 42,
    finished: DataFrame | None = None,
    id_col: str = "article_id",
    text_col: str = "content",
    results: str | None = None,
    out_dir: str | None = None,
) -> dict[str, DataFrame]:
    """E3 on merged records (``article_id, content, domain, labels, ...``).

    The model is called once per article without an answer; answers go to the
    Parquet folder ``results`` (default: a new one below the checkpoint
    folder). ``finished`` (id, gpt_output) gives earlier answers. Every article
    is predicted and scored. A ``position`` in the taxonomy orders the prompt
    options. ``out_dir`` takes the fold predictions, the results table and
    the metrics log."""
    d = LB.with_class(merged, "domain", "class_id")
    d = FO.stratified_folds(d, "class_id", id_col, k=k, seed=seed)
    base = checkpoint_dir(spark)
    d = d.checkpoint()  # read by the classifier and by its predictions
    oof = IN.out_of_fold_predictions(d, text_col, "class_id", id_col).checkpoint()
    fold_metrics = SC.class_metrics(oof, "class_id", "p_domains", keys=["fold"])
    long = SC.with_metric_means(SC.metrics_long(fold_metrics, keys=["fold"]))
    order = "position" if "position" in taxonomy.columns else None
    prompts = IN.route_prompts(oof, taxonomy, text_col=text_col, class_col="p_domains", order=order)
    answers = answered_once(
        prompts,
        lambda todo: IN.answer_routed(todo, model, id_col),
        id_col,
        "gpt_output",
        results or f"{base.rstrip('/')}/answers-{uuid.uuid4().hex}",
        finished,
    )
    detected = DT.detect(
        oof.join(answers, id_col), taxonomy, id_col=id_col, text_col="gpt_output", class_col="p_domains"
    ).checkpoint()
    sides = None
    for level in ("narrative", "subnarrative"):
        x = detected.select(
            F.lit(level).alias("level"), id_col, F.col(f"labels.{level}").alias("gold"), F.col(f"p_{level}").alias("pred")
        )
        sides = x if sides is None else sides.unionByName(x)
    out = {
        "folds": d,
        "predictions": detected,
        "fold_metrics": long,
        "metrics": SC.sample_prf(sides, ["level"], id_col),
        "other_counts": DT.other_counts(detected),
        "metrics_log": K.metrics_log_lines(long),
    }
    if out_dir:
        K.write_jsonl(oof, f"{out_dir}/fold_predictions", partition_by=("fold",))
        K.write_jsonl(detected, f"{out_dir}/results")
        out["metrics_log"].orderBy("block", "pos").select("line").write.mode("overwrite").text(f"{out_dir}/metrics_log")
    return out


def translate_table(
    spark: SparkSession,
    records: DataFrame,
    model: Callable[[list[str]], list[str]],
    results: str,
    id_col: str = "article_id",
    text_col: str = "content",
    lang_col: str = "language",
) -> DataFrame:
    """Every record with ``en_content``. Languages that pass through
    keep their text; the others are translated once, in ``results``."""
    checkpoint_dir(spark)
    answers = answered_once(
        records, lambda todo: IN.translate(todo, model, id_col, text_col, lang_col), id_col, "en_content", results
    )
    return records.join(answers, id_col, "left")


def merge_languages(
    spark: SparkSession, paths: list[str], out_jsonl: str | None = None, out_rejects: str | None = None
) -> DataFrame:
    """The nested records of several languages as one table with
    combined labels and language. Lines that are no such record are left out and
    go to ``out_rejects`` (JSON lines: file, line, reason)."""
    records, rejects = R.read_jsonl_checked(spark, paths)
    merged = LB.merge_records(records)
    if out_jsonl:
        K.write_jsonl(merged, out_jsonl)
    if out_rejects:
        K.write_jsonl(rejects, out_rejects)
    return merged


def score_files(
    spark: SparkSession,
    prediction_file: str,
    gold_file: str,
    classes_coarse: str,
    classes_fine: str,
    strict: bool = True,
) -> DataFrame:
    """``level, f1_mean, f1_sd, n`` for coarse (narrative) and fine
    (subnarrative) labels. Every line must have three fields and ids must match
    (J4) unless ``strict`` is off; then other lines and ids are left out."""
    gold, bad_gold = R.read_quoted_checked(spark, gold_file)
    pred, bad_pred = R.read_quoted_checked(spark, prediction_file)
    if strict:
        if seen := bad_gold.unionByName(bad_pred).limit(1).collect():
            raise ValueError(f"a line that has not three fields in {seen[0]['file_path']}: {seen[0]['record'][:200]}")
        SC.check_alignment(gold, pred)
    out = None
    for level, col, path in (("coarse", "narrative", classes_coarse), ("fine", "subnarrative", classes_fine)):
        g = gold.select("article_id", L.split_list(col).alias("labels"))
        p = pred.select("article_id", L.split_list(col).alias("labels"))
        per = SC.sample_f1_by_class_list(SC.align(g, p), R.read_class_list(spark, path))
        s = SC.summarize_f1(per).select(F.lit(level).alias("level"), "*")
        out = s if out is None else out.unionByName(s)
    return out
