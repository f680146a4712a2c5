"""Physical plan checks for every registered query: no Cartesian product,
nested-loop joins only where a phrase table is broadcast, scans pruned to the
columns a query needs."""

import contextlib
import io
import os
import re
import subprocess
import sys

import pytest

from plotline.plans import catalog

SF = "/root/testdata/sf0.001"
E_PATH = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(q(spark, SF)) for name, q in catalog.QUERIES.items()}


def test_no_cartesian_product(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name


def test_no_nested_loop(plans):
    for name, p in plans.items():
        assert "BroadcastNestedLoopJoin" not in p, name


def test_final_scores_are_not_grouped_by_label(spark):
    """Without broadcasts, the class list is joined on (level, label), and the
    last per-article aggregate gets its rows by article."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(catalog.QUERIES["scorer_f1"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert re.search(r"hashpartitioning\(level#\d+, article_id#\d+, ", p)


def test_spread_leaves_split_inputs_alone(spark, tmp_path):
    from plotline.operators.joins import spread

    spark.range(5400).coalesce(1).write.parquet(str(tmp_path / "one"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = spark.read.parquet(str(tmp_path / "one"))
        n = df.rdd.getNumPartitions()
        assert n > 8 and spread(df, 4).rdd.getNumPartitions() == n
        assert spread(spark.range(10).coalesce(1), 4).rdd.getNumPartitions() == 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_queries_prove_something(spark):
    """The label views have rejects, gaps of every kind and phrase hits."""
    sf = "/root/testdata/sf0.01"
    rows = {n: catalog.QUERIES[n](spark, sf).collect() for n in (
        "label_rejects", "narrative_gaps", "subnarrative_gaps", "subnarrative_gaps_by_theme", "narrative_gaps_by_language",
        "subnarrative_gaps_by_language", "detect_phrases", "other_counts")}
    assert all(rows.values())
    assert {r["subnarrative"] for r in rows["subnarrative_gaps"]} - {"Other"}
    assert len(rows["subnarrative_gaps_by_theme"]) > len(rows["subnarrative_gaps"])
    assert sum(r["p_narrative"] != "Other" for r in rows["detect_phrases"]) > 10
    assert rows["other_counts"][0]["n_with_labels"] > 10 and rows["other_counts"][0]["n_all_other"] > 10


def test_model_query_from_another_folder(tmp_path):
    """Functions of the package reach the workers without the package."""
    code = (
        "import importlib.util, sys\n"
        f"spec = importlib.util.spec_from_file_location('__spark_entry__', {E_PATH!r})\n"
        "e = importlib.util.module_from_spec(spec); spec.loader.exec_module(e)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('ROWS', e.queries()['routed_answers'](s, {SF!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200" in out.stdout, out.stderr[-2000:]


def test_lineitem_scans_are_pruned(plans):
    unused = {"l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity", "l_extendedprice"}
    seen = 0
    for name, p in plans.items():
        for schema in re.findall(r"lineitem\.parquet\]\n(?:.*\n){0,3}?ReadSchema: struct<([^>]*)>", p):
            cols = {c.split(":")[0] for c in schema.split(",")}
            assert not cols & unused, (name, cols)
            seen += 1
    assert seen >= 10


def test_documents_text_read_only_when_needed(plans):
    text_free = {"stratified_folds", "fold_value_counts", "id_alignment", "ids_without_result"}
    for name in text_free:
        for schema in re.findall(r"documents\.parquet\]\n(?:.*\n){0,3}?ReadSchema: struct<([^>]*)>", plans[name]):
            assert "text:" not in schema, name
