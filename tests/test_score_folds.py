"""Scoring (J4, J5, A7, A8, A9, A15) and folds."""

import pytest
from pyspark.sql import functions as F

from plotline.operators import folds as FO
from plotline.operators import score as SC

GOLD = [("1", ["a", "b"]), ("2", ["c"]), ("3", ["z"])]
PRED = [("1", ["a"]), ("2", ["a", "b"]), ("3", ["z"])]
SCHEMA = "article_id string, labels array<string>"


def sides(spark, gold=GOLD, pred=PRED):
    return spark.createDataFrame(gold, SCHEMA), spark.createDataFrame(pred, SCHEMA)


def test_class_list_f1(spark):
    g, p = sides(spark)
    classes = spark.createDataFrame([("a",), ("b",), ("c",), ("",)], "class string")
    per = SC.sample_f1_by_class_list(SC.align(g, p), classes)
    f1 = {r["article_id"]: r["f1"] for r in per.collect()}
    assert f1 == pytest.approx({"1": 2 / 3, "2": 0.0, "3": 0.0})
    s = SC.summarize_f1(per).first()
    assert s["f1_mean"] == pytest.approx(0.222222, abs=1e-6)
    assert s["f1_sd"] == pytest.approx(0.314270, abs=1e-6)
    assert s["n"] == 3


def test_observed_label_prf(spark):
    g, p = sides(spark)
    s = SC.sample_prf(SC.align(g, p)).first()
    assert s["f1"] == pytest.approx(0.555556, abs=1e-6)
    assert s["precision"] == pytest.approx(0.666667, abs=1e-6)
    assert s["recall"] == pytest.approx(0.5)


def test_order_does_not_matter(spark):
    g, p = sides(spark, pred=list(reversed(PRED)))
    s = SC.sample_prf(SC.align(g, p)).first()
    assert s["f1"] == pytest.approx(0.555556, abs=1e-6)  # Q9 fixed


def test_swap_swaps_precision_recall(spark):
    g, p = sides(spark)
    a = SC.sample_prf(SC.align(g, p)).first()
    b = SC.sample_prf(SC.align(p, g)).first()
    assert a["precision"] == pytest.approx(b["recall"]) and a["recall"] == pytest.approx(b["precision"])


def test_perfect_prediction_scores_one(spark):
    g, _ = sides(spark)
    classes = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "class string")
    s = SC.summarize_f1(SC.sample_f1_by_class_list(SC.align(g, g), classes)).first()
    assert s["f1_mean"] == pytest.approx(1.0)


def test_missing_id_raises(spark):
    g, p = sides(spark, pred=PRED[:2])
    with pytest.raises(SC.AlignmentError, match="3"):
        SC.check_alignment(g, p)
    a = SC.alignment(g, p).first()
    assert (a["n_gold"], a["n_pred"], a["n_common"]) == (3, 2, 2)


def test_repeated_id_raises(spark):
    g, p = sides(spark, pred=PRED + [("1", ["b"])])
    with pytest.raises(SC.AlignmentError, match="repeated"):
        SC.check_alignment(g, p)


def test_class_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, pred int")
    m = SC.class_metrics(df).first()
    assert m["accuracy"] == pytest.approx(0.5)
    assert m["precision"] == pytest.approx(0.777778, abs=1e-6)
    assert m["recall"] == pytest.approx(0.5)
    assert m["f1"] == pytest.approx(0.388889, abs=1e-6)


def test_metric_means(spark):
    wide = spark.createDataFrame(
        [(1, 0.5, 0.5, 0.5, 0.5), (2, 1.0, 0.0, 1.0, 0.0)], "fold int, accuracy double, precision double, "
        "recall double, f1 double"
    )
    means = {r["metric"]: r["value"] for r in SC.metric_means(SC.metrics_long(wide)).collect()}
    assert means == pytest.approx({"accuracy": 0.75, "precision": 0.25, "recall": 0.75, "f1": 0.25})


def folds(spark, seed=42):
    rows = [(i, "A") for i in range(7)] + [(100 + i, "B") for i in range(4)]
    df = spark.createDataFrame(rows, "id long, cls string")
    return FO.stratified_folds(df, "cls", "id", k=3, seed=seed)


def test_fold_balance(spark):
    f = folds(spark)
    counts = {(r["fold"], r["cls"]): r["count"] for r in FO.fold_value_counts(f, "cls").collect()}
    assert sorted(counts.get((k, "A"), 0) for k in (1, 2, 3)) == [2, 2, 3]
    assert sorted(counts.get((k, "B"), 0) for k in (1, 2, 3)) == [1, 1, 2]
    sizes = sorted(f.groupBy("fold").count().select("count").toPandas()["count"])
    assert sizes == [3, 4, 4]
    assert f.count() == 11 and f.select("id").distinct().count() == 11


def test_fold_deterministic(spark):
    a = {r["id"]: r["fold"] for r in folds(spark).collect()}
    b = {r["id"]: r["fold"] for r in folds(spark).collect()}
    assert a == b


def test_fold_equals_single_window_definition(spark):
    from pyspark.sql import Window

    df = spark.range(500).select(F.col("id"), (F.col("id") % 3).cast("string").alias("c"))
    got = FO.stratified_folds(df, "c", "id", k=5, seed=1, bucket_hex=1)
    w = Window.partitionBy("c").orderBy(FO.order_key("id", 1), "id")
    ref = df.withColumn("rn", F.row_number().over(w))
    start = df.groupBy("c").count().collect()
    offs, acc = {}, 0
    for r in sorted(start, key=lambda r: r["c"]):
        offs[r["c"]] = acc
        acc += r["count"]
    want = {r["id"]: (offs[r["c"]] + r["rn"] - 1) % 5 + 1 for r in ref.collect()}
    assert {r["id"]: r["fold"] for r in got.collect()} == want


def test_fold_pivot(spark):
    f = folds(spark)
    p = FO.fold_value_counts(f, "cls", pivot=True).orderBy("fold").collect()
    assert [r["A"] + r["B"] for r in p] == [r["count"] for r in f.groupBy("fold").count().orderBy("fold").collect()]


def test_multi_hot(spark):
    from plotline.functions.labels import multi_hot

    df = spark.createDataFrame([(["b", "z", "b"],)], "l array<string>")
    assert df.select(multi_hot("l", ["a", "b", "c"])).first()[0] == [0, 1, 0]


def test_line_and_long_scorers_agree(spark):
    from plotline.functions import labels as L
    from plotline.sources import driver as D

    sf = "/root/testdata/sf0.001"
    gp = D.gold_and_predictions(spark, sf)
    classes = D.theme_abbr_labels(D.taxonomy(spark, sf)).where("level = 'fine'").select("class")
    aligned = gp.select("article_id", L.split_list("subnarrative").alias("gold"), L.split_list("p_subnarrative").alias("pred"))
    a = SC.summarize_f1(SC.sample_f1_by_class_list(aligned, classes)).first()
    items = D.label_items(spark, sf).select("article_id", F.col("sub_label").alias("label"), "l_discount")
    counts = SC.set_counts_long(items.drop("l_discount"), items.where("l_discount >= 0.05").drop("l_discount"),
                                classes=classes)
    b = SC.summarize_f1(SC.f1_from_counts(counts)).first()
    assert a["n"] == b["n"]
    assert a["f1_mean"] == pytest.approx(b["f1_mean"]) and a["f1_sd"] == pytest.approx(b["f1_sd"])
    p1 = SC.sample_prf(aligned.select("article_id", F.array_remove("gold", "").alias("gold"), F.array_remove("pred", "").alias("pred"))).first()
    p2 = SC.prf_from_counts(counts.select("article_id", "tp", "n_gold", "n_pred")).first()
    assert p1["n"] == p2["n"]


def test_fold_sizes_of_the_published_run(spark):
    # T4: 726 rows in 5 folds -> 146, 145, 145, 145, 145 (fold 1 takes the remainder)
    df = spark.range(726).select(F.col("id"), (F.col("id") % 3).alias("c"))
    f = FO.stratified_folds(df, "c", "id", k=5, seed=42)
    sizes = [r["count"] for r in f.groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [146, 145, 145, 145, 145]
