"""The trained classifier's fit against ``pyspark.ml``, what it keeps while it
runs, and what the folds shuffle."""

import random
import threading

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, StringIndexer
from pyspark.sql import functions as F

from plotline.operators import classify as CL
from plotline.operators import folds as FO

SCHEMA = "id long, text string, c string, fold int"
FEATURES, STEPS = 1 << 10, 12


def noisy(classes, n, seed=3):
    """Texts that share many words between classes, some without class, text or words."""
    rng = random.Random(seed)
    own = {c: [f"{c}{k}" for k in range(6)] for c in classes}
    every = [w for x in own.values() for w in x]
    rows = []
    for i in range(n):
        c = rng.choice(classes)
        words = rng.choices(own[c], k=rng.randrange(1, 4)) + rng.choices(every, k=rng.randrange(2, 30))
        rows.append((i, None if i == 5 else "" if i == 6 else " ".join(words), None if i % 17 == 4 else c, i % 3 + 1))
    return rows


def by_pyspark_ml(df):
    """The classes by a ``LogisticRegression`` for each fold."""
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=FEATURES)
    rows = tf.transform(df.withColumn("w", CL.words("text")).withColumn("words", CL.terms("w"))).cache()
    out = {}
    for fold in (1, 2, 3):
        train = rows.where(F.col("c").isNotNull() & (F.col("fold") != fold))
        indexer = StringIndexer(inputCol="c", outputCol="label", stringOrderType="alphabetAsc").fit(train)
        idf, unit = IDF(inputCol="tf", outputCol="weighted").fit(train), Normalizer(inputCol="weighted", outputCol="x")
        fit = LogisticRegression(featuresCol="x", labelCol="label", predictionCol="p", maxIter=STEPS, regParam=1e-6, standardization=False)
        model = fit.fit(unit.transform(idf.transform(indexer.transform(train))))
        # by its coefficients: with two classes the model cannot be sent to tasks after an observation in the session
        weights, free = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        for r in unit.transform(idf.transform(rows.where(F.col("fold") == fold))).select("id", "x").collect():
            z = weights @ r.x.toArray() + free
            out[r.id] = indexer.labels[int(z[0] > 0) if len(z) == 1 else int(z.argmax())]
    rows.unpersist()
    return out


@pytest.mark.parametrize("classes", ["ab", "abcd"])
@pytest.mark.parametrize("parallel", [5, 2])
def test_the_fit_is_that_of_pyspark_ml(spark, monkeypatch, classes, parallel):
    monkeypatch.setattr(CL, "PIECE", 200)  # many pieces and sums
    monkeypatch.setattr(CL, "LOOKUP", 50)
    monkeypatch.setattr(CL, "CHUNK", 1000)
    rows = noisy(list(classes), 150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.id: r.p_domains for r in CL.trained_out_of_fold(df, "text", "c", "id", features=FEATURES, iterations=STEPS, parallel=parallel).collect()}
    right = sum(got[i] == c for i, _, c, _ in rows if c) / len(rows)
    assert 1 / len(classes) < right < 0.98  # some are hard
    assert got == by_pyspark_ml(df)


def test_no_copy_of_the_features_is_kept_while_fitting(spark):
    df = spark.createDataFrame(noisy(list("abc"), 200), SCHEMA).repartition(4)
    kept, over = [0], threading.Event()

    def watch():
        while not over.wait(0.02):
            kept.append(len(spark.sparkContext._jsc.sc().getRDDStorageInfo()))

    before = len(spark.sparkContext._jsc.sc().getRDDStorageInfo())
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        CL.trained_out_of_fold(df, "text", "c", "id", features=FEATURES, iterations=5).collect()
    finally:
        over.set()
        watcher.join()
    assert max(kept) <= before


def test_rows_and_labels_of_other_types(spark):
    rows = [(f"k{i}", t, None if c is None else ord(c), f) for i, t, c, f in noisy(list("ab"), 60)] + [("z", "a1 a2", 97, None)]
    df = spark.createDataFrame(rows, "id string, text string, c int, fold int")
    out = CL.trained_out_of_fold(df, "text", "c", "id", features=1 << 17, iterations=3)
    assert dict(out.dtypes)["p_domains"] == "int"
    got = {r.id: r.p_domains for r in out.collect()}
    assert len(got) == 61 and got.pop("z") is None and set(got.values()) == {97, 98}


def test_without_any_word_the_shares_of_the_classes_decide(spark):
    df = spark.createDataFrame([(i, "" if i % 2 else None, "abbb"[i % 4], i % 3 + 1) for i in range(24)], SCHEMA)
    got = CL.trained_out_of_fold(df, "text", "c", "id", iterations=3).collect()
    assert len(got) == 24 and {r.p_domains for r in got} == {"b"}


def test_folds_shuffle_whole_rows_once(spark):
    rows = [(i, "x" * 50, None if i % 7 == 0 else f"c{i % 3}") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, text string, c string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = FO.stratified_folds(df, "c", "id")
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        assert out.columns == ["id", "text", "c", "fold"] and out.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    moved = [k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line and "text#" in "".join(plan[k + 1 : k + 3])]
    assert len(moved) == 1
    sizes = {(r.c, r.fold): r["count"] for r in out.groupBy("c", "fold").count().collect()}
    for c in {c for c, _ in sizes}:
        own = [sizes.get((c, k), 0) for k in range(1, 6)]
        assert max(own) - min(own) <= 1
