"""Trained classifier, model loading and failing rows, batches of a stream that
are run again, and metrics in one pass."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from plotline.operators import classify as CL
from plotline.operators import detect as DT
from plotline.operators import infer as IN
from plotline.operators import score as SC
from plotline.streaming.resumable import run_resumable


def corpus(seed=1, n=240):
    rng = random.Random(seed)
    own = {"a": "tank army front".split(), "b": "carbon ice warming".split(), "c": "cake flour oven".split()}
    rows = []
    for i in range(n):
        c = "abc"[i % 3]
        rows.append((i, " ".join(rng.choices(own[c] + ["the", "of", "and"], k=12)), c, i % 4 + 1))
    return rows


SCHEMA = "id long, text string, c string, fold int"


def predicted(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.id: r.p_domains for r in CL.trained_out_of_fold(df, "text", "c", "id", iterations=8, features=1 << 12).collect()}


def test_trained_classes_come_from_the_other_folds(spark):
    rows = corpus()
    got = predicted(spark, rows)
    assert sum(got[i] == c for i, _, c, _ in rows) / len(rows) > 0.99
    # other classes for the rows of one fold: its own predictions stay as they are
    turned = [(i, t, {"a": "b", "b": "c", "c": "a"}[c] if f == 2 else c, f) for i, t, c, f in rows]
    again = predicted(spark, turned)
    assert {i: got[i] for i, *_, f in rows if f == 2} == {i: again[i] for i, *_, f in rows if f == 2}


def test_rows_without_class_or_text_are_predicted(spark):
    rows = corpus(n=60) + [(900, "tank army tank", None, 1), (901, None, "a", 2), (902, "", None, 3)]
    got = predicted(spark, rows)
    assert got[900] == "a" and got[901] in "abc" and got[902] in "abc" and len(got) == len(rows)
    one = [(1, "x", "only", 1), (2, "y", "only", 2), (3, "z", None, 1)]
    assert predicted(spark, one) == {1: "only", 2: "only", 3: "only"}
    assert predicted(spark, []) == {}


def test_a_model_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: [t.upper() for t in texts]

    df = spark.range(400).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("t")).repartition(24)
    out = IN.apply_model(df, None, "id", "t", "o", load=load)
    assert {r.o for r in out.collect()} == {f"T{i}" for i in range(400)}
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert 0 < len(loads) == len(set(loads)) < 24


def test_one_failing_text_is_one_row_with_its_error(spark):
    def model(texts):
        assert len(texts) <= 4
        if any(t == "boom" for t in texts):
            raise RuntimeError("no")
        return [t + "!" for t in texts]

    rows = [(i, "boom" if i == 7 else "x" * (i % 9 + 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    got = {r.id: (r.o, r.error) for r in IN.apply_model(df, model, "id", "t", "o", batch_size=4, errors=True).collect()}
    assert got == {i: (None, "RuntimeError: no") if t == "boom" else (t + "!", None) for i, t in rows}
    with pytest.raises(Exception, match="no"):
        IN.apply_model(df, model, "id", "t", "o", batch_size=4).collect()


def test_texts_of_like_length_go_together(spark, tmp_path):
    folder = str(tmp_path)

    def model(texts):
        lengths = [len(t) for t in texts]
        open(f"{folder}/{uuid.uuid4().hex}", "w").write(f"{min(lengths)} {max(lengths)}")
        return texts

    df = spark.createDataFrame([(i, "x" * (i * 37 % 100)) for i in range(100)], "id long, t string").coalesce(1)
    # one task of one Arrow batch
    assert IN.apply_model(df.repartition(1), model, "id", "t", "o", batch_size=10).count() == 100
    spans = [tuple(map(int, p.read_text().split())) for p in tmp_path.iterdir()]
    assert all(b - a <= 100 // 2 for a, b in spans)


def test_a_batch_run_again_leaves_its_answers_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "id string, text string"
    sch = spark.createDataFrame([], schema).schema
    calls = []

    def once(name):
        return lambda ts: calls.extend(ts) or [f"{t} by {name}" for t in ts]

    run = lambda model, check=ck: run_resumable(spark, f"{src}/*", sch, out, model, "id", "text", checkpoint=check, by_epoch=True, errors=True)
    spark.createDataFrame([("1", "a"), ("2", "b")], schema).coalesce(1).write.parquet(f"{src}/p1")
    run(once("first"))
    # killed between the write of a batch and its commit: the batch is run again
    spark.createDataFrame([("3", "c"), ("4", "d")], schema).coalesce(1).write.parquet(f"{src}/p2")
    run(once("first"))
    commits = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    for crc in (tmp_path / "ck" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    run(once("second"))
    res = sorted((r.id, r.output) for r in spark.read.parquet(out).collect())
    assert res == [("1", "a by first"), ("2", "b by first"), ("3", "c by first"), ("4", "d by first")]
    # another checkpoint over the same files keeps every answer
    run(once("third"), str(tmp_path / "ck2"))
    assert sorted((r.id, r.output) for r in spark.read.parquet(out).collect()) == res


def test_rows_with_an_error_are_asked_again(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "id string, text string"
    sch = spark.createDataFrame([], schema).schema
    spark.createDataFrame([("1", "a"), ("2", "boom")], schema).coalesce(1).write.parquet(f"{src}/p1")

    def model(ts):
        if "boom" in ts:
            raise RuntimeError("no")
        return ts

    run_resumable(spark, f"{src}/*", sch, out, model, "id", "text", checkpoint=str(tmp_path / "a"), by_epoch=True, errors=True)
    assert {(r.id, r.output, r.error) for r in spark.read.parquet(out).collect()} == {("1", "a", None), ("2", None, "RuntimeError: no")}
    run_resumable(spark, f"{src}/*", sch, out, lambda ts: ts, "id", "text", checkpoint=str(tmp_path / "b"), by_epoch=True, errors=True)
    rows = [(r.id, r.output) for r in spark.read.parquet(out).where("error IS NULL").collect()]
    assert sorted(rows) == [("1", "a"), ("2", "boom")]


def test_set_metrics_match_the_single_operators(spark):
    rng = random.Random(5)
    names = ["x", "y", "z", "", "unlisted"]
    rows = [(lv, f, f"{lv}{f}{i}", rng.choice(names), rng.random() < 0.7, rng.random() < 0.5) for lv in "pq" for f in (1, 2) for i in range(12) for _ in range(3)]
    occ = spark.createDataFrame(rows, "level string, fold int, article_id string, label string, in_gold boolean, in_pred boolean")
    classes = spark.createDataFrame([("p", "x"), ("p", "y"), ("q", "z"), ("q", "x")], "level string, class string")
    got = {(r.level, r.fold): r for r in SC.set_metrics(occ, classes).collect()}
    assert set(got) == {(lv, f) for lv in "pq" for f in ("1", "2", "all")}
    for keys in (["level", "fold"], ["level"]):
        f1 = SC.summarize_f1(SC.f1_from_counts(SC.set_counts_flagged(occ, keys=keys, classes=classes)), keys)
        prf = SC.prf_from_counts(SC.set_counts_flagged(occ, keys=keys), keys)
        for r in f1.join(prf, keys).collect():
            m = got[r.level, str(r.fold) if "fold" in keys else "all"]
            assert m.f1_mean == pytest.approx(r.f1_mean) and m.f1_sd == pytest.approx(r.f1_sd)
            assert (m.precision, m.recall, m.f1) == pytest.approx((r.precision, r.recall, r.f1))
    seen = {lv: {r[3] for r in rows if r[0] == lv and r[3]} for lv in "pq"}
    assert all(got[lv, "all"].n_labels == len(seen[lv]) for lv in "pq")


def test_phrases_are_looked_up_by_windows(spark):
    docs = spark.createDataFrame([(1, "The Big-Bad wolf. big bad  wolf; BIG bad wolf"), (2, "bigbad"), (3, None), (4, "x -- y")], "id long, text string")
    phrases = spark.createDataFrame([("n", "big bad wolf"), ("n", "Big-Bad"), ("s", "wolf"), ("s", " -- "), ("n", "bad")], "kind string, phrase string")
    got = sorted(tuple(r) for r in DT.find_phrases(docs, phrases, strategy="in_place").collect())
    assert got == [(1, "n", "Big-Bad"), (1, "n", "bad"), (1, "n", "big bad wolf"), (1, "s", "wolf"), (4, "s", " -- ")]
    assert got == sorted(tuple(r) for r in DT.find_phrases(docs, phrases, strategy="shuffled").collect())
