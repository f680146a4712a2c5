"""End-to-end jobs on files laid out like the reference data (E1-E4),
sources and sinks (S1-S9, K1-K6) and the resumable stream."""

import os

import pytest
from pyspark.sql import functions as F

from plotline.plans import jobs
from plotline.sources import readers as R
from plotline.sources import schemas
from plotline.sources import sinks as K
from plotline.streaming.resumable import run_resumable

ANN_EN = (
    "EN_UA_1.txt\tURW: Discrediting Ukraine;URW: Praise of Russia\t"
    "URW: Discrediting Ukraine: Discrediting Ukrainian military;URW: Praise of Russia: Other\n"
    "EN_2.txt\tOther\tOther\n"
    "EN_gone.txt\tOther\tOther\n"
    "EN_4.txt\tURW: Russia is the Victim\tURW: Russia is the Victim\n"
)
ANN_PT = "PT_9.txt\tCC: Downplaying climate change\tCC: Downplaying climate change: Ice is not melting\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture()
def layout(tmp_path):
    root = str(tmp_path / "data")
    write(f"{root}/rel/EN/subtask-2-annotations.txt", ANN_EN)
    write(f"{root}/rel/PT/subtask-2-annotations.txt", ANN_PT)
    write(f"{root}/rel/EN/raw-documents/EN_UA_1.txt", 'Title "one"\n\nBody, with “quotes”\nand lines')
    write(f"{root}/rel/EN/raw-documents/EN_2.txt", "T2\n\nb2")
    write(f"{root}/rel/EN/raw-documents/EN_4.txt", "T4\n\nb4")
    write(f"{root}/rel/PT/raw-documents/PT_9.txt", "Título\n\nçã")
    return root


def test_annotate(spark, layout, tmp_path):
    out_csv, out_jsonl = str(tmp_path / "csv"), str(tmp_path / "jsonl")
    res = jobs.annotate(spark, f"{layout}/rel/*/subtask-2-annotations.txt", layout, out_csv, out_jsonl)
    flat = {r["article_id"]: r for r in res["flat"].collect()}
    assert set(flat) == {"EN_UA_1.txt", "EN_2.txt", "PT_9.txt"}
    assert flat["EN_UA_1.txt"]["content"] == "Title 'one'\n\nBody, with 'quotes'\nand lines"
    rej = {r["article_id"]: r["reject_reason"] for r in res["rejects"].collect()}
    assert set(rej) == {"EN_gone.txt", "EN_4.txt"}
    back = {r["article_id"]: r for r in R.read_csv_records(spark, out_csv).collect()}
    assert back["EN_UA_1.txt"]["content"] == flat["EN_UA_1.txt"]["content"]  # multi-line round trip
    assert back["PT_9.txt"]["domain"] == "CC"
    js = {r["article_id"]: r for r in R.read_jsonl(spark, out_jsonl).collect()}
    assert js["EN_UA_1.txt"]["labels"]["subnarrative"] == ["Discrediting Ukrainian military", "Other"]


def test_audit_from_outline(spark, layout):
    pages = spark.createDataFrame(
        [("t", 1, "Discrediting Ukraine\n- Discrediting Ukrainian military\nPraise of Russia\n"
                  "Russia is the Victim\nFigure 1: Ukraine War label taxonomy"),
         ("t", 2, "Downplaying climate change\n- Ice is not melting\nFigure 2: Climate Change label taxonomy")],
        schemas.OUTLINE_PAGE,
    )
    out = jobs.audit(spark, layout, outline_pages=pages)
    theme = {(r["theme"], r["language"]): r["count"] for r in out["theme_counts"].collect()}
    assert theme == {
        ("Ukraine War label taxonomy", "EN"): 6,
        ("Other", "EN"): 4,
        ("Climate Change label taxonomy", "PT"): 2,
    }
    nar = {(r["narrative"], r["language"]): r["count"] for r in out["narrative_counts"].collect()}
    assert nar[("Russia is the Victim", "EN")] == 2 and nar[("Downplaying climate change", "PT")] == 2
    gaps = {r["narrative"] for r in out["narrative_gaps"].collect()}
    assert gaps == set()
    sub_gaps = {(r["narrative"], r["subnarrative"]) for r in out["subnarrative_gaps"].collect()}
    assert ("Discrediting Ukraine", "Discrediting Ukrainian military") not in sub_gaps


def test_score_files(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/gold.tsv", '1\ta;b\ta\n2\tc\tc\n3\tz\t"x;y"\n')
    write(f"{d}/pred.tsv", "3\tz\tx\n1\ta\ta\n2\ta;b\tc\n")
    write(f"{d}/coarse.txt", "a\nb\nc\n")  # trailing newline (Q10)
    write(f"{d}/fine.txt", "a\nc\nx\ny\n")
    s = {r["level"]: r for r in jobs.score_files(spark, f"{d}/pred.tsv", f"{d}/gold.tsv", f"{d}/coarse.txt",
                                                f"{d}/fine.txt").collect()}
    assert s["coarse"]["f1_mean"] == pytest.approx(2 / 9)
    assert s["fine"]["f1_mean"] == pytest.approx((1 + 1 + 2 / 3) / 3)
    write(f"{d}/pred2.tsv", "1\ta\ta\n2\ta;b\tc\n")
    with pytest.raises(ValueError, match="3") as error:
        jobs.score_files(spark, f"{d}/pred2.tsv", f"{d}/gold.tsv", f"{d}/coarse.txt", f"{d}/fine.txt")
    assert [tuple(r) for r in error.value.ids.collect()] == [("3", "only gold")]


def test_tsv_quotes(spark, tmp_path):
    write(f"{tmp_path}/a.tsv", 'x\t"q" label\tb\n')
    plain = R.read_annotations(spark, f"{tmp_path}/a.tsv").first()
    assert plain["narrative"] == '"q" label'  # line reader keeps quotes


def test_resumable_stream(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "id string, text string"
    spark.createDataFrame([("1", "a"), ("2", "b")], schema).coalesce(1).write.parquet(f"{src}/p1")
    seen = []

    def model(texts):
        seen.extend(texts)
        return [t + "!" for t in texts]

    sch = spark.createDataFrame([], schema).schema
    run_resumable(spark, f"{src}/*", sch, out, model, "id", "text", checkpoint=str(tmp_path / "ck"))
    # as if the run had ended after a part of the next batch was written
    spark.createDataFrame([("3", "c"), ("1", "a")], schema).coalesce(1).write.parquet(f"{src}/p2")
    run_resumable(spark, f"{src}/*", sch, out, model, "id", "text", checkpoint=str(tmp_path / "ck"))
    res = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert res == [("1", "a!"), ("2", "b!"), ("3", "c!")]


def test_predict_and_score(spark):
    rows = []
    words = {"URW": "tank army front", "CC": "carbon warming ice", "Other": "cake recipe flour"}
    for i in range(45):
        dom = ["URW", "CC", "Other"][i % 3]
        labels = (["Blaming the war on others"], ["Other"]) if dom == "URW" else (["Other"], ["Other"])
        rows.append((f"EN_{i}.txt", f"{words[dom]} {i}", dom, labels))
    merged = spark.createDataFrame(
        rows, "article_id string, content string, domain string, labels struct<narrative:array<string>,"
        "subnarrative:array<string>>"
    )
    tax = spark.createDataFrame(
        [("Ukraine War label taxonomy", "Blaming the war on others", "Other")], schemas.TAXONOMY
    )
    out = jobs.predict_and_score(spark, merged, tax, model=lambda ps: ["Blaming the war on others" if "tank" in p else "none" for p in ps], k=3)
    pred = out["predictions"].collect()
    assert len(pred) == 45
    acc = {r["metric"]: r["value"] for r in out["fold_metrics"].where(F.col("fold") == "avg").collect()}
    assert acc["accuracy"] > 0.9
    m = {r["level"]: r for r in out["metrics"].collect()}
    assert m["narrative"]["f1"] > 0.9


def test_metrics_log(spark):
    long = spark.createDataFrame(
        [("1", "accuracy", 0.5), ("1", "f1", 0.25), ("2", "accuracy", 1.0), ("2", "f1", 0.75),
         ("avg", "accuracy", 0.75), ("avg", "f1", 0.5)],
        "fold string, metric string, value double",
    )
    lines = [r["line"] for r in K.metrics_log_lines(long).orderBy("block", "pos").collect()]
    assert lines == [
        "Fold 1 Metrics:", "accuracy: 0.5000", "f1: 0.2500", "",
        "Fold 2 Metrics:", "accuracy: 1.0000", "f1: 0.7500", "",
        "Average Metrics Across All Folds:", "accuracy: 0.7500", "f1: 0.5000",
    ]


def test_audit_release_filter(spark, layout):
    write(f"{layout}/other/EN/subtask-2-annotations.txt", "EN_x.txt\tOther\tOther\n")
    tax = spark.createDataFrame([("Other", "Other", "Other")], schemas.TAXONOMY)
    all_ = {(r["theme"], r["language"]): r["count"] for r in jobs.audit(spark, layout, taxonomy=tax)["theme_counts"].collect()}
    one = {(r["theme"], r["language"]): r["count"]
           for r in jobs.audit(spark, layout, taxonomy=tax, release="rel")["theme_counts"].collect()}
    assert all_[("Other", "EN")] == one[("Other", "EN")] + 2


def test_read_fold_files(spark, tmp_path):
    for i in (1, 2):
        write(f"{tmp_path}/folds/fold{i}_predictions.csv",
              f'article_id,content,p_domains\nA{i},"two\nlines, ""q""",{i}\n')
    write(f"{tmp_path}/folds/other.csv", "article_id\nx\n")
    df = R.read_fold_files(spark, f"{tmp_path}/folds")
    got = sorted((r["article_id"], r["content"], r["fold"]) for r in df.collect())
    assert got == [("A1", 'two\nlines, "q"', 1), ("A2", 'two\nlines, "q"', 2)]


def test_tsv_quoted_doubled_quote(spark, tmp_path):
    write(f"{tmp_path}/b.tsv", 'x\t"a ""q"" b;c"\td\n')
    row = R.read_annotations(spark, f"{tmp_path}/b.tsv", quoted=True).first()
    assert row["narrative"] == 'a "q" b;c'


def test_stack_languages_and_merge(spark, layout, tmp_path):
    from plotline.operators import labels as LB

    for lang in ("EN", "PT"):
        res = jobs.annotate(spark, f"{layout}/rel/{lang}/subtask-2-annotations.txt", layout)
        K.write_jsonl(res["nested"], f"{tmp_path}/json/{lang}")
    both = R.read_jsonl(spark, [f"{tmp_path}/json/EN", f"{tmp_path}/json/PT"])  # U2: one multi-path read
    merged = {r["article_id"]: r for r in LB.merge_records(both).collect()}
    assert merged["PT_9.txt"]["language"] == "PT"
    assert merged["PT_9.txt"]["label"] == ["Downplaying_climate_change__Ice_is_not_melting"]
    assert merged["EN_UA_1.txt"]["label"][1] == "Praise_of_Russia__Other"


def test_language_from_path_below_root(spark, tmp_path):
    root = str(tmp_path / "BG_data")  # a code in the root's own name is ignored
    write(f"{root}/rel/PT/subtask-2-annotations.txt", "PT_1.txt\tOther\tOther\n")
    write(f"{root}/rel/RU/subtask-2-annotations.txt", "RU_1.txt\tOther\tOther\n")
    got = {r["article_id"]: r["language"] for r in R.read_annotations(spark, root, recursive=True).collect()}
    assert got == {"PT_1.txt": "PT", "RU_1.txt": "Unknown"}


def test_annotate_partitioned_jsonl(spark, layout, tmp_path):
    out = str(tmp_path / "parts")
    jobs.annotate(spark, f"{layout}/rel/*/subtask-2-annotations.txt", layout, out_jsonl=out,
                  partition_by=("release", "lang"))
    assert os.path.isdir(f"{out}/release=rel/lang=PT")
    pt = spark.read.json(out).where("lang = 'PT'").select("article_id").collect()
    assert [r[0] for r in pt] == ["PT_9.txt"]


def test_resumable_stream_after_failure(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "id string, text string"
    spark.createDataFrame([("1", "a")], schema).coalesce(1).write.parquet(f"{src}/p1")
    spark.createDataFrame([("2", "boom"), ("3", "c")], schema).coalesce(1).write.parquet(f"{src}/p2")
    sch = spark.createDataFrame([], schema).schema

    def flaky(texts):
        if "boom" in texts:
            raise RuntimeError("model failed")
        return [t + "!" for t in texts]

    with pytest.raises(Exception):
        run_resumable(spark, f"{src}/*", sch, out, flaky, "id", "text", checkpoint=ck, max_files_per_trigger=1)
    done = sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert done == ["1"]  # the first batch was kept, the failed one left no rows
    run_resumable(spark, f"{src}/*", sch, out, lambda ts: [t + "!" for t in ts], "id", "text", checkpoint=ck)
    res = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert res == [("1", "a!"), ("2", "boom!"), ("3", "c!")]


def test_every_cell_of_a_label_line_counts(spark, tmp_path):
    """Empty and absent cells lose no other label; fields after the third count."""
    from plotline.operators import taxonomy as TX

    lines = ["a.txt\tURW: A;URW: B\t", "b.txt\tURW: C", "c.txt\tURW: D\tURW: D: x\tURW: E;URW: F: y", "d.txt"]
    write(f"{tmp_path}/rel/EN/subtask-2-annotations.txt", "\n".join(lines) + "\n")
    occ = TX.count_labels(R.read_annotations(spark, str(tmp_path), recursive=True))
    found = sorted(r["label"] for r in occ.where("label <> ''").collect())
    assert found == ["URW: A", "URW: B", "URW: C", "URW: D", "URW: D: x", "URW: E", "URW: F: y"]


def test_folder_name_with_a_blank(spark, tmp_path):
    root = str(tmp_path / "EN data")
    write(f"{root}/rel/PT/subtask-2-annotations.txt", "PT_1.txt\tOther\tOther\n")
    assert [r["language"] for r in R.read_annotations(spark, root, recursive=True).collect()] == ["PT"]


def test_language_without_a_valid_label_has_gaps(spark, tmp_path):
    write(f"{tmp_path}/rel/EN/subtask-2-annotations.txt", "e.txt\tURW: A\tURW: A: Other\n")
    write(f"{tmp_path}/rel/PT/subtask-2-annotations.txt", "p.txt\tOther\tOther\n")
    tax = spark.createDataFrame([("Ukraine War label taxonomy", "A", "Other")], schemas.TAXONOMY)
    out = jobs.audit(spark, str(tmp_path), taxonomy=tax)
    gaps = [(r["narrative"], r["language"]) for r in out["narrative_gaps_by_language"].collect()]
    assert gaps == [("A", "PT")]


def articles(spark, n):
    rows = [(f"EN_{i}.txt", f"{'tank war' if i % 2 else 'carbon ice'} {i}", "URW" if i % 2 else "CC", (["N"], ["Other"])) for i in range(n)]
    return spark.createDataFrame(
        rows, "article_id string, content string, domain string, labels struct<narrative:array<string>,subnarrative:array<string>>"
    )


def test_model_runs_once_per_article_and_keeps_finished_answers(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def model(prompts):
        calls.add(len(prompts))
        return ["N" for _ in prompts]

    tax = spark.createDataFrame([("Ukraine War label taxonomy", "N", "Other"), ("Climate Change label taxonomy", "N", "Other")], schemas.TAXONOMY)
    finished = spark.createDataFrame([(f"EN_{i}.txt", "old answer N") for i in range(20)], "article_id string, gpt_output string")
    results = str(tmp_path / "answers")
    merged = articles(spark, 60)
    out = jobs.predict_and_score(spark, merged, tax, model, k=3, finished=finished, results=results, out_dir=str(tmp_path / "out"))
    for df in out.values():
        df.collect()
    assert calls.value == 40
    pred = {r["article_id"]: r["gpt_output"] for r in out["predictions"].collect()}
    assert len(pred) == 60 and pred["EN_3.txt"] == "old answer N" and pred["EN_30.txt"] == "N"
    assert {r["n"] for r in out["metrics"].collect()} == {60}
    again = jobs.predict_and_score(spark, articles(spark, 61), tax, model, k=3, finished=finished, results=results)
    assert again["predictions"].count() == 61 and calls.value == 41
    log = sorted(r["value"] for r in spark.read.text(str(tmp_path / "out" / "metrics_log")).collect())
    assert sum(x.startswith("accuracy: ") for x in log) == 4
    assert spark.read.json(str(tmp_path / "out" / "results")).count() == 60


def test_translate_table_keeps_every_record(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def model(prompts):
        calls.add(len(prompts))
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([("1", "a", "PT"), ("2", "b", "EN"), ("3", "c", None)], "article_id string, content string, language string")
    results = str(tmp_path / "t")
    for n in (2, 3):
        got = {r["article_id"]: r["en_content"] for r in jobs.translate_table(spark, df.limit(n), model, results).collect()}
        assert len(got) == n and got["2"] == "b" and got["1"].endswith("A")
    assert calls.value == 2


def test_prompt_options_follow_the_outline(spark):
    from plotline.operators import infer as IN
    from plotline.operators import taxonomy as TX

    pages = spark.createDataFrame([("t", 1, "Zeta\n- zz\n- aa\nAlpha\nFigure 1: Ukraine War label taxonomy")], schemas.OUTLINE_PAGE)
    text = IN.option_lists(TX.outline_taxonomy(pages), order="position").first()["options"]
    assert text == "Zeta\n- zz\n- aa\n- Other\n\nAlpha\n- Other"


def test_merge_languages(spark, layout, tmp_path):
    for lang in ("EN", "PT"):
        res = jobs.annotate(spark, f"{layout}/rel/{lang}/subtask-2-annotations.txt", layout)
        K.write_jsonl(res["nested"], f"{tmp_path}/json/{lang}")
    merged = jobs.merge_languages(spark, [f"{tmp_path}/json/EN", f"{tmp_path}/json/PT"], f"{tmp_path}/merged")
    back = R.read_jsonl(spark, f"{tmp_path}/merged", schemas.MERGED_RECORD)
    assert sorted(map(tuple, back.select("article_id", "language").collect())) == sorted(map(tuple, merged.select("article_id", "language").collect()))


def test_streams_into_folders_of_one_name_are_apart(spark, tmp_path):
    schema = "id string, text string"
    src = str(tmp_path / "src")
    spark.createDataFrame([("1", "a")], schema).write.parquet(f"{src}/p1")
    sch = spark.createDataFrame([], schema).schema
    for out in (str(tmp_path / "a/out"), str(tmp_path / "b/out")):
        run_resumable(spark, f"{src}/*", sch, out, lambda ts: ts, "id", "text")
        assert spark.read.parquet(out).count() == 1
