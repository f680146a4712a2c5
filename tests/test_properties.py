"""Hand-worked tables and properties on generated inputs (one Spark job per
example)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plotline.operators import detect as DT
from plotline.operators import folds as FO
from plotline.operators import labels as LB
from plotline.operators import taxonomy as TX
from plotline.sources import schemas

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

# label pieces: words, separators and a few non-ASCII letters
piece = st.sampled_from(["URW", "CC", "Other", "a b", "Ünï", "x", "", " ", ":", ": ", "Дом", "_1"])
label = st.lists(piece, min_size=1, max_size=5).map("".join).filter(lambda s: ";" not in s and "\t" not in s)
cell = st.lists(label, min_size=1, max_size=4).map(";".join)


# -- labels: hand-worked cells, and what holds for any cell ---------------------

#: label -> domain, narrative, subnarrative, the rest after the domain
WORKED = [
    ("URW: N: S", "URW", "N", "S", "N: S"),
    ("URW: N", "URW", "N", None, "N"),
    ("Other", "", "Other", "Other", "Other"),
    (": x", "", "x", None, "x"),
    ("Дом: N: S: T", "Дом", "N", "S", "N: S: T"),
    ("a b: c", "", "a b: c", "a b: c", "a b: c"),
    ("CC:x", "CC:x", None, None, None),
    ("", "", "", "", ""),
]


def test_decode_of_worked_labels(spark):
    df = spark.createDataFrame([(f"id{i}", w[0], w[0]) for i, w in enumerate(WORKED)], schemas.ANNOTATION)
    got = {r["article_id"]: r for r in LB.decode(df).collect()}
    for i, (text, domain, nar, sub, rest) in enumerate(WORKED):
        r = got[f"id{i}"]
        assert (r["domain"], r["narratives"], r["subnarratives"], r["narratives_subnarratives"]) == (domain, [nar], [sub], [rest]), text
        assert (r["reject_reason"] is not None) == (nar is None or sub is None), text


@SETTINGS
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=12))
def test_decode_keeps_rows_order_and_lengths(spark, rows):
    data = [(f"id{i}", n, s) for i, (n, s) in enumerate(rows)]
    got = {r["article_id"]: r for r in LB.decode(spark.createDataFrame(data, schemas.ANNOTATION)).collect()}
    assert set(got) == {d[0] for d in data}  # no row is lost
    single = {}
    for _, n, s in data:
        single.update({x: None for x in [*n.split(";"), *s.split(";")]})
    alone = {r["article_id"]: r for r in LB.decode(spark.createDataFrame([(x, x, x) for x in single], schemas.ANNOTATION)).collect()}
    for aid, n, s in data:  # each label of a list decodes as it does alone
        r = got[aid]
        assert r["narratives"] == [alone[x]["narratives"][0] for x in n.split(";")]
        assert r["subnarratives"] == [alone[x]["subnarratives"][0] for x in s.split(";")]


def test_count_decode_of_worked_labels(spark):
    war = "Ukraine War label taxonomy"
    worked = {
        "URW": (war, "URW", None), "Other": ("Other", "Other", None), "x": (None, "x", None), " CC : n ": ("Climate Change label taxonomy", "n", None),
        "URW:n:s": (war, "n", "s"), "URW: n : s ": (war, "n", "s"), "URW:n:": (war, "n", None), "": (None, "", None),
    }
    occ = spark.createDataFrame([("EN", x) for x in [*worked, "a:b:c:d", ":::"]], "language string, label string")
    got = {r["label"]: r for r in TX.decode_count_labels(occ).collect()}
    for text, want in worked.items():
        r = got[text]
        assert (r["theme"], r["narrative"], r["subnarrative"], r["reject_reason"]) == (*want, None), text
    assert got["a:b:c:d"]["reject_reason"] and got[":::"]["reject_reason"]


# -- outline --------------------------------------------------------------------

def outline(spark, pages):
    df = spark.createDataFrame([("d", p, t) for p, t in enumerate(pages)], "doc string, page int, text string")
    return [(r["theme"], r["narrative"], r["subnarrative"]) for r in TX.parse_outline(df).orderBy("page", "line_no").collect()]


def test_worked_outline(spark):
    pages = [
        "- lost item\nN1\n- s1\n\n  -- s2  \nN2\nFigure 1: T1\nbelow the caption",
        "-s3\nN3 ",  # no caption: the theme of the page before
        "N4\nsee Figure without colon",
        "N5\nFigure 2:  \n",  # a caption without text keeps the theme
        "- s5\nFigure 3: T2 : more",
        "",
    ]
    assert outline(spark, pages) == [
        ("T1", "N1", "Other"), ("T1", "N1", "s1"), ("T1", "N1", "s2"), ("T1", "N2", "Other"),
        ("T1", "N2", "s3"), ("T1", "N3", "Other"), ("T1", "N4", "Other"), ("T1", "N5", "Other"), ("T2", "N5", "s5"),
    ]


outline_line = st.sampled_from(["N1", "N2", "Other", "- s1", "-- s2", "-s3", "", "  ", "- ", "N3 "])


@SETTINGS
@given(st.lists(outline_line, min_size=2, max_size=12), st.integers(1, 11))
def test_a_page_may_be_cut_anywhere(spark, lines, at):
    """Without captions, one page and its two halves give the same rows."""
    whole = [x[1:] for x in outline(spark, ["\n".join(lines)])]
    halves = ["\n".join(lines[:at]), "\n".join(lines[at:])]
    assert [x[1:] for x in outline(spark, halves)] == whole
    heads = [x.strip() for x in lines if x.strip() and not x.strip().startswith("-")]
    assert [n for n, s in whole if s == "Other"] == heads  # every heading opens an entry, in order


def test_page_of_many_lines(spark):
    rows = outline(spark, ["\n".join(f"N{i // 4}" if i % 4 == 0 else f"- s{i}" for i in range(20_000)) + "\nFigure 1: T"])
    assert len(rows) == 20_000 and rows[-1] == ("T", "N4999", "s19999")


# -- folds --------------------------------------------------------------------

@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=60), st.integers(2, 6))
def test_fold_balance_property(spark, classes, k):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(classes)], "id long, c string")
    rows = FO.stratified_folds(df, "c", "id", k=k, bucket_hex=1).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(classes)))
    sizes = [sum(1 for r in rows if r["fold"] == f) for f in range(1, k + 1)]
    assert max(sizes) - min(sizes) <= 1
    for c in set(classes):
        per = [sum(1 for r in rows if r["fold"] == f and r["c"] == c) for f in range(1, k + 1)]
        assert max(per) - min(per) <= 1


def test_rows_without_class_stay_in_folds(spark):
    df = spark.createDataFrame([(i, ["a", "b", None][i % 3]) for i in range(30)], "id long, c string")
    rows = FO.stratified_folds(df, "c", "id").collect()
    assert len(rows) == 30 and {r["fold"] for r in rows} == {1, 2, 3, 4, 5}


# -- phrase detection ---------------------------------------------------------

word = st.sampled_from(["alpha", "Beta", "gam", "ma", "x1", "über", "de", "ok"])
sep = st.sampled_from([" ", ", ", ".", "-", "\n", "", "_"])
text = st.lists(st.tuples(word, sep), max_size=25).map(lambda ps: "".join(w + s for w, s in ps))
phrase = st.lists(st.tuples(word, sep), min_size=1, max_size=2).map(lambda ps: "".join(w + s for w, s in ps).strip())


@SETTINGS
@given(st.lists(text, min_size=1, max_size=10), st.lists(phrase, min_size=1, max_size=8))
def test_detection_matches_python_re(spark, texts, phrases):
    phrases = sorted({p for p in phrases if p})
    d = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    p = spark.createDataFrame([("p", x) for x in phrases], "kind string, phrase string")
    want = sorted(
        (i, x) for i, t in enumerate(texts) for x in phrases if re.search(r"\b" + re.escape(x) + r"\b", t, re.I)
    )
    for strategy in ("in_place", "shuffled"):
        got = sorted((r["id"], r["phrase"]) for r in DT.find_phrases(d, p, strategy=strategy).collect())
        assert got == want, strategy


def test_explode_then_collect_is_identity(spark):
    rows = [("a", "x;y;x"), ("b", "z")]
    df = spark.createDataFrame(rows, "id string, cell string")
    ex = df.select("id", F.posexplode(F.split("cell", ";")).alias("pos", "label"))
    back = ex.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))),
                                                         lambda s: s["label"]), ";").alias("cell"))
    assert sorted(map(tuple, back.collect())) == rows


# -- scoring ------------------------------------------------------------------

lab = st.sampled_from(["a", "b", "c", "d", "", "zz"])
labset = st.lists(lab, max_size=4)


def f1_rule(g, p, classes):
    g = {x for x in g if x in classes}
    p = {x for x in p if x in classes}
    return 0.0 if not g and not p else 2 * len(g & p) / (len(g) + len(p))


@SETTINGS
@given(st.lists(st.tuples(labset, labset), min_size=1, max_size=15))
def test_scorers_match_rules(spark, pairs):
    from plotline.operators import score as SC

    rows = [(str(i), g, p) for i, (g, p) in enumerate(pairs)]
    al = spark.createDataFrame(rows, "article_id string, gold array<string>, pred array<string>")
    classes = ["a", "b", "c"]
    cls = spark.createDataFrame([(c,) for c in classes], "class string")
    s = SC.summarize_f1(SC.sample_f1_by_class_list(al, cls)).first()
    f1s = [f1_rule(g, p, set(classes)) for _, g, p in rows]
    mean = sum(f1s) / len(f1s)
    sd = (sum((x - mean) ** 2 for x in f1s) / len(f1s)) ** 0.5
    assert abs(s["f1_mean"] - mean) < 1e-9 and abs(s["f1_sd"] - sd) < 1e-9

    # long form gives the same per-article counts
    occ = spark.createDataFrame(
        [(a, x, True, False) for a, g, _ in rows for x in g] + [(a, x, False, True) for a, _, p in rows for x in p]
        + [(a, "", True, True) for a, _, _ in rows],
        "article_id string, label string, in_gold boolean, in_pred boolean",
    )
    s2 = SC.summarize_f1(SC.f1_from_counts(SC.set_counts_flagged(occ, classes=cls))).first()
    assert abs(s2["f1_mean"] - mean) < 1e-9 and s2["n"] == len(rows)

    # observed-label variant: undefined -> 0
    def prf(g, p):
        g, p = set(g), set(p)
        tp = len(g & p)
        return (tp / len(p) if p else 0.0, tp / len(g) if g else 0.0, 2 * tp / (len(g) + len(p)) if g or p else 0.0)

    m = SC.sample_prf(al).first()
    want = [prf(g, p) for _, g, p in rows]
    for i, k in enumerate(("precision", "recall", "f1")):
        assert abs(m[k] - sum(w[i] for w in want) / len(want)) < 1e-9


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=30))
def test_class_metrics_match_rules(spark, pairs):
    from plotline.operators import score as SC

    df = spark.createDataFrame(pairs, "label int, pred int")
    m = SC.class_metrics(df).first()
    classes = sorted({t for t, _ in pairs} | {p for _, p in pairs})
    prec, rec, f1 = [], [], []
    for c in classes:
        tp = sum(1 for t, p in pairs if t == c and p == c)
        npred = sum(1 for _, p in pairs if p == c)
        ntrue = sum(1 for t, _ in pairs if t == c)
        prec.append(tp / npred if npred else 1.0)
        rec.append(tp / ntrue if ntrue else 1.0)
        f1.append(2 * tp / (npred + ntrue))
    assert abs(m["accuracy"] - sum(1 for t, p in pairs if t == p) / len(pairs)) < 1e-9
    assert abs(m["precision"] - sum(prec) / len(prec)) < 1e-9
    assert abs(m["recall"] - sum(rec) / len(rec)) < 1e-9
    assert abs(m["f1"] - sum(f1) / len(f1)) < 1e-9


# -- fill-forward -------------------------------------------------------------

@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.one_of(st.none(), st.sampled_from(["a", "b"])),
                       st.one_of(st.none(), st.sampled_from(["x", "y"]))), min_size=1, max_size=80),
    st.integers(1, 9),
)
def test_carry_forward_many_matches_scan(spark, rows, block):
    from plotline.operators.scan import carry_forward_many

    data = [(k, i, u, v) for i, (k, u, v) in enumerate(rows)]  # positions unique per key
    df = spark.createDataFrame(data, "k string, p int, u string, v string")
    got = carry_forward_many(df, ["k"], "p", [("u", "cu", True), ("v", "cv", False)], block_size=block)
    res = {(r["k"], r["p"]): (r["cu"], r["cv"]) for r in got.collect()}
    last_u, last_v = {}, {}
    for k, p, u, v in sorted(data, key=lambda x: (x[0], x[1])):
        if u is not None:
            last_u[k] = u
        assert res[(k, p)] == (last_u.get(k), last_v.get(k))
        if v is not None:
            last_v[k] = v


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["n1", "n2", "n3", "n4"]), st.sampled_from(["EN", "PT", "BG"])),
             min_size=1, max_size=20),
    st.sets(st.sampled_from(["RU", "HI"])),
)
def test_gaps_by_language_matches_sets(spark, counted, uncounted):
    tax_rows = [("T", n, "Other") for n in ("n1", "n2", "n3", "n4", "n5")]
    tax = spark.createDataFrame(tax_rows, schemas.TAXONOMY)
    counts = spark.createDataFrame([(n, lang, 1) for n, lang in counted], "narrative string, language string, count long")
    languages = spark.createDataFrame([(x,) for x in sorted({lang for _, lang in counted} | uncounted)], "language string")
    got = sorted((r["narrative"], r["language"]) for r in TX.gaps_by_language(tax, counts, languages, "narrative").collect())
    langs = {lang for _, lang in counted} | uncounted
    seen = set(counted)
    want = sorted((n, lang) for _, n, _ in tax_rows for lang in langs if (n, lang) not in seen)
    assert got == want
