"""Counts, rollup, gaps (A1-A4, J2, J6, P16) and outline parse."""

from plotline.operators import taxonomy as TX
from plotline.operators.scan import carry_forward
from plotline.sources import schemas

URW = "Ukraine War label taxonomy"
LINES = [
    (
        "EN_UA_1.txt",
        "URW: Discrediting Ukraine;URW: Praise of Russia",
        "URW: Discrediting Ukraine: Discrediting Ukrainian military;URW: Praise of Russia: Other",
    ),
    ("PT_2.txt", "Other", "Other"),
]
TAX = [
    (URW, "Discrediting Ukraine", "Other"),
    (URW, "Discrediting Ukraine", "Discrediting Ukrainian military"),
    (URW, "Praise of Russia", "Other"),
    (URW, "Russia is the Victim", "Other"),
]


def setup(spark):
    ann = spark.createDataFrame([(a, n, s, "EN") for a, n, s in LINES], "article_id string, narrative string, "
                                "subnarrative string, language string")
    tax = spark.createDataFrame(TAX, schemas.TAXONOMY)
    return TX.label_cube(ann), tax


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_theme_counts(spark):
    cube, _ = setup(spark)
    assert rows(TX.theme_counts(cube)) == [("Other", "EN", 2), (URW, "EN", 4)]


def test_theme_rollup(spark):
    cube, _ = setup(spark)
    got = {(r["theme"], r["language"]): r["count"] for r in TX.theme_rollup(cube).collect()}
    assert got == {("Other", "EN"): 2, (URW, "EN"): 4, ("Other", None): 2, (URW, None): 4, (None, None): 6}


def test_narrative_and_subnarrative_counts(spark):
    cube, tax = setup(spark)
    assert rows(TX.narrative_counts(cube, tax)) == [("Discrediting Ukraine", "EN", 2), ("Praise of Russia", "EN", 2)]
    assert rows(TX.subnarrative_counts(cube, tax)) == [("Discrediting Ukrainian military", "EN", 1), ("Other", "EN", 1)]


def test_gaps(spark):
    cube, tax = setup(spark)
    ng = rows(TX.narrative_gaps(tax, TX.narrative_counts(cube, tax)))
    assert ng == [(URW, "Russia is the Victim", 0)]  # Q8 fixed
    assert rows(TX.subnarrative_gaps(tax, TX.subnarrative_counts(cube, tax))) == []
    keyed = rows(TX.subnarrative_gaps(tax, TX.subnarrative_counts(cube, tax, by_theme=True)))
    assert keyed == [(URW, "Discrediting Ukraine", "Other", 0), (URW, "Russia is the Victim", "Other", 0)]


def test_gaps_and_counted_partition_taxonomy(spark):
    cube, tax = setup(spark)
    counts = TX.subnarrative_counts(cube, tax, by_theme=True)
    gaps = TX.subnarrative_gaps(tax, counts)
    counted = counts.select("theme", "narrative", "subnarrative").distinct()
    assert gaps.count() + counted.count() == tax.count()


def test_arity(spark):
    ann = spark.createDataFrame(
        [("x", "URW:a:b:c;XX: a;URW: a", "", "EN")],
        "article_id string, narrative string, subnarrative string, language string",
    )
    tax = spark.createDataFrame(TAX, schemas.TAXONOMY)
    cube = TX.label_cube(ann, columns="narrative")
    assert rows(TX.theme_counts(cube)) == [(URW, "EN", 1)]  # 4 parts dropped, XX no theme
    assert TX.narrative_counts(cube, tax).count() == 0  # 'a' outside the taxonomy
    rej = TX.label_rejects(ann, columns="narrative").collect()
    assert [r["label"] for r in rej] == ["URW:a:b:c"]


def test_counts_are_even_when_both_columns_counted(spark):
    cube, _ = setup(spark)
    assert all(r["count"] % 2 == 0 for r in TX.theme_counts(cube).collect())  # T3


OUTLINE = [
    ("d", 1, "N1\n- s1\n\n- s2\nFigure 1: T1\nignored"),
    ("d", 2, "- s3\nN2\n-- s4"),
    ("d", 3, "Other\n- s5\nFigure 2: T2"),
]


def test_outline(spark):
    pages = spark.createDataFrame(OUTLINE, "doc string, page int, text string")
    out = TX.parse_outline(pages).orderBy("page", "line_no")
    got = [(r["theme"], r["narrative"], r["subnarrative"]) for r in out.collect()]
    assert got == [
        ("T1", "N1", "Other"),
        ("T1", "N1", "s1"),
        ("T1", "N1", "s2"),
        ("T1", "N1", "s3"),
        ("T1", "N2", "Other"),
        ("T1", "N2", "s4"),
        ("T2", "Other", "Other"),
        ("T2", "Other", "s5"),
    ]


def test_carry_forward_matches_window_across_blocks(spark):
    import random

    rnd = random.Random(7)
    data = [("k" + str(k), p, (str(p) if rnd.random() < 0.2 else None)) for k in range(3) for p in range(200)]
    df = spark.createDataFrame(data, "k string, p int, v string")
    got = carry_forward(df, ["k"], "p", "v", "out", inclusive=False, block_size=16)
    res = {(r["k"], r["p"]): r["out"] for r in got.collect()}
    last = {}
    for k, p, v in sorted(data):
        assert res[(k, p)] == last.get(k)
        if v is not None:
            last[k] = v


def test_gaps_by_language(spark):
    ann = spark.createDataFrame(
        [("EN_1.txt", "URW: Praise of Russia", "URW: Praise of Russia: Other", "EN"),
         ("PT_2.txt", "URW: Discrediting Ukraine", "URW: Discrediting Ukraine: Other", "PT")],
        "article_id string, narrative string, subnarrative string, language string",
    )
    tax = spark.createDataFrame(TAX, schemas.TAXONOMY)
    cube = TX.label_cube(ann)
    got = rows(TX.gaps_by_language(tax, TX.narrative_counts(cube, tax), cube, "narrative"))
    assert got == [
        (URW, "Discrediting Ukraine", "EN", 0),
        (URW, "Praise of Russia", "PT", 0),
        (URW, "Russia is the Victim", "EN", 0),
        (URW, "Russia is the Victim", "PT", 0),
    ]
