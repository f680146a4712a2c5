"""Label decoding, records and merge (P1-P14, P25, P26) on the FIXTURES cases."""

from pyspark.sql import functions as F

from plotline.functions import labels as L
from plotline.operators import labels as LB
from plotline.sources import schemas

TWO = (
    "EN_UA_1.txt",
    "URW: Discrediting Ukraine;URW: Praise of Russia",
    "URW: Discrediting Ukraine: Discrediting Ukrainian military;URW: Praise of Russia: Other",
)
NO_DOMAIN = ("PT_2.txt", "Other", "Other")
RU = ("RU-URW-3.txt", "CC: Downplaying climate change", "CC: Downplaying climate change: Ice is not melting")
FEW = ("BG_4.txt", "URW: Russia is the Victim", "URW: Russia is the Victim")
UNEQUAL = ("HI_5.txt", "URW: A;URW: B", "URW: A: x")


def lines(spark, rows):
    return spark.createDataFrame(rows, schemas.ANNOTATION)


def by_id(df):
    return {r["article_id"]: r for r in df.collect()}


def test_flat_records(spark):
    dec = LB.decode(lines(spark, [TWO, NO_DOMAIN, RU, UNEQUAL]))
    good, bad = LB.split_rejects(dec)
    assert bad.count() == 0
    r = by_id(LB.flat_records(good))
    a = r["EN_UA_1.txt"]
    assert a["domain"] == "URW"
    assert a["narrative"] == "Discrediting Ukraine;Praise of Russia"
    assert a["subnarrative"] == "Discrediting Ukrainian military;Other"
    assert a["narrative_subnarrative"] == "Discrediting Ukraine: Discrediting Ukrainian military;Praise of Russia: Other"
    b = r["PT_2.txt"]
    assert (b["domain"], b["narrative"], b["subnarrative"]) == ("", "Other", "Other")
    assert b["narrative_subnarrative"] == "Other"  # Q1 fixed
    assert r["RU-URW-3.txt"]["domain"] == "CC"


def test_too_few_parts_is_rejected(spark):
    dec = LB.decode(lines(spark, [TWO, FEW]))
    good, bad = LB.split_rejects(dec)
    assert [x["article_id"] for x in good.collect()] == ["EN_UA_1.txt"]
    rej = bad.collect()
    assert len(rej) == 1 and rej[0]["article_id"] == "BG_4.txt"
    assert "subnarrative" in rej[0]["reject_reason"]


def test_merge_combined_labels_and_language(spark):
    dec = LB.decode(lines(spark, [TWO, NO_DOMAIN, RU, UNEQUAL]), domain_from="narrative")
    good, _ = LB.split_rejects(dec)
    m = by_id(LB.with_class(LB.merge_records(LB.nested_records(good))))
    assert m["EN_UA_1.txt"]["label"] == [
        "Discrediting_Ukraine__Discrediting_Ukrainian_military",
        "Praise_of_Russia__Other",
    ]
    assert m["EN_UA_1.txt"]["language"] == "EN"
    assert m["PT_2.txt"]["label"] == ["Other__Other"]
    assert m["PT_2.txt"]["class_id"] == 2
    assert m["RU-URW-3.txt"]["language"] == "Unknown"  # Q13
    assert m["RU-URW-3.txt"]["class_id"] == 1
    assert m["HI_5.txt"]["label"] == ["A__x"]  # shorter list wins
    assert m["EN_UA_1.txt"]["class_id"] == 0


def test_language_leftmost(spark):
    df = spark.createDataFrame([("A9_BG_EN.txt",), ("x",)], "id string")
    got = [r[0] for r in df.select(L.language_of("id")).collect()]
    assert got == ["BG", "Unknown"]


def test_quotes_title_body(spark):
    df = spark.createDataFrame([('a"b“c”d', "T\n\nl1\nl2"), ("x", "one")], "q string, t string")
    r = df.select(L.normalize_quotes("q").alias("q"), L.title_of("t").alias("title"), L.body_of("t").alias("body"))
    rows = r.collect()
    assert rows[0]["q"] == "a'b'c'd"
    assert (rows[0]["title"], rows[0]["body"]) == ("T", "l1\nl2")
    assert (rows[1]["title"], rows[1]["body"]) == ("one", "")


def test_has_domain_unicode(spark):
    df = spark.createDataFrame([("Другое: x",), ("Other",), ("Two words: x",), (":x",)], "l string")
    got = [r[0] for r in df.select(L.has_domain("l")).collect()]
    assert got == [True, False, False, True]


def test_split_keeps_trailing_empty(spark):
    df = spark.createDataFrame([("a;b;",)], "c string")
    assert df.select(L.split_list("c")).first()[0] == ["a", "b", ""]


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],)], "x array<float>")
    assert df.select(L.argmax("x")).first()[0] == 1


def test_json_records_roundtrip(spark, tmp_path):
    dec = LB.decode(lines(spark, [TWO, NO_DOMAIN]), domain_from="narrative")
    good, _ = LB.split_rejects(dec)
    nested = LB.nested_records(good.withColumn("content", F.lit('say "hi"\nbye')))
    out = str(tmp_path / "j")
    nested.write.json(out)
    back = spark.read.schema(schemas.NESTED_RECORD).json(out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, nested.collect()))
