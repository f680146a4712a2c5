"""Classifiers, language identification, token counts and pages."""

import base64
import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest
from helpers import DOCS, clashing, crc_rest, documents, prose, table

from plotline.llm import language as LA
from plotline.llm import pages as PG
from plotline.llm import quality as QU
from plotline.llm import token_counts as TC
from plotline.llm import toxicity as TX

LABELS = "doc_id long, quality int, toxic int"


# Toxicity --------------------------------------------------------------------


def toxic_rows(n=400, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(rng, rng.randrange(8, 40), 300)
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["scumble", "scumbly", "grotz"])
        if (bad and rng.random() < 0.8) or (not bad and rng.random() < 0.05):
            words.insert(3, "muslim")  # a group named mostly in toxic texts
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    extra = [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "x " * 50_000 + "grotz", "en", "s", 1), rows[0]]
    docs = clashing(table(spark, rows + extra))
    marks = table(spark, labels + [(None, 1, 1), (5000, None, None), (3, None, None)], LABELS)
    got = TX.toxicity_scores(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: t for i, _, t in labels}
    for r in got:
        assert r.held_out == (crc_rest(r.doc_id, 5) == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    wrong = [r for r in got if r.held_out and r.doc_id in truth and r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 2
    assert next(r for r in got if r.doc_id == 902).predicted == 1


def test_swap_penalty_frees_neutral_mentions(spark):
    rows, labels = toxic_rows()
    docs, marks = table(spark, rows), table(spark, labels, LABELS)
    plain = TX.fit(docs, marks, swap_penalty=0.0)
    fair = TX.fit(docs, marks, swap_penalty=10.0)
    assert abs(fair.weights.get("muslim", 0)) < 0.5 * abs(plain.weights["muslim"])
    text = "w1 w2 muslim w3"
    swapped = "w1 w2 jewish w3"
    assert abs(fair.score(text) - fair.score(swapped)) < abs(plain.score(text) - plain.score(swapped))
    assert fair.score("w1 grotz w2") > 0.5


def test_toxicity_without_labels_or_rows(spark):
    docs, none = table(spark, documents(n=5)), table(spark, [], LABELS)
    assert len({r.score for r in TX.toxicity_scores(docs, none).collect()}) == 1
    assert TX.toxicity_scores(table(spark, []), none).count() == 0


def test_identity_groups_are_permutations():
    assert sorted(TX.SWAP) == sorted(TX.SWAP.values()) and all(a != b for a, b in TX.SWAP.items())


# Quality ---------------------------------------------------------------------


def quality_rows(n=300, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(10, 80))
        good = i % 5 != 0
        text = ". ".join(words) if good else rng.choice(["%%% ".join(words), " | ".join(words), " ".join(words).upper() + "!!"])
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = quality_rows()
    extra = [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "ab cd. " * 40_000, "en", "s", 1), rows[1]]
    docs = clashing(table(spark, rows + extra))
    marks = table(spark, labels + [(None, 1, 1), (7, None, None)], LABELS)
    got = QU.quality_scores(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: q for i, q, _ in labels}
    for r in got:
        assert r.held_out == (crc_rest(r.doc_id, 4) == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted != truth[r.doc_id] for r in held) <= 0.04 * len(held) + 1
    kept = QU.without_rejects(docs, marks)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.predicted)


def test_pairs_order_and_quantile():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    better = (x[:, 0] - x[:, 1] > 0.5).astype(int)
    m = QU.fit_pairs(x, better, pairs=20_000)
    assert m.weights[0] > 0 > m.weights[1] and abs(m.weights[2]) < 0.2 * m.weights[0]
    below = (m.strength(x) < m.threshold).mean()
    assert below == pytest.approx((better == 0).mean(), abs=0.005)
    assert ((m.score(x) >= QU.CUT) == (m.strength(x) >= m.threshold)).all()


def test_quality_without_pairs_or_rows(spark):
    docs, none = table(spark, documents(n=5)), table(spark, [], LABELS)
    assert all(r.predicted == 1 for r in QU.quality_scores(docs, none).collect())
    assert QU.quality_scores(table(spark, []), none).count() == 0


# Languages -------------------------------------------------------------------


def language_rows(n=240, seed=4):
    rng = random.Random(seed)
    parts = {"en": ["the", "ing", "ton", "wh", "ly"], "de": ["sch", "ung", "ä", "keit", "der"], "es": ["ción", "ar", "ñ", "que", "los"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 30))]
        rows.append((i, " ".join(words).capitalize() + ".", lang, "s", 1))
    return rows


def test_languages_on_held_out_rows(spark):
    rows = language_rows()
    extra = [(900, None, "en", None, None), (901, "", "en", "s", 0), (902, "123 !? 4", "de", "s", 1), (903, "x", None, "s", 1), rows[0]]
    extra += [(904, "Schungkeit " * 20_000, "de", "s", 1)]
    got = LA.languages(clashing(table(spark, rows + extra))).collect()
    assert len(got) == len(rows) + len(extra)
    lang = {r[0]: r[2] for r in rows}
    by = {r.doc_id: r for r in got}
    for r in got:
        assert r.held_out == (crc_rest(r.doc_id, 4) == 2) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out and r.doc_id in lang]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert {by[i].lang_pred for i in (900, 901, 902)} == {"und"} and by[904].lang_pred == "de"
    nothing = LA.languages(table(spark, [(1, "abc", None, "s", 1)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert LA.languages(table(spark, [])).count() == 0


def test_word_first_then_longest_known_order():
    import pandas as pd

    m = LA.build(pd.DataFrame({"word": ["haus", "house"], "lang": ["de", "en"], "n": [4, 4]}))
    assert m.rows("haus") == [m.known["haus"]]
    assert m.rows("hausx") == [m.tables[5]["<haus"]]  # an order-5 gram is known
    assert m.rows("xau") == [m.tables[2]["au"]]
    assert m.rows("zsz") == [m.tables[1][g] for g in "<s>"]
    assert m.rows("zz") == [m.tables[1][g] for g in "<>"]
    score = LA.Scorer(m)
    [(lang, p)] = score(["Haus house haus"])
    logs = sum(m.logs[m.known[w]] for w in ("haus", "house", "haus"))
    want = np.exp(logs) / np.exp(logs).sum()
    assert lang == "de" and p == pytest.approx(want[0])


# Token counts ----------------------------------------------------------------


@pytest.fixture
def ranks(tmp_path):
    """A byte vocabulary with a few merges."""
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"abc", b"w1", b" w"]
    path = tmp_path / "ranks.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    return str(path)


def test_histogram_and_suffix_sums_match_plain_sums(spark, ranks):
    import tiktoken

    rows = documents(n=40) + [(700 + i, "abc" * i, "en", "s", 1) for i in range(8)]
    with open(ranks, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=TC.PATTERN, mergeable_ranks=merges, special_tokens={})
    size = [len(enc.encode_ordinary(r[1] or "")) for r in rows]
    sums = TC.suffix_sums(TC.length_histogram(clashing(table(spark, rows)), ranks), block=16)
    got = {r.n_tokens: r for r in sums.collect()}
    assert {k: r.n_docs for k, r in got.items()} == Counter(size)
    for k, r in got.items():
        assert r.docs_from == sum(s >= k for s in size) and r.tokens_from == sum(s for s in size if s >= k)
        assert (r.total_docs, r.total_tokens) == (len(size), sum(size))
        assert r.quantile == pytest.approx(sum(s <= k for s in size) / len(size))
        assert r.truncated_tokens == sum(min(s, k) for s in size) and r.truncated_docs == sum(s > k for s in size)
        assert r.lost_tokens == r.total_tokens - r.truncated_tokens
    limits = [0, 1, 17, 100, 10**6]
    for r in TC.at_limits(sums, limits).collect():
        assert r.truncated_tokens == sum(min(s, r.limit) for s in size) and r.truncated_docs == sum(s > r.limit for s in size)
    assert TC.suffix_sums(TC.length_histogram(spark.createDataFrame([], DOCS), ranks)).count() == 0


# Pages -----------------------------------------------------------------------


def test_lines_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="header-fixed">
    <script>var t="<p>no</p>";</script><header><h1>Site</h1></header><nav><ul><li><a href="/">Menu</a></ul></nav>
    <!-- <p>comment</p> --><div class="ad">Buy &amp; go</div><div class="cookie-notice">Cookies <div>inner</div> more</div>
    <article><header><h1>Title &lt;1&gt;</h1></header><p>One <b>bold\n  text<br>next &amp; last
    <p>Two <a href="x">link</a>.</p><ul><li>first<li>second</ul><aside>side</aside>
    <section id="comments"><article><p>reader</p></article></section><form>f</form></article>
    <p>outside</p><footer>&copy; f</footer></body></html>"""
    assert [x.text for x in PG.page_lines(page)] == ["Title <1>", "One bold text next & last", "Two link.", "first", "second"]
    page = """<div class="no-sidebar"><nav>n</nav><article><div class="entry-header"><h1>T</h1></div><p>text</p>
    <div class="social-share">s</div></article></div><div id="comments"><article>c</article></div>"""
    assert [x.text for x in PG.page_lines(page)] == ["T", "text"]
    assert PG.page_lines(None) == [] and PG.page_lines("") == [] and PG.page_lines("<p>") == []
    assert [x.text for x in PG.page_lines("<article><p>cut off &amp then <foot")][:1] == ["cut off & then <foot"]


def test_rules_for_chrome_take_no_whole_article():
    def lines(source):
        return [x.text for x in PG.page_lines(source)]

    story = "<p>A story that is told at some length.</p><p>Its second part.</p>"
    want = ["A story that is told at some length.", "Its second part."]
    nav = "<nav><a href=/>Menu</a></nav>"
    assert lines(f"<body><form action=x>{nav}<article>{story}</article></form>") == want
    assert lines(f"<body><form action=x>{nav}<div>{story}</div></form><div>{nav}</div>") == want
    assert lines(f"<html><head lang=en><title>T</title><meta charset=x><body>{nav}{story}") == want
    assert lines(f"<html><head><title>T</title>{story}") == want
    assert lines(f'<article class=x><div class="article-body no-comments">{story}</div></article>') == want
    assert lines(f"<div id=content class=has-sidebar>{story}</div>") == want
    assert lines(f"<article>Teaser</article><div>{story}</div>") == ["Teaser", *want]
    assert lines(f'<div>{story}</div><div class="site-footer">f</div><div id="comments">{"much said " * 50}</div>') == want
    assert lines(f"<div>{story}</div><form>{'<label>Name</label>' * 3}</form><footer>{'legal ' * 50}</footer>") == want


@pytest.mark.parametrize("seed", range(6))
def test_common_lines_is_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(6) for _ in range(rng.randrange(0, 14))] for _ in "ab")
    got = PG.common_lines(a, b)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert len(got) == best[-1][-1] and got == sorted(set(got))
    it = iter(b)
    assert all(any(a[i] == y for y in it) for i in got)
    assert SequenceMatcher(None, [a[i] for i in got], b, autojunk=False).ratio() >= 0


def page(*paragraphs, chrome=("Our site", "Share this page", "All rights")):
    top, mid, low = chrome
    return f"<body><div>{top}</div>" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"<div>{mid}</div><div>{low}</div></body>"


def test_shared_lines_of_nearest_pages_go(spark):
    rows = [
        (1, "http://a.org/news/1", page("alpha story told at length", "common passage")),
        (2, "http://A.org/news/2?x=1", page("beta story told at length", "common passage")),
        (3, "http://a.org/news/1/print", page("alpha story told at length", "common passage")),  # a copy of 1
        (4, "http://b.org/only", page("single page host")),
        (5, None, None),
        (6, "http://c.org/1", "<article><p>quoted passage</p><p>own one</p></article>"),
        (7, "http://c.org/2", "<article><p>quoted passage</p><p>own two</p></article>"),
        (8, "http://d.org/" + "p" * 3000, page(*[f"line {i}" for i in range(3000)])),
    ]
    rows.append(rows[3])
    got = PG.main_texts(clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert all(r.n_chars == len(r.text) for r in got)
    assert text[2] == "beta story told at length"
    assert "alpha story told at length" in text[1]
    assert text[5] == "" and text[4].startswith("Our site")
    assert text[6] == "quoted passage\n\nown one" and text[7] == "quoted passage\n\nown two"
    assert text[8].count("\n\n") == 3002
    assert PG.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_neighbours_are_exact_across_ranges(spark):
    """One hot host over many ranges: every page gets the nearer of its two
    neighbours in path order."""
    rng = random.Random(9)
    rows = [(i, i, "hot", f"/{rng.randrange(40)}/{rng.randrange(10**6)}") for i in range(300)] + [(900, 900, "x", "/a")]
    df = spark.createDataFrame(rows, "_k long, _k2 long, host string, path string").repartition(6)
    near = {r._k: r.near for r in PG.neighbours(df).collect()}
    order = sorted(rows, key=lambda r: (r[2], r[3], r[0]))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for n, r in enumerate(order):
        beside = [order[m] for m in (n - 1, n + 1) if 0 <= m < len(order) and order[m][2] == r[2]]
        if not beside:
            assert near[r[0]] is None
            continue
        best = min(beside, key=lambda o: distance(o[3], r[3]))
        assert near[r[0]]._k == best[0]


def test_quality_is_fitted_on_every_labelled_document(spark, monkeypatch):
    import zlib

    import numpy as np

    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, f"some good text number {i}. " * (1 + i % 7) if i % 3 else f"#### {i} | " * (1 + i % 5)) for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(4000)], "doc_id long, quality int")
    monkeypatch.setattr(QU, "GROUP", 100)
    monkeypatch.setattr(QU, "NEAR", 20)
    m = QU.fit(docs, labels)
    x = np.array([QU.features(r["text"].encode()) for r in docs.orderBy("doc_id").collect()])[ids]
    assert np.allclose(m.mean, x.mean(0)) and np.allclose(m.scale, x.std(0) + 1e-6)
    s, at = np.sort(m.strength(x)), sum(i % 3 == 0 for i in ids)
    assert np.isclose(m.threshold, (s[at - 1] + s[at]) / 2)
    assert ((m.score(x) >= QU.CUT) == (np.array(ids) % 3 > 0)).mean() > 0.99


def test_every_row_is_paired():
    import numpy as np

    for a, b in ((1, 9), (64, 1900), (700, 700), (3, 2)):
        d = QU.differences(np.arange(a, dtype=float)[:, None] * 10_000, np.arange(b, dtype=float)[:, None])
        ups = {round((v + b) // 10_000) for v in d[:, 0]} if b < 10_000 else set()
        assert len(d) >= QU.EACH * max(a, b) and len(ups) == a


def test_features_are_joined_to_labels_not_texts(spark, monkeypatch):
    """The join by id comes after the features: texts are not shuffled."""
    from plotline.llm import quality as Q

    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return df.localCheckpoint()

    monkeypatch.setattr(Q, "shared_table", kept)
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "||| $$$ !!!") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = Q.fit(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    p = plans["quality_features"]
    assert 0 <= p.find("SortMergeJoin") < p.find("MapInPandas")
    up, down = model.strength(np.array([Q.features(b"good words here"), Q.features(b"||| $$$ !!!")]))
    assert up > down
