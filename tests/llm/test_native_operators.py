"""Decontamination, rules, mixing and sharding against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, clashing, documents, prose, table

from plotline.llm import decontaminate as DC
from plotline.llm import mixing as MX
from plotline.llm import rules as RU
from plotline.llm import shards as SH

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Decontamination -------------------------------------------------------------


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def contaminated(rows, items):
    wins = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        if w and i is not None:
            n = min(13, len(w))
            for k in range(len(w) - n + 1):
                wins[tuple(w[k : k + n])].add(str(i))
    out = []
    for r in rows:
        w = item_words(r[1])
        hit, ids = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                found = wins.get(tuple(w[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids |= found
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(ids), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("short", [False, True])
def test_decontamination_matches_brute_force(spark, short):
    rng = random.Random(4)
    rows = documents()
    items = [(k, " ".join(item_words(rows[i][1])[5:30])) for k, i in enumerate((0, 1, 7, 8))] + [(9, None), (10, " .!"), (11, rows[0][1])]
    if short:
        items += [(20, "w1 W2"), (21, rows[2][1].split()[3]), (22, "ünïcode word")]
    rows += [(200, "Zz, " + "; ".join(item_words(rows[0][1])[5:30]).upper() + " zz", "en", "b", 1)]
    rows += [(201, " ".join(prose(rng, 300) + item_words(rows[1][1])[5:18]), "en", "b", 1)]
    docs, bench = table(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in DC.decontaminated(docs, bench).collect()]
    want = contaminated(rows, items)
    assert sorted(got) == sorted(want)
    clean = DC.without_contaminated(clashing(docs), bench)
    assert clean.columns == clashing(docs).columns
    bad = Counter(r[0] for r in want if r[5])
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r[0] for r in rows) - bad
    scrubbed = {r.doc_id: r.text for r in DC.without_spans(clashing(docs), bench).collect()}
    n_words = {r[0]: r[1] - r[2] for r in want}
    assert {i: len(item_words(t)) for i, t in scrubbed.items()} == n_words
    assert scrubbed[60] is None


def test_items_without_id_contaminate(spark):
    rng = random.Random(8)
    a, b, own = (" ".join(prose(rng, 20)) for _ in range(3))
    docs = table(spark, [(1, a, "en", "s", 1), (2, f"{a} {b}", "en", "s", 1), (3, own, "en", "s", 1)])
    items = spark.createDataFrame([(None, a), (5, b), (5, None)], "item_id long, text string")
    got = {r.doc_id: r for r in DC.decontaminated(docs, items).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [(20, 0, True), (40, 1, True), (0, 0, False)]
    assert [got[i].items_sha256 for i in (1, 2)] == [hashlib.sha256(x).hexdigest() for x in (b"", b"5")]
    assert [r.doc_id for r in DC.without_contaminated(docs, items).collect()] == [3]


@pytest.mark.parametrize("most", [200_000, 0])
def test_a_hit_takes_no_more_than_its_window_along(spark, monkeypatch, most):
    monkeypatch.setattr(DC, "BROADCAST_WINDOWS", most)
    passage = [f"word{i}" for i in range(400)]
    docs = table(spark, [(1, " ".join(passage * 2), "en", "a", 1)])
    found = DC.hits(docs, spark.createDataFrame([(7, " ".join(passage))], "item_id long, text string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if re.search(r"Join Inner", line))
    above = plan[: join + (1 if most else 2)]  # shuffled: what goes into the join too
    assert not [line for line in above if re.search(r"[\[ ]w#\d+[,\]]", line)]
    (row,) = found.collect()
    assert (row["n_words"], row["n_hit"], len(row["spans"]), row["items"]) == (800, 800, 776, ["7"])


def test_decontamination_without_items_or_rows(spark):
    docs = table(spark, documents(n=5))
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 and not r.contaminated for r in DC.decontaminated(docs, none).collect())
    assert DC.decontaminated(table(spark, []), none).count() == 0
    assert DC.without_contaminated(docs, none).count() == docs.count()


def test_windows_join_without_broadcast(spark, monkeypatch):
    rows = documents()
    items = [(1, " ".join(item_words(rows[0][1])[2:40]))]
    monkeypatch.setattr(DC, "BROADCAST_WINDOWS", 0)
    got = DC.decontaminated(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == sorted(contaminated(rows, items))


# Rules -----------------------------------------------------------------------


def base_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    where = defaultdict(list)
    for i in range(len(w) - 4):
        where[tuple(w[i : i + 5])].append(i)
    repeat = {p for v in where.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeat))


def test_base_counts_match_plain_python(spark):
    rows = documents() + [
        (300, "a b c d e f a b c d e x\n\na b\na b\n \n", "en", "b", 1),
        (301, "x " * 3000, "en", "b", 1),
        (302, "one two three four five " * 2, "en", "b", 1),
        (303, "# a | b $ <c> & 100% d e \u0085f", None, "b", 1),
    ]
    docs = clashing(table(spark, rows))
    want = {r[0]: base_counts(r[1]) for r in rows}
    for r in RU.quality_rules(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id], r.doc_id
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    assert RU.quality_rules(table(spark, [])).count() == 0


def test_divergence_rejects_other_distributions_only(spark):
    rng = random.Random(6)
    words = ["the"] * 8 + ["and"] * 5 + ["of"] * 3 + [f"{a}{b}" for a in "abcdefgh" for b in ("lo", "mi", "ra")]
    rows = [(i, ". ".join(" ".join(rng.choices(words, k=9)) for _ in range(20)), "en", "s", 1) for i in range(60)]
    junk = [
        (100, "@@ ## == ~~ {}[]^^ " * 40 + " ".join(f"k{i}" for i in range(100)), "en", "s", 1),
        (101, " ".join(f"Q{chr(65 + i % 26)}Z{chr(65 + i // 26 % 26)}" for i in range(300)), "en", "s", 1),
        (102, "short: 555-1234 !!", "en", "s", 1),
    ]
    got = {r.doc_id: r for r in RU.quality_rules(table(spark, rows + junk)).collect()}
    assert all(got[i].kept for i in range(60))
    assert not got[100].kept and not got[101].kept
    assert got[102].char_distance is None and got[102].word_distance is None


def test_distance_of_known_histograms(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5])], "p array<double>, q array<double>")
    assert [r.d for r in df.select(RU.distance(F.col("p"), F.col("q")).alias("d")).collect()] == [1.0, 0.0]


# Mixing ----------------------------------------------------------------------


def test_targets_follow_the_resharing_rule(spark):
    sizes = {"a": 10, "b": 400, "c": 90, "d": 3, "e": 0, None: 700}
    got = {r.source: r.target for r in MX.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    names = sorted(x for x in sizes if x is not None) + [None]
    weight = {x: (5, 2, 1)[i % 3] for i, x in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = total - sum(stopped.values())
        unit = rest / sum(weight[x] for x in names if x not in stopped)
        over = [x for x in names if x not in stopped and weight[x] * unit > 3 * sizes[x]]
        if not over:
            break
        stopped |= {x: 3 * sizes[x] for x in over}
    want = {x: stopped.get(x, weight[x] * unit) for x in names}
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(total)


def test_mix_takes_its_targets(spark):
    rows = documents(n=400)
    docs = clashing(table(spark, rows))
    got = MX.mixed(docs)
    assert got.columns == [c for c in docs.columns if c not in ("_size", "_copies")] + ["_size", "_source_size", "_target", "_copies"]
    got = got.collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        assert r._size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert 0 <= r._copies <= 3
        by[r.source].append(r)
    for part in by.values():
        taken, target = sum(r._copies * r._size for r in part), part[0]._target
        assert part[0]._source_size == sum(r._size for r in part)
        repeated = 2 * max(r._size for r in part)  # rows that repeat an id are taken together
        assert abs(taken - target) <= repeated
        copies = {r._copies for r in part}
        assert max(copies) - min(copies) <= 1
    again = MX.mixed(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r._copies) for r in got) == sorted((r.doc_id, r._copies) for r in again)


def test_mix_cuts_between_rows_of_one_id_and_size(spark):
    import duckdb

    from plotline.llm import oracles

    rng = random.Random(12)
    rows = [(i, " ".join(prose(rng, rng.randrange(5, 30))), "en", rng.choice("abc"), 1) for i in range(200)]
    for i in range(400):
        text = " ".join(prose(rng, 20)) if i % 2 else "same words " * 10
        rows.append((None if i % 3 else 7, text, "en", "abc"[i % 3], 1))
    docs = table(spark, rows)
    got = MX.mixed(clashing(docs)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    for s in "abc":
        part = [r for r in got if r.source == s]
        assert abs(sum(r._copies * r._size for r in part) - part[0]._target) <= max(r._size for r in part)
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(f"WITH {oracles.mixing_ctes('documents')} SELECT doc_id, size, copies FROM mix").fetchall()
    assert Counter((r.doc_id, r._size, r._copies) for r in got) == Counter(want)
    again = MX.mixed(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.text, r._copies) for r in got) == Counter((r.doc_id, r.text, r._copies) for r in again)


def test_mix_of_nothing(spark):
    assert MX.mixed(table(spark, [])).count() == 0
    rows = [(1, None, "en", None, 0), (2, "", "en", "a", 0)]
    assert [r._size for r in MX.mixed(table(spark, rows)).collect()] == [0, 0]


def test_rank_prefers_likely_documents():
    def odds(u, p):
        return (u / (1 - u)) / (p / (1 - p))

    rng = random.Random(1)
    p = [0.1, 0.3, 0.5, 0.7, 0.4]  # two of five on average
    n, taken = 20_000, Counter()
    for _ in range(n):
        taken.update(sorted(range(5), key=lambda i: odds(rng.random(), p[i]))[:2])
    assert all(math.isclose(taken[i] / n, p[i], abs_tol=0.03) for i in range(5))


# Sharding --------------------------------------------------------------------


def test_shards_are_gapless_even_and_in_proportion(spark):
    rows = documents(n=700)
    docs = table(spark, rows)
    got = SH.sharded(docs).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    sources = {r[0]: r[3] for r in rows}
    total = Counter(r[3] for r in rows)
    for s in range(24):
        here = Counter(sources[r.doc_id] for r in got if r.shard == s)
        assert all(abs(here[k] - n / 24) <= 2 for k, n in total.items())
    again = SH.sharded(docs.repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_with_shards_keeps_texts(spark):
    rows = documents(n=50) + [(None, "x", "en", None, 1), (None, "y", "en", None, 1)]
    docs = clashing(table(spark, rows))
    got = SH.with_shards(docs)
    assert got.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r[0], r[1]) for r in rows)
    assert got.select("shard", "slot").distinct().count() == len(rows)
    assert SH.with_shards(spark.createDataFrame([], DOCS)).count() == 0
