import random

import numpy as np
import pytest
from helpers import clashing, documents, near_components, prose, shingles, table
from pyspark.sql import functions as F

from plotline.llm.near_dup import NearDup, Shingler, components, near_duplicates, one_of_each


def check(spark, rows, cfg=NearDup()):
    got = near_duplicates(table(spark, rows), cfg).collect()
    assert len(got) == len(rows)
    want = near_components(rows)
    size = {(r[0], len(shingles(r[1]))) for r in rows}
    for r in got:
        assert (r.doc_id, r.n_shingles) in size
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_matches_all_pairs_with_nulls_blanks_repeats(spark):
    check(spark, documents())


def test_cut_units_lose_no_link(spark):
    """One large group of near copies, compared in blocks of 6 documents."""
    rng = random.Random(3)
    base = prose(rng, 60)
    rows = []
    for i in range(50):
        words = list(base)
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(words), "en", "hot", 1))
    check(spark, rows, NearDup(block=6))


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (7, "a b c d e f", "en", "s", 1)]
    check(spark, rows)
    assert near_duplicates(table(spark, [])).count() == 0
    assert one_of_each(table(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_every_clean_document(spark):
    rows = documents()
    docs = clashing(table(spark, rows))
    got = one_of_each(docs)
    assert got.columns == docs.columns
    want = {i for i, c in near_components(rows).items() if i == c}
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_shingles_of_short_texts_and_case():
    s = Shingler(5)
    assert len(s(None)) == len(s(b" \n")) == 0
    assert len(s(b"one two")) == 1
    assert np.array_equal(s(b"A b C d E f"), s(b"a B c\td\ne F"))
    assert not np.array_equal(s("É a b".encode()), s("é a b".encode()))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(12)]
    low = {}

    def root(i):
        while low.setdefault(i, i) != i:
            i = low[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        low[b] = a
    got = {r.doc_id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for i in low}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_of_one_id_count_as_one_document(spark):
    rng = random.Random(5)
    a, b = " ".join(prose(rng, 40)), " ".join(prose(rng, 40))
    rows = [(1, a, "en", "s", 1), (2, a, "en", "s", 1), (2, b, "en", "s", 1), (3, b, "en", "s", 1)]
    got = near_duplicates(table(spark, rows)).agg(F.collect_set("component_id").alias("c")).first().c
    assert got == [1]


def test_one_of_each_decides_by_text_where_an_id_repeats(spark):
    rng = random.Random(5)
    a, b, c = (" ".join(prose(rng, 40)) for _ in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, c), (4, ""), (4, " "), (5, "")]
    got = one_of_each(table(spark, [(i, t, "en", "s", 1) for i, t in rows])).collect()
    assert sorted((r.doc_id, r.text.strip()) for r in got) == sorted([(1, a), (2, b), (4, c), (4, ""), (5, "")])


def test_one_of_each_compares_rows_without_id(spark):
    rng = random.Random(6)
    a, b = (prose(rng, 40) for _ in "ab")
    near = " ".join(["other", *b[1:]])
    a, b = " ".join(a), " ".join(b)
    rows = [(None, a), (7, a), (None, a), (None, b), (None, near), (None, b), (None, ""), (None, None)]
    got = one_of_each(table(spark, [(i, t, "en", "s", 1) for i, t in rows])).collect()
    assert len(got) == 4 and {r.doc_id for r in got if r.text == a} == {7}
    assert len([r for r in got if r.text in (b, near)]) == 1
