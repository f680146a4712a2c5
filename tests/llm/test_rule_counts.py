"""Character classes of the quality rules, counted run by run."""

import contextlib
import io
import random
import re

from plotline.llm import rules as RU

SCHEMA = "doc_id long, text string, lang string"


def test_class_counts_equal_counts_of_single_characters(spark):
    every = "".join(map(chr, range(128)))
    texts = [every * 2, "aB1 .#\né\U0001f600", "##aa##  \t,,A_A|", "", None, "ä中" * 5, " \n\x0b\x0c\r", "a1" * 300]
    got = {r.doc_id: r for r in RU.measured(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        counts = [len(re.findall(p, text)) for p in RU.CLASSES.values()]
        assert list(got[i].chars) == [*counts, len(text) - sum(counts)]
        assert got[i].n_symbols == len(re.findall("[#*$%&|<>]", text))
        assert got[i].word_chars == len(re.sub("[\\x20\\x09-\\x0D]", "", text))


def test_no_list_of_single_characters_is_built(spark):
    """A list of the matches of a class has an entry for nearly every character."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        RU.measured(spark.createDataFrame([(1, "x", "en")], SCHEMA)).explain(True)
    assert "regexp_extract_all" not in out.getvalue() and "regexp_replace" in out.getvalue()


def covered(w, size):
    at = {}
    for i in range(len(w) - size + 1):
        at.setdefault(tuple(w[i : i + size]), []).append(i)
    return len({k for found in at.values() if len(found) > 1 for i in found for k in range(i, i + size)})


def test_repeated_and_common_words_equal_plain_counts(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["a", "b", "c.", "ä", "$1"], k=n)) for n in (0, 1, 4, 5, 6, 7, 9, 30, 400)]
    texts += ["x y z u v " * 2 + "x y z u", "x y z u q x y z u r", "a a a a a a", "a a a a a", "\\E.* | \\E.* (a"]
    rows = [(i, t.split(), common) for i, t in enumerate(texts) for common in ([], ["a"], ["\\E.*", "a", "$1", "zz"])]
    df = spark.createDataFrame(rows, "doc_id long, w array<string>, common array<string>")
    for size in (2, 3, 4, 5, 8):
        for r in RU.with_repeated_words(df, size).collect():
            assert r.n_repeat_words == covered(r.w, size), (size, r.w)
    for r in RU.with_word_counts(df).collect():
        assert r.by_word == [*(r.w.count(c) for c in r.common), sum(x not in r.common for x in r.w)]


def test_words_are_not_looked_at_one_by_one_for_each_common_word(spark):
    """A lambda over the words is not compiled; it took most of the time of the counts."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df = spark.createDataFrame([(["a"], ["a"])], "w array<string>, common array<string>")
        RU.with_word_counts(df).explain(True)
    assert "lambda" not in out.getvalue()
