"""Language identification by word-first backoff.

A word that the model knows adds its log frequency in each language. For an
unseen word the model falls back to the longest order of character n-grams
(from ``ORDERS[0]`` down to single characters, with marked word ends) of which
it knows at least one, and adds the mean of their log frequencies. The
language with the largest sum wins.

The model is fitted on a bounded sample of documents with a language (``FIT_ROWS``
expected rows of each language by a hash of id and text): word counts per language
are summed by Spark, the ``KEEP`` most frequent words of each language are the known
ones, and the n-gram counts are those of their occurrences. So what is learned of a
language does not shrink as others grow. Scoring is one pass over the whole texts
without a shuffle.

Defined results: ``und`` with score 0 for a null text and one without a letter
(Unicode categories L*; digits and other numerals are none). Rows without id or
language are scored, not learned from. Repeated rows are scored each. Languages that
tie go by name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import held_out

FIT_ROWS = 3_000
ORDERS = (5, 4, 3, 2, 1)
KEEP = 15_000
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> Counter:
    """Runs of letters, lower case, with their numbers."""
    found = Counter(WORDS.findall((text or "").lower()))
    for mixed in [w for w in found if not w.isalpha()]:  # numerals that are no digits
        n = found.pop(mixed)
        for part in "".join(c if c.isalpha() else " " for c in mixed).split():
            found[part] += n
    return found


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass(frozen=True)
class Model:
    """Log frequencies by language: ``known`` and ``tables[n]`` give the row
    of a word or an n-gram in ``logs`` (one column per language)."""

    languages: list[str]
    known: dict[str, int]
    tables: dict[int, dict[str, int]]
    logs: np.ndarray

    def rows(self, word: str) -> list[int]:
        """Rows whose mean is the word's vector; none for a word without any
        known character."""
        at = self.known.get(word)
        if at is not None:
            return [at]
        for n in ORDERS:
            table = self.tables[n]
            found = [table[g] for g in grams(word, n) if g in table]
            if found:
                return found
        return []


class Scorer:
    """Predicts texts; vectors of words met before are kept, up to a bound."""

    def __init__(self, model: Model, keep: int = 300_000):
        self.model, self.keep = model, keep
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.vectors = np.zeros((0, len(self.model.languages)))

    def learn(self, new: list[str]) -> None:
        rows = [self.model.rows(w) for w in new]
        size = np.array([len(r) for r in rows])
        sums = np.zeros((len(new), len(self.model.languages)))
        has = np.flatnonzero(size)
        if len(has):
            flat = np.fromiter((i for r in rows for i in r), np.int64, int(size.sum()))
            sums[has] = np.add.reduceat(self.model.logs[flat], np.r_[0, np.cumsum(size[has])[:-1]]) / size[has][:, None]
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
        self.vectors = np.concatenate([self.vectors, sums])

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        counts = [words(t) for t in texts]
        if len(self.at) > self.keep:
            self.forget()
        self.learn(list(set().union(*counts) - self.at.keys()))
        return [self.predict(c) for c in counts]

    def predict(self, counts: Counter) -> tuple[str, float]:
        if not counts or not self.model.languages:
            return UNKNOWN, 0.0
        at = np.fromiter(map(self.at.__getitem__, counts), np.int64, len(counts))
        total = np.fromiter(counts.values(), float, len(counts)) @ self.vectors[at]
        best = int(total.argmax())  # ties: first by name
        return self.model.languages[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def build(counts: pd.DataFrame) -> Model:
    """From (word, lang, n), in any order: add-half log frequencies of the words and of the
    n-grams in their occurrences."""
    counts = counts.sort_values(["word", "lang"])
    names = sorted(counts["lang"].unique())
    column = {l: i for i, l in enumerate(names)}
    found: dict[int, dict[str, list[float]]] = {n: {} for n in (0, *ORDERS)}
    for word, lang, k in zip(counts["word"], counts["lang"], counts["n"], strict=True):
        for n, table in found.items():
            for g in [word] if n == 0 else grams(word, n):
                table.setdefault(g, [0.0] * len(names))[column[lang]] += k
    logs, tables = [np.zeros((0, len(names)))], {}
    for n, table in found.items():
        start = sum(map(len, logs))
        tables[n] = dict(zip(table, range(start, start + len(table)), strict=True))
        if table:
            x = np.array(list(table.values())) + 0.5
            logs.append(np.log(x / x.sum(0)))
    return Model(names, tables.pop(0), tables, np.concatenate(logs))


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, lang, n); each task counts a batch before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                found: Counter = Counter()
                for t in texts:
                    found.update(words(t))
                yield pd.DataFrame({"word": list(found), "lang": lang, "n": list(found.values())})

    rows = sample.mapInPandas(run, "word string, lang string, n long")
    return rows.groupBy("word", "lang").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, rows: int = FIT_ROWS, keep: int = KEEP) -> Model:
    """Fit on documents with text and language that are not held out."""
    ids = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2))
    # one number for each language, kept as one value: the share of its rows that
    # leaves about ``rows``
    sizes = ids.groupBy("lang").agg((F.lit(float(rows)) / F.count(F.lit(1))).alias("share"))
    shares = sizes.select(F.map_from_entries(F.collect_list(F.struct("lang", "share")))).scalar()
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = ids.where(place < F.try_element_at(shares, F.col("lang"))).select("lang", "text")
    counts = word_counts(sample)
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    known = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep).select("word").distinct()
    return build(counts.join(known, "word").toPandas())


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; ``und`` with score 0
    for a null text or one without a letter."""
    model = fit(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = Scorer(model)
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at : at + 500]
                found = score(list(part["text"]))
                yield pd.DataFrame({"doc_id": part["doc_id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    return (
        docs.select("doc_id", "text")
        .mapInPandas(run, "doc_id long, lang_pred string, score double")
        .select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
    )
