"""Bradley-Terry quality scores from preference pairs.

The labelled documents give preference pairs (a document marked 1 over one marked
0): every one of them is in at least ``EACH`` pairs. The logistic loss on differences
of document features fits one weight per feature; a document's strength is its
weighted feature sum. The threshold is the quantile of all strengths at the share of
documents marked 0, and scores are shifted so that it lies at ``CUT``.

Features are written once. The documents are dealt into groups of about ``GROUP``,
paired inside their group; a label too rare for that is dealt into several groups.
Every Newton step is one job that sums gradients and curvatures over the groups; the
driver gets those sums, a few numbers for each task. Scoring is one pass over the
texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotline.llm.common import held_out, shared_table

#: Documents of a group, the least of them of either label, and pairs of each.
GROUP, LEAST, EACH = 2_000, 64, 5
PAIRS = 100_000
#: Strengths between which the threshold lies come to the driver from so many on.
NEAR = 10_000
CUT = 0.7

LOWER, UPPER, DIGITS = (bytes(range(a, b)) for a, b in ((97, 123), (65, 91), (48, 58)))
#: Character groups whose share of the bytes is a feature.
GROUPS = (LOWER, UPPER, DIGITS, b"#*$%&<>=~^@\\", b"|", b"!", b"?", b".,;:", b"\"'()[]{}", b"-_/+", b"\n", bytes(range(128, 256)))
N_FEATURES = len(GROUPS) + 9


def features(text: bytes | None) -> list[float]:
    """Shares of character groups, shouted, repeated and decorated words,
    repeated lines, word and line lengths of a whole text. Shares enter on a
    log scale, so that few junk lines in a long text still show."""
    text = text or b""
    n = max(1, len(text))
    shares = [(len(text) - len(text.translate(None, g))) / n for g in GROUPS]
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    w, k = max(1, len(words)), max(1, len(lines))
    shares += [
        sum(map(eq, words, words[1:])) / w,
        sum(map(eq, words, words[2:])) / w,
        1 - len(set(words)) / w,
        sum(map(bytes.isupper, words)) / w,
        1 - sum(map(bytes.isalpha, words)) / w,
        1 - len(set(lines)) / k if lines else 0.0,
    ]
    out = [float(np.log1p(200 * s)) for s in shares]
    return out + [float(np.log(w)), float(np.log1p(len(text) / w)), float(np.log1p(w / k))]


@dataclass(frozen=True)
class Ranking:
    """A fitted model: strength = weights . (features - mean) / scale."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.strength(x) - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_pairs(x: np.ndarray, better: np.ndarray, pairs: int = PAIRS, l2: float = 1e-3, seed: int = 7) -> Ranking:
    """Newton steps on the mean pair loss log(1 + exp(-w.(better - worse)))
    plus an L2 penalty. Without both labels there is no pair: all strengths
    are 0 and every document passes."""
    d = x.shape[1] if x.ndim == 2 else N_FEATURES
    x = x.reshape(-1, d)
    mean = x.mean(0) if len(x) else np.zeros(d)
    scale = x.std(0) + 1e-6 if len(x) else np.ones(d)
    w = np.zeros(d)
    up, down = np.flatnonzero(better == 1), np.flatnonzero(better == 0)
    if not len(up) or not len(down):
        return Ranking(mean, scale, w, 0.0)
    rng = np.random.default_rng(seed)
    z = (x - mean) / scale
    diff = z[rng.choice(up, pairs)] - z[rng.choice(down, pairs)]
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))  # chance of the wrong order
        grad = -(p @ diff) / pairs + l2 * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + l2 * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    s = np.sort(z @ w)
    at = int(len(down))
    threshold = float((s[at - 1] + s[min(at, len(s) - 1)]) / 2)
    return Ranking(mean, scale, w, threshold)


def dealt(rows: DataFrame, n_up: int, n_down: int) -> DataFrame:
    """``rows`` (``doc_id, label, x``) with a ``group``. A label with fewer than LEAST
    rows for each group is repeated in as many groups as it takes."""
    groups = max(1, (n_up + n_down) // GROUP)
    copies = [min(groups, -(-LEAST * groups // n)) for n in (n_down, n_up)]
    k = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 1, copies[1] - 1).otherwise(copies[0] - 1)))
    spot = F.pmod(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(groups)) + F.col("k"), F.lit(groups)).cast("int")
    return rows.select("*", k.alias("k")).select(spot.alias("group"), "doc_id", "label", "x")


def differences(up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Differences of pairs in which each row occurs EACH times or more."""
    n = np.arange(max(len(up), len(down)))
    turns = [(n + k * (len(up) // EACH or 1), n + k * (len(down) // EACH * 2 or 1)) for k in range(EACH)]
    return np.concatenate([up[i % len(up)] - down[j % len(down)] for i, j in turns])


def summed(groups: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of pairs, gradient and curvature of the pair loss at ``w``."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        z = (np.array(pdf["x"].tolist(), float) - mean) / scale
        up, down = z[pdf["label"] == 1], z[pdf["label"] == 0]
        if not len(up) or not len(down):
            return pd.DataFrame({"group": [], "v": []})
        diff = differences(up, down)
        p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))  # chance of the wrong order
        hess = (diff * (p * (1 - p))[:, None]).T @ diff
        return pd.DataFrame({"group": pdf["group"].iloc[:1], "v": [np.concatenate(([len(diff)], p @ diff, hess.ravel()))]})

    made = groups.groupBy("group").applyInPandas(one, "group int, v array<double>")
    # sums of a task's groups, then of the tasks
    sums = made.select("group", F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,12)")).cast("double").alias("v"))
    got = {r["i"]: r["v"] for r in sums.collect()}
    d = len(w)
    return np.array([got.get(i, 0.0) for i in range(1 + d + d * d)])


def ranked(strengths: DataFrame, at: int, n: int) -> float:
    """The middle between the ``at``-th smallest of ``n`` values ``s`` and the next."""
    low, high = strengths.agg(F.min("s"), F.max("s")).first()
    below = 0  # values under ``low``
    inside = strengths
    count = n
    while count > NEAR and high > low:
        edges = np.linspace(low, high, 1025)
        cut = F.floor((F.col("s") - F.lit(float(low))) / F.lit(float(edges[1] - edges[0])))
        bins = {r["b"]: r for r in inside.groupBy(cut.alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min("s").alias("l"), F.max("s").alias("h")).collect()}
        for b in sorted(bins):
            if below + bins[b]["c"] >= at:
                break
            below += bins[b]["c"]
        if bins[b]["c"] == count:
            break
        low, high, count = bins[b]["l"], bins[b]["h"], bins[b]["c"]
        inside = strengths.where(F.col("s").between(float(low), float(high)))
    ordered = [low] * count if high == low else sorted(r["s"] for r in inside.collect())
    own = ordered[at - below - 1]
    if at - below < len(ordered):
        after = ordered[at - below]
    else:
        after = strengths.where(F.col("s") > float(high)).agg(F.min("s")).first()[0]
    return float((own + (own if after is None else after)) / 2)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking:
    """Fit on all labelled documents that are not held out. Null labels and ids
    are ignored."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2))
    marked = marked.select("doc_id", F.col(label).cast("int").alias("label"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "x": [features(t) for t in b["text"]]})

    # features first: the join by id moves a few numbers for each document, not its text
    texts = docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2)).select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = texts.mapInPandas(run, "doc_id long, x array<double>").join(marked, "doc_id").select("doc_id", "label", "x")
    rows = shared_table(rows, "quality_features")
    d = N_FEATURES
    x = [F.get("x", F.lit(i)) for i in range(d)]
    n_up, n, *moments = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1)), *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    if not n_up or n_up == n:
        return Ranking(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean, scale = np.array(moments[:d], float), np.array(moments[d:], float) + 1e-6
    groups, w, l2 = dealt(rows, n_up, n - n_up), np.zeros(d), 1e-3
    for _ in range(30):
        total = summed(groups, mean, scale, w)
        pairs = total[0]
        if not pairs:
            return Ranking(mean, scale, w, 0.0)
        grad, hess = -total[1 : 1 + d] / pairs + l2 * w, total[1 + d :].reshape(d, d) / pairs + l2 * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    model = Ranking(mean, scale, w, 0.0)

    def strength(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"s": model.strength(np.array(b["x"].tolist(), float).reshape(-1, d))})

    strengths = shared_table(rows.select("x").mapInPandas(strength, "s double"), "quality_strengths")
    return Ranking(mean, scale, w, ranked(strengths, int(n - n_up), int(n)))


def scored(docs: DataFrame, model: Ranking, columns: list[str]) -> DataFrame:
    """``columns`` of every row with its ``score``; null texts score like
    empty ones."""
    kept = docs.select(*columns, F.col("text").cast("binary").alias("_bytes"))
    schema = kept.drop("_bytes").schema.add("score", "double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array([features(t) for t in b["_bytes"]], float).reshape(-1, N_FEATURES)
            yield b.drop(columns="_bytes").assign(score=model.score(x))

    return kept.mapInPandas(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``CUT`` on) of every row."""
    model = fit(docs, labels)
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def without_rejects(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (any columns) whose score reaches ``CUT``. The verdict is a
    scalar Pandas UDF on the text, so no other column goes to Python."""
    model = fit(docs, labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in text], float).reshape(-1, N_FEATURES)))

    return docs.where(score(F.col("text").cast("binary")) >= CUT)
