"""Toxicity by a counterfactual-regularised classifier.

Features of a text are its distinct words and word beginnings. The features
that separate a labelled sample best (likelihood ratio of document counts) and
the identity terms enter a logistic regression. For every sample text with
identity terms, the terms are swapped for others of their group, and for a
blank, and squared differences between the log odds of text and swapped text
are penalised: which group a text names, and that it names one, can't carry
weight by itself, which lowers false positives on neutral mentions.

The sample is bounded (``FIT_ROWS`` expected rows by id hash); only its rows
of selected feature numbers reach the driver. Scoring is one pass over the
texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotline.llm.common import bounded_labels, held_out

FIT_ROWS = 12_000
N_FEATURES = 600
BEGINNINGS = (4, 5, 6)
WORDS = re.compile(r"[^\W\d_]+")

#: Identity terms, by group; a term is swapped for the next of its group.
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("men", "women"),
    ("man", "woman"),
    ("boys", "girls"),
    ("male", "female"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees"),
    ("young", "old"),
    ("blind", "deaf", "disabled"),
)
SWAP = {a: g[(i + 1) % len(g)] for g in IDENTITIES for i, a in enumerate(g)}


def words(text: str | None) -> set[str]:
    return set(WORDS.findall((text or "").lower()))


def swapped(found: set[str], swap: dict[str, str] = SWAP) -> set[str]:
    return {swap.get(w, w) for w in found}


def features(found: Iterable[str]) -> set[str]:
    """Words, and beginnings of longer words (marked by a hyphen)."""
    out = set(found)
    for n in BEGINNINGS:
        out.update([w[:n] + "-" for w in found if len(w) > n])
    return out


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        get = self.weights.get
        z = self.bias + sum(get(f, 0.0) for f in features(words(text)) & self.weights.keys())
        return float(1 / (1 + np.exp(-min(500.0, max(-500.0, z)))))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, before: np.ndarray, after: np.ndarray, l2: float = 5e-6, swap_penalty: float = 1.0, steps: int = 600
) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on the logistic loss, its mean taken with
    equal weight of both labels, + l2 |w|^2 / 2 +
    swap_penalty * mean((before.w - after.w)^2) / 2. Columns are scaled by
    their root mean square while fitting, so that rare features, as most toxic
    words are, move as fast as common ones."""
    n, d = x.shape
    w, b = np.zeros(d), 0.0
    if not n or y.min() == y.max():
        return w, (0.0 if not n else (4.0 if y.max() else -4.0))
    scale = 1 / np.sqrt((x * x).mean(0) + 1e-3)
    part = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    x, delta, l2 = x * scale, (before - after) * scale, l2 * scale**2
    m = max(1, len(delta))
    v = np.ones(d) / np.sqrt(d)
    for _ in range(20):  # largest curvature
        v = 0.25 * (x.T @ (part * (x @ v))) + swap_penalty * (delta.T @ (delta @ v)) / m
        top = float(np.linalg.norm(v)) + 1e-12
        v /= top
    rate = 1 / (1.2 * top + 0.25 + l2.max())
    pw, pb = w, b
    for t in range(steps):
        k = t / (t + 3)
        aw, ab = w + k * (w - pw), b + k * (b - pb)
        p = 1 / (1 + np.exp(-np.clip(x @ aw + ab, -50, 50)))
        gw = x.T @ (part * (p - y)) + l2 * aw + swap_penalty * (delta.T @ (delta @ aw)) / m
        pw, pb = w, b
        w, b = aw - rate * gw, ab - rate * float((part * (p - y)).sum())
    return w * scale, b


def incidence(rows: list[list[int]], d: int) -> np.ndarray:
    x = np.zeros((len(rows), d))
    for i, r in enumerate(rows):
        x[i, r] = 1
    return x


def select_features(sample: DataFrame, n: int = N_FEATURES) -> list[str]:
    """The ``n`` features whose document counts differ most between labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts: dict[str, list[int]] = {}
            for text, label in zip(b["text"], b["label"], strict=True):
                for f in features(words(text)):
                    counts.setdefault(f, [0, 0])[label] += 1
            yield pd.DataFrame({"feature": list(counts), "n0": [c[0] for c in counts.values()], "n1": [c[1] for c in counts.values()]})

    counts = sample.select("text", "label").mapInPandas(run, "feature string, n0 long, n1 long")
    counts = counts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n0 + n1 >= 4")
    size = sample.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")).first()
    share = (size["n1"] or 0) / max(1, (size["n0"] or 0) + (size["n1"] or 0))
    seen = F.col("n0") + F.col("n1")
    gain = sum(
        F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (seen * F.lit(max(q, 1e-9))))).otherwise(0.0)
        for c, q in (("n1", share), ("n0", 1 - share))
    )
    best = counts.select("feature", gain.alias("gain")).orderBy(F.desc("gain"), "feature").limit(n)
    return [r["feature"] for r in best.collect()]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, swap: dict[str, str] = SWAP, **how) -> Model:
    """Fit on labelled documents that are not held out. Null labels and ids
    are ignored; without both labels every text gets the same score."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", 5, 0))
    marked = bounded_labels(marked.select("doc_id", F.col(label).cast("int").alias("label")), "doc_id", rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
    names = sorted({*select_features(sample), *swap})
    at = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def numbers(found: set[str]) -> list[int]:
            return sorted(at[f] for f in features(found) & at.keys())

        for b in batches:
            found = [words(t) for t in b["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"],
                    "label": b["label"],
                    "x": [numbers(f) for f in found],
                    "other": [numbers(swapped(f, swap)) if not swap.keys().isdisjoint(f) else None for f in found],
                    "blank": [numbers(f - swap.keys()) if not swap.keys().isdisjoint(f) else None for f in found],
                }
            )

    rows_ = sample.mapInPandas(run, "doc_id long, label int, x array<int>, other array<int>, blank array<int>").toPandas()
    rows_ = rows_.sort_values("doc_id", kind="stable")
    x = incidence(rows_["x"].tolist(), len(names))
    has = rows_["other"].notna().to_numpy()
    after = incidence(rows_["other"][has].tolist() + rows_["blank"][has].tolist(), len(names))
    w, b = fit_logistic(x, rows_["label"].to_numpy(float), np.concatenate([x[has], x[has]]), after, **how)
    return Model({f: float(v) for f, v in zip(names, w, strict=True) if v}, b)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.5 on) of every row; null
    texts score like empty ones."""
    model = fit(docs, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": [model.score(t) for t in b["text"]]})

    return (
        docs.select("doc_id", "text")
        .mapInPandas(run, "doc_id long, score double")
        .select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )
