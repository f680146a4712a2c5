"""M1, trained: out-of-fold classes by multinomial logistic regression on hashed
TF-IDF features (hashed by ``pyspark.ml``). ``infer.out_of_fold_predictions`` is the
counting variant (naive Bayes).

Texts become hashed term frequencies once, in a written table of packed numbers. For
every fold the document frequencies and the regression are fitted on the labelled rows
of the other folds only. A pass over the table sums the gradients of several folds at
once, streamed batch by batch: nothing but the table is kept on disk or in memory, and
the models on the driver are (folds x classes x features) numbers, whatever the corpus.

The fit is that of ``pyspark.ml``'s ``LogisticRegression`` without standardization (L-BFGS
on features divided by their deviation, centred, the penalty on undivided ones; one
weight vector for two classes), which keeps a copy of the features for every fold.
"""

from __future__ import annotations

import math
import tempfile
from collections import defaultdict
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotline.session import work_path

#: Terms that a task works on at once, and those looked up at once.
PIECE, LOOKUP = 1 << 18, 1 << 14
#: Numbers of one row of a task's sums.
CHUNK = 1 << 14
#: Has a pass remove its shuffled sums when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Steps that L-BFGS remembers, its tolerance, function values it looks back on.
MEMORY, TOLERANCE, LOOK_BACK = 10, 1e-6, 20


def words(text_col: str) -> Column:
    """The word runs of a text, lower case; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"(?U)\W+"), lambda x: x != "")


def terms(words_col: str) -> Column:
    """The words and their first and last three letters, which stand in
    for words that training has not seen."""
    w = F.col(words_col)
    ends = [F.transform(w, lambda x: F.concat(F.lit("<"), F.substring(x, 1, 3))), F.transform(w, lambda x: F.concat(F.lit(">"), F.right(x, F.lit(3))))]
    return F.concat(w, *ends)


class SearchFailed(ArithmeticError):
    """No step in this direction meets the Wolfe conditions."""


def descent(grad: np.ndarray, steps: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """The L-BFGS direction; ``steps`` and changes of the gradient, latest first."""
    d, scale, a = grad.copy(), 1.0, []
    if steps:
        sy = steps[0] @ turns[0]
        if sy < 0 or math.isnan(sy):
            raise SearchFailed
        scale = sy / (turns[0] @ turns[0])
    rho = [s @ y for s, y in zip(steps, turns, strict=True)]
    for s, y, r in zip(steps, turns, rho, strict=True):
        a.append(s @ d / r)
        d -= a[-1] * y
    d *= scale
    for s, y, r, k in reversed([*zip(steps, turns, rho, a, strict=True)]):
        d += (k - y @ d / r) * s
    return -d


Evaluated = tuple[float, np.ndarray]


def wolfe_step(x: np.ndarray, value: float, grad: np.ndarray, d: np.ndarray, t: float) -> Generator[np.ndarray, Evaluated, tuple]:
    """(step, point, value, gradient) by the strong Wolfe conditions, with cubic
    interpolation. Yields the points whose value and gradient it needs."""
    slope = float(grad @ d)
    if slope > 0:
        raise SearchFailed

    def at(t):
        point = x + t * d
        f, g = yield point
        return t, f, float(g @ d), point, g

    def between(a, b):  # (step, value, slope) each, a left of b
        d1 = a[2] + b[2] - 3 * (a[1] - b[1]) / (a[0] - b[0])
        root = d1 * d1 - a[2] * b[2]
        d2 = math.sqrt(root) if root >= 0 else math.nan
        width, below = b[0] - a[0], b[2] - a[2] + 2 * d2
        t = b[0] - width * (b[2] + d2 - d1) / below if below else math.nan
        return a[0] + 0.1 * width if t < a[0] + 0.1 * width else a[0] + 0.9 * width if t > a[0] + 0.9 * width else t

    def zoom(low, high):
        for _ in range(10):
            c = yield from at(between(high, low) if low[0] > high[0] else between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return c
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed

    low = (0.0, value, slope)
    for i in range(10):
        c = yield from at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            c = yield from zoom(low, c)
        elif abs(c[2]) > 0.9 * abs(slope):
            if c[2] < 0:
                low, t = c, t * 1.5
                continue
            c = yield from zoom(c, low)
        return c[0], c[3], c[1], c[4]
    raise SearchFailed


def minimised(x: np.ndarray, iterations: int) -> Generator[np.ndarray, Evaluated, np.ndarray]:
    """The point that L-BFGS reaches from ``x``. Yields the points whose value and
    gradient it needs, so that the fits of several folds share a pass over the rows."""
    # in a file: for all folds these are twenty times their models
    room = np.asarray(np.memmap(tempfile.TemporaryFile(), np.float64, "w+", shape=(2, MEMORY, len(x))))
    value, grad = yield x
    first, seen, used, done, failed = value, [math.inf], [], 0, False
    while done < iterations and np.linalg.norm(grad) > max(TOLERANCE * value, 1e-8):
        if len(seen) > 1 and abs(value - max(seen)) <= TOLERANCE * first:
            break
        try:
            d = descent(grad, [room[0, k] for k in used], [room[1, k] for k in used])
            t, point, f, g = yield from wolfe_step(x, value, grad, d, 1.0 if done else 1 / np.linalg.norm(d))
            if t * np.linalg.norm(grad) < 1e-10:
                raise SearchFailed
        except SearchFailed:
            if failed:
                break
            failed, used = True, []
            continue
        used = [used[-1] if len(used) == MEMORY else len(used), *used][:MEMORY]
        np.subtract(point, x, out=room[0, used[0]])
        np.subtract(g, grad, out=room[1, used[0]])
        x, value, grad, seen = point, f, g, [*seen, f][-LOOK_BACK:]
        done, failed = done + 1, False
    return x


# Sums over the table (run inside tasks) ---------------------------------------


@dataclass
class Rows:
    """Rows with at least one term: fold and class by their place in the lists (-1:
    none), and the terms of all rows in turn; ``at`` are the rows' places in the batch."""

    at: np.ndarray
    fold: np.ndarray
    label: np.ndarray
    start: np.ndarray
    term: np.ndarray
    count: np.ndarray

    def __post_init__(self):
        sizes = np.diff(np.append(self.start, len(self.term)))
        self.row = np.repeat(np.arange(len(self.start)), sizes)

    def weighted(self, weights: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Sums of ``count`` times the ``weights`` (a row each) of a row's terms."""
        out = np.zeros((len(self.at), weights.shape[1]))
        a = 0
        while a < len(self.start):
            s = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.start, s + LOOKUP)))
            e = self.start[b] if b < len(self.start) else len(self.term)
            found = weights.take(self.term[s:e], axis=0)
            found *= count[s:e, None]
            out[a:b] = np.add.reduceat(found, self.start[a:b] - s, axis=0)
            a = b
        return out

    def by_term(self, of_row: np.ndarray, count: np.ndarray, features: int) -> Iterator[np.ndarray]:
        """For each column, sums by term of ``count`` times what its rows have."""
        for k in range(of_row.shape[1]):
            w = of_row[:, k].take(self.row)
            w *= count
            yield np.bincount(self.term, w, features)


def numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Start of each row and all numbers of a column of packed ones."""
    data, size = column.cast(pa.large_binary()), np.dtype(kind).itemsize
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    flat = np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return (ends - ends[0]) // size, flat.view(kind)


def pieces(b: pa.RecordBatch, folds: list, classes: list[str], kind: str, places: np.ndarray) -> Iterator[Rows]:
    """A batch in pieces of about PIECE terms, each by its place in ``places``. Rows
    without terms come in a piece of their own, with none."""
    place = lambda name, values: pc.fill_null(pc.index_in(b.column(name), pa.array(values, b.column(name).type)), -1).to_numpy(zero_copy_only=False)
    fold, label = place("__fold", folds), place("__class", classes)
    ends, term = numbers(b.column(b.schema.get_field_index("__terms")), kind)
    _, count = numbers(b.column(b.schema.get_field_index("__counts")), "<u4")
    none = np.flatnonzero(np.diff(ends) == 0)
    yield Rows(none, fold[none], label[none], np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    full = np.flatnonzero(np.diff(ends))
    a = 0
    while a < len(full):
        s = ends[full[a]]
        z = max(a + 1, int(np.searchsorted(ends[full], s + PIECE)))
        own = full[a:z]
        e = ends[own[-1] + 1]
        yield Rows(own, fold[own], label[own], ends[own] - s, places.take(term[s:e]), count[s:e].astype(float))
        a = z


def packed(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` with the term frequencies ``__tf`` as packed numbers: ``__terms`` of
    ``kind``, and their ``__counts``."""

    def column(lists: pa.Array, kind: str) -> pa.Array:
        ends = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(kind)
        ends = ((ends - ends[0]) * flat.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(flat)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tf = b.column(b.num_columns - 1)
            made = [column(tf.field("indices"), kind), column(tf.field("values"), "<u4")]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], names=[*b.schema.names[:-1], "__terms", "__counts"])

    kept = rows.select("__id", "__fold", "__class", "__tf")
    return kept.mapInArrow(run, kept.drop("__tf").schema.add("__terms", "binary").add("__counts", "binary"))


@dataclass
class Table:
    """The written term frequencies, with the values that folds and classes have, and
    the place of each term among the ``features``."""

    rows: DataFrame
    folds: list
    classes: list[str]
    features: int
    kind: str
    places: np.ndarray

    def without(self, unused: np.ndarray) -> Table:
        """Only the features that occur: so many numbers a model has."""
        used = np.flatnonzero(~unused)
        places = np.zeros(self.features, np.int64)
        places[used] = range(len(used))
        return replace(self, features=len(used), places=places)

    def each(self, of_batch: Callable, rows: DataFrame, schema) -> DataFrame:
        """What ``of_batch`` (partition's batches, as pairs of batch and pieces) yields."""
        known = self.folds, self.classes, self.kind, self.places
        return rows.mapInArrow(lambda batches: of_batch((b, pieces(b, *known)) for b in batches), schema)

    def summed(self, add: Callable[[np.ndarray, Rows], None], size: int) -> np.ndarray:
        """The sum that ``add`` makes of all pieces. A task for each core adds up its
        share, so that there are few sums to add however large the table."""

        def run(batches) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for _, found in batches:
                for piece in found:
                    add(total, piece)
            part = TaskContext.get().partitionId()
            for k, a in enumerate(range(0, size, CHUNK)):
                own = [pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([total[a : a + CHUNK].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(own, names=["chunk", "part", "v"])

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(v) for v in pdf.sort_values("part")["v"])
            return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "v": [total.tobytes()]})

        spark = self.rows.sparkSession
        tasks = self.rows.coalesce(max(1, spark.sparkContext.defaultParallelism))
        kept = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            sums = self.each(run, tasks, "chunk int, part int, v binary").groupBy("chunk").applyInPandas(one, "chunk int, v binary")
            got = sorted(sums.collect(), key=lambda r: r["chunk"])
        finally:
            spark.conf.unset(CLEANUP) if kept is None else spark.conf.set(CLEANUP, kept)
        return np.concatenate([np.empty(0), *(np.frombuffer(r["v"]) for r in got)])


@dataclass
class Fold:
    """What a fold's fit knows of its training rows. ``labels`` are classes by place in
    the list; ``unit`` is what a term frequency is multiplied with, ``shift`` what centres it."""

    place: int
    labels: list[int]
    rows: np.ndarray
    idf: np.ndarray
    unit: np.ndarray | None = None
    shift: np.ndarray | None = None
    back: np.ndarray | None = None  # 1 / variance, 0 for features without any

    @property
    def columns(self) -> int:
        return 1 if len(self.labels) == 2 else len(self.labels)

    def first(self) -> np.ndarray:
        """No weights; intercepts by the classes' shares."""
        n = self.rows
        free = np.log(n[1:] / n[:1]) if self.columns == 1 else np.log1p(n) - np.log1p(n).mean()
        return np.concatenate((np.zeros(len(self.idf) * self.columns), free))

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights (features x columns) and intercepts."""
        return x[: -self.columns].reshape(-1, self.columns), x[-self.columns :]

    def model(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same as weights of term frequencies and constants."""
        w, free = self.parts(x)
        return w * self.unit[:, None], free - self.shift @ w


def inverse_norms(rows: Rows, idf2: np.ndarray) -> np.ndarray:
    """1 / length of each row's TF-IDF vector in each fold, 0 without terms: long and
    short texts weigh the same."""
    norm = np.sqrt(rows.weighted(idf2, rows.count * rows.count))
    return np.divide(1, norm, out=np.zeros_like(norm), where=norm > 0)


def prepared(table: Table, folds: list[Fold]) -> None:
    """Sets what the fits need of the features' means and deviations."""
    v, idf2, places = table.features, np.stack([f.idf**2 for f in folds], 1), [f.place for f in folds]
    sent = table.rows.sparkSession.sparkContext.broadcast(idf2)

    def add(total: np.ndarray, rows: Rows) -> None:
        inverse = inverse_norms(rows, sent.value)
        for k, place in enumerate(places):
            inverse[(rows.fold == place) | (rows.label < 0), k] = 0
        for k, sums in enumerate(rows.by_term(inverse, rows.count, v)):
            total[2 * k * v : (2 * k + 1) * v] += sums
        for k, sums in enumerate(rows.by_term(inverse * inverse, rows.count * rows.count, v)):
            total[(2 * k + 1) * v : (2 * k + 2) * v] += sums

    sums = table.summed(add, 2 * v * len(folds)).reshape(len(folds), 2, v)
    sent.destroy()
    for f, (once, twice) in zip(folds, sums, strict=True):
        n = f.rows.sum()
        mean = once * f.idf / n
        variance = np.maximum((twice * f.idf**2 - n * mean * mean) / (n - 1), 0)
        f.back = np.divide(1, variance, out=np.zeros(v), where=variance > 0)
        # features keep their scale in the penalty: divided by their deviation, the rarest would rule
        f.unit, f.shift = f.idf * np.sqrt(f.back), mean * np.sqrt(f.back)


def evaluated(table: Table, folds: list[Fold], points: list[np.ndarray], regularisation: float) -> list[Evaluated]:
    """Mean loss and gradient of each fold at its point, in one pass."""
    v, ends = table.features, np.cumsum([0, *[f.columns for f in folds]])
    models = [f.model(x) for f, x in zip(folds, points, strict=True)]
    known = np.full((len(folds), len(table.classes) + 1), -1)  # the last: without a class
    for k, f in enumerate(folds):
        known[k, f.labels] = range(len(f.labels))
    places, width = [f.place for f in folds], int(ends[-1])
    sent = table.rows.sparkSession.sparkContext.broadcast(
        (np.concatenate([w for w, _ in models], 1), np.concatenate([c for _, c in models]), np.stack([f.idf**2 for f in folds], 1))
    )

    def add(total: np.ndarray, rows: Rows) -> None:
        weights, free, idf2 = sent.value
        inverse, every = inverse_norms(rows, idf2), np.arange(len(rows.at))
        pull = rows.weighted(weights, rows.count)
        for k, place in enumerate(places):
            a, b = ends[k], ends[k + 1]
            z = pull[:, a:b] * inverse[:, k : k + 1] + free[a:b]
            label = known[k, rows.label]
            train = (rows.fold != place) & (label >= 0)
            if b - a == 1:
                loss = np.logaddexp(0, z[:, 0]) - z[:, 0] * (label == 1)
                z[:, 0] = np.exp(z[:, 0] - np.logaddexp(0, z[:, 0])) - (label == 1)
            else:
                top = z.max(1, keepdims=True)
                e = np.exp(z - top)
                s = e.sum(1, keepdims=True)
                loss = (np.log(s) + top)[:, 0] - z[every, label]
                z = e / s
                z[every, label] -= 1
            z[~train] = 0
            total[width * v + a : width * v + b] += z.sum(0)
            total[width * (v + 1) + k] += loss[train].sum()
            pull[:, a:b] = z * inverse[:, k : k + 1]
        for k, sums in enumerate(rows.by_term(pull, rows.count, v)):
            total[k * v : (k + 1) * v] += sums

    total = table.summed(add, width * (v + 1) + len(folds))
    sent.destroy()
    out = []
    for k, (f, x) in enumerate(zip(folds, points, strict=True)):
        a, b, n, (w, _) = ends[k], ends[k + 1], f.rows.sum(), f.parts(x)
        free = total[width * v + a : width * v + b]
        grad = total[a * v : b * v].reshape(b - a, v).T * f.unit[:, None] - f.shift[:, None] * free
        bent = f.back[:, None] * w * regularisation
        out.append((float(total[width * (v + 1) + k] / n + (w * bent).sum() / 2), np.concatenate(((grad / n + bent).ravel(), free / n))))
    return out


def fitted(table: Table, folds: list[Fold], iterations: int, regularisation: float) -> list[np.ndarray]:
    """The folds' fits, step by step together: each pass evaluates what they ask for."""
    prepared(table, folds)
    fits = [minimised(f.first(), iterations) for f in folds]
    asked, found = {k: next(fit) for k, fit in enumerate(fits)}, {}
    while asked:
        for k, got in zip(list(asked), evaluated(table, [folds[k] for k in asked], [*asked.values()], regularisation), strict=True):
            try:
                asked[k] = fits[k].send(got)
            except StopIteration as end:
                found[k] = end.value
                del asked[k]
    return [found[k] for k in range(len(folds))]


def predicted(table: Table, folds: list[Fold], points: list[np.ndarray]) -> DataFrame:
    """``__id`` and ``__p`` (place of the class) of the rows in these folds."""
    models = [f.model(x) for f, x in zip(folds, points, strict=True)]
    spark, ends = table.rows.sparkSession, np.cumsum([0, *[f.columns for f in folds]])
    sent = spark.sparkContext.broadcast(
        (np.concatenate([w for w, _ in models], 1), np.concatenate([c for _, c in models]), np.stack([f.idf**2 for f in folds], 1))
    )
    labels, places = [np.array(f.labels) for f in folds], [f.place for f in folds]

    def run(batches) -> Iterator[pa.RecordBatch]:
        weights, free, idf2 = sent.value
        for b, found in batches:
            p = np.zeros(b.num_rows, np.int32)
            for rows in found:
                inverse, pull = inverse_norms(rows, idf2), rows.weighted(weights, rows.count)
                for k, place in enumerate(places):
                    z = (pull[:, ends[k] : ends[k + 1]] * inverse[:, k : k + 1] + free[ends[k] : ends[k + 1]])[rows.fold == place]
                    best = (z[:, 0] > 0).astype(int) if z.shape[1] == 1 else z.argmax(1)
                    p[rows.at[rows.fold == place]] = labels[k][best]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["__id", "__p"])

    own = table.rows.where(F.col("__fold").isin([table.folds[k] for k in places]))
    return table.each(run, own, own.select("__id").schema.add("__p", "integer"))


def trained_out_of_fold(
    df: DataFrame,
    text_col: str,
    label_col: str,
    id_col: str,
    fold_col: str = "fold",
    features: int = 1 << 16,
    iterations: int = 20,
    regularisation: float = 1e-6,
    out_col: str = "p_domains",
    parallel: int = 5,
) -> DataFrame:
    """``df`` with ``out_col``, the class that a model fitted on the other folds
    gives each row. Ids are unique. Rows without a class are predicted but not
    fitted on; a fold whose other folds hold fewer than two classes gets their
    only class (null without any). ``parallel`` folds are fitted at a time."""
    spark = df.sparkSession
    column = df.schema[label_col].dataType
    tf = HashingTF(inputCol="__words", outputCol="__tf", numFeatures=features)
    rows = df.select(F.col(id_col).alias("__id"), F.col(fold_col).alias("__fold"), F.col(label_col).cast("string").alias("__class"), words(text_col).alias("__w"))
    rows = tf.transform(rows.where(F.col("__fold").isNotNull()).withColumn("__words", terms("__w")))
    kind = "<u2" if features <= 1 << 16 else "<u4"
    path = work_path(spark, "term_frequencies")
    packed(rows, kind).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = defaultdict(dict)
    for r in rows.groupBy("__fold", "__class").count().collect():
        sizes[r["__fold"]][r["__class"]] = r["count"]
    if not (values := sorted(sizes)):
        return df.withColumn(out_col, F.lit(None).cast(column))
    # in the order of Spark's strings, which have UTF-16 units
    classes = sorted({c for own in sizes.values() for c in own} - {None}, key=lambda c: c.encode("utf-16-be", "surrogatepass"))
    table, n_folds = Table(rows, values, classes, features, kind, np.arange(features)), len(values)

    def add(total: np.ndarray, rows: Rows) -> None:  # the last: rows without a class
        fold = np.where(rows.label < 0, n_folds, rows.fold)[rows.row]
        total += np.bincount(fold * features + rows.term, minlength=len(total))

    documents = table.summed(add, (n_folds + 1) * features).reshape(n_folds + 1, features)
    unused = documents.sum(0) == 0
    table, documents = table.without(unused), documents[:-1, ~unused]
    every, folds, parts = documents.sum(0), [], []
    for k, value in enumerate(values):
        n = np.array([sum(sizes[f].get(c, 0) for f in values if f != value) for c in classes], float)
        labels = [int(i) for i in np.flatnonzero(n)]
        if len(labels) > 1:
            folds.append(Fold(k, labels, n[labels], np.log((n.sum() + 1) / (every - documents[k] + 1))))
        else:
            parts.append(rows.where(F.col("__fold") == value).select("__id", F.lit(labels[0] if labels else None).cast("int").alias("__p")))
    for a in range(0, len(folds), parallel):
        some = folds[a : a + parallel]
        parts.append(predicted(table, some, fitted(table, some, iterations, regularisation)))
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    label = F.get(F.array(*[F.lit(c) for c in classes]).cast("array<string>"), F.col("__p")).cast(column)
    scored = scored.select("__id", label.alias(out_col))
    return df.join(scored, df[id_col] == scored["__id"], "left").drop("__id")
