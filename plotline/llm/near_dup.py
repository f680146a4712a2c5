"""Near-duplicate classes by a signature-coordinate inverted join.

Every text becomes its set of distinct word shingles and a MinHash
signature. Documents are posted under each (coordinate, value) pair of the
signature; a pair of documents is a candidate when at least ``matches`` of
the ``coordinates`` postings collide, and it is linked when the Jaccard
similarity of the two full sets reaches the threshold.

* Texts with equal sets are one class from the start; only the class with
  its smallest id goes on, so copies never meet pairwise.
* Skip: a posting held by one document cannot collide, and a document with
  fewer than ``matches`` shared postings has no partner.
* Prefix: in one global order (rarest posting first) two documents with
  ``matches`` collisions share one of their first
  ``coordinates - matches + 1`` postings, so only these are merged.
* Postings are merged through their smallest id (the hub): the documents
  of all lists with one hub form a unit, sent once per document, and any
  two documents of a list lie in the same unit. Units are cut into blocks;
  each block returns at most a spanning forest of its confirmed links.
  Documents of a cut unit that are not yet in its largest component are then
  compared with all its blocks, so cutting loses no link.

A pair at the threshold itself misses the collision count with probability
below 1e-4 (binomial with 48 draws of 0.75, fewer than 24 hits); pairs above
it far less.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import shared_table
from plotline.session import checkpoint_dir


@dataclass(frozen=True)
class NearDup:
    """``matches`` of ``coordinates`` must collide; ``block`` documents are
    compared in one task at a time."""

    words: int = 5
    percent: int = 75
    coordinates: int = 48
    matches: int = 24
    block: int = 256
    seed: int = 20


# Shingles and signatures (run inside tasks) ---------------------------------


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text. Word hashes are kept
    in a dictionary of bounded size."""

    def __init__(self, words: int, keep: int = 300_000):
        self.words, self.keep, self.known = words, keep, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space splits
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        a = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(a))
        h = a[: len(a) - size + 1].copy()
        for k in range(1, size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + a[k : k + len(h)]
        return np.unique(mixed(h + np.uint64(size)))


class Signer:
    """One 64-bit posting key per signature coordinate of a set."""

    def __init__(self, coordinates: int, seed: int):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, coordinates, dtype=np.uint64)
        self.own = rng.integers(0, 2**63, coordinates, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 4096):
            part = shingles[at : at + 4096]
            for k in range(len(low)):
                low[k] = min(low[k], (part * self.a[k] + self.b[k]).min())
        return mixed(low ^ self.own)


def lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def signatures(docs: DataFrame, cfg: NearDup) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null without words), postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(cfg.words), Signer(cfg.coordinates, cfg.seed)
        for b in small_batches(batches):
            sets = [shingle(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    lists([sign(s) if len(s) else s for s in sets]),
                ],
                names=["doc_id", "n_shingles", "digest", "postings"],
            )

    schema = "doc_id long, n_shingles long, digest binary, postings array<long>"
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, cfg: NearDup) -> DataFrame:
    """doc_id, shingles (sorted hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(cfg.words)
        for b in small_batches(batches):
            sets = [shingle(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), lists(sets)], names=["doc_id", "shingles"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, shingles array<long>")


# Candidates ------------------------------------------------------------------


def prefix_postings(reps: DataFrame, cfg: NearDup) -> DataFrame:
    """(posting, doc_id): the prefix of each document that can have partners."""
    posted = reps.select("doc_id", F.explode("postings").alias("posting"))
    held = posted.groupBy("posting").agg(F.count("*").alias("held")).where("held > 1")
    shared = posted.join(held, "posting")
    doc = Window.partitionBy("doc_id")
    return (
        shared.withColumn("at", F.row_number().over(doc.orderBy("held", "posting")))
        .withColumn("of", F.count("*").over(doc))
        .where(F.col("at") <= F.col("of") - F.lit(cfg.matches - 1))
        .select("posting", "doc_id")
    )


def units(prefixes: DataFrame) -> DataFrame:
    """(hub, doc_id): the documents of all posting lists whose smallest id is
    ``hub``, without the hub itself."""
    hubs = prefixes.groupBy("posting").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    return prefixes.join(hubs, "posting").where("doc_id <> hub").select("hub", "doc_id").distinct()


# Confirmation ----------------------------------------------------------------


class Unit:
    """Sets of one block, compared in numpy: collision counts on the
    signatures first, then exact intersections."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray], group: np.ndarray, cfg: NearDup):
        sign = Signer(cfg.coordinates, cfg.seed)
        self.ids, self.group, self.cfg = ids, group, cfg
        self.size = np.array([len(s) for s in sets])
        self.signs = np.stack([sign(s.view(np.uint64)) for s in sets])
        keys, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(flat, np.cumsum(self.size)[:-1])
        self.mark = np.zeros(len(keys), bool)
        self.links: list[tuple[int, int]] = []

    def compare(self, x: int, others: np.ndarray) -> None:
        """Link ``x`` with those of ``others`` in another group that reach the
        threshold; one link for each pair of groups."""
        p, size, n = self.cfg.percent, self.size, self.size[x]
        ys = others[(self.group[others] != self.group[x])]
        ys = ys[(100 * np.minimum(size[ys], n) >= p * np.maximum(size[ys], n))]
        ys = ys[(self.signs[ys] == self.signs[x]).sum(1) >= self.cfg.matches]
        if not len(ys):
            return
        self.mark[self.sets[x]] = True
        for at in range(0, len(ys), 256):
            part = ys[at : at + 256]
            ends = np.cumsum(size[part])
            common = np.add.reduceat(self.mark[np.concatenate([self.sets[y] for y in part])], np.r_[0, ends[:-1]], dtype=np.int64)
            for y in part[100 * common >= p * (n + size[part] - common)]:
                if self.group[y] != self.group[x]:
                    self.links.append((self.ids[x], self.ids[y]))
                    self.group[self.group == self.group[y]] = self.group[x]
        self.mark[self.sets[x]] = False

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame(self.links, columns=["a", "b"], dtype="int64")


def block_links(members: DataFrame, cfg: NearDup) -> DataFrame:
    """Links inside each (hub, block)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        u = Unit(pdf["doc_id"].to_numpy(), list(pdf["shingles"]), np.arange(len(pdf)), cfg)
        every = np.arange(len(pdf))
        for x in every[:-1]:
            u.compare(x, every[x + 1 :])
        return u.frame()

    return members.groupBy("hub", "block").applyInPandas(run, "a long, b long")


def cross_links(members: DataFrame, cfg: NearDup) -> DataFrame:
    """Links between the open documents of a unit and a block of all of them."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["is_open", "doc_id"], ascending=[False, True], kind="stable")
        u = Unit(pdf["doc_id"].to_numpy(), list(pdf["shingles"]), pdf["component"].to_numpy().copy(), cfg)
        is_open = pdf["is_open"].to_numpy()
        others = np.flatnonzero(~is_open)
        for x in np.flatnonzero(is_open):
            u.compare(x, others)
        return u.frame()

    return members.groupBy("hub", "open_block", "block").applyInPandas(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of every document in ``links`` (a, b): smallest id
    reachable. Labels take the neighbours' minimum, then jump to their
    label's label; each round is written to the checkpoint folder."""
    checkpoint_dir(links.sparkSession)
    pairs = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pairs = pairs.checkpoint()
    labels = pairs.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("low"))
    labels = labels.select("doc_id", F.least("doc_id", "low").alias("component")).checkpoint()
    while True:
        near = (
            pairs.join(labels.withColumnRenamed("doc_id", "b"), "b")
            .groupBy(F.col("a").alias("doc_id"))
            .agg(F.min("component").alias("low"))
        )
        lower = labels.join(near, "doc_id").select(
            "doc_id", F.least("component", "low").alias("component"), F.col("component").alias("was")
        )
        jump = labels.select(F.col("doc_id").alias("component"), F.col("component").alias("far"))
        new = (
            lower.join(jump, "component", "left")
            .select("doc_id", F.least("component", "far").alias("component"), "was")
            .checkpoint()
        )
        labels = new.select("doc_id", "component")
        if new.where("component <> was").isEmpty():
            return labels


def confirmed(docs: DataFrame, stars: DataFrame, cfg: NearDup) -> DataFrame:
    """Spanning links (a, b) of all candidate pairs that reach the threshold."""
    size = F.ceil((F.col("n") + 1) / F.lit(cfg.block)).cast("long")
    hubs = stars.groupBy("hub").agg(F.count("*").alias("n")).select("hub", size.alias("blocks"))
    wanted = stars.select("doc_id").union(stars.select(F.col("hub").alias("doc_id"))).distinct()
    sets = shared_table(shingle_sets(docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id", "left_semi"), cfg), "sets")
    in_block = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    members = (
        stars.join(hubs, "hub")
        .select("hub", in_block.alias("block"), "doc_id")
        .union(hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("hub").alias("doc_id")))
    )
    links = shared_table(block_links(members.join(sets, "doc_id"), cfg), "links")
    cut = hubs.where("blocks > 1")
    if cut.isEmpty():
        return links
    labels = components(links)
    cut = shared_table(cut, "cut")
    rows = stars.join(cut, "hub").union(cut.select("hub", F.col("hub").alias("doc_id"), "blocks"))
    rows = shared_table(
        rows.join(labels, "doc_id", "left").select("hub", "doc_id", "blocks", F.coalesce("component", "doc_id").alias("component")),
        "cut_units",
    )
    main = (
        rows.groupBy("hub", "component").agg(F.count("*").alias("n"))
        .groupBy("hub").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all"))
        .select("hub", F.col("m.component").alias("main"), (F.col("all") - F.col("m.n")).alias("n_open"))
        .where("n_open > 0")
        .withColumn("open_blocks", F.ceil(F.col("n_open") / F.lit(cfg.block)).cast("long"))
    )
    rows = rows.join(main, "hub")
    every = rows.select(
        "hub", "doc_id", "component", F.lit(False).alias("is_open"),
        F.explode(F.sequence(F.lit(0), F.col("open_blocks") - 1)).alias("open_block"), in_block.alias("block"),
    )
    opened = rows.where("component <> main").select(
        "hub", "doc_id", "component", F.lit(True).alias("is_open"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("open_blocks")).alias("open_block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    more = cross_links(every.union(opened).join(sets, "doc_id"), cfg)
    return links.union(shared_table(more, "more_links"))


def same_id_links(linkable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes that hold different texts of one id."""
    ids = linkable.groupBy("doc_id").agg(F.min("digest").alias("d1"), F.max("digest").alias("d2")).where("d1 <> d2")
    reps = linkable.join(ids.select("doc_id"), "doc_id").select("doc_id", "digest")
    reps = reps.join(classes.withColumnRenamed("doc_id", "b"), "digest").select("doc_id", "b")
    low = reps.groupBy("doc_id").agg(F.min("b").alias("a"))
    return reps.join(low, "doc_id").where("a <> b").select("a", "b")


def near_duplicates(docs: DataFrame, cfg: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``
    (doc_id long, text; other columns are ignored).

    Null or blank texts have no shingles and are linked with nothing. A null
    doc_id cannot be named by a component: its component_id is null and the
    row is kept. Rows that repeat a doc_id count as one document, also where
    their texts differ."""
    signed = shared_table(signatures(docs, cfg), "signatures")
    linkable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    reps = shared_table(
        linkable.select("doc_id", "digest", "postings").join(classes, ["doc_id", "digest"], "left_semi").select("doc_id", "postings"),
        "postings",
    )
    stars = shared_table(units(shared_table(prefix_postings(reps, cfg), "prefixes")), "units")
    labels = components(confirmed(docs, stars, cfg).union(same_id_links(linkable, classes)))
    by_class = classes.join(labels, "doc_id", "left").select(
        "digest", F.coalesce("component", "doc_id").alias("component")
    )
    return signed.drop("postings").join(by_class, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, cfg: NearDup = NearDup()) -> DataFrame:
    """``docs`` (any columns) with one document of each group of near-duplicate
    texts, that with the smallest id. Rows are told apart by a number of their
    own, so different texts under one id are different documents and rows
    without id are compared like the others (any id comes before none). Of rows
    without words that repeat an id one stays; without words and id all stay."""
    numbered = shared_table(docs.withColumn("_pl_row", F.monotonically_increasing_id()), "numbered")
    verdict = near_duplicates(numbered.select(F.col("_pl_row").alias("doc_id"), "text"), cfg)
    verdict = verdict.select(F.col("doc_id").alias("_pl_row"), (F.col("n_shingles") > 0).alias("worded"), "component_id")
    rows = verdict.join(numbered.select("_pl_row", "doc_id"), "_pl_row")
    group = F.when(F.col("worded"), F.col("component_id")).otherwise(F.col("doc_id")).alias("group")
    rows = shared_table(rows.select("_pl_row", "doc_id", "worded", group).where("group is not null"), "groups")
    first = rows.groupBy("worded", "group").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "_pl_row")).alias("first"))
    gone = rows.select("_pl_row").join(first.select("first._pl_row"), "_pl_row", "left_anti")
    return numbered.join(shared_table(gone, "gone"), "_pl_row", "left_anti").select(*docs.columns)
