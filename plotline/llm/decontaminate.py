"""Benchmark decontamination by a broadcast hash set of test n-grams.

Windows of the benchmark items (13 normalised words; a shorter item is one
window) are hashed into a small table, broadcast when its rows are within a
checked bound and joined by shuffle otherwise. Every position of every
document hashes the words from there on and looks them up; a hit is verified
word by word. Spans of hits are united per document.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotline.llm.common import ascii_lower, shared_table

WINDOW = 13
#: What separates words after A-Z are lower-cased (ASCII other than 0-9, a-z).
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The same before lower-casing, and its complement.
BETWEEN_ANY_CASE = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
WORD_ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
#: Up to this many distinct windows (about 200 bytes each) are broadcast.
BROADCAST_WINDOWS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN), "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_ANY_CASE}+")), F.lit(0)).cast("long")


def window_hash(tokens: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(tokens, at + k) for k in range(size)])


def windows(items: DataFrame) -> DataFrame:
    """h, size, gram (the words) and items (ids as strings, sorted) of every
    distinct window of ``items`` (item_id, text). An item without id has
    windows too; it adds nothing to their items."""
    tokens = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where("size(w) > 0")
    size = F.least(F.size("w"), F.lit(WINDOW))
    grams = tokens.select("item", "w", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("at"))
    grams = grams.select("item", "size", F.slice("w", F.col("at") + 1, F.col("size")).alias("gram"))
    grams = grams.groupBy("size", "gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    h = F.lit(None).cast("long")
    for k in range(1, WINDOW + 1):
        h = F.when(F.col("size") == k, window_hash(F.col("gram"), F.lit(0), k)).otherwise(h)
    return grams.withColumn("h", h)


def row_key() -> list[Column]:
    """Identifies a row's result: its text decides, the id spreads copies."""
    return [
        F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("_pl_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_pl_text"),
    ]


def united(spans: Column) -> Column:
    """Number of positions that (start, end) spans cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"),
        ),
        lambda a: a["n"],
    )


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """_pl_id, _pl_text, spans (start, end of every hit window, in words), n_words,
    n_hit, items (sorted ids) of the documents with at least one hit."""
    grams = shared_table(windows(items), "grams")
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # at most 13 numbers
    small = grams.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    tokens = docs.select(*row_key(), words(F.col("text")).alias("w")).where("size(w) > 0")
    length = F.size("w").cast("long").alias("n_words")
    at = tokens.select("_pl_id", "_pl_text", length, "w", F.posexplode("w").alias("at", "_word")).drop("_word")
    if sizes == [WINDOW] or not sizes:
        at = at.withColumn("size", F.lit(WINDOW)).withColumn("h", window_hash(F.col("w"), F.col("at"), WINDOW))
    else:
        keys = [F.struct(F.lit(k).alias("size"), window_hash(F.col("w"), F.col("at"), k).alias("h")) for k in sizes]
        at = at.withColumn("key", F.explode(F.array(*keys))).select("*", "key.size", "key.h").drop("key")
    here = F.slice("w", F.col("at") + 1, F.col("size"))
    if not small:  # a shuffled position takes its window along, not all words of its text
        at = at.withColumn("here", here).drop("w")
        here = F.col("here")
    found = at.join(F.broadcast(grams) if small else grams, ["h", "size"]).where(here == F.col("gram"))
    # nor does a hit: with all words beside each, a text's hits grow with the square of its length
    found = found.select("_pl_id", "_pl_text", "n_words", "at", "size", "items")
    span = F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end"))
    return (
        found.groupBy("_pl_id", "_pl_text")
        .agg(
            F.array_sort(F.collect_set(span)).alias("spans"),
            F.flatten(F.collect_set("items")).alias("items"),
            F.max("n_words").alias("n_words"),
        )
        .select("_pl_id", "_pl_text", "spans", "n_words", united(F.col("spans")).alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"))
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every
    row of ``docs`` (doc_id, text). Null texts have no words; items without
    id count in n_hit and contaminated, but not in n_items and items_sha256;
    the hash of a row without items is that of the empty string."""
    found = hits(docs, items).drop("spans", "n_words")
    rows = docs.select("doc_id", *row_key(), count_words(F.col("text")).alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(found, ["_pl_id", "_pl_text"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents of which a twentieth or more is hit."""
    rows = docs.select("*", *row_key())
    bad = hits(docs, items).where("20 * n_hit >= n_words").select("_pl_id", "_pl_text")
    return rows.join(shared_table(bad, "contaminated"), ["_pl_id", "_pl_text"], "left_anti").select(*docs.columns)


def without_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with the hit words, and what follows each up to the next
    word, removed from ``text``."""
    found = hits(docs, items).select("_pl_id", "_pl_text", F.col("spans").alias("_pl_spans"))
    rows = docs.select("*", *row_key()).join(found, ["_pl_id", "_pl_text"], "left")
    pieces = F.regexp_extract_all("text", F.lit(f"{WORD_ANY_CASE}+{BETWEEN_ANY_CASE}*"), F.lit(0))
    clean = F.filter(pieces, lambda p, i: ~F.exists("_pl_spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    lead = F.regexp_extract("text", f"^{BETWEEN_ANY_CASE}*", 0)
    text = F.when(F.col("_pl_spans").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(clean, "")))
    return rows.withColumn("text", text).select(*docs.columns)
