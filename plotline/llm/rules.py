"""Quality rules by distribution divergence.

A document's character-class histogram and its histogram of the language's
common words are compared with references of its language by Jensen-Shannon
distance (base 2). References are sums over all documents of the language;
texts too short for a histogram to mean something are not judged by it.

DataFrame functions only: no Python runs on the executors. Documents are
never shuffled: each row is measured in place, and only the references (a row
per language) are joined. Repeated five-word windows are found by sorting a
row's window hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import SPACE, shared_table

#: Character classes, the rest (other letters) last.
CLASSES = {
    "lower": "[a-z]",
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "space": "[\\x20\\x09-\\x0D]",
    "stop": "[.,;:?'\"()-]",
    "mark": "[\\x00-\\x08\\x0E-\\x1F!#$%&*+/<=>@\\[\\\\\\]^_`{|}~\\x7F]",
}
#: Characters counted as symbols, all of them marks.
SYMBOLS = "[#*$%&|<>]"
#: Words of a language's reference: its most frequent ones.
COMMON = 20
#: Distances above these reject a text.
MOST_CHARS = 0.25
MOST_WORDS = 0.40
#: Texts below these lengths are not judged by the histogram.
LEAST_CHARS = 250
LEAST_WORDS = 50
#: Languages (and their common words) up to this many are broadcast.
BROADCAST_LANGUAGES = 1000


def words(text: Column) -> Column:
    """Words of the text; none for a null text."""
    return F.coalesce(F.array_remove(F.split(text, SPACE), ""), F.array().cast("array<string>"))


def with_repeated_words(rows: DataFrame, size: int = 5) -> DataFrame:
    """``rows`` (w: words) with n_repeat_words: words inside windows of ``size``
    words that occur twice or more. A window's hash is one of the hashes of shorter
    windows it is made of. Windows of ``size`` are hashed only where two of about
    ``size`` / 2 words or more have one hash. Where some hashes are equal, windows are
    sorted by them; those equal to a neighbour are repeated, and the positions they
    cover are united. Each array is a column before a lambda looks into it, else every
    step of the lambda would build it again."""
    n = F.size("w") - size + 1

    def joined(a: Column, b: str, at: int) -> Column:
        return F.zip_with(a, F.slice(b, F.lit(at + 1), F.size("w")), lambda x, y: F.xxhash64(x, y))

    have = 1
    rows = rows.withColumn("_windows", F.when(n >= 2, F.col("w")))
    while 2 * have <= size:  # places whose window would pass the end are cut off
        rows = rows.withColumn("_windows", F.slice(joined(F.col("_windows"), "_windows", have), F.lit(1), F.size("w") - 2 * have + 1))
        have *= 2
    rows = rows.withColumn("_windows", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.col("_windows")))
    for k in range(have, size):
        rows = rows.withColumn("_windows", joined(F.col("_windows"), "w", k))
    rows = rows.withColumn("_windows", F.slice("_windows", F.lit(1), F.greatest(n, F.lit(0))))
    repeats = F.size(F.array_distinct("_windows")) < n
    rows = rows.withColumn("_sorted", F.when(repeats, F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("_sorted", F.sort_array("_sorted"))

    def same(a: Column, b: Column) -> Column:
        equal = (a["h"] == b["h"]) & (F.slice("w", a["i"] + 1, size) == F.slice("w", b["i"] + 1, size))
        return F.coalesce(equal, F.lit(False))

    twice = F.filter("_sorted", lambda x, k: same(x, F.get("_sorted", k - 1)) | same(x, F.get("_sorted", k + 1)))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        starts,
        zero,
        lambda a, i: F.struct((i + size).alias("end"), (a["n"] + i + size - F.greatest(a["end"], i)).alias("n")),
        lambda a: a["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_windows", "_sorted")


def with_class_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (text, w) with chars (counts by class) and n_symbols. Classes share no
    character: each is taken out of what the ones before it left, run by run, and
    what is missing then is its count; the words without what is between them leave
    all but white space. Symbols are marks, so they are looked for among what the
    other classes leave. Every rest is a column, worked out once."""
    names = [c for c in CLASSES if c not in ("mark", "space")]
    rows = rows.withColumn("_rest", F.array_join("w", ""))
    rows = rows.withColumn("_n_space", (F.length("text") - F.length("_rest")).cast("long"))
    for name in [*names, "symbol", "mark"]:
        pattern = SYMBOLS if name == "symbol" else CLASSES[name]
        rows = rows.withColumn("_less", F.regexp_replace("_rest", f"{pattern}+", ""))
        rows = rows.withColumn(f"_n_{name}", (F.length("_rest") - F.length("_less")).cast("long")).withColumn("_rest", F.col("_less"))
    marks = F.col("_n_symbol") + F.col("_n_mark")
    counts = [marks if c == "mark" else F.col(f"_n_{c}") for c in CLASSES]
    return rows.withColumn("chars", F.array(*counts, F.length("_rest").cast("long"))).withColumn("n_symbols", F.col("_n_symbol"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, ``chars`` (counts by class) and ``w``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_class_counts(docs.select("doc_id", "lang", text.alias("text"), words(F.col("text")).alias("w")))
    rows = rows.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    return rows.select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        (F.length("text") - F.col("_n_space")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "chars",
        "w",
    )


def common_words(docs: DataFrame, count: int = COMMON) -> DataFrame:
    """lang, common (the ``count`` most frequent words), over all documents.
    Words are counted per task before the shuffle; each task of the second
    step keeps its own best before the language's best are chosen."""
    w = F.explode(words(F.col("text"))).alias("word")
    counts = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), w).groupBy("lang", "word").agg(F.count("*").alias("n"))
    order = [F.desc("n"), F.col("word")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("word"), F.lit(64))).orderBy(*order)
    counts = counts.withColumn("at", F.row_number().over(part)).where(F.col("at") <= count)
    counts = counts.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("at") <= count)
    return counts.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("common"))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root of the divergence, base 2)."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def with_reference(rows: DataFrame, reference: DataFrame) -> DataFrame:
    small = reference.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES
    return rows.join(F.broadcast(reference) if small else reference, "lang", "left")


def with_word_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (w, common) with by_word: counts of each common word, and of all
    other words, last. Common words are taken out one by one; what is missing then is
    their count."""
    rest, sizes = F.col("w"), []
    for k in range(COMMON):
        sizes.append(F.size(rest))
        # a place beyond the language's common words takes nothing out: no word is empty
        rest = F.array_remove(rest, F.coalesce(F.get("common", F.lit(k)), F.lit("")))
    sizes = [n.cast("long") for n in [*sizes, F.size(rest)]]
    counts = F.array(*[a - b for a, b in zip(sizes, sizes[1:])])
    return rows.withColumn("by_word", F.concat(F.slice(counts, F.lit(1), F.size("common")), F.array(sizes[-1])))


def measures(docs: DataFrame) -> DataFrame:
    """Base counts, ``chars`` and ``by_word`` histograms of every row (written
    to the shared folder: later steps need neither text nor words)."""
    common = shared_table(common_words(docs), "common")
    rows = measured(docs).withColumn("lang", F.coalesce("lang", F.lit("")))
    rows = with_reference(rows, common).withColumn("common", F.coalesce("common", F.array().cast("array<string>")))
    return shared_table(with_word_counts(with_repeated_words(rows)).drop("w", "common"), "measures")


def references(rows: DataFrame) -> DataFrame:
    """lang, ref_chars, ref_words: shares over all documents of the language."""
    n = len(CLASSES) + 1
    sums = rows.groupBy("lang").agg(
        F.array(*[F.sum(F.col("chars")[k]) for k in range(n)]).alias("c"),
        F.array(*[F.coalesce(F.sum(F.get("by_word", F.lit(k))), F.lit(0)) for k in range(COMMON + 1)]).alias("b"),
        F.max(F.size("by_word")).alias("k"),
    )
    return sums.select("lang", shares(F.col("c")).alias("ref_chars"), shares(F.slice("b", 1, F.col("k"))).alias("ref_words"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, char_distance, word_distance of every row.

    A null text has no words. A null and an empty language are one, a
    language of its own.
    Distances are null for texts below the least lengths; such texts pass
    that rule."""
    rows = measures(docs)
    rows = with_reference(rows, shared_table(references(rows), "references"))
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn(
        "char_distance", F.when(n_chars >= LEAST_CHARS, F.round(distance(shares(F.col("chars")), F.col("ref_chars")), 6))
    ).withColumn(
        "word_distance", F.when(F.col("n_words") >= LEAST_WORDS, F.round(distance(shares(F.col("by_word")), F.col("ref_words")), 6))
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    near = F.coalesce(F.col("char_distance") <= MOST_CHARS, F.lit(True)) & F.coalesce(F.col("word_distance") <= MOST_WORDS, F.lit(True))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & near).alias("kept"), "char_distance", "word_distance",
    )
