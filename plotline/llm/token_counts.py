"""Exact token length histogram.

Every whole text is encoded with a public tokenizer; documents are counted by
encoded length. Suffix sums over the histogram answer, for any context limit,
how many documents and tokens are at or above it, quantiles, and the tokens
left after truncation. The suffix sums are two-level (blocks of lengths, then
lengths inside a block), so no task sees the whole histogram.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import shared_table

#: Rank file of a byte-level BPE (base64 token, rank per line), and the
#: pattern that cuts texts before merging (a fixed value of that vocabulary).
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A run of the pattern's white space that is cut out before the pattern is tried,
#: which keeps a state for every character of a run and would exhaust its stack.
LONG_BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{500,}")
#: Lengths per block of the suffix sums.
BLOCK = 256


def encoded_length(encoding, text: str) -> int:
    """Tokens of a text. Of a run of white space inside a text, the pattern makes all
    but the last character one piece, and the last goes to what follows; a run at the
    end is one piece. Long runs are cut into these pieces here, exactly."""
    if not text:
        return 0
    at, total = 0, 0
    for found in LONG_BLANKS.finditer(text):
        end = found.end() if found.end() == len(text) else found.end() - 1
        total += len(encoding.encode_ordinary(text[at : found.start()]))
        total += len(encoding._encode_single_piece(text[found.start() : end].encode()))
        at = end
    return total + len(encoding.encode_ordinary(text[at:]))


def length_histogram(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """n_tokens, n_docs of ``docs`` (text). Null and empty texts have length
    0. The vocabulary file (about 1 MB) is read here and sent to the tasks,
    which count lengths per batch before the shuffle."""
    with open(ranks, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        pairs = (line.split() for line in vocabulary.value.splitlines())
        merges = {base64.b64decode(a): int(b) for a, b in pairs}
        encoding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        for b in batches:
            found = Counter(encoded_length(encoding, t) for t in b["text"])
            yield pd.DataFrame({"n_tokens": list(found), "n_docs": list(found.values())})

    found = docs.select("text").mapInPandas(run, "n_tokens long, n_docs long")
    return found.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per length L present: n_docs; docs_from and tokens_from
    (documents of length L or more and their tokens); total_docs and
    total_tokens; quantile (share of documents of length L or less); and, for a
    context limit of L, truncated_docs (longer documents), truncated_tokens
    (tokens kept when every document is cut at L) and lost_tokens."""
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / block)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    whole = Window.partitionBy(F.lit(0))
    after = whole.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after") for c in "dt"],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"],
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("d_after")).alias("docs_from"),
        (F.sum("tokens").over(inside) + F.col("t_after")).alias("tokens_from"),
        F.col("d_all").alias("total_docs"),
        F.col("t_all").alias("total_tokens"),
    )
    longer = F.col("docs_from") - F.col("n_docs")
    kept = F.col("total_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
    return rows.select(
        "*",
        ((F.col("total_docs") - longer) / F.col("total_docs")).alias("quantile"),
        longer.alias("truncated_docs"),
        kept.alias("truncated_tokens"),
        (F.col("total_tokens") - kept).alias("lost_tokens"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """limit, truncated_docs, truncated_tokens for any context limits, from the
    suffix sums of the first length above each limit."""
    total = F.coalesce(F.max("total_tokens"), F.lit(0))
    rows = []
    for limit in limits:
        longer, over = (F.coalesce(F.max(F.when(F.col("n_tokens") > limit, F.col(c))), F.lit(0)) for c in ("docs_from", "tokens_from"))
        rows.append(
            F.struct(
                F.lit(limit).cast("long").alias("limit"),
                longer.alias("truncated_docs"),
                (total - over + limit * longer).alias("truncated_tokens"),
            )
        )
    return sums.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def token_counts(docs: DataFrame) -> DataFrame:
    """The suffix sums of the whole table; an empty table gives no rows. Null and
    empty texts have length 0; very long texts, and very long runs of white space in
    them, are encoded whole. Every text is encoded once: the histogram is written,
    as its rows and its blocks are both read."""
    return suffix_sums(shared_table(length_histogram(docs), "length_histogram"))
