"""Language-model scores by online logistic context mixing.

1. ``token_table``: how often every token (words and one end per document) occurs
   in the training documents, counted per batch and summed by shuffle. Its most
   frequent words make the lexicon, at most ``LEXICON`` of them.
2. ``fitted``: each task codes its training texts as binary decisions (``bitmodel``)
   and counts zeros and ones under every hashed context; every batch is predicted
   from the counts so far before it is counted, and the gated mixing weights
   learn online from the errors. The tables of all tasks are summed block by block
   in one pass over sorted rows. A table has a fixed number of slots, whatever the
   corpus, so that all of them together are ``TABLE_BYTES`` and are broadcast.
   Weights are averaged by decisions. The letters of words outside the lexicon are
   fitted in the same way on the token table, each distinct word with its count.
3. ``scored``: every text, whole, in one pass. The predictors' log odds are mixed by
   the weights of the decision's gate, and the mix of each class by a gain that
   the document itself refines as it goes on.
4. Words outside the lexicon, those of the token table and those that only held-out
   documents have, are spelled once each; their bits and counts (for the baseline)
   come back to the documents by a join and a sum.

The model's text is the sequence of its words with one space between, A-Z
lower-cased, and its end: ``bits_per_byte`` counts those bytes.

Defined results: a null text is empty, an empty text is its end alone; a null id is
never held out; repeated rows are scored each (and learned from each); rows are
told apart by their place in the input, not by id. Long texts go in pieces of
``PIECE`` words, which keep their context and gains. Without any training token
all tokens are unseen. Further columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pandas as pd
import zstandard
from pyspark import cloudpickle
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotline.llm import bitmodel as B
from plotline.llm.common import shared_table

#: A word is in the lexicon if it is at least 1 / LEXICON of the training tokens,
#: occurs twice and has at most LONG bytes.
LEXICON, LONG = 1 << 18, 64
#: Words of a long document worked on at once; words of a batch, counting and
#: scoring; letters of a batch.
PIECE, COUNT_WORDS, SCORE_WORDS, LETTERS = 1 << 14, 120_000, 1 << 15, 300_000
#: Every batch from the second on also trains the weights; a task's first two batches
#: are this much smaller, so that a small task has a second one.
FIRST_BATCHES = 32
#: Slots of a block of a table, and the bytes of all tables.
SLOTS = 1 << 12
TABLE_BYTES = (B.N << B.WORD_BITS) + (B.N << B.LETTER_BITS)
#: Entries a task counts before it hands them on.
FLUSH = 200_000


def shared_value(spark: SparkSession, value) -> Broadcast:
    """A broadcast that carries its classes along (read it with pickle.loads)."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def token_table(texts: DataFrame) -> DataFrame:
    """``token, n`` over the ``text`` column; the end is the empty token."""

    def count(batches):
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(B.words_of(text))
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"token": [w.decode("utf-8", "surrogatepass") for w in seen], "n": list(seen.values())})
                    seen = Counter()
            if len(pdf):
                seen[b""] += len(pdf)
        if seen:
            yield pd.DataFrame({"token": [w.decode("utf-8", "surrogatepass") for w in seen], "n": list(seen.values())})

    return texts.select("text").mapInPandas(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def of_lexicon(total: int) -> Column:
    """Is a row of the token table a word of the lexicon?"""
    return (F.col("n") >= 2) & (F.col("n") * LEXICON >= total) & (F.octet_length("token") <= LONG) & (F.col("token") != "")


def lexicon(tokens: DataFrame, total: int) -> B.Lexicon:
    """The lexicon of a written token table: at most LEXICON words come to the
    driver, and the letters' counts of all others."""
    own = of_lexicon(total)
    counts = {r["token"].encode("utf-8", "surrogatepass"): r["n"] for r in tokens.where(own).orderBy(F.desc("n"), "token").toLocalIterator()}

    def letters(batches):
        sums = np.zeros(257, np.int64)
        for pdf in batches:
            for w, n in zip(pdf["token"], pdf["n"]):
                sums[:256] += np.bincount(np.frombuffer(w.encode("utf-8", "surrogatepass"), np.uint8), minlength=256) * n
                sums[256] += n
        yield pd.DataFrame({"letter": np.arange(257), "n": sums})

    rest = tokens.where(~own & (F.col("token") != "")).mapInPandas(letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    spelled = np.zeros(257, np.int64)
    for r in rest.collect():
        spelled[r["letter"]] = r["n"]
    ends = tokens.where("token = ''").first()
    return B.Lexicon(counts, ends["n"] if ends else 0, int(spelled[256]), spelled)


def parts_of(numbers: np.ndarray, end: int):
    """The pieces of a document's numbers, each with the two numbers before it."""
    before = (end, end)
    for at in range(0, len(numbers), PIECE):
        yield numbers[at : at + PIECE], before
        if len(numbers) > at + PIECE:
            before = (numbers[at + PIECE - 1], numbers[at + PIECE - 2])


def fitted(rows: DataFrame, fill, bits: int, n_gates: int, name: str) -> B.Mixer:
    """Tables and weights from all ``rows``: ``fill(task, batches)`` adds a task's
    rows to its ``bitmodel.Counter``. Only the summed tables, TABLE_BYTES, come to
    the driver."""

    def count(batches):
        task = B.Counter(bits, n_gates)
        fill(task, batches)
        if not task.batches:
            return
        pack = zstandard.ZstdCompressor(level=1).compress
        for k, counts in enumerate(task.counts):
            out = []
            for at in range(0, len(counts), SLOTS):
                block = counts[at : at + SLOTS]
                if block.any():
                    out.append((k, at // SLOTS, pack(block.astype(np.int64).tobytes())))
            if out:
                yield pd.DataFrame(out, columns=["part", "block", "data"])
        if task.decisions:
            own = np.append(task.weights.reshape(-1) * task.decisions, float(task.decisions))
            yield pd.DataFrame([(-1, 0, pack(own.tobytes()))], columns=["part", "block", "data"])

    def finished(key, total):
        if key[0] < 0:
            return (total[:-1] / total[-1]).tobytes()
        pair = total.reshape(-1, 2)
        return B.steps(B.log_odds(pair[:, 1], pair.sum(1))).tobytes()

    def summed(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        key, total = None, None
        for pdf in batches:
            out = []
            for part, block, data in zip(pdf["part"], pdf["block"], pdf["data"]):
                if (part, block) != key:
                    if key is not None:
                        out.append((*key, finished(key, total)))
                    key, total = (part, block), 0
                total = total + np.frombuffer(unpack(data), np.float64 if part < 0 else np.int64)
            if out:
                yield pd.DataFrame(out, columns=["part", "block", "data"])
        if key is not None:
            yield pd.DataFrame([(*key, finished(key, total))], columns=["part", "block", "data"])

    schema = "part int, block int, data binary"
    made = rows.mapInPandas(count, schema)
    made = made.repartition("part", "block").sortWithinPartitions("part", "block").mapInPandas(summed, schema)
    tables = [np.zeros(1 << bits, np.int8) for _ in range(B.N)]
    weights = np.full((n_gates * B.CLASSES, B.N), B.FIRST)
    for r in shared_table(made, name).toLocalIterator():
        if r["part"] < 0:
            weights = np.frombuffer(r["data"], np.float64).reshape(weights.shape)
        else:
            tables[r["part"]][r["block"] * SLOTS : (r["block"] + 1) * SLOTS] = np.frombuffer(r["data"], np.int8)
    return B.Mixer(tables, weights)


def word_model(texts: DataFrame, shared: Broadcast) -> B.Mixer:
    """The mixer of words, from all of ``texts``."""

    def fill(task, batches):
        lex = pickle.loads(shared.value)
        batch, size = [], 0
        for pdf in batches:
            for text in pdf["text"]:
                for part in parts_of(lex.numbered(B.words_of(text))[0], lex.end):
                    batch.append(part)
                    size += len(part[0])
                    if size >= (COUNT_WORDS if task.batches > 1 else COUNT_WORDS // FIRST_BATCHES):
                        task.add(B.of_words(batch, lex))
                        batch, size = [], 0
        if batch:
            task.add(B.of_words(batch, lex))

    return fitted(texts.select("text"), fill, B.WORD_BITS, B.DEPTHS, "mixing_words")


def letter_model(tokens: DataFrame, shared: Broadcast, n_gates: int) -> B.Mixer:
    """The mixer of letters, from the token table's words outside the lexicon."""

    def fill(task, batches):
        lex = pickle.loads(shared.value)
        words, times, size = [], [], 0

        def add():
            made = B.of_letters(words, lex)
            task.add(made, np.array(times, np.float64)[made.word])

        for pdf in batches:
            for token, n in zip(pdf["token"], pdf["n"]):
                word = token.encode("utf-8", "surrogatepass")
                if word and word not in lex.ids:
                    words.append(word)
                    times.append(n)
                    size += len(word)
                    if size >= (LETTERS if task.batches > 1 else LETTERS // FIRST_BATCHES):
                        add()
                        words, times, size = [], [], 0
        if words:
            add()

    return fitted(tokens.select("token", "n"), fill, B.LETTER_BITS, n_gates, "mixing_letters")


def spelled(tokens: DataFrame, mixer: Broadcast, lexicon: Broadcast) -> DataFrame:
    """``token, c, bits``: what the letters of each word of ``token, c`` cost."""

    def spell(batches):
        model, lex = pickle.loads(mixer.value), pickle.loads(lexicon.value)
        for pdf in batches:
            words = [t.encode("utf-8", "surrogatepass") for t in pdf["token"]]
            bits, at = [], 0
            while at < len(words):
                end, size = at, 0
                while end < len(words) and size < LETTERS:
                    size += len(words[end])
                    end += 1
                bits.append(B.letter_bits(model, words[at:end], lex))
                at = end
            if words:
                yield pdf.assign(bits=np.concatenate(bits))

    return tokens.mapInPandas(spell, "token string, c long, bits double")


SCORED = (
    "doc_id string, held_out boolean, n_tokens long, n_common long, common double, rare string, times array<long>, "
    "n_bytes long, bits double"
)


def scored(docs: DataFrame, mixer: Broadcast, lexicon: Broadcast, below: float) -> DataFrame:
    """Each row's bits of words, the baseline of its words in the lexicon
    (``below``: log10 of the denominator) and its other words with their numbers."""
    names = "doc_id held_out n_tokens n_common common rare times n_bytes bits".split()

    def score(batches):
        model, lex = pickle.loads(mixer.value), pickle.loads(lexicon.value)
        logs = np.log10(lex.counts + 1) - below
        rows, batch, size = [], [], 0

        def flush():
            nonlocal batch, size
            if batch:
                gains = np.array([rows[i][-1] for i, _ in batch])
                bits, gains = B.word_bits(model, [p for _, p in batch], gains, lex)
                for (i, _), b, g in zip(batch, bits, gains):
                    rows[i][-2] += b
                    rows[i][-1] = g
            batch, size = [], 0

        def table():
            return pd.DataFrame([r[:-1] for r in rows], columns=names)

        for pdf in batches:
            for doc_id, held, text in zip(pdf["doc_id"], pdf["held_out"], pdf["text"]):
                words = B.words_of(text)
                numbers, others = lex.numbered(words)
                own = numbers[numbers <= lex.end]
                known = int((lex.counts[own] > 0).sum())
                seen = Counter(others)
                said = b" ".join(seen).decode("utf-8", "surrogatepass") if seen else None
                n_bytes = len(b" ".join(words))
                rows.append(
                    [doc_id, held, len(numbers), known, float(logs[own].sum()), said, list(seen.values()), n_bytes, 0.0, np.zeros((B.CLASSES, 2))]
                )
                for k, part in enumerate(parts_of(numbers, lex.end)):
                    if k:  # the next piece of a document goes on with its gains
                        flush()
                    batch.append((len(rows) - 1, part))
                    size += len(part[0])
                if size >= SCORE_WORDS:
                    flush()
                    yield table()
                    rows = []
        flush()
        if rows:
            yield table()

    # the id as text: a null would make pandas read the numbers as floats
    return docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(score, SCORED)


def language_model_scores(docs: DataFrame, held_out) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte`` of every row of ``docs`` (``doc_id, text``), learned from the
    rows where ``held_out`` (a column) is false."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    train = rows.where("NOT held_out")
    tokens = shared_table(token_table(train), "mixing_tokens")
    distinct, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    lex = lexicon(tokens, total)
    shared = shared_value(spark, lex)
    words = shared_value(spark, word_model(train, shared))
    below = float(np.log10(total + distinct + 1))
    done = shared_table(scored(rows, words, shared, below).withColumn("_row", F.monotonically_increasing_id()), "mixing_scored")

    letters = shared_value(spark, letter_model(tokens, shared, lex.letters.n_nodes))
    said = F.posexplode(F.split("rare", " ", -1)).alias("k", "token")
    rare = done.select("_row", "times", said).select("_row", "token", F.get("times", F.col("k")).alias("n"))
    # words outside the lexicon: those of the token table, and what only held-out rows say
    known = tokens.where(~of_lexicon(total) & (F.col("token") != "")).select("token", F.col("n").alias("c"))
    new = done.where("held_out").select(F.explode(F.split("rare", " ", -1)).alias("token")).distinct().join(known, "token", "left_anti")
    costs = shared_table(spelled(known.unionByName(new.withColumn("c", F.lit(0).cast("long"))), letters, shared), "mixing_spelled")
    rare = rare.join(costs, "token").groupBy("_row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_rare"),
        F.sum(F.col("n") * (F.log10(F.col("c") + 1) - F.lit(below))).alias("base_rare"),
        F.sum(F.col("n") * F.col("bits")).alias("bits_rare"),
    )
    none = F.lit(0.0)
    bits = F.col("bits") + F.coalesce("bits_rare", none)
    return done.join(rare, "_row", "left").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("common") + F.coalesce("base_rare", none)).alias("base_score"),
        (bits * F.lit(-float(np.log10(2)))).alias("score"),
        F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )
