"""Whole-phrase, case-insensitive taxonomy phrase detection.

A phrase P is found in a text T when ``T rlike (?iU)\\bP\\b`` (P escaped).

* ``in_place`` (phrase table within ``BROADCAST_BYTES``): the phrases are
  broadcast as an index of token windows (words and what is between them). The
  tokens of a text are looked up among the phrases' first tokens, then their first
  two words, which tell the lengths of their phrases; only windows of those lengths
  are made, looked up, and verified. The texts stay where they are and are split into tokens once, in pieces
  of bounded length. A phrase without words must be a whole run between two words.
* ``shuffled`` (any size): every phrase has an anchor, its longest word or, without
  any, the phrase itself. Distinct words and runs of the texts are joined with the
  anchors by shuffle, and the candidates with the texts by id.

Both return ``id, kind, phrase`` for every match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotline.functions import labels as L
from plotline.operators.joins import spread

#: Phrases are broadcast up to this many bytes of phrase text.
BROADCAST_BYTES = 8 << 20
#: Tokens of a text whose windows are looked up from one row.
PIECE = 256
_REGEX_META = r"([\\\[\]{}()*+?.^$|])"
_WORD_RUN = r"(?U)\w+"
_TOKEN = r"(?U)\w+|\W+"


def _fold_table() -> tuple[str, str]:
    """Characters whose lower case differs from the lower case of their
    upper case (dotless i, long s, final sigma, Greek symbol forms, ...),
    mapped to the latter, plus İ -> i and ẞ -> ß. Built from the Unicode
    case rules of the BMP; ``lower(translate(x, FROM, TO))`` then maps
    characters that ``(?iU)`` treats as equal to the same text."""
    src, dst = ["İ", "ẞ", "Σ"], ["i", "ß", "σ"]
    for cp in range(0x80, 0x10000):
        c = chr(cp)
        up = c.upper()
        if len(up) != 1 or len(c.lower()) != 1 or c in src:
            continue
        target = up.lower()
        if len(target) == 1 and target != c.lower():
            src.append(c)
            dst.append(target)
    return "".join(src), "".join(dst)


_FOLD_FROM, _FOLD_TO = _fold_table()


def fold(col) -> Column:
    """Case folding used by the cheap pre-test (both sides). Catalyst turns
    ``lower(upper(x))`` into ``lower(x)``, so the characters where the two
    differ are mapped explicitly first."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.translate(c, _FOLD_FROM, _FOLD_TO))


def phrase_pattern(col) -> Column:
    """``(?iU)\\b`` + escaped phrase + ``\\b``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(r"(?iU)\b"), F.regexp_replace(c, _REGEX_META, r"\\$1"), F.lit(r"\b"))


def taxonomy_phrases(taxonomy: DataFrame) -> DataFrame:
    """``kind, phrase``: distinct narrative and subnarrative names (Q14:
    subnarratives are searched without their narrative)."""
    nar = taxonomy.select(F.lit("narrative").alias("kind"), F.col("narrative").alias("phrase"))
    sub = taxonomy.select(F.lit("subnarrative").alias("kind"), F.col("subnarrative").alias("phrase"))
    return nar.unionByName(sub).where(F.col("phrase").isNotNull() & (F.col("phrase") != "")).distinct()


def _longest_word(col: Column) -> Column:
    """The longest word run of a phrase ('' when it has none). Every whole
    word run of a phrase is a whole token of any text the phrase matches
    (it is bounded by non-word characters of the phrase or by ``\b``);
    the longest is usually the rarest, so it makes the fewest candidates."""
    words = F.regexp_extract_all(col, F.lit(_WORD_RUN), 0)
    return F.aggregate(words, F.lit(""), lambda acc, w: F.when(F.length(w) > F.length(acc), w).otherwise(acc))


def _prepared(phrases: DataFrame) -> DataFrame:
    folded = fold("phrase")
    word = _longest_word(folded)
    return phrases.select(
        "kind",
        "phrase",
        phrase_pattern("phrase").alias("__pat"),
        folded.alias("__folded"),
        F.when(word != "", word).otherwise(folded).alias("__anchor"),
    )


def _tokens(text_col: str) -> Column:
    """Distinct words, and runs between words, of the folded text."""
    return F.array_distinct(F.regexp_extract_all(fold(text_col), F.lit(_TOKEN), F.lit(0)))


def _in_place(docs: DataFrame, ph: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Token windows of bounded pieces. A phrase, without what is no word at its ends,
    is one window of tokens wherever it is matched, so what the index finds is what
    the pattern is tried on: on the window and two tokens on each side, which is all
    that ``\\b`` looks at. Texts are cut into pieces of ``PIECE`` tokens or the longest
    phrase's, so that no row carries more than that, however long a text is."""
    trimmed = F.regexp_replace("__folded", r"(?U)^\W+|\W+$", "")
    keyed = ph.withColumn("__key", F.when(trimmed != "", trimmed).otherwise(F.col("__folded")))
    keyed = keyed.withColumn("__w", F.regexp_extract_all("__key", F.lit(_TOKEN), F.lit(0))).withColumn("__n", F.size("__w"))
    # first token -> lengths of heads (a word, or two and what is between); head -> lengths of phrases
    head_size = F.least("__n", F.lit(3))
    starts = keyed.groupBy(F.get("__w", F.lit(0)).alias("__start")).agg(F.collect_set(head_size).alias("__heads"))
    heads = keyed.groupBy(F.array_join(F.slice("__w", 1, 3), "").alias("__head")).agg(F.collect_set("__n").alias("__sizes"))
    index = keyed.select("__key", "__n", "kind", "phrase", "__pat")
    longest = keyed.agg(F.max("__n")).first()[0] or 1  # one small job
    size = max(PIECE, longest)
    # a piece has the tokens of the windows that start in it, and two more on each side
    tokens = F.regexp_extract_all(F.col(text_col), F.lit(_TOKEN), F.lit(0))
    d = docs.select(F.col(id_col).alias("__id"), tokens.alias("__all")).select("__id", "__all", F.transform("__all", fold).alias("__low"))

    def cut(at):
        before, first = F.least(at - 1, F.lit(2)), F.greatest(at - 2, F.lit(1))
        own = F.least(F.size("__all") - at + 1, F.lit(size))
        part = [F.slice(c, first, before + size + longest + 1).alias(c) for c in ("__all", "__low")]
        return F.struct(before.alias("__before"), own.alias("__own"), *part)

    begins = F.filter(F.sequence(F.lit(1), F.greatest(F.size("__all"), F.lit(1)), F.lit(size)), lambda _: F.size("__all") > 0)
    pieces = d.select("__id", F.explode(F.transform(begins, cut)).alias("__p")).select("__id", "__p.*")
    at = pieces.select("*", F.posexplode("__low").alias("__i", "__start"))
    at = at.where((F.col("__i") >= F.col("__before")) & (F.col("__i") < F.col("__before") + F.col("__own")))

    def window(n):
        return F.array_join(F.slice("__low", F.col("__i") + 1, F.col(n)), "")

    found = at.join(F.broadcast(starts), "__start").select("__id", "__all", "__low", "__i", F.explode("__heads").alias("__h"))
    found = found.withColumn("__head", window("__h")).join(F.broadcast(heads), "__head")
    found = found.select("__id", "__all", "__low", "__i", F.explode("__sizes").alias("__n"))
    tried = found.select("__id", "__all", "__i", "__n", window("__n").alias("__key"))
    left = F.least("__i", F.lit(2))
    around = F.array_join(F.slice("__all", F.col("__i") + 1 - left, left + F.col("__n") + 2), "")
    hits = tried.join(F.broadcast(index), ["__key", "__n"]).where(F.regexp_like(around, F.col("__pat")))
    return hits.select("__id", "kind", "phrase").distinct()


def _shuffled(docs: DataFrame, ph: DataFrame, id_col: str, text_col: str) -> DataFrame:
    toks = docs.select(F.col(id_col).alias("__id"), F.explode(_tokens(text_col)).alias("__anchor"))
    cand = toks.join(ph.hint("merge"), "__anchor")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    return cand.join(texts, "__id").where(F.regexp_like(F.col("__t"), F.col("__pat")))


def find_phrases(
    docs: DataFrame, phrases: DataFrame, id_col: str = "id", text_col: str = "text", strategy: str = "auto"
) -> DataFrame:
    """Every (document, phrase) whole-phrase match -> ``id, kind, phrase``.
    ``auto`` measures the phrase table's bytes (one small job)."""
    if strategy == "auto":
        size = phrases.agg(F.sum(F.octet_length("phrase")).alias("n")).first()["n"] or 0
        strategy = "in_place" if size <= BROADCAST_BYTES else "shuffled"
    docs = spread(docs.where(F.col(text_col).isNotNull()))
    plan = {"in_place": _in_place, "shuffled": _shuffled}[strategy]
    return plan(docs, _prepared(phrases), id_col, text_col).select(F.col("__id").alias(id_col), "kind", "phrase")


def detect(
    docs: DataFrame,
    taxonomy: DataFrame,
    id_col: str = "article_id",
    text_col: str = "gpt_output",
    class_col: str = "p_domains",
    other_class: int = L.OTHER_CLASS,
    strategy: str = "auto",
    scoped: bool = False,
) -> DataFrame:
    """M3: ``docs`` + ``p_narrative``, ``p_subnarrative`` (sorted distinct
    arrays, P22 / Q16). Nothing found -> ``[Other]`` (P23); class
    ``other_class`` -> ``[Other]`` / ``[Other]`` without a search (P24).

    With ``scoped``, a subnarrative counts only when one of its narratives
    was found in the same text (the reference matches them alone, Q14)."""
    searched = docs.where(F.col(class_col).isNull() | (F.col(class_col) != other_class))
    hits = find_phrases(searched, taxonomy_phrases(taxonomy), id_col, text_col, strategy)
    if scoped:
        # each subnarrative with its narratives, judged inside the document's row
        pairs = taxonomy.select(F.lit("subnarrative").alias("kind"), F.col("subnarrative").alias("phrase"), "narrative").distinct()
        hits = hits.join(pairs, ["kind", "phrase"], "left")
    nar = F.array_sort(F.collect_set(F.when(F.col("kind") == "narrative", F.col("phrase"))))
    sub = F.when(F.col("kind") == "subnarrative", F.struct("phrase", F.col("narrative") if scoped else F.col("phrase").alias("narrative")))
    per_doc = hits.groupBy(id_col).agg(nar.alias("__n"), F.collect_set(sub).alias("__s"))
    named = F.filter("__s", lambda x: F.array_contains("__n", x["narrative"])) if scoped else F.col("__s")
    per_doc = per_doc.select(id_col, "__n", F.array_sort(F.array_distinct(F.transform(named, lambda x: x["phrase"]))).alias("__s"))
    out = docs.join(per_doc, id_col, "left")
    other = F.array(F.lit("Other"))
    is_other = F.col(class_col).isNotNull() & (F.col(class_col) == other_class)
    return out.select(
        *[F.col(c) for c in docs.columns],
        F.when(is_other, other).otherwise(L.default_other("__n")).alias("p_narrative"),
        F.when(is_other, other).otherwise(L.default_other("__s")).alias("p_subnarrative"),
    )


def other_counts(detected: DataFrame) -> DataFrame:
    """Articles predicted all-``Other`` versus the rest."""
    all_other = (F.col("p_narrative") == F.array(F.lit("Other"))) & (
        F.col("p_subnarrative") == F.array(F.lit("Other"))
    )
    return detected.agg(
        F.count_if(all_other).alias("n_all_other"), F.count_if(~all_other).alias("n_with_labels")
    )
