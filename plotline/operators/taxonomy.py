"""Taxonomy outline parse, label counts per language, and coverage gaps.

Taxonomy table: ``theme, narrative, subnarrative`` (long form; each
narrative has an ``Other`` row). Counts are built once as a pre-aggregate
``(theme, narrative, subnarrative, language) -> count`` so the taxonomy
joins see distinct labels, not label occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotline.functions import labels as L
from plotline.operators.scan import carry_forward_many

CAPTION_WORD = "Figure"  # fixed: a line containing it names the page theme and ends the page


# --------------------------------------------------------------------------
# Outline pages -> taxonomy rows
# --------------------------------------------------------------------------

def parse_outline(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """Outline pages ``(doc, page, text)`` -> ``doc, page, line_no, theme,
    narrative, subnarrative``.

    Per page (in-row, no shuffle): lines are stripped; the first line that
    contains ``Figure`` gives the page theme (text after its first ``:``)
    and ends the page. A line without a leading ``-`` opens a narrative and
    yields ``(narrative, Other)``; a ``-`` line is a subnarrative of the
    last narrative, also one from an earlier page. Themes and narratives are
    carried over pages by ``carry_forward`` (split per block of pages).
    """
    is_head = lambda l: (l != F.lit("")) & ~l.startswith("-")
    p = pages.where(F.col(text).isNotNull() & (F.col(text) != "")).select(
        F.col(doc).alias("doc"),
        F.col(page).alias("page"),
        F.transform(F.split(F.col(text), "\n", -1), L.strip_py).alias("lines"),
    )
    p = p.withColumn(
        "cap", F.array_position(F.transform("lines", lambda l: F.instr(l, CAPTION_WORD) > 0), True)
    )
    cap_line = F.get(F.col("lines"), (F.col("cap") - 1).cast("int"))
    p = p.select(
        "doc",
        "page",
        # a caption without text keeps the theme of the pages before
        F.when(F.col("cap") > 0, F.nullif(L.strip_py(F.get(F.split(cap_line, ":", -1), 1)), F.lit(""))).alias("page_theme"),
        F.when(F.col("cap") > 0, F.slice("lines", 1, (F.col("cap") - 1).cast("int")))
        .otherwise(F.col("lines"))
        .alias("kept"),
    )
    # headings cut a page into runs of lines; each line is copied once
    at_heads = F.filter(F.transform("kept", lambda l, i: F.when(is_head(l), i + 1)), lambda x: x.isNotNull())
    p = p.select("*", F.array_distinct(F.concat(F.array(F.lit(1)), at_heads)).alias("starts"))
    ends = F.concat(F.slice(F.col("starts"), F.lit(2), F.size("starts")), F.array(F.size("kept") + 1))
    p = p.select(
        "*",
        F.try_element_at(F.filter("kept", is_head), F.lit(-1)).alias("page_last_head"),
        F.zip_with(
            "starts", ends, lambda a, b: F.struct(a.alias("start"), F.slice("kept", a, b - a).alias("run"))
        ).alias("runs"),
    )
    p = carry_forward_many(
        p, ["doc"], "page", [("page_theme", "theme", True), ("page_last_head", "head_before", False)]
    )
    runs = p.select("doc", "page", "theme", "head_before", F.explode("runs").alias("r"))
    lines = runs.select(
        "doc", "page", "theme", "head_before", F.col("r.start").alias("start"), F.get("r.run", F.lit(0)).alias("first"),
        F.posexplode("r.run").alias("k", "line"),
    ).withColumn("line_no", (F.col("start") - 1 + F.col("k")).cast("int"))
    line = F.col("line")
    narrative = F.coalesce(F.when(is_head(F.col("first")), F.col("first")), F.col("head_before"))
    sub = L.strip_py(F.regexp_replace(line, r"^[- ]+", ""))
    out = lines.select(
        "doc",
        "page",
        "line_no",
        "theme",
        F.when(is_head(line), line).otherwise(narrative).alias("narrative"),
        F.when(is_head(line), F.lit("Other")).when(line.startswith("-"), sub).alias("subnarrative"),
    )
    return out.where(F.col("narrative").isNotNull() & F.col("subnarrative").isNotNull())


def outline_taxonomy(pages: DataFrame) -> DataFrame:
    """``theme, narrative, subnarrative, position``: the distinct entries of an
    outline; ``position`` orders them as they first occur (by page and line;
    of several documents, interleaved)."""
    position = F.col("page").cast("long") * (1 << 32) + F.col("line_no")
    rows = parse_outline(pages)
    return rows.groupBy("theme", "narrative", "subnarrative").agg(F.min(position).alias("position"))


def label_vocabulary(taxonomy: DataFrame, themes=tuple(L.THEME_NAMES[t] for t in ("URW", "CC"))) -> DataFrame:
    """``combination``: narrative__subnarrative (blanks as ``_``) of every
    entry of the given themes, in one scan."""
    def joined(c: str) -> F.Column:
        return F.replace(F.col(c), F.lit(" "), F.lit("_"))

    return taxonomy.where(F.col("theme").isin(*themes)).select(
        F.concat(joined("narrative"), F.lit(L.COMBINED_PART_SEP), joined("subnarrative")).alias("combination")
    )


# --------------------------------------------------------------------------
# Label occurrences for counting
# --------------------------------------------------------------------------

def count_labels(lines: DataFrame, columns: str = "both", language: str = "language") -> DataFrame:
    """Label occurrences ``language, label`` from annotation lines.

    ``columns`` = ``both`` (reference: every label of every cell after the
    id, Q5, also the cells in ``more`` if there is such a column),
    ``narrative`` or ``subnarrative``. A cell that is absent has no labels;
    the other cells of its line count. Lines without any cell after the id
    give no row (F1).
    """
    none = F.array().cast("array<string>")

    def cell(name: str) -> F.Column:
        return F.coalesce(L.split_list(name), none)

    more = F.coalesce(F.flatten(F.transform("more", lambda x: L.split_list(x))), none) if "more" in lines.columns else none
    cells = {
        "both": F.concat(cell("narrative"), cell("subnarrative"), more),
        "narrative": cell("narrative"),
        "subnarrative": cell("subnarrative"),
    }[columns]
    return lines.select(F.col(language).alias("language"), F.explode(cells).alias("label"))


def decode_count_labels(occ: DataFrame) -> DataFrame:
    """Split a label on ``:`` by arity; 1 part -> (x, x, null), 2 ->
    (t, n, null), 3 -> (t, n, s), 4+ -> rejected. Parts are stripped and the
    theme abbreviation becomes the theme name (unknown -> null)."""
    parts = F.split(F.col("label"), ":", -1)
    n = F.size(parts)
    abbr = F.when(n == 1, F.col("label")).otherwise(F.get(parts, 0))
    nar = F.when(n == 1, F.col("label")).otherwise(F.get(parts, 1))
    sub = F.when(n == 3, F.get(parts, 2))
    return occ.select(
        "*",
        L.theme_name(abbr).alias("theme"),
        L.strip_py(nar).alias("narrative"),
        # an empty raw subnarrative counts as none, as in the reference
        F.when(sub != "", L.strip_py(sub)).alias("subnarrative"),
        F.when(n >= 4, F.lit("more than three ':' parts")).alias("reject_reason"),
    )


def cube_from_occurrences(occ: DataFrame) -> DataFrame:
    """``language, label`` occurrences (optionally weighted by a count
    column ``n``) -> ``theme, narrative, subnarrative, language, count`` over
    valid-arity labels.

    Raw label strings are counted first (partial aggregation combines hot
    keys map-side), so the string decoding runs once per distinct label and
    language, not once per occurrence."""
    weight = F.col("n") if "n" in occ.columns else F.lit(1)
    raw = occ.groupBy("language", "label").agg(F.sum(weight).cast("long").alias("count"))
    dec = decode_count_labels(raw)
    return (
        dec.where(F.col("reject_reason").isNull())
        .groupBy("theme", "narrative", "subnarrative", "language")
        .agg(F.sum("count").alias("count"))
    )


def label_cube(lines: DataFrame, columns: str = "both", language: str = "language") -> DataFrame:
    """Pre-aggregate of annotation lines (see ``cube_from_occurrences``)."""
    return cube_from_occurrences(count_labels(lines, columns, language))


def label_rejects(lines: DataFrame, columns: str = "both", language: str = "language") -> DataFrame:
    """labels skipped for their arity, with the reason."""
    dec = decode_count_labels(count_labels(lines, columns, language))
    return dec.where(F.col("reject_reason").isNotNull()).select("language", "label", "reject_reason")


# --------------------------------------------------------------------------
# counts
# --------------------------------------------------------------------------

def theme_counts(cube: DataFrame) -> DataFrame:
    """A1: ``theme, language, count`` of labels with a known theme."""
    return cube.where(F.col("theme").isNotNull()).groupBy("theme", "language").agg(F.sum("count").alias("count"))


def theme_rollup(cube: DataFrame) -> DataFrame:
    """A4: theme counts with per-theme totals (language null) and the grand total."""
    return (
        cube.where(F.col("theme").isNotNull())
        .rollup("theme", "language")
        .agg(F.sum("count").alias("count"))
    )


def _narratives(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.select("theme", "narrative").distinct()


def _subnarratives(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.select("theme", "narrative", "subnarrative").distinct()


def narrative_counts(cube: DataFrame, taxonomy: DataFrame, by_theme: bool = False) -> DataFrame:
    """A2 + J2: counts of labels whose (theme, narrative) is in the taxonomy,
    keyed by narrative name and language (Q7), or also by theme."""
    valid = cube.join(_narratives(taxonomy), ["theme", "narrative"], "left_semi")
    keys = (["theme"] if by_theme else []) + ["narrative", "language"]
    return valid.groupBy(*keys).agg(F.sum("count").alias("count"))


def subnarrative_counts(cube: DataFrame, taxonomy: DataFrame, by_theme: bool = False) -> DataFrame:
    """A3 + J2: counts of labels whose (theme, narrative, subnarrative) is in
    the taxonomy, keyed by subnarrative name and language, or by the triple."""
    valid = cube.where(F.col("subnarrative").isNotNull()).join(
        _subnarratives(taxonomy), ["theme", "narrative", "subnarrative"], "left_semi"
    )
    keys = (["theme", "narrative"] if by_theme else []) + ["subnarrative", "language"]
    return valid.groupBy(*keys).agg(F.sum("count").alias("count"))


# --------------------------------------------------------------------------
# gaps
# --------------------------------------------------------------------------

def narrative_gaps(taxonomy: DataFrame, counts: DataFrame) -> DataFrame:
    """Taxonomy narratives with no count in any language (Q8 fixed), Count 0.

    Keyed like ``counts``: by narrative name, or by theme too when the
    counts carry a theme column."""
    keys = ["theme", "narrative"] if "theme" in counts.columns else ["narrative"]
    seen = counts.select(*keys).distinct()
    return (
        _narratives(taxonomy)
        .join(seen, keys, "left_anti")
        .select("theme", "narrative", F.lit(0).cast("long").alias("count"))
    )


def subnarrative_gaps(taxonomy: DataFrame, counts: DataFrame) -> DataFrame:
    """Taxonomy subnarratives with no count in any language, Count 0; keyed by
    name, or by (theme, narrative, subnarrative) for by-theme counts."""
    keys = ["theme", "narrative", "subnarrative"] if "theme" in counts.columns else ["subnarrative"]
    seen = counts.select(*keys).distinct()
    return (
        _subnarratives(taxonomy)
        .join(seen, keys, "left_anti")
        .select("theme", "narrative", "subnarrative", F.lit(0).cast("long").alias("count"))
    )


def gaps_by_language(taxonomy: DataFrame, counts: DataFrame, languages: DataFrame, level: str = "narrative") -> DataFrame:
    """J6 per language (Q8): taxonomy entries with no count in a language of
    ``languages`` (``language``, e.g. the label cube: also a language without
    any valid label has gaps); ``theme, narrative[, subnarrative], language,
    count`` with count 0.

    No taxonomy x language product is joined: the (small) set of languages
    is a scalar subquery, and each entry's missing languages are the set
    difference with the languages it was counted in."""
    entry = ["theme", "narrative"] + (["subnarrative"] if level == "subnarrative" else [])
    keys = [k for k in entry if k in counts.columns] if "theme" in counts.columns else [level]
    all_langs = languages.select(F.array_sort(F.collect_set("language"))).scalar()
    seen = counts.groupBy(*keys).agg(F.collect_set("language").alias("__langs"))
    tax = taxonomy.select(*entry).distinct()
    missing = F.array_except(all_langs, F.coalesce(F.col("__langs"), F.array().cast("array<string>")))
    return tax.join(seen, keys, "left").select(
        *entry, F.explode(missing).alias("language"), F.lit(0).cast("long").alias("count")
    )
