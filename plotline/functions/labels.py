"""Column expressions for label strings (no Python per row).

A label is ``DOMAIN: Narrative[: Subnarrative]`` or a bare name such as
``Other``. An annotation cell is a ``;``-list of labels. Every function
here returns a ``Column`` built from Spark built-ins so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
LABEL_SEP = ";"                 # between labels in a cell
PART_SEP = ": "                 # between domain, narrative, subnarrative
COMBINED_PART_SEP = "__"        # narrative__subnarrative in combined labels
LANGUAGE_CODES = ("BG", "EN", "HI", "PT")  # leftmost match wins, else Unknown
UNKNOWN_LANGUAGE = "Unknown"
QUOTE_CHARS = '["“”]'           # straight and curly double quotes -> '
DOMAIN_CLASS = {"URW": 0, "CC": 1}  # anything else (and null) -> 2
OTHER_CLASS = 2
THEME_NAMES = {
    "URW": "Ukraine War label taxonomy",
    "CC": "Climate Change label taxonomy",
    "Other": "Other",
}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_list(col, sep: str = LABEL_SEP) -> Column:
    """P25: ``a;b;`` -> [a, b, ''] (trailing empties kept, like str.split)."""
    return F.split(_c(col), sep, -1)


def has_domain(label) -> Column:
    """The label starts with word characters (maybe none) and ``:``.

    ``(?U)`` makes ``\\w`` Unicode-aware, as in Python 3 ``re``.
    """
    return _c(label).rlike(r"(?U)^\w*:")


def _parts(label) -> Column:
    return F.split(_c(label), PART_SEP, -1)


def domain_of(label) -> Column:
    """First ``": "`` part when the label has a domain, else ''."""
    return F.when(has_domain(label), F.get(_parts(label), 0)).otherwise(F.lit(""))


def narrative_of(label) -> Column:
    """Second part when the label has a domain, else the label."""
    return F.when(has_domain(label), F.get(_parts(label), 1)).otherwise(_c(label))


def subnarrative_of(label) -> Column:
    """P5: third part when the label has a domain, else the label.

    Null when a domain label has fewer than three parts (a reject, Q2).
    """
    return F.when(has_domain(label), F.get(_parts(label), 2)).otherwise(_c(label))


def narrative_subnarrative_of(label) -> Column:
    """All parts after the domain joined by ``": "``; bare labels as is (Q1 fixed).

    Null when a domain label has no second part.
    """
    parts = _parts(label)
    n = F.size(parts)
    joined = F.when(n >= 2, F.array_join(F.slice(parts, 2, F.greatest(n - 1, F.lit(1))), PART_SEP))
    return F.when(has_domain(label), joined).otherwise(_c(label))


def label_parts(label) -> Column:
    """``struct(label, has_domain, parts)``: one regex test and one split per
    label, shared by the decoders below."""
    return F.struct(_c(label).alias("l"), has_domain(label).alias("d"), _parts(label).alias("p"))


def narrative_from_parts(x) -> Column:
    """P4 on a ``label_parts`` struct."""
    return F.when(x["d"], F.get(x["p"], 1)).otherwise(x["l"])


def subnarrative_from_parts(x) -> Column:
    """P5 on a ``label_parts`` struct."""
    return F.when(x["d"], F.get(x["p"], 2)).otherwise(x["l"])


def narrative_subnarrative_from_parts(x) -> Column:
    """P6 on a ``label_parts`` struct."""
    n = F.size(x["p"])
    joined = F.when(n >= 2, F.array_join(F.slice(x["p"], 2, F.greatest(n - 1, F.lit(1))), PART_SEP))
    return F.when(x["d"], joined).otherwise(x["l"])


def map_labels(cell, fn) -> Column:
    """Apply a per-label expression to every label of a ``;``-cell."""
    return F.transform(split_list(cell), fn)


def combined_labels(narratives, subnarratives) -> Column:
    """``Narr_words__Sub_words`` pairwise; the shorter list wins."""
    n, s = _c(narratives), _c(subnarratives)
    m = F.least(F.size(n), F.size(s))
    return F.zip_with(
        F.slice(n, 1, m),
        F.slice(s, 1, m),
        lambda a, b: F.concat(
            F.replace(a, F.lit(" "), F.lit("_")),
            F.lit(COMBINED_PART_SEP),
            F.replace(b, F.lit(" "), F.lit("_")),
        ),
    )


def language_of(col, codes=LANGUAGE_CODES) -> Column:
    """Leftmost language code in an id or path, else ``Unknown``."""
    code = F.regexp_extract(_c(col), "(" + "|".join(codes) + ")", 1)
    return F.when(code == "", F.lit(UNKNOWN_LANGUAGE)).otherwise(code)


def domain_class(domain) -> Column:
    """URW -> 0, CC -> 1, anything else or null -> 2."""
    d = _c(domain)
    out = F.lit(OTHER_CLASS)
    for name, cls in reversed(list(DOMAIN_CLASS.items())):
        out = F.when(d == name, F.lit(cls)).otherwise(out)
    return out


def normalize_quotes(col) -> Column:
    """``"``, ``“`` and ``”`` become ``'``."""
    return F.regexp_replace(_c(col), QUOTE_CHARS, "'")


def title_of(col) -> Column:
    """First line of an article."""
    return F.get(F.split(_c(col), "\n", -1), 0)


def body_of(col) -> Column:
    """Lines from the third on, joined by newline."""
    lines = F.split(_c(col), "\n", -1)
    return F.array_join(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))), "\n")


def argmax(col) -> Column:
    """P20: index of the largest score, the first on ties (0-based)."""
    x = _c(col)
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def default_other(col) -> Column:
    """``[Other]`` when nothing was found."""
    x = _c(col)
    return F.when(F.coalesce(F.size(x), F.lit(0)) <= 0, F.array(F.lit("Other"))).otherwise(x)


def multi_hot(labels, classes) -> Column:
    """0/1 vector over a caller's class list (unknown labels ignored,
    repeats count once). Only for output; scoring uses set functions."""
    arr = F.array(*[F.lit(c) for c in classes])
    return F.transform(arr, lambda c: F.array_contains(_c(labels), c).cast("int"))


def theme_name(abbr) -> Column:
    """Theme abbreviation (trimmed) -> long name; unknown -> null."""
    pairs = []
    for k, v in THEME_NAMES.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), strip_py(abbr))


# Unicode White_Space (what Java's (?U)\s matches), for strip_py.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip_py(col) -> Column:
    """Python ``str.strip()``: trim Unicode white space on both ends (a
    character scan, no regex)."""
    return F.btrim(_c(col), F.lit(WHITE_SPACE))


# ---------------------------------------------------------------------------
# Text of a Python literal as JSON
# ---------------------------------------------------------------------------

#: An escape, a quote, or a run without either (no repeated group: Java matches
#: those recursively, which long texts would exhaust).
_LITERAL_PIECE = r"""(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|.)|['"]|[^\\'"]+"""
_BACKSLASH = "\\"


def _hex4(n: Column) -> Column:
    return F.concat(F.lit(r"\u"), F.lpad(F.hex(n), 4, "0"))


def _json_piece(x: Column) -> Column:
    """A piece of a Python string as JSON."""
    kind, rest = F.substring(x, 2, 1), F.substring(x, F.lit(3), F.length(x))
    wide = F.conv(rest, 16, 10).cast("long")
    above = wide - 0x10000
    pair = F.concat(_hex4(F.shiftright(above, 10) + 0xD800), _hex4(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00))
    octal = F.conv(F.substring(x, F.lit(2), F.length(x)), 8, 10).cast("long")
    plain = x
    for raw, said in (("\n", "n"), ("\r", "r"), ("\t", "t")):
        plain = F.replace(plain, F.lit(raw), F.lit(_BACKSLASH + said))
    return (
        F.when(x == '"', F.lit(r"\""))
        .when(~F.startswith(x, F.lit(_BACKSLASH)), plain)
        .when(kind == "x", F.concat(F.lit(r"\u00"), rest))
        .when(kind == "u", x)
        .when(kind == "U", F.when(wide > 0xFFFF, pair).otherwise(_hex4(wide)))
        .when(kind.between("0", "7"), _hex4(octal))
        .when(kind.isin("n", "r", "t", "b", "f", _BACKSLASH, '"'), x)
        .when(kind == "'", kind)
        .when(kind == "a", F.lit(r"\u0007"))
        .when(kind == "v", F.lit(r"\u000b"))
        .when(kind == "\n", F.lit(""))
        .otherwise(F.concat(F.lit(_BACKSLASH), x))
    )


def _json_signs(x: Column) -> Column:
    """What stands between the strings of a literal, as JSON."""
    out = F.translate(F.regexp_replace(x, r"\s+", ""), "()", "[]")
    for name, said in (("None", "null"), ("True", "true"), ("False", "false")):
        out = F.regexp_replace(out, rf"\b{name}\b", said)
    return F.regexp_replace(out, r",([\]}])", "$1")  # the last comma of a tuple


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: an expression that a lambda
    looks into is worked out again at every step, its own variable is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def literal_to_json(text) -> Column:
    """The JSON of a Python literal: strings in either quotes with their escapes,
    numbers, None, True, False, lists, tuples and dicts; null if a string does not
    end. Other text gives what is no JSON. In the row and without Python: the pieces
    are scanned once with the quote that is open."""
    c = F.col(text) if isinstance(text, str) else text
    pieces = F.regexp_extract_all(c, F.lit(_LITERAL_PIECE), F.lit(0))

    def step(acc, x):
        at, cuts = acc["at"] + 1, acc["cuts"]
        opens = (acc["open"] == "") & x.isin("'", '"')
        closes = (acc["open"] != "") & (acc["open"] == x)
        return F.struct(
            at.alias("at"),
            F.when(opens, x).when(closes, F.lit("")).otherwise(acc["open"]).alias("open"),
            F.when(opens | closes, F.concat(cuts, F.array(at))).otherwise(cuts).alias("cuts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("open"), F.array().cast("array<int>").alias("cuts"))

    def joined(pieces, cuts):
        def part(cut, i):
            after = F.get(cuts, i + 1)
            said = F.slice(pieces, cut + 1, F.greatest(after - cut - 1, F.lit(0)))
            string = F.concat(F.lit('"'), F.array_join(F.transform(said, _json_piece), ""), F.lit('"'))
            return F.when(after.isNull(), F.lit("")).when(i % 2 == 1, string).otherwise(_json_signs(F.array_join(said, "")))

        return F.array_join(F.transform(cuts, part), "")

    def said(pieces):
        # places of the quotes, with the ends: signs and strings take turns between them
        ends = lambda found: F.when(found["open"] == "", F.concat(F.array(F.lit(0)), found["cuts"], F.array(found["at"] + 1)))
        return _let(_let(F.aggregate(pieces, start, step), ends), lambda cuts: joined(pieces, cuts))

    return _let(pieces, said)
