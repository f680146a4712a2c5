"""Small tables and brute-force versions for the operator tests."""

from __future__ import annotations

import random
import zlib
from itertools import combinations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with what operators add or use inside.
CLASH = {
    c: "x"
    for c in (
        "score held_out predicted kept component_id digest postings hub block size whole p cut target rank u bucket "
        "shard slot law w h at spans items n_hit n_words _size _copies _source _id _text label x word"
    ).split()
}


def prose(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Prose with exact copies, near copies, repeated rows, nulls, blanks,
    short and very long texts."""
    rng = random.Random(seed)
    rows: list[tuple] = []
    for i in range(n):
        kind = i % 10
        if kind == 3 and rows:
            text = rng.choice(rows)[1]
        elif kind in (4, 5) and rows:
            words = (rng.choice(rows)[1] or "a b c").split()
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(999)}"
            text = " ".join(words)
        elif kind == 6:
            text = " ".join(prose(rng, rng.randrange(1, 6), 3))
        else:
            text = " ".join(prose(rng, rng.randrange(20, 200))) + "\n" + " ".join(prose(rng, 15))
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice(["hot", "hot", "b", "c", None]), len(text)))
    rows += [
        (n, None, None, None, None),
        (n + 1, "", "en", "b", 0),
        (n + 2, " \t\n ", "en", "hot", 4),
        (n + 3, " ".join(prose(rng, 20_000, 10**6)), "en", "c", 1),
        (n + 4, "ÄRGER Ünïcode word éé", "de", "hot", 1),
    ]
    return rows + [rows[0], rows[1]]


def table(spark, rows: list[tuple], schema: str = DOCS):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(v) for c, v in CLASH.items() if c not in df.columns})


def crc_rest(doc_id: int, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def near_components(rows: list[tuple], percent: int = 75) -> dict[int, int]:
    """doc_id -> smallest id reachable over all pairs that reach the threshold."""
    sets: dict[int, set] = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], set()).add(shingles(r[1]))
    low = {i: i for i in sets}

    def root(i: int) -> int:
        while low[i] != i:
            i = low[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            a, b = sorted((root(a), root(b)))
            low[b] = a
    return {i: root(i) for i in sets}
