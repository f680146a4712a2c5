"""Conversation trie, Merkle manifest and language-model scores against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, clashing, documents, table
from pyspark.sql import functions as F

from plotline.llm import bitmodel as B
from plotline.llm import context_mixing as CM
from plotline.llm import merkle as MK
from plotline.llm import trie as TR
from plotline.llm.common import held_out, shared_table
from plotline.llm.order import ranked

TURNS = "conv_id long, turn long, role string, text string"


# Ranks -----------------------------------------------------------------------


def test_ranks_are_gapless_in_a_group_of_any_size(spark):
    rng = random.Random(3)
    rows = [(None if k % 9 == 0 else "hot" if k % 3 else f"g{k % 5}", rng.randrange(40)) for k in range(3000)]
    df = shared_table(spark.createDataFrame(rows, "g string, x int"), "rank_rows")
    got = defaultdict(list)
    for r in ranked(df, ["g"], ["x"], "ranks").collect():
        got[r.g].append((r._pos, r.x))
    assert {g: len(v) for g, v in got.items()} == dict(Counter(g for g, _ in rows))
    for v in got.values():
        v.sort()
        assert [p for p, _ in v] == list(range(len(v))) and [x for _, x in v] == sorted(x for _, x in v)


# Trie ------------------------------------------------------------------------


def trie(rows):
    """conv_id, depth -> the row of the contract, by plain prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = (role or "", text or "")
            content = hashlib.sha256(f"{len(key[0].encode())}:{key[0]}{key[1]}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, content, key))
    plain = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = plain.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids, out = Counter(p[:-1] for p in members if p), {}
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        gain = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += gain
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        out[p] = (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def conversations(seed=5):
    rng = random.Random(seed)
    say = ["", "hi", "ja — ñ", "tell me more", "x" * 3000]
    rows = []
    for c in [*range(0, 60), *range(200, 260), *range(-130, -90), 1000, 1001, 505]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(say)))
    # a chain of several blocks of turns, a copy of it, and one that leaves it
    chain = [(t, "user", f"step {t % 7}") for t in range(300)]
    rows += [(c, *x) for c in (700, 701, 702) for x in chain]
    rows += [(703, *x) for x in chain[:150]] + [(703, 900, "user", "elsewhere")]
    # ties, null turns, repeated rows, no id, null cells
    rows += [(800, 1, "user", "b"), (800, 1, "user", "a"), (800, None, "user", "first"), (800, 1, "user", "a"), (None, 1, "user", "x")]
    rows += [(801, 0, None, None), (802, 0, "", "")]
    # many equal conversations
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2100) for t in range(8)]
    return rows


@pytest.mark.parametrize("chunk_bits", [2, 12])
def test_trie_matches_plain_prefixes(spark, chunk_bits, monkeypatch):
    monkeypatch.setattr(TR, "CHUNK_BITS", chunk_bits)
    rows = conversations()
    df = clashing(spark.createDataFrame(rows, TURNS)).repartition(5)
    got = sorted((tuple(r) for r in TR.conversation_trie(df).collect()), key=str)
    assert got == trie(rows)


def test_heavy_parents_and_small_tables(spark, monkeypatch):
    monkeypatch.setattr(TR, "HEAVY", 4)  # the root and other wide nodes go by broadcast
    rows = conversations(6)
    got = sorted((tuple(r) for r in TR.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()), key=str)
    assert got == trie(rows)
    assert TR.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    # turnless after the cut: only the root
    alone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2)
    (r,) = TR.conversation_trie(spark.createDataFrame([(alone, 0, "user", "gone")], TURNS)).collect()
    assert (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) == (alone, 0, None, 1, 0, 1, 0)
    assert r.ends_sha256 == hashlib.sha256(str(alone).encode()).hexdigest()


def test_contraction_is_short_on_long_chains(spark):
    n = 1000
    tree = spark.createDataFrame(
        [(k, k - 1 if k else None, k, int(k < n - 1), int(k == n - 1), k) for k in range(n)],
        "num long, parent long, depth long, kids long, leaves long, saved long",
    )
    raked, spliced = TR.contract(tree)
    assert len(raked) < 30 and spliced
    got = {r.num: (r.leaves, r.saved) for r in TR.expand(raked, spliced).collect()}
    assert got == {k: (1, sum(range(k, n))) for k in range(n)}


# Manifest --------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows):
    def leaf(r, more=0):
        i, text, lang, source, n = r
        values = [i, source, lang, None if n is None else n + more, text]
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            last = out[-1]
            out.append([sha(*last[k : k + 2]) for k in range(0, len(last), 2)])
        return out

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    low = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        low[lang] = levels([leaf(r) for r in groups[lang]])
    high = levels([low[x][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        for pos, r in enumerate(groups[lang]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded, proof = leaf(r, int(bad)), []
            for lv, p in ((low[lang], pos), (high, at)):
                for nodes in lv[:-1]:
                    side = nodes[p ^ 1 : (p ^ 1) + 1]
                    proof += side
                    folded = sha(*([*side, folded] if p % 2 else [folded, *side]))
                    p //= 2
            root = high[-1][0]
            out.append((r[0], leaf(r), low[lang][-1][0], root, sha(*proof), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [(2, 3), (9, 12)])
def test_manifest_matches_plain_tree(spark, bits, monkeypatch):
    monkeypatch.setattr(MK, "LEVELS", bits[0])
    monkeypatch.setattr(MK, "RUN_BITS", bits[1])
    monkeypatch.setattr(MK, "CLIMB", MK.climb_sql())
    rows = documents(n=150)
    rows += [(None, "no id", "en", "b", 3), (None, "no id", "en", "b", 3), (500, "x", None, None, 2**63 - 1), (501, "alone", "", "b", 1), (502, "y", "é", "b", None)]
    rows += [(503, f"copy {k % 2}", "hot", "b", 1) for k in range(70)]  # one id on many rows
    df = clashing(table(spark, rows)).repartition(4)
    seventh = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    got = sorted((tuple(r) for r in MK.manifest(df, seventh).collect()), key=str)
    assert got == manifest(rows)


def test_manifest_of_small_tables(spark):
    never = F.lit(False)
    assert MK.manifest(table(spark, [], DOCS), never).collect() == []
    one = [(7, "a", "en", "b", 1)]
    (r,) = MK.manifest(table(spark, one), never).collect()
    assert tuple(r) == manifest([(7, "a", "en", "b", 1)])[0] or not r.verified
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == sha()


# Language model --------------------------------------------------------------


def scores(spark, rows, **more):
    df = CM.language_model_scores(clashing(table(spark, rows)), held_out("doc_id", 7, 2), **more)
    return df.collect()


def test_baseline_matches_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(CM, "LEXICON", 200)  # most tokens go the shuffled way
    rows = documents() + [(None, "Null ID w1 w2", "en", "b", 1)]
    seen = Counter()
    words = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for i, t, *_ in rows:
        if not held(i):
            seen.update(words(t))
    n, v = seen.total(), len(seen)
    want = sorted(
        (str(i), held(i), len(words(t)), sum(seen[w] > 0 for w in words(t)), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in words(t)), 6))
        for i, t, *_ in rows
    )
    got = scores(spark, rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    # rows of one text have one score, whatever their place
    by_text = defaultdict(set)
    texts = {str(i): t for i, t, *_ in rows}
    for r in got:
        by_text[texts[str(r.doc_id)]].add(round(r.score, 6))
    assert all(len(v) == 1 for v in by_text.values())


def test_model_is_a_distribution_and_learns(spark):
    """Predictions of a decision add up to 1 whatever comes, and text like the
    training text costs less than other text."""
    rng = random.Random(9)
    verb = ["runs", "sits", "eats", "sleeps"]
    say = lambda: " ".join(f"the {rng.choice(['cat', 'dog', 'bird'])} {rng.choice(verb)} and" for _ in range(60))
    rows = [(i, say(), "en", "b", 1) for i in range(400)]
    odd = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows += [(odd[0], " ".join(rng.sample(say().split(), 200)), "en", "b", 1), (odd[1], say() + " zyzzyva " * 3, "en", "b", 1)]
    got = {r.doc_id: r for r in scores(spark, rows)}
    fresh = [r for i, r in got.items() if r.held_out and i < 400]
    assert fresh and all(r.score > r.base_score for r in fresh)
    assert max(r.bits_per_byte for r in fresh) < 0.6 < got[odd[0]].bits_per_byte


def test_code_is_a_prefix_code_and_pieces_go_on(monkeypatch):
    rng = random.Random(1)
    code = B.Code([rng.randrange(1000) for _ in range(300)], 1)
    paths = ["".join(map(str, code.bits[s : s + n])) for s, n in zip(code.start, code.length)]
    assert abs(sum(2.0 ** -len(p) for p in paths) - 1) < 1e-12
    assert not any(a != b and b.startswith(a) for a in paths for b in paths)
    lex = B.Lexicon({b"a": 5, b"b": 3}, 2, 4, [1] * 257)
    words = [rng.choice([b"a", b"b", b"cc", b"\xc3\xa9"]) for _ in range(50)]
    numbers, others = lex.numbered(words)
    assert others == [w for w in words if w not in (b"a", b"b")]
    whole = B.of_words(list(CM.parts_of(numbers, lex.end)), lex)
    monkeypatch.setattr(CM, "PIECE", 7)
    cut = B.of_words(list(CM.parts_of(numbers, lex.end)), lex)
    for k in range(B.N):
        assert whole.slots(k).tolist() == cut.slots(k).tolist()


def test_gates_gains_and_tables_change_scores(monkeypatch):
    """Each part of the method bears on the result."""
    import numpy as np

    rng = random.Random(2)
    lex = B.Lexicon({f"w{k}".encode(): 50 for k in range(50)}, 20, 30, [1] * 257)
    docs = [lex.numbered([f"w{min(49, int(rng.expovariate(0.1)))}".encode() for _ in range(400)])[0] for _ in range(30)]
    task = B.Counter(B.WORD_BITS, B.DEPTHS, 2)
    for d in docs:
        task.add(B.of_words(list(CM.parts_of(d, lex.end)), lex))
    tables = [B.steps(B.log_odds(c[:, 1], c.sum(1))) for c in task.counts]

    def cost(t, w):
        return B.word_bits(B.Mixer(t, w), list(CM.parts_of(docs[0], lex.end)), np.zeros((1, B.CLASSES, 2)), lex)[0][0]

    full = cost(tables, task.weights)
    assert task.decisions > 0 and full < cost(tables, np.full_like(task.weights, 0.4))
    assert full < cost([tables[0], tables[1] * 0, tables[2] * 0], task.weights)
    monkeypatch.setattr(B, "FIRM", 1e12)  # gains stay 1
    assert cost(tables, task.weights) != full


def test_letters_learn_with_their_counts():
    import numpy as np

    lex = B.Lexicon({b"the": 9}, 1, 9, [1] * 257)
    task = B.Counter(B.LETTER_BITS, lex.letters.n_nodes, 2)
    for _ in range(4):
        made = B.of_letters([b"banana", b"ban"], lex)
        task.add(made, np.array([5.0, 1.0])[made.word])
    assert task.counts[0].sum() == 4 * (5 * lex.letters.length[list(b"banana") + [256]].sum() + lex.letters.length[list(b"ban") + [256]].sum())
    mixer = B.Mixer([B.steps(B.log_odds(c[:, 1], c.sum(1))) for c in task.counts], task.weights)
    said = B.letter_bits(mixer, [b"banana", b"zqzqzq"], lex)
    assert said[0] < said[1] / 3


def test_scores_of_empty_tables(spark):
    assert scores(spark, []) == []
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = scores(spark, [(only, None, None, None, None)])
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (1, 0, 0, 0.0) and r.score < 0


def test_every_batch_trains_the_weights():
    import numpy as np

    from plotline.llm import bitmodel as B

    lex = B.Lexicon({b"a": 9, b"b": 5}, 3, 1, np.ones(257, np.int64))
    task, sizes = B.Counter(B.WORD_BITS, B.DEPTHS), []
    for _ in range(5):
        made = B.of_words([(np.array([0, 1, 0, 0, lex.end]), (lex.end, lex.end))], lex)
        sizes.append(len(made.bits))
        task.add(made)
    # the first batch meets empty tables; all others are predicted before they are counted
    assert task.decisions == sum(sizes[1:])
