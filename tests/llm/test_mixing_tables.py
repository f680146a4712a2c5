"""Numbers of the context mixer, worked out table by table."""

import numpy as np

from plotline.llm import bitmodel as B


def made(rng, lexicon, n=400):
    parts = [(np.append(rng.integers(0, lexicon.end, rng.integers(1, 700)), lexicon.end), (lexicon.end, lexicon.end)) for _ in range(n)]
    return parts, B.of_words(parts, lexicon)


def small():
    return B.Lexicon({b"w%d" % i: 400 // (i + 1) + 1 for i in range(300)}, 50, 20, np.ones(257, np.int64))


def test_odds_of_slots():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 1000, (1 << 10, 2))
    slots = rng.integers(0, 1 << 10, 5000).astype(np.uint32)
    found = counts[slots]
    np.testing.assert_allclose(B.looked_up(counts, slots), B.log_odds(found[:, 1], found.sum(1)), rtol=1e-9, atol=1e-12)
    assert not B.looked_up(np.full((4, 2), 7), np.arange(4)).any()  # as many zeros as ones: no odds


def test_slots_are_worked_out_once_for_counting_and_training(monkeypatch):
    rng, lex, calls = np.random.default_rng(5), small(), []
    plain = B.Decisions.slots
    monkeypatch.setattr(B.Decisions, "slots", lambda self, k: calls.append(k) or plain(self, k))
    task = B.Counter(B.WORD_BITS, B.DEPTHS)
    for _ in range(2):
        task.add(made(rng, lex, 20)[1])
    assert calls == [0, 1, 2] * 2 and task.decisions > 0


def test_words_put_in_another_order_keep_their_decisions():
    lex = small()
    parts, turn = made(np.random.default_rng(7), lex, 30)
    order = np.random.default_rng(8).permutation(sum(len(p[0]) for p in parts))
    moved = B.of_words(parts, lex, order)
    ends = np.cumsum(turn.lengths)
    back = np.concatenate([np.arange(ends[i] - turn.lengths[i], ends[i]) for i in order])
    assert (moved.bits == turn.bits[back]).all() and (moved.gate == turn.gate[back]).all()
    for k in range(B.N):
        assert (moved.slots(k) == turn.slots(k)[back]).all()


def test_counts_widen_before_they_overflow():
    lex = small()
    task = B.Counter(B.LETTER_BITS, lex.letters.n_nodes)
    words = [b"ab", b"zz"]
    one = B.of_letters(words, lex)
    assert all(c.dtype == np.int32 for c in task.counts)  # half the memory while it is enough
    for _ in range(3):
        task.add(one, np.full(len(one.bits), float(1 << 30)))
    for c in task.counts:
        assert c.dtype == np.int64 and c.sum() == 3 * (1 << 30) * len(one.bits)


def test_values_of_nodes_equal_values_of_slots():
    rng, lex = np.random.default_rng(8), small()
    _, words = made(rng, lex)
    task = B.Counter(B.WORD_BITS, B.DEPTHS)
    table = rng.integers(-127, 128, 1 << B.WORD_BITS).astype(np.int8)
    for k in range(B.N):
        assert (words.values(k, table) == table[words.slots(k)]).all()
    salted = words.salt * np.uint32(0x85EBCA6B) >> np.uint32(32 - B.WORD_BITS)
    assert (words.slots(0) == salted).all()
    task.add(words)
    for k in range(B.N):
        plain = np.bincount(words.slots(k).astype(np.int64) * 2 + words.bits, minlength=2 << B.WORD_BITS)
        assert (task.counts[k].reshape(-1) == plain).all()
