"""Bit predictors over hashed contexts, mixed in the logistic domain: the numeric
part of ``context_mixing``, on flat arrays of many documents at once.

A text is the sequence of its words and an end. A prefix code by the words' counts
turns each into a few binary decisions, frequent words into the fewest; a word
outside the lexicon is an escape, and its bytes and an end of the word follow in a
code of their own. Each of ``N`` predictors looks up its context (words before;
letters before in the word) and the decision's node of the code tree in a table of
a fixed number of slots. What a word's letters cost depends on the word alone, so it is
worked out once for each distinct word. All numbers here are bounds of a task's
memory; none drops text.
"""

from __future__ import annotations

import heapq
import zlib
from itertools import chain, repeat

import numpy as np

#: Slots of a predictor's table, as a power of two, for words and for letters.
WORD_BITS, LETTER_BITS = 20, 21
#: Predictors: 0, 1 or 2 words before; for letters, so many letters before, or all
#: of the word's.
N = 3
LETTERS = (2, 4)
#: Weight sets: by depth of a word's node (up to DEPTHS), or by letter node, and by
#: how many of the two longer contexts have been seen.
DEPTHS, CLASSES = 24, 3
#: A slot with c1 of c observed ones predicts (c1 + PRIOR) / (c + 2 PRIOR); tables
#: hold the log odds of that in steps of 1 / SCALE.
PRIOR, SCALE = 0.15, 15.0
#: Decisions of one weight update and its rate; words between two updates of a
#: document's gains, and the strength of the first gain of 1.
UPDATE, RATE, STEP, FIRM = 1 << 15, 0.05, 256, 50.0
#: Weights before any update.
FIRST = 0.4
END_OF_WORD = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base))))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text (between U+0009-U+000D and space), A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Code:
    """A prefix code by counts (each plus one): per symbol its number of decisions
    (``length``), their nodes in the code tree and their bits from ``start``."""

    def __init__(self, counts, salt: int):
        n = len(counts)
        heap = [(int(c) + 1, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        parent = np.zeros(2 * n - 1, np.int64)
        side = np.zeros(2 * n - 1, np.int8)
        for node in range(n, 2 * n - 1):
            (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
            parent[left] = parent[right] = node
            side[right] = 1
            heapq.heappush(heap, (a + b, node))
        depth = np.zeros(2 * n - 1, np.int64)
        for node in range(2 * n - 3, -1, -1):
            depth[node] = depth[parent[node]] + 1
        self.length = depth[:n].copy()
        self.start = np.cumsum(self.length) - self.length
        self.nodes = np.zeros(self.length.sum(), np.int32)
        self.bits = np.zeros(self.length.sum(), np.int8)
        # all symbols climb together, writing their paths from the back
        at, put, left = np.arange(n), self.start + self.length - 1, self.length.copy()
        while (on := left > 0).any():
            self.nodes[put[on]] = parent[at[on]] - n
            self.bits[put[on]] = side[at[on]]
            at, put, left = np.where(on, parent[at], at), put - 1, left - 1
        self.n_nodes = n - 1
        self.depth = np.minimum(depth[n:], DEPTHS - 1)
        self.gate = (self.depth * CLASSES).astype(np.int32)
        self.salt = ((np.arange(n - 1, dtype=np.uint64) + np.uint64(salt)) * _ODD >> np.uint64(32)).astype(np.uint32)

    def decisions(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Decisions of each symbol, and the node and bit of all of them in turn."""
        lengths = self.length[symbols]
        ends = np.cumsum(lengths)
        at = np.repeat(self.start[symbols] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return lengths, self.nodes[at], self.bits[at]


class Lexicon:
    """The words with a code of their own, with their counts, and the code of
    letters for the rest."""

    def __init__(self, counts: dict[bytes, int], ends: int, others: int, letters):
        self.ids = {w: i for i, w in enumerate(counts)}
        self.counts = np.array([*counts.values(), ends], np.int64)
        self.end, self.escape = len(counts), len(counts) + 1
        self.words = Code([*counts.values(), ends, others], 1)
        self.letters = Code(letters, 1 << 40)

    def numbered(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """A number for each word and the end, and the words outside, which get
        numbers above ``escape``."""
        out = np.fromiter(chain(map(self.ids.get, words, repeat(-1)), (self.end,)), np.int64, len(words) + 1)
        at = np.flatnonzero(out < 0)
        others = [words[i] for i in at]
        out[at] = [self.escape + 1 + zlib.crc32(w) for w in others]
        return out, others


class Decisions:
    """Binary decisions of several sequences: their bits, contexts (None: none) and
    gates."""

    def __init__(self, code: Code, symbols: np.ndarray, hashes: list[np.ndarray | None], bits: int, deep: bool):
        self.table_bits = bits
        self.lengths, nodes, self.bits = code.decisions(symbols)
        self.code, self.nodes, self.salt = code, nodes, code.salt[nodes]
        self.gate = code.gate[nodes] if deep else nodes * np.int32(CLASSES)
        self.hashes = [None if h is None else (h >> np.uint64(32)).astype(np.uint32) for h in hashes]

    def slots(self, k: int) -> np.ndarray:
        """The slot of every decision in the table of predictor ``k``."""
        if self.hashes[k] is None:
            return self.node_slots()[self.nodes]
        h = np.repeat(self.hashes[k], self.lengths)
        h += self.salt
        return self.hashed(h)

    def node_slots(self) -> np.ndarray:
        """Without a context the slot is the node's own: the slots of all nodes."""
        return self.hashed(self.code.salt.copy())

    def hashed(self, h: np.ndarray) -> np.ndarray:
        h *= np.uint32(0x85EBCA6B)
        h >>= np.uint32(32 - self.table_bits)
        return h

    def values(self, k: int, table: np.ndarray) -> np.ndarray:
        """What ``table`` has for predictor ``k`` at every decision."""
        if self.hashes[k] is None and len(self.code.salt) < len(self.nodes):
            return np.take(np.take(table, self.node_slots()), self.nodes)
        return np.take(table, self.slots(k))


def of_words(parts, lexicon: Lexicon, order: np.ndarray | None = None) -> Decisions:
    """Decisions of parts of documents, ``(numbers, before)``: the words' numbers and
    the two numbers before the first; all words in turn, or in this ``order``."""
    numbers = np.concatenate([p[0] for p in parts])
    sizes = np.array([len(p[0]) for p in parts])
    first = np.cumsum(sizes) - sizes
    before = np.array([p[1] for p in parts])
    one, two, long = np.roll(numbers, 1), np.roll(numbers, 2), sizes > 1
    one[first], two[first] = before[:, 0], before[:, 1]
    two[first[long] + 1] = before[long, 0]
    one, two = one.astype(np.uint64) + np.uint64(1), two.astype(np.uint64) + np.uint64(1)
    if order is not None:
        numbers, one, two = numbers[order], one[order], two[order]
    hashes = [None, one * _ODD, (one * _ODD + two) * _ODD]
    return Decisions(lexicon.words, np.minimum(numbers, lexicon.escape), hashes, WORD_BITS, True)


def of_letters(words: list[bytes], lexicon: Lexicon) -> Decisions:
    """Decisions of the letters of words and their ends. Adds ``word``, the word that
    a decision is of."""
    sizes = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
    flat[ends - 1] = END_OF_WORD
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    h, hashes = np.zeros(len(flat), np.uint64), []
    for k in range(1, max(LETTERS) + 1):
        back = np.where(place >= k, np.roll(flat, k) + 1, 0)
        h = (h + back.astype(np.uint64) + np.uint64(k)) * _ODD
        if k in LETTERS:
            hashes.append(h)
    # all letters of the word so far: differences of a running polynomial, moved to
    # the start of the word
    start = np.repeat(ends - sizes, sizes)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((flat + 1).astype(np.uint64) * powers(_ODD, len(flat)))))
    hashes.append((total[:-1] - total[start]) * powers(_BACK, len(flat))[start] * _ODD)
    out = Decisions(lexicon.letters, flat, hashes, LETTER_BITS, False)
    out.word = np.repeat(np.repeat(np.arange(len(words)), sizes), out.lengths)
    return out


def log_odds(ones: np.ndarray, both: np.ndarray) -> np.ndarray:
    p = (ones + PRIOR) / (both + 2 * PRIOR)
    return np.log(p / (1 - p))


def looked_up(counts: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Log odds under the counts (zeros, ones) of slots."""
    pairs = counts.view(f"V{2 * counts.itemsize}").reshape(-1)  # one thing to fetch, not two
    pair = np.take(pairs, slots).view(counts.dtype).reshape(-1, 2) + PRIOR
    odds = pair[:, 1] / pair[:, 0]
    return np.log(odds, out=odds)


def steps(odds: np.ndarray) -> np.ndarray:
    """Log odds as a table's bytes."""
    return np.clip(np.rint(odds * SCALE), -127, 127).astype(np.int8)


class Counter:
    """What one task learns: per predictor the zeros and ones of its slots, and
    weights learned online, every batch (or one in ``tune_every``) from the second on
    predicted from the counts before it; before the first there are none."""

    def __init__(self, bits: int, n_gates: int, tune_every: int = 1):
        self.every, self.batches, self.decisions, self.counted = tune_every, 0, 0, 0
        self.counts = [np.zeros((1 << bits, 2), np.int32) for _ in range(N)]
        self.weights = np.full((n_gates * CLASSES, N), FIRST)
        self.squares = np.zeros_like(self.weights)

    def add(self, made: Decisions, times: np.ndarray | None = None) -> None:
        """Count decisions, each ``times`` times."""
        slots = [made.slots(k) for k in range(N)]
        if self.batches and (self.batches - 1) % self.every == 0:
            self.tune(made, slots)
        self.counted += len(made.bits) if times is None else int(times.sum())
        if self.counted > np.iinfo(self.counts[0].dtype).max:  # no slot can have more than this
            self.counts = [c.astype(np.int64) for c in self.counts]
        for c in self.counts:
            at = slots.pop(0).astype(np.int64)
            at *= 2
            at += made.bits
            np.add.at(c.reshape(-1), at, c.dtype.type(1) if times is None else times.astype(c.dtype))
        self.batches += 1

    def tune(self, made: Decisions, slots: list[np.ndarray]) -> None:
        own = None
        if made.hashes[0] is None:  # one number for each node: worked out once
            own = looked_up(self.counts[0], made.node_slots())
        for a in range(0, len(made.bits), UPDATE):
            cut = slice(a, a + UPDATE)
            x = [looked_up(c, at[cut]) if k or own is None else np.take(own, made.nodes[cut]) for k, (c, at) in enumerate(zip(self.counts, slots))]
            gate = made.gate[cut].astype(np.intp)
            for v in x[1:]:
                gate += v != 0
            z = sum(v * np.take(w, gate) for v, w in zip(x, self.weights.T))
            np.clip(z, -12, 12, out=z)
            error = made.bits[cut] - 1 / (1 + np.exp(-z))
            for j, v in enumerate(x):
                g = np.bincount(gate, error * v, len(self.weights))
                self.squares[:, j] += g * g
                self.weights[:, j] += RATE * g / np.sqrt(self.squares[:, j] + 1e-3)
            self.decisions += len(z)


class Mixer:
    """The gated mix of the predictors under merged tables and weights."""

    def __init__(self, tables: list[np.ndarray], weights: np.ndarray):
        self.tables = tables
        self.weights = [np.ascontiguousarray(w) for w in (weights / SCALE).astype(np.float32).T]

    def mixed(self, made: Decisions) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of a one, and class, of every decision."""
        x = [made.values(k, table) for k, table in enumerate(self.tables)]
        seen = sum((v != 0).view(np.int8) for v in x[1:])
        gate = made.gate.astype(np.intp)
        gate += seen
        return sum(v * np.take(w, gate) for v, w in zip(x, self.weights)), seen


def letter_bits(mixer: Mixer, words: list[bytes], lexicon: Lexicon) -> np.ndarray:
    """Bits of the letters and the end of each word."""
    made = of_letters(words, lexicon)
    z, _ = mixer.mixed(made)
    cost = np.log1p(np.exp(np.clip((1 - 2 * made.bits) * z, -12, 12)))
    return np.bincount(made.word, cost, len(words)) / np.log(2)


def word_bits(mixer: Mixer, parts, gains: np.ndarray, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each part's words (escapes without letters). A document starts with
    gains of 1 on the mix of each class and refines them every STEP words: ``gains``
    (parts x CLASSES x 2: gradients and curvatures so far) are returned as they are
    after the part."""
    n, sizes = len(parts), np.array([len(p[0]) for p in parts])
    part = np.repeat(np.arange(n), sizes)
    step = (np.arange(len(part)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // STEP
    # words are put in order of their steps before they become decisions
    order = np.argsort(step.astype(np.int16), kind="stable")
    made = of_words(parts, lexicon, order)
    z, seen = mixer.mixed(made)
    cell = np.repeat(part[order] * CLASSES, made.lengths) + seen
    sign = (1 - 2 * made.bits).astype(np.float32)
    ends = np.cumsum(np.bincount(step[order], made.lengths)).astype(np.int64)
    slope, bend = gains[..., 0].reshape(-1).copy(), gains[..., 1].reshape(-1).copy()
    cost = np.zeros(n * CLASSES)
    for a, b in zip([0, *ends[:-1]], ends):
        c, raw, s = cell[a:b], z[a:b], sign[a:b]
        gain = np.clip(1 + slope / (bend + FIRM), 0.2, 3).astype(np.float32)
        wrong = raw * np.take(gain, c)
        np.clip(wrong, -12, 12, out=wrong)
        wrong *= -s
        np.exp(wrong, out=wrong)
        wrong += 1
        np.divide(1, wrong, out=wrong)
        cost += np.bincount(c, -np.log1p(-wrong), len(cost))
        pull = wrong * raw
        slope -= np.bincount(c, s * pull, len(slope))
        bend += np.bincount(c, pull * raw * (1 - wrong), len(bend))
    return cost.reshape(n, CLASSES).sum(1) / np.log(2), np.stack((slope, bend), 1).reshape(n, CLASSES, 2)
