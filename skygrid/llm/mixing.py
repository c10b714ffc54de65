"""A byte model by logistic mixing of context bit predictors.

Bytes are coded bit by bit, most significant first, along the 255 inner nodes
of the tree of byte values.  For each order ``k`` a predictor has the exact
counts of the bits seen at the node after the last ``k`` bytes.  Its estimate in
the logistic domain is weighted by a gate -- the predictor's own evidence
there, and the longest order that knows the context -- and summed; an adaptive
probability map refines the sum by the node.  Weights and map are learned
online, in small steps over training windows, the bits of the texts they come
from taken out of the counts first.  A trained model is frozen, so a text's
probability does not depend on which texts were scored before it.

A text is followed by an end symbol (byte 0) and preceded by six of them.
"""

from __future__ import annotations

import numpy as np

ORDERS = (1, 2, 3, 4, 5, 6)
SPAN = 7                               # bytes of the longest context and its symbol
BLOCK = 1 << 14                        # windows mixed together, to stay in cache
GATHER = 1 << 17                       # windows whose counts are looked up together: most share short contexts
DELTA = 0.04
EVIDENCE = 32
LOG2 = np.log(2.0)
_M = np.uint64(0x9E3779B97F4A7C15)
_LIMIT = 9.0
_BUCKETS = 33
_NUMBER = np.arange(1, len(ORDERS) + 1, dtype=np.int32)[:, None]
_FIRST_CELL = np.arange(len(ORDERS), dtype=np.int32)[:, None] * EVIDENCE
assert len(ORDERS) * EVIDENCE * (len(ORDERS) + 1) <= 1 << 11
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _pack(stream: np.ndarray) -> np.ndarray:
    """All windows of a stream: six bytes and the symbol after them, packed."""
    packed = np.zeros(max(0, len(stream) - SPAN + 1), np.uint64)
    for i in range(SPAN):
        packed = (packed << np.uint64(8)) | stream[i:len(packed) + i]
    return packed


def windows(texts: list[bytes], chunk: int = 3 << 20):
    """Yield ``(windows, text number of each)`` of lower-cased texts with their end symbols.

    Short texts come together, about ``chunk`` bytes at a time; a longer text
    comes in several parts.
    """
    pad, held, first, size = bytes(SPAN - 1), [], 0, 0

    def together():
        packed = _pack(np.frombuffer(pad + b"".join(t + pad for t in held), np.uint8))
        lengths = np.array([len(t) + 1 for t in held], np.int64)
        # After a text's end symbol, the pad's other zeros are nobody's symbols.
        keep = np.ones(len(packed), bool)
        gaps = np.cumsum(lengths[:-1] + SPAN - 2)[:, None] - (SPAN - 2) + np.arange(SPAN - 2)
        keep[gaps.ravel()] = False
        keep[lengths.sum() + (SPAN - 2) * (len(held) - 1):] = False
        return packed[keep], first + np.repeat(np.arange(len(held)), lengths)

    for n, text in enumerate(texts):
        if held and size + len(text) > chunk:
            yield together()
            held, size = [], 0
        if len(text) > chunk:
            stream = np.frombuffer(pad + text.translate(_LOWER) + b"\0", np.uint8)
            for at in range(0, len(text) + 1, chunk):
                packed = _pack(stream[at:at + chunk + SPAN - 1])
                yield packed, np.full(len(packed), n)
            continue
        if not held:
            first = n
        elif first + len(held) != n:      # a long text stood between
            yield together()
            held, size, first = [], 0, n
        held.append(text.translate(_LOWER))
        size += len(text)
    if held:
        yield together()


_table = np.zeros(1 << 22, np.int32)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(distinct values, index of each value among them)``, in no order.

    One pass through a hash table settles most values; those that lose their
    place in it are sorted.
    """
    n = len(values)
    slot = (values * _M) >> np.uint64(42)
    _table[slot] = np.arange(n, dtype=np.int32)
    first = _table[slot]
    settled = values[first] == values
    mark = np.zeros(n, bool)
    mark[first[settled]] = True
    kept = np.flatnonzero(mark)
    rank = np.zeros(n, np.int32)
    rank[kept] = np.arange(len(kept), dtype=np.int32)
    index = rank[first]
    rest = np.flatnonzero(~settled)
    if not len(rest):
        return values[kept], index
    more, back = np.unique(values[rest], return_inverse=True)
    index[rest] = len(kept) + back
    return np.concatenate((values[kept], more)), index


class Counts:
    """Exact counts of the symbols after each context, for some orders.

    Per order, the sorted distinct window ends (context and symbol) and the
    running sums of their counts: a context's symbols, and those below a node
    of the tree, are neighbours there.
    """

    def __init__(self, orders=ORDERS):
        self.orders = orders
        self.keys = {k: np.zeros(0, np.uint64) for k in orders}
        self.sums = {k: np.zeros(1, np.int64) for k in orders}

    def add(self, packed: np.ndarray, counts: np.ndarray) -> None:
        """Add windows seen ``counts`` times."""
        if not len(packed):
            return
        for k in self.orders:
            keys = np.concatenate((self.keys[k], _end(packed, k)))
            n = np.concatenate((np.diff(self.sums[k]), counts.astype(np.int64)))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            self.keys[k] = keys[first]
            self.sums[k] = np.concatenate(([0], np.cumsum(np.add.reduceat(n[order], first))))

    def bits(self, k: int, ends: np.ndarray) -> np.ndarray:
        """``(2, 8, windows)``: zeros and ones at each node on the way to the symbols, after the last ``k`` bytes."""
        symbol = ends & np.uint64(255)
        base = ends - symbol

        def below(at):
            return self.sums[k][np.searchsorted(self.keys[k], at)]
        out = np.empty((2, 8, len(ends)), np.int64)
        low, high = below(base), below(base + np.uint64(256))
        for depth in range(8):
            start = base + ((symbol >> np.uint64(8 - depth)) << np.uint64(8 - depth))
            middle = below(start + np.uint64(128 >> depth))
            out[0, depth], out[1, depth] = middle - low, high - middle
            one = ((symbol >> np.uint64(7 - depth)) & np.uint64(1)).astype(bool)
            low, high = np.where(one, middle, low), np.where(one, high, middle)
        return out


def _end(packed: np.ndarray, k: int) -> np.ndarray:
    """The last ``k`` bytes before the symbol, and the symbol."""
    return packed & np.uint64((1 << 8 * (k + 1)) - 1)


def empty_counts() -> Counts:
    return Counts()


def add_counts(counts: Counts, packed: np.ndarray, n: np.ndarray) -> None:
    """Add windows seen ``n`` times to the counts."""
    counts.add(packed, n)


def gather(packed: np.ndarray, counts: list[Counts], without: tuple[Counts, ...] = ()):
    """``(symbols, estimates, evidence)`` of windows, from counts that have each order once."""
    st = np.empty((len(ORDERS), 8, len(packed)), np.float32)
    evidence = np.empty((len(ORDERS), 8, len(packed)), np.uint8)
    for held in counts:
        for k in held.orders:
            ends, back = np.unique(_end(packed, k), return_inverse=True)
            n = held.bits(k, ends)
            for other in without:
                if k in other.orders:
                    n -= other.bits(k, ends)
            s, e = _estimate(n[0], n[1])
            st[k - 1], evidence[k - 1] = s[:, back], e[:, back]
    return (packed & np.uint64(255)).astype(np.int32), st, evidence


def _stretch(p):
    return np.log(p / (1.0 - p))


def _squash(x):
    return 1.0 / (1.0 + np.exp(-x))


def _estimate(n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretched estimate and the evidence class of bit counts."""
    n = n0 + n1
    st = np.clip(np.log((n1 + DELTA) / (n0 + DELTA)), -_LIMIT, _LIMIT)
    evidence = np.minimum(15, (2 * np.log2(n + 1)).astype(np.int64)) * 2 + (np.minimum(n0, n1) > 0)
    return st, np.where(n > 0, evidence, 0)


class Model:
    """Gate weights and probability map, beside the counts where one process holds them."""

    def __init__(self, counts: Counts | None = None):
        self.weights = np.full((len(ORDERS), EVIDENCE, len(ORDERS) + 1), 0.25, np.float32)
        centres = np.linspace(-_LIMIT, _LIMIT, _BUCKETS, dtype=np.float32)
        self.map = np.tile(_squash(centres), (256, 1)).astype(np.float32)
        self.counts = [counts] if counts else []

    @classmethod
    def frozen(cls, weights, probability_map, counts: list[Counts]) -> Model:
        """A model for scoring, from the parts of a trained one."""
        model = cls.__new__(cls)
        model.weights, model.map, model.counts = weights, probability_map, counts
        return model

    def _mix(self, estimates: np.ndarray, seen: np.ndarray, cells: np.ndarray):
        """Sum in the logistic domain; also the cells of the weights used."""
        cells = cells + (seen * _NUMBER).max(axis=0)        # by the longest order that knows the context
        total = np.einsum("ki,ki->i", self.weights.ravel()[cells], estimates)
        return np.clip(total, -_LIMIT, _LIMIT), cells

    def _refine(self, total: np.ndarray, node: np.ndarray):
        """The map's probability, between the two nearest centres."""
        x = (total + np.float32(_LIMIT)) * np.float32((_BUCKETS - 1) / (2 * _LIMIT))
        low = np.minimum(x.astype(np.int32), _BUCKETS - 2)
        part = (x - low).astype(np.float32)
        at = node * _BUCKETS + low
        flat = self.map.ravel()
        return flat[at] * (1 - part) + flat[at + 1] * part, at, part

    def bits(self, packed: np.ndarray) -> np.ndarray:
        """The cost in bits of each window's symbol."""
        out = np.empty(len(packed))
        order = np.argsort(packed.byteswap())          # windows of equal ends come together
        for first in range(0, len(packed), GATHER):
            block = order[first:first + GATHER]
            symbol, estimates, evidence = gather(packed[block], self.counts)
            for at in range(0, len(block), BLOCK):
                some = slice(at, at + BLOCK)
                out[block[some]] = self._bits(symbol[some], estimates[:, :, some], evidence[:, :, some])
        return out

    def _bits(self, symbol: np.ndarray, estimates: np.ndarray, evidence: np.ndarray) -> np.ndarray:
        probability = np.ones(len(symbol))
        for depth in range(8):
            node = (symbol | 256) >> (8 - depth)
            classes = evidence[:, depth].astype(np.int32)
            total, _ = self._mix(estimates[:, depth], classes > 0, (_FIRST_CELL + classes) * (len(ORDERS) + 1))
            refined, _, _ = self._refine(total, node)
            p1 = np.clip(0.5 * (_squash(total) + refined), 1e-5, 1 - 1e-5)
            probability *= np.where((symbol >> (7 - depth)) & 1, p1, 1 - p1)
        return -np.log2(probability)

    def learn(self, texts: list[np.ndarray], counts: Counts, per_text: int | None = None, seed: int = 1) -> None:
        """Steps over windows of training texts (all windows of a text in one array), each text's own bits left out."""
        rng = np.random.default_rng(seed)
        for windows_ in texts:
            own = Counts()
            own.add(windows_, np.ones(len(windows_), np.int64))
            self.steps(rng.permutation(windows_)[:per_text], None, [counts], (own,))

    def steps(self, packed: np.ndarray, often: np.ndarray | None, counts: list[Counts],
              without: tuple[Counts, ...], rate: float = 0.8, step: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Online steps over windows seen ``often`` times; returns how often each weight and map cell was met."""
        flat, m = self.weights.ravel(), self.map.ravel()
        met, met_map = np.zeros(len(flat)), np.zeros(len(m))
        often = np.ones(len(packed)) if often is None else often.astype(np.float64)
        for first in range(0, len(packed), GATHER):
            symbol, estimates, evidence = gather(packed[first:first + GATHER], counts, without)
            for at in range(0, len(symbol), step):
                lr = rate * (0.1 + 0.9 * (1 - (first + at) / len(packed)))
                some = slice(at, at + step)
                n = often[first + at:first + at + len(symbol[some])]
                for depth in range(8):
                    node, bit = (symbol[some] | 256) >> (8 - depth), (symbol[some] >> (7 - depth)) & 1
                    st, classes = estimates[:, depth, some], evidence[:, depth, some].astype(np.int32)
                    total, cells = self._mix(st, classes > 0, (_FIRST_CELL + classes) * (len(ORDERS) + 1))
                    error = (bit - _squash(total)) * n
                    gradient = np.bincount(cells.ravel(), (error * st).ravel(), len(flat))
                    weight = np.bincount(cells.ravel(), np.broadcast_to(n, cells.shape).ravel(), len(flat))
                    flat += (lr * 0.025 * gradient / (weight + 8.0) * np.minimum(weight, 8)).astype(np.float32)
                    met += weight
                    refined, low, part = self._refine(total, node)
                    for cell, share in ((low, (1 - part) * n), (low + 1, part * n)):
                        seen = np.bincount(cell, share, len(m))
                        hit = np.bincount(cell, share * bit, len(m))
                        m += ((hit - seen * m) * (0.02 / (1 + 0.02 * seen))).astype(np.float32)
                        met_map += seen
        return met, met_map
