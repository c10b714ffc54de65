"""Token pairs of a merge vocabulary, looked up and merged for many words at once."""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)      # the rank of a pair that doesn't merge
EDGE = (1 << 20) - 1            # stands beside the first and the last token of a word; merges with nothing


class PairRanks:
    """Ranks of pairs ``left << 20 | right``, in an open-addressed table of at most a quarter full."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        keys, ranks = np.asarray(keys, np.int64), np.asarray(ranks, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            slots, first = np.unique(at[free], return_index=True)
            self.keys[slots], self.ranks[slots] = keys[free[first]], ranks[free[first]]
            rest = self.keys[at] != keys
            keys, ranks, at = keys[rest], ranks[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 20) | right
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.ranks[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at_open = (at[open_] + 1) & self.mask
            at[open_] = at_open
            found = self.keys[at_open]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[at_open[hit]]
            open_ = open_[~hit & (found >= 0)]
        return out


def merge_words(symbols: np.ndarray, ranks: PairRanks, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All merges over the rows of ``symbols`` (one word each, -1 after its end).

    Every position keeps the rank of the pair that starts there.  A round takes
    each word's lowest rank (the leftmost of equal ones), merges there and looks
    up the two touched neighbours only, so each word sees its merges in rank
    order.  Returns the ids that stay, word after word, and their number per word.
    """
    n, width = symbols.shape
    size = n * width
    symbol = np.append(symbols.astype(np.int32).ravel(), EDGE)
    symbol[:size][symbol[:size] < 0] = EDGE
    inside = symbol[:size] != EDGE
    place = np.arange(size)
    column = place % width if width else place
    after = np.append(place + 1, size)
    after[:size][column == width - 1] = size
    after[:size][symbol[after[:size]] == EDGE] = size
    before = np.append(place - 1, size)
    before[:size][column == 0] = size
    rank = np.full(size + 1, NONE, np.int32)
    some = np.flatnonzero(inside & (after[:size] < size))
    rank[some] = ranks(symbol[some], symbol[after[some]])
    grid = rank[:size].reshape(n, width)
    rows = np.arange(n)
    while len(rows):
        part = grid if len(rows) == n else grid[rows]
        lowest = part.argmin(1)
        i = rows * width + lowest
        r = rank[i]
        more = r < NONE
        if not more.all():
            rows, i, r = rows[more], i[more], r[more]
            if not len(rows):
                break
        j, h = after[i], before[i]
        k = after[j]
        symbol[i], symbol[j] = made[r], EDGE
        rank[j] = NONE
        after[i], before[k] = k, i
        rank[i] = ranks(symbol[i], symbol[k])
        rank[h] = ranks(symbol[h], symbol[i])
        after[size] = before[size] = size
        symbol[size], rank[size] = EDGE, NONE
    stay = symbol[:size] != EDGE
    return symbol[:size][stay], stay.reshape(n, width).sum(1)


def width_classes(lengths: np.ndarray, longest: int):
    """``(width, indices)``: words by length, so that a grid of them holds few empty places."""
    low, width = 0, 4
    while low < longest:
        some = np.flatnonzero((lengths > low) & (lengths <= width))
        if len(some):
            yield width, some
        low, width = width, width * 2 if width < 8 else width + 8


def grid_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The bytes of words as rows of a grid, -1 after a word's end."""
    column = np.arange(width)
    inside = column < lengths[:, None]
    return np.where(inside, data[np.where(inside, starts[:, None] + column, 0)].astype(np.int32), -1)
