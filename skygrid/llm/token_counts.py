"""Exact token counts at every prefix of a text, by prefix dynamic programming.

For a byte-level BPE a sequence of tokens is *the* encoding of its bytes if
and only if every two neighbours are: their bytes together encode to the two.
So the encoding of a prefix ends in the one token ``t`` that is compatible
with the last token of the prefix before ``t``, and

    count[prefix] = count[prefix without t] + 1.

The recurrence runs over the bytes of each distinct piece (match of the split
pattern), for all new pieces of a batch at once; a text's table is the running
total over its pieces.  The total,
whether a limit is passed, and where a budget of tokens runs out are read off
the table; nothing is encoded again.

A prefix that ends in white space or within a contraction splits differently
from the whole text; its last piece is then looked up as the piece it would be.

Cases
-----
* null text: like an empty one, 0 bytes and 0 tokens;
* texts and pieces of any length are counted whole;
* strings of special tokens inside a text count as one token each, as the
  library does by default; a prefix that ends inside such a string counts it
  as ordinary text;
* repeated rows: each row is counted; empty table: empty result;
* other columns are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import cached_property
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import map_batches, text_slices
from skygrid.llm.pairs import NONE, PairRanks, grid_of, width_classes

SLICE_BYTES = 2 << 20
KEPT_PIECES = 500_000
LONGEST = 32        # bytes of pieces whose tables are made together
TABLED_PIECES = 50_000

# The split pattern of byte-level BPE tokenizer files, and the
# code points that newer Unicode versions class as letters or numbers but the
# tokenizer library's tables don't.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNCLASSED = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F))


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a tokenizer file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """Vocabulary, merges and special strings of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        as_bytes = lambda s: bytes(alphabet[c] for c in s)
        special = {t["content"]: t for t in spec["added_tokens"] if t["special"]}
        self.ids = {as_bytes(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.token = {i: s for s, i in self.ids.items()}
        # Tokens by their bytes, and what a token goes on from (-1).
        self.walk = dict.fromkeys((s[:i] for s in self.ids for i in range(1, len(s))), -1) | self.ids
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for n, (a, b) in enumerate(spec["model"]["merges"]):
            left, right = as_bytes(a), as_bytes(b)
            self.rank[self.ids[left], self.ids[right]] = (n, self.ids[left + right])
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))
                                     or r"(?!)")
        self._fits: dict[int, bool] = {}
        self.split = regex.compile(SPLIT)
        odd = "".join(f"{chr(a)}-{chr(b)}" for a, b in UNCLASSED)
        self.odd = regex.compile(f"[{odd}]")
        self.split_odd = regex.compile(SPLIT.replace(r"\p{L}+", rf"[\p{{L}}--[{odd}]]+")
                                       .replace(r"\p{N}+", rf"[\p{{N}}--[{odd}]]+")
                                       .replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{odd}]]"),
                                       regex.V1)

    def _encode(self, data: bytes) -> list[int]:
        """Plain pairwise merging; only for the few bytes of two tokens."""
        ids = [self.ids[data[i:i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            found = min(((self.rank[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False))
                         if p in self.rank), default=None)
            if found is None:
                break
            (_, merged), i = found
            ids[i:i + 2] = [merged]
        return ids

    def fits(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens together encode to the two (a < 0: to the second alone)."""
        key = (a + 1) << 20 | b
        ok = self._fits.get(key)
        if ok is None:
            if len(self._fits) >= 3_000_000:
                self._fits.clear()
            want = [b] if a < 0 else [a, b]
            ok = self._fits[key] = self._encode(b"".join(self.token[t] for t in want)) == want
        return ok

    def prefix_counts(self, piece: bytes) -> list[int]:
        """``count[i]``: the tokens of the first ``i`` bytes of a piece."""
        walk, fits = self.walk.get, self._fits
        n = len(piece)
        # Tokens by end, longest first: starts in order, as far as some token goes on.
        ending: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for start in range(n):
            for end in range(start + 1, n + 1):
                t = walk(piece[start:end])
                if t is None:
                    break
                if t >= 0:
                    ending[end].append((start, t))
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            for start, t in ending[end]:
                before = last[start]
                ok = fits.get((before + 1) << 20 | t)
                if ok is None:
                    ok = self.fits(before, t)
                if ok:
                    last[end], count[end] = t, count[start] + 1
                    break
        return count

    @cached_property
    def columns(self) -> Columns | None:
        """The tables of many pieces at once; None where a token has several merges."""
        made = [t for _, t in self.rank.values()]
        return Columns(self) if len(set(made)) == len(made) else None

    def pieces(self, text: str) -> list[str]:
        """The matches of the split pattern in a text without special strings."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.odd.search(text):
                return self.split_odd.findall(text)
        return self.split.findall(text)


class Columns:
    """The recurrence over many pieces at once, on arrays.

    Whether two tokens are the encoding of their bytes is told by undoing their
    merges, the later first: at no time may the two tokens at the border have had
    a merge that came before the one undone.
    """

    def __init__(self, t: Tokenizer):
        size = max(t.ids.values()) + 1
        self.rank = np.full(size, -1, np.int32)
        self.left, self.right = np.zeros(size, np.int32), np.zeros(size, np.int32)
        pairs, ranks = [], []
        for (a, b), (n, made) in t.rank.items():
            self.rank[made], self.left[made], self.right[made] = n, a, b
            pairs.append(a << 20 | b)
            ranks.append(n)
        self.pair_ranks = PairRanks(np.array(pairs, np.int64), np.array(ranks, np.int32))
        # Tokens that their own bytes encode to.
        self.own = self.rank >= 0
        for s, i in t.ids.items():
            if len(s) == 1:
                self.own[i] = True
        merged = np.flatnonzero(self.rank >= 0)
        a, b = self.left[merged], self.right[merged]
        fit = self.fits(a, b, self.rank[merged])
        while True:
            own = fit & self.own[a] & self.own[b]
            if (own == self.own[merged]).all():
                break
            self.own[merged] = own
        # Nodes of the tree of tokens; the inner ones, from 0 (the root), have a row of children.
        inner = {s for s in (key[:-1] for key in t.walk) if s}
        node = {b"": 0} | {s: i for i, s in enumerate(inner, 1)}
        for s in t.walk:
            node.setdefault(s, len(node))
        self.inner = len(inner) + 1
        self.child = np.full((self.inner, 256), -1, np.int32)
        self.token = np.full(len(node), -1, np.int32)
        for s, i in t.walk.items():
            self.child[node[s[:-1]], s[-1]] = node[s]
            self.token[node[s]] = i

    def fits(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether two tokens, each its own encoding, stay apart (until the merge ``limit``)."""
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        if limit is None:
            limit = np.full(len(a), NONE, np.int32)
        while len(at):
            apart = self.pair_ranks(a, b) >= limit
            ok[at[~apart]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = apart & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
            undo_left = ra > rb
            limit = np.where(undo_left, ra, rb + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return ok

    def counts(self, grid: np.ndarray) -> np.ndarray:
        """``count[row, i]``: the tokens of the first ``i`` bytes of each row (-1 after its end)."""
        n, width = grid.shape
        # Every token inside a piece: row, start, end.
        row, start = (x.astype(np.int32) for x in np.nonzero(grid >= 0))
        node, end = np.zeros(len(row), np.int32), start.copy()
        found = []
        while len(row):
            byte = grid[row, end]
            node = self.child[node, byte]
            end = end + 1
            token = np.where(node >= 0, self.token[node], -1)
            some = np.flatnonzero(token >= 0)
            some = some[self.own[token[some]]]
            found.append((row[some], start[some], end[some], token[some]))
            on = (node >= 0) & (node < self.inner) & (end < width)
            on[on] = grid[row[on], end[on]] >= 0
            row, start, end, node = row[on], start[on], end[on], node[on]
        row, start, end, token = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, row, end))
        row, start, token = row[order], start[order], token[order]
        cuts = np.searchsorted(end[order], np.arange(1, width + 2))
        last, count = np.full((n, width + 1), -1, np.int32), np.zeros((n, width + 1), np.int32)
        for e in range(1, width + 1):
            part = slice(cuts[e - 1], cuts[e])
            r, s, t = row[part], start[part], token[part]
            before = last[r, s]
            ok = s == 0
            inside = np.flatnonzero((s > 0) & (before >= 0))
            ok[inside] = self.fits(before[inside], t[inside])
            r, s, t = r[ok], s[ok], t[ok]
            r, first = np.unique(r, return_index=True)      # the longest token first
            last[r, e], count[r, e] = t[first], count[r, s[first]] + 1
        return count

    def tables(self, pieces: list[str]) -> list[tuple[int, ...] | None]:
        """The counts at the character borders of each piece; None for a piece above LONGEST bytes."""
        encoded = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        data, starts = np.frombuffer(b"".join(encoded), np.uint8), np.cumsum(lengths) - lengths
        out: list[tuple[int, ...] | None] = [None] * len(pieces)
        for width, some in width_classes(lengths, LONGEST):
            grid = grid_of(data, starts[some], lengths[some], width)
            border = np.ones((len(some), width + 1), bool)
            border[:, :width] = (grid >= 0) & ((grid & 0xC0) != 0x80)
            border[:, width] = False
            border[np.arange(len(some)), lengths[some]] = True
            flat, at = self.counts(grid)[border].tolist(), 0
            for i, k in zip(some.tolist(), border.sum(1).tolist(), strict=True):
                out[i] = tuple(flat[at:at + k])
                at += k
        return out


_CONTRACTION = regex.compile(r"'(re|ve|ll)")


class Counter:
    """Prefix tables of texts, keeping the tables of pieces it knows."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer(path)
        self.known: dict[str, tuple[int, ...]] = {}     # by piece: count at each character border
        self.totals: dict[str, int] = {}                # and its last entry

    def _table(self, piece: str) -> tuple[int, ...]:
        table = self.known.get(piece)
        if table is None:
            if len(self.known) >= KEPT_PIECES:
                self.known.clear()
                self.totals.clear()
            count = self.tokenizer.prefix_counts(piece.encode())
            if len(count) > len(piece) + 1:      # keep the borders of characters
                ends = accumulate((1 + (c > "\x7f") + (c > "\u07ff") + (c > "\uffff") for c in piece), initial=0)
                count = [count[e] for e in ends]
            table = self.known[piece] = tuple(count)
            self.totals[piece] = table[-1]
        return table

    def learn(self, pieces: set[str]) -> None:
        """Make the tables of the new ones among some pieces together."""
        columns = self.tokenizer.columns
        if columns is None:
            return
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > KEPT_PIECES:
            self.known.clear()
            self.totals.clear()
            new = list(pieces)
        for at in range(0, len(new), TABLED_PIECES):
            some = new[at:at + TABLED_PIECES]
            for piece, table in zip(some, columns.tables(some), strict=True):
                if table is not None:
                    self.known[piece] = table
                    self.totals[piece] = table[-1]

    def _parts(self, text: str):
        """``(piece, is a special string)`` in order."""
        at = 0
        for m in self.tokenizer.special.finditer(text):
            yield from ((p, False) for p in self.tokenizer.pieces(text[at:m.start()]))
            yield m.group(), True
            at = m.end()
        yield from ((p, False) for p in self.tokenizer.pieces(text[at:] if at else text))

    def _counted(self, text: str) -> tuple[list[tuple[str, bool]], list[int]]:
        parts = list(self._parts(text))
        return parts, [1 if special else self._table(p)[-1] for p, special in parts]

    def total(self, text: str) -> int:
        """The tokens of the whole text."""
        return sum(self._counted(text)[1])

    def _plain(self, pieces: list[str]) -> list[int]:
        """The tokens of each piece."""
        try:
            return list(map(self.totals.__getitem__, pieces))
        except KeyError:        # some are new
            found = {p: self._table(p)[-1] for p in set(pieces)}
            return list(map(found.__getitem__, pieces))

    def measure_all(self, texts: list[str], limit: int) -> list[tuple[int, int]]:
        """``measure`` of many texts, whose new pieces are tabled together."""
        special = self.tokenizer.special.search
        pieces = [None if special(t) else self.tokenizer.pieces(t) for t in texts]
        self.learn(set().union(*(p for p in pieces if p)))
        return [self.measure(t, limit, p) for t, p in zip(texts, pieces, strict=True)]

    def measure(self, text: str, limit: int, pieces: list[str] | None = None) -> tuple[int, int]:
        """The tokens of the whole text, and the characters of its longest prefix within ``limit``.

        ``pieces`` are those of a text without special strings, where they are known.
        """
        if pieces is None:
            parts, counts = self._counted(text)
        else:
            parts, counts = pieces, self._plain(pieces)
        n = sum(counts)
        if n <= limit:
            return n, len(text)
        passed = next(i for i, c in enumerate(accumulate(counts)) if c > limit)
        parts = [p if isinstance(p, tuple) else (p, False) for p in parts[:passed + 4]]
        return n, Prefixes(self, text, parts, counts[:passed + 4]).fit(limit)

    def prefixes(self, text: str) -> Prefixes:
        return Prefixes(self, text, *self._counted(text))


class Prefixes:
    """The table of one text (or its first parts): token counts at every character border."""

    def __init__(self, counter: Counter, text: str, parts: list[tuple[str, bool]], counts: list[int]):
        self.counter, self.text, self.parts = counter, text, parts
        self.starts = list(accumulate((len(p) for p, _ in parts), initial=0))
        self.before = list(accumulate(counts, initial=0))

    def count(self, chars: int) -> int:
        """The tokens of the first ``chars`` characters."""
        k = bisect_right(self.starts, chars) - 1
        if chars == self.starts[k] and k == len(self.parts):
            return self.before[k]
        run = chars     # the white space the prefix ends in is one piece
        floor = self.starts[max((i for i in range(max(0, k - 2), k + 1)
                                 if i < len(self.parts) and self.parts[i][1]), default=0)]
        while run > floor and self.text[run - 1].isspace() and self.counter.tokenizer.split.fullmatch(
                self.text[run - 1]):
            run -= 1
        if run < chars:
            first = bisect_right(self.starts, run) - 1
            if self.starts[first] == run:
                return self.before[first] + self.counter._table(self.text[run:chars])[-1]
        if chars == self.starts[k]:
            return self.before[k]
        piece, special = self.parts[k]
        cut = piece[:chars - self.starts[k]]
        if special:     # its first characters join the piece before it
            if k and not self.parts[k - 1][1]:
                return self.before[k - 1] + self.counter.total(self.text[self.starts[k - 1]:chars])
            return self.before[k] + self.counter.total(cut)
        if _CONTRACTION.fullmatch(piece):
            return self.before[k] + self.counter.total(cut)
        return self.before[k] + self.counter._table(piece)[len(cut)]

    def fit(self, limit: int) -> int:
        """The characters of the longest prefix of at most ``limit`` tokens."""
        if self.before[-1] <= limit:
            return self.starts[-1]
        k = bisect_right(self.before, limit)        # pieces up to here may still fit
        chars = self.starts[min(k + 1, len(self.parts))]
        while chars and self.count(chars) > limit:
            chars -= 1
        return chars


_counters: dict[str, Counter] = {}      # one per worker process


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, id_cols: list[Column], text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """``id_cols`` plus ``n_bytes, n_tokens, over_limit, fit_chars`` per row.

    ``fit_chars`` is the length of the longest prefix within the limit.
    """
    keyed = docs.select(*id_cols, F.col(text_col).alias("__text"))
    n = len(id_cols)
    ids = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:n])

    def run(batch: pa.RecordBatch):
        c = counter(path)
        for part in text_slices(batch, n, SLICE_BYTES):
            texts = [t or "" for t in part.column(n).to_pylist()]
            measured = c.measure_all(texts, limit)
            totals, fit = [m for m, _ in measured], [f for _, f in measured]
            sizes = pc.binary_length(part.column(n)).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(n)]
                + [sizes, pa.array(totals, pa.int64()), pa.array([m > limit for m in totals], pa.bool_()),
                   pa.array(fit, pa.int64())],
                names=[*batch.schema.names[:n], "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return map_batches(keyed, run, ids + ", n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def prefix_tables(docs: DataFrame, path: str, id_cols: list[Column], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus ``counts array<int>``: the tokens of every prefix, by characters (0 first)."""
    keyed = docs.select(*id_cols, F.col(text_col).alias("__text"))
    n = len(id_cols)
    ids = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:n])

    def run(batch: pa.RecordBatch):
        c = counter(path)
        for part in text_slices(batch, n, SLICE_BYTES):
            rows = []
            for t in part.column(n).to_pylist():
                table = c.prefixes(t or "")
                rows.append([table.count(i) for i in range(len(t or "") + 1)])
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(n)] + [pa.array(rows, pa.list_(pa.int32()))],
                names=[*batch.schema.names[:n], "counts"])

    return map_batches(keyed, run, ids + ", counts array<int>")
