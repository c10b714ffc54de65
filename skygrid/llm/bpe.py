"""Byte-level BPE encoding and decoding by merge replay over each batch's distinct pieces.

All distinct pieces of a batch of texts (the matches of the split pattern)
are laid out as one sequence of byte tokens with links to their neighbours.
An inverted index holds, for every merge that applies somewhere, the
positions where its pair stands; the merges are replayed in rank order, each
at all its positions at once, and every merge updates the index for the two
touched neighbours only.  A piece's ids are then reused for all its
occurrences in the task.

Pieces of up to LONGEST bytes, nearly all there are, keep that index as arrays:
the rank at every position, searched for the lowest of each piece and updated
for all pieces at once.  As pieces don't touch each other, each meets its merges
in the same order as by the lists of positions, which longer pieces use.

Cases
-----
* null text: like an empty one, no ids, decoded to no bytes;
* texts of any length are split and encoded whole, one piece of any length too;
* repeated rows: each row is encoded; empty table: empty result;
* strings of special tokens in a text are ordinary text;
* decoding: null ids give null; an id outside the vocabulary or a null id
  makes the row's bytes null;
* other columns are ignored by the encoder and decoder.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import map_batches, row_slices, text_slices
from skygrid.llm.pairs import PairRanks, grid_of, merge_words, width_classes

SLICE_BYTES = 2 << 20
SLICE_IDS = 1 << 18           # ids decoded together
# Distinct pieces laid out together, and kept encoded between batches.
REPLAY_PIECES = 50_000
KEPT_PIECES = 300_000
GRID_PLACES = 1 << 17         # bytes of pieces merged together
LONGEST = 32


class Vocabulary:
    """Ranks (token bytes to id) of a rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.size = max(self.ranks.values()) + 1
        self.tokens: list = [None] * self.size
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]

    # A worker that only encodes or only decodes makes only the tables it uses.

    @cached_property
    def words(self) -> list[str]:
        return [str(i) for i in range(self.size)]

    @cached_property
    def array(self) -> pa.Array:
        return pa.array(self.tokens, pa.binary())

    @cached_property
    def merges(self) -> dict[int, int]:
        """Every mergeable pair (left << 20 | right) and the token it gives."""
        pairs = {}
        for token, i in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = i
        return pairs

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array(self.bytes)

    @cached_property
    def byte_pairs(self) -> np.ndarray:
        """The token that two single bytes merge to; -1 where nothing merges."""
        return np.array([[self.merges.get(a << 20 | b, -1) for b in self.bytes] for a in self.bytes])

    @cached_property
    def pair_ranks(self) -> PairRanks:
        return PairRanks(np.fromiter(self.merges, np.int64, len(self.merges)),
                         np.fromiter(self.merges.values(), np.int32, len(self.merges)))

    @cached_property
    def made(self) -> np.ndarray:
        """The token a merge of some rank gives: the rank itself."""
        return np.arange(self.size, dtype=np.int32)


def replay(vocab: Vocabulary, pieces: list[bytes]) -> list[tuple[int, ...]]:
    """The ids of every piece: all merges over all pieces, in rank order."""
    return [tuple(np.frombuffer(ids, np.int32).tolist()) for ids in replay_packed(vocab, pieces)]


def replay_packed(vocab: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """The same, a piece's ids as 32-bit numbers in one string."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data, starts = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(lengths) - lengths
    symbols = vocab.byte_ids[data].astype(np.int32)
    out = [b""] * len(pieces)
    for width, whole in width_classes(lengths, LONGEST):
        rows = GRID_PLACES // width
        for some in (whole[i:i + rows] for i in range(0, len(whole), rows)):
            ids, sizes = merge_words(grid_of(symbols, starts[some], lengths[some], width), vocab.pair_ranks, vocab.made)
            flat, at = ids.astype(np.int32).tobytes(), 0
            for i, n in zip(some.tolist(), (4 * sizes).tolist(), strict=True):
                out[i] = flat[at:at + n]
                at += n
    long = np.flatnonzero(lengths > LONGEST).tolist()
    for i, ids in zip(long, replay_listed(vocab, [pieces[i] for i in long]), strict=True):
        out[i] = np.array(ids, np.int32).tobytes()
    return out


def replay_listed(vocab: Vocabulary, pieces: list[bytes]) -> list[tuple[int, ...]]:
    """The same by lists of positions, in time near linear for pieces of any length."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    symbol = vocab.byte_ids[data].tolist()
    lengths = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(lengths)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends[lengths > 0] - 1] = -1       # no links between pieces
    before[(ends - lengths)[lengths > 0]] = -1
    # Inverted index: merged token -> positions of its pair, in order.
    first = vocab.byte_pairs[data[:-1], data[1:]] if n else np.empty(0, np.int64)
    at = np.flatnonzero((first >= 0) & (after[:-1] >= 0)) if n else first
    at = at[np.argsort(first[at], kind="stable")]
    found, starts = np.unique(first[at], return_index=True)
    where: dict[int, list[int]] = dict(zip(found.tolist(), map(np.ndarray.tolist, np.split(at, starts[1:])), strict=True)) \
        if len(found) else {}
    after, before = after.tolist(), before.tolist()
    merged = vocab.merges.get
    ranks = list(where)
    heapq.heapify(ranks)
    while ranks:
        rank = heapq.heappop(ranks)
        places = where.pop(rank, None)
        if places is None:
            continue
        places.sort()
        for at, i in enumerate(places):
            s = symbol[i]
            j = after[i]
            if s < 0 or j < 0 or merged(s << 20 | symbol[j]) != rank:
                continue        # a neighbouring merge took one of the two
            k, h = after[j], before[i]
            symbol[i], symbol[j] = rank, -1
            after[i] = k
            lower = False
            if k >= 0:
                before[k] = i
                r = merged(rank << 20 | symbol[k])
                if r is not None:
                    if r not in where:
                        where[r] = []
                        heapq.heappush(ranks, r)
                    where[r].append(i)
                    lower = r < rank
            if h >= 0:
                r = merged(symbol[h] << 20 | rank)
                if r is not None:
                    if r not in where:
                        where[r] = []
                        heapq.heappush(ranks, r)
                    where[r].append(h)
                    lower = lower or r < rank
            if lower and at + 1 < len(places):
                # The new pair comes first by rank; this merge goes on after it.
                if rank not in where:
                    where[rank] = []
                    heapq.heappush(ranks, rank)
                where[rank] += places[at + 1:]
                break
    out, start = [], 0
    for p in pieces:
        out.append(tuple([s for s in symbol[start:start + len(p)] if s >= 0]))
        start += len(p)
    return out


class Encoder:
    """Encodes batches of texts, keeping the pieces it knows."""

    def __init__(self, path: str, pattern: str):
        self.vocab, self.split = Vocabulary(path), regex.compile(pattern)
        self.known: dict[str, bytes] = {}   # ids as 32-bit numbers: a third of the memory of tuples
        self.often: set[str] = set()        # pieces met in more than one batch

    def learn(self, texts: list[str]) -> list[list[str]]:
        """The pieces of every text, all of them known afterwards."""
        pieces = [self.split.findall(t) for t in texts]
        distinct = set().union(*pieces) if pieces else set()
        new = [p for p in distinct if p not in self.known]
        self.often.update(distinct.difference(new))
        if len(self.known) + len(new) > KEPT_PIECES:
            stay = self.often if len(self.often) < KEPT_PIECES // 2 else distinct
            self.known = {p: self.known[p] for p in stay if p in self.known}
            self.often = set()
        for at in range(0, len(new), REPLAY_PIECES):
            some = new[at:at + REPLAY_PIECES]
            self.known.update(zip(some, replay_packed(self.vocab, [p.encode() for p in some]), strict=True))
        return pieces

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as 32-bit numbers in one string."""
        pieces = self.learn(texts)
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in pieces]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, np.int32).tolist() for ids in self.encode_packed(texts)]

    def round_trip(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """Per text: the number of ids, the ids as decimal text, and the bytes they decode to."""
        words, tokens = self.vocab.words, self.vocab.tokens
        return [(len(ids), " ".join([words[i] for i in ids]), b"".join([tokens[i] for i in ids]))
                for ids in self.encode(texts)]

    def decode(self, flat: pa.Array) -> pa.Array:
        """The token bytes of ids; null for a null id or one outside the vocabulary."""
        ids = pa.array(flat, pa.int64())
        ok = np.asarray(ids.fill_null(-1))
        ids = pa.array(ok, mask=(ok < 0) | (ok >= self.vocab.size))
        return self.vocab.array.take(ids)


_encoders: dict[tuple[str, str], Encoder] = {}      # one per worker process


def _encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def _joined(tokens: pa.Array, offsets: np.ndarray) -> list[bytes | None]:
    """The concatenated tokens of every row; None where one is null."""
    data = tokens.buffers()[2]
    ends = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset:tokens.offset + len(tokens) + 1]
    nulls = np.concatenate(([0], np.cumsum(np.asarray(tokens.is_null()))))
    raw = memoryview(data) if data is not None else memoryview(b"")
    return [None if nulls[b] > nulls[a] else bytes(raw[ends[a]:ends[b]])
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _ids_schema(keyed: DataFrame, n: int) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:n])


def encode(docs: DataFrame, path: str, pattern: str, id_cols: list[Column], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus ``ids array<int>`` per row."""
    keyed = docs.select(*id_cols, F.col(text_col).alias("__text"))
    n = len(id_cols)

    def run(batch: pa.RecordBatch):
        encoder = _encoder(path, pattern)
        for part in text_slices(batch, n, SLICE_BYTES):
            ids = encoder.encode_packed([t or "" for t in part.column(n).to_pylist()])
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(n)] + [pa.ListArray.from_arrays(pa.array(ends), flat)],
                names=[*batch.schema.names[:n], "ids"])

    return map_batches(keyed, run, _ids_schema(keyed, n) + ", ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, id_cols: list[Column], ids_col: str = "ids") -> DataFrame:
    """``id_cols`` plus ``bytes binary`` per row of token ids."""
    keyed = encoded.select(*id_cols, F.col(ids_col).cast("array<int>").alias("__ids"))
    n = len(id_cols)

    def run(batch: pa.RecordBatch):
        lengths = pc.list_value_length(batch.column(n)).fill_null(0).to_pylist()
        for part in row_slices(batch, lengths, SLICE_IDS):
            column = part.column(n)
            tokens = _encoder(path, pattern).decode(column.flatten())
            sizes = np.asarray(pc.list_value_length(column).fill_null(0))
            rows = _joined(tokens, np.concatenate(([0], np.cumsum(sizes))))
            null = column.is_null().to_pylist()
            out = pa.array([None if gone else r for gone, r in zip(null, rows, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n)] + [out],
                                             names=[*batch.schema.names[:n], "bytes"])

    return map_batches(keyed, run, _ids_schema(keyed, n) + ", bytes binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_cols: list[Column],
                       text_col: str = "text") -> DataFrame:
    """``id_cols`` plus ``n_tokens, ids_sha256, decoded_sha256``.

    Each slice of texts is encoded and its ids decoded again in one task, so
    that the ids needn't leave the worker for their digests.
    """
    keyed = docs.select(*id_cols, F.col(text_col).alias("__text"))
    n = len(id_cols)

    def run(batch: pa.RecordBatch):
        encoder = _encoder(path, pattern)
        for part in text_slices(batch, n, SLICE_BYTES):
            rows = encoder.round_trip([t or "" for t in part.column(n).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(n)]
                + [pa.array([k for k, _, _ in rows], pa.int64()),
                   pa.array([hashlib.sha256(said.encode()).hexdigest() for _, said, _ in rows], pa.string()),
                   pa.array([hashlib.sha256(raw).hexdigest() for _, _, raw in rows], pa.string())],
                names=[*batch.schema.names[:n], "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(keyed, run, _ids_schema(keyed, n)
                       + ", n_tokens long, ids_sha256 string, decoded_sha256 string")
