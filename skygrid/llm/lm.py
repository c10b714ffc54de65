"""Language-model scoring: context mixing over bytes, beside a word baseline.

The texts are cut into slices.  A slice hands on its distinct seven-byte windows,
dealt to parts by the three bytes before the symbol, with how often each stands
in the training texts, and its distinct words in the same way (64-bit hashes).
One shuffle brings a part together: it then has all counts of its contexts of
three and more bytes, and the places of the slices' windows among its own.  The
number of parts grows with the bytes of the texts.  Contexts of one and two
bytes, at most 2^24 triples a fold whatever the corpus, are broadcast.

Gate weights are learned from all training windows: texts are dealt to folds by a
hash (copies to the same), and a fold's windows are evaluated by the counts of the
others; each part returns its weights and how often it met their cells, which are
averaged.  Then each part gives the bits of the windows and the counts of the words
that a slice asked for, and the slice, joined with its texts again, adds them up.
Bits travel with 16 binary digits after the leading one.

Cases
-----
* null text: like an empty one, its one token is the end;
* texts of any length are scored whole;
* repeated rows: each is scored, and each counts in learning;
* a null id belongs to the training texts;
* no training texts: all counts are 0; empty table: empty result;
* other columns are ignored.
"""

from __future__ import annotations

import secrets
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm import mixing
from skygrid.llm.common import bound_batches, cut_lineage, text_slices

FOLDS = 4
PART_BYTES = 16 << 20         # bytes of text for each part of the windows
SLICE_BYTES = 16 << 20
CHUNK = 3 << 20
HELD_WINDOWS = 6 << 20        # windows of a slice that are sorted together
SUM_GROUPS = 16               # rows of learned weights that reach the driver
WINDOWS, WORDS, TEXTS = 0, 1, 2
_P = 0xD1342543DE82EF95
_ROW = "kind int, part int, own long, slice long, n int, data binary"


def _texts(column: pa.Array) -> list[bytes]:
    return column.fill_null("").cast(pa.binary()).to_pylist()


def _planes(numbers: np.ndarray) -> bytes:
    """Compressed unsigned numbers, byte plane by byte plane, in as few bytes as the largest needs."""
    top = int(numbers.max(initial=0))
    size = next(s for s in (1, 2, 4, 8) if top < 1 << 8 * s)
    raw = np.ascontiguousarray(numbers).ravel().astype(f"u{size}").view(np.uint8).reshape(-1, size).T
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(raw.tobytes())


def _from_planes(blob: bytes, n: int) -> np.ndarray:
    size = blob[0]
    if not n:
        return np.zeros(0, f"u{size}")
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(f"u{size}").ravel()


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted values as compressed differences, and their counts (one line or several)."""
    steps = _planes(np.diff(values, prepend=np.uint64(0)))
    return struct.pack("<II", len(steps), counts.size // max(1, len(values))) + steps + _planes(counts)


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    size, lines = struct.unpack_from("<II", blob)
    values = np.cumsum(_from_planes(blob[8:8 + size], n), dtype=np.uint64)
    counts = _from_planes(blob[8 + size:], n * lines)
    return values, counts if lines == 1 else counts.reshape(lines, n)


def _merged(held: list) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of several lists, in order, and the sums of their counts."""
    wide = sum(int(n.max(initial=0)) for _, n in held) >= 1 << 32
    values = np.concatenate([v for v, _ in held])
    counts = np.concatenate([n.astype(np.uint64 if wide else np.uint32) for _, n in held], axis=-1)
    order = np.argsort(values)
    values = values[order]
    first = np.flatnonzero(np.diff(values, prepend=~values[:1]))
    if not len(first):
        return values, counts
    return values[first], np.add.reduceat(counts[..., order], first, axis=-1)


def _dealt(values: np.ndarray, parts: int, words: bool = False):
    """``(order, [(part, start, end)])``: windows by the three bytes before the symbol, hashes of words by themselves."""
    if not len(values):
        return np.zeros(0, np.int64), []
    h = values if words else ((values >> np.uint64(8)) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    if parts <= 1 << 16:
        part = part.astype(np.uint16)           # sorted by radix
    order = np.argsort(part, kind="stable")
    part = part[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    return order, list(zip(part[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=True))


def _rounded(bits: np.ndarray) -> bytes:
    """Bits as floats with 16 binary digits after the leading one."""
    raw = np.ascontiguousarray(bits, np.float32).view(np.uint32)
    planes = ((raw + np.uint32(128)) >> np.uint32(8)).view(np.uint8).reshape(-1, 4).T[:3]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _from_rounded(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(3, -1)
    raw = np.zeros((planes.shape[1], 4), np.uint8)
    raw[:, 1:] = planes.T
    return raw.view(np.float32).ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit word for each word, every bit of it depending on all of the other's."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words:
    """64-bit hashes of the words of many texts at once.

    A byte and its place in the word are mixed into 64 bits, and a word's hash is
    mixed from their sum: no algebra of its letters makes two words equal.
    """

    def __init__(self):
        space = np.zeros(256, bool)
        space[[0x20, *range(0x09, 0x0E)]] = True
        self.space = space

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(hash, text number)`` of every word, in order."""
        data = np.frombuffer(b"\n".join(texts).translate(mixing._LOWER), np.uint8)
        word = np.zeros(len(data) + 2, np.int8)
        word[1:-1] = ~self.space[data]
        edges = np.flatnonzero(np.diff(word))
        starts, ends = edges[::2], edges[1::2]
        letters = np.flatnonzero(word[1:-1])
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        place = (np.arange(len(letters)) - np.repeat(first, lengths)).astype(np.uint64)
        sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(_mixed((place << np.uint64(8) | data[letters]) * np.uint64(_P) + np.uint64(1)), out=sums[1:])
        h = _mixed(sums[first + lengths] - sums[first])
        limits = np.cumsum([len(t) + 1 for t in texts])
        return h, np.searchsorted(limits, starts, side="right")


def _chunks(texts: list[bytes], size: int):
    """Row ranges of about ``size`` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def _runs(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of some arrays, in order, and how often each is there."""
    keys = np.concatenate(keys)
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[first], np.diff(first, append=len(keys)).astype(np.uint32)


def _slice_windows(texts: list[bytes], fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct windows of a slice, in order, and how often each stands in each fold."""
    held, keys, size = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32))], [], 0
    fold = fold.astype(np.uint8)
    for packed, owner in mixing.windows(texts, CHUNK):
        # A window leaves 8 bits of a word free: its fold travels there.
        packed <<= np.uint64(8)
        packed |= fold[owner]
        keys.append(packed)
        size += len(packed)
        if size >= HELD_WINDOWS:
            held.append(_runs(keys))
            keys, size = [], 0
            if sum(len(v) for v, _ in held) >= HELD_WINDOWS:
                held = [_merged(held)]
    if keys:
        held.append(_runs(keys))
    keys, n = _merged(held) if len(held) > 2 else held[-1]
    fold = (keys & np.uint64(255)).astype(np.intp)
    keys >>= np.uint64(8)
    new = np.diff(keys, prepend=~keys[:1]) != 0
    counts = np.zeros((FOLDS + 1, np.count_nonzero(new)), np.uint32)
    counts[fold, np.cumsum(new) - 1] = n
    return keys[new], counts[:FOLDS]


def _window_costs(texts: list[bytes], cost_of) -> np.ndarray:
    """For each text the sum of its windows' costs; ``cost_of(distinct windows in order)`` gives theirs.

    The windows are read once: of each chunk its distinct windows are kept, and
    the place of every window among them.  Texts of more than two slices' bytes,
    one long text for instance, are read twice, in memory for a chunk.
    """
    n = len(texts)
    bits = np.zeros(n)
    if sum(map(len, texts)) + n > 2 * SLICE_BYTES:
        values, _ = _slice_windows(texts, np.zeros(n, np.uint8))
        cost = cost_of(values)
        for packed, owner in mixing.windows(texts, CHUNK):
            some, index = mixing.distinct(packed)
            bits += np.bincount(owner, cost[np.searchsorted(values, some)][index], n)
        return bits
    held, chunks = [np.zeros(0, np.uint64)], []
    for packed, owner in mixing.windows(texts, CHUNK):
        some, index = mixing.distinct(packed)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        chunks.append((index, owner[first], np.diff(first, append=len(owner))))
        held.append(some)
    values, back = np.unique(np.concatenate(held), return_inverse=True)
    cost, at = cost_of(values)[back], 0
    for (index, owner, often), some in zip(chunks, held[1:], strict=True):
        bits += np.bincount(np.repeat(owner, often), cost[at:at + len(some)][index], n)
        at += len(some)
    return bits


def _slice_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(distinct hashes in order, index of each word among them, text number of each word)``."""
    hasher, hashes, owners = _Words(), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in _chunks(texts, CHUNK):
        h, owner = hasher.hashes(texts[a:b])
        hashes.append(h), owners.append(owner + a)
    values, index = np.unique(np.concatenate(hashes), return_inverse=True)
    return values, index, np.concatenate(owners)


def _parts_for(texts: DataFrame, text_col: str) -> int:
    size = texts.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return max(1, min(1 << 24, -(-size // PART_BYTES)))


def _gathered(texts: DataFrame, parts: int, asked: bool) -> DataFrame:
    """What the slices of ``texts`` (id, held_out, fold, text) hand on, as rows of ``_ROW``, ids, held_out and n_bytes.

    Windows with counts by fold (a fold of FOLDS counts nowhere); where
    ``asked``, also words with counts and the texts themselves.
    """
    bound_batches(texts.sparkSession)
    key = texts.schema["id"].dataType.simpleString()

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in text_slices(batch, 3, SLICE_BYTES):
                if size and size + part.nbytes > SLICE_BYTES:
                    yield from one_slice(held)
                    held, size = [], 0
                held.append(part)
                size += pc.sum(pc.binary_length(part.column(3))).as_py() or 0
        if held:
            yield from one_slice(held)

    def one_slice(held):
        ids, out = (pa.concat_arrays([p.column(i) for p in held]) for i in (0, 1))
        fold = np.concatenate([p.column(2).to_numpy() for p in held])
        texts = [t for p in held for t in _texts(p.column(3))]
        name = secrets.randbits(62)

        def batch_of(kind, cells, whole=False):
            def lists(array):
                return (pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array) if whole
                        else pa.nulls(len(cells), pa.list_(array.type)))
            return pa.RecordBatch.from_arrays([
                pa.array([kind] * len(cells), pa.int32()), pa.array([p for p, _, _ in cells], pa.int32()),
                pa.array([name if whole else 0] * len(cells), pa.int64()),
                pa.array([name if asked else None] * len(cells), pa.int64()),
                pa.array([n for _, n, _ in cells], pa.int32()), pa.array([b for _, _, b in cells], pa.binary()),
                lists(ids), lists(out), lists(pa.array([len(t) for t in texts], pa.int64()))],
                names=["kind", "part", "own", "slice", "n", "data", "ids", "held_out", "n_bytes"])

        def cells(values, counts, words):
            order, dealt = _dealt(values, parts, words)
            values, counts = values[order], counts[..., order]
            for at in range(0, len(dealt), 32):
                yield [(p, b - a, _packed(values[a:b], counts[..., a:b])) for p, a, b in dealt[at:at + 32]]

        for some in cells(*_slice_windows(texts, fold), False):
            yield batch_of(WINDOWS, some)
        if asked:
            values, index, owners = _slice_words(texts)
            training = ~np.asarray(out.to_numpy(zero_copy_only=False), bool)
            counts = np.bincount(index[training[owners]], minlength=len(values))
            for some in cells(values, counts, True):
                yield batch_of(WORDS, some)
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            yield batch_of(TEXTS, [(0, len(texts), blob)], whole=True)

    return texts.mapInArrow(run, f"{_ROW}, ids array<{key}>, held_out array<boolean>, n_bytes array<long>")


def _by_part(rows: DataFrame, tag: str) -> DataFrame:
    """Gathered rows with each part merged: its values, their counts, and where each slice's values are among them."""
    key = rows.schema["ids"].dataType.simpleString()
    asks = pa.list_(pa.struct([("slice", pa.int64()), ("n", pa.int32()), ("at", pa.binary())]))

    def merge(group, table):
        kind = group[0].as_py()
        listed = [table[c] for c in ("ids", "held_out", "n_bytes")]
        if kind == TEXTS:
            return pa.table([table["kind"], table["part"], table["own"], table["slice"], table["n"], table["data"],
                             *listed, pa.nulls(table.num_rows, pa.int64()), pa.nulls(table.num_rows, pa.int64()),
                             pa.nulls(table.num_rows, asks)], names=names)
        slices, sizes, blobs = (table[c].to_pylist() for c in ("slice", "n", "data"))
        values, counts = _merged([_unpacked(b, k) for k, b in zip(sizes, blobs, strict=True)])
        found = []
        for name, k, blob in zip(slices, sizes, blobs, strict=True):
            if name is not None:
                at = np.searchsorted(values, _unpacked(blob, k)[0])
                found.append({"slice": name, "n": k, "at": _planes(np.diff(at, prepend=0))})
        return pa.table([
            pa.array([kind], pa.int32()), pa.array([group[1].as_py()], pa.int32()), pa.array([0], pa.int64()),
            pa.nulls(1, pa.int64()), pa.array([len(values)], pa.int32()), pa.array([_packed(values, counts)], pa.binary()),
            *[pa.nulls(1, c.type) for c in listed], pa.array([int(counts.sum())], pa.int64()),
            pa.array([int(np.count_nonzero(counts))], pa.int64()), pa.array([found], asks)], names=names)

    names = ["kind", "part", "own", "slice", "n", "data", "ids", "held_out", "n_bytes", "total", "seen", "asks"]
    return cut_lineage(rows.groupBy("kind", "part", "own").applyInArrow(
        merge, f"{_ROW}, ids {key}, held_out array<boolean>, n_bytes array<long>, total long, seen long, "
        "asks array<struct<slice:long,n:int,at:binary>>"), tag)


def _fold(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(FOLDS)).cast("long")


def _fitted(rows: DataFrame, parts: int) -> mixing.Model:
    """Gate weights and probability map from the merged windows."""
    spark = rows.sparkSession
    model = mixing.Model()
    model.windows, model.parts, model.learned = rows.where(F.col("kind") == WINDOWS), parts, 0
    data = model.windows.select("part", "n", "data")

    def ends(batches):
        for batch in batches:
            for n, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                values, counts = _unpacked(blob, n)
                some, back = np.unique(values & np.uint64(0xFFFFFF), return_inverse=True)
                for f in range(FOLDS):
                    sums = np.bincount(back, counts[f], len(some)).astype(np.int64)
                    met = sums > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some[met].astype(np.int32)), pa.array(np.full(met.sum(), f, np.int32)),
                         pa.array(sums[met])], names=["ends", "fold", "n"])

    # Contexts of one and two bytes: not more than the triples of bytes there are.
    short = data.mapInArrow(ends, "ends int, fold int, n long").groupBy("ends", "fold").agg(F.sum("n").alias("n")).toArrow()
    triples, fold, n = (short[c].to_numpy() for c in ("ends", "fold", "n"))
    low, low_others = mixing.Counts((1, 2)), [mixing.Counts((1, 2)) for _ in range(FOLDS)]
    low.add(triples.astype(np.uint64), n)
    for f in range(FOLDS):
        low_others[f].add(triples[fold != f].astype(np.uint64), n[fold != f])
    folds = spark.sparkContext.broadcast(low_others)

    def one_part(batches):
        for batch in batches:
            for part, n, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                values, counts = _unpacked(blob, n)
                total = counts.sum(axis=0, dtype=np.int64)
                values, counts, total = values[total > 0], counts[:, total > 0], total[total > 0]
                if not len(values):
                    continue
                learned, rng = mixing.Model(), np.random.default_rng(1)
                met, met_map = np.zeros(learned.weights.size), np.zeros(learned.map.size)
                for f in range(FOLDS):
                    others = mixing.Counts((3, 4, 5, 6))
                    others.add(values, total - counts[f])
                    own = rng.permutation(np.flatnonzero(counts[f]))
                    a, b = learned.steps(values[own], counts[f][own], [folds.value[f], others], ())
                    met, met_map = met + a, met_map + b
                yield pa.RecordBatch.from_arrays([
                    pa.array([part % SUM_GROUPS], pa.int32()), pa.array([(learned.weights.ravel() * met).tobytes()]),
                    pa.array([met.tobytes()]), pa.array([(learned.map.ravel() * met_map).tobytes()]),
                    pa.array([met_map.tobytes()]), pa.array([int(total.sum())], pa.int64())], names=fields)

    def added(table):
        return pa.table([table["g"].slice(0, 1), *[
            pa.array([np.sum([np.frombuffer(x) for x in table[c].to_pylist()], axis=0).tobytes()]) for c in fields[1:5]],
            pa.array([pc.sum(table["windows"]).as_py()], pa.int64())], names=fields)

    fields = ["g", "weights", "met", "map", "met_map", "windows"]
    schema = "g int, weights binary, met binary, map binary, met_map binary, windows long"
    sums = data.mapInArrow(one_part, schema).groupBy("g").applyInArrow(added, schema).orderBy("g").collect()
    model.learned = sum(r["windows"] for r in sums)
    for name, met in (("weights", "met"), ("map", "met_map")):
        if sums:
            own = getattr(model, name)
            n = np.sum([np.frombuffer(r[met]) for r in sums], axis=0)
            total = np.sum([np.frombuffer(r[name]) for r in sums], axis=0)
            own.ravel()[:] = np.where(n > 0, total / np.maximum(n, 1e-9), own.ravel())
    model.shared = spark.sparkContext.broadcast((model.weights, model.map, low))
    return model


def _keyed(docs: DataFrame, held_out: Column, id_col: str, text_col: str, counted: bool) -> DataFrame:
    held, text = F.coalesce(held_out, F.lit(False)), F.col(text_col)
    fold = F.when(held, F.lit(FOLDS)).otherwise(_fold(text)) if counted else F.lit(FOLDS)
    return docs.select(F.col(id_col).alias("id"), held.alias("held_out"), fold.cast("long").alias("fold"),
                       text.alias("text"))


def learn(texts: DataFrame, text_col: str = "text") -> mixing.Model:
    """A model of all ``texts``."""
    parts, text = _parts_for(texts, text_col), F.col(text_col)
    keyed = texts.select(F.lit(0).alias("id"), F.lit(False).alias("held_out"), _fold(text).alias("fold"),
                         text.alias("text"))
    return _fitted(_by_part(_gathered(keyed, parts, asked=False), "lmwindows"), parts)


def learn_and_score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` of all ``docs`` by a model of those not ``held_out``, with one reading of the windows for both."""
    parts = _parts_for(docs, text_col)
    keyed = _keyed(docs, held_out, id_col, text_col, counted=True)
    rows = _by_part(_gathered(keyed, parts, asked=True), "lmparts")
    return _scored(rows, _fitted(rows, parts), id_col)


def score(docs: DataFrame, model: mixing.Model, held_out: Column, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte)``.

    Words are learned from the rows that are not ``held_out``.
    """
    keyed = _keyed(docs, held_out, id_col, text_col, counted=False)
    rows = _gathered(keyed, model.parts, asked=True)
    known = model.windows.select([F.col(c).cast(rows.schema[c].dataType) if c != "ids" else
                                  F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    return _scored(_by_part(rows.unionByName(known), "lmparts"), model, id_col)


def _scored(rows: DataFrame, model: mixing.Model, id_col: str) -> DataFrame:
    kind, shared = rows.schema["ids"].dataType.elementType.simpleString(), model.shared

    def answers(batches):
        """What each slice asked of a part: the bits of its windows, the counts of its words."""
        weights, probability_map, low = shared.value
        for batch in batches:
            for what, part, n, blob, asks in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                values, counts = _unpacked(blob, n)
                places = [np.cumsum(_from_planes(a["at"], a["n"]), dtype=np.int64) for a in asks]
                if what == WINDOWS:
                    asked, high = np.zeros(n, bool), mixing.Counts((3, 4, 5, 6))
                    for at in places:
                        asked[at] = True
                    total = counts.sum(axis=0, dtype=np.int64)
                    high.add(values[total > 0], total[total > 0])
                    counts = np.zeros(n, np.float32)
                    counts[asked] = mixing.Model.frozen(weights, probability_map, [low, high]).bits(values[asked])
                pack = _rounded if what == WINDOWS else _planes
                for at in range(0, len(asks), 32):
                    some = range(at, min(at + 32, len(asks)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([asks[i]["slice"] for i in some], pa.int64()), pa.array([what] * len(some), pa.int32()),
                        pa.array([part] * len(some), pa.int32()), pa.array([asks[i]["n"] for i in some], pa.int32()),
                        pa.array([pack(counts[places[i]]) for i in some], pa.binary())],
                        names=["of", "what", "part", "n", "found"])

    answered = rows.where((F.col("kind") != TEXTS) & (F.size("asks") > 0)).select(
        "kind", "part", "n", "data", "asks").mapInArrow(answers, "of long, what int, part int, n int, found binary")
    texts = rows.where(F.col("kind") == TEXTS).select("slice", "ids", "held_out", "n_bytes", "data")
    parts = model.parts
    words = rows.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("total"), F.lit(0)),
                                                   F.coalesce(F.sum("seen"), F.lit(0))).first()
    ends = texts.select(F.explode("held_out").alias("h")).where("NOT h").count()
    tokens, kinds = int(words[0]) + ends, int(words[1]) + (ends > 0)

    def finish(key, left, right):
        right = right.sort_by("part")
        found = {what: right.filter(pc.equal(right["what"], what)) for what in (WINDOWS, WORDS)}
        sizes = left["n_bytes"].combine_chunks().flatten().to_numpy()
        data, at = zstandard.ZstdDecompressor().decompress(left["data"][0].as_py()), np.cumsum(sizes).tolist()
        texts = [data[e - n:e] for e, n in zip(at, sizes.tolist(), strict=True)]
        n = len(texts)

        def cost_of(values):
            cost = np.empty(len(values), np.float32)
            cost[_dealt(values, parts)[0]] = np.concatenate([_from_rounded(b) for b in found[WINDOWS]["found"].to_pylist()])
            return cost
        bits = _window_costs(texts, cost_of)
        _, index, owners = _slice_words(texts)
        known = np.concatenate([np.zeros(0), *[_from_planes(b, k) for k, b in zip(
            found[WORDS]["n"].to_pylist(), found[WORDS]["found"].to_pylist(), strict=True)]])
        c = known[index]
        n_tokens = np.bincount(owners, minlength=n).astype(np.int64) + 1
        n_known = np.bincount(owners, c > 0, n).astype(np.int64) + (ends > 0)
        base = (np.bincount(owners, np.log10(c + 1.0), n) + np.log10(ends + 1.0)
                - n_tokens * np.log10(tokens + kinds + 1.0))
        return pa.table({
            "id": left["ids"].combine_chunks().flatten(), "held_out": left["held_out"].combine_chunks().flatten(),
            "n_tokens": n_tokens, "n_known": n_known, "train_tokens": np.full(n, tokens), "base_score": base,
            "score": -bits * np.log10(2.0), "n_bytes": sizes, "bits_per_byte": bits / np.maximum(1, sizes)})

    out = texts.groupBy("slice").cogroup(answered.groupBy("of")).applyInArrow(
        finish, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, n_bytes long, bits_per_byte double")
    return out.withColumnRenamed("id", id_col)
