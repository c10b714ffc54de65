"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is contained in a document when at least ``threshold`` of the
item's distinct word shingles occur in the document, wherever they stand.

1.  Items are partitioned by their number of shingles (powers of two).  An
    item of ``n`` shingles may miss ``n - ceil(threshold * n)`` of them; its
    bottom-k MinHash sketch is a little larger than that for the whole size
    class, so a containing document shares at least ``k - misses`` sketch
    values with it: the candidate search loses nothing.
2.  Documents of any length are scanned once, whole; all their shingle hashes
    are tested against the sketch values of a block of items.
3.  Candidates are verified by exact shingle containment on the words.

The items are the query set: they are taken in blocks of a bounded number of
characters, each scanned against all documents (one block in practice).

Words are runs of letters and digits in lower case.  An item of fewer than
``shingle`` words has one shingle, all its words.

Cases
-----
* null or empty texts, texts without words: contain nothing, are contained in
  nothing;
* repeated documents: each row is reported (or dropped); repeated items
  (same id and text) count once; ids may be null;
* exactly ``threshold`` is contained (compared in whole numbers of shingles);
* empty documents or empty benchmark: no pairs, every document kept;
* other columns are ignored by :func:`contained_items` and kept, whatever
  their names, by :func:`decontaminate`.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skygrid.llm.common import map_batches, text_slices

SHINGLE = 5
THRESHOLD = 0.8
# Test items are taken in blocks of about this many characters.
BLOCK_CHARS = 4_000_000
# Sketch values beyond those an item may miss.
EXTRA = 3
SLICE_BYTES = 1 << 20

WORD = regex.compile(r"[\p{L}\p{N}]+")
_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_FILTER_BITS = 22


@lru_cache(maxsize=1)
def _word_points() -> np.ndarray:
    """Whether a code point is a letter or a digit."""
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, bool)
    for m in regex.finditer(r"[\p{L}\p{N}]", chars):
        out[ord(m.group())] = True
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Hasher:
    """Shingle hashes of many texts at once; collisions are left to verification."""

    def __init__(self):
        self.power = self.inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            self.power = _powers(_P, 2 * n)
            self.inverse = _powers(pow(_P, -1, 1 << 64), 2 * n)

    @staticmethod
    def spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(code points, starts, ends, text number)`` of the words, in order."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.zeros(len(points) + 2, np.int8)
        word[1:-1] = _word_points()[points]
        edges = np.flatnonzero(np.diff(word))
        starts, ends = edges[::2], edges[1::2]
        limits = np.cumsum([len(t) + 1 for t in lowered])
        return points, starts, ends, np.searchsorted(limits, starts, side="right")

    def hashes(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each span of code points."""
        self._grow(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points + np.uint32(1)).astype(np.uint64) * self.power[:len(points)], out=sums[1:])
        return _mix((sums[ends] - sums[starts]) * self.inverse[starts])

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(hash, text number)`` per word, in order."""
        points, starts, ends, owner = self.spans(texts)
        return self.hashes(points, starts, ends), owner

    @staticmethod
    def shingles(h: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``(hash, text number)`` of every run of ``k`` words within a text."""
        n = len(h) - k + 1
        if n <= 0:
            return h[:0], owner[:0]
        total = np.zeros(n, np.uint64)
        for j, q in enumerate(_powers(_Q, k)):
            total += h[j:j + n] * q
        inside = owner[:n] == owner[k - 1:]
        return _mix(total[inside]), owner[:n][inside]


def item_shingles(text: str | None, shingle: int = SHINGLE) -> tuple[int, set[str]]:
    """The shingle length used for an item, and its distinct shingles."""
    words = WORD.findall((text or "").lower())
    k = min(shingle, len(words))
    return k, {" ".join(words[i:i + k]) for i in range(len(words) - k + 1)} if k else set()


def needed(n: int, threshold: float) -> int:
    """The least number of an item's ``n`` shingles that count as contained."""
    return math.ceil(round(threshold * n, 9))


class Index:
    """The MinHash sketches of a block of items, by shingle length."""

    def __init__(self, items: list[tuple], shingle: int, threshold: float):
        self.items, hasher = [], Hasher()
        self.sketches: dict[int, tuple] = {}
        found = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            k, shingles = item_shingles(text, shingle)
            n = len(shingles)
            if not n:
                continue
            need = needed(n, threshold)
            size_class = 1 << (n - 1).bit_length()
            sketch_size = min(n, size_class - needed(size_class, threshold) + EXTRA)
            hashes = np.unique(hasher.shingles(*hasher.words([text]), k)[0])   # smallest first
            sketch = hashes[:sketch_size]
            at = len(self.items)
            # A colliding hash may stand for several shingles: never ask for more.
            self.items.append((item_id, k, frozenset(shingles), need,
                               max(1, len(sketch) - (n - need))))
            for h in sketch.tolist():
                found[k][h].append(at)
        for k, by_hash in found.items():
            values = np.array(sorted(by_hash), np.uint64)
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[values >> np.uint64(64 - _FILTER_BITS)] = True
            self.sketches[k] = (values, bits, [by_hash[v] for v in values.tolist()])

    def search(self, texts: list[str], hasher: Hasher):
        """Yield ``(text number, item, shingles found)`` for verified containments."""
        h, owner = hasher.words(texts)
        hits: dict[tuple[int, int], set] = defaultdict(set)
        for k, (values, bits, lists) in self.sketches.items():
            sh, text_no = Hasher.shingles(h, owner, k)
            maybe = np.flatnonzero(bits[sh >> np.uint64(64 - _FILTER_BITS)])
            at = np.searchsorted(values, sh[maybe])
            at[at == len(values)] = 0
            same = values[at] == sh[maybe]
            for v, t in zip(at[same].tolist(), text_no[maybe[same]].tolist(), strict=True):
                for item in lists[v]:
                    hits[t, item].add(v)
        by_text = defaultdict(list)
        for (t, item), seen in hits.items():
            if len(seen) >= self.items[item][4]:
                by_text[t].append(item)
        for t, candidates in sorted(by_text.items()):
            words = WORD.findall(texts[t].lower())
            shingles = {k: {" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}
                        for k in {self.items[c][1] for c in candidates}}
            for c in sorted(candidates):
                _, k, wanted, need, _ = self.items[c]
                n = len(wanted & shingles[k])
                if n >= need:
                    yield t, self.items[c], n


def _blocks(benchmark: DataFrame, text_col: str, id_col: str, block_chars: int):
    """The items, in blocks of about ``block_chars`` characters."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        "text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / block_chars))
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b)
        yield sorted(map(tuple, part.collect()), key=lambda x: (x[0] is None, x))


def contained_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                    id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
                    shingle: int = SHINGLE, threshold: float = THRESHOLD,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_found, containment)`` per contained item."""
    keyed = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    item_type = benchmark.schema[item_id].dataType.simpleString()
    schema = (f"doc {keyed.schema['doc'].dataType.simpleString()}, item {item_type}, "
              "n_shingles long, n_found long, containment double")
    out_item, found = to_arrow_type(benchmark.schema[item_id].dataType), None
    for items in _blocks(benchmark, item_text, item_id, block_chars):
        index = Index(items, shingle, threshold)

        def run(batch: pa.RecordBatch, index=index, hasher=Hasher()):   # noqa: B008 one per task
            for part in text_slices(batch, 1, SLICE_BYTES):
                rows = [(t, item, n) for t, item, n in
                        index.search([x or "" for x in part.column(1).to_pylist()], hasher)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([r[1][0] for r in rows], out_item),
                     pa.array([len(r[1][2]) for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([r[2] / len(r[1][2]) for r in rows], pa.float64())],
                    names=["doc", "item", "n_shingles", "n_found", "containment"])

        pairs = map_batches(keyed, run, schema)
        found = pairs if found is None else found.unionByName(pairs)
    return found.select(F.col("doc").alias(id_col), F.col("item").alias(item_id),
                        "n_shingles", "n_found", "containment")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_text: str = "text", item_id: str = "item_id", shingle: int = SHINGLE,
                  threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns."""
    at = docs.columns.index(text_col)
    schema, clean = docs.schema, docs
    for items in _blocks(benchmark, item_text, item_id, block_chars):
        index = Index(items, shingle, threshold)

        def run(batch: pa.RecordBatch, index=index, hasher=Hasher()):   # noqa: B008 one per task
            for part in text_slices(batch, at, SLICE_BYTES):
                bad = {t for t, _, _ in index.search([x or "" for x in part.column(at).to_pylist()], hasher)}
                yield part.filter(pa.array([i not in bad for i in range(part.num_rows)], pa.bool_()))

        clean = map_batches(clean, run, schema)
    return clean
