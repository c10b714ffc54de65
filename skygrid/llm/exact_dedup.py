"""Exact duplicates by content-defined chunk recipes.

1.  Every text is cut where a rolling hash of its last 32 bytes has a fixed
    pattern, so equal passages are cut alike wherever they stand.  A chunk
    gets a 128-bit hash; a document's recipe is the ordered list of the
    identifiers of its chunks.
2.  Identifiers are verified: the bytes of the chunks, each distinct one once
    per task, are grouped by (hash, bytes).  A hash with one content *is* an
    identifier; if contents share a hash, they are numbered, and recipes are
    made of hash and number.
3.  Documents are equal when their recipes are.  Only recipes (16 bytes for
    about 2 KB of text) are grouped and joined; the text of a long document
    never moves as a whole, and its chunks move once.

A group of equal texts is counted before the shuffle, so its size doesn't
matter; the rows of a large group meet their group in an ordinary join, which
adaptive execution splits.

Cases
-----
* null counts as the empty text; empty texts are equal to each other;
* any length: chunks are at most 8 KB, a text is read in slices;
* of equal texts the row with the largest id is kept; null ids come last;
  among repeated rows with that id exactly one is kept;
* an empty table gives an empty result;
* only the id and the text are read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygrid.llm.common import cut_lineage, map_batches

WINDOW = 32             # bytes that decide a cut; MIN_CHUNK is not smaller
MIN_CHUNK, MAX_CHUNK = 512, 8192
MEAN_BITS = 11          # a position is a candidate with probability 2^-11
HASH_BYTES = 16
_SLICE = 1 << 18        # positions hashed at a time
_GEAR = np.random.default_rng(13).integers(0, 1 << 32, 256, dtype=np.uint32)


def candidates(data: np.ndarray) -> np.ndarray:
    """The positions after which the last 32 bytes ask for a cut, in the bytes ``data``.

    The hash of a window is the sum of its bytes' table values, each shifted
    by its distance from the end; windows of 2, 4, .. 32 bytes are put
    together from two halves.
    """
    found = []
    for start in range(0, len(data), _SLICE):
        first = max(0, start - WINDOW + 1)
        h = _GEAR[data[first:start + _SLICE]]
        for half in (1, 2, 4, 8, 16):
            longer = h.copy()
            longer[half:] += h[:-half] << np.uint32(half)
            h = longer
        at = np.flatnonzero((h >> np.uint32(32 - MEAN_BITS)) == 0) + first
        found.append(at[at >= start] + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(length: int, cuts: np.ndarray) -> list[int]:
    """The ends of a text's chunks, from its candidate positions in ascending order."""
    ends, start = [], 0
    if length > MIN_CHUNK:
        for cut in cuts.tolist():
            while cut - start > MAX_CHUNK:
                start += MAX_CHUNK
                ends.append(start)
            if cut - start >= MIN_CHUNK and cut < length:
                ends.append(cut)
                start = cut
        while length - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
    if length > start:
        ends.append(length)
    return ends


def chunked(texts: pa.Array) -> Iterator[list[bytes]]:
    """The chunks of each text of an Arrow array of strings without nulls."""
    raw = texts.cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.empty(0, np.uint8)
    data, bounds = data[bounds[0]:bounds[-1]], bounds - bounds[0]
    cuts = candidates(data)
    place = np.searchsorted(cuts, bounds, "right")
    for k in range(len(raw)):
        lo, hi = int(bounds[k]), int(bounds[k + 1])
        text, start, chunks = data[lo:hi], 0, []
        for end in chunk_ends(hi - lo, cuts[place[k]:place[k + 1]] - lo):
            chunks.append(text[start:end].tobytes())
            start = end
        yield chunks


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _numbered_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _texts(docs, id_col, text_col).select(
        "id", F.monotonically_increasing_id().alias("row"), F.sha2("text", 256).alias("text_sha256"), "text")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            hash_bytes: int = HASH_BYTES) -> DataFrame:
    """``(id, row, text_sha256, recipe)`` of every row; ``recipe`` joins the hashes of its chunks in order."""
    rows = _numbered_rows(docs, id_col, text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        listed = [b"".join(xxhash.xxh3_128_digest(c)[:hash_bytes] for c in chunks)
                  for chunks in chunked(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(listed, pa.binary())],
                                         names=["id", "row", "text_sha256", "recipe"])
    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"id {kind}, row long, text_sha256 string, recipe binary")


def chunk_store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_bytes: int = HASH_BYTES) -> DataFrame:
    """The distinct chunks of all texts, ``(hash, content)``; bytes are compared, not only hashes."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        distinct = list(dict.fromkeys(c for chunks in chunked(batch.column(0)) for c in chunks))
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_128_digest(c)[:hash_bytes] for c in distinct], pa.binary()),
             pa.array(distinct, pa.binary())], names=["hash", "content"])
    return map_batches(_texts(docs, id_col, text_col).select("text"), run, "hash binary, content binary").distinct()


def _numbered_recipes(docs: DataFrame, shared: DataFrame, id_col: str, text_col: str, hash_bytes: int) -> DataFrame:
    """Recipes of hash and number, where several contents share a hash (``shared``)."""
    inside = Window.partitionBy("hash").orderBy("content")
    numbers = cut_lineage(
        chunk_store(docs, id_col, text_col, hash_bytes).join(shared, "hash", "left_semi")
        .withColumn("number", F.row_number().over(inside)), "sharedhashes")
    rows = _numbered_rows(docs, id_col, text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, place, content = [], [], []
        for i, chunks in enumerate(chunked(batch.column("text"))):      # place -1: texts without chunks stay
            at += [i] * (len(chunks) + 1)
            place += range(-1, len(chunks))
            content += [b"", *chunks]
        same = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:3]]
        hashes = [xxhash.xxh3_128_digest(c)[:hash_bytes] for c in content]
        yield pa.RecordBatch.from_arrays([*same, pa.array(place, pa.int32()), pa.array(hashes, pa.binary()),
                                          pa.array(content, pa.binary())],
                                         names=["id", "row", "text_sha256", "place", "hash", "content"])
    kind = rows.schema["id"].dataType.simpleString()
    parts = map_batches(rows, run, f"id {kind}, row long, text_sha256 string, place int, hash binary, content binary")
    number = F.lpad(F.hex(F.coalesce("number", F.lit(0))), 16, "0")
    named = parts.join(numbers, ["hash", "content"], "left").select(
        "id", "row", "text_sha256", "place", F.concat(F.hex("hash"), number).alias("chunk"))
    listed = named.groupBy("id", "row", "text_sha256").agg(
        F.sort_array(F.collect_list(F.when(F.col("place") >= 0, F.struct("place", "chunk")))).alias("chunks"))
    return listed.select("id", "row", "text_sha256",
                         F.unhex(F.array_join(F.col("chunks.chunk"), "")).alias("recipe"))


def verified_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hash_bytes: int = HASH_BYTES) -> DataFrame:
    """:func:`recipes` whose identifiers name one content each; written to the shared folder."""
    found = cut_lineage(recipes(docs, id_col, text_col, hash_bytes), "recipes")
    contents = chunk_store(docs, id_col, text_col, hash_bytes).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    shared = cut_lineage(contents.where("n > 1").select("hash"), "sharedhash")
    if shared.isEmpty():
        return found
    return cut_lineage(_numbered_recipes(docs, shared, id_col, text_col, hash_bytes), "recipes")


def equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_bytes: int = HASH_BYTES) -> DataFrame:
    """``(id_col, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``."""
    rows = verified_recipes(docs, id_col, text_col, hash_bytes)
    groups = cut_lineage(rows.groupBy("recipe").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.coalesce(F.max_by("row", "id"), F.max("row")).alias("keep_row"))
        .where("group_size > 1").withColumnRenamed("recipe", "of"), "copies")
    alone = F.col("group_size").isNull()
    return rows.join(groups, F.col("recipe") == F.col("of"), "left").select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256")
