"""Near-duplicate vectors: random-hyperplane sign hashing in several tables.

1.  Equal vectors are one class, represented by the smallest id; the rest of
    the work sees distinct vectors only.
2.  Each class is hashed into ``tables`` buckets of ``bits`` hyperplane signs;
    both numbers follow from the number of classes and the wanted recall.
3.  The cosines inside a bucket are computed exactly in double precision; a
    pair that shares buckets in several tables counts in the first of them.
    Large buckets are dealt out as pairs of blocks of bounded size.
4.  A task returns, per class, the vectors newly linked to it, and a spanning
    forest of the links -- never the pairs.
5.  Distributed connected components join the forests.

Cases
-----
* null vectors, zero vectors, vectors with null or non-finite components, and
  rows without an id link with nothing (``n_links`` 0, own component);
* vectors of different lengths link with nothing of another length;
* repeated rows (same id and vector) are one vector, each row is returned;
* empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import cut_lineage, map_batches
from skygrid.llm.components import Forest, connected_components

THRESHOLD = 0.95
# The share of pairs exactly at the threshold that no table may bring together.
MISS = 1e-4
BUCKET_ROWS = 64      # mean bucket size the number of bits aims at
BLOCK_ROWS = 1024     # rows of a bucket compared with one another in one task
SEED = 20240229


def table_shape(n: int, threshold: float, miss: float = MISS, bucket_rows: int = BUCKET_ROWS) -> tuple[int, int]:
    """``(bits, tables)`` for ``n`` distinct vectors."""
    same_sign = 1.0 - math.acos(threshold) / math.pi
    bits = max(1, min(62, round(math.log2(max(2.0, n / bucket_rows)))))
    return bits, math.ceil(math.log(miss) / math.log1p(-same_sign ** bits))


def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))


def signatures(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The bucket number of every row in every table (rows x tables)."""
    signs = (unit @ _planes(unit.shape[1], bits, tables) > 0).reshape(len(unit), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vector.isNotNull() & ~F.coalesce(bad, F.lit(True))
            & F.exists(vector, lambda x: F.coalesce(x, F.lit(0)) != 0))


def _bucket_links(threshold: float, bits: int, tables: int):
    def run(key, rows):
        table, dim = key[0].as_py(), key[1].as_py()
        ids, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        side = rows["left"].to_numpy(zero_copy_only=False)     # None: in both blocks
        unit = _unit(_matrix(rows["vector"], dim))
        sig = signatures(unit, bits, tables)[:, :table]
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        left = np.flatnonzero(side <= 0)
        right = np.flatnonzero(side >= 0)
        for at in range(0, len(left), 256):
            a = left[at:at + 256]
            near = unit[a] @ unit[right].T >= threshold
            if key[3].as_py() == key[4].as_py():       # a block with itself: each pair once
                near &= a[:, None] < right[None, :]
            i, j = np.nonzero(near)
            if table:       # those that met in an earlier table have been counted
                new = ~(sig[a[i]] == sig[right[j]]).any(axis=1)
                i, j = i[new], j[new]
            if not len(i):
                continue
            x, y = a[i], right[j]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            cuts = np.flatnonzero(np.diff(x)) + 1
            for who, group in zip(x[np.concatenate(([0], cuts))], np.split(y, cuts), strict=True):
                forest.join(who, group)
        some = np.flatnonzero(links)
        ends = np.array(forest.links, np.int64).reshape(-1, 2)
        return pa.table({
            "a": np.concatenate((ids[some], ids[ends[:, 0]])),
            "b": np.concatenate((ids[some], ids[ends[:, 1]])),
            "links": np.concatenate((links[some], np.zeros(len(ends), np.int64)))})
    return run


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           threshold: float = THRESHOLD, miss: float = MISS,
                           bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    usable = rows.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    classes = cut_lineage(
        usable.groupBy("vector").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies")),
        "vectors")
    n = classes.count()
    bits, tables = table_shape(n, threshold, miss, bucket_rows)

    def deal(batch: pa.RecordBatch):
        dims = pc.list_value_length(batch.column(0)).to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            sig = signatures(_unit(_matrix(part.column(0), dim)), bits, tables)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sig), t, np.int32)), pa.array(np.full(len(sig), dim, np.int32)),
                     pa.array(sig[:, t]), part.column(1)], names=["table", "dim", "bucket", "rep"])

    dealt = map_batches(classes.select("vector", "rep"), deal, "table int, dim int, bucket long, rep long")
    keys = ["table", "dim", "bucket"]
    sizes = (dealt.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
             .select(*keys, F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")))
    # A row of block b takes part in the block pairs (0, b) .. (b, b) .. (b, last).
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    paired = (dealt.join(sizes, keys).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(*keys, "rep", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                      F.signum((F.col("own") - F.col("other")).cast("double")).cast("int").alias("left")))
    found = cut_lineage(
        paired.join(classes, "rep").groupBy(*keys, "lo", "hi")
        .applyInArrow(_bucket_links(threshold, bits, tables), "a long, b long, links long"), "veclinks")
    counts = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    component = connected_components(found.where("a <> b"))
    labelled = (classes.join(counts, "rep", "left")
                .join(component.withColumnRenamed("node", "rep"), "rep", "left")
                .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    linked = usable.join(labelled, "vector").select("id", "n_links", "component_id")
    alone = rows.where(~(F.col("id").isNotNull() & _usable(F.col("vector")))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
