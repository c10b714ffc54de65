"""SimHash near-duplicates by vantage-point trees over Hamming distance.

1.  Every text gets a 64-bit SimHash of its word shingles.
2.  The distinct fingerprints are dealt to shards by a vantage-point tree
    (fitted on a bounded sample): a node holds a vantage fingerprint and a
    radius, a fingerprint goes inside or outside by its distance.
3.  Where a fingerprint lies so close to a node's border that a partner could
    be on the other side (triangle bound), it is also sent there as a query.
4.  In a shard the same splitting goes on in memory down to small leaves,
    whose pairs are tested exactly.
5.  A shard returns a spanning forest of its links, never the pairs; the
    forests meet in distributed connected components.

Two fingerprints within ``k`` bits differ by at most ``k // 2`` in one of
their 32-bit halves, so there is one tree per half: its nodes may measure that
half with bound ``k // 2`` or the whole word with bound ``k``, whichever cuts
the node's sample with fewer border cases.  All links are found exactly; the
sample shapes the work, never the result.

Cases
-----
* null or empty text, or a text of white space: fingerprint zero, linked like
  any other; fewer words than a shingle: the whole sequence is the shingle;
* repeated rows and equal ids: every row is returned; ids in a component are
  compared by value, a null id is never the smallest unless all are null;
* empty table: empty result;
* other columns are ignored by :func:`near_duplicates` and kept by
  :func:`drop_near_duplicates`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import cut_lineage, map_batches
from skygrid.llm.components import Forest, connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Tree fitting: at most about this many distinct fingerprints are sampled;
# a shard is meant to hold SHARD_ROWS fingerprints of its own.
SAMPLE = 1 << 14
SHARD_ROWS = 8192
LEAF_ROWS = 128

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HALVES = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))
WHOLE = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    # digest() is big-endian, so bit 0 of unpackbits is the highest bit.
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(b" ".join(words), SEED)
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_digest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        digests = b"".join([digest(joined[s:e], SEED)
                            for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    n = len(rows)
    if n < 2048:
        ones = np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    else:   # long texts: count byte values, then the bits of the 256 values
        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
        ones = np.concatenate([np.bincount(rows[:, k], minlength=256) @ table for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                      shingle: int = SHINGLE) -> DataFrame:
    """``(id, fingerprint)`` per row; the fingerprint as a signed long."""
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch):
        prints = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, shingle)
                              for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))],
                                         names=["id", "fingerprint"])

    return map_batches(keyed, run, f"id {keyed.schema['id'].dataType.simpleString()}, fingerprint long")


# ---------------------------------------------------------------------------
# Vantage-point trees

@dataclass
class Node:
    """Inner node: fingerprints within ``radius`` of ``vantage`` go inside."""
    vantage: np.uint64
    mask: np.uint64
    radius: int
    reach: int           # a link's largest distance under ``mask``
    inside: Node | Leaf
    outside: Node | Leaf


@dataclass
class Leaf:
    shard: int
    blocks: int          # its own rows are dealt to this many blocks


def _distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def _best_cut(points: np.ndarray, half: np.uint64, max_bits: int):
    """The (vantage, mask, radius, reach) with the least work below, or None.

    Work is the product sum of own rows and visiting rows on the two sides;
    None where no cut saves anything (all points lie close together).
    """
    best, least = None, 0.95 * len(points) ** 2
    step = max(1, len(points) // 3)
    some = points if len(points) <= 4096 else points[:: len(points) // 4096 + 1]
    for vantage in points[::step][:3]:
        for mask, reach in ((half, max_bits // 2), (WHOLE, max_bits)):
            d = _distance(some, vantage, mask)
            counts = np.bincount(d, minlength=65)
            below = np.cumsum(counts)
            radius = int(np.searchsorted(below, len(some) / 2))
            for r in {max(0, radius - 1), radius, radius + 1}:
                own_in, own_out = below[min(r, 64)], len(some) - below[min(r, 64)]
                if not own_in or not own_out:
                    continue
                visit_in = below[min(r + reach, 64)]
                visit_out = len(some) - (below[r - reach] if r - reach >= 0 else 0)
                work = (own_in * visit_in + own_out * visit_out) * (len(points) / len(some)) ** 2
                if work < least:
                    best, least = (vantage, mask, r, reach), work
    return best


def build_tree(sample: np.ndarray, half: np.uint64, scale: float, max_bits: int,
               shard_rows: int, first_shard: int = 0) -> tuple[Node | Leaf, int]:
    """A tree over ``sample``, each point standing for ``scale`` fingerprints."""
    expected = len(sample) * scale
    cut = _best_cut(sample, half, max_bits) if expected > shard_rows and len(sample) >= 8 else None
    if cut is None:
        return Leaf(first_shard, max(1, int(np.ceil(expected / (2 * shard_rows))))), first_shard + 1
    vantage, mask, radius, reach = cut
    inner = _distance(sample, vantage, mask) <= radius
    inside, nxt = build_tree(sample[inner], half, scale, max_bits, shard_rows, first_shard)
    outside, nxt = build_tree(sample[~inner], half, scale, max_bits, shard_rows, nxt)
    return Node(vantage, mask, radius, reach, inside, outside), nxt


def _sides(node: Node, own: np.ndarray, visiting: np.ndarray):
    """Split own rows and send on those a partner could be across the border for.

    An own row outside the border is sent inside, not the other way round:
    one of a pair's two visits finds it.  Visitors go wherever they reach.
    """
    d = _distance(own, node.vantage, node.mask)
    inner = d <= node.radius
    v = _distance(visiting, node.vantage, node.mask).astype(np.int16)
    yield (node.inside, own[inner],
           np.concatenate((visiting[v <= node.radius + node.reach],
                           own[~inner & (d <= node.radius + node.reach)])))
    yield node.outside, own[~inner], visiting[v > node.radius - node.reach]


def route(tree: Node | Leaf, own: np.ndarray, visiting: np.ndarray):
    """Yield ``(leaf, own rows, visiting rows)`` for every leaf reached."""
    if not len(own) and not len(visiting):
        return
    if isinstance(tree, Leaf):
        yield tree, own, visiting
        return
    for side in _sides(tree, own, visiting):
        yield from route(*side)


def _link(p: np.ndarray, forest: Forest, own: np.ndarray, visiting: np.ndarray, half: np.uint64, max_bits: int,
          leaf_rows: int) -> None:
    """Join all linked pairs among ``own`` and between ``own`` and ``visiting`` (indices)."""
    if not len(own):
        return
    cut = _best_cut(p[own], half, max_bits) if len(own) > leaf_rows else None
    if cut is not None:
        vantage, mask, radius, reach = cut
        d = _distance(p[own], vantage, mask)
        v = _distance(p[visiting], vantage, mask).astype(np.int16)
        inner = d <= radius
        _link(p, forest, own[inner],
              np.concatenate((visiting[v <= radius + reach], own[~inner & (d <= radius + reach)])),
              half, max_bits, leaf_rows)
        _link(p, forest, own[~inner], visiting[v > radius - reach], half, max_bits, leaf_rows)
        return
    for start in range(0, len(own), leaf_rows):
        rows, later = own[start:start + leaf_rows], own[start:]
        for others in (later, visiting):
            for at in range(0, len(others), 1 << 14):
                part = others[at:at + (1 << 14)]
                near = np.bitwise_count(p[rows][:, None] ^ p[part][None, :]) <= max_bits
                itself = 1 if others is later and at == 0 else 0
                for i in np.flatnonzero(near.sum(axis=1) > itself):
                    forest.join(rows[i], part[near[i]])


def _shard_links(max_bits: int, leaf_rows: int):
    def run(key, rows):
        half = HALVES[key[0].as_py()]
        prints = rows["fingerprint"].to_numpy().view(np.uint64)
        own = rows["own"].to_numpy(zero_copy_only=False)
        points, back = np.unique(prints, return_inverse=True)
        mine = np.zeros(len(points), bool)
        mine[back[own]] = True
        forest = Forest(len(points))
        _link(points, forest, np.flatnonzero(mine), np.flatnonzero(~mine), half, max_bits, leaf_rows)
        ends = np.array(forest.links, np.int64).reshape(-1, 2)
        a, b = points[ends[:, 0]].view(np.int64), points[ends[:, 1]].view(np.int64)
        return pa.table({"a": a, "b": b})
    return run


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE,
                      shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all links within ``max_bits``.

    ``prints`` holds distinct fingerprints in the column ``fingerprint``.
    """
    n = prints.count()
    share = min(1.0, sample / max(1, n))
    chosen = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.lit(1 << 32)) < int(share * (1 << 32))
    taken = np.array([r[0] for r in prints.where(chosen).select("fingerprint").collect()],
                     np.int64).view(np.uint64)
    taken.sort()
    np.random.default_rng(1).shuffle(taken)
    scale = n / max(1, len(taken))
    trees = [build_tree(taken, half, scale, max_bits, shard_rows)[0] for half in HALVES]

    def deal(batch: pa.RecordBatch):
        points = batch.column(0).to_numpy().view(np.uint64)
        for h, tree in enumerate(trees):
            for leaf, own, visiting in route(tree, points, points[:0]):
                block = (own % np.uint64(leaf.blocks)).astype(np.int32)
                parts = [(block, own, True)]
                for b in range(leaf.blocks):
                    parts.append((np.full(len(visiting), b, np.int32), visiting, False))
                    if b:   # own rows of lower blocks visit the higher ones
                        lower = own[block < b]
                        parts.append((np.full(len(lower), b, np.int32), lower, False))
                for blocks, rows, mine in parts:
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), h, np.int32)),
                             pa.array(np.full(len(rows), leaf.shard, np.int32)), pa.array(blocks),
                             pa.array(rows.view(np.int64)), pa.array(np.full(len(rows), mine))],
                            names=["half", "shard", "block", "fingerprint", "own"])

    dealt = map_batches(prints.select("fingerprint"), deal,
                        "half int, shard int, block int, fingerprint long, own boolean")
    return dealt.groupBy("half", "shard", "block").applyInArrow(
        _shard_links(max_bits, leaf_rows), "a long, b long")


def _components(prints: DataFrame, max_bits: int, **tree) -> DataFrame:
    """``(fingerprint, component)`` for fingerprints linked to another one."""
    links = fingerprint_links(prints, max_bits, **tree)
    return connected_components(links).select(F.col("node").alias("fingerprint"), "component")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, **tree) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest
    id reachable over links of at most ``max_bits`` bits.
    """
    prints = cut_lineage(with_fingerprints(docs, text_col, id_col, shingle), "simhash")
    groups = cut_lineage(prints.groupBy("fingerprint").agg(F.min("id").alias("first_id")), "simgroups")
    found = _components(groups, max_bits, **tree)
    labelled = groups.join(found, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint"))
    firsts = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = labelled.join(firsts, "component").select("fingerprint", "component_id")
    return prints.join(ids, "fingerprint").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS, **tree) -> DataFrame:
    """The rows of ``docs`` that represent their group, with all their columns.

    The row with the smallest id represents a group (null ids last); among
    repeated rows with that id, one is kept.
    """
    numbered = cut_lineage(docs.select(F.struct(*docs.columns).alias("doc"),
                                       F.monotonically_increasing_id().alias("row")), "simdocs")
    doc = F.col("doc")
    prints = cut_lineage(with_fingerprints(numbered.select(
        F.struct(doc[id_col].isNull().alias("none"), doc[id_col].alias("id"), F.col("row")).alias("id"),
        doc[text_col].alias("text")), "text", "id", shingle), "simhash")
    groups = cut_lineage(prints.groupBy("fingerprint").agg(F.min("id").alias("first")), "simgroups")
    found = _components(groups, max_bits, **tree)
    kept = (groups.join(found, "fingerprint", "left")
            .groupBy(F.coalesce("component", "fingerprint").alias("component"))
            .agg(F.min("first").alias("first")).select(F.col("first.row").alias("row")))
    return numbered.join(kept, "row", "left_semi").select("doc.*")
