"""Merkle manifest of a data set: digests by time-forward processing, proofs by a reversed sweep.

Every row is a leaf.  The leaves of a group (a source), in the order of their
ids, form a tree of runs of three whose top is the group's subroot; the
subroots, in the order of the groups, form another tree whose top is the root.

Nodes are labelled level by level, so a parent always comes after its
children.  A priority queue ordered by label delivers digests: a node takes
out its children's digests, which come first and in order, and sends its own
to its parent's label.  The queue is external: leaves are ranked by a sample
sort, the nodes of ``3^6`` consecutive leaves form a block, and what leaves a
block -- one digest -- is sorted on to its next block by a Spark shuffle.
Inside a block, which one task holds, the queue is a heap.  A group of any size
spans as many tasks as it has blocks, and ten billion leaves take four rounds.

The reversed sweep goes through the same blocks by descending labels and hands
every child its parent's proof below its own siblings; what enters a block is
the proof of its top node.

A proof is text: for every level from the leaf up, the digests left and right
of the node in its run, ``left|right``, and ``/`` between levels.

Cases
-----
* null group: a group of its own, before all others; null fields of a leaf
  differ from empty ones; null ids come first in their group;
* repeated ids are ordered by their leaves; repeated rows are leaves of their
  own, with proofs of their own;
* one row: leaf, subroot and root are the same, its proof is empty;
* texts of any length are hashed in the JVM and never moved;
* an empty table gives an empty result;
* other columns are not read, or carried through under any name (``keep``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import cut_lineage, map_batches
from skygrid.operators.ranks import rank_rows

ARITY = 3
LEVELS = 6
BLOCK = ARITY ** LEVELS


def digest(parts: Sequence[str]) -> str:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as its UTF-8 byte count, ``:`` and value, or ``-`` where it is null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def level_sizes(n: int, levels: int) -> list[int]:
    """Nodes per level of a block of ``n`` nodes, which ends after ``levels`` levels, or earlier at ``n`` = 1."""
    sizes = [n]
    while len(sizes) <= levels:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def depth(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    d = 0
    while n > 1:
        n, d = -(-n // ARITY), d + 1
    return d


def climb(leaves: Sequence[str], levels: int) -> list[list[str]]:
    """The digests of all nodes of a block, by level; the queue is ordered by the label of the receiver."""
    sizes = level_sizes(len(leaves), levels)
    nodes = [list(leaves)] + [[] for _ in sizes[1:]]
    start = [0]
    for n in sizes:
        start.append(start[-1] + n)

    def message(level: int, index: int, value: str):
        return start[level + 1] + index // ARITY, index, value
    queue = [message(0, i, d) for i, d in enumerate(leaves)] if levels else []
    heapify(queue)
    level = 1
    while queue:
        label, parts = queue[0][0], []
        while queue and queue[0][0] == label:
            parts.append(heappop(queue)[2])
        while label >= start[level + 1]:
            level += 1
        nodes[level].append(digest(parts))
        if level < levels:
            heappush(queue, message(level, label - start[level], nodes[level][-1]))
    return nodes


def sweep(nodes: list[list[str]], proof: str) -> list[str]:
    """The proofs of a block's lowest nodes, from that of its top, by descending labels."""
    above = [proof]
    for level in reversed(nodes[:-1]):
        below = [""] * len(level)
        for i in range(len(level) - 1, -1, -1):
            first = i - i % ARITY
            own = "".join(level[first:i]) + "|" + "".join(level[i + 1:first + ARITY])
            below[i] = f"{own}/{above[i // ARITY]}" if above[i // ARITY] else own
        above = below
    return above


def siblings(proof: str) -> str:
    """The digests of a proof, level by level, left to right."""
    return proof.replace("|", "").replace("/", "")


def fold_proof(leaf: str, proof: str) -> str:
    """The root that a leaf and a proof lead to."""
    for level in proof.split("/") if proof else ():
        left, _, right = level.partition("|")
        leaf = digest((left, leaf, right))
    return leaf


def _levels(n: int) -> int:
    return min(LEVELS, depth(n))


def _climb_block(nodes: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    n = nodes["n"][0].as_py()
    top = climb(nodes["digest"].to_pylist(), _levels(n))[-1][0]
    return pa.table({"grp": nodes["grp"][:1], "pos": nodes["block"][:1], "digest": [top],
                     "n": [-(-n // BLOCK)], "done": [n <= BLOCK]})


def _sweep_block(nodes: pa.Table, tops: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    levels = climb(nodes["digest"].to_pylist(), _levels(nodes["n"][0].as_py()))
    same = {c: pa.concat_arrays([tops[c].combine_chunks()[:1]] * len(nodes)) for c in ("subroot", "root")}
    return pa.table({"grp": nodes["grp"], "pos": nodes["pos"], "row": nodes["row"],
                     "proof": sweep(levels, tops["proof"][0].as_py()), **same})


class Tree:
    """The rounds of blocks above ranked nodes ``(grp, pos, digest, n, row)``; ``n`` is the group's nodes.

    ``row`` is anything that goes with a node; ``pos`` counts from 0.
    """

    def __init__(self, nodes: DataFrame):
        self.rounds, tops, kind = [], [], nodes.schema["row"].dataType
        block = F.expr(f"pos div {BLOCK}").alias("block")
        nodes = nodes.select("grp", "pos", "digest", "n", "row", block)
        while True:
            self.rounds.append(nodes)
            up = cut_lineage(nodes.groupBy("grp", "block").applyInArrow(
                _climb_block, "grp string, pos long, digest string, n long, done boolean"), "merkle")
            tops.append(up.where("done").select("grp", "digest", F.lit(len(self.rounds) - 1).alias("round")))
            rest = up.where("NOT done")
            if rest.isEmpty():
                break
            nodes = rest.select("grp", "pos", "digest", "n", F.lit(None).cast(kind).alias("row"), block)
        #: ``(grp, digest, round)``: the top of every group, and the round in which it was reached.
        self.tops = cut_lineage(reduce(DataFrame.unionByName, tops), "merkletops")

    def proofs(self, tops: DataFrame) -> DataFrame:
        """``(grp, pos, row, proof, subroot, root)`` of the lowest nodes, from ``(grp, round, proof, subroot, root)``."""
        kind = self.rounds[0].schema["row"].dataType.simpleString()
        found = None
        for k in reversed(range(len(self.rounds))):
            entering = tops.where(F.col("round") == k).select(
                "grp", F.lit(0).cast("long").alias("block"), "proof", "subroot", "root")
            if found is not None:
                entering = entering.unionByName(found.select(
                    "grp", F.col("pos").alias("block"), "proof", "subroot", "root"))
            found = self.rounds[k].groupBy("grp", "block").cogroup(entering.groupBy("grp", "block")).applyInArrow(
                _sweep_block, f"grp string, pos long, row {kind}, proof string, subroot string, root string")
            if k:
                found = cut_lineage(found, "proofs")
        return found


def prove(leaves: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf",
          keep: Sequence[str] = ()) -> DataFrame:
    """``(order, group, leaf, subroot, root, proof, *keep)``, one row per row of ``leaves``.

    ``leaves`` holds a digest per row; it is written to the shared folder
    once, so what it is made from is read once.
    """
    names = list(dict.fromkeys([order, group, leaf, *keep]))
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))     # null before all others
    rows = cut_lineage(leaves.select(grp.alias("grp"), F.col(order).alias("id"), F.col(leaf).alias("digest"),
                                     F.struct(*names).alias("row")), "leaves")
    counts = cut_lineage(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "leafcounts")
    ranked = rank_rows(rows, ["grp"], ["id", "digest"]).join(counts, "grp")
    below = Tree(cut_lineage(ranked.select("grp", (F.col("rank") - 1).alias("pos"), "digest", "n", "row"), "leaves"))
    groups = counts.count()
    if not groups:
        return rows.select("row.*", *[F.lit("").alias(c) for c in ("subroot", "root", "proof")])
    # The subroots: one more tree, of a single group.
    ordered = rank_rows(below.tops, [], ["grp"])
    above = Tree(cut_lineage(ordered.select(
        F.lit("").alias("grp"), (F.col("rank") - 1).alias("pos"), "digest", F.lit(groups).cast("long").alias("n"),
        F.struct("grp", "round", "digest").alias("row")), "subroots"))
    root = above.tops.select("grp", "round", F.lit("").alias("proof"), F.col("digest").alias("subroot"),
                             F.col("digest").alias("root"))
    entering = cut_lineage(above.proofs(root).select(
        F.col("row.grp").alias("grp"), F.col("row.round").alias("round"), "proof",
        F.col("row.digest").alias("subroot"), "root"), "subproofs")
    return below.proofs(entering).select("row.*", "subroot", "root", "proof")


def folded(proved: DataFrame, presented: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, proof_sha256, folded_root, verified)``: where the leaf ``presented`` leads with the row's proof."""
    keep = list(keep)
    rows = proved.select(*[F.col(c) for c in keep], F.col(presented).alias("presented leaf"),
                         F.col("proof").alias("its proof"), F.col("root").alias("its root"))
    kinds = ", ".join(f"`{c}` {proved.schema[c].dataType.simpleString()}" for c in keep)

    def run(batch: pa.RecordBatch):
        leaf, proof, root = (c.to_pylist() for c in batch.columns[-3:])
        ends = [fold_proof(a, p) for a, p in zip(leaf, proof, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-3], pa.array([digest((siblings(p),)) for p in proof], pa.string()),
             pa.array(ends, pa.string()), pa.array([a == b for a, b in zip(ends, root, strict=True)])],
            names=[*keep, "proof_sha256", "folded_root", "verified"])
    return map_batches(rows, run, f"{kinds}, proof_sha256 string, folded_root string, verified boolean")
