"""Centroid clustering, Merkle manifest and exact dedup: brute force, awkward rows, clashing columns."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skygrid.llm import centroids, exact_dedup, merkle


# Centroid clustering ---------------------------------------------------------

def _plain_nearest(x, cents):
    d = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents] for v in x.tolist()]
    return [min(range(len(cents)), key=lambda k: (row[k], k)) for row in d], [min(row) for row in d]


@pytest.mark.parametrize("k,dims,spread", [(1, 3, 9), (2, 1, 4), (8, 5, 3), (40, 4, 50), (60, 2, 10**6)])
def test_threshold_walk_equals_all_distances(k, dims, spread):
    rng = np.random.default_rng(k)
    cents = rng.integers(-spread, spread + 1, (k, dims)).astype(np.int64)      # small spreads: many ties
    x = rng.integers(-spread, spread + 1, (300, dims)).astype(np.int64)
    x[:k] = cents
    who, dist = centroids.nearest(x, cents)
    assert (who.tolist(), dist.tolist()) == _plain_nearest(x, cents.tolist())


def test_walk_stops_before_it_has_met_all(monkeypatch):
    """Far centroids are never given an exact distance."""
    cents = np.arange(1000, dtype=np.int64)[:, None] * 1000
    counted = []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda s, a, b: counted.append(len(a)) or einsum(s, a, b))
    who, dist = centroids.nearest(np.array([[500_400]]), cents)
    assert (who.tolist(), dist.tolist()) == ([500], [160_000])
    assert sum(counted[::2]) <= 4


def _plain_cluster(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    cents = [q for _, q in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for r in range(rounds + 1):
        placed = [min(range(len(cents)), key=lambda c: (sum((a - b) ** 2 for a, b in zip(q, cents[c], strict=True)), c))
                  for _, q in kept]
        if r < rounds:
            for c in set(placed):
                own = [q for (_, q), p in zip(kept, placed, strict=True) if p == c]
                cents[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    dist = [sum((a - b) ** 2 for a, b in zip(q, cents[p], strict=True)) for (_, q), p in zip(kept, placed, strict=True)]
    inertia = defaultdict(int)
    for p, d in zip(placed, dist, strict=True):
        inertia[p] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, p, d, inertia[p], sum(dist), sha[p]) for (i, _), p, d in zip(kept, placed, dist, strict=True)]


def test_clustering_of_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(k, rng.normal(0, 1, 64).tolist()) for k in range(120)]
    good += [(k, good[0][1]) for k in range(200, 260)]          # a large group of equal vectors
    good += [good[7], (300, [0.0] * 64)]                        # a repeated row, zeros
    bad = [(400, None), (401, []), (402, [1.0] * 63), (403, [None] + [1.0] * 63), (404, [float("nan")] * 64),
           (405, [float("inf")] + [0.0] * 63)]
    beyond = [(500, [1e300] + [0.0] * 63), (501, [-131073.0] * 64)]
    df = spark.createDataFrame([*good, *bad, *beyond], "vec_id long, embedding array<double>")
    df = df.select("*", *[F.lit(c).alias(c) for c in ("id", "vector", "cluster", "distance", "of", "n")]).repartition(5)
    got = sorted(map(tuple, centroids.cluster(df).collect()), key=repr)
    want = _plain_cluster(good) + [(i, None, None, None, None, None) for i, _ in beyond]
    assert got == sorted(want, key=repr)
    few = centroids.cluster(df.where("vec_id IN (3, 5)"))
    assert sorted(r.cluster for r in few.collect()) == [0, 1]
    assert centroids.cluster(df.limit(0)).collect() == []
    unnamed = centroids.cluster(df.where("vec_id = 3").withColumn("vec_id", F.lit(None).cast("long"))).collect()
    assert [(r.vec_id, r.cluster) for r in unnamed] == [(None, None)]


# Merkle manifest -------------------------------------------------------------

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _plain_tree(leaves):
    """Levels of digests, and the siblings of each leaf as (left, right) per level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([_h(*low[k:k + 3]) for k in range(0, len(low), 3)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            first = i // 3 * 3
            path.append(("".join(level[first:i]), "".join(level[i + 1:first + 3])))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 700])
def test_blocks_equal_a_plain_tree(n):
    leaves = [_h(str(k)) for k in range(n)]
    top, paths = _plain_tree(leaves)
    nodes = merkle.climb(leaves, merkle.depth(n))
    assert nodes[-1] == [top]
    proofs = merkle.sweep(nodes, "")
    assert proofs == ["/".join(f"{a}|{b}" for a, b in p) for p in paths]
    assert {merkle.fold_proof(d, p) for d, p in zip(leaves, proofs, strict=True)} == {top}
    assert n == 1 or merkle.fold_proof(_h("other"), proofs[0]) != top


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        leaf = _h(*map(_field, r))
        presented = leaf
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
            presented = _h(*map(_field, [*r[:4], r[4].replace("\n", "")]))
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf, presented, r[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s], key=lambda x: x[:3]),) for s in order}
    trees = {s: (own[0], *_plain_tree([x[2] for x in own[0]])) for s, own in trees.items()}
    root, above = _plain_tree([trees[s][1] for s in order])
    out = []
    for k, s in enumerate(order):
        own, subroot, paths = trees[s]
        for (_, _, leaf, presented, doc_id), path in zip(own, paths, strict=True):
            digest = presented
            for left, right in [*path, *above[k]]:
                digest = _h(left, digest, right)
            out.append((doc_id, leaf, subroot, root, _h(*[a + b for a, b in [*path, *above[k]]]), digest, digest == root))
    return out


def _manifest(df):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = merkle.leaf_digest([*fields[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    leaf = merkle.leaf_digest(fields)
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    leaves = df.select("*", leaf.alias("leaf"), F.when(even, tampered).otherwise(leaf).alias("presented"))
    return merkle.folded(merkle.prove(leaves, keep=["presented"]), "presented", ["doc_id", "leaf", "subroot", "root"])


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_manifest_of_awkward_rows(spark):
    rnd = random.Random(4)
    rows = [(k, "hot", "en", 4, f"text\n{k}") for k in range(2300)]              # several blocks, two rounds
    rows += [(k, f"s{k % 41}", None, k, rnd.choice(["", "a\nb", None, "é\n∂"])) for k in range(3000, 3200)]
    rows += [(9000, None, "en", None, "no source\n"), (9001, "", "en", 1, "empty source"), (9002, "-", "en", 1, "dash"),
             (9003, "é", "en", 1, "x"), (9004, "z", "en", 1, "y"), (9005, "lone", "en", 1, "l" * 300_000)]
    rows += [(None, "nulls", "en", 1, "a"), (None, "nulls", "en", 1, "b"), (7, "nulls", "en", 1, "a")]
    rows += [(9100, "twice", "en", 1, "same\n")] * 4 + [(9100, "twice", "en", 1, "other")]
    assert 2300 > merkle.BLOCK * 3
    clash = ("grp", "pos", "digest", "n", "row", "block", "proof", "root", "subroot", "id", "rank", "ended")
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(c).alias(c) for c in clash]).repartition(7)
    got = sorted(map(tuple, _manifest(df).collect()), key=repr)
    assert got == sorted(_plain_manifest(rows), key=repr)
    assert 100 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_manifest_of_few_rows(spark, n):
    rows = [(k, "a", "en", 1, "t") for k in range(n)]
    assert sorted(map(tuple, _manifest(spark.createDataFrame(rows, SCHEMA)).collect())) == sorted(
        _plain_manifest(rows) if rows else [])


# Exact dedup -----------------------------------------------------------------

def test_chunks_join_to_the_text_and_follow_the_content():
    rnd = random.Random(2)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(60_000))
    texts = ["", "x", "a" * 50_000, passage, "some words before it " + passage, "é" * 4000, passage[:700] * 900]
    parts = [list(c) for c in exact_dedup.chunked(pa.array(["skip", *texts, "tail"]).slice(1, len(texts)))]
    assert ["".encode().join(c) for c in parts] == [t.encode() for t in texts]
    assert all(len(c) <= exact_dedup.MAX_CHUNK for p in parts for c in p)
    assert all(len(c) >= exact_dedup.MIN_CHUNK for p in parts for c in p[:-1])
    shared = set(parts[3]) & set(parts[4])
    assert len(shared) >= len(parts[3]) - 3 > 5          # cuts depend on the content, not on the place


def test_cuts_do_not_depend_on_slices(monkeypatch):
    data = np.random.default_rng(0).integers(0, 256, 300_000).astype(np.uint8)
    whole = exact_dedup.candidates(data)
    monkeypatch.setattr(exact_dedup, "_SLICE", 1000)
    # The first window of the text is shorter; every later position agrees.
    assert exact_dedup.candidates(data).tolist() == whole.tolist() and len(whole) > 100


@pytest.mark.parametrize("hash_bytes", [16, 1])
def test_equal_texts_of_awkward_rows(spark, hash_bytes):
    """With hashes of one byte nearly all chunks share one: identifiers must still be verified."""
    rnd = random.Random(hash_bytes)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(40_000))
    swapped = long[20_000:] + long[:20_000]
    texts = [None, "", " ", "", "one", "One", "one ", long, long, long + "!", swapped, "é", "é"]
    texts += [f"text {k % 90}" for k in range(300)] + ["hot"] * 200
    rows = list(enumerate(texts)) + [(4, "one"), (4, "one"), (None, "one"), (None, "only null"), (None, "only null")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit(c).alias(c) for c in ("id", "row", "recipe", "of", "hash", "content", "keep_id", "n")]).repartition(6)
    got = defaultdict(list)
    for r in exact_dedup.equal_texts(df, hash_bytes=hash_bytes).collect():
        got[r.text_sha256].append((r.doc_id, r.keep_id, r.group_size, r.kept))
    want = defaultdict(list)
    for k, t in rows:
        want[hashlib.sha256((t or "").encode()).hexdigest()].append(k)
    assert got.keys() == want.keys()
    for sha, ids in want.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        assert sorted(r[0] for r in got[sha] if r[0] is not None) == sorted(known) and len(got[sha]) == len(ids)
        assert {r[1:3] for r in got[sha]} == {(keep, len(ids))}
        assert [r[0] for r in got[sha] if r[3]] == [keep]       # exactly one row stays
    assert exact_dedup.equal_texts(df.limit(0)).collect() == []


def test_chunk_store_holds_every_content_once(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcd ") for _ in range(9000)) for _ in range(5)] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    store = exact_dedup.chunk_store(df).collect()
    want = {c for chunks in exact_dedup.chunked(pa.array(texts)) for c in chunks}
    assert sorted(bytes(r.content) for r in store) == sorted(want)
    recipe = {r.id: bytes(r.recipe) for r in exact_dedup.recipes(df).collect()}
    by_hash = {bytes(r.hash): bytes(r.content) for r in store}
    for k, text in enumerate(texts):
        assert b"".join(by_hash[recipe[k][i:i + 16]] for i in range(0, len(recipe[k]), 16)) == text.encode()
