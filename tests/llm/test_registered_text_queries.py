"""Registered queries without SQL, over all documents of the small tables: libraries and plain loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from conftest import SF_SMALL

from skygrid.llm import bpe, queries


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_byte_bpe_query(spark, texts):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Vocabulary(path).ranks,
                            special_tokens={})
    rows = queries.op6_byte_bpe(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = lib.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_token_counts_query(spark, texts):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.no_truncation(), lib.no_padding()
    rows = queries.op7_token_counts(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n = len(lib.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_lm_scoring_query(spark, texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower)) for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in [*ws, None])
    n, kinds = sum(counts.values()), len(counts)
    rows = queries.op4_lm_scoring(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        own = [counts[w] for w in [*words[r.doc_id], None]]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[r.doc_id], len(own), sum(c > 0 for c in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c + 1) / (n + kinds + 1)) for c in own), rel=1e-9)
        assert r.score < 0
