"""Pipeline stages on rows whose other columns have the names that the operators use inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL

NAMES = ["score", "accepted", "lang_pred", "margin_bytes", "document", "doc", "row", "__row", "__text", "id", "none",
         "first", "fingerprint", "component", "text_slice", "held_out"]


@pytest.mark.parametrize("stage", [corpus_pipeline.language_id, corpus_pipeline.near_dedup])
def test_stages_keep_columns_of_any_name(spark, stage):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = [(None, None), (900001, ""), (900002, None), (900003, "12 34"), (None, "der hund und die katze sind hier")]
    more = spark.createDataFrame(extra, "doc_id long, text string").select(
        "doc_id", "text", *[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns if c not in ("doc_id", "text")])
    docs = docs.unionByName(more)
    named = docs.select("*", *[F.lit(f"keep {c}").alias(c) for c in NAMES])
    plain = stage(spark, docs, SF_SMALL)
    out = stage(spark, named, SF_SMALL)
    assert out.columns == named.columns
    assert sorted(map(repr, out.select(docs.columns).collect())) == sorted(map(repr, plain.collect()))
    assert all(r[c] == f"keep {c}" for r in out.limit(5).collect() for c in NAMES)
    assert plain.count() > 50 and stage(spark, named.limit(0), SF_SMALL).count() == 0


def test_replaced_texts_keep_columns_of_any_name_and_many_mentions(spark):
    from skygrid.llm import pii
    names = ["news", "__n", "__row", "__parts", "__hits", "row", "doc", "hits", "parts", "pos", "new", "sub", "rebuilt",
             "mentions", "type", "canonical", "surrogate"]
    many = " ".join(f"word{k} user{k}@mail{k}.org," for k in range(20_000))
    texts = [None, "", "nothing here", "write to bob@x.org or ann@y.org, bob@x.org", many]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(
        "*", *[F.lit(f"keep {c}").alias(c) for c in names])
    out = {r.doc_id: r for r in pii.replace_personal_data(docs, "key", count_col="found").collect()}
    assert all(r[c] == f"keep {c}" for r in out.values() for c in names)
    assert [out[k].text for k in range(3)] == texts[:3] and [out[k].found for k in range(5)] == [0, 0, 0, 3, 20_000]
    a, b, c = out[3].text.removeprefix("write to ").replace(" or ", " ").replace(",", "").split()
    assert a == c != b and "bob" not in out[3].text
    words = out[4].text.split()
    assert words[::2] == [f"word{k}" for k in range(20_000)] and len(set(words[1::2])) == 20_000
