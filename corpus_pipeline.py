"""The corpus pipeline: five operators of ``skygrid.llm`` over ``documents``.

Each stage takes what its predecessor kept, whole; its output is written as
Parquet and read again.  All stages but the last return the columns of
``documents``; the last returns the encoded corpus.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.llm import bpe, decontam, langid, pii, simhash
from skygrid.llm.common import cut_lineage, table

RANKS = "byte_bpe_50k.tiktoken"
# A deployment passes its own secret; a fixed one keeps results comparable.
PII_KEY = "skygrid-demo-key"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go.

    Null and empty texts have no language and go; repeated rows are each kept
    or not; an empty table stays empty; columns may have any name.
    """
    dictionaries = langid.learn_dictionaries(docs)
    marked = langid.identify(docs, dictionaries, [F.struct(*docs.columns).alias("document")])
    return marked.where("accepted").select("document.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id.

    Texts without words form one group, null and empty ones included; of
    repeated rows one stays; null ids come last; an empty table stays empty;
    columns may have any name.
    """
    return simhash.drop_near_duplicates(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; ``n_chars`` follows the text."""
    return pii.replace_personal_data(docs, PII_KEY).withColumn(
        "n_chars", F.length("text").cast("long")).select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded corpus: ids and their number, and the text that the ids decode to."""
    path, keys = public_tokenizers.path(RANKS), ["doc_id", "lang", "source"]
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, [F.col(c) for c in keys])
    decoded = bpe.decode(encoded, path, public_tokenizers.PATTERN, [F.col(c) for c in (*keys, "ids")])
    return decoded.select(*keys, "ids", F.size("ids").cast("long").alias("n_tokens"),
                          F.col("bytes").cast("string").alias("decoded"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("replace_pii", replace_pii),
    ("tokenize", tokenize),
]

# Compression, fingerprints and keyed surrogates are not expressible in SQL;
# the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
