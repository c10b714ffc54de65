"""Language identification by compression with per-language dictionaries.

A text is compressed once per language with a zstandard raw-content
dictionary made of that language's training texts; the language whose
dictionary gives the fewest bytes wins.  Texts and dictionaries are compared
in lower case and by letters only.  Where the two best sizes lie too
close together the document is *rejected* (``accepted`` false).

Cases
-----
* null text, empty text, text without a letter: language ``und``, score 0,
  rejected;
* equal sizes: the first language in text order wins, and the margin of 0
  rejects the document;
* repeated rows: each row gets its own (equal) answer;
* no training rows at all: every document is ``und``;
* other columns of the input are neither read nor passed on.
"""

from __future__ import annotations

import math

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import map_batches

UNDETERMINED = "und"
# Bounded training sample: about this many documents per language feed a
# dictionary, each with at most SNIPPET characters, up to DICT_BYTES in all.
DOCS_PER_LANGUAGE = 300
SNIPPET = 2_000
DICT_BYTES = 96 * 1024
LEVEL = 3
# A margin below FINE_MARGIN bytes is settled by encoding the whole text again
# at this slower level (matches of three bytes) behind a primer, PRIMER bytes
# of the same dictionary: alone, a few words are stored raw whatever the
# dictionary; behind a primer they are coded by its letter statistics.
FINE_LEVEL = 19
FINE_MARGIN = 12
PRIMER = 2_048
# Rejection: the runner-up must need at least this many more bytes.
MIN_MARGIN_BYTES = 1


def _folded(text: Column) -> Column:
    """Lower case, every run of other characters than letters as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))


def learn_dictionaries(train: DataFrame, text_col: str = "text", lang_col: str = "lang",
                       docs_per_language: int = DOCS_PER_LANGUAGE,
                       dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Raw-content dictionaries by language from a bounded, hash-chosen sample.

    Rows with a null or letterless text, or a null language, teach nothing.
    The sample holds about ``docs_per_language`` texts of each language
    (all, if a language has fewer), chosen by a hash of the text, so it
    depends neither on row order nor on how often a text is repeated.
    """
    text, lang = F.col(text_col), F.col(lang_col)
    usable = train.where(text.isNotNull() & lang.isNotNull()).select(
        lang.alias("lang"), text.alias("text"), F.xxhash64(text).alias("h"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # A share of the 2^32 hash range per language that yields the wanted number.
    share = F.create_map(*[F.lit(x) for lg, n in sorted(counts.items())
                           for x in (lg, min(1.0, 1.2 * docs_per_language / n))])
    u = F.pmod(F.col("h"), F.lit(1 << 32)) / float(1 << 32)
    rows = (usable.where((u < share[F.col("lang")]) & F.col("text").rlike(r"\p{L}"))
            .select("lang", "h", F.substring(_folded(F.col("text")), 1, SNIPPET).alias("text"))
            .dropDuplicates(["lang", "h"]).collect())
    by_lang: dict[str, list] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((r["h"], r["text"]))
    # Every language gets the same number of bytes at most; the end of a
    # dictionary is the cheapest to refer to.
    return {lg: "\n".join(t for _, t in sorted(texts)).encode()[-dict_bytes:]
            for lg, texts in sorted(by_lang.items())}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_cols: list[Column],
             text_col: str = "text", min_margin: int = MIN_MARGIN_BYTES) -> DataFrame:
    """``id_cols`` plus ``lang_pred, score, margin_bytes, accepted`` for every row.

    ``score`` is the winner's share of ``exp(-bytes)`` over the languages;
    ``margin_bytes`` the runner-up's extra bytes (null for a single language
    or ``und``).
    """
    langs = list(dictionaries)
    keyed = docs.select(*id_cols, _folded(F.col(text_col)).alias("__text"),
                        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    n_ids = len(id_cols)
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:n_ids])
    out_schema += ", lang_pred string, score double, margin_bytes long, accepted boolean"
    state: dict = {}

    def compressor(lg: str, level: int):
        if (lg, level) not in state:
            d = zstandard.ZstdCompressionDict(dictionaries[lg], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            state[lg, level] = zstandard.ZstdCompressor(
                level=level, dict_data=d, write_checksum=False, write_content_size=False,
                write_dict_id=False)
        return state[lg, level]

    def coarse(raw, lg: str) -> int:
        return len(compressor(lg, LEVEL).compress(raw))

    def fine(raw, lg: str) -> int:
        primer = dictionaries[lg][:PRIMER]
        if lg not in state:
            state[lg] = len(compressor(lg, FINE_LEVEL).compress(primer))
        return len(compressor(lg, FINE_LEVEL).compress(primer + bytes(raw))) - state[lg]

    def ranked(raw, size) -> tuple[list[int], list[int]]:
        sizes = [size(raw, lg) for lg in langs]
        return sizes, sorted(range(len(sizes)), key=sizes.__getitem__)

    def predict(batch: pa.RecordBatch):
        pred, score, margin, accepted = [], [], [], []
        for text, letters in zip(batch.column(n_ids), batch.column(n_ids + 1), strict=True):
            if not letters.as_py() or not langs:
                pred.append(UNDETERMINED), score.append(0.0), margin.append(None), accepted.append(False)
                continue
            raw = text.as_buffer()
            sizes, order = ranked(raw, coarse)
            if len(order) > 1 and sizes[order[1]] - sizes[order[0]] < FINE_MARGIN:
                sizes, order = ranked(raw, fine)
            best = sizes[order[0]]
            gap = sizes[order[1]] - best if len(order) > 1 else None
            pred.append(langs[order[0]])
            score.append(1.0 / sum(math.exp(best - s) for s in sizes))
            margin.append(gap)
            accepted.append(gap is None or gap >= min_margin)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(n_ids)]
            + [pa.array(pred, pa.string()), pa.array(score, pa.float64()),
               pa.array(margin, pa.int64()), pa.array(accepted, pa.bool_())],
            names=[batch.schema.names[i] for i in range(n_ids)]
            + ["lang_pred", "score", "margin_bytes", "accepted"])

    return map_batches(keyed, predict, out_schema)
