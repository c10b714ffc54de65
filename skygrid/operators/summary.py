"""Per-object and global summaries.

Every aggregate here is distributive, so Catalyst plans a partial
(map-side) aggregate before the shuffle: a hot object that holds a third of
all rows sends one partial row per map task, never its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.cells import Zone
from skygrid.functions.coords import wrap_ra, zone_text
from skygrid.operators.positions import require_positions
from skygrid.sources.schema import DECL, OBJECT_ID, RA, SOURCE_ID


def count_by_object(sources: DataFrame, key: str = OBJECT_ID) -> DataFrame:
    """Observations per object; rows without an object are excluded."""
    return (sources.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("n_sources")))


_MAX_DIGITS = 19  # digits of the largest 64-bit id


def _digits_below(v: Column, offset: int = 0) -> Column:
    """Digits of ``v + offset`` for ``v + offset`` >= 0, by comparisons only."""
    n = F.lit(_MAX_DIGITS)
    for k in range(_MAX_DIGITS - 1, 0, -1):
        n = F.when(v < F.lit(10 ** k - offset), F.lit(k)).otherwise(n)
    return n


_LONG_MIN = -(2 ** 63)


def _with_text_order_columns(df: DataFrame, sid: str) -> DataFrame:
    """Per-row helper columns for :func:`_latest_text_aggregates`.

    ``_d``: digits of ``|v|``; ``_e``: an order-preserving code -- ``v`` for
    ``v >= 0`` and ``MIN + (|v| - 1)`` (in ``[MIN, -1]``, no overflow) for
    ``v < 0`` -- so every non-negative id outranks every negative one, and
    within one digit count a larger magnitude ranks higher, as in text order.
    """
    v = F.col(sid)
    return (df.withColumn("_e", F.when(v >= 0, v).otherwise(-(v + 1) + F.lit(_LONG_MIN)))
            .withColumn("_d", F.when(v >= 0, _digits_below(v))
                        .otherwise(_digits_below(-(v + 1), 1))))


def _latest_text_aggregates() -> tuple[list[Column], Column]:
    """Aggregates and final expression for the text-greatest id.

    Ids with the same number of digits compare as text exactly as they do
    as numbers, so one pass keeps a plain maximum of the code per digit
    count -- 19 long buffers, hash aggregation, no per-row strings or
    decimals -- and the text-greatest candidate is chosen once per group.
    Negative ids ("-" sorts below every digit) only win in a group without
    any other id.  Needs the columns of :func:`_with_text_order_columns`.
    """
    digits = range(1, _MAX_DIGITS + 1)
    aggs = [F.max(F.when(F.col("_d") == n, F.col("_e"))).alias(f"_t{n}") for n in digits]
    # Arrays: their code is split into small methods, which stay compiled.
    pos_text = F.array_max(F.array(*[F.when(F.col(f"_t{n}") >= 0, F.col(f"_t{n}").cast("string"))
                                     for n in digits]))
    neg_text = F.array_max(F.array(*[
        F.when(F.col(f"_t{n}") < 0, F.concat(F.lit("-"), (
            F.col(f"_t{n}").cast("decimal(20,0)") - F.lit(_LONG_MIN).cast("decimal(20,0)") + 1)
            .cast("decimal(20,0)").cast("string")))
        for n in digits]))
    return aggs, F.coalesce(pos_text, neg_text)


def object_extent(sources: DataFrame, key: str = OBJECT_ID, source_id: str = SOURCE_ID,
                  ra: str = RA, decl: str = DECL) -> DataFrame:
    """Per object: count, latest source id and the RA/Decl extent.

    "Latest" compares source ids as text, as the catalogue tools do; it
    equals the numeric maximum only for ids of equal length (see
    :func:`_latest_text_aggregates`: every aggregate buffer is fixed-width).
    """
    latest_aggs, latest = _latest_text_aggregates()
    rows = _with_text_order_columns(sources.where(F.col(key).isNotNull()), source_id)
    agg = (rows.groupBy(key)
           .agg(F.count(F.lit(1)).alias("n_sources"), *latest_aggs,
                F.min(ra).alias("min_ra"), F.max(ra).alias("max_ra"),
                F.min(decl).alias("min_decl"), F.max(decl).alias("max_decl")))
    return agg.select(key, "n_sources", latest.alias("last_source_id"),
                      "min_ra", "max_ra", "min_decl", "max_decl")


def merge_extents(extents: DataFrame, key: str = OBJECT_ID) -> DataFrame:
    """One :func:`object_extent` from several of disjoint rows: counts add up, extents and latest ids are compared.

    The result has the same columns, so it can be merged again.
    """
    latest_aggs, latest = _latest_text_aggregates()
    rows = _with_text_order_columns(extents.withColumn("_last", F.col("last_source_id").cast("bigint")), "_last")
    merged = rows.groupBy(key).agg(
        F.sum("n_sources").alias("n_sources"), *latest_aggs, F.min("min_ra").alias("min_ra"),
        F.max("max_ra").alias("max_ra"), F.min("min_decl").alias("min_decl"), F.max("max_decl").alias("max_decl"))
    return merged.select(key, "n_sources", latest.alias("last_source_id"), "min_ra", "max_ra", "min_decl", "max_decl")


def bounding_zone(positions: DataFrame, ra: str = RA, decl: str = DECL) -> DataFrame:
    """One row: the RA/Decl bounding box of every row (object or not)."""
    return positions.agg(F.min(ra).alias("min_ra"), F.max(ra).alias("max_ra"),
                         F.min(decl).alias("min_decl"), F.max(decl).alias("max_decl"))


def bounding_zone_wrapped(positions: DataFrame, ra: str = RA, decl: str = DECL) -> DataFrame:
    """Bounding box after moving RA above 180 to negative values."""
    return bounding_zone(positions.select(wrap_ra(ra).alias(ra), F.col(decl)), ra, decl)


def zone_of(positions: DataFrame, ra: str = RA, decl: str = DECL) -> Zone:
    """Collect the (single-row) bounding box to the driver as grid bounds."""
    row = bounding_zone(require_positions(positions, ra, decl), ra, decl).first()
    if row is None or row["min_ra"] is None:
        raise ValueError("cannot build a grid over an empty input")
    return Zone(float(row["min_ra"]), float(row["max_ra"]),
                float(row["min_decl"]), float(row["max_decl"]))


def zone_description(zone_df: DataFrame) -> DataFrame:
    """Text form of a bounding-box row."""
    return zone_df.select(zone_text("min_ra", "max_ra", "min_decl", "max_decl").alias("zone"))


def count_lines_containing(lines: DataFrame, needles=("a", "b"), col: str = "value") -> DataFrame:
    """Lines containing each needle (case-sensitive), in one pass over the data."""
    return lines.agg(*[F.count_if(F.col(col).contains(n)).alias(f"lines_with_{n}")
                       for n in needles])
