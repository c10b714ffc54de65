"""Scans of catalogue files and of the driver's Parquet tables."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.functions.coords import NULL_TOKEN
from skygrid.sources.schema import DECL, OBJECT_ID, RA, SOURCE_ID, OBJECT_SCHEMA, SOURCE_SCHEMA

# The catalogue text format (headerless, comma separated, no
# quoting, fields trimmed, the literal NULL for missing values).
DELIMITER = ","
_BLANKS = " \t\r\n\f\v"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line (column ``value``) of a file or directory."""
    return spark.read.text(path)


def _csv_reader(spark: SparkSession, schema: T.StructType, mode: str):
    return (spark.read.schema(schema)
            .option("sep", DELIMITER)
            .option("header", False)
            .option("quote", "")
            .option("nullValue", NULL_TOKEN)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .option("mode", mode))


def text_positions(schema: T.StructType) -> T.StructType:
    """The schema with RA and Decl still as text, for a reader that must not hide bad numbers."""
    return T.StructType([T.StructField(f.name, T.StringType(), True, f.metadata) if f.name in (RA, DECL) else f
                         for f in schema.fields])


def parsed_positions(raw: DataFrame) -> DataFrame:
    """RA and Decl of a text-position scan as numbers; a malformed number fails.

    A missing value stays null: jobs that need positions refuse it (see
    ``operators.positions``).
    """
    def number(c: str) -> Column:
        value = F.col(c).try_cast("double")
        return F.when(F.col(c).isNotNull() & value.isNull(), F.raise_error(
            F.concat(F.lit(f"{c} is not a number: "), F.col(c))).cast("double")).otherwise(value).alias(c)
    return raw.select(*[number(c) if c in (RA, DECL) else F.col(c) for c in raw.columns])


def read_sources(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Source catalogue text files with the 107-column schema.

    Column pruning reaches the CSV parser, so a 4-column projection parses
    only those fields.  A typed field that is read and is no value of its type
    fails, it never becomes a silent null; a short line fails where the whole
    line is read.  RA and Decl are parsed strictly in every mode.
    """
    return parsed_positions(_csv_reader(spark, text_positions(SOURCE_SCHEMA), mode).csv(path))


def read_checked_sources(spark: SparkSession, path: str, fields=(SOURCE_ID, OBJECT_ID, RA, DECL),
                         whole_lines: bool = False) -> DataFrame:
    """Source rows with a verdict per field; nothing fails and no line is dropped (blank ones aside).

    The file is read as lines.  Columns: ``fields``, null where their text is
    no value of their type; ``ra_text`` and ``decl_text``, what the file says;
    ``errors``, an array of ``(field, reason)`` for every field asked for that
    is ``malformed``, ``missing`` though required, or ``not finite`` (RA and
    Decl), and for the ``line`` where it is ``short`` or ``long``; and
    ``reject``, the first error that makes the row unusable -- positions
    first, then the other fields, and short or long lines if ``whole_lines``
    (surplus fields are ignored otherwise, and missing ones count only where
    they are asked for).
    """
    from skygrid.operators.positions import reject_reason
    names = SOURCE_SCHEMA.fieldNames()
    # A line is split once, as far as the last field asked for.  The fields come
    # out of a generator, since a filter on a verdict would otherwise be pushed
    # below the split, which then runs for every mention of a field in it.
    # A line is blank if nothing is left behind its leading blanks: the rest of it need not be looked at.
    lines = spark.read.text(path).where(F.ltrim("value", F.lit(_BLANKS)) != "")
    last = max((names.index(c) for c in fields), default=0)
    tokens = lines.select(
        (F.length("value") - F.length(F.replace("value", F.lit(DELIMITER), F.lit(""))) + 1).alias("n_fields"),
        F.split("value", DELIMITER, last + 2).alias("token"))

    def text(c: str) -> Column:
        token = F.btrim(F.get("token", F.lit(names.index(c))), F.lit(_BLANKS))
        return F.when(token != NULL_TOKEN, token)
    raw = tokens.select("n_fields", F.inline(F.array(F.struct(*[text(c).alias(f"{c}_text") for c in fields]))))
    typed = raw.select("*", *[F.col(f"{c}_text").try_cast(SOURCE_SCHEMA[c].dataType).alias(c) for c in fields])

    def reason(c: str) -> Column:
        if c in (RA, DECL):
            return reject_reason(f"{c}_text", c, "").substr(F.lit(2), F.lit(20))
        missing = F.lit("missing") if SOURCE_SCHEMA[c].metadata["required"] else F.lit(None).cast("string")
        return F.when(F.col(f"{c}_text").isNull(), missing).when(F.col(c).isNull(), F.lit("malformed"))
    found = {c: reason(c) for c in fields} | {
        "line": F.when(F.col("n_fields") < len(names), "short").when(F.col("n_fields") > len(names), "long")}
    order = [c for c in (RA, DECL) if c in fields] + [c for c in fields if c not in (RA, DECL)]
    none = F.array().cast("array<struct<field:string,reason:string>>")
    errors = F.concat(*[F.when(found[c].isNotNull(), F.array(F.struct(F.lit(c).alias("field"), found[c].alias("reason"))))
                        .otherwise(none) for c in [*order, "line"]])
    label = {RA: "RA", DECL: "Decl"}
    reject = F.coalesce(*[F.concat(F.lit(label.get(c, c) + " "), found[c]) for c in order + ["line"] * whole_lines])
    texts = [f"{c}_text" for c in (RA, DECL) if c in fields]
    return typed.select(*fields, *texts, errors.alias("errors"), reject.alias("reject"))


def read_objects(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Object catalogue text files with the 229-column schema."""
    return _csv_reader(spark, OBJECT_SCHEMA, mode).csv(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sky_from_events(events: DataFrame) -> DataFrame:
    """Deterministic stand-in catalogue derived from the ``events`` table.

    Columns ``sourceId, objectId, ra, decl``; RA lies within 2 degrees of 0
    across the wrap and Decl in [-7, 7), the footprint of the real survey.
    Integer arithmetic happens before the single double division so every
    engine computes bit-identical coordinates.
    """
    k = (F.col("event_id") * 7919 + F.col("user_id") * 37) % 4000
    m = (F.col("event_id") * 104729 + F.col("user_id") * 13) % 14000
    thousand = F.lit(1000.0)
    ra = (F.when(k < 2000, F.lit(358.0) + k.cast("double") / thousand)
          .otherwise((k - 2000).cast("double") / thousand))
    decl = m.cast("double") / thousand - F.lit(7.0)
    return events.select(
        F.col("event_id").alias(SOURCE_ID),
        F.when(F.col("event_type") == "error", F.lit(None).cast("bigint"))
         .otherwise(F.col("user_id")).alias(OBJECT_ID),
        ra.alias(RA),
        decl.alias(DECL),
    )


def sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sky_from_events(table(spark, sf_dir, "events"))


def source_lines(sources: DataFrame, keep=()) -> DataFrame:
    """Render rows in the catalogue text layout (``value`` column, and the columns ``keep``).

    Every Source column is written in DDL order; columns the frame lacks are
    written as the null token.  Doubles use Java's shortest round-trip text,
    so reading the lines back gives the identical values.
    """
    present = set(sources.columns)
    # Neighbouring columns that the frame lacks are one literal: most of a line is made once, not per row.
    parts: list[Column] = []
    for here, fields in groupby(SOURCE_SCHEMA.fieldNames(), present.__contains__):
        if here:
            parts += [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in fields]
        else:
            parts.append(F.lit(DELIMITER.join(NULL_TOKEN for _ in fields)))
    return sources.select(F.concat_ws(DELIMITER, *parts).alias("value"), *keep)


def write_source_files(sources: DataFrame, path: str) -> None:
    """Write a frame as catalogue text files (refuses an existing path)."""
    source_lines(sources).write.mode("errorifexists").text(path)
