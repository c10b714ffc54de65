"""The contract of positions: every row a job works on has a finite RA and Decl.

A row without one is never placed in a cell and never dropped unseen.  Strict
handling (the default of all jobs) fails on the first such row; the lenient
way splits the input into good rows and rejects with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.cells import is_position
from skygrid.sources.schema import DECL, RA


def strict(col: str, what: str) -> Column:
    """The coordinate; fails where it is null or not finite."""
    return F.when(is_position(col), F.col(col)).otherwise(
        F.raise_error(F.concat(F.lit(f"{what} is not a finite number: "),
                               F.coalesce(F.col(col).cast("string"), F.lit("NULL")))).cast("double")).alias(col)


def require_positions(rows: DataFrame, ra: str = RA, decl: str | None = DECL) -> DataFrame:
    """``rows`` with both coordinates checked where they are read (a narrow projection)."""
    checked = {ra: strict(ra, "RA")} | ({decl: strict(decl, "Decl")} if decl else {})
    return rows.select(*[checked.get(c, F.col(c)) for c in rows.columns])


def reject_reason(raw: str, value: str, what: str) -> Column:
    """Why a coordinate is unusable, from its text and its parsed value; null if it is usable."""
    return (F.when(F.col(raw).isNull(), F.lit(f"{what} missing"))
            .when(F.col(value).isNull(), F.lit(f"{what} malformed"))
            .when(~is_position(value), F.lit(f"{what} not finite")))
