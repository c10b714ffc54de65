"""Column expressions on sky coordinates (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# RA wraps at 360 degrees; points above 180 are moved to
# negative RA so a footprint straddling RA = 0 becomes contiguous.
RA_WRAP_AT = 180.0
NULL_TOKEN = "NULL"     # how catalogue text writes a missing value
FULL_CIRCLE = 360.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def wrap_ra(ra) -> Column:
    """``ra - 360`` above 180, unchanged otherwise (180 itself stays)."""
    ra = _c(ra)
    return F.when(ra > F.lit(RA_WRAP_AT), ra - F.lit(FULL_CIRCLE)).otherwise(ra)


def unwrap_ra(ra) -> Column:
    """Inverse of :func:`wrap_ra`: negative RA moves back up by 360."""
    ra = _c(ra)
    return F.when(ra < F.lit(0.0), ra + F.lit(FULL_CIRCLE)).otherwise(ra)


def log_bar(count) -> Column:
    """``'*' * ceil(log10(count))``: 1 -> '', 10 -> '*', 11 -> '**'."""
    return F.repeat(F.lit("*"), F.ceil(F.log10(_c(count).cast("double"))).cast("int"))


def format_record(*cols) -> Column:
    """Comma-joined text of the values (Java number text, as the catalogue uses).

    A missing value is written as the catalogue's null token, so the fields
    behind it keep their places.
    """
    return F.concat_ws(",", *[F.coalesce(_c(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols])


def zone_text(min_ra, max_ra, min_decl, max_decl) -> Column:
    """Bounding-box text with six decimals per bound."""
    # Fixed value: the box text format.
    return F.format_string("minRA : %f, maxRA : %f, minDecl : %f, maxDecl : %f",
                           _c(min_ra), _c(max_ra), _c(min_decl), _c(max_decl))


def haversine_term(ra1, decl1, ra2, decl2, cos1=None, cos2=None) -> Column:
    """``hav(angular separation)`` of two positions given in degrees.

    Comparing this term with :func:`haversine_threshold` avoids an ``asin``
    per pair; the comparison is monotone in the separation.  Columns that hold
    the cosines of both Decl already may be given.
    """
    r1, d1, r2, d2 = (F.radians(_c(c)) for c in (ra1, decl1, ra2, decl2))
    s_dec = F.sin((d2 - d1) / F.lit(2.0))
    s_ra = F.sin((r2 - r1) / F.lit(2.0))
    c1, c2 = (F.cos(d) if c is None else _c(c) for c, d in ((cos1, d1), (cos2, d2)))
    return s_dec * s_dec + c1 * c2 * s_ra * s_ra


def haversine_threshold(eps_deg: float) -> float:
    s = math.sin(math.radians(eps_deg) / 2.0)
    return s * s


def separation_deg(ra1, decl1, ra2, decl2) -> Column:
    """Great-circle separation in degrees (haversine formula)."""
    h = haversine_term(ra1, decl1, ra2, decl2)
    return F.degrees(F.lit(2.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h))))
