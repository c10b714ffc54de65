"""Catalogue schemas: the Source (107 columns) and Object (229 columns) tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, types and order as published; "!" marks columns
# that are never missing.
_SOURCE = """
    sourceId bigint!, scienceCcdExposureId bigint, filterId smallint!, objectId bigint,
    movingObjectId bigint, procHistoryId bigint!, ra double!, raSigmaForDetection double,
    raSigmaForWcs double!, decl double!, declSigmaForDetection double, declSigmaForWcs double!,
    htmId20 bigint!, xFlux double, xFluxSigma double, yFlux double, yFluxSigma double, raFlux double,
    raFluxSigma double, declFlux double, declFluxSigma double, xPeak double, yPeak double, raPeak double,
    declPeak double, xAstrom double, xAstromSigma double, yAstrom double, yAstromSigma double,
    raAstrom double, raAstromSigma double, declAstrom double, declAstromSigma double, raObject double,
    declObject double, taiMidPoint double!, taiRange double, psfFlux double, psfFluxSigma double,
    apFlux double, apFluxSigma double, modelFlux double, modelFluxSigma double, petroFlux double,
    petroFluxSigma double, instFlux double, instFluxSigma double, nonGrayCorrFlux double,
    nonGrayCorrFluxSigma double, atmCorrFlux double, atmCorrFluxSigma double, apDia double, Ixx double,
    IxxSigma double, Iyy double, IyySigma double, Ixy double, IxySigma double, psfIxx double,
    psfIxxSigma double, psfIyy double, psfIyySigma double, psfIxy double, psfIxySigma double,
    e1_SG double, e1_SG_Sigma double, e2_SG double, e2_SG_Sigma double, resolution_SG double,
    shear1_SG double, shear1_SG_Sigma double, shear2_SG double, shear2_SG_Sigma double,
    sourceWidth_SG double, sourceWidth_SG_Sigma double, shapeFlag_SG int, snr double!, chi2 double!,
    sky double, skySigma double, extendedness int, flux_Gaussian double, flux_Gaussian_Sigma double,
    flux_ESG double, flux_ESG_Sigma double, sersicN_SG double, sersicN_SG_Sigma double, radius_SG double,
    radius_SG_Sigma double, flux_flux_SG_Cov double, flux_e1_SG_Cov double, flux_e2_SG_Cov double,
    flux_radius_SG_Cov double, flux_sersicN_SG_Cov double, e1_e1_SG_Cov double, e1_e2_SG_Cov double,
    e1_radius_SG_Cov double, e1_sersicN_SG_Cov double, e2_e2_SG_Cov double, e2_radius_SG_Cov double,
    e2_sersicN_SG_Cov double, radius_radius_SG_Cov double, radius_sersicN_SG_Cov double,
    sersicN_sersicN_SG_Cov double, flagForAssociation int, flagForDetection bigint, flagForWcs int
"""
_OBJECT_HEAD = """
    objectId bigint!, iauId string, ra_PS double!, ra_PS_Sigma double, decl_PS double!,
    decl_PS_Sigma double, radecl_PS_Cov double, htmId20 bigint!, ra_SG double, ra_SG_Sigma double,
    decl_SG double, decl_SG_Sigma double, radecl_SG_Cov double, raRange double, declRange double,
    muRa_PS double, muRa_PS_Sigma double, muDecl_PS double, muDecl_PS_Sigma double,
    muRaDecl_PS_Cov double, parallax_PS double, parallax_PS_Sigma double, canonicalFilterId smallint,
    extendedness int, varProb double, earliestObsTime double, latestObsTime double, meanObsTime double,
    flags bigint
"""
# The columns of one photometric band, after the band's letter.
_OBJECT_BAND = """
    NumObs bigint, Extendedness int, VarProb double, RaOffset_PS double, RaOffset_PS_Sigma double,
    DeclOffset_PS double, DeclOffset_PS_Sigma double, RaDeclOffset_PS_Cov double, RaOffset_SG double,
    RaOffset_SG_Sigma double, DeclOffset_SG double, DeclOffset_SG_Sigma double,
    RaDeclOffset_SG_Cov double, LnL_PS double, LnL_SG double, Flux_PS double, Flux_PS_Sigma double,
    Flux_ESG double, Flux_ESG_Sigma double, Flux_Gaussian double, Flux_Gaussian_Sigma double,
    Timescale double, EarliestObsTime double, LatestObsTime double, SersicN_SG double,
    SersicN_SG_Sigma double, E1_SG double, E1_SG_Sigma double, E2_SG double, E2_SG_Sigma double,
    Radius_SG double, Radius_SG_Sigma double, Flags bigint
"""
_OBJECT_TAIL = "chunkId bigint, subChunkId bigint"
BANDS = "ugrizy"

_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(),
          "double": T.DoubleType(), "string": T.StringType()}


def _fields(columns: str, prefix: str = "") -> list[T.StructField]:
    """Fields of a column list; every column may be null when read from text."""
    out = []
    for column in columns.split(","):
        name, kind = column.split()
        out.append(T.StructField(prefix + name, _TYPES[kind.rstrip("!")], True, {"required": kind.endswith("!")}))
    return out


SOURCE_SCHEMA = T.StructType(_fields(_SOURCE))
OBJECT_SCHEMA = T.StructType(_fields(_OBJECT_HEAD)
                             + [f for band in BANDS for f in _fields(_OBJECT_BAND, band)]
                             + _fields(_OBJECT_TAIL))

# The Source columns every operator reads.
SOURCE_ID = "sourceId"
OBJECT_ID = "objectId"
RA = "ra"
DECL = "decl"


def position(schema: T.StructType, name: str) -> int:
    return schema.fieldNames().index(name)
