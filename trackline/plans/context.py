"""Shared building blocks for the registered queries: test tables -> typed frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.numeric import round_half_up
from trackline.operators.clean import clean
from trackline.operators.tracks import track_legs, vessel_metrics
from trackline.sources.fixture import raw_positions

ROUND_DIGITS = 6


def round_double(c: F.Column, digits: int = ROUND_DIGITS) -> F.Column:
    return round_half_up(c, digits)


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Round every DOUBLE column with :func:`round_double`."""
    return df.select(*[
        round_double(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


# Base frames of the registered queries, shared per (session, input folder) like
# temporary views: the driver's tables are read-only, so a frame analysed once
# can serve every query of the session.  Frames stay lazy; nothing is cached.
_FRAMES: dict[tuple, DataFrame] = {}


def _session_key(spark: SparkSession):
    try:
        return (spark.sparkContext.applicationId, id(spark))
    except Exception:  # noqa: BLE001 -- no SparkContext (remote session): do not share
        return None


def _shared(spark: SparkSession, key: tuple, build):
    sk = _session_key(spark)
    if sk is None:
        return build()
    full = sk + key
    if full not in _FRAMES:
        _FRAMES[full] = build()
    return _FRAMES[full]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, ("raw", sf_dir), lambda: raw_positions(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, ("clean", sf_dir), lambda: clean(raw(spark, sf_dir)))


def metrics(spark: SparkSession, sf_dir: str, method: str = "geodesic", extended: bool = False) -> DataFrame:
    return _shared(spark, ("metrics", sf_dir, method, extended),
                   lambda: vessel_metrics(cleaned(spark, sf_dir), method=method, extended=extended))


def legs(spark: SparkSession, sf_dir: str, method: str = "geodesic") -> DataFrame:
    """Every leg of every track."""
    return _shared(spark, ("legs", sf_dir, method),
                   lambda: track_legs(cleaned(spark, sf_dir), method))


def materialized_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-vessel metrics written once to the shared checkpoint folder (several consumers)."""
    from trackline.session import materialize
    return _shared(spark, ("metrics-ckpt", sf_dir), lambda: materialize(metrics(spark, sf_dir)))
