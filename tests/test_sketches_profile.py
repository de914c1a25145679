import datetime as dt

import pytest
from pyspark.sql import functions as F

from trackline.operators import profile, sketches


def _reports(spark, vessels):
    return spark.range(vessels * 3).select(
        (F.col("id") % vessels).alias("mmsi"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 40).cast("int"))).alias("base_datetime"))


def test_sketches_of_days_merge_within_the_stated_error(spark):
    rows = _reports(spark, 60_000)
    daily = sketches.daily_sketches(rows).union(sketches.daily_sketches(rows.where("mmsi % 2 = 0")))  # a day in two loads
    got = sketches.distinct_vessels(sketches.merged(daily, "traffic_date")).first()
    assert got.vessels == pytest.approx(60_000, rel=4 * 1.04 / 2 ** (sketches.LG_K / 2)) and got.positions == 270_000
    day = dt.date(2024, 1, 20)
    exact = rows.where("to_date(base_datetime) > date'2024-01-13' and to_date(base_datetime) <= date'2024-01-20'").select("mmsi").distinct().count()
    assert sketches.distinct_vessels(daily, 7, day).first().vessels == pytest.approx(exact, rel=4 * 1.04 / 2 ** (sketches.LG_K / 2))
    assert tuple(sketches.distinct_vessels(daily.limit(0)).first()) == (0, 0)


def test_profile(spark):
    df = spark.createDataFrame([(1, None, "70"), (1, dt.datetime(2024, 1, 2), "70"), (2, dt.datetime(2024, 1, 1), None), (None, None, "30")],
                               "mmsi long, base_datetime timestamp_ntz, vessel_type string")
    assert tuple(profile.load_profile(df).first()) == (4, 3, 2, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert [tuple(r) for r in profile.top_vessel_types(df).collect()] == [("70", 2), ("30", 1)]
    assert {r["column"]: (r.filled, r.share) for r in profile.column_fill(df).collect()} == {
        "mmsi": (3, 0.75), "base_datetime": (2, 0.5), "vessel_type": (3, 0.75)}
    assert {r.share for r in profile.column_fill(df.limit(0)).collect()} == {0.0}
