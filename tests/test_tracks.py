import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SAMPLE, geodesic, haversine, positions_df, walked
from trackline.operators.clean import clean, coerce_types
from trackline.operators.tracks import track_legs, vessel_metrics, vessel_summary
from trackline.sources.positions import ingest_order, read_positions

def _sample_clean(spark, sample_path):
    return clean(ingest_order(read_positions(spark, sample_path)), order_col="ingest_order")


@pytest.mark.parametrize("method,distance", [("geodesic", geodesic), ("haversine", haversine)])
def test_sample_metrics_equal_a_walk(spark, sample_path, method, distance):
    rows = {r["mmsi"]: r for r in vessel_metrics(_sample_clean(spark, sample_path), method).collect()}
    want = walked(SAMPLE, distance)
    assert set(rows) == set(want) and len(want) == 9
    for mmsi, w in want.items():
        for k, v in w.items():
            assert rows[mmsi][k] == (v if isinstance(v, str) else pytest.approx(v, abs=1e-9)), (mmsi, k)


def test_bucket_width_does_not_change_results(spark):
    """Splitting tracks into time buckets (skew handling) must be exact for any width."""
    rnd = random.Random(7)
    rows = []
    for v in range(1, 6):
        t = 0
        for _ in range(200):
            t += rnd.randint(1, 5400)
            rows.append((v, f"2024-01-{1 + t // 86400:02d} {t % 86400 // 3600:02d}:{t % 3600 // 60:02d}:{t % 60:02d}",
                         10 + rnd.random(), 20 + rnd.random(), rnd.choice([0.0, 0.5, 1.5, 12.0])))
    c = clean(positions_df(spark, rows))
    results = []
    for minutes in (1, 60, 24 * 60, 365 * 24 * 60):
        m = vessel_summary(c, bucket_minutes=minutes).orderBy("mmsi").collect()
        results.append([(r["mmsi"], round(r["total_distance_nm"], 9), r["total_time_hours"], r["moving_time_hours"],
                         r["point_count"], r["leg_count"]) for r in m])
    assert all(r == results[0] for r in results)
    assert results[0][0][5] == 199


def test_edge_rows(spark):
    rows = [
        (1, "2024-01-01 00:00:00", 10.0, 10.0, 5.0),                       # single point
        (2, "2024-01-01 00:00:00", 10.0, 179.9, 0.5), (2, "2024-01-01 01:00:00", 10.0, -179.9, 1.5),  # antimeridian
        (3, "2024-01-01 00:00:00", 5.0, 5.0, 1.0), (3, "2024-01-01 00:30:00", 5.0, 5.0, 1.0),  # coincident
    ]
    m = {r["mmsi"]: r for r in vessel_metrics(clean(positions_df(spark, rows))).collect()}
    assert (m[1]["total_distance_nm"], m[1]["total_time_hours"], m[1]["moving_time_hours"], m[1]["point_count"]) \
        == (0.0, 0.0, 0.0, 1)
    assert m[2]["total_distance_nm"] == pytest.approx(11.840104, abs=1e-6)
    assert m[2]["moving_time_hours"] == 1.0  # pair mean exactly 1.0 counts as moving
    assert m[3]["total_distance_nm"] == 0.0 and m[3]["at_dock_time_hours"] == 0.0


def test_first_name_null_gives_unknown(spark):
    rows = [(9, "2024-01-01 00:00:00", 1.0, 1.0, 3.0, None), (9, "2024-01-01 00:10:00", 1.0, 1.1, 3.0, "LATE NAME")]
    assert vessel_metrics(clean(positions_df(spark, rows))).collect()[0]["vessel_name"] == "Unknown"


def test_permutation_invariance_and_time_identity(spark):
    rnd = random.Random(3)
    rows = [(v, f"2024-01-02 {h:02d}:{m:02d}:00", rnd.uniform(-60, 60), rnd.uniform(-170, 170), rnd.uniform(0, 30))
            for v in range(3) for h in range(24) for m in (0, 20, 40)]
    a = vessel_metrics(clean(positions_df(spark, rows))).orderBy("mmsi").collect()
    rnd.shuffle(rows)
    b = vessel_metrics(clean(positions_df(spark, rows))).orderBy("mmsi").collect()
    for x, y in zip(a, b):
        assert x["total_distance_nm"] == pytest.approx(y["total_distance_nm"], rel=1e-12)
        assert x["moving_time_hours"] + x["at_dock_time_hours"] == pytest.approx(x["total_time_hours"], abs=1e-12)


def test_legs_match_metrics(spark, sample_path):
    c = _sample_clean(spark, sample_path)
    legs = track_legs(c).groupBy("mmsi").agg(F.sum("leg_nm").alias("d"), F.count("*").alias("n"))
    got = {r["mmsi"]: (r["d"], r["n"]) for r in legs.collect()}
    for mmsi, w in walked(SAMPLE).items():
        if w["point_count"] > 1:
            assert got.pop(mmsi) == (pytest.approx(w["total_distance_nm"], abs=1e-9), w["point_count"] - 1)
    assert not got


def test_text_input_is_typed(spark, sample_path):
    typed = coerce_types(read_positions(spark, sample_path))
    f = {x.name: x.dataType.simpleString() for x in typed.schema.fields}
    assert f["mmsi"] == "bigint" and f["base_datetime"] == "timestamp_ntz" and f["latitude"] == "double"


def test_hot_vessel_is_spread_over_tasks(spark):
    """One vessel with a third of all reports must not land in one task."""
    from trackline.operators.tracks import _sliced_legs
    hot = spark.range(0, 30000).select(F.lit(1).cast("long").alias("mmsi"), F.col("id").alias("i"))
    cold = spark.range(0, 60000).select((F.col("id") % 300 + 2).alias("mmsi"), F.col("id").alias("i"))
    rows = hot.unionByName(cold).select(
        "mmsi",
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=F.col("i") * 7)).alias("base_datetime"),
        (F.col("i") % 90).cast("double").alias("latitude"), F.lit(1.0).alias("longitude"),
        F.lit(3.0).alias("sog"), F.lit("V").alias("vessel_name"), F.col("i").alias("ingest_seq"))
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        legs = _sliced_legs(rows, "haversine", 60).where(F.col("mmsi") == 1)
        per_task = [r["n"] for r in legs.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert sum(per_task) == 30000
    assert len(per_task) >= 6 and max(per_task) < 0.3 * 30000


def test_dense_vessel_hour_is_split_with_identical_results(spark):
    """A vessel-hour holding most reports is cut into time slices; metrics do not change."""
    from trackline.operators.tracks import _sliced_legs
    dense = spark.range(0, 20000).select(
        F.lit(5).cast("long").alias("mmsi"),
        (F.lit("2024-03-01 10:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=F.col("id") * F.lit(0.15))).alias("base_datetime"),
        (F.col("id") % 50 / 10.0).alias("latitude"), (F.col("id") % 7 / 10.0).alias("longitude"),
        (F.col("id") % 3).cast("double").alias("sog"), F.lit("D").alias("vessel_name"),
        F.col("id").alias("ingest_seq"))
    other = spark.range(0, 500).select(
        F.lit(6).cast("long").alias("mmsi"),
        (F.lit("2024-03-01 09:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 30)).alias(
            "base_datetime"),
        F.lit(1.0).alias("latitude"), (F.col("id") / 100.0).alias("longitude"), F.lit(4.0).alias("sog"),
        F.lit("E").alias("vessel_name"), F.col("id").alias("ingest_seq"))
    c = clean(dense.unionByName(other))
    plain = {r["mmsi"]: r for r in vessel_summary(c).collect()}
    split = {r["mmsi"]: r for r in vessel_summary(c, bucket_minutes=3).collect()}
    for m in (5, 6):
        assert split[m]["total_distance_nm"] == pytest.approx(plain[m]["total_distance_nm"], rel=1e-12)
        for k in ("total_time_hours", "moving_time_hours", "point_count", "leg_count"):
            assert split[m][k] == plain[m][k]
    slices = _sliced_legs(c, "haversine", 3).where("mmsi = 5").groupBy("_slice").count().collect()
    assert len(slices) >= 15 and max(r["count"] for r in slices) <= 1200
