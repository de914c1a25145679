from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import positions_df
from trackline.operators.clean import (clean, cleaning_report, coerce_types, constraint_violations,
                                       dedupe_positions, uniqueness_violations)


def test_lenient_parsing(spark):
    vals = ["12.5", " 7 ", "1e-4", "NA", "1.5d", "1,000", "inf", "nan", "", None, "-0.25", "085"]
    df = spark.createDataFrame([(v,) for v in vals], "latitude string")
    got = [r["latitude"] for r in coerce_types(df).collect()]
    assert got[0] == 12.5 and got[1] == 7.0 and got[2] == 1e-4
    assert got[3] is None and got[4] is None and got[5] is None and got[8] is None and got[9] is None
    assert got[6] == float("inf") and got[7] != got[7]
    assert got[10] == -0.25 and got[11] == 85.0


def test_id_and_time_parsing(spark):
    df = spark.createDataFrame([("219006771.0", "2024-01-15T08:00:00"), ("1.5", "not a time"),
                                ("42", "2024-01-15 08:00:00.250")], "mmsi string, base_datetime string")
    got = coerce_types(df).collect()
    assert got[0]["mmsi"] == 219006771 and str(got[0]["base_datetime"]) == "2024-01-15 08:00:00"
    assert got[1]["mmsi"] is None and got[1]["base_datetime"] is None
    assert got[2]["base_datetime"].microsecond == 250000


def test_ranges_and_bounds(spark):
    rows = [(1, "2024-01-01 00:00:00", 90.0, 180.0, 0.0), (1, "2024-01-01 00:01:00", -90.0, -180.0, 50.0),
            (1, "2024-01-01 00:02:00", 90.0001, 0.0, 1.0), (1, "2024-01-01 00:03:00", 0.0, 0.0, 50.0001),
            (1, "2024-01-01 00:04:00", 0.0, 0.0, None), (1, "2024-01-01 00:05:00", 0.0, 0.0, float("nan"))]
    assert clean(positions_df(spark, rows)).count() == 2


def test_dedupe_keeps_first_in_file_order(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", 3.0, 7), (1, "2024-01-01 00:00:00", 9.0, 2),
                                (1, "2024-01-01 00:00:00", 5.0, 11)], "mmsi long, t string, sog double, ingest_seq long")
    df = df.withColumn("base_datetime", F.col("t").cast("timestamp_ntz")).drop("t")
    r = dedupe_positions(df).collect()
    assert len(r) == 1 and r[0]["sog"] == 9.0 and r[0]["ingest_seq"] == 2


def test_clean_is_idempotent(spark):
    rows = [(v, f"2024-01-01 00:0{i}:00", float(i), float(v), float(i)) for v in range(3) for i in range(5)]
    once = clean(positions_df(spark, rows))
    twice = clean(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_report_and_quarantine(spark):
    rows = [(1, "2024-01-01 00:00:00", 95.0, 0.0, 1.0), (1, "2024-01-01 00:01:00", 1.0, 0.0, 60.0),
            (1, "2024-01-01 00:02:00", 1.0, 0.0, 1.0), (1, "2024-01-01 00:02:00", 1.0, 0.0, 2.0),
            (None, "2024-01-01 00:03:00", 1.0, 0.0, 1.0)]
    r = cleaning_report(positions_df(spark, rows)).collect()[0]
    assert (r["rows_in"], r["rejected_incomplete"], r["rejected_coordinates"], r["rejected_speed"],
            r["rejected_duplicates"], r["rows_out"]) == (5, 1, 1, 1, 1, 1)
    v = {row["violations"] for row in constraint_violations(positions_df(spark, rows)).collect()}
    assert "chk_latitude" in v and "nn_mmsi" in v
    u = uniqueness_violations(positions_df(spark, rows)).collect()
    assert len(u) == 1 and u[0]["copies"] == 2


def test_empty_input(spark):
    from trackline.operators import fleet, tracks
    schema = T.StructType([T.StructField("mmsi", T.LongType()), T.StructField("base_datetime", T.TimestampNTZType()),
                           T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
                           T.StructField("sog", T.DoubleType()), T.StructField("vessel_name", T.StringType()),
                           T.StructField("ingest_seq", T.LongType())])
    empty = clean(spark.createDataFrame([], schema))
    m = tracks.vessel_metrics(empty)
    t = fleet.time_analysis(m).collect()[0]
    assert t["vessels_count"] == 0 and t["moving_time_percentage"] == 0.0 and t["total_time"] == 0.0
    q = fleet.data_quality(empty).collect()[0]
    assert q["total_records"] == 0 and q["overall_quality_score"] == 0.0


def test_limit_records_equals_a_sort(spark):
    from trackline.operators import clean as C
    df = spark.range(0, 50000, 1, 8).select((F.col("id") * 7919 % 50000).alias("ingest_seq"), F.col("id"))
    for n in (0, 1, 3000, 49999, 50000, 60000):
        assert [r["ingest_seq"] for r in C.limit_records(df, n).collect()] == list(range(min(n, 50000)))
    text = df.select(F.lpad("ingest_seq", 6, "0").alias("ingest_seq"))
    assert [r[0] for r in C.limit_records(text, 5).collect()] == [f"{i:06d}" for i in range(5)]
    assert C.limit_records(df.where("id < 0"), 5).collect() == []
    few = df.select(F.when(F.col("id") > 3, F.col("ingest_seq")).alias("ingest_seq"))
    assert C.limit_records(few, 10).count() == 10 and C.limit_records(few, 60000).count() == 49996


def test_limit_records_in_file_order(spark, tmp_path):
    from trackline.operators import clean as C
    from trackline.sources.datasource import read_files
    from trackline.sources.positions import ORDER, ingest_order
    d = tmp_path / "many"
    d.mkdir()
    line = "{m},2024-01-15 08:{mm:02d}:00,35.1,-5.2,1.0,0,0,V,0,C,70,0,1,1,1,0,A\n"
    for k in range(4):
        (d / f"f{k}.csv").write_text("".join(line.format(m=k * 1000 + i, mm=i % 60) for i in range(700)))
    raw = ingest_order(read_files(spark, str(d), "false", split_bytes=16384))
    assert raw.rdd.getNumPartitions() > 4
    for n in (1, 650, 1500, 5000):
        want = [r["mmsi"] for r in raw.orderBy(ORDER).limit(n).collect()]
        assert [r["mmsi"] for r in C.limit_records(raw, n, ORDER).collect()] == want, n


def test_limit_records_runs_nothing_while_built(spark):
    from trackline.operators import clean as C
    from trackline.operators.tracks import track_legs, vessel_metrics
    from trackline.plans.context import cleaned
    c = cleaned(spark, "/root/testdata/sf0.001")
    sc = spark.sparkContext
    sc.setJobGroup("building", "building")
    C.limit_records(spark.range(1000).withColumnRenamed("id", "ingest_seq"), 10)
    vessel_metrics(c), track_legs(c)
    assert not sc.statusTracker().getJobIdsForGroup("building")
    sc.setLocalProperty("spark.jobGroup.id", None)

