import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001
from trackline.operators import changes, fleet, traffic, vessels
from trackline.plans.context import cleaned, metrics


def test_fleet_statistics_equals_literal_left_join(spark):
    c = cleaned(spark, SF0001)
    m = metrics(spark, SF0001)
    # drop some positions so that vessels without reports exist (weight max(n, 1))
    pos = c.where(F.col("mmsi") % 4 != 0)
    got = fleet.fleet_statistics(m, pos).collect()[0]
    j = m.alias("vm").join(pos.alias("ad"), F.col("vm.mmsi") == F.col("ad.mmsi"), "left")
    ref = j.agg(F.count_distinct("vm.mmsi").alias("v"), F.count("ad.mmsi").alias("p"),
                F.avg("vm.total_distance_nm").alias("d"), F.avg("vm.avg_speed_knots").alias("s")).collect()[0]
    assert got["total_vessels"] == ref["v"] and got["total_positions"] == ref["p"]
    assert got["avg_distance"] == pytest.approx(ref["d"], rel=1e-12)
    assert got["avg_speed_fleet"] == pytest.approx(ref["s"], rel=1e-12)


def test_histogram_counts_all_vessels(spark):
    m = metrics(spark, SF0001)
    h = fleet.distance_histogram(m).collect()
    assert sum(r["vessels"] for r in h) == m.count()
    assert all(1 <= r["bin"] <= 20 for r in h)


def test_daily_traffic_and_active(spark):
    c = cleaned(spark, SF0001)
    d = traffic.daily_traffic(c).collect()
    assert sum(r["total_positions"] for r in d) == c.count()
    assert all(r["moving_positions"] + r["stationary_positions"] <= r["total_positions"] for r in d)
    a = traffic.active_vessels(c, metrics(spark, SF0001)).collect()
    assert a and all(r["total_distance_nm"] is not None for r in a)


def test_top_page_search(spark):
    m = metrics(spark, SF0001)
    top = vessels.top_vessels(m).collect()
    assert len(top) == 5 and all(top[i]["total_distance_nm"] >= top[i + 1]["total_distance_nm"] for i in range(4))
    page = vessels.vessel_page(m, limit=4, offset=4).collect()
    assert len(page) == 4 and page[0]["page"] == 2
    with pytest.raises(ValueError):
        vessels.vessel_page(m, limit=2000)
    hits = vessels.vessel_search(m, name="vessel%1").collect()
    assert all("1" in r["vessel_name"] for r in hits)


def test_change_log_and_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "k long, n string, x double")
    new = spark.createDataFrame([(2, "b", 2.5), (3, "c", None), (4, "d", 4.0)], "k long, n string, x double")
    log = {r["record_id"]: r for r in changes.table_changes(old, new, "k", "t").collect()}
    assert {k: r["operation"] for k, r in log.items()} == {1: "DELETE", 2: "UPDATE", 4: "INSERT"}
    assert '"x":2.5' in log[2]["new_values"] and log[1]["new_values"] is None
    import datetime as dt
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    cur = old.withColumn("created_at", F.lit(t0).cast("timestamp_ntz")).withColumn("updated_at",
                                                                                   F.lit(t0).cast("timestamp_ntz"))
    up = {r["k"]: r for r in changes.upsert_stamped(cur, new, "k", t1).collect()}
    assert up[1]["updated_at"] == t0 and up[2]["updated_at"] == t1 and up[3]["updated_at"] == t0
    assert up[4]["created_at"] == t1 and up[2]["x"] == 2.5
    # a repeated key stays one row: the last by order, and of current rows the last updated
    twice = new.withColumn("seq", F.lit(1)).union(spark.createDataFrame([(2, "z", 9.0, 2), (2, "y", 8.0, 0), (None, "n", 0.0, 1)], "k long, n string, x double, seq int"))
    both = cur.union(cur.withColumn("n", F.lit("late")).withColumn("updated_at", F.lit(t1).cast("timestamp_ntz")))
    rows = changes.upsert_stamped(both, twice, "k", t1, order_col="seq").collect()
    assert sorted((str(r["k"]), r["n"], r["x"]) for r in rows) == [("1", "late", 1.0), ("2", "z", 9.0), ("3", "c", None), ("4", "d", 4.0), ("None", "n", 0.0)]
    log = changes.table_changes(old.withColumn("seq", F.lit(0)).union(old.withColumn("seq", F.lit(-1)).withColumn("n", F.lit("q"))), twice, "k", "t", "seq")
    assert sorted((str(r["record_id"]), r["operation"]) for r in log.collect()) == [("1", "DELETE"), ("2", "UPDATE"), ("3", "UPDATE"), ("4", "INSERT"), ("None", "INSERT")]
    codes = vessels.vessel_type_codes(spark)
    extra = spark.createDataFrame([(70, "dup", "x"), (99, "new", "y")], codes.schema)
    merged = changes.insert_if_absent(codes, extra, "code")
    assert merged.count() == 29 and merged.where("code = 70").collect()[0]["description"] == "Cargo"


def test_code_table_is_broadcast_only_if_small(spark):
    c = cleaned(spark, SF0001)
    many = spark.range(vessels.MAX_CODES + 1).select(F.col("id").cast("int").alias("code"), F.lit("d").alias("description"), F.lit("c").alias("category"))
    with pytest.raises(Exception, match="code table"):
        vessels.decode_types(c, many).count()
    assert vessels.decode_types(c, many.where(f"code < {vessels.MAX_CODES}")).where("type_description = 'd'").count() > 0
