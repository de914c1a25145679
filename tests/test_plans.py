"""Physical-plan checks: shuffles, pushdown, no Python in the hot path."""

from pyspark.sql import functions as F

from tests.conftest import SF0001
from trackline.operators.tracks import recent_positions
from trackline.plans.context import cleaned, metrics
from trackline.sources.fixture import table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(df):
    # AQE plan before execution: count exchange operators of the main query
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_metrics_plan_shuffles_and_native(spark):
    p = _plan(metrics(spark, SF0001))
    # dedupe (mmsi, time) + legs (mmsi, hour) + segments by (mmsi, day) and by mmsi
    assert p.count("Exchange hashpartitioning") == 4
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p
    # the dedupe aggregates before its exchange (a hot group of copies collapses map-side)
    assert "partial_min_by" in p


def test_bucketed_store_needs_no_exchange(spark, tmp_path):
    from trackline.operators.tracks import vessel_metrics
    from trackline.sinks import sink_bucketed
    c = cleaned(spark, SF0001)
    sink_bucketed(c, "bucketed_positions", str(tmp_path / "b"), 4)
    try:
        m = vessel_metrics(spark.table("bucketed_positions"))
        assert "Exchange" not in _plan(m)
        key = lambda r: (r["mmsi"], round(r["total_distance_nm"], 9), r["point_count"])
        assert sorted(map(key, m.collect())) == sorted(map(key, metrics(spark, SF0001).collect()))
    finally:
        spark.sql("DROP TABLE bucketed_positions")


def test_recent_positions_limits_before_shuffle(spark):
    p = _plan(recent_positions(cleaned(spark, SF0001), n=100))
    assert "WindowGroupLimit" in p


def test_pushdown_and_pruning(spark):
    ev = table(spark, SF0001, "events").where(F.col("user_id") == 7).select("ts")
    p = _plan(ev)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p


def _stages_run(spark, df, group):
    sc = spark.sparkContext
    st = sc.statusTracker()
    sc.setJobGroup(group, group)
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    infos = [st.getStageInfo(s) for j in st.getJobIdsForGroup(group) for s in st.getJobInfo(j).stageIds]
    return sum(1 for i in infos if i is not None and i.numCompletedTasks > 0)


def test_track_legs_reads_input_once(spark):
    from trackline.operators.tracks import track_legs
    legs = track_legs(cleaned(spark, SF0001), "geodesic")
    # inner legs and boundary legs share the de-duplication stage (same columns
    # on both sides, so the exchange is reused): scan + dedupe, bucket window,
    # bucket summaries, bucket rows by vessel, result -- not a second scan
    assert _stages_run(spark, legs, "legs-reuse") == 5
