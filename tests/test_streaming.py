from pyspark.sql import functions as F

from tests.conftest import SF0001
from trackline.plans.context import cleaned
from trackline.plans.queries import _as_source_text
from trackline.sources.fixture import raw_positions
from trackline.streaming.ingest import incremental_ingest, read_positions_table


def test_two_runs_equal_one_batch_and_no_double_load(spark, tmp_path):
    base = str(tmp_path)
    r = raw_positions(spark, SF0001)
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    (_as_source_text(r.where(F.col("base_datetime") < split)).repartition(2).write.option("header", True)
     .csv(f"{base}/in/a"))
    s1 = incremental_ingest(spark, f"{base}/in/*", f"{base}/t", f"{base}/ck", f"{base}/daily")
    (_as_source_text(r.where(F.col("base_datetime") >= split)).repartition(2).write.option("header", True)
     .csv(f"{base}/in/b"))
    s2 = incremental_ingest(spark, f"{base}/in/*", f"{base}/t", f"{base}/ck", f"{base}/daily")
    # a third run re-delivers reports that are already stored: nothing is loaded twice
    (_as_source_text(r.where(F.col("base_datetime") < split)).write.option("header", True)
     .csv(f"{base}/in/again"))
    s3 = incremental_ingest(spark, f"{base}/in/*", f"{base}/t", f"{base}/ck", f"{base}/daily")
    assert s1["input_rows"] > 0 and s2["input_rows"] > 0 and s3["input_rows"] > 0
    got = read_positions_table(spark, f"{base}/t")
    assert got.count() == cleaned(spark, SF0001).count()
    daily = spark.read.parquet(f"{base}/daily")
    assert daily.agg(F.sum("total_positions")).collect()[0][0] == got.count()


def test_backlog_in_bounded_batches(spark, tmp_path):
    base = str(tmp_path)
    r = raw_positions(spark, SF0001)
    _as_source_text(r).repartition(6).write.option("header", True).csv(f"{base}/in/all")
    stats = incremental_ingest(spark, f"{base}/in/*", f"{base}/t", f"{base}/ck", max_files_per_trigger=2)
    assert stats["batches"] >= 3
    assert read_positions_table(spark, f"{base}/t").count() == cleaned(spark, SF0001).count()


def test_two_checkpoints_share_a_table(spark, tmp_path):
    """A second feed with a checkpoint of its own leaves what the first has stored."""
    from trackline.streaming.ingest import incremental_ingest, read_positions_table
    head = "MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselName,IMO,CallSign,VesselType,Status,Length,Width,Draft,Cargo,TransceiverClass\n"
    for feed, n in (("a", 10), ("b", 3)):
        (tmp_path / feed).mkdir()
        (tmp_path / feed / "f.csv").write_text(head + "".join(
            f"{100000000 + n},2024-01-15 0{i % 10}:00:00,1.0,2.0,3.0,,,,,,,,,,,,\n" for i in range(n)))
        incremental_ingest(spark, str(tmp_path / feed), str(tmp_path / "table"), str(tmp_path / f"ckpt-{feed}"))
    assert read_positions_table(spark, str(tmp_path / "table")).count() == 13


def test_files_of_several_layouts(spark, tmp_path):
    import zipfile
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "swapped.csv").write_text("LON,LAT,MMSI,BaseDateTime,SOG,Port\n-5.5,35.5,100000001,2024-01-15 08:00:00,3.0,X\n")
    with zipfile.ZipFile(tmp_path / "in" / "one.zip", "w") as zf:
        zf.writestr("std.csv", "mmsi,lat,lon,time,speed\n100000002,1.0,2.0,2024-01-15T09:00:00Z,3.0\n")
    stats = incremental_ingest(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "ckpt"))
    got = {r["mmsi"]: (r["latitude"], r["longitude"]) for r in read_positions_table(spark, str(tmp_path / "table")).collect()}
    assert got == {100000001: (35.5, -5.5), 100000002: (1.0, 2.0)} and stats == {"input_rows": 2, "batches": 1}


def test_folders_of_a_date_are_merged(spark, tmp_path):
    """However many batches bring reports of one day, few folders are live, and old manifests and folders go."""
    from trackline.streaming.manifest import KEPT, Manifest
    (tmp_path / "in").mkdir()
    for i in range(7):
        (tmp_path / "in" / f"{i}.csv").write_text("mmsi,time,lat,lon,speed\n" + "".join(
            f"{100000000 + j},2024-03-0{1 + j % 2} 0{i}:00:00,1.0,2.0,3.0\n" for j in range(4)))
        incremental_ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck"), str(tmp_path / "daily"), max_folders=2)
    m = Manifest(spark, str(tmp_path / "t" / "positions"))
    assert set(m.folders) == {"2024-03-01", "2024-03-02"} and all(len(b) <= 2 for b in m.folders.values())
    rows = read_positions_table(spark, str(tmp_path / "t"))
    assert rows.count() == 28 and rows.select("mmsi", "base_datetime").distinct().count() == 28
    assert len(list((tmp_path / "t" / "positions").glob("traffic_date=*/batch=*"))) <= 2 * 4
    assert len(list((tmp_path / "t" / "positions" / "_manifest").glob("[0-9]*.json"))) <= KEPT
    assert {str(r["traffic_date"]): r["total_positions"] for r in spark.read.parquet(str(tmp_path / "daily")).collect()} == {
        "2024-03-01": 14, "2024-03-02": 14}
