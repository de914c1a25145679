import pytest

from tests.conftest import SAMPLE, SAMPLE_CSV, walked
from trackline.plans.pipeline import ledger, run_pipeline, stored_metrics, stored_positions


def test_pipeline_from_files_and_flags(spark, sample_path, tmp_path):
    store = str(tmp_path / "store")
    res = run_pipeline(spark, store, paths=[sample_path])
    report = res.report.collect()[0]
    want = walked(SAMPLE)
    top = max(want, key=lambda v: want[v]["total_distance_nm"])
    assert report["top_top1_mmsi"] == top and report["points_total_vessels"] == len(want)
    assert report["quality_total_records"] == len(SAMPLE)
    m = {r["mmsi"]: r for r in stored_metrics(spark, store).collect()}
    assert m[top]["total_distance_nm"] == pytest.approx(want[top]["total_distance_nm"], abs=1e-6)
    # a second run over the same file adds nothing
    run_pipeline(spark, store, paths=[sample_path], skip_stats=True)
    assert stored_positions(spark, store).count() == len(SAMPLE)
    again = run_pipeline(spark, store, stats_only=True).report.collect()[0]
    assert again["quality_total_records"] == len(SAMPLE) and again["top_top1_mmsi"] == top
    # a new file that repeats stored reports and has one of its own adds that one
    mmsi = SAMPLE[0]["mmsi"]
    (tmp_path / "more.csv").write_text(SAMPLE_CSV + f"{mmsi},2024-05-01 00:00:00,1.5,2.5,3.0\n")
    run_pipeline(spark, store, paths=[sample_path, str(tmp_path / "more.csv")], skip_stats=True)
    assert stored_positions(spark, store).count() == len(SAMPLE) + 1 and ledger(spark, store).count() == 2
    assert stored_metrics(spark, store).where(f"mmsi = {mmsi}").first()["point_count"] == want[mmsi]["point_count"] + 1


def test_run_that_stopped_before_its_ledger_entry(spark, sample_path, tmp_path):
    """Positions were written, the ledger was not: the next run takes their place."""
    import shutil
    store = str(tmp_path / "store")
    run_pipeline(spark, store, paths=[sample_path], skip_stats=True)
    shutil.rmtree(f"{store}/ledger")
    run_pipeline(spark, store, paths=[sample_path], skip_stats=True)
    assert stored_positions(spark, store).count() == len(SAMPLE)


def test_pipeline_cap_and_skip(spark, sample_path, tmp_path):
    store = str(tmp_path / "capped")
    res = run_pipeline(spark, store, paths=[sample_path], max_records=6, batch_only=True)
    assert stored_positions(spark, store).count() == 6  # first 6 rows in file order
    assert {r["mmsi"] for r in stored_metrics(spark, store).collect()} == {r["mmsi"] for r in SAMPLE[:6]}
    assert res.report is not None
    raw_store = str(tmp_path / "raw")
    res2 = run_pipeline(spark, raw_store, paths=[sample_path], skip_processing=True)
    assert res2.report is None and stored_positions(spark, raw_store).count() == len(SAMPLE)
