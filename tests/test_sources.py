import io
import os
import zipfile

from pyspark.sql import functions as F

from tests.conftest import SAMPLE, SAMPLE_CSV
from trackline.operators.clean import clean, coerce_types
from trackline.sources import archives, positions


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_bad_and_short_rows(spark, tmp_path):
    lines = SAMPLE_CSV.splitlines()
    text = "\n".join([lines[0], lines[1], lines[2] + ",EXTRA", "219000001,2024-01-15 12:00:00,59.2,20.4,12.0",
                      "219000001,2024-01-15 13:00:00,NA,20.4,NULL"]) + "\n"
    df = positions.read_positions(spark, _write(tmp_path, "a.csv", text))
    rows = df.orderBy("ingest_seq").collect()
    assert len(rows) == 3  # the 18-field row is skipped
    assert rows[1]["vessel_name"] is None and rows[1]["sog"] == "12.0"  # short row kept, NULL-filled
    assert rows[2]["latitude"] is None and rows[2]["sog"] is None  # NA tokens -> NULL
    assert clean(coerce_types(df)).count() == 2


def test_headerless_standard_and_detection(spark, tmp_path):
    body = "\n".join(SAMPLE_CSV.splitlines()[1:]) + "\n"
    d = tmp_path / "files"
    d.mkdir()
    (d / "headed.csv").write_text(SAMPLE_CSV)
    (d / "plain.csv").write_text(body)
    (d / "std.csv").write_text("mmsi,timestamp,lat,lon,speed,name\n1,2024-01-01 00:00:00,1.0,2.0,3.0,X\n")
    fmt = {os.path.basename(r["file_path"]): r["format"] for r in positions.detect_format(spark, str(d)).collect()}
    assert fmt == {"headed.csv": "noaa", "plain.csv": "noaa_no_header", "std.csv": "standard"}
    assert positions.read_positions_headerless(spark, str(d / "plain.csv")).count() == len(SAMPLE)
    std = positions.read_positions_standard(spark, str(d / "std.csv")).collect()[0]
    assert (std["mmsi"], std["base_datetime"], std["sog"], std["vessel_name"], std["status"]) == \
        ("1", "2024-01-01 00:00:00", "3.0", "X", None)
    allrows = positions.read_any(spark, [str(d / "headed.csv"), str(d / "plain.csv"), str(d / "std.csv")])
    assert allrows.count() == 2 * len(SAMPLE) + 1


def test_combine_by_name(spark, tmp_path):
    a = positions.read_positions(spark, _write(tmp_path, "a.csv", SAMPLE_CSV))
    b = positions.read_positions_standard(spark, _write(tmp_path, "b.csv", "mmsi,time,lat,lon\n5,2024-01-01,1,2\n"),
                                          fill_missing=False)
    both = positions.combine_files([a, b])
    assert both.count() == len(SAMPLE) + 1 and both.where(F.col("mmsi") == "5").collect()[0]["sog"] is None


def test_zip_archive(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("day/AIS_2024_01_15.CSV", SAMPLE_CSV)
        zf.writestr("readme.txt", "not data")
    (tmp_path / "AIS_2024_01_15.zip").write_bytes(buf.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    df = archives.read_zip_positions(spark, str(tmp_path))
    assert df.count() == len(SAMPLE)
    assert clean(coerce_types(df), order_col="ingest_seq").count() == len(SAMPLE)


def test_write_then_read_archives(spark, tmp_path):
    lines = spark.createDataFrame([(l,) for l in SAMPLE_CSV.splitlines()[1:]], "line string")
    assert archives.write_archives(lines, str(tmp_path / "zips"), 3) == len(list((tmp_path / "zips").glob("*.zip"))) > 1
    assert archives.read_zip_positions(spark, str(tmp_path / "zips")).count() == len(SAMPLE_CSV.splitlines()) - 1


def test_malformed_row_with_a_long_quoted_field(spark, tmp_path):
    """A megabyte between quotes neither ends the executor nor hides the rows around it."""
    head, body = SAMPLE_CSV.split("\n", 1)
    long = '"' + "x,y" * 350_000 + '"'
    text = "\n".join([head, f"1,2024-01-01 00:00:00,1,2,3,4,5,{long}" + "," * 12, f"2,2024-01-01 00:00:00,1,2,3,4,5,{long}", body])
    for df in (positions.read_positions(spark, _write(tmp_path, "a.csv", text)), positions.read_any(spark, [str(tmp_path)])):
        rows = df.where("length(vessel_name) > 100").collect()
        assert [(r.mmsi, r.vessel_name) for r in rows] == [("2", long.strip('"'))]  # the first has 20 fields
        assert df.count() == len(body.splitlines()) + 1


def test_quotes_backslashes_and_bytes_survive(spark, tmp_path):
    import csv as pycsv
    names = ['A "B" \\ C', "back\\slash", 'ends with "', "comma, inside", "ünï", " blanks ", "a\tb", '""', "\\"]
    buf = io.StringIO()
    w = pycsv.writer(buf, lineterminator="\n")
    w.writerow(["lat", "name", "mmsi", "time"])
    for i, n in enumerate(names):
        w.writerow([str(i), n, str(i), "2024-01-01"])
    text = buf.getvalue()
    _write(tmp_path, "p.csv", text)
    with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("m.csv", text)
    (tmp_path / "latin.csv").write_bytes(b"mmsi,time,name\n77,2024,\xe9t\xe9\n")
    rows = positions.read_any(spark, [str(tmp_path)]).collect()
    for kind in ("p.csv", "m.csv"):
        assert {int(r.mmsi): r.vessel_name for r in rows if r.source_file.endswith(kind)} == {
            i: n for i, n in enumerate(names)}
    assert [r.vessel_name for r in rows if r.mmsi == "77"] == ["\ufffdt\ufffd"]


def test_stretches_hold_every_line_once(spark, tmp_path):
    """Whatever the size of a stretch, and whichever line ends a file has."""
    from trackline.sources.datasource import file_rows, line_blocks
    body = [f"{i},2024-01-01 00:00:00,{'9' * (i % 17)}" for i in range(300)]
    for end in ("\n", "\r\n", "\r"):
        data = (end.join(["mmsi,time,lat", *body]) + (end if end != "\r" else "")).encode()
        for step in (7, 64, 1000, len(data)):
            got = []
            for a in range(0, len(data), step):
                f = io.BytesIO(data)
                f.seek(max(a - 1, 0))
                for b in file_rows(f, "f", "true", a, min(a + step, len(data)), "mmsi,time,lat" if a else None):
                    got += b.column("mmsi").to_pylist()
            assert got == [str(i) for i in range(300)], (end, step)
    assert list(line_blocks(io.BytesIO(b""))) == []
    path = _write(tmp_path, "big.csv", "mmsi,time,lat\n" + "\n".join(body) + "\n")
    from trackline.sources.datasource import read_files
    split = read_files(spark, path, "auto", split_bytes=1000)
    assert split.rdd.getNumPartitions() > 5 and split.count() == 300
    assert split.groupBy("source_offset", "ingest_seq").count().where("count > 1").isEmpty()


def test_members_are_partitions_and_globs_match(spark, tmp_path):
    from trackline.sources.datasource import PositionsReader
    with zipfile.ZipFile(tmp_path / "many.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        for i in range(5):
            zf.writestr(f"d/{i}.csv", f"mmsi,time,lat\n{i},2024-01-01,1\n" * 1)
    (tmp_path / "sub").mkdir()
    _write(tmp_path / "sub", "one.csv", "mmsi,time\n9,2024\n")
    _write(tmp_path / "sub", "_hidden.csv", "mmsi,time\n10,2024\n")
    _write(tmp_path / "sub", "other.txt", "mmsi,time\n11,2024\n")
    parts = PositionsReader({"path": str(tmp_path), "splitbytes": "100"}).partitions()
    assert len(parts) == 7
    assert sorted(r.mmsi for r in positions.read_any(spark, [str(tmp_path)]).collect()) == ["0", "1", "11", "2", "3", "4", "9"]
    assert [r.mmsi for r in positions.read_any(spark, [str(tmp_path / "s*" / "*.csv")]).collect()] == ["9"]
    assert archives.read_zip_positions(spark, str(tmp_path)).count() == 5


def test_archive_over_two_gigabytes_of_text(tmp_path):
    """A member is inflated as it streams: over 2 GB of text are read with a few blocks in memory."""
    import tracemalloc
    from trackline.sources.datasource import member_rows
    line = b"1,2024-01-01 00:00:00," + b"x" * 400_000 + b"\n"  # one long column that no canonical name takes
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
        with zf.open("big.csv", "w", force_zip64=True) as m:
            m.write(b"mmsi,time,port\n")
            for _ in range(5400):
                m.write(line)
    tracemalloc.start()
    rows = sum(b.num_rows for b in member_rows(str(tmp_path / "big.zip"), "big.csv", "member"))
    assert rows == 5400 and tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()


def test_file_inventory(spark, tmp_path):
    _write(tmp_path, "x.csv", SAMPLE_CSV)
    _write(tmp_path, "empty.csv", "")
    inv = positions.file_inventory(spark, str(tmp_path), glob="*.csv").collect()
    assert [os.path.basename(r["path"]) for r in inv] == ["x.csv"]


def test_gzip_csv_and_create_tables(spark, tmp_path):
    import gzip
    p = tmp_path / "day.csv.gz"
    p.write_bytes(gzip.compress(SAMPLE_CSV.encode()))
    assert positions.read_positions(spark, str(p)).count() == len(SAMPLE)
    from trackline.sinks import create_tables
    names = create_tables(spark, str(tmp_path / "store"))
    names2 = create_tables(spark, str(tmp_path / "store"))  # idempotent
    assert names == names2 and "traffic_date" in spark.table(names[0]).columns
    spark.sql(f"DROP TABLE {names[0]}")
    spark.sql(f"DROP TABLE {names[1]}")


def test_spread_after_unsplittable_source(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("a.csv", SAMPLE_CSV)
    (tmp_path / "one.zip").write_bytes(buf.getvalue())
    df = archives.read_zip_positions(spark, str(tmp_path), spread=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == len(SAMPLE)


def test_read_any_keeps_each_standard_header(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    (d / "a.csv").write_text("mmsi,timestamp,lat,lon,speed\n1,2024-01-01 00:00:00,1.0,2.0,3.0\n")
    (d / "b.csv").write_text("time,speed,mmsi,lon,lat\n2024-01-01 00:05:00,4.0,2,6.0,5.0\n")
    rows = {r["mmsi"]: r for r in positions.read_any(spark, [str(d / "a.csv"), str(d / "b.csv")]).collect()}
    assert (rows["1"]["latitude"], rows["1"]["sog"]) == ("1.0", "3.0")
    assert (rows["2"]["latitude"], rows["2"]["longitude"], rows["2"]["sog"]) == ("5.0", "6.0", "4.0")


def test_detect_format_reads_whole_first_line_only(spark, tmp_path):
    import gzip
    d = tmp_path / "heads"
    d.mkdir()
    long_header = "MMSI,Time," + ",".join(f"extra_{i}" for i in range(20000))  # longer than one read chunk
    assert len(long_header) > positions.FIRST_LINE_CHUNK
    (d / "long.csv").write_text(long_header + "\n1,2\n")
    (d / "crlf.csv").write_text("MMSI,BaseDateTime,LAT\r\n1,2,3\r\n")
    with gzip.open(d / "z.csv.gz", "wt") as f:
        f.write("1,2024-01-01 00:00:00,3\n")
    (d / "empty.csv").write_text("")
    rows = {os.path.basename(r["file_path"]): r for r in positions.detect_format(spark, str(d)).collect()}
    assert set(rows) == {"long.csv", "crlf.csv", "z.csv.gz"}
    assert rows["long.csv"]["first_line"] == long_header and rows["long.csv"]["format"] == "standard"
    assert rows["crlf.csv"]["first_line"] == "MMSI,BaseDateTime,LAT" and rows["crlf.csv"]["format"] == "noaa"
    assert rows["z.csv.gz"]["format"] == "noaa_no_header"


def test_detect_format_falls_back_to_text_scan(spark, tmp_path, monkeypatch):
    d = tmp_path / "fallback"
    d.mkdir()
    (d / "a.csv").write_text("MMSI,BaseDateTime,LAT\n1,2,3\n")
    (d / "b.csv").write_text("1,2024-01-01 00:00:00,3\n")
    fast = {os.path.basename(r["file_path"]): (r["format"], r["first_line"])
            for r in positions.detect_format(spark, str(d)).collect()}
    rows = lambda: sorted((r.mmsi, r.base_datetime, r.latitude) for r in positions.read_any(spark, [str(d)]).collect())
    by_source = rows()
    monkeypatch.setattr(positions, "readable", lambda path: False)
    assert rows() == by_source == [("1", "2", "3"), ("1", "2024-01-01 00:00:00", "3")]
    slow = {os.path.basename(r["file_path"]): (r["format"], r["first_line"])
            for r in positions.detect_format(spark, str(d)).collect()}
    assert fast == slow == {"a.csv": ("noaa", "MMSI,BaseDateTime,LAT"),
                            "b.csv": ("noaa_no_header", "1,2024-01-01 00:00:00,3")}


def test_columns_go_by_name(spark, tmp_path):
    d = tmp_path / "named"
    d.mkdir()
    (d / "swapped.csv").write_text("LON,LAT,MMSI,BaseDateTime,SOG,Port\n-5.5,35.5,1,2024-01-15 08:00:00,3.0,X\n")
    wide = ",".join([*positions.SOURCE_COLUMNS, "Port"])
    (d / "wide.csv").write_text(wide + "\n2,2024-01-15 08:00:00,10,20,1" + "," * 12 + ",Y\n3,2024-01-15 08:00:00,10,20,1" + "," * 13 + ",Z\n")
    for df in (positions.read_positions(spark, str(d)), positions.read_any(spark, [str(d)])):
        got = {r["mmsi"]: (r["latitude"], r["longitude"], r["sog"]) for r in df.collect()}
        assert got == {"1": ("35.5", "-5.5", "3.0"), "2": ("10", "20", "1")}  # row 3 has more fields than its header


def test_standard_rows_longer_than_header(spark, tmp_path):
    text = 'mmsi,time,lat,lon,name\n1,2024-01-01,1,2,"a, b"\n2,2024-01-01,1,2,x,\n3,2024-01-01,1\n'
    df = positions.read_positions_standard(spark, _write(tmp_path, "s.csv", text))
    assert {r["mmsi"]: r["vessel_name"] for r in df.collect()} == {"1": "a, b", "3": None}


def test_zip_members_by_name_and_read_any(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "two.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("std.csv", 'mmsi,lat,lon,timestamp,speed,name\n7,1.0,2.0,2024-01-01 00:00:00,3.0,"A, ""B"""\n8,1,2,2024-01-01,3,x,y\n')
        zf.writestr("noaa.csv", SAMPLE_CSV)
    _write(tmp_path, "plain.csv", SAMPLE_CSV)
    rows = positions.read_any(spark, [str(tmp_path)]).collect()
    assert len(rows) == 2 * len(SAMPLE) + 1
    seven = [r for r in rows if r["mmsi"] == "7"][0]
    assert (seven["base_datetime"], seven["latitude"], seven["longitude"], seven["sog"], seven["vessel_name"]) == \
        ("2024-01-01 00:00:00", "1.0", "2.0", "3.0", 'A, "B"')


def test_times_with_zones_and_slashes(spark):
    texts = {"2024-01-15T08:00:00Z": "2024-01-15 08:00:00", "2024-01-15 08:00:00+02:30": "2024-01-15 05:30:00",
             "2024-01-15T08:00:00.25-0100": "2024-01-15 09:00:00.25", "01/15/2024 09:00:00": "2024-01-15 09:00:00",
             "2024/01/15 09:00": "2024-01-15 09:00:00", "2024-01-15": "2024-01-15 00:00:00", "2024-01-15 08:00 UTC": "2024-01-15 08:00:00",
             "2024-13-01": None, "Z": None, "": None}
    df = spark.createDataFrame([(t,) for t in texts], "base_datetime string").withColumn("t", F.col("base_datetime"))
    got = {r["t"]: r["s"] for r in coerce_types(df).select("t", F.col("base_datetime").cast("string").alias("s")).collect()}
    assert got == texts


def test_skip_then_normal_run(spark, tmp_path):
    from trackline.plans.pipeline import run_pipeline
    src = _write(tmp_path, "a.csv", SAMPLE_CSV + "9,not a time,1,2,3\n")
    run_pipeline(spark, str(tmp_path / "store"), paths=[src], skip_processing=True)
    done = run_pipeline(spark, str(tmp_path / "store"), paths=[src], skip_stats=True)
    # the raw rows are stored already; the bad time came with them
    assert spark.read.parquet(done.positions_path).count() == len(SAMPLE) + 1
    assert spark.read.parquet(done.metrics_path).count() == len({r["mmsi"] for r in SAMPLE})
