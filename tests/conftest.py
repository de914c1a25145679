from __future__ import annotations

import csv
import datetime as dt
import io
import math
import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trackline.session import local_session
    s = local_session("*", 8, app="trackline-tests")
    yield s
    s.stop()


HEADER = ("MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselName,IMO,CallSign,VesselType,Status,Length,Width,Draft,Cargo,"
          "TransceiverClass")


def _sample_tracks(seed: int = 41) -> list[dict]:
    """Reports of nine vessels by random walks: uneven times, gaps of days, one over the date line, one with a single report."""
    draw = random.Random(seed)
    out = []
    for v, reports in enumerate([11, 1, 6, 4, 8, 2, 13, 5, 7]):
        mmsi = 200_000_000 + draw.randrange(10 ** 8)
        at = dt.datetime(2024, 2, 27, draw.randrange(24), draw.randrange(60), draw.randrange(60))
        lat, lon, speed = draw.uniform(-55, 55), draw.uniform(-150, 150), draw.choice([0.0, 0.4, 6.0, 15.0])
        if v == 4:
            lon, speed = 179.62, 14.0  # eastward over the date line
        base = draw.choice(["KESTREL", "Grey Heron", 'MOLLY "M"', "ØRN, II", ""])
        name = f"{base} {v}" if base else ""
        for _ in range(reports):
            sog = max(0.0, round(speed + draw.uniform(-1.5, 1.5), 1)) if speed else draw.choice([0.0, 0.1, 0.9])
            out.append({"mmsi": mmsi, "at": at, "lat": round(lat, 5), "lon": round(lon, 5), "sog": sog, "name": name,
                        "kind": draw.choice(["30", "52", "60", "70", "80", "99"]), "status": draw.choice(["0", "1", "5", ""])})
            at += dt.timedelta(seconds=draw.choice([10, 61, 540, 3599, 3600, 7300, 40_000, 190_000]))
            lat += draw.uniform(-0.2, 0.2) * (speed > 1)
            lon = (lon + (0.21 if v == 4 else draw.uniform(-0.3, 0.3)) * (speed > 1) + 180) % 360 - 180
    draw.shuffle(out)
    return out


SAMPLE = _sample_tracks()


def _csv(rows: list[dict]) -> str:
    text = io.StringIO()
    w = csv.writer(text, lineterminator="\n")
    for r in rows:
        w.writerow([r["mmsi"], r["at"].isoformat(sep=" "), r["lat"], r["lon"], r["sog"], 90, "", r["name"], "", "", r["kind"], r["status"],
                    "", "", "", "", "B"])
    return f"{HEADER}\n{text.getvalue()}"


SAMPLE_CSV = _csv(SAMPLE)


def haversine(lat1, lon1, lat2, lon2):
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 3440.065 * math.asin(math.sqrt(h))


def geodesic(lat1, lon1, lat2, lon2):
    """Vincenty's inverse formula to the end, in nautical miles."""
    f, a = 1 / 298.257223563, 6378137.0
    u, v = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    wanted = lam = math.radians((lon2 - lon1 + 180) % 360 - 180)
    for _ in range(100):
        s = math.hypot(math.cos(v) * math.sin(lam), math.cos(u) * math.sin(v) - math.sin(u) * math.cos(v) * math.cos(lam))
        if s == 0:
            return 0.0
        c = math.sin(u) * math.sin(v) + math.cos(u) * math.cos(v) * math.cos(lam)
        sigma, alpha = math.atan2(s, c), math.cos(u) * math.cos(v) * math.sin(lam) / s
        q = 1 - alpha * alpha
        m = c - 2 * math.sin(u) * math.sin(v) / q if q else 0.0
        w = f / 16 * q * (4 + f * (4 - 3 * q))
        before, lam = lam, wanted + (1 - w) * f * alpha * (sigma + w * s * (m + w * c * (2 * m * m - 1)))
        if abs(lam - before) < 1e-14:
            break
    t = q * (1 / (1 - f) ** 2 - 1)
    big = 1 + t / 16384 * (4096 + t * (t * (320 - 175 * t) - 768))
    small = t / 1024 * (256 + t * (t * (74 - 47 * t) - 128))
    cut = small * s * (m + small / 4 * (c * (2 * m * m - 1) - small / 6 * m * (4 * s * s - 3) * (4 * m * m - 3)))
    return (1 - f) * a * big * (sigma - cut) / 1852


def walked(rows: list[dict], distance=geodesic) -> dict[int, dict]:
    """Metrics of each vessel by walking its reports in order of time."""
    out = {}
    for mmsi in {r["mmsi"] for r in rows}:
        own = sorted((r for r in rows if r["mmsi"] == mmsi), key=lambda r: r["at"])
        legs = list(zip(own, own[1:]))
        hours = [(b["at"] - a["at"]).total_seconds() / 3600 for a, b in legs]
        moving = sum(h for h, (a, b) in zip(hours, legs) if (a["sog"] + b["sog"]) / 2 >= 1)
        out[mmsi] = {"vessel_name": own[0]["name"].strip() or "Unknown", "point_count": len(own), "total_time_hours": sum(hours),
                     "total_distance_nm": sum(distance(a["lat"], a["lon"], b["lat"], b["lon"]) for a, b in legs),
                     "moving_time_hours": moving, "at_dock_time_hours": sum(hours) - moving,
                     "avg_speed_knots": sum(r["sog"] for r in own) / len(own), "max_speed_knots": max(r["sog"] for r in own)}
    return out


@pytest.fixture()
def tmpdir_shared(tmp_path):
    return str(tmp_path)


@pytest.fixture()
def sample_path(tmp_path):
    p = tmp_path / "sample.csv"
    p.write_text(SAMPLE_CSV)
    return str(p)


def positions_df(spark, rows):
    """Typed positions from (mmsi, 'YYYY-mm-dd HH:MM:SS', lat, lon, sog[, name]) tuples."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("mmsi", T.LongType()), T.StructField("ts", T.StringType()),
        T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
        T.StructField("sog", T.DoubleType()), T.StructField("vessel_name", T.StringType()),
    ])
    full = [tuple(r) + (("V",) if len(r) == 5 else ()) for r in rows]
    df = spark.createDataFrame(full, schema)
    return (df.withColumn("base_datetime", F.col("ts").cast("timestamp_ntz")).drop("ts")
            .withColumn("ingest_seq", F.monotonically_increasing_id()))
