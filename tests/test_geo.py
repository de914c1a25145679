import pytest
from pyspark.sql import functions as F

from trackline.functions.geo import register_sql_functions, with_distance


def _dist(spark, pairs, method="geodesic"):
    df = spark.createDataFrame(pairs, "lat1 double, lon1 double, lat2 double, lon2 double")
    return [r["d"] for r in with_distance(df, "lat1", "lon1", "lat2", "lon2", "d", method).collect()]


def test_geodesic_reference_lengths(spark):
    d = _dist(spark, [(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (10.0, 179.9, 10.0, -179.9)])
    assert d[0] * 1852 == pytest.approx(110574.3886, abs=1e-3)
    assert d[1] * 1852 == pytest.approx(111319.4908, abs=1e-3)
    assert d[2] == pytest.approx(11.840104, abs=1e-6)


def test_geodesic_edges(spark):
    d = _dist(spark, [(35.0, -5.0, 35.0, -5.0), (90.0, 0.0, 89.0, 0.0), (None, 1.0, 2.0, 3.0),
                      (12.0, 40.0, -7.5, 88.0), (-7.5, 88.0, 12.0, 40.0)])
    assert d[0] == 0.0
    assert d[1] > 0
    assert d[2] is None
    assert d[3] == pytest.approx(d[4], rel=1e-12)  # symmetric


#: Published lengths in metres of geodesics between nearly antipodal points, and of a meridian from pole to pole.
PUBLISHED = [((0.0, 0.0, 0.5, 179.5), 19936288.579), ((0.0, 0.0, 0.5, 179.7), 19944127.421), ((-30.0, 0.0, 29.9, 179.8), 19989832.82761),
             ((90.0, 0.0, -90.0, 0.0), 20003931.4586), ((0.0, 0.0, 0.0, 180.0), 20003931.4586), ((30.0, 10.0, -30.0, -170.0), 20003931.4586)]


def test_nearly_antipodal_points(spark):
    pairs = [p for p, _ in PUBLISHED]
    turned = [(c, d, a, b) for a, b, c, d in pairs] + [(-a, -b, -c, -d) for a, b, c, d in pairs]
    got = [x * 1852 for x in _dist(spark, pairs + turned)]
    for x, (_, metres) in zip(got, PUBLISHED * 3):
        assert x == pytest.approx(metres, abs=1e-3)


def _by_bisection(lat1, lon1, lat2, lon2):
    """Metres, by halving the azimuth's bracket and Simpson's rule; for points far apart."""
    import math
    f, a = 1 / 298.257223563, 6378137.0
    b1, b2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    lam = math.radians(abs((lon2 - lon1 + 180) % 360 - 180))
    if abs(b1) < abs(b2):
        b1, b2 = b2, b1
    if b1 > 0:
        b1, b2 = -b1, -b2
    e2 = f * (2 - f) / (1 - f) ** 2

    def go(alpha):
        s0, y1 = math.sin(alpha) * math.cos(b1), math.cos(alpha) * math.cos(b1)
        y2 = math.sqrt(max(0.0, y1 * y1 + math.cos(b2) ** 2 - math.cos(b1) ** 2))
        k2, g1, g2 = e2 * (1 - s0 * s0), math.atan2(math.sin(b1), y1), math.atan2(math.sin(b2), y2)
        n, h = 200, (g2 - g1) / 200
        r = [math.sqrt(1 + k2 * math.sin(g1 + i * h) ** 2) for i in range(n + 1)]
        simpson = lambda y: h / 3 * (y[0] + y[-1] + 4 * sum(y[1:-1:2]) + 2 * sum(y[2:-1:2]))
        w = math.atan2(s0 * math.sin(b2), y2) - math.atan2(s0 * math.sin(b1), y1)
        return w - f * s0 * simpson([(2 - f) / (1 + (1 - f) * x) for x in r]), a * (1 - f) * simpson(r)

    low, high = 0.0, math.pi
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if go(mid)[0] > lam else (mid, high)
    return go((low + high) / 2)[1]


def test_long_legs_against_bisection(spark):
    """Every pair has a distance, wherever the first iteration ends."""
    import random
    draw = random.Random(5)
    pairs = [(0.0, 0.0, 5.0, 170.0), (0.0, 0.0, 20.0, 160.0), (10.0, 0.0, -8.0, 175.0)]
    for _ in range(150):
        lat, lon = draw.uniform(-89, 89), draw.uniform(-180, 180)
        off = draw.choice([0.01, 0.5, 3, 12])
        pairs.append((lat, lon, max(-90.0, min(90.0, -lat + draw.uniform(-off, off))), (lon + 180 + draw.uniform(-off, off) + 180) % 360 - 180))
    for p, nm in zip(pairs, _dist(spark, pairs)):
        assert nm * 1852 == pytest.approx(_by_bisection(*p), abs=1e-3), p


def test_settled_search_takes_no_more_steps(spark, monkeypatch):
    """Fifty times the steps allowed give the same lengths in hardly more time."""
    import random
    import time

    from trackline.functions import geo
    draw = random.Random(6)
    pairs = [(lat, lon, -lat + draw.uniform(-1, 1), lon + 180 + draw.uniform(-1, 1)) for lat, lon in (
        (draw.uniform(-60, 60), draw.uniform(-170, -1)) for _ in range(600))]
    _dist(spark, pairs)
    begun = time.perf_counter()
    few = _dist(spark, pairs)
    middle = time.perf_counter()
    monkeypatch.setattr(geo, "AZIMUTH_STEPS", 50 * geo.AZIMUTH_STEPS)
    many = _dist(spark, pairs)
    assert time.perf_counter() - middle < 2 * (middle - begun) + 3
    assert many == pytest.approx(few, abs=1e-6)


def test_haversine_and_sql_function(spark):
    register_sql_functions(spark)
    v = spark.sql("SELECT calculate_distance_nm(0.0, 0.0, 1.0, 0.0) AS d").collect()[0]["d"]
    assert v == pytest.approx(3440.065 * 3.141592653589793 / 180, rel=1e-12)
    assert _dist(spark, [(0.0, 0.0, 1.0, 0.0)], "haversine")[0] == pytest.approx(v, rel=1e-12)


def test_geodesic_stays_native(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("a"))
    out = with_distance(df, "a", "a", "a", "a", "d")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
