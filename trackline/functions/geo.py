"""Distance functions as native SQL expressions (no Python per row).

The ellipsoidal distance is Vincenty's inverse method on WGS-84,
unrolled into a fixed number of staged projections: each stage only names
columns of earlier stages, so Catalyst keeps the stages apart (an upper
project references the expensive lower ones several times, so they are not
inlined) and whole-stage codegen compiles the lot into one loop.

That iteration does not settle where the points are nearly antipodal.  Such rows
(and no others: the branch is not entered) are solved for the azimuth at the first
point, by Newton steps, or halvings of the bracket where a step does not halve the last one, on the exact integrals for
longitude and length, so every pair of points has its distance.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.schema import EARTH_RADIUS_NM, METERS_PER_NM, WGS84_A, WGS84_F

# Four iterations: the correction shrinks by a factor ~f (1/298) per step, and
# the last one enters the angle to first order (its slope is the sine of the
# azimuth at the equator); a fifth makes the generated method too large for
# the JIT (measured 6x slower per row).
VINCENTY_ITERATIONS = 4
# A leg whose longitude iteration still moves by more than this after the last
# stage did not converge (nearly antipodal points); the second solver takes it.
VINCENTY_TOLERANCE = 1e-10
FAR_ARC = 2.8  # beyond this angle, in radians, the second solver is asked without waiting for the first
AZIMUTH_STEPS = 60  # at most: some ten of Newton's end most searches; a bracket halves at worst
# Integrals are series by powers of u = k2 sin^2 < 0.0068; what is left out is below a double's last digit for the
# length (in radii) and the longitude (times f), and 1e-7 for the slope, which only directs steps.
LENGTH_ORDER, LONGITUDE_ORDER, SLOPE_ORDER = 6, 4, 3


def _d(x: float) -> str:
    """A DOUBLE literal that both Spark and DuckDB parse as DOUBLE (not DECIMAL)."""
    return "%.17e" % x


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in nautical miles (R = 3440.065), atan2 form."""
    a = (
        f"(sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2))"
    )
    return f"({_d(EARTH_RADIUS_NM)} * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def haversine_nm(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Column form of :func:`haversine_sql` for DataFrame code."""
    la1, lo1, la2, lo2 = (F.radians(F.col(c) if isinstance(c, str) else c) for c in (lat1, lon1, lat2, lon2))
    dlat, dlon = la2 - la1, lo2 - lo1
    a = F.sin(dlat / 2) * F.sin(dlat / 2) + F.cos(la1) * F.cos(la2) * F.sin(dlon / 2) * F.sin(dlon / 2)
    return F.lit(EARTH_RADIUS_NM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def vincenty_stages(lat1: str, lon1: str, lat2: str, lon2: str, out: str,
                    iterations: int = VINCENTY_ITERATIONS, p: str = "_v") -> list[list[tuple[str, str]]]:
    """Stages of (alias, sql) pairs computing WGS-84 inverse distance in nm into ``out``.

    Stage k only references input columns and aliases of stages < k.
    """
    a, f = WGS84_A, WGS84_F
    b = (1 - f) * a
    stages: list[list[tuple[str, str]]] = []
    stages.append([
        (f"{p}L", f"radians({lon2} - {lon1})"),
        (f"{p}U1", f"atan({_d(1 - f)} * tan(radians({lat1})))"),
        (f"{p}U2", f"atan({_d(1 - f)} * tan(radians({lat2})))"),
    ])
    stages.append([
        (f"{p}sU1", f"sin({p}U1)"), (f"{p}cU1", f"cos({p}U1)"),
        (f"{p}sU2", f"sin({p}U2)"), (f"{p}cU2", f"cos({p}U2)"),
        (f"{p}lam0", f"{p}L"),
    ])
    for k in range(1, iterations + 1):
        lam = f"{p}lam{k - 1}"
        stages.append([
            (f"{p}sl{k}", f"sin({lam})"),
            (f"{p}cl{k}", f"cos({lam})"),
        ])
        sl, cl = f"{p}sl{k}", f"{p}cl{k}"
        stages.append([
            (f"{p}ss{k}", f"sqrt(({p}cU2 * {sl}) * ({p}cU2 * {sl})"
                          f" + ({p}cU1 * {p}sU2 - {p}sU1 * {p}cU2 * {cl})"
                          f" * ({p}cU1 * {p}sU2 - {p}sU1 * {p}cU2 * {cl}))"),
            (f"{p}cs{k}", f"({p}sU1 * {p}sU2 + {p}cU1 * {p}cU2 * {cl})"),
        ])
        ss, cs = f"{p}ss{k}", f"{p}cs{k}"
        stages.append([
            (f"{p}sig{k}", f"atan2({ss}, {cs})"),
            (f"{p}sa{k}", f"CASE WHEN {ss} = 0 THEN CAST(0 AS DOUBLE) ELSE {p}cU1 * {p}cU2 * {sl} / {ss} END"),
        ])
        sa = f"{p}sa{k}"
        stages.append([(f"{p}ca{k}", f"(1 - {sa} * {sa})")])
        ca = f"{p}ca{k}"
        stages.append([
            (f"{p}c2m{k}", f"CASE WHEN {ca} = 0 THEN CAST(0 AS DOUBLE) ELSE {cs} - 2 * {p}sU1 * {p}sU2 / {ca} END"),
            (f"{p}C{k}", f"({_d(f)} / 16 * {ca} * (4 + {_d(f)} * (4 - 3 * {ca})))"),
        ])
        c2m, C, sig = f"{p}c2m{k}", f"{p}C{k}", f"{p}sig{k}"
        stages.append([
            (f"{p}lam{k}", f"({p}L + (1 - {C}) * {_d(f)} * {sa} * ({sig} + {C} * {ss}"
                           f" * ({c2m} + {C} * {cs} * (-1 + 2 * {c2m} * {c2m}))))"),
        ])
    n = iterations
    ss, cs, sig, ca, c2m = (f"{p}ss{n}", f"{p}cs{n}", f"{p}sig{n}", f"{p}ca{n}", f"{p}c2m{n}")
    usq_factor = (a * a - b * b) / (b * b)
    stages.append([(f"{p}usq", f"({ca} * {_d(usq_factor)})")])
    u2 = f"{p}usq"
    stages.append([
        (f"{p}A", f"(1 + {u2} / 16384 * (4096 + {u2} * (-768 + {u2} * (320 - 175 * {u2}))))"),
        (f"{p}B", f"({u2} / 1024 * (256 + {u2} * (-128 + {u2} * (74 - 47 * {u2}))))"),
    ])
    A, B = f"{p}A", f"{p}B"
    stages.append([
        (f"{p}ds", f"({B} * {ss} * ({c2m} + {B} / 4 * ({cs} * (-1 + 2 * {c2m} * {c2m})"
                   f" - {B} / 6 * {c2m} * (-3 + 4 * {ss} * {ss}) * (-3 + 4 * {c2m} * {c2m}))))"),
    ])
    stages.append([
        (out, f"CASE WHEN {lat1} IS NULL OR {lon1} IS NULL OR {lat2} IS NULL OR {lon2} IS NULL THEN NULL"
              f" WHEN {ss} = 0 AND {cs} > 0 THEN CAST(0 AS DOUBLE)"
              f" WHEN {sig} > {_d(FAR_ARC)} OR abs({p}lam{n} - {p}lam{n - 1}) > {_d(VINCENTY_TOLERANCE)} THEN NULL"
              f" ELSE {_d(b)} * {A} * ({sig} + {p}sa{n} * ({p}lam{n} - {p}lam{n - 1}) - {p}ds) / {_d(METERS_PER_NM)} END"),
    ])
    return stages


def _let(name: str, fields: dict[str, str], body: str) -> str:
    """SQL of ``body`` with a struct ``name`` of values that are worked out once."""
    return f"transform(array(struct({', '.join(f'{sql} AS {c}' for c, sql in fields.items())})), {name} -> {body})[0]"


def _power(power: float, order: int) -> np.ndarray:
    """Coefficients by powers of u of (1 + u) to a power."""
    return np.cumprod([1.0, *((power - j) / (j + 1) for j in range(order))])


def _inverse(c: np.ndarray) -> np.ndarray:
    """Coefficients of one over the series with these coefficients."""
    out = np.zeros(len(c))
    out[0] = 1 / c[0]
    for k in range(1, len(c)):
        out[k] = -np.dot(c[1:k + 1], out[k - 1::-1][:k]) / c[0]
    return out


def _horner(coefficients: list[str], x: str) -> str:
    return reduce(lambda total, c: f"({c} + {x} * {total})", reversed(coefficients))


def _weights(series: np.ndarray, k2: str) -> dict[str, str]:
    """Weights w of the integral of sum(a[j] * (k2 sin^2)^j): w0 times the arc, less what :func:`_end` gives at its ends.

    From S[j] = ((2j - 1) S[j-1] - sin^(2j-1) cos) / 2j for the integral S[j] of sin^2j; each w is a polynomial in k2.
    """
    w = [[float(series[-1])]]
    for j in range(len(series) - 1, 0, -1):
        w.insert(0, [float(series[j - 1]), *(c * (2 * j - 1) / (2 * j) for c in w[0])])
    return {f"w{j}": _horner([f"({_d(c / (2 * j) if j else c)})" for c in own], k2) for j, own in enumerate(w)}


def _integral(series: np.ndarray, v: str) -> str:
    """Over the arc ``v``, of a series by powers of k2 sin^2; e is k2 sin cos at an end of it and u is k2 sin^2."""
    end = lambda i: f"{v}.e{i} * " + _horner([f"w.w{j}" for j in range(1, len(series))], f"{v}.u{i}")
    return _let("w", _weights(series, f"{v}.k2"), f"(w.w0 * {v}.arc - {end(2)} + {end(1)})")


def antipodal_nm(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """WGS-84 distance in nm of two columns' points by the azimuth at the first one; for any points but very near ones.

    The points are put so that the first is the southern one, at least as far from the equator as the other;
    the longitude a geodesic reaches at the other's latitude then grows with its azimuth from 0 to 180 degrees.
    A search that has settled takes no more steps.
    """
    a, f = WGS84_A, WGS84_F
    b, second = (1 - f) * a, (2 - f) * f / (1 - f) ** 2  # second eccentricity, squared
    # with u = k2 sin^2: length by sqrt(1 + u), longitude by (2 - f) / (1 + (1 - f) sqrt(1 + u)), slope by u / sqrt(1 + u)
    root = _power(0.5, LENGTH_ORDER)
    longitude = (2 - f) * _inverse(np.concatenate([[2 - f], (1 - f) * root[1:]]))[:LONGITUDE_ORDER + 1]
    reduction = np.concatenate([[0.0], _power(-0.5, SLOPE_ORDER - 1)])

    def on_arc(azimuth: str, body: str) -> str:
        """``body`` of the arc ``v`` from the first point ``p`` at an azimuth to the latitude of the other."""
        sphere = {"s0": "h.sa * p.c1", "y1": "h.ca * p.c1", "y2": "sqrt(greatest(h.ca * p.c1 * (h.ca * p.c1) + (p.c2 * p.c2 - p.c1 * p.c1), 0D))",
                  "k2": f"{_d(second)} * (h.ca * h.ca + h.sa * h.sa * p.s1 * p.s1)"}
        arcs = {"s0": "h.s0", "y2": "h.y2", "k2": "h.k2", "g1": "atan2(p.s1, h.y1)", "g2": "atan2(p.s2, h.y2)",
                "w": "atan2(h.s0 * p.s2, h.y2) - atan2(h.s0 * p.s1, h.y1)"}
        ends = {"s0": "h.s0", "y2": "h.y2", "k2": "h.k2", "w": "h.w", "arc": "h.g2 - h.g1",
                "s1": "sin(h.g1)", "c1": "cos(h.g1)", "s2": "sin(h.g2)", "c2": "cos(h.g2)"}
        squares = {**{c: f"h.{c}" for c in ends}, **{f"e{i}": f"h.k2 * h.s{i} * h.c{i}" for i in (1, 2)}, **{f"u{i}": f"h.k2 * h.s{i} * h.s{i}" for i in (1, 2)}}
        return _let("h", {"sa": f"sin({azimuth})", "ca": f"cos({azimuth})"},
                    _let("h", sphere, _let("h", arcs, _let("h", ends, _let("v", squares, body)))))

    # off: longitude beyond the wanted one; slope: of it by azimuth
    reduced = f"(sqrt(1 + v.u2) * v.c1 * v.s2 - sqrt(1 + v.u1) * v.s1 * v.c2 - v.c1 * v.c2 * {_integral(reduction, 'v')})"
    reached = {"off": f"v.w - {_d(f)} * v.s0 * {_integral(longitude, 'v')} - p.lam", "slope": f"CASE WHEN v.y2 > 0 THEN {_d(b / a)} * {reduced} / v.y2 END"}
    newton = {"low": "if(e.off > 0, t.low, t.x)", "high": "if(e.off > 0, t.x, t.high)", "done": "abs(e.off) < 1e-14D",
              "to": "CASE WHEN e.slope > 0 THEN t.x - e.off / e.slope END"}
    sure = "n.to >= n.low AND n.to <= n.high AND (n.done OR n.to <> t.x AND abs(n.to - t.x) <= t.moved / 2)"
    # settled without a step to trust: the azimuth stays where it is
    chosen = {"low": "n.low", "high": "n.high", "done": "n.done", "to": f"CASE WHEN {sure} THEN n.to WHEN n.done THEN t.x ELSE (n.low + n.high) / 2 END"}
    step = on_arc("t.x", _let("e", reached, _let("n", newton, _let(
        "n", chosen, "struct(n.low AS low, n.high AS high, n.to AS x, abs(n.to - t.x) AS moved, n.done AS done)"))))
    first = f"struct(0D AS low, {_d(math.pi)} AS high, {_d(math.pi / 2)} AS x, {_d(math.pi)} AS moved, false AS done)"
    azimuth = f"aggregate(sequence(1, {AZIMUTH_STEPS}), {first}, (t, i) -> if(t.done, t, {step}), t -> t.x)"
    metres = _let("z", {"x": azimuth}, on_arc("z.x", f"({_d(b)} * {_integral(root, 'v')})"))

    # a first point on the equator counts as some micrometres south of it
    swapped = "abs(p.u1) < abs(p.u2)"
    far, near = f"if({swapped}, p.u2, p.u1)", f"if({swapped}, p.u1, p.u2)"
    reduced_latitudes = {f"u{i}": f"atan({_d(1 - f)} * tan(radians({c})))" for i, c in ((1, lat1), (2, lat2))}
    reduced_latitudes["lam"] = f"radians(abs(pmod({lon2} - {lon1} + 180, 360D) - 180))"
    ordered = {"b1": "least(-abs(p.far), -1e-12D)", "b2": "if(p.far > 0, -p.near, p.near)", "lam": "p.lam"}
    points = {"s1": "sin(p.b1)", "c1": "cos(p.b1)", "s2": "sin(p.b2)", "c2": "cos(p.b2)", "lam": "p.lam"}
    return F.expr(_let("p", reduced_latitudes, _let("p", {"far": far, "near": near, "lam": "p.lam"}, _let("p", ordered, _let(
        "p", points, f"{metres} / {_d(METERS_PER_NM)}")))))


def stage_columns(stages: list[list[tuple[str, str]]]) -> list[str]:
    return [alias for stage in stages for alias, _ in stage]


def with_distance(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str, out: str,
                  method: str = "geodesic", iterations: int = VINCENTY_ITERATIONS) -> DataFrame:
    """Add column ``out`` = distance in nm between the two points of each row.

    ``method`` is ``"geodesic"`` (WGS-84 ellipsoid, the default) or ``"haversine"``.
    """
    if method == "haversine":
        return df.withColumn(out, F.expr(haversine_sql(lat1, lon1, lat2, lon2)))
    if method != "geodesic":
        raise ValueError(f"unknown distance method {method!r}")
    stages = vincenty_stages(lat1, lon1, lat2, lon2, out, iterations)
    # One select; later stages name earlier aliases (lateral column aliases),
    # and the analyzer builds one projection per dependency level.
    df = df.select("*", *[F.expr(sql).alias(alias) for stage in stages for alias, sql in stage])
    temps = [c for c in stage_columns(stages) if c != out]
    df = df.drop(*temps)
    known = reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in (lat1, lon1, lat2, lon2)))
    return df.withColumn(out, F.when(F.col(out).isNull() & known, antipodal_nm(lat1, lon1, lat2, lon2)).otherwise(F.col(out)))


def register_sql_functions(spark) -> None:
    """Register ``calculate_distance_nm(lat1, lon1, lat2, lon2)`` as a SQL function.

    A SQL-bodied function is inlined by the analyzer, so it stays in codegen.
    """
    body = haversine_sql("lat1", "lon1", "lat2", "lon2")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION calculate_distance_nm("
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE "
        f"RETURN {body}"
    )
