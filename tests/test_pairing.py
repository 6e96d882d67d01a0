"""Interpolation numerics on analytic fields, time handling and search
exactness (the reference mocks its interpolator; these pin ours)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from skyscore.operators import pairing as pr
from skyscore.operators.dedup import drop_duplicate_times, keep_first

T0 = dt.datetime(2024, 1, 1)


def grid(spark, f, step=10.0, times=(T0,)):
    a0, b0 = -90.0 + step / 2, -180.0 + step / 2
    rows = [(t, a0 + step * i, b0 + step * j, f(a0 + step * i, b0 + step * j))
            for t in times for i in range(int(180 / step)) for j in range(int(360 / step))]
    return spark.createDataFrame(rows, "time timestamp, lat double, lon double, v double")


def points(spark, coords, t=T0):
    return spark.createDataFrame([(k, t, la, lo) for k, (la, lo) in enumerate(coords)],
                                 "site_id long, time timestamp, lat double, lon double")


def test_bilinear_exact_on_linear_field(spark):
    g = grid(spark, lambda la, lo: 2.0 * la - 0.5 * lo + 3.0)
    rnd = random.Random(1)
    pts = [(rnd.uniform(-80, 80), rnd.uniform(-170, 170)) for _ in range(50)]
    out = pr.pair_bilinear(g, points(spark, pts), "v").collect()
    for r in out:
        assert r["v"] == pytest.approx(2.0 * r["lat"] - 0.5 * r["lon"] + 3.0, rel=1e-9)


def test_constant_field_all_methods(spark):
    g = grid(spark, lambda la, lo: 7.0)
    pts = points(spark, [(1.2, 3.4), (-44.4, 170.1), (60.0, -179.0)])
    for fn in (pr.pair_nearest, pr.pair_bilinear):
        assert {round(r["v"], 12) for r in fn(g, pts, "v").collect()} == {7.0}
    tgt = grid(spark, lambda la, lo: 0.0, step=15.0).select("lat", "lon")
    for m in ("nearest", "bilinear", "conservative"):
        vals = {round(r["v"], 12) for r in pr.regrid(g, tgt, "v", m).collect() if r["v"] is not None}
        assert vals == {7.0}, m


def test_conservative_preserves_area_integral(spark):
    g = grid(spark, lambda la, lo: math.cos(math.radians(lo)) + la / 90.0)
    tgt = grid(spark, lambda la, lo: 0.0, step=30.0).select("lat", "lon")
    out = pr.regrid(g, tgt, "v", "conservative")

    def integral(df, step):
        w = (F.sin(F.radians(F.col("lat") + step / 2)) - F.sin(F.radians(F.col("lat") - step / 2))) * step
        return df.agg(F.sum(w * F.col("v")) / F.sum(w)).first()[0]
    assert integral(out, 30.0) == pytest.approx(integral(g, 10.0), rel=1e-9, abs=1e-12)


def test_nearest_ties_go_to_upper_cell(spark):
    g = grid(spark, lambda la, lo: la)
    out = pr.pair_nearest(g, points(spark, [(0.0, 0.0)]), "v").first()
    assert out["v"] == 5.0   # 0 is half-way between cells -5 and 5


def test_repeated_times_survive_pairing(spark):
    g = grid(spark, lambda la, lo: 1.0)
    pts = spark.createDataFrame([(T0, 1.0, 1.0, k) for k in range(3)],
                                "time timestamp, lat double, lon double, val int")
    assert pr.pair_nearest(g, pts, "v").count() == 3
    assert drop_duplicate_times(pts, kind="point").count() == 3
    assert drop_duplicate_times(pts, kind="table", order="val").count() == 1


def test_keep_first_by_order(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, o int, v string")
    got = {r["k"]: r["v"] for r in keep_first(df, ["k"], ["o"]).collect()}
    assert got == {"a": "y", "b": "z"}


def test_interp_time_linear(spark):
    model = spark.createDataFrame([(T0, 0.0), (T0 + dt.timedelta(hours=3), 3.0), (T0 + dt.timedelta(hours=6), 9.0)],
                                  "time timestamp, v double")
    pts = spark.createDataFrame([(T0 + dt.timedelta(hours=h),) for h in (0, 1, 4.5, 6, 7)], "time timestamp")
    got = {r["time"]: r["v"] for r in pr.pair_interp_time(model, pts, "v", bucket_seconds=3600).collect()}
    assert got[T0] == 0.0
    assert got[T0 + dt.timedelta(hours=1)] == pytest.approx(1.0)
    assert got[T0 + dt.timedelta(hours=4.5)] == pytest.approx(6.0)
    assert got[T0 + dt.timedelta(hours=6)] == 9.0
    assert got[T0 + dt.timedelta(hours=7)] is None


def test_asof_tolerance_and_ties(spark):
    model = spark.createDataFrame([(T0, 1.0), (T0 + dt.timedelta(minutes=20), 2.0)], "time timestamp, v double")
    pts = spark.createDataFrame([(T0 + dt.timedelta(minutes=10),), (T0 + dt.timedelta(hours=5),)], "time timestamp")
    got = {r["time"]: r["v"] for r in pr.pair_asof(pts, model, "v", tolerance_seconds=1800).collect()}
    assert got[T0 + dt.timedelta(minutes=10)] == 1.0   # tie -> earlier model time
    assert got[T0 + dt.timedelta(hours=5)] is None


def test_curvilinear_matches_brute_force(spark):
    rnd = random.Random(3)
    cells = [(k, rnd.uniform(-60, 60), rnd.uniform(-120, 120)) for k in range(300)]
    sites = [(rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for _ in range(100)]
    cdf = spark.createDataFrame(cells, "cell_id long, lat double, lon double")
    sdf = spark.createDataFrame(sites, "lat double, lon double")
    got = {(r["lat"], r["lon"]): r["cell_id"] for r in pr.pair_nearest_curvilinear(cdf, sdf, tile=2.0).collect()}
    for la, lo in sites:
        best = min(cells, key=lambda c: ((la - c[1]) ** 2 + (lo - c[2]) ** 2, c[0]))[0]
        assert got[(la, lo)] == best


def test_inferred_axes(spark):
    g = grid(spark, lambda la, lo: 0.0)
    a = pr.axes_row(pr.grid_axes(g))
    assert (a["a0"], a["ad"], a["an"], a["ap"]) == (-85.0, 10.0, 18, False)
    assert (a["b0"], a["bd"], a["bn"], a["bp"]) == (-175.0, 10.0, 36, True)


def test_suffixes_and_merge(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, v double")
    b = spark.createDataFrame([(1, 3.0)], "k int, v double")
    s, t = pr.suffix_clashes(a, b, ["k"])
    assert s.columns == ["k", "v_source"] and t.columns == ["k", "v_target"]


def test_asof_matches_brute_force(spark):
    rnd = random.Random(9)
    model = [(rnd.randint(0, 2), T0 + dt.timedelta(minutes=rnd.randint(0, 600)), float(rnd.randint(0, 5)))
             for _ in range(300)]
    pts = [(rnd.randint(0, 2), T0 + dt.timedelta(minutes=rnd.randint(-60, 660))) for _ in range(200)]
    mdf = spark.createDataFrame(model, "k int, time timestamp, v double")
    pdf = spark.createDataFrame(pts, "k int, time timestamp")
    got = {(r["k"], r["time"]): (r["model_time"], r["v"])
           for r in pr.pair_asof(pdf, mdf, "v", keys=["k"], tolerance_seconds=1200).collect()}
    for k, t in pts:
        cands = [(abs((mt - t).total_seconds()), mt, v) for kk, mt, v in model
                 if kk == k and abs((mt - t).total_seconds()) <= 1200]
        exp = (min(cands)[1], min(cands)[2]) if cands else (None, None)
        assert got[(k, t)] == exp


def test_pair_data_interp_time_and_suffix(spark):
    t1 = T0 + dt.timedelta(hours=6)
    g = grid(spark, lambda la, lo: 2.0 * la + lo, times=(T0,)).unionByName(
        grid(spark, lambda la, lo: 2.0 * la + lo + 6.0, times=(t1,)))
    pts = spark.createDataFrame([(T0 + dt.timedelta(hours=3), 1.0, 2.0, 99.0)],
                                "time timestamp, lat double, lon double, v double")
    for method in ("nearest", "bilinear"):
        r = pr.pair_data(g, pts, "v", method=method, interp_time=True, bucket_seconds=3600).first()
        assert r["v_target"] == 99.0                       # obs column renamed
        exp = (2.0 * 5.0 + 5.0 + 3.0) if method == "nearest" else (2.0 * 1.0 + 2.0 + 3.0)
        assert r["v_source"] == pytest.approx(exp), method


def test_pair_data_time_trunc(spark):
    g = grid(spark, lambda la, lo: 4.0)
    pts = points(spark, [(1.0, 1.0)], t=T0 + dt.timedelta(minutes=40))
    assert pr.pair_data(g, pts, "v", time_trunc="hour").first()["v"] == 4.0
    assert pr.pair_data(g, pts, "v").first()["v"] is None


def test_bilinear_across_the_dateline(spark):
    """Global longitudes are periodic: a point between the last and the first
    cell blends both (the wrap cell)."""
    g = grid(spark, lambda la, lo: math.cos(math.radians(lo)) + la)
    pts = points(spark, [(1.0, 180.0), (1.0, -178.0)])
    got = {r["lon"]: r["v"] for r in pr.pair_bilinear(g, pts, "v").collect()}
    c175 = math.cos(math.radians(175.0))
    assert got[180.0] == pytest.approx(c175 + 1.0)
    assert got[-178.0] == pytest.approx(0.3 * c175 + 0.7 * math.cos(math.radians(-175.0)) + 1.0)


def test_great_circle_nearest_matches_brute_force(spark):
    rnd = random.Random(8)
    cells = [(k, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for k in range(400)]
    sites = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(150)] + [(0.0, 179.99), (89.9, 10.0)]
    cdf = spark.createDataFrame(cells, "cell_id long, lat double, lon double")
    sdf = spark.createDataFrame(sites, "lat double, lon double")
    got = {(r["lat"], r["lon"]): (r["cell_id"], r["distance_km"])
           for r in pr.pair_nearest_great_circle(cdf, sdf).collect()}

    def hav(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))
    for la, lo in sites:
        best = min(cells, key=lambda c: hav(la, lo, c[1], c[2]))
        assert got[(la, lo)][0] == best[0]
        assert got[(la, lo)][1] == pytest.approx(hav(la, lo, best[1], best[2]), rel=1e-6)


def test_nearest_cell_far_sites_missing_coordinates_and_date_line(spark):
    cells = spark.createDataFrame([(1, 80.0, 350.0), (2, -10.0, 179.9), (3, -10.0, -170.0), (4, None, 1.0),
                                   (0, 80.0, 350.0)], "cell_id long, lat double, lon double")
    sites = spark.createDataFrame([(-80.0, -170.0), (-10.0, -179.9), (89.9, 170.0), (None, 5.0)],
                                  "lat double, lon double")
    got = {(r["lat"], r["lon"]): (r["cell_id"], r["distance_km"])
           for r in pr.pair_nearest_great_circle(cells, sites).collect()}
    assert {k: v[0] for k, v in got.items()} == {(-80.0, -170.0): 3, (-10.0, -179.9): 2, (89.9, 170.0): 0,
                                                 (None, 5.0): None}
    assert got[(-10.0, -179.9)][1] == pytest.approx(21.9, abs=0.1)
    flat = pr.pair_nearest_curvilinear(cells, sites)
    assert {(r["lat"], r["lon"]): r["cell_id"] for r in flat.collect()} == {
        (-80.0, -170.0): 3, (-10.0, -179.9): 3, (89.9, 170.0): 2, (None, 5.0): None}
    for fn in (pr.pair_nearest_curvilinear, pr.pair_nearest_great_circle):
        assert [r["cell_id"] for r in fn(cells.limit(0), sites).collect()] == [None] * 4


def test_nearest_keeps_points_without_coordinates(spark):
    g = grid(spark, lambda la, lo: la)
    pts = spark.createDataFrame([(T0, None, 1.0, 1), (T0, 1.0, None, 2), (T0, 1.0, 1.0, 3)],
                                "time timestamp, lat double, lon double, an int")
    for fn in (pr.pair_nearest, pr.pair_bilinear):
        got = {r["an"]: r["v"] for r in fn(g, pts, "v").collect()}
        assert got[1] is None and got[2] is None and got[3] is not None and len(got) == 3


def test_bilinear_on_the_last_line(spark):
    rows = [(T0, float(a), float(b), a + 2.0 * b) for a in range(0, 50, 10) for b in range(0, 50, 10)]
    g = spark.createDataFrame(rows, "time timestamp, lat double, lon double, v double")
    got = {(r["lat"], r["lon"]): r["v"] for r in pr.pair_bilinear(
        g, points(spark, [(40.0, 40.0), (40.0, 0.0), (39.0, 40.0), (40.1, 0.0)]), "v").collect()}
    assert got == {(40.0, 40.0): 120.0, (40.0, 0.0): 40.0, (39.0, 40.0): 119.0, (40.1, 0.0): None}


def test_single_precision_axis(spark):
    lon = spark.range(3600).select((F.col("id") * 0.1 - 180.0).cast("float").alias("lon"), F.lit(0.0).alias("lat"))
    a = pr.axes_row(pr.axis_columns(lon, "lon", "b"))
    assert (a["bn"], a["bp"]) == (3600, True)


def test_bilinear_moves_points_once_and_keeps_rows(spark):
    """Repeated grid rows, repeated and missing points, edges and both kinds of
    join as by four look-ups; the points meet the grid in a single join."""
    cells = [(T0, float(a), float(b), float(a * b + a)) for a in range(0, 40, 10) for b in range(0, 40, 10)]
    cells += [(T0, 20.0, 20.0, 5.0), (T0, 0.0, 30.0, None), (None, 10.0, 10.0, 1.0)]
    cells.remove((T0, 30.0, 30.0, 930.0))
    g = spark.createDataFrame(cells, "time timestamp, lat double, lon double, v double")
    pts = [(T0, 5.0, 5.0), (T0, 5.0, 5.0), (T0, 15.0, 15.0), (T0, 25.0, 25.0), (T0, 30.0, 10.0), (T0, 5.0, 25.0), (T0, -5.0, 5.0),
           (T0, -15.0, 5.0), (T0, 5.0, None), (None, 5.0, 5.0), (T0 + dt.timedelta(days=1), 5.0, 5.0)]
    d = spark.createDataFrame([(k, *p) for k, p in enumerate(pts)], "k int, time timestamp, lat double, lon double")
    want = {0: 30.0, 1: 30.0, 5: 130.0}
    # three cells of which one is there twice count as four, as ever: 15/15 and 30/10 have five, 25/25 has four
    want[3] = 0.25 * (20 * 20 + 20 + 5.0 + 20 * 30 + 20 + 30 * 20 + 30)
    out = pr.pair_bilinear(g, d, "v")
    assert out.columns == ["time", "lat", "lon", "k", "v"]
    assert {r["k"]: r["v"] for r in out.collect()} == {k: pytest.approx(want[k]) if k in want else None for k in range(len(pts))}
    inner = {r["k"]: r["v"] for r in pr.pair_bilinear(g, d, "v", how="inner").collect()}
    assert inner == {k: pytest.approx(want[k]) if k in want else None for k in (0, 1, 2, 3, 4, 5, 6, 10)}
    whole = {r["k"]: r["v"] for r in pr.pair_data(g, d, "v", method="bilinear", drop_duplicates=False).collect()}
    assert whole == {k: pytest.approx(want[k]) if k in want else None for k in range(len(pts))}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
