"""Axes at any places, 2-D grids, time gaps, model against model, regions over
the date line, wide neighbourhoods, grouping sets: against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyscore.operators import axes as ax
from skyscore.operators import pairing as pr
from skyscore.operators import stats
from skyscore.operators.distribution import fractions_skill_score, quantiles
from skyscore.operators.plotdata import conditional_quantile
from skyscore.operators.regions import label_regions, region_table

T0 = dt.datetime(2024, 1, 1)
POINT = "site_id long, time timestamp, lat double, lon double"


def grid(spark, lats, lons, f, times=(T0,)):
    return spark.createDataFrame([(t, float(a), float(b), float(f(a, b))) for t in times for a in lats for b in lons],
                                 "time timestamp, lat double, lon double, v double")


def points(spark, coords, t=T0):
    return spark.createDataFrame([(k, t, float(a), float(b)) for k, (a, b) in enumerate(coords)], POINT)


def values(df, col="v"):
    return {r["site_id"]: r[col] for r in df.collect()}


LATS, LONS = (0, 1, 3, 7, 15), (10, 11, 14, 22, 23.5)


def test_uneven_axis_nearest_has_no_gaps_and_a_limit(spark):
    g = grid(spark, LATS, LONS, lambda a, b: 100 * a + b)
    rnd = random.Random(2)
    pts = [(4.4, 12), (9, 12), (12, 12)] + [(rnd.uniform(-0.5, 19), rnd.uniform(9.5, 24.2)) for _ in range(60)]
    pts += [(-0.6, 12), (19.1, 12), (5, 9.4), (5, 24.3)]  # beyond the outermost cells
    got = values(pr.pair_nearest(g, points(spark, pts), "v"))
    for k, (a, b) in enumerate(pts[:-4]):
        want = 100 * min(LATS, key=lambda x: (abs(x - a), -x)) + min(LONS, key=lambda x: (abs(x - b), -x))
        assert got[k] == want, (a, b)
    assert [got[len(pts) - 4 + k] for k in range(4)] == [None] * 4
    far = values(pr.pair_nearest(g, points(spark, pts[-4:]), "v", limit=None))
    assert far == {0: 11.0, 1: 1511.0, 2: 710.0, 3: 723.5}  # 5 is half way between 3 and 7
    near = values(pr.pair_nearest(g, points(spark, [(-1.9, 12), (-2.1, 12)]), "v", limit=2.0))
    assert near == {0: 11.0, 1: None}


def test_uneven_axis_bilinear_is_exact_on_a_linear_field(spark):
    g = grid(spark, LATS, LONS, lambda a, b: 2 * a - 3 * b + 1)
    rnd = random.Random(3)
    pts = [(rnd.uniform(0, 15), rnd.uniform(10, 23.5)) for _ in range(40)] + [(15, 23.5), (0, 10), (15.1, 12)]
    got = values(pr.pair_bilinear(g, points(spark, pts), "v"))
    for k, (a, b) in enumerate(pts[:-1]):
        assert got[k] == pytest.approx(2 * a - 3 * b + 1, abs=1e-9), (a, b)
    assert got[len(pts) - 1] is None


def test_uneven_periodic_axis_wraps(spark):
    lons = [-170, -120, -100, -30, 10, 60, 100, 140]  # the seam is 50 wide
    assert pr.axes_row(pr.grid_axes(grid(spark, (0, 10), lons, lambda a, b: b)))["bp"]
    g = grid(spark, (0, 10), lons, lambda a, b: abs(b))
    got = values(pr.pair_bilinear(g, points(spark, [(5, 165), (5, -195), (5, 190), (5, 525)]), "v"))
    assert all(got[k] == pytest.approx(155.0) for k in (0, 1, 3)) and got[2] == pytest.approx(170.0)
    near = values(pr.pair_nearest(g, points(spark, [(1, 164), (1, 166), (1, 526)]), "v"))
    assert near == {0: 140.0, 1: 170.0, 2: 170.0}


def test_fractional_index_and_line_are_inverse(spark):
    for spec in (ax.LineAxis((0, 1, 3, 7, 15)), ax.LineAxis((-170, -100, 10, 100), True), ax.RegularAxis(-5, 2.5, 7)):
        d = spark.range(-9, 12).withColumns(ax.axis_columns(None, "x", "b", spec))
        for r in d.select("id", ax.fractional_index(ax.line_at(F.col("id"), "b"), "b").alias("f")).collect():
            assert r["f"] == pytest.approx(r["id"], abs=1e-9)


def test_conservative_on_uneven_axes_keeps_the_integral(spark):
    lats = [-85, -65, -30, 10, 20, 45, 80]  # the outermost cells reach the poles
    lons = [-180, -150, -100, -90, -20, 0, 70, 130]  # the seam is 50 wide
    rnd = random.Random(4)
    field = {(a, b): rnd.uniform(0, 9) for a in lats for b in lons}
    g = grid(spark, lats, lons, lambda a, b: field[a, b])
    target = spark.createDataFrame([(float(a), float(b)) for a in range(-85, 86, 10) for b in range(-175, 176, 10)],
                                   "lat double, lon double")
    out = pr.regrid(g, target, "v", "conservative").collect()
    got = sum(r["v"] * 10 * (math.sin(math.radians(r["lat"] + 5)) - math.sin(math.radians(r["lat"] - 5))) for r in out)
    mid = lambda x: [x[0] - (x[1] - x[0]) / 2] + [(p + q) / 2 for p, q in zip(x, x[1:])] + [x[-1] + (x[-1] - x[-2]) / 2]
    la = [max(-90, min(90, v)) for v in mid(lats)]
    lo = [(p + q) / 2 for p, q in zip([130 - 360] + lons, lons + [180])]
    want = sum(field[a, b] * (lo[j + 1] - lo[j]) * (math.sin(math.radians(la[i + 1])) - math.sin(math.radians(la[i])))
               for i, a in enumerate(lats) for j, b in enumerate(lons))
    assert len(out) == target.count() and got == pytest.approx(want, rel=1e-9)


# --- 2-D grids -----------------------------------------------------------------


def curved(spark, f, n=12, shift=0.0):
    rows = []
    for y in range(n):
        for x in range(n):
            lat = -20 + 3 * y + 0.8 * math.sin(x * 0.7)
            lon = shift + 3.5 * x + 1.1 * math.cos(y * 0.6)
            rows.append((T0, y, x, lat, (lon + 180) % 360 - 180, f(lat, lon)))
    return spark.createDataFrame(rows, "time timestamp, y int, x int, lat double, lon double, v double")


@pytest.mark.parametrize("shift", [0.0, 160.0])
def test_bilinear_2d_inside_quads_and_over_the_date_line(spark, shift):
    g = curved(spark, lambda a, b: 2 * a - b, shift=shift)
    rnd = random.Random(5)
    pts = [(rnd.uniform(-15, 8), shift + rnd.uniform(4, 34)) for _ in range(60)] + [(60.0, shift + 5)]
    sites = points(spark, [(a, (b + 180) % 360 - 180) for a, b in pts])
    got = values(pr.pair_data(g, sites, "v", method="bilinear", cell=("y", "x")))
    # the field is linear in the coordinates, so the blend is exact wherever the quad is right
    assert all(got[k] == pytest.approx(2 * a - b, abs=1e-8) for k, (a, b) in enumerate(pts[:-1]))
    assert got[len(pts) - 1] is None


def test_nearest_2d_values_and_time_interpolation(spark):
    g = curved(spark, lambda a, b: a + b)
    later = g.withColumns({"time": F.col("time") + F.expr("interval 10 hours"), "v": F.col("v") + 10})
    both = g.unionByName(later)
    pts = points(spark, [(-5.0, 10.0), (3.0, 20.0), (80.0, 10.0)], T0 + dt.timedelta(hours=4))
    cells = [(r["lat"], r["lon"], r["v"]) for r in g.collect()]

    def dist(a, b):
        p, q, d = math.radians(a[0]), math.radians(b[0]), math.radians(a[1] - b[1])
        return math.acos(min(1, math.sin(p) * math.sin(q) + math.cos(p) * math.cos(q) * math.cos(d)))
    got = values(pr.pair_data(both, pts, "v", method="nearest", cell=("y", "x"), interp_time=True, limit_km=500.0))
    for k, site in enumerate([(-5.0, 10.0), (3.0, 20.0)]):
        assert got[k] == pytest.approx(min(cells, key=lambda c: dist(site, c))[2] + 4.0)
    assert got[2] is None
    assert values(pr.pair_data(g, pts.withColumn("time", F.lit(T0)), "v", method="nearest", cell=("y", "x"), limit_km=500.0))[2] is None


# --- time --------------------------------------------------------------------------


def test_model_times_years_apart_cost_three_rows(spark):
    times = [dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1, 0, 0, 1), dt.datetime(2001, 1, 1)]
    model = spark.createDataFrame([(1, t, float(k)) for k, t in enumerate(times)], "k int, time timestamp, v double")
    pts = spark.createDataFrame([(1, times[1] + (times[2] - times[1]) / 2, 7), (1, times[2], 8), (1, dt.datetime(2005, 1, 1), 9),
                                 (1, dt.datetime(1999, 1, 1), 10), (2, times[1], 11), (None, times[1], 12), (1, None, 13),
                                 (1, times[2], 8)], "k int, time timestamp, n int")
    got = [(r["n"], r["v"]) for r in pr.pair_interp_time(model, pts, "v", keys=["k"]).collect()]
    assert sorted(got, key=lambda r: r[0]) == [(7, 1.5), (8, 2.0), (8, 2.0), (9, None), (10, None), (11, None), (12, None), (13, None)]
    inner = pr.pair_interp_time(model, pts, "v", keys=["k"], how="inner").collect()
    assert sorted((r["n"], r["v"]) for r in inner) == [(7, 1.5), (8, 2.0), (8, 2.0)]
    assert pr.pair_interp_time(model.where("false"), pts, "v", keys=["k"]).where("v is not null").count() == 0


def test_time_merge_matches_brute_force(spark):
    rnd = random.Random(7)
    at = lambda: T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(60), rnd.randrange(10 ** 6)]))
    model = {(k, at()): (rnd.uniform(0, 9) if rnd.random() < 0.9 else None) for k in (1, 2, 3) for _ in range(80)}
    pts = [(n, rnd.choice([1, 2, 3, 4]), at()) for n in range(300)] + [(300 + n, k, t) for n, (k, t) in enumerate(model)]
    m = spark.createDataFrame([(k, t, v) for (k, t), v in model.items()], "k int, time timestamp, v double")
    got = {r["n"]: r["v"] for r in pr.pair_interp_time(m, spark.createDataFrame(pts, "n int, k int, time timestamp"), "v",
                                                       keys=["k"]).collect()}
    for n, k, t in pts:
        ts = sorted(x for kk, x in model if kk == k)
        before, after = [x for x in ts if x <= t], [x for x in ts if x > t]
        want = None
        if before and before[-1] == t:
            want = model[k, t]
        elif before and after:
            a, b = model[k, before[-1]], model[k, after[0]]
            want = None if a is None or b is None else a + (b - a) * ((t - before[-1]) / (after[0] - before[-1]))
        assert got[n] == (None if want is None else pytest.approx(want)), n


# --- pair_data -----------------------------------------------------------------------


def test_pair_data_duplicates_mask_history_sort_and_target(spark):
    g = grid(spark, (0, 10, 20), (0, 10, 20), lambda a, b: a + b)
    twice = g.unionByName(g)
    pts = points(spark, [(1, 1), (11, 19)])
    regions = region_table(spark, [("west", 1, [(-5, -5), (-5, 9), (30, 9), (30, -5)])])
    out = pr.pair_data(twice, pts, "v", method="nearest", mask=regions, sort=True)
    assert sorted((r["site_id"], r["v"], r["region"]) for r in out.collect()) == [(0, 0.0, "west"), (1, 30.0, None)]
    assert "nearest" in out.schema["v"].metadata["history"]
    target = grid(spark, (5, 15), (5, 15), lambda a, b: 1.0)
    for method, want in (("regrid", {10.0, 20.0, 30.0}), ("conservative", None)):
        both = pr.pair_data(twice, target, "v", method=method, merge_target=True, target_step=(10.0, 10.0))
        rows = both.collect()
        assert len(rows) == 4 and all(r["v_target"] == 1.0 and r["v_source"] is not None for r in rows)
        assert want is None or {round(r["v_source"], 9) for r in rows} == want
    assert set(pr.pair_data(g, target, "v", method="regrid").columns) == {"time", "lat", "lon", "v_source"}
    with pytest.raises(ValueError):
        pr.pair_data(g, pts, "v", method="nonsense")


# --- regions ---------------------------------------------------------------------------


def test_region_over_the_date_line(spark):
    ring = [(0, 170), (0, -170), (20, -170), (20, 170)]
    pts = [(10, 0), (10, 175), (10, -175), (10, 185), (10, 169), (10, -169), (-1, 175)]
    d = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "lat double, lon double")
    for poly in (ring, [(a, b % 360) for a, b in ring]):
        got = {(r["lat"], r["lon"]): r["region"] for r in label_regions(d, region_table(spark, [("pac", 1, poly)])).collect()}
        assert [got[float(a), float(b)] for a, b in pts] == [None, "pac", "pac", "pac", None, None, None]


def test_large_ring_is_dealt_by_edges(spark):
    n = 20_000
    ring = [(40 * math.sin(2 * math.pi * k / n), 60 * math.cos(2 * math.pi * k / n)) for k in range(n)]
    rnd = random.Random(9)
    pts = [(rnd.uniform(-60, 60), rnd.uniform(-90, 90)) for _ in range(300)]
    out = label_regions(spark.createDataFrame(pts, "lat double, lon double"), region_table(spark, [("e", 1, ring)]))
    for r in out.collect():
        d = (r["lat"] / 40) ** 2 + (r["lon"] / 60) ** 2
        if abs(d - 1) > 1e-4:
            assert (r["region"] == "e") == (d < 1)


# --- distributions and statistics ---------------------------------------------------------


def _fss(f, o, k, seam):
    def frac(x):
        p = np.pad(x, ((k, k), (0, 0)))
        p = np.pad(p, ((0, 0), (k, k)), mode="wrap") if seam else np.pad(p, ((0, 0), (k, k)))
        return np.array([[p[i:i + 2 * k + 1, j:j + 2 * k + 1].mean() for j in range(x.shape[1])] for i in range(x.shape[0])])
    pf, po = frac(f), frac(o)
    return 1 - ((pf - po) ** 2).sum() / ((pf ** 2).sum() + (po ** 2).sum())


@pytest.mark.parametrize("k,seam", [(0, False), (1, True), (4, False), (4, True), (20, False), (20, True)])
def test_fss_against_brute_force(spark, k, seam):
    rng = np.random.default_rng(k)
    f, o = rng.random((9, 12)), rng.random((9, 12))
    lats, lons = np.arange(9) * 10.0 - 40, np.arange(12) * 30.0 - 180
    rows = [(float(lats[i]), float(lons[j]), float(f[i, j]), float(o[i, j])) for i in range(9) for j in range(12)]
    d = spark.createDataFrame(rows, "lat double, lon double, f double, o double")
    got = fractions_skill_score(d, d, "f", "o", 0.7, k=k, time=None, seam=seam).first()["fss"]
    assert got == pytest.approx(_fss(f >= 0.7, o >= 0.7, k, seam), abs=1e-12)


def test_quantiles_many_buckets_copies_and_infinite_values(spark):
    rnd = random.Random(11)
    rows = [("a", rnd.choice([rnd.gauss(0, 1), 3.0])) for _ in range(700)] + [("b", 1.0), ("c", None), ("d", float("-inf")), ("d", 2.0)]
    d = spark.createDataFrame(rows, "g string, x double")
    qs = [0.0, 0.001, 0.125, 0.5, 0.77, 1.0]
    for per in (3, 50, 100_000):
        got = {r["g"]: list(r)[1:] for r in quantiles(d, "x", qs, by=["g"], rows_per_bucket=per).collect()}
        assert got["a"] == pytest.approx(list(np.quantile([x for g, x in rows if g == "a"], qs)))
        assert got["b"] == [1.0] * 6 and "c" not in got and got["d"][0] == float("-inf") and got["d"][-1] == 2.0


def test_conditional_quantile_with_part_of_a_percent(spark):
    d = spark.createDataFrame([(k / 100, k / 50) for k in range(100)], "o double, m double")
    for exact in (True, False):
        out = conditional_quantile(d, "o", "m", bins=2, hi=2.0, quantiles=(0.12, 0.125, 0.5), exact=exact)
        assert out.columns[-3:] == ["q12", "q12_5", "q50"] and out.count() == 2


def test_grouping_sets_match_single_calls(spark):
    rnd = random.Random(13)
    rows = [(rnd.choice("xy"), rnd.choice(["p", "q", None]), rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(200)]
    d = spark.createDataFrame(rows, "a string, b string, o double, m double")
    names = ["n", "rmse", "ioa_m", "e1", "ac", "wassersteindistance"]
    cube = stats.compute_statistics(d, names, "o", "m", by=["a", "b"], grouping="cube").collect()
    for gid, keys in ((0, ["a", "b"]), (1, ["a"]), (2, ["b"]), (3, [])):
        one = {tuple(r[k] for k in keys): r for r in stats.compute_statistics(d, names, "o", "m", by=keys).collect()}
        mine = [r for r in cube if r["grouping_id"] == gid]
        assert len(mine) == len(one)
        for r in mine:
            assert [r[n] for n in names] == pytest.approx([one[tuple(r[k] for k in keys)][n] for n in names])
    with pytest.raises(ValueError):
        stats.compute_statistics(d, ["rmse"], "o", "m", by=["a"], grouping=[["z"]])
    with pytest.raises(ValueError):
        stats.compute_statistics(d, ["fss"], "o", "m", by=["a"])


def test_salted_centre_gives_the_same_figures(spark, monkeypatch):
    rnd = random.Random(17)
    rows = [(rnd.choice(["hot"] * 8 + ["b", None]), rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(400)]
    d = spark.createDataFrame(rows, "g string, o double, m double").repartition(7)
    names = ["ioa_m", "d1", "e1", "ac", "ioa_radar"]
    want = {r["g"]: list(r)[1:] for r in stats.compute_statistics(d, names, "o", "m", by=["g"]).collect()}
    few = stats.join_group_values.__defaults__
    monkeypatch.setattr(stats.join_group_values, "__defaults__", (*few[:-1], 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = stats.compute_statistics(d, names, "o", "m", by=["g"])
        got = {r["g"]: list(r)[1:] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g]) for g in want)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("__salt" in line for line in joins)
