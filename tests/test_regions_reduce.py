"""Regions (J11/J12, F4-F6, K5), reductions (A1-A9), conform (P-rows),
distribution metrics (M16/M17)."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyscore.operators import conform as cf
from skyscore.operators.distribution import fractions_skill_score, quantiles, wasserstein
from skyscore.operators.pairing import RegularAxis, grid_axes
from skyscore.operators.plotdata import scatter_density
from skyscore.operators.reduce import calculate_reduction, multi_reduction
from skyscore.operators.regions import (filter_region, find_region_column, label_regions, missing_regions,
                                        region_table, render_name)


def test_polygon_labels_priority_and_outside(spark):
    regions = region_table(spark, [("big", 2, [(-10, -10), (-10, 10), (10, 10), (10, -10)]),
                                   ("small", 1, [(-1, -1), (-1, 1), (1, 1), (1, -1)]),
                                   ("tri", 3, [(20, 0), (30, 10), (20, 20)])])
    pts = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0), (22.0, 10.0), (29.0, 1.0), (50.0, 50.0)], "lat double, lon double")
    got = {(r["lat"], r["lon"]): r["region"] for r in label_regions(pts, regions).collect()}
    assert got == {(0.0, 0.0): "small", (5.0, 5.0): "big", (22.0, 10.0): "tri", (29.0, 1.0): None, (50.0, 50.0): None}


def test_region_column_detection(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0, "land")], "x int, lat double, lon double, t double, land string")
    assert find_region_column(df) == "land"
    with pytest.raises(ValueError):
        find_region_column(df.drop("land"))
    assert missing_regions(df, ["land", "sea"], "land").collect()[0]["land"] == "sea"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["a b", "c-d", "e/f"]), min_size=1, max_size=20))
def test_region_filter_purity_and_count(spark, labels):
    df = spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], "obs int, mask_region string")
    for lab in set(labels):
        rows = filter_region(df, lab, "mask_region").collect()
        assert len(rows) == labels.count(lab) and all(r["mask_region"] == lab for r in rows)


def test_render_name():
    assert render_name("stats_{region}.md", "North America", for_plots=False) == "stats_North_America.md"
    assert render_name("p_{region}.png", "a/b c") == "p_a_b_c.png"
    with pytest.raises(ValueError):
        render_name("stats.md", "x")


def cube(spark):
    rnd = random.Random(5)
    rows = [(t, float(la), float(lo), rnd.random()) for t in range(5) for la in range(-80, 81, 20)
            for lo in range(-170, 171, 20)]
    return spark.createDataFrame(rows, "time int, lat double, lon double, test_data double")


def test_reduction_methods(spark):
    df = cube(spark)
    pdf = df.toPandas()
    assert calculate_reduction(df, "mean").first()["test_data"] == pytest.approx(pdf.test_data.mean())
    assert calculate_reduction(df, "std", dim="time").count() == 9 * 18
    s = calculate_reduction(df, "std").first()["test_data"]
    assert s == pytest.approx(pdf.test_data.std(ddof=0))
    with pytest.raises(ValueError):
        calculate_reduction(df, "bogus")
    m = multi_reduction(df, ["max", "min", "count"], dim="time").first()
    assert m["test_data_count"] == 5


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0, 1.0, None), (0, 2.0, None)], "time int, lat double, v double")
    assert calculate_reduction(df, "sum", dim="lat").first()["v"] == 0.0


def test_weighted_spatial_mean_then_time(spark):
    df = cube(spark)
    pdf = df.toPandas()
    pdf["w"] = [math.cos(math.radians(x)) for x in pdf.lat]
    per_t = pdf.groupby("time").apply(lambda g: (g.w * g.test_data).sum() / g.w.sum(), include_groups=False)
    got = {r["time"]: r["test_data"] for r in calculate_reduction(df, "mean", dim=["lat", "lon"]).collect()}
    for t, v in per_t.items():
        assert got[t] == pytest.approx(v)
    both = calculate_reduction(df, "mean", dim=["time", "lat", "lon"]).first()["test_data"]
    assert both == pytest.approx(per_t.mean())
    forced = calculate_reduction(df.withColumnsRenamed({"lat": "y", "lon": "x"}), "mean", dim=["y", "x"],
                                 dims=["time", "y", "x"], force_weighted=True)
    assert {r["time"]: r["test_data"] for r in forced.collect()} == pytest.approx(got)


def test_conform_chain(spark):
    df = spark.createDataFrame([(1, 3.0, 4.0, 300.0)], "valid_time int, UGRD double, VGRD double, TMP double")
    out = cf.conform(df, rename_map={"TMP": "t2m"}, offset_map={"t2m": -273.15}, scale_map={"t2m": 1.0})
    r = out.first()
    assert "time" in out.columns and r["wind_speed"] == 5.0 and r["t2m"] == pytest.approx(26.85)
    assert out.schema["wind_speed"].metadata["units"] == "m s-1"
    with pytest.raises(ValueError):
        cf.rename(df, {"UGRD": "VGRD"})
    assert cf.find_time_column(["x", "valid_date"]) == "valid_date"
    assert cf.discover_spatial_dims(["Latitude", "x", "LONG"]) == ("Latitude", "LONG")


def test_history_metadata_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "v double")
    df = cf.with_history(cf.with_history(df, "v", "loaded"), "v", "paired")
    p = str(tmp_path / "h")
    df.write.parquet(p)
    assert spark.read.parquet(p).schema["v"].metadata["history"] == "loaded\npaired"


def test_isel_sel(spark):
    df = spark.createDataFrame([(t, float(z)) for t in (30, 10, 20) for z in range(3)], "t int, z double")
    assert {r["t"] for r in cf.isel(df, {"t": 0, "nope": 3}).collect()} == {10}
    assert {r["t"] for r in cf.isel(df, {"t": slice(1, None)}).collect()} == {20, 30}
    assert cf.sel(df, {"z": 1.0}).count() == 3


def test_pressure_alignment(spark):
    obs = spark.createDataFrame([(50000.0,), (85000.0,)], "press double")
    mod = spark.createDataFrame([(500.0,), (1000.0,)], "isobaric_surface double")
    assert sorted(r["press"] for r in cf.align_pressure_units(obs, mod, "press", "isobaric_surface").collect()) == [500.0, 850.0]


@pytest.mark.parametrize("rows_per_bucket", [1, 7, 10**6])
def test_wasserstein_matches_sorted_pairs(spark, rows_per_bucket):
    rnd = random.Random(11)
    rows = [(k % 2, float(rnd.randint(0, 20)), rnd.gauss(10, 4)) for k in range(400)]  # integer obs: many ties
    df = spark.createDataFrame(rows, "g int, o double, m double")
    got = {r["g"]: r["wassersteindistance"] for r in wasserstein(df, "o", "m", by=["g"], rows_per_bucket=rows_per_bucket).collect()}
    for g in (0, 1):
        os_ = sorted(o for k, o, m in rows if k == g)
        ms_ = sorted(m for k, o, m in rows if k == g)
        assert got[g] == pytest.approx(sum(abs(a - b) for a, b in zip(os_, ms_)) / len(os_), rel=1e-9)


def test_fss_identical_fields_is_one(spark):
    rows = [(0, -85.0 + 10 * i, -175.0 + 10 * j, float((i * j) % 5)) for i in range(18) for j in range(36)]
    g = spark.createDataFrame(rows, "time int, lat double, lon double, v double")
    axes = grid_axes(g, lat_axis=RegularAxis(-85.0, 10.0, 18), lon_axis=RegularAxis(-175.0, 10.0, 36))
    assert fractions_skill_score(g, g, "v", "v", 3.0, k=1, axes=axes).first()["fss"] == pytest.approx(1.0)
    empty = g.where(F.lit(False))
    assert fractions_skill_score(g, empty, "v", "v", 3.0, k=1, axes=axes).first()["fss"] == pytest.approx(0.0)


def test_exact_medians_and_quantiles(spark):
    import numpy as np
    df = cube(spark)
    pdf = df.toPandas()
    got = {(r["lat"], r["lon"]): r["test_data"] for r in calculate_reduction(df, "median", dim="time").collect()}
    exp = pdf.groupby(["lat", "lon"]).test_data.median()
    for k, v in exp.items():
        assert got[k] == pytest.approx(v)
    allq = quantiles(df, "test_data", [0.1, 0.9], rows_per_bucket=3).first()
    assert allq["q10"] == pytest.approx(np.quantile(pdf.test_data, 0.1))
    assert allq["q90"] == pytest.approx(np.quantile(pdf.test_data, 0.9))
    nulls = spark.createDataFrame([(0, 1.0, None), (1, 1.0, 2.0)], "time int, lat double, v double")
    m = {r["time"]: r["v_median"] for r in multi_reduction(nulls, ["median", "count"], dim="lat").collect()}
    assert m == {0: None, 1: 2.0}


def test_value_buckets_split_hot_ranges(spark):
    """A third of the rows are copies of one value and another third sit in
    a tiny value range: the tally collapses the copies and the second bucket
    level splits the narrow range, so no bucket is large; results stay exact."""
    import numpy as np
    from skyscore.operators.distribution import value_tally
    rnd = random.Random(2)
    xs = [5.0] * 300 + [1000.0 + rnd.random() * 1e-3 for _ in range(300)] + [rnd.uniform(0, 2000) for _ in range(300)]
    df = spark.createDataFrame([(0, x) for x in xs], "g int, x double")
    tally = value_tally(df.select("g", "x", F.lit(1).alias("c")), ["g"], ["c"], rows_per_bucket=30)
    biggest = tally.groupBy("bpath").count().agg(F.max("count")).first()[0]
    assert biggest <= 30
    assert tally.where(F.col("x") == 5.0).first()["c"] == 300
    got = quantiles(df, "x", [0.2, 0.5, 0.8], by=["g"], rows_per_bucket=30).first()
    for q, c in ((0.2, "q20"), (0.5, "q50"), (0.8, "q80")):
        assert got[c] == pytest.approx(np.quantile(xs, q))
    df2 = spark.createDataFrame([(0, x, x * 0.5 + 1.0) for x in xs], "g int, o double, m double")
    w = wasserstein(df2, "o", "m", by=["g"], rows_per_bucket=30).first()["wassersteindistance"]
    assert w == pytest.approx(np.mean(np.abs(np.sort(xs) - np.sort([x * 0.5 + 1.0 for x in xs]))))


def _inside(lat, lon, poly):
    c = False
    n = len(poly)
    for k in range(n):
        y1, x1 = poly[k]
        y2, x2 = poly[(k + 1) % n]
        if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
            c = not c
    return c


def test_polygon_labels_match_brute_force(spark):
    rnd = random.Random(4)
    polys = []
    for k in range(6):
        cy, cx = rnd.uniform(-60, 60), rnd.uniform(-150, 150)
        ring = [(cy + rnd.uniform(5, 30) * math.sin(a), cx + rnd.uniform(5, 40) * math.cos(a))
                for a in sorted(rnd.uniform(0, 2 * math.pi) for _ in range(7))]
        polys.append((f"r{k}", rnd.randint(1, 3), ring))
    pts = [(rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for _ in range(400)]
    got = {(r["lat"], r["lon"]): r["region"] for r in
           label_regions(spark.createDataFrame(pts, "lat double, lon double"), region_table(spark, polys)).collect()}
    for la, lo in pts:
        hits = sorted((p, n) for n, p, ring in polys if _inside(la, lo, ring))
        assert got[(la, lo)] == (hits[0][1] if hits else None)


def test_isel_counts_from_the_end(spark):
    df = spark.range(6).select((F.col("id") * 10).alias("x"))
    axis = [0, 10, 20, 30, 40, 50]
    for ix in (slice(-3, None), slice(None, -2), slice(1, None, 2), slice(None, None, -2), slice(4, 0, -3),
               slice(-99, 3), slice(2, 99)):
        assert sorted(r["x"] for r in cf.isel(df, {"x": ix}).collect()) == sorted(axis[ix]), ix
    assert [r["x"] for r in cf.isel(df, {"x": -1}).collect()] == [50]
    assert sorted(r["x"] for r in cf.isel(df, {"x": [0, -2]}).collect()) == [0, 40]


def test_fss_keeps_groups_below_the_threshold(spark):
    g = spark.createDataFrame([(1, 0.0, 0.0, 9.0), (1, 1.0, 1.0, 0.0), (2, 0.0, 0.0, 1.0), (2, 1.0, 1.0, 0.0)],
                              "time int, lat double, lon double, v double")
    got = {r["time"]: r["fss"] for r in fractions_skill_score(g, g, "v", "v", 3.0, by=["time"]).collect()}
    assert got == {1: pytest.approx(1.0), 2: None}


def test_density_counts_values_outside_the_range(spark):
    df = spark.createDataFrame([(-1.0, 0.5), (0.5, 1.0), (2.0, 0.0)], "o double, m double")
    got = {(r["obs_bin"], r["mod_bin"]): r["n"] for r in scatter_density(df, "o", "m", bins=2, lo=0, hi=1).collect()}
    assert got == {(-1, 1): 1, (1, 1): 1, (2, 0): 1}


def test_quantile_names_below_a_percent(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    got = quantiles(df, "x", [0.001, 0.004, 0.5]).first().asDict()
    assert got == {"q00_1": 1.0, "q00_4": 4.0, "q50": 500.0}


def test_region_labels_replicate_sites_of_many_rows_only(spark, monkeypatch):
    from skyscore.operators import stats
    few = stats.join_group_values.__defaults__
    monkeypatch.setattr(stats.join_group_values, "__defaults__", tuple(0 if d == stats.FEW_GROUPS else d for d in few))
    monkeypatch.setattr(stats, "HOT_ROWS", 50)
    box = [(-10, -10), (-10, 10), (10, 10), (10, -10)]
    regions = region_table(spark, [("b", 1, box), ("a", 1, box), ("c", 0, [(20, 20), (20, 30), (30, 25)])])
    rows = [(k, 1.0, 1.0) for k in range(300)] + [(300 + k, 0.5, float(k)) for k in range(20)] + [(900, 22.0, 25.0), (901, None, 1.0)]
    got = {r["id"]: r["region"] for r in label_regions(spark.createDataFrame(rows, "id int, lat double, lon double"), regions).collect()}
    assert got == {k: "c" if k == 900 else "a" if la is not None and lo < 10 else None for k, la, lo in rows}
    small = spark.createDataFrame([(1.0, 49, "x"), (2.0, 51, "y"), (3.0, 1, "z")], "__key_0 double, n int, label string")
    none = spark.createDataFrame([], "k double")
    found = stats.salted_join(none, small, ["k"], ["__key_0"], 16, "right", "n").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in found} == {"x": 1, "y": 16, "z": 1}
