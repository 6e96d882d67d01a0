"""Hand-worked metric cases, degenerate inputs, weights, lookup and
partition independence (the reference's unit-test strategy)."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyscore.operators.stats import compute_statistics
from skyscore.operators.plotdata import radar_table


def pairs(spark, obs, mod, extra=None):
    rows = [(float(o) if o is not None else None, float(m) if m is not None else None) for o, m in zip(obs, mod)]
    return spark.createDataFrame(rows, "obs double, mod double")


def one(spark, obs, mod, metrics):
    return compute_statistics(pairs(spark, obs, mod), metrics, "obs", "mod").first().asDict()


def test_perfect_agreement(spark):
    r = one(spark, [1, 2, 3, 4, 5], [1, 2, 3, 4, 5], ["ioa_radar", "kge", "ccc", "rmse", "mb", "corr"])
    assert r["ioa_radar"] == pytest.approx(1.0)
    assert r["kge"] == pytest.approx(1.0)
    assert r["ccc"] == pytest.approx(1.0)
    assert r["rmse"] == 0 and r["mb"] == 0
    assert r["corr"] == pytest.approx(1.0)


def test_ioa_hand_worked(spark):
    r = one(spark, [2, 4, 6, 8], [3, 5, 7, 9], ["ioa_radar", "ioa_m"])
    assert r["ioa_radar"] == pytest.approx(1 - 4 / 84)
    assert r["ioa_m"] == pytest.approx(1 - 4 / 84)


def test_kge_and_ccc_hand_worked(spark):
    r = one(spark, [1, 2, 3, 4, 5], [2, 4, 6, 8, 10], ["kge", "ccc"])
    assert r["kge"] == pytest.approx(1 - math.sqrt(2))
    assert r["ccc"] == pytest.approx(10 / 21.5)


@pytest.mark.parametrize("obs,mod", [
    ([1.0], [2.0]),                                  # one row
    ([float("nan")] * 3, [1.0, 2.0, 3.0]),           # all missing
    ([1.0, float("nan"), 3.0], [2.0, 5.0, None]),    # one valid pair
    ([3.0, 3.0, 3.0], [1.0, 2.0, 3.0]),              # constant obs
    ([1.0, 2.0, 3.0], [4.0, 4.0, 4.0]),              # constant model
])
def test_degenerate_inputs_give_no_value(spark, obs, mod):
    df = compute_statistics(pairs(spark, obs, mod), ["ioa_radar", "kge", "ccc", "corr"], "obs", "mod")
    rows = df.collect()
    for r in rows:  # no valid pair at all -> no row
        assert r["ioa_radar"] is None and r["kge"] is None and r["ccc"] is None and r["corr"] is None


def test_empty_input_has_no_rows(spark):
    df = spark.createDataFrame([], "obs double, mod double")
    assert compute_statistics(df, ["rmse"], "obs", "mod", by=[]).collect()[0]["rmse"] is None


def test_constant_bias_weighted_and_not(spark):
    rows = [(float(la), float(lo), float(la + lo), float(la + lo) + 0.5)
            for la in range(-45, 50, 10) for lo in range(0, 200, 10)]
    df = spark.createDataFrame(rows, "lat double, lon double, obs double, mod double")
    from skyscore.operators.conform import area_weight
    df = df.withColumn("w", area_weight("lat"))
    a = compute_statistics(df, ["mb"], "obs", "mod").first()["mb"]
    b = compute_statistics(df, ["mb"], "obs", "mod", weights="w").first()["mb"]
    assert a == pytest.approx(0.5) and b == pytest.approx(0.5)


def test_weighted_fallback_is_unweighted(spark):
    rows = [(0.0, 0.0, 1.0, 1.1), (0.0, 1.0, 2.0, 2.1), (1.0, 0.0, 3.0, 3.1), (1.0, 1.0, 4.0, 4.1)]
    df = spark.createDataFrame(rows, "lat double, lon double, obs double, mod double").selectExpr("*", "lat + 1 AS w")
    r = compute_statistics(df, ["mse", "fac2"], "obs", "mod", weights="w").first()
    assert r["mse"] == pytest.approx(0.01)
    assert r["fac2"] == pytest.approx(1.0)


def test_weighted_pearson_equal_weights_matches_unweighted(spark):
    import random
    rnd = random.Random(42)
    rows = [(o, 0.8 * o + 0.2 * rnd.random(), 2.0) for o in [rnd.random() for _ in range(200)]]
    df = spark.createDataFrame(rows, "obs double, mod double, w double")
    a = compute_statistics(df, ["corr"], "obs", "mod").first()["corr"]
    b = compute_statistics(df, ["corr"], "obs", "mod", weights="w").first()["corr"]
    assert a == pytest.approx(b, rel=1e-12)


def test_mape_infinite_with_zero_obs(spark):
    r = one(spark, [0, 1, 2], [1, 1, 2], ["mape", "fac2"])
    assert math.isinf(r["mape"]) and r["mape"] > 0
    assert r["fac2"] == pytest.approx(2 / 3)


def test_aliases_and_unknown(spark):
    df = pairs(spark, [1, 2, 3], [1, 3, 2])
    out = compute_statistics(df, ["bias", "R", "pearsonr"], "obs", "mod").first().asDict()
    assert set(out) == {"bias", "R"}   # pearsonr is the same metric as R -> computed once
    with pytest.raises(ValueError):
        compute_statistics(df, ["nope"], "obs", "mod")
    out = compute_statistics(df, ["nope", "mb"], "obs", "mod", skip_unknown=True).first().asDict()
    assert set(out) == {"mb"}


def test_partition_independence(spark):
    import random
    rnd = random.Random(7)
    rows = [(str(i % 5), rnd.gauss(10, 3), rnd.gauss(11, 3)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, obs double, mod double")
    names = ["rmse", "mb", "mae", "corr", "ioa_m", "d1", "e1", "ac", "kge", "ccc"]
    a = {r["g"]: r for r in compute_statistics(df.repartition(1), names, "obs", "mod", by=["g"]).collect()}
    b = {r["g"]: r for r in compute_statistics(df.repartition(7), names, "obs", "mod", by=["g"]).collect()}
    for g in a:
        for n in names:
            assert a[g][n] == pytest.approx(b[g][n], rel=1e-9, abs=1e-12)


def test_radar_table_long_by_model(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 2.0), (3.0, 6.0, 3.0), (4.0, 8.0, 4.0), (5.0, 10.0, 5.0)],
                               "obs double, a double, b double")
    r = {x["model"]: x for x in radar_table(df, "obs", ["a", "b"]).collect()}
    assert r["a"]["ccc"] == pytest.approx(10 / 21.5)
    assert r["b"]["kge"] == pytest.approx(1.0)


finite = st.floats(min_value=-1e3, max_value=1e3, allow_nan=False, allow_infinity=False)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(finite, finite), min_size=0, max_size=30))
def test_metric_bounds(spark, data):
    """IOA in [0, 1], KGE <= 1, CCC in [-1, 1] whenever defined."""
    df = spark.createDataFrame([(float(a), float(b)) for a, b in data], "obs double, mod double")
    for r in compute_statistics(df, ["ioa_radar", "kge", "ccc"], "obs", "mod").collect():
        if r["ioa_radar"] is not None:
            assert 0.0 <= r["ioa_radar"] <= 1.0
        if r["kge"] is not None:
            assert r["kge"] <= 1.0 + 1e-12
        if r["ccc"] is not None:
            assert -1.0 <= r["ccc"] <= 1.0


def test_frequency_strings():
    from skyscore.operators.series import spark_duration
    assert spark_duration("3h") == "3 hours"
    assert spark_duration("h") == "1 hours"
    assert spark_duration("D") == "1 days"
    assert spark_duration("15min") == "15 minutes"
    assert spark_duration("2 hours") == "2 hours"
    with pytest.raises(ValueError):
        spark_duration("3q")


def test_window_stats_by_series(spark):
    import datetime as dt
    from skyscore.operators.series import resample, time_window_stats
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=20 * i), "a" if i % 2 else "b", float(i), float(i) + (1.0 if i % 2 else -1.0))
            for i in range(18)]
    df = spark.createDataFrame(rows, "time timestamp, k string, obs double, mod double")
    got = {(r["k"], r["time"]): (r["n"], r["mb"]) for r in
           time_window_stats(df, "obs", "mod", freq="3h", by=["k"]).collect()}
    # [00:00, 03:00) holds i = 0..8: four odd ("a") and five even ("b") rows
    assert got[("a", t0)] == (4, 1.0) and got[("b", t0)] == (5, -1.0)
    hourly = {(r["k"], r["time"]): r["obs"] for r in resample(df, "h", "obs", keys=["k"]).collect()}
    assert hourly[("b", t0)] == pytest.approx(1.0)   # obs 0 and 2 in the first hour
