"""Sources, sinks (S-, K-rows) and streaming (X-rows)."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from skyscore.sources import io
from skyscore.sources import sinks
from skyscore.streaming import stream as xs


def test_date_list_rules():
    assert io.date_list("2024-01-01", "2024-01-03") == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert io.date_list("2024-01-01", "2024-01-01T12:00:00", "12h") == ["2024-01-01", "2024-01-01"]
    with pytest.raises(ValueError):
        io.date_list("2024-01-02", "2024-01-01")
    kw = io.normalise_date_args({"date": "2024-01-01"})
    assert kw == {"dates": "2024-01-01"}
    kw = io.normalise_date_args({"start_date": "2024-01-01", "end_date": "2024-01-02"})
    assert kw["dates"] == ["2024-01-01", "2024-01-02"]


def test_coverage_check(spark):
    store = spark.createDataFrame([(dt.datetime(2024, 1, 1, 3),), (dt.datetime(2024, 1, 2),)], "time timestamp")
    req = io.date_frame(spark, "2024-01-01", "2024-01-03")
    assert [r["date"] for r in io.missing_dates(store, req).collect()] == ["2024-01-03"]
    assert io.store_covers(store, io.date_frame(spark, "2024-01-01", "2024-01-02"))
    assert not io.store_covers(store.where(F.lit(False)), None)


def test_station_files_skip_missing(spark, tmp_path):
    paths = []
    for k in range(3):
        p = tmp_path / f"st{k}.csv"
        p.write_text("time,val\n2024-01-01 00:00:00,%d\n" % k)
        paths.append(str(p))
    df, skipped = io.read_station_files(spark, paths + [str(tmp_path / "absent.csv")], header=True)
    assert skipped == 1 and df.count() == 3


def test_date_window_and_overlap(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23),), (dt.datetime(2024, 1, 2, 1),)], "time timestamp")
    assert io.date_window(df, "2024-01-01").count() == 1
    hist = spark.createDataFrame([("a", dt.datetime(2023, 1, 1), dt.datetime(2023, 6, 1)),
                                  ("b", dt.datetime(2023, 12, 1), dt.datetime(2024, 2, 1))],
                                 "id string, begin timestamp, end timestamp")
    assert [r["id"] for r in io.overlapping_stations(hist, ["2024-01-01", "2024-01-05"]).collect()] == ["b"]


def test_photometer_text(spark):
    lines = ["AERONET-like preamble", "Date(dd:mm:yyyy),Time(hh:mm:ss),Site_Latitude,Site_Longitude,Site_Elevation,AOD_550nm",
             "01:02:2024,03:04:05,10.5,-20.25,100.0,0.1", "02:02:2024,00:00:00,10.5,-20.25,100.0,-999.0",
             "garbage,line"]
    df = io.parse_photometer_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = df.orderBy("time").collect()
    assert len(rows) == 2
    assert rows[0]["time"] == dt.datetime(2024, 2, 1, 3, 4, 5) and rows[0]["aod_550nm"] == 0.1
    assert rows[1]["aod_550nm"] is None


def test_level_filter_pushdown(spark, tmp_path):
    p = str(tmp_path / "lv")
    spark.createDataFrame([(2, "TMP", 1.0), (10, "TMP", 2.0), (2, "UGRD", 3.0)],
                          "level int, shortName string, v double").write.parquet(p)
    spec = io.SourceSpec(path=p, filters={"level": 2, "shortName": ["TMP"]}, rename={"v": "t2m"})
    df = io.load_data(spark, spec)
    assert [r["t2m"] for r in df.collect()] == [1.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "level" in plan


def test_save_roundtrip_and_idempotent(spark, tmp_path):
    url = str(tmp_path / "store")
    df = spark.createDataFrame([(dt.datetime(2024, 1, d), float(d)) for d in (1, 2)], "time timestamp, v double")
    sinks.save_data(df, url)
    sinks.save_data(df.where(F.dayofmonth("time") == 2).withColumn("v", F.lit(9.0)), url)
    back = {r["v"] for r in io.read_store(spark, url).collect()}
    assert back == {1.0, 9.0}
    assert io.read_store(spark, url, dates=["2024-01-01"]).count() == 1
    with pytest.raises(ValueError):
        sinks.save_data(df, url, backend="zarr")
    with pytest.raises(TypeError):
        sinks.save_data([1, 2], url)


def test_versioned_snapshots(spark, tmp_path):
    url = str(tmp_path / "repo")
    a = spark.createDataFrame([(1,)], "x int")
    assert sinks.save_versioned(a, url, "first") == 0
    assert sinks.save_versioned(a.union(a), url, "second") == 1
    assert sinks.read_versioned(spark, url).count() == 2
    assert sinks.read_versioned(spark, url, 0).count() == 1
    assert [r["message"] for r in sinks.snapshot_log(spark, url).orderBy("snapshot").collect()] == ["first", "second"]


def test_save_statistics_markdown(spark, tmp_path):
    df = spark.createDataFrame([(2.70761, float("inf"), None)], "rmse double, mape double, corr double")
    p = str(tmp_path / "s.md")
    sinks.save_statistics(df, p)
    txt = open(p).read()
    assert "| rmse | 2.7076 |" in txt and "| mape | inf |" in txt and "| corr | nan |" in txt
    sinks.save_statistics(df, str(tmp_path / "s.csv"))
    assert os.path.isdir(str(tmp_path / "s.csv"))
    two = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, mb double")
    sinks.save_statistics(two.drop("k"), p)
    assert open(p).read().count("| mb | 2.0000 |") == 1
    sinks.save_statistics(two.drop("k"), p, average=False)
    assert open(p).read().count("| mb |") == 2
    sinks.save_statistics(two.orderBy("k"), p, keys=["k"])
    assert "## k=b\n\n| Metric | Value |" in open(p).read()


def _write_events(spark, path, rows):
    spark.createDataFrame(rows, "k string, time timestamp, o double, m double").write.mode("append").parquet(path)


def test_stream_window_and_dedup(spark, tmp_path):
    src = str(tmp_path / "ev")
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(minutes=30 * i), float(i), float(i) + 1.0) for i in range(40)]
    _write_events(spark, src, rows + rows[:5])   # the first 5 repeated
    schema = "k string, time timestamp, o double, m double"
    s = xs.read_stream(spark, src, schema)
    out = xs.run_to_table(xs.stream_window_stats(s, "o", "m", freq="3 hours", watermark="1 hour"))
    got = {r["time"]: (r["n"], r["mb"]) for r in out.collect()}
    assert got[t0] == (11, 1.0)        # 6 rows in [00:00, 03:00) plus 5 repeated ones
    dd = xs.run_to_table(xs.stream_dedup(xs.read_stream(spark, src, schema), ["k", "time"], watermark="1 hour"))
    assert dd.count() == 40
    with pytest.raises(ValueError):
        xs.stream_window_stats(s, "o", "m", metrics=["ioa_m"])


def test_stream_stream_join(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([("s1", t0 + dt.timedelta(hours=h), float(h)) for h in range(5)],
                          "site string, time timestamp, obs double").write.parquet(a)
    spark.createDataFrame([("s1", t0 + dt.timedelta(hours=h), 10.0 + h) for h in range(0, 5, 2)],
                          "site string, time timestamp, v double").write.parquet(b)
    o = xs.read_stream(spark, a, "site string, time timestamp, obs double")
    m = xs.read_stream(spark, b, "site string, time timestamp, v double")
    out = xs.run_to_table(xs.stream_pair_streams(o, m, ["site"]))
    assert sorted(r["obs"] for r in out.collect()) == [0.0, 2.0, 4.0]


def test_paired_streams_keep_arrivals_in_files_like_the_streaming_join(spark, tmp_path):
    """The same rows as Spark's stream-stream join over several micro-batches
    (pairs across them, late rows, repeated rows, null keys), without a state store."""
    t0 = dt.datetime(2024, 1, 1)
    hour = lambda h: t0 + dt.timedelta(hours=h)
    o = [[("a", hour(0), 1.0), ("a", hour(0), 2.0), (None, hour(0), 3.0), ("b", None, 4.0)],
         [("b", hour(50), 5.0)], [("a", hour(51), 6.0), ("c", hour(1), 7.0)], [("c", hour(2), 8.0), ("d", hour(60), 9.0)]]
    m = [[("b", hour(49), 1), ("a", hour(1), 2)], [("a", hour(0), 3), ("b", hour(50), 4), (None, hour(0), 5)],
         [("a", hour(52), 6)], [("c", hour(1), 7), ("d", hour(60), 8), ("d", hour(60), 8), ("a", hour(1), 9), ("a", hour(50), 10)]]
    for side, kind, parts in (("o", "site string, time timestamp, obs double", o), ("m", "site string, time timestamp, v int", m)):
        for k, rows in enumerate(parts):
            src = str(tmp_path / f"{side}{k}")
            spark.createDataFrame(rows, kind).coalesce(1).write.parquet(src)
            (tmp_path / side).mkdir(exist_ok=True)
            (part,) = (tmp_path / f"{side}{k}").glob("*.parquet")
            to = tmp_path / side / f"{k}.parquet"
            to.write_bytes(part.read_bytes())
            os.utime(to, (1_700_000_000 + k, 1_700_000_000 + k))
    paired = xs.stream_pair_streams(
        xs.read_stream(spark, str(tmp_path / "o"), "site string, time timestamp, obs double", max_files_per_trigger=1),
        xs.read_stream(spark, str(tmp_path / "m"), "site string, time timestamp, v int", max_files_per_trigger=1),
        ["site"], tolerance="1 hours")
    name = f"kept_in_files_{uuid.uuid4().hex}"  # the checkpoint folder outlives a test run
    got, want = xs.run_to_table(paired, name), xs.run_to_table(paired.stream)
    assert got.columns == want.columns and paired.columns == want.columns and paired.isStreaming
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, want.collect())) and len(rows) > 6
    assert not os.path.exists(os.path.join(xs.ensure_checkpoint_dir(spark), "streams", name, "checkpoint", "state"))
    assert [r["v"] for r in xs.run_to_table(paired.select("v").where("v = 4")).collect()] == [4]
    # resumed: nothing new, the same rows
    assert sorted(map(tuple, xs.run_to_table(paired, name).collect())) == rows


def test_load_named_types(spark, tmp_path):
    p = str(tmp_path / "gfs")
    spark.createDataFrame([(dt.datetime(2024, 1, 1), 103, 2, 255, 280.0), (dt.datetime(2024, 1, 1), 1, 0, 255, 250.0),
                           (dt.datetime(2024, 1, 2), 103, 2, 255, 290.0)],
                          "time timestamp, typeOfFirstFixedSurface int, scaledValueOfFirstFixedSurface int, "
                          "typeOfSecondFixedSurface int, TMP double").write.parquet(p)
    df = io.load_named(spark, "m", "gfs", p, date="2024-01-01", offset={"TMP_2maboveground": -273.15})
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["TMP_2maboveground"] == pytest.approx(6.85)
    assert "Loaded dataset 'm'" in df.schema["TMP_2maboveground"].metadata["history"]
    with pytest.raises(ValueError):
        io.load_named(spark, "x", "nope", p)


def test_ingest_turns_nan_into_null(spark, tmp_path):
    p = str(tmp_path / "nan")
    spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5)], "level int, v double").write.parquet(p)
    rows = {r["level"]: r["v"] for r in io.load_data(spark, io.SourceSpec(path=p)).collect()}
    assert rows == {1: None, 2: None, 3: 1.5}


def test_ingest_keeps_metadata(spark, tmp_path):
    p = str(tmp_path / "wind")
    spark.createDataFrame([(3.0, 4.0)], "UGRD double, VGRD double").write.parquet(p)
    df = io.load_data(spark, io.SourceSpec(path=p))
    assert df.first()["wind_speed"] == 5.0 and df.schema["wind_speed"].metadata["units"] == "m s-1"


def test_day_ranges_keep_whole_days(spark):
    t = [dt.datetime(2024, 1, d, h) for d in range(1, 7) for h in (0, 23)]
    df = spark.createDataFrame([(x,) for x in t], "time timestamp")
    days = [dt.date(2024, 1, d) for d in (2, 3, 5)]
    got = sorted(r["time"] for r in df.where(io._on_days(F.col("time"), days)).collect())
    assert got == [x for x in t if x.date() in days]
    assert df.where(io._on_days(F.col("time"), [])).count() == 0


def test_station_manifest_counts_absent_and_corrupt_files(spark, tmp_path):
    good, torn, none = (str(tmp_path / f"{n}.csv") for n in ("good one", "torn", "none"))
    open(good, "w").write("a,1\nb,2\n")
    import gzip
    whole = gzip.compress(b"c,3\n" * 2000)
    open(torn + ".gz", "wb").write(b"not a gzip file" + whole[20:])
    open(none, "w").close()
    paths = [good, torn + ".gz", none, str(tmp_path / "absent.csv"), str(tmp_path / "nowhere" / "x.csv")]
    df, manifest = io.read_station_manifest(spark, paths, "k string, v int")
    assert sorted(map(tuple, df.collect())) == [("a", 1), ("b", 2)]
    got = {os.path.basename(r["path"]): (r["status"], r["n_rows"]) for r in manifest.collect()}
    assert got == {"good one.csv": ("read", 2), "torn.csv.gz": ("unreadable", 0), "none.csv": ("absent", 0),
                   "absent.csv": ("absent", 0), "x.csv": ("absent", 0)}
    df, manifest = io.read_station_manifest(spark, paths[3:], "k string, v int")
    assert df.count() == 0 and {r["status"] for r in manifest.collect()} == {"absent"}


def test_photometer_files_of_different_headers_in_one_scan(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in ("a.txt", "b.txt", "c.txt"))
    open(a, "w").write("Version 3\nsome,preamble\nDate(dd:mm:yyyy),Time(hh:mm:ss),AOD_550nm,Site_Latitude(Degrees)\n"
                       "02:01:2024,03:04:05,0.25,10.5\n03:01:2024,03:04:05,-999.,x\n04:01:2024,00:00:00,\n")
    open(b, "w").write("Date(dd:mm:yyyy),Time(hh:mm:ss),Site_Latitude(Degrees),Other,Other,Site_Longitude(Degrees),AOD_550nm\n"
                       "05:01:2024,00:00:00,1,9,8,2,0.5,extra\n")
    open(c, "w").write("05:01:2024,00:00:00,1,2\n")  # no header
    out = io.parse_photometer_files(io.read_photometer_files(spark, [a, b, c])).orderBy("time").collect()
    got = [(os.path.basename(r["file"]), r["time"].day, r["lat"], r["lon"], r["aod_550nm"], r["elevation"]) for r in out]
    assert got == [("a.txt", 2, 10.5, None, 0.25, None), ("a.txt", 3, None, None, None, None),
                   ("a.txt", 4, None, None, None, None), ("b.txt", 5, 1.0, 2.0, 0.5, None)]


def test_stream_windows_to_the_end_over_many_batches(spark, tmp_path):
    src = str(tmp_path / "ev")
    t0 = dt.datetime(2024, 1, 1)
    for day in range(6):
        _write_events(spark, src, [("a", t0 + dt.timedelta(days=day, minutes=30 * i), float(i), float(i + day)) for i in range(40)])
    schema = "k string, time timestamp, o double, m double"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = xs.run_to_latest(xs.stream_window_stats(s, "o", "m", freq="3 hours", watermark="10 days"), ["time"])
    batch = spark.read.schema(schema).parquet(src).groupBy(F.window("time", "3 hours")["start"].alias("time")).agg(
        F.count("*").alias("n"), F.avg(F.col("m") - F.col("o")).alias("mb"))
    assert {(r["time"], r["n"], r["mb"]) for r in out.collect()} == {tuple(r) for r in batch.collect()}
    once = xs.stream_dedup(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), ["k", "time"], watermark="10 days")
    assert xs.run_to_table(once).count() == 240
