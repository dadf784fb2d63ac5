"""Sources, look-ups, local time, splits and the incremental run."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.functions import localtime
from gridloom.functions.versions import version_rank
from gridloom.jobs.pipeline import bounds, read_config, read_rejects, run_pipeline
from gridloom.operators import daily, intervals, lookup, split
from gridloom.sources import exports
from gridloom.sources import points as store

POINT = "measurement string, entity_id string, field string, version string, scenario string, unit string, time timestamp, value double"


def raw(spark, rows):
    return spark.createDataFrame([("raw", e, "value", "", "", "", t, v) for e, t, v in rows], POINT)


def plain(df, *columns):
    return [tuple(r) for r in df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if df.schema[c].dataType.typeName() == "timestamp" else F.col(c) for c in columns]).collect()]


@pytest.mark.parametrize(
    ("local", "utc"),
    [("2024-10-27 02:30:00", datetime(2024, 10, 27, 1, 30)), ("2024-03-31 02:30:00", datetime(2024, 3, 31, 1, 30)), ("2024-07-01 12:00:00", datetime(2024, 7, 1, 10)), ("2024-10-27 01:30:00", datetime(2024, 10, 26, 23, 30)), ("2024-10-27 03:00:00", datetime(2024, 10, 27, 2))],
)
def test_local_to_utc(spark, local, utc):
    row = spark.range(1).select(localtime.to_utc(F.lit(local).cast("timestamp")).cast("timestamp_ntz").alias("x")).first()
    assert row.x == utc


@pytest.mark.parametrize(("day", "hours"), [(date(2024, 3, 31), 23), (date(2024, 10, 27), 25), (date(2024, 1, 15), 24)])
def test_length_of_day(spark, day, hours):
    d = F.lit(day)
    assert spark.range(1).select(localtime.hours_between(localtime.day_start(d), localtime.next_day_start(d)).alias("h")).first().h == hours


@pytest.mark.parametrize(("back", "n"), [(3, 2), (1, 0), (0, 0)])
def test_days_to_process(spark, back, n):
    as_of = date(2024, 1, 10)
    days = localtime.days_after(F.lit(as_of - timedelta(days=back)), F.date_sub(F.lit(as_of), 1))
    assert spark.range(1).select(F.size(days).alias("n")).first().n == n


@pytest.mark.parametrize(("names", "top"), [(["v2", "v10", "v9", ""], "v10"), (["v10", "beta"], "beta"), ([""], None), ([], None)])
def test_latest_version(spark, names, top):
    frame = spark.createDataFrame([(n,) for n in names], "version string")
    assert lookup.latest_version(frame).first().version == top
    assert version_rank(F.col("version")) is not None


def test_max_point_takes_the_earliest_of_equals(spark):
    t = [datetime(2024, 1, 1, h) for h in range(3)]
    got = lookup.max_point(raw(spark, [("a", t[0], 5.0), ("a", t[1], 7.0), ("a", t[2], 7.0)]), ["entity_id"])
    assert plain(got, "value", "time") == [(7.0, t[1])]


def test_range_is_half_open(spark):
    t = [datetime(2024, 1, 1, h) for h in range(3)]
    frame = raw(spark, [("a", x, 1.0) for x in t])
    got = store.select_points(frame, F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 02:00:00").cast("timestamp"))
    assert got.count() == 2 and store.select_points(frame, version="").count() == 3


def test_first_and_last_day_of_nothing(spark):
    none = raw(spark, [])
    assert lookup.first_day(none).first().first_day is None and lookup.last_day(none).first().last_day is None


def test_points_fills_defaults(spark):
    now = datetime(2024, 1, 1)
    frame = spark.createDataFrame([("a", 1)], "entity_id string, value int")
    row = store.points(frame, now).withColumn("time", F.col("time").cast("timestamp_ntz")).first()
    assert row.measurement == "home_assistant" and row.field == "value" and row.version == "" and row.value == 1.0 and row.time == now


def split_case(spark):
    day = datetime(2024, 1, 15)
    at = lambda h: day + timedelta(hours=h)
    pump = raw(spark, [("p", at(h), v) for h, v in [(0, 0.0), (1, 1.0), (2, 1.5), (3, 2.5), (4, 3.0), (6, 4.0)]] + [("q", at(1), 2.0)])
    grid = raw(spark, [("g", at(h), v) for h, v in [(0, -500.0), (1, 400.0), (1.5, 2000.0), (2.5, -100.0), (4, 300.0)]])
    roles = spark.createDataFrame([("p", "g", "all"), ("q", "g", "all")], "pump_entity string, grid_entity string, output_entity string")
    return split.split_intervals(pump, grid, roles)


def test_split(spark):
    got = split_case(spark).orderBy("stop").select(F.round("import_kwh", 6), F.round("pv_contribution", 6), F.round("grid_import", 6)).collect()
    assert [tuple(r) for r in got] == [(0.0, 1.0, 0.0), (1.466667, 0.0, 0.5), (0.8, 0.2, 0.8), (0.0, 0.5, 0.0), (0.0, 1.0, 0.0)]
    spine = spark.createDataFrame([("p", "all", date(2024, 1, 15)), ("q", "all", date(2024, 1, 15))], "entity_id string, output_entity string, day date")
    days = {r.entity_id: (round(r.daily_pv, 6), round(r.daily_grid_import, 6)) for r in split.split_days(split_case(spark), spine).collect()}
    assert days == {"p": (2.7, 1.3), "q": (0.0, 0.0), "all": (2.7, 1.3)}


@pytest.mark.parametrize("width", [600, 3600, 86400])
def test_overlaps_make_each_pair_once(spark, width):
    import random

    rng, t0 = random.Random(3), datetime(2024, 1, 1)
    make = lambda n: [("k", t0 + timedelta(seconds=s), t0 + timedelta(seconds=s + rng.randrange(1, 9000))) for s in (rng.randrange(40000) for _ in range(n))]
    a, b = make(60), make(60)
    frames = [spark.createDataFrame(x, "k string, start timestamp, stop timestamp") for x in (a, b)]
    want = sum(x[1] < y[2] and x[2] > y[1] for x in a for y in b)
    assert intervals.overlaps(*frames, ["k"], width).count() == want


@pytest.mark.parametrize("width", [60, 3600, 86400])
def test_import_by_running_sums(spark, width):
    """Against all pairs, with ties of ends, gaps, exports, powers that are no numbers, and intervals without any overlap."""
    import math
    import random

    rng, t0 = random.Random(width), datetime(2024, 1, 1)
    make = lambda n, more: [("k", t0 + timedelta(seconds=s), t0 + timedelta(seconds=s + rng.randrange(0, 40) * 60), *more()) for s in (rng.randrange(300) * 60 for _ in range(n))]
    asked = list({x[1:]: x for x in make(80, tuple) if x[1] < x[2]}.values())
    given = make(60, lambda: (rng.choice([-500.0, 0.0, 0.1, 333.3, 2000.0, None]),))
    given += [("k", t0 + timedelta(hours=9), t0 + timedelta(hours=10), float("nan")), ("other", t0, t0 + timedelta(hours=9), 1e6)]
    asked.append(("k", t0 + timedelta(hours=9, minutes=30), t0 + timedelta(hours=11)))
    frames = spark.createDataFrame(asked, "k string, start timestamp, stop timestamp"), spark.createDataFrame(given, "k string, start timestamp, stop timestamp, value double")
    got = {(r.start, r.stop): r.import_kwh for r in intervals.import_energy(*frames, ["k"], width).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")}).collect()}
    assert len(got) == len(asked)
    for _, a, b in asked:
        met = [((y - x).total_seconds(), p) for k, x, y, p in given if k == "k" and x < y and x < b and y > a]
        energy, span = sum(s * p / 3.6e6 for s, p in met if p is not None and not p < 0), sum(s for s, _ in met)
        want = energy * (b - a).total_seconds() / span if span else 0.0
        assert got[a, b] == pytest.approx(want, abs=1e-12, nan_ok=True) and (got[a, b] == 0.0) == (want == 0.0) and math.isnan(got[a, b]) == math.isnan(want)


def test_a_dense_hour_makes_no_pairs(spark):
    """A second's interval on each side for an hour, shifted by half a second: 7,199 overlaps, and rows in proportion."""
    seconds = spark.range(3600).select(F.lit("k").alias("k"), F.timestamp_micros(F.col("id") * 1_000_000).alias("start"), F.timestamp_micros(F.col("id") * 1_000_000 + 1_000_000).alias("stop"), (F.col("id") % 7 * 100.0).alias("value"))
    half = seconds.withColumns({c: F.col(c) + F.expr("INTERVAL 0.5 SECOND") for c in ("start", "stop")}).drop("value")
    found = intervals.import_energy(half, seconds, ["k"])
    rows = {r["start"]: r["kwh"] for r in found.select(F.unix_micros("start").alias("start"), F.col("import_kwh").alias("kwh")).collect()}
    mean = lambda i: (i % 7 + (i + 1) % 7) * 50.0 if i < 3599 else i % 7 * 100.0
    assert len(rows) == 3600 and all(rows[i * 1_000_000 + 500_000] == pytest.approx(mean(i) / 3.6e6) for i in range(3600))
    assert "CartesianProduct" not in found._jdf.queryExecution().toString() and "NestedLoop" not in found._jdf.queryExecution().toString()


def test_a_power_counts_with_all_its_places(spark):
    hour = [datetime(2024, 1, 1, h) for h in range(3)]
    for power in (1000 / 3, 12345.678901234567, 1e-7):
        grid = spark.createDataFrame([("k", hour[0], hour[2], power)], "k string, start timestamp, stop timestamp, value double")
        used = spark.createDataFrame([("k", hour[0], hour[1], 0.0)], "k string, start timestamp, stop timestamp, value double")
        got = intervals.import_energy(used, grid, ["k"]).first().import_kwh
        assert got == pytest.approx(power / 1000, rel=1e-9, abs=1e-15)


def test_wide_and_long_form(spark):
    wide = spark.createDataFrame([("a", 1.0, 2.0)], "entity_id string, daily_pv double, daily_grid_import double")
    long = split.long_form(wide, ["entity_id"], split.DAILY_FIELDS)
    assert long.count() == 2 and split.wide_form(long, ["entity_id"], split.DAILY_FIELDS).collect() == wide.collect()


def test_daily_sums(spark):
    t = datetime(2024, 1, 15, 10)
    got = daily.daily_sums(raw(spark, [("a", t, 6.0), ("a", t, 1.0), ("b", t, 4.0)]), "total")
    assert sorted(plain(got, "entity_id", "daily_sum")) == [("a", 6.0), ("b", 4.0), ("total", 10.0)]
    stamp = daily.daily_points(got, "m", "v1").select(F.col("time").cast("timestamp_ntz").alias("t")).first().t
    assert stamp == datetime(2024, 1, 15, 22, 59, 59, 999999)


def test_upsert_and_delete(spark, tmp_path):
    path, t = str(tmp_path / "points"), datetime(2024, 1, 15, 10)
    one = raw(spark, [("a", t, 1.0), ("a", t + timedelta(hours=1), 2.0), ("b", t, 3.0)])
    store.write_points(one, path)
    store.write_points(raw(spark, [("a", t, 9.0)]), path)
    read = lambda: sorted(plain(store.read_points(spark, path), "entity_id", "time", "value"))
    want = [("a", t, 9.0), ("a", t + timedelta(hours=1), 2.0), ("b", t, 3.0)]
    assert read() == want
    store.write_points(raw(spark, [("a", t, 9.0)]), path)
    assert read() == want
    hit = store.matching(F.lit("2024-01-15 00:00:00").cast("timestamp"), F.lit("2024-01-16 00:00:00").cast("timestamp"), measurement="raw", entity_id="a")
    store.delete_points(spark, path, hit)
    assert read() == [("b", t, 3.0)]
    store.delete_points(spark, path, store.matching(F.lit("2024-01-15 00:00:00").cast("timestamp"), F.lit("2024-01-16 00:00:00").cast("timestamp")))
    assert read() == []


CONFIG = {
    "repair": {"version": "v1", "entities": ["p", "q", " "], "output_measurement": "clean"},
    "daily": {"version": "v1", "entities": ["p", "q"], "output_entity_id": "all", "output_measurement": "stat"},
    "split": {"version": "v1", "entities": ["p", "q", "g"], "output_entity_id": "all", "output_measurement": "stat"},
}


def test_config_is_checked():
    whole = {"input": "a", "output": "b", "jobs": CONFIG}
    assert [j.kind for j in read_config(whole)] == ["repair", "daily", "split"] and read_config(whole)[0].entities == ("p", "q")
    for broken in ({"input": "a"}, whole | {"jobs": []}, whole | {"jobs": {"daily": {"version": "v1", "entities": ["p"]}}}, whole | {"jobs": {"repair": {"entities": ["p"]}}}, whole | {"jobs": {"repair": {"version": "v1", "entities": "p"}}}):
        with pytest.raises(ValueError):
            read_config(broken)
    assert read_config(whole | {"jobs": {"repair": CONFIG["repair"] | {"entities": ["", 3]}}}) == []


def test_incremental_run(spark, tmp_path):
    config = {"input": str(tmp_path / "in"), "output": str(tmp_path / "out"), "jobs": CONFIG}
    start, rows = datetime(2024, 1, 15), []
    for d in range(3):
        for h in range(24):
            t = start + timedelta(days=d, hours=h, minutes=10)
            rows += [("p", t, h * 0.5), ("q", t, h * 0.25), ("g", t, 400.0 if h % 2 else -300.0)]
    store.write_points(raw(spark, rows), config["input"])
    first = store.read_points(spark, config["input"]).agg(F.to_date(F.min("time"))).first()[0]
    assert first == date(2024, 1, 15)
    assert run_pipeline(spark, config, date(2024, 1, 18)) == ["repair", "daily", "split"]
    # sums of doubles may differ in their last bits, as Spark adds in any order
    table = lambda: sorted((*r[:-1], round(r[-1], 9)) for r in plain(store.read_points(spark, config["output"]), *store.KEY[:-1], "time", "value"))
    done = table()
    sums = [r for r in done if r[5] == "daily_sum" and r[1] == "all"]
    assert [round(r[-1], 6) for r in sums] == [17.25, 17.25, 17.25]
    assert run_pipeline(spark, config, date(2024, 1, 18)) == [] and table() == done
    # what is deleted at the end is made again
    hit = store.matching(F.lit("2024-01-16 23:00:00").cast("timestamp"), F.lit("2024-01-18 00:00:00").cast("timestamp"))
    store.delete_points(spark, config["output"], hit)
    assert table() != done and run_pipeline(spark, config, date(2024, 1, 18)) == ["repair", "daily", "split"]
    assert table() == done


def test_bad_days(spark, tmp_path):
    config = {"input": str(tmp_path / "in"), "output": str(tmp_path / "out"), "jobs": {"repair": CONFIG["repair"]}}
    t = datetime(2024, 1, 14, 20)
    store.write_points(raw(spark, [("p", t, 1.0), ("p", t + timedelta(hours=16), 2.0), ("q", t + timedelta(hours=16), 0.0)]), config["input"])
    with pytest.raises(ValueError, match="no_first_reset"):
        run_pipeline(spark, config, date(2024, 1, 16))
    assert not (tmp_path / "out").exists()
    assert run_pipeline(spark, config, date(2024, 1, 16), "quarantine") == ["repair"]
    bad = sorted(map(tuple, read_rejects(spark, config["output"]).collect()))
    assert ("p", "no_first_reset", "repair", date(2024, 1, 15)) in bad
    assert store.read_points(spark, config["output"]).filter("entity_id = 'q'").count() > 0
    # the same days once more: what is rejected still is there once, what is good now is gone
    hit = store.matching(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp"))
    store.delete_points(spark, config["output"], hit)
    assert run_pipeline(spark, config, date(2024, 1, 16), "quarantine") == ["repair"]
    assert sorted(map(tuple, read_rejects(spark, config["output"]).collect())) == bad
    store.write_points(raw(spark, [("p", t, 0.0)]), config["input"])
    store.delete_points(spark, config["output"], hit)
    assert run_pipeline(spark, config, date(2024, 1, 16), "quarantine") == ["repair"]
    assert not [r for r in read_rejects(spark, config["output"]).collect() if r.day == date(2024, 1, 15)]


def test_jobs_that_cannot_be_done(spark, tmp_path):
    """No repaired counters to read; a null in a window; a share below 0."""
    t = datetime(2024, 1, 15, 10)
    config = {"input": str(tmp_path / "in"), "output": str(tmp_path / "out"), "jobs": {"daily": CONFIG["daily"] | {"cleaned_measurement": "clean"}}}
    store.write_points(raw(spark, [("p", t, None), ("p", t + timedelta(hours=1), 1.0)]), config["input"])
    with pytest.raises(ValueError, match="no repaired counters"):
        run_pipeline(spark, config, date(2024, 1, 16))
    with pytest.raises(ValueError, match="null_value"):
        run_pipeline(spark, config | {"jobs": {"repair": CONFIG["repair"]}}, date(2024, 1, 16))
    falling = raw(spark, [("p", t, 2.0), ("p", t + timedelta(hours=1), 1.0)])
    roles = spark.createDataFrame([("p", "g", "all")], "pump_entity string, grid_entity string, output_entity string")
    assert [r.status for r in split.split_intervals(falling, raw(spark, []), roles).collect()] == ["negative_share"]


def test_any_tag_can_be_deleted(spark, tmp_path):
    path, t = str(tmp_path / "points"), datetime(2024, 1, 15, 10)
    names = ["a:b/c", "", "100%=x", "plain"]
    rows = [(m, "e", "value", v, "", "", t, 1.0) for m in names for v in ("", "v/1")]
    store.write_points(spark.createDataFrame(rows, POINT), path)
    read = lambda: sorted(plain(store.read_points(spark, path), "measurement", "version"))
    assert read() == sorted((m, v) for m in names for v in ("", "v/1"))
    left = set(read())
    for m, v in sorted(left):
        store.delete_points(spark, path, (F.col("measurement") == m) & (F.col("version") == v))
        left.discard((m, v))
        assert read() == sorted(left)
    store.write_points(spark.createDataFrame(rows[:2], POINT), path)
    assert read() == [("a:b/c", ""), ("a:b/c", "v/1")]


def test_partitions_of_other_days_are_not_read(spark, tmp_path):
    path = str(tmp_path / "points")
    store.write_points(raw(spark, [("p", datetime(2024, 1, d, 10), 1.0) for d in range(1, 20)]), path)
    found = bounds(store.select_points(store.read_points(spark, path), entities=["p"]), date(2024, 1, 5), date(2024, 1, 7), 5, 5)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [" in plan and "IsNotNull(time)" in plan


def test_exports_there_and_back(spark, tmp_path):
    at = datetime(2024, 10, 27, 0, 30, 0, 123456)
    rows = [("a,b", 'x "y"', "value", "v1", "", "kWh", at, 0.1 + 0.2), ("m", "e", "f", "", "", "", at + timedelta(hours=1), None), ("m", "ü\\", "f", "", "s", "", at, -1e300)]
    frame = spark.createDataFrame(rows, POINT)
    for form in ("csv", "json"):
        exports.write_export(frame, str(tmp_path / form), form)
        good, bad = exports.read_export(spark, str(tmp_path / form), form)
        assert sorted(plain(good, *frame.columns), key=repr) == sorted(plain(frame, *frame.columns), key=repr) and bad.isEmpty()


def test_bad_lines_of_exports_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text("entity_id,time,value\na,2024-07-01 12:00:00,True\na,2024-07-01T12:00:00+00:00,2\n,2024-07-01 12:00:00,3\nb,soon,4\nb,2024-07-01,five\nb,2024-07-01,\nc,2024-07-01,6,7\n")
    good, bad = exports.read_export(spark, str(tmp_path / "x.csv"), "csv", ("entity_id", "time", "value"))
    assert sorted(plain(good, "entity_id", "time", "value"), key=repr) == sorted([("a", datetime(2024, 7, 1, 10), 1.0), ("a", datetime(2024, 7, 1, 12), 2.0), ("b", datetime(2024, 6, 30, 22), None)], key=repr)
    assert {r.measurement for r in good.collect()} == {"home_assistant"} and sorted(r.reason for r in bad.collect()) == ["entity_id", "format", "time", "value"]
    assert "c,2024-07-01,6,7" in {r.record for r in bad.collect()}
    (tmp_path / "x.json").write_text('{"entity_id": "a", "time": "2024-01-01T00:00:00Z", "value": 1, "more": [1]}\n{"entity_id": "a"\n\n')
    good, bad = exports.read_export(spark, str(tmp_path / "x.json"), "json")
    assert good.count() == 1 and [tuple(r) for r in bad.collect()] == [('{"entity_id": "a"', "format")]
    with pytest.raises(ValueError):
        exports.read_export(spark, "x", "xml")
