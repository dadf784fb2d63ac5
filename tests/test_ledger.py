"""The ledger of days, changes of several tables together, files that are read and written, and jobs of one's own."""

import glob
import os
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.jobs import pipeline
from gridloom.jobs.pipeline import CLEANED, RAW, KINDS, Kind, Work, ordered, read_rejects, register, run_pipeline
from gridloom.sources import ledger, swap
from gridloom.sources import points as store
from gridloom.sources.days import day_list, within

from .test_jobs import CONFIG, plain, raw

FIRST = datetime(2024, 1, 15)


def table(spark, path):
    """Sums of doubles may differ in their last bits."""
    return sorted((*r[:-1], round(r[-1], 9)) for r in plain(store.read_points(spark, path), *store.KEY[:-1], "time", "value"))


def config_of(tmp_path, jobs=CONFIG):
    return {"input": str(tmp_path / "in"), "output": str(tmp_path / "out"), "jobs": jobs}


def readings(days=5, names=("p", "q")):
    at = [(d, h, FIRST + timedelta(days=d, hours=h, minutes=10)) for d in range(days) for h in range(24)]
    return [(n, t, h * 0.5 / (i + 1)) for i, n in enumerate(names) for _, h, t in at] + [("g", t, 400.0 if h % 2 else -300.0) for _, h, t in at]


def files(path):
    return sorted(glob.glob(f"{path}/**/*.parquet", recursive=True))


def scanned(df):
    """Files that the scan of df, a plan without shuffles, opens."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value()


def statuses(spark, config, job="repair"):
    return {(r.entity_id, r.day.day): r.status for r in ledger.read_ledger(spark, config["output"], job).collect()}


def test_rejected_days_are_done_again(spark, tmp_path):
    config, bad = config_of(tmp_path), FIRST + timedelta(days=2, hours=10, minutes=10)
    good = raw(spark, readings())
    store.write_points(good.withColumn("value", F.when((F.col("entity_id") != "p") | (F.col("time") != F.lit(bad)), F.col("value"))), config["input"])
    assert run_pipeline(spark, config, date(2024, 1, 20), "quarantine") == ["repair", "daily", "split"]
    assert statuses(spark, config)["p", 17] == "null_value" and statuses(spark, config)["q", 17] == statuses(spark, config)["p", 18] == ledger.DONE
    assert statuses(spark, config, "daily")["all", 17] == "held_up"
    assert [tuple(r) for r in read_rejects(spark, config["output"]).filter("job = 'repair'").collect()] == [("p", "null_value", "repair", date(2024, 1, 17))]
    # tried again, and still bad: nothing changes
    before = table(spark, config["output"])
    assert run_pipeline(spark, config, date(2024, 1, 20), "quarantine") == ["repair", "daily", "split"] and table(spark, config["output"]) == before
    store.write_points(raw(spark, [("p", bad, 5.0)]), config["input"])
    assert run_pipeline(spark, config, date(2024, 1, 20), "quarantine") == ["repair", "daily", "split"]
    assert set(statuses(spark, config).values()) == set(statuses(spark, config, "daily").values()) == {ledger.DONE}
    assert read_rejects(spark, config["output"]).isEmpty() and run_pipeline(spark, config, date(2024, 1, 20)) == []
    # as if it had been right from the start
    other = config_of(tmp_path / "other")
    store.write_points(good, other["input"])
    run_pipeline(spark, other, date(2024, 1, 20))
    assert table(spark, config["output"]) == table(spark, other["output"])


def test_open_days_are_found_in_the_ledger_alone(spark, tmp_path):
    config = config_of(tmp_path, {"repair": CONFIG["repair"]})
    store.write_points(raw(spark, readings(2)), config["input"])
    run_pipeline(spark, config, date(2024, 1, 17))
    spine = spark.createDataFrame([("p", date(2024, 1, 15)), ("p", date(2024, 1, 17)), ("z", date(2024, 1, 15))], "entity_id string, day date")
    found = ledger.days_to_do(spine, ledger.read_ledger(spark, config["output"], "repair"))
    assert sorted(map(tuple, found.collect())) == [("p", date(2024, 1, 17)), ("z", date(2024, 1, 15))]
    assert found.inputFiles() and all("_ledger/" in f for f in found.inputFiles())


def test_all_tables_change_or_none(spark, tmp_path, monkeypatch):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    frame = lambda v: spark.createDataFrame([(v, "a"), (v, "b")], "v int, k string")
    swap.replace_together(spark, [(frame(1), one, ("k",)), (frame(1), two, ())])
    read = lambda: (sorted(map(tuple, spark.read.parquet(one).collect())), sorted(map(tuple, spark.read.parquet(two).collect())))
    before = read()
    with pytest.raises(Exception, match="wrong row"):  # while rows are written
        swap.replace_together(spark, [(frame(2), one, ("k",)), (frame(2).withColumn("v", F.raise_error(F.lit("wrong row")).cast("int")), two, ())])
    assert read() == before
    real, asked = swap.folders, []

    def folders(*args):
        asked.append(args)
        if len(asked) == 2:
            raise OSError("no such folder")
        return real(*args)

    monkeypatch.setattr(swap, "folders", folders)
    with pytest.raises(OSError, match="no such folder"):  # after the first table has been changed
        swap.replace_together(spark, [(frame(2), one, ("k",)), (frame(2), two, ())])
    assert read() == before and len(asked) == 2 and sorted(os.listdir(tmp_path)) == ["one", "two"]
    monkeypatch.undo()
    swap.replace_together(spark, [(frame(3).filter("k = 'a'"), one, ("k",)), (frame(3), two, ())])
    assert read() == ([(1, "b"), (3, "a")], [(3, "a"), (3, "b")])


def test_results_and_ledger_stay_together(spark, tmp_path, monkeypatch):
    config = config_of(tmp_path, {"repair": CONFIG["repair"]})
    store.write_points(raw(spark, readings(3)), config["input"])
    run_pipeline(spark, config, date(2024, 1, 16))
    before, known = table(spark, config["output"]), statuses(spark, config)
    entered = ledger.entered
    broken = lambda *a: (entered(*a)[0].withColumn("status", F.raise_error(F.lit("ledger"))), *entered(*a)[1:])
    monkeypatch.setattr(ledger, "entered", broken)
    with pytest.raises(Exception, match="ledger"):
        run_pipeline(spark, config, date(2024, 1, 18))
    assert table(spark, config["output"]) == before and statuses(spark, config) == known
    monkeypatch.undo()
    run_pipeline(spark, config, date(2024, 1, 18))
    assert len(statuses(spark, config)) == 6


def test_rejects_are_counted_while_rows_are_stored(spark, tmp_path):
    config = config_of(tmp_path, {"repair": CONFIG["repair"]})
    rows = [r if r[0] == "g" else (r[0], r[1], None if r[1].day == 16 and r[1].hour == 12 else r[2]) for r in readings(3)]
    store.write_points(raw(spark, rows), config["input"])
    with pytest.raises(ValueError, match=r"p on 2024-01-16: null_value; \{'null_value': 2\}"):
        run_pipeline(spark, config, date(2024, 1, 18))
    assert not (tmp_path / "out").exists() and not (tmp_path / "out_ledger").exists()


def test_only_touched_files_are_read(spark, tmp_path):
    path = str(tmp_path / "points")
    store.write_points(raw(spark, [(e, FIRST + timedelta(days=d), 1.0) for e in "pq" for d in range(30)]), path)
    assert len(files(path)) == 30
    touched = spark.createDataFrame([("raw", "", date(2024, 1, 20)), ("raw", "", date(2024, 1, 21)), ("raw", "", date(2024, 2, 1)), ("x", "", date(2024, 1, 15))], "measurement string, version string, day date")
    found = store.in_partitions(store._parts(spark, path), touched)
    assert found.count() == 6 and scanned(found) == 3
    assert scanned(store.read_points(spark, path).filter(within([(date(2024, 1, 20), date(2024, 1, 22))], F.col("day"), 1, 0))) == 4
    old = {f: os.stat(f).st_ino for f in files(path)}
    store.write_points(raw(spark, [("p", FIRST + timedelta(days=3), 7.0)]), path)
    assert len(set(old) & set(files(path))) == 29 and store.read_points(spark, path).count() == 60
    # more runs of days than a filter spells out
    many = spark.createDataFrame([("raw", "", date(2024, 1, 1) + timedelta(days=2 * d)) for d in range(100)], "measurement string, version string, day date")
    assert len(day_list(many)) == 1 and store.in_partitions(store._parts(spark, path), many).count() == 2 * sum((FIRST.date() + timedelta(days=d) - date(2024, 1, 1)).days % 2 == 0 for d in range(30))


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "points")
    many = spark.range(200_000).select(F.lit("raw").alias("measurement"), F.concat(F.lit("e"), F.col("id") % 1000).alias("entity_id"), F.timestamp_micros(F.lit(1705312800000000) + F.col("id") * 1000).alias("time"), F.rand(1).alias("value"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        store.write_points(store.points(many), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/measurement=raw/*/day=2024-01-15/*.parquet")) > 1 and store.read_points(spark, path).count() == 200_000


def test_versions_are_known_without_points(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = [("clean", e, "value", v, "", "", FIRST, 1.0) for e, v in (("p", "v2"), ("p", "v10"), ("q", "v9"), ("r", ""))]
    store.write_points(spark.createDataFrame(rows, store.POINTS), path)
    store.write_points(spark.createDataFrame([("clean", "q", "value", "v11", "", "", FIRST, 1.0), ("other", "q", "value", "v1", "", "", FIRST, 1.0)], store.POINTS), path)
    found = store.read_versions(spark, path)
    assert all("_versions/" in f for f in found.inputFiles())
    assert sorted((r.measurement, r.entity_id, r.version) for r in found.collect()) == [("clean", "p", "v10"), ("clean", "p", "v2"), ("clean", "q", "v11"), ("clean", "q", "v9"), ("clean", "r", ""), ("other", "q", "v1")]
    store.delete_points(spark, path, F.col("version") == "v11")
    store.compact(spark, path)
    assert sorted(r.version for r in store.read_versions(spark, path).filter("entity_id = 'q'").collect()) == ["v1", "v9"]


def test_each_entity_at_its_latest_version(spark, tmp_path):
    config = config_of(tmp_path, {"daily": CONFIG["daily"] | {"cleaned_measurement": "clean"}})
    store.write_points(raw(spark, readings(1)), config["input"])
    rows = [("clean", e, "value", v, "", "kWh", FIRST + timedelta(hours=9), x) for e, v, x in (("p", "v2", 5.0), ("p", "v10", 6.0), ("q", "v9", 3.0))]
    store.write_points(spark.createDataFrame(rows, store.POINTS), config["output"])
    run_pipeline(spark, config, date(2024, 1, 16))
    sums = store.read_points(spark, config["output"]).filter("field = 'daily_sum'").collect()
    assert {r.entity_id: r.value for r in sums} == {"p": 6.0, "q": 3.0, "all": 9.0}


def test_many_entities_make_no_larger_plan(spark, tmp_path):
    sizes = {}
    points = raw(spark, readings(1))
    for n in (10, 100_000):
        names = str(tmp_path / f"names{n}")
        spark.range(n).select(F.concat(F.lit("m"), "id").alias("entity_id")).write.parquet(names)
        began = time.perf_counter()
        plan = store.select_points(points, entities=spark.read.parquet(names))._jdf.queryExecution().executedPlan().toString()
        assert time.perf_counter() - began < 2
        sizes[n] = len(plan)
    assert abs(sizes[10] - sizes[100_000]) < 50
    some = store.select_points(points, entities=spark.createDataFrame([("q",), ("q",), ("z",)], "entity_id string"))
    assert some.count() == 24 and some.columns == points.columns


def test_a_job_between_two_others(spark, tmp_path):
    ran = []

    def doubled(run):
        days = run.open_days(run.entities())
        if days.isEmpty():
            return None
        have = store.select_points(run.results(), measurement=run.job.settings["of"], entities=run.entities())
        ran.append((run.job.kind, have.count()))
        return Work(have.withColumn("value", F.col("value") * 2).withColumn("version", F.lit(run.job.version)), days, days.limit(0).withColumn("status", F.lit("")))

    register("doubled", doubled, ["of"], [CLEANED], [CLEANED])
    try:
        assert ordered(KINDS) == ["repair", "doubled", "daily", "split"]
        jobs = {"daily": CONFIG["daily"], "doubled": {"version": "v2", "entities": ["p"], "of": "clean", "output_measurement": "clean"}, "repair": CONFIG["repair"]}
        config = config_of(tmp_path, jobs)
        store.write_points(raw(spark, readings(2)), config["input"])
        with pytest.raises(ValueError, match="doubled needs of"):
            run_pipeline(spark, config | {"jobs": jobs | {"doubled": {"version": "v2", "entities": ["p"]}}}, date(2024, 1, 17))
        assert run_pipeline(spark, config, date(2024, 1, 17)) == ["repair", "doubled", "daily"] and ran[0][1] > 40
        sums = {(r.entity_id, r.value) for r in store.read_points(spark, config["output"]).filter("field = 'daily_sum'").collect()}
        assert sums == {("p", 23.0), ("q", 5.75), ("all", 28.75)}
        assert run_pipeline(spark, config, date(2024, 1, 17)) == [] and len(ran) == 1
    finally:
        del KINDS["doubled"]


def test_order_of_jobs():
    kind = lambda i, o: Kind(lambda run: None, inputs=tuple(i), outputs=tuple(o))
    assert ordered({"c": kind("y", "z"), "b": kind("x", "y"), "amend": kind("y", "y"), "a": kind([RAW], "x")}) == ["a", "b", "amend", "c"]
    assert ordered({"two": kind("x", "x"), "one": kind("x", "x"), "make": kind([], "x")}) == ["make", "two", "one"]
    with pytest.raises(ValueError, match="each other's outputs"):
        ordered({"a": kind("x", "y"), "b": kind("y", "x")})


def test_late_points_on_request(spark, tmp_path):
    config = config_of(tmp_path)
    store.write_points(raw(spark, readings(4)), config["input"])
    run_pipeline(spark, config, date(2024, 1, 19))
    late = FIRST + timedelta(days=1, hours=23, minutes=20)
    store.write_points(raw(spark, [("p", late, 11.9)]), config["input"])
    before = table(spark, config["output"])
    assert run_pipeline(spark, config, date(2024, 1, 19)) == [] and run_pipeline(spark, config, date(2024, 1, 19), recheck=1) == []
    assert table(spark, config["output"]) == before
    assert run_pipeline(spark, config, date(2024, 1, 19), recheck=10) == ["repair", "daily", "split"]
    sums = {(r.entity_id, r.time.day): r.value for r in store.read_points(spark, config["output"]).filter("field = 'daily_sum'").withColumn("time", F.col("time").cast("timestamp_ntz")).collect()}
    assert sums["p", 16] == 11.9 and sums["all", 16] == 17.65 and sums["p", 15] == 11.5
    assert run_pipeline(spark, config, date(2024, 1, 19), recheck=10) == []


def test_deleted_ranges(spark, tmp_path):
    config = config_of(tmp_path, {"repair": CONFIG["repair"]})
    store.write_points(raw(spark, readings(4)), config["input"])
    run_pipeline(spark, config, date(2024, 1, 19))
    path = config["output"]
    before, old = table(spark, path), files(path)
    store.delete_range(spark, path, FIRST + timedelta(days=1), FIRST + timedelta(days=1, hours=20), measurement="clean", entity_id="p")
    assert files(path) == old
    held = [r for r in before if r[1] != "p" or not (FIRST + timedelta(days=1) <= r[-2] < FIRST + timedelta(days=1, hours=20))]
    assert table(spark, path) == held and len(held) < len(before)
    assert statuses(spark, config)["p", 16] == ledger.OPEN and statuses(spark, config)["p", 18] == ledger.DONE
    store.compact(spark, path)
    assert table(spark, path) == held and files(path) != old and store.read_points(spark, path).count() == len(held)
    store.delete_range(spark, path, FIRST, FIRST + timedelta(days=9))
    assert table(spark, path) == [] if not [r for r in held if r[-2] < FIRST] else len(table(spark, path)) < 5
    # what is written after a delete stays, and the days are made again
    run_pipeline(spark, config, date(2024, 1, 19))
    assert table(spark, path) == before
    for _ in range(3):
        store.delete_range(spark, path, FIRST, FIRST + timedelta(hours=1), entity_id="nobody")
    assert spark.read.parquet(f"{path}_deleted").count() == 4 and table(spark, path) == before


def test_too_many_deleted_ranges_are_worked_in(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "points")
    store.write_points(raw(spark, [("p", FIRST + timedelta(hours=h), 1.0) for h in range(10)]), path)
    monkeypatch.setattr(store, "MOST_DELETED", 2)
    for h in range(4):
        store.delete_range(spark, path, FIRST + timedelta(hours=h), FIRST + timedelta(hours=h + 1))
    assert store.read_points(spark, path).count() == 6 and spark.read.parquet(f"{path}_deleted").count() == 2


def test_entities_from_a_table(spark, tmp_path):
    names = str(tmp_path / "names")
    spark.createDataFrame([("p", "g"), ("q", "g"), (" ", "g"), (None, "g")], "entity_id string, grid_entity string").write.parquet(names)
    jobs = {k: {**{a: b for a, b in v.items() if a != "entities"}, "entities": {"table": names}} for k, v in CONFIG.items()}
    one, two = config_of(tmp_path / "a", jobs), config_of(tmp_path / "b")
    for c in (one, two):
        store.write_points(raw(spark, readings(2)), c["input"])
        assert run_pipeline(spark, c, date(2024, 1, 17)) == ["repair", "daily", "split"]
    assert table(spark, one["output"]) == table(spark, two["output"])
    assert pipeline.read_config(one)[0].entities == names
