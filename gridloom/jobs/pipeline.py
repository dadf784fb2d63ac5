"""The incremental run: jobs over all days that are not done yet.

A job is registered by its kind, with the keys that its settings need and the data sets that it reads and
writes; from these comes the order in which jobs run. Each runs for all its entities and open days in one
plan. The ledger beside the results tells which days are open; results, ledger and versions
of a job are changed together.
"""

from __future__ import annotations

import graphlib
import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.localtime import ZONE, day_start, next_day_start
from gridloom.operators import daily, lookup, repair, split
from gridloom.sources import ledger
from gridloom.sources.days import day_list, within
from gridloom.sources.points import exists, merged_points, read_points, read_versions, select_points, valid_entities
from gridloom.sources.scratch import stored
from gridloom.sources.swap import replace_together

log = logging.getLogger(__name__)

#: Data sets: the given points, and repaired counters.
RAW, CLEANED = "raw", "cleaned"


@dataclass(frozen=True)
class Job:
    kind: str
    version: str
    #: Names, or the path of a Parquet table with entity_id (and for split grid_entity).
    entities: tuple[str, ...] | str
    output_measurement: str
    output_entity_id: str = ""
    #: Where repaired counters are read from.
    cleaned_measurement: str = ""
    settings: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Work:
    """What a job writes: points in write order, the days (entity_id, day) that it did, and those (entity_id, day, status)
    that it rejects. refused: how many rejects there are, by status, if that was counted on the way; fingerprints: (entity_id, day, fingerprint)
    of what was read."""

    points: DataFrame
    days: DataFrame
    rejects: DataFrame
    order: tuple[str, ...] = ("value",)
    #: The runs of days, see day_list.
    runs: Sequence[tuple[date, date]] = ()
    refused: Mapping[str, int] | None = None
    fingerprints: DataFrame | None = None


@dataclass(frozen=True)
class Run:
    """What a job is given: its settings, the tables, and the days of the run."""

    spark: SparkSession
    job: Job
    raw: DataFrame
    output: str
    first: date
    as_of: date
    zone: str
    #: Days that jobs before this one have done in this run: what is made of them is made again.
    changed: DataFrame | None = None
    recheck: int | None = None

    def entities(self) -> DataFrame:
        """(entity_id, ...) of the job's settings, stored, so that Spark knows its size."""
        given = self.job.entities
        if isinstance(given, str):
            return valid_entities(self.spark.read.parquet(given))
        return stored(self.spark.createDataFrame([(n,) for n in given], "entity_id string"), "entities")

    def open_days(self, entities: DataFrame) -> DataFrame:
        """(entity_id, day) from the first day to the one before as_of that the ledger doesn't call done, and changed days."""
        last = self.as_of - timedelta(days=1)
        if last < self.first:
            return self.spark.createDataFrame([], "entity_id string, day date")
        days = F.explode(F.sequence(F.lit(self.first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("day")
        spine = entities.select("entity_id").distinct().select("entity_id", days)
        known = ledger.read_ledger(self.spark, self.output, self.job.kind).filter(F.col("version") == self.job.version)
        if self.changed is not None:
            known = known.join(F.broadcast(self.changed), "day", "left_anti")  # a row for each day
        return stored(ledger.days_to_do(spine, known), "days")

    def results(self) -> DataFrame | None:
        return read_points(self.spark, self.output) if exists(self.spark, self.output) else None


@dataclass(frozen=True)
class Kind:
    run: Callable[[Run], Work | None]
    needs: tuple[str, ...] = ()
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()


KINDS: dict[str, Kind] = {}


def register(name: str, run: Callable[[Run], Work | None], needs: Sequence[str] = (), inputs: Sequence[str] = (RAW,), outputs: Sequence[str] = ()) -> None:
    """Make a kind of job known. needs: keys of its settings beside version and entities; inputs, outputs: names of data
    sets. A job that reads and writes one amends it: it runs after those that only write it and before those that only read it."""
    KINDS[name] = Kind(run, tuple(needs), tuple(inputs), tuple(outputs))


def ordered(kinds: Mapping[str, Kind]) -> list[str]:
    """Names of kinds, each after those whose outputs it reads; else in the order of their registration."""
    before: dict[str, set[str]] = {n: set() for n in kinds}
    for a, x in kinds.items():
        for b, y in kinds.items():
            shared = set(x.outputs) & set(y.inputs)
            if a != b and any(name not in x.inputs or name not in y.outputs for name in shared):  # two that amend a data set don't wait for each other
                before[b].add(a)
    sorter = graphlib.TopologicalSorter(before)
    try:
        sorter.prepare()
    except graphlib.CycleError as error:
        raise ValueError(f"jobs need each other's outputs: {', '.join(error.args[1])}") from error
    out: list[str] = []
    ready: list[str] = []
    while sorter.is_active():
        ready += sorter.get_ready()
        ready.sort(key=list(kinds).index)
        out.append(ready.pop(0))
        sorter.done(out[-1])
    return out


def read_config(config: Mapping[str, Any]) -> list[Job]:
    """The jobs of a configuration with the keys input, output and jobs (kind -> settings), in the order in which they run.

    Every job needs a version and entities, a list or {"table": path}, and what its kind
    needs. Blank entities are left out; a job without any is skipped.
    """
    missing = [k for k in ("input", "output", "jobs") if k not in config]
    if missing:
        raise ValueError(f"the configuration lacks {', '.join(missing)}")
    if not isinstance(config["jobs"], Mapping):
        raise ValueError("jobs must be a mapping")
    unknown = set(config["jobs"]) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown jobs: {', '.join(sorted(unknown))}")
    found = []
    cleaned = config["jobs"].get("repair", {})
    for kind in ordered({k: v for k, v in KINDS.items() if k in config["jobs"]}):
        own = config["jobs"][kind]
        if not isinstance(own, Mapping):
            raise ValueError(f"{kind} must be a mapping")
        if not own.get("version"):
            raise ValueError(f"{kind} needs a version")
        given = own.get("entities", [])
        if not isinstance(given, list) and not (isinstance(given, Mapping) and isinstance(given.get("table"), str)):
            raise ValueError(f"entities of {kind} must be a list or name a table")
        for key in KINDS[kind].needs:
            if not own.get(key) or not isinstance(own[key], str):
                raise ValueError(f"{kind} needs {key}")
        entities = given["table"] if isinstance(given, Mapping) else tuple(e for e in given if isinstance(e, str) and e.strip())
        if not entities:
            log.warning("%s has no entities and is skipped", kind)
            continue
        source = own.get("cleaned_measurement") or (cleaned.get("output_measurement", "") if isinstance(cleaned, Mapping) else "")
        found.append(Job(kind, own["version"], entities, own.get("output_measurement") or "daily_sums", own.get("output_entity_id", ""), source, own))
    return found


def bounds(df: DataFrame, lo: date, hi: date, before: int = 0, after: int = 0, zone: str = ZONE) -> DataFrame:
    """Points of the local days lo to hi, and so many hours before and after; partitions of other days are not read."""
    around = lambda hours: timedelta(days=-(-hours // 24))
    hours = lambda n: F.make_dt_interval(hours=F.lit(n))
    start, stop = day_start(F.lit(lo), zone) - hours(before), next_day_start(F.lit(hi), zone) + hours(after)
    return df.filter(F.col("day").between(lo - around(before), hi + around(after)) & (F.col("time") >= start) & (F.col("time") < stop))


def _observed(rows: DataFrame, counted: Column, name: str) -> tuple[DataFrame, Mapping[str, int]]:
    """rows stored, and of those that are counted how many have each status."""
    seen = Observation()
    of = lambda s: F.count_if(counted & (F.col("status") == s)).alias(s)
    kept = stored(rows.observe(seen, *map(of, STATUSES)), name)
    return kept, {k: v for k, v in seen.get.items() if v}


#: Why a day may be rejected.
STATUSES = ("null_value", "no_first_reset", "no_anchor", "monotonicity", "negative_share", "no_data")


def _cleaned(run: Run, runs: Sequence[tuple[date, date]], entities: DataFrame) -> DataFrame:
    """Repaired counters of the days, of each entity at its own latest version. Versions come from the table beside the results."""
    job, have = run.job, run.results()
    named = read_versions(run.spark, run.output).filter(F.col("measurement") == job.cleaned_measurement).join(entities.select("entity_id").distinct(), "entity_id", "left_semi")
    top = lookup.latest_version(named, ["entity_id"])
    versions = [r["version"] for r in top.select("version").distinct().limit(VERSIONS + 1).collect()]
    if have is None or not versions:
        raise ValueError(f"{job.kind}: there are no repaired counters")
    found = select_points(have, measurement=job.cleaned_measurement).filter(within(runs, F.col("day")))
    if len(versions) <= VERSIONS:
        found = found.filter(F.col("version").isin(versions))
    return found.join(top, ["entity_id", "version"], "left_semi")


#: Versions that a filter spells out, at most.
VERSIONS = 100


def _late(run: Run, entities: DataFrame, days: DataFrame) -> DataFrame:
    """days, and the done days of the last run.recheck whose read window holds other points than when they were done."""
    since = run.as_of - timedelta(days=run.recheck)
    known = ledger.read_ledger(run.spark, run.output, run.job.kind).filter((F.col("version") == run.job.version) & (F.col("day") >= since) & (F.col("status") == ledger.DONE)).select("entity_id", "day", "fingerprint")
    points = select_points(run.raw.filter(F.col("day") >= since - timedelta(days=1)), entities=entities)
    now = repair.fingerprints(points, run.zone)
    met = known.join(now.withColumnRenamed("fingerprint", "_now"), ["entity_id", "day"], "left").filter(~F.col("fingerprint").eqNullSafe(F.coalesce("_now", F.lit(0))))
    return stored(days.unionByName(met.select("entity_id", "day")).distinct(), "days")


def repair_job(run: Run) -> Work | None:
    job, entities = run.job, run.entities()
    days = run.open_days(entities)
    if run.recheck:
        days = _late(run, entities, days)
    runs = day_list(days)
    if not runs:
        return None
    # a read window reaches into the days beside its own
    near = select_points(run.raw, entities=entities).filter(within(runs, F.col("day"), 1, 1)).drop("day")
    counts: dict[str, int] = {}
    marks: list[DataFrame] = []

    def hold(rows: DataFrame) -> DataFrame:
        kept, found = _observed(rows, repair.opens_group(), "repaired")
        counts.update(found)
        marks.append(kept.filter(repair.opens_group()).select("entity_id", "day", F.col("mark").alias("fingerprint")))
        return kept

    written, bad = repair.repair(near, days, run.zone, hold=hold, sparse=True)
    tags = {"measurement": job.output_measurement, "field": "value", "version": job.version, "scenario": "", "unit": "kWh"}
    points = written.select(*[F.lit(v).alias(k) for k, v in tags.items()], "entity_id", "time", "value", "day", "seq")
    return Work(points, days, bad, ("day", "seq"), runs, counts, marks[0])


def _members(days: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity_id, day) of all entities on all of the days."""
    return entities.select("entity_id").distinct().crossJoin(F.broadcast(days.select("day").distinct()))  # a row for each day


def daily_job(run: Run) -> Work | None:
    job, entities = run.job, run.entities()
    days = run.open_days(run.spark.createDataFrame([(job.output_entity_id,)], "entity_id string"))
    runs = day_list(days)
    if not runs:
        return None
    cleaned = _cleaned(run, runs, entities)
    cleaned = cleaned.filter(daily.within_day(F.col("time"), run.zone))
    spine = _members(days, entities)
    bad = stored(daily.rejects(spine, cleaned, run.zone), "rejects")
    whole = days.join(F.broadcast(bad.select("day").distinct()), "day", "left_anti")
    sums = daily.daily_sums(cleaned, job.output_entity_id, run.zone).join(F.broadcast(whole.select("day")), "day", "left_semi")
    return Work(daily.daily_points(sums, job.output_measurement, job.version, run.zone), spine.unionByName(days), _with_whole(bad, days), runs=runs)


def _with_whole(bad: DataFrame, days: DataFrame) -> DataFrame:
    """Rejects of entities, and the days of the output entity that they hold up."""
    held = days.join(F.broadcast(bad.select("day").distinct()), "day", "left_semi")
    return bad.unionByName(held.select("entity_id", "day", F.lit("held_up").alias("status")))


def split_job(run: Run) -> Work | None:
    """The last entity is the grid meter, the others are the pumps; in a table, grid_entity tells each pump's meter."""
    job, entities = run.job, run.entities()
    days = run.open_days(run.spark.createDataFrame([(job.output_entity_id,)], "entity_id string"))
    runs = day_list(days)
    if not runs:
        return None
    if isinstance(job.entities, str):
        roles = entities.select(F.col("entity_id").alias("pump_entity"), "grid_entity", F.lit(job.output_entity_id).alias("output_entity"))
    else:
        *names, grid = job.entities
        roles = stored(run.spark.createDataFrame([(p, grid, job.output_entity_id) for p in names], "pump_entity string, grid_entity string, output_entity string"), "roles")
    pumps, meters = roles.select(F.col("pump_entity").alias("entity_id")), roles.select(F.col("grid_entity").alias("entity_id"))
    cleaned = _cleaned(run, runs, pumps)
    power = select_points(run.raw, entities=meters).filter(within(runs, F.col("day")))
    found = split.split_intervals(cleaned, power, roles, run.zone)
    found, counts = _observed(found.join(F.broadcast(days.select("day").distinct()), "day", "left_semi"), F.lit(True), "shares")
    bad = found.filter("status is not null").select("entity_id", "day", "status").distinct()
    held = F.broadcast(bad.select("day").distinct())
    good = found.join(held, "day", "left_anti")
    every = _members(days, pumps)
    spine = every.join(held, "day", "left_anti").withColumn("output_entity", F.lit(job.output_entity_id))
    points = split.split_points(good, split.split_days(good, spine), job.output_measurement, job.version, run.zone)
    return Work(points, every.unionByName(days), _with_whole(bad, days), runs=runs, refused=counts)


register("repair", repair_job, ["output_measurement"], [RAW], [CLEANED])
register("daily", daily_job, ["output_entity_id"], [CLEANED], ["daily sums"])
register("split", split_job, ["output_measurement", "output_entity_id"], [RAW, CLEANED], ["shares"])


def _first_day(raw: DataFrame) -> date | None:
    """The UTC date of the earliest point, read from the first partitions only."""
    low = raw.agg(F.min("day")).first()[0]
    # the UTC date may be the one before the local day, or the one after it
    return None if low is None else lookup.first_day(raw.filter(F.col("day") <= low + timedelta(days=2))).first().first_day


def _entries(work: Work, job: Job, run: int) -> DataFrame:
    """Rows of the ledger for the days that a job did."""
    rejects = work.rejects.groupBy("entity_id", "day").agg(F.min("status").alias("status"))
    rows = work.days.select("entity_id", "day").distinct().join(rejects, ["entity_id", "day"], "left")
    if work.fingerprints is not None:
        rows = rows.join(work.fingerprints, ["entity_id", "day"], "left")
    else:
        rows = rows.withColumn("fingerprint", F.lit(None).cast("long"))
    tags = [F.lit(v).alias(k) for k, v in {"run": run, "measurement": job.output_measurement, "version": job.version}.items()]
    return rows.select("entity_id", F.coalesce("status", F.lit(ledger.DONE)).alias("status"), *tags, F.coalesce("fingerprint", F.lit(0).cast("long")).alias("fingerprint"), F.lit(job.kind).alias("job"), "day")


def read_rejects(spark: SparkSession, output: str) -> DataFrame:
    """(entity_id, status, job, day) of the days that are rejected as things stand."""
    rows = ledger.read_ledger(spark, output)
    return rows.filter(~F.col("status").isin(ledger.DONE, ledger.OPEN, "held_up")).select("entity_id", "status", "job", "day")


def run_pipeline(spark: SparkSession, config: Mapping[str, Any], as_of: date, on_error: str = "raise", zone: str = ZONE, recheck: int | None = None) -> list[str]:
    """Run the configured jobs for the days before as_of that are not done; returns the kinds that wrote something.

    on_error "raise": a day that can't be done stops the run before its job writes anything.
    "quarantine": such days are entered in the ledger with the reason, the others are written; they are
    open, so the next run tries them again. Days that a job has done are done by those after it, too. recheck:
    of the last so many days, those whose points have changed since they were repaired are done again.
    """
    if on_error not in ("raise", "quarantine"):
        raise ValueError("on_error is raise or quarantine")
    jobs = read_config(config)
    raw = read_points(spark, config["input"])
    first = _first_day(raw)
    if first is None:
        log.warning("there are no points")
        return []
    output, number = config["output"].rstrip("/"), time.time_ns() // 1000
    ran: list[str] = []
    changed: DataFrame | None = None
    for job in jobs:
        work = KINDS[job.kind].run(Run(spark, job, raw, output, first, as_of, zone, changed, recheck))
        if work is None:
            continue
        if on_error == "raise" and (work.refused is None or work.refused):
            example = work.rejects.orderBy(F.col("status") == "held_up", "day", "entity_id").first()
            if example is not None:
                raise ValueError(f"{job.kind}: {example.entity_id} on {example.day}: {example.status}; {dict(work.refused or {})}")
        order: list[Column] = [F.col(c) for c in work.order]
        entries = stored(_entries(work, job, number), "entries")
        replace_together(spark, [*merged_points(work.points, output, order, zone), ledger.entered(spark, output, job.kind, entries, work.runs or day_list(entries))])
        days = entries.select("day").distinct()
        changed = days if changed is None else changed.union(days).distinct()
        ran.append(job.kind)
    return ran
