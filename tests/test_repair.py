"""Counter repair: hand-made cases, and random days against a plain restatement of the rules."""

import random
from datetime import date, datetime, timedelta
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from gridloom.operators import repair as steps
from gridloom.operators.repair import repair, stored_points

DAY = date(2024, 1, 15)
DS, DE = datetime(2024, 1, 14, 23), datetime(2024, 1, 15, 22, 59, 59)


def at(text):
    d, t = text.split()
    h, m, *s = t.split(":")
    whole, _, part = (s[0] if s else "0").partition(".")
    return datetime(2024, 1, int(d), int(h), int(m), int(whole), int(part.ljust(6, "0")) if part else 0)


def points(text):
    return [(at(" ".join(x.split()[:2])), float(x.split()[2])) for x in text.split("·")] if text else []


ZEROS = [(DS + timedelta(hours=h), 0.0) for h in range(24)] + [(DE, 0.0)]
CASES = {
    "R1": ("", ZEROS),
    "R2": ("14 22:50 9 · 14 23:01 0 · 15 11:00 3 · 15 22:50 6 · 15 23:02 0", "14 23:00 0 · 14 23:01 0 · 15 11:00 3 · 15 22:50 6 · 15 22:59:59 6"),
    "R3": ("14 21:00 9 · 14 22:30 0 · 14 22:50 0.1 · 14 23:20 0.2 · 15 20:00 5 · 15 23:01 0", "14 23:00 0 · 14 23:20 0.2 · 15 20:00 5 · 15 22:59:59 5"),
    "R4": ("14 21:00 9 · 14 22:30 0 · 14 22:40 0.1 · 14 22:50 0.2 · 14 23:30 0.3 · 15 20:00 5 · 15 23:01 0", "14 23:00 0 · 14 23:20 0.1 · 14 23:30 0.3 · 15 20:00 5 · 15 22:59:59 5"),
    "R5": ("14 21:00 9 · 14 23:00 0 · 15 22:00 5 · 15 23:10 5.1 · 15 23:20 5.2 · 15 23:30 5.3 · 15 23:40 0", "14 23:00 0 · 15 22:00 5 · 15 22:19:59.666667 5.1 · 15 22:39:59.333333 5.2 · 15 22:59:59 5.3"),
    "R6": ("14 21:00 9 · 14 22:30 0 · 14 22:50 0.1 · 14 23:20 0.2 · 15 22:00 5 · 15 23:10 5.1 · 15 23:20 5.2 · 15 23:40 0", "14 23:00 0 · 14 23:20 0.2 · 15 22:00 5 · 15 22:29:59.5 5.1 · 15 22:59:59 5.2"),
    "R7": ("15 05:00 1 · 15 12:00 2", "14 23:00 0 · 15 05:00 1 · 15 12:00 2 · 15 22:59:59 2"),
    "R8": ("15 05:00 0", ZEROS),
    "R8b": ("15 05:00 0 · 15 12:00 2", "14 23:00 0 · 15 05:00 0 · 15 12:00 2 · 15 22:59:59 2"),
    "R9": ("14 20:00 0 · 14 21:00 0.2 · 15 12:00 2", "14 21:00 0.2 · 14 23:00 0 · 15 12:00 2 · 15 22:59:59 2"),
    "R10": ("14 20:00 1 · 15 12:00 2", "no_first_reset"),
    "R11": ("14 21:00 9 · 14 23:00 0 · 15 05:00 2 · 15 08:00 1.9 · 15 15:00 3 · 15 23:01 0", "14 23:00 0 · 15 05:00 2 · 15 08:00 2 · 15 15:00 3 · 15 22:59:59 3"),
    "R11b": ("14 21:00 9 · 14 23:00 0 · 15 05:00 2 · 15 08:00 1.75 · 15 15:00 3 · 15 23:01 0", "14 23:00 0 · 15 05:00 2 · 15 08:00 2 · 15 15:00 3 · 15 22:59:59 3"),
    "R12": ("14 21:00 9 · 14 23:00 0 · 15 05:00 2 · 15 08:00 1.5 · 15 15:00 3 · 15 23:01 0", "monotonicity"),
    "R13": ("14 21:00 9 · 14 23:00 0 · 15 14:00 4 · 15 15:00 3.99 · 15 20:00 8 · 15 23:01 0", "14 23:00 0 · 15 14:00 4 · 15 22:59:59 4"),
    "R14": ("14 20:00 9 · 14 21:00 8.99 · 14 23:01 0 · 15 20:00 5 · 15 23:01 0", "monotonicity"),
    "R15": ("14 20:00 9 · 14 21:00 0 · 14 22:00 0.1", "no_anchor"),
}


def run(spark, series, days):
    rows = [(name, t, v) for name, own in series.items() for t, v in own]
    frame = spark.createDataFrame(rows, "entity_id string, time timestamp, value double")
    spine = spark.createDataFrame([(name, d) for name in series for d in days], "entity_id string, day date")
    written, rejects = repair(frame, spine)
    kept = {}
    for r in stored_points(written).orderBy("time").withColumn("time", F.col("time").cast("timestamp_ntz")).collect():
        kept.setdefault(r.entity_id, []).append((r.time, r.value))
    return kept, {(r.entity_id, r.day): r.status for r in rejects.collect()}


def test_cases(spark):
    kept, bad = run(spark, {name: points(given) for name, (given, _) in CASES.items()}, [DAY])
    for name, (_, want) in CASES.items():
        if isinstance(want, str) and "_" in want or want == "monotonicity":
            assert bad[name, DAY] == want and name not in kept, name
        else:
            want = points(want) if isinstance(want, str) else want
            got = kept[name]
            assert [t for t, _ in got] == [t for t, _ in want], name
            assert [v for _, v in got] == pytest.approx([v for _, v in want]), name


@pytest.mark.parametrize(("day", "rows"), [(date(2024, 3, 31), 24), (date(2024, 10, 27), 26), (date(2024, 1, 15), 25)])
def test_empty_day_has_a_row_an_hour(spark, day, rows):
    kept, bad = run(spark, {"a": []}, [day])
    assert len(kept["a"]) == rows and not bad


def restated(own):
    """What one day writes, as a list of (time, value), or a status; by definition, not step by step."""
    times, values, n = [t for t, _ in own], [v for _, v in own], len(own)
    if not n:
        return ZEROS
    rounded = [round(v, 3) for v in values]
    near_start = [abs(t - DS) <= abs(DE - t) for t in times]
    # the first fall below what came before, and falls below what came since it
    fall = next((j for j in range(n) if rounded[j] < max([0.0, *rounded[:j]])), None)
    opening = fall if fall is not None and near_start[fall] else None
    if opening is None:
        closed_by = fall
    else:
        closed_by = next((j for j in range(fall + 1, n) if not near_start[j] and rounded[j] < max(rounded[fall:j])), None)
    closing = (n if closed_by is None else closed_by) - 1
    if opening is None:
        zero, before = values[0] == 0, times[0] < DS
        if not before and values[0] > 0:
            times, values, closing = [DS, *times], [0.0, *values], closing + 1
        elif zero and before:
            times[0] = DS
        elif not zero or times[0] > DE:
            return "no_first_reset"
        opening = 0
    if n == len(times) == 1 and values[0] == 0 and DS <= times[0] <= DE:
        return ZEROS
    span, moved = range(opening, closing + 1), {}
    if times[opening] < DS:
        m = sum(times[i] < DS for i in span) - 1
        if m and opening + m + 1 >= len(times):
            return "no_anchor"
        gap = times[opening + m + 1] - DS if m else timedelta()
        moved = {opening: DS} | {opening + i: DS + gap * (i + 1) / (m + 1) for i in range(1, m + 1)}
    if times[closing] > DE:
        placed = [moved.get(i, t) for i, t in enumerate(times)]
        m = sum(placed[i] > DE for i in span)
        base = placed[closing - m]
        moved |= {closing - m + i: base + (DE - base) * i / m for i in range(1, m + 1)}
    tops = list(accumulate((values[i] for i in span), max, initial=0.0))
    if any(top - values[i] > 0.25 for top, i in zip(tops, span, strict=False)):
        return "monotonicity"
    rows = [(moved.get(i, times[i]), top) for i, top in zip(span, tops[1:], strict=True)]
    return [(DS, 0.0)] * (rows[0][0] != DS) + rows + [(DE, rows[-1][1])] * (rows[-1][0] != DE)


def test_random_days(spark):
    rng, series = random.Random(5), {}
    lo = datetime(2024, 1, 14, 19)
    for k in range(400):
        n = rng.choice([1, 2, 3, 5, 9, 14])
        times = sorted({lo + timedelta(minutes=10 * rng.randrange(32 * 6)) for _ in range(n)})
        v, own = rng.choice([0.0, 0.0, 5.0, -0.1]), []
        for t in times:
            own.append((t, round(v, 3)))
            v = rng.choice([v + rng.random(), v + rng.random(), v, 0.0, max(0.0, v - rng.choice([0.1, 0.25, 0.001, 2.0]))])
        series[f"s{k}"] = own
    kept, bad = run(spark, series, [DAY])
    for name, own in series.items():
        want = restated(own)
        if isinstance(want, str):
            assert bad.get((name, DAY)) == want, (name, own)
            continue
        stored = dict((t, v) for t, v in want)
        got = kept[name]
        assert (name, DAY) not in bad, (name, own, bad.get((name, DAY)))
        assert len(got) == len(stored), (name, own)
        for (t, v), (wt, wv) in zip(got, sorted(stored.items()), strict=True):
            assert abs((t - wt).total_seconds()) < 2e-6 and v == pytest.approx(wv), (name, own)


def test_windows_tell_fingerprints_in_few_steps(spark):
    """Fingerprints of read windows come with the windows, also where the spine holds few days; windows in one order share a step."""
    when = lambda d, h: datetime(2024, 1, d, h)
    rows = [("a", when(2, h), float(h)) for h in range(0, 24, 3)] + [("a", when(3, 2), None), ("b", when(2, 21), 1.0), ("b", when(2, 21), 1.0), ("c", when(9, 12), 5.0)]
    points = spark.createDataFrame(rows, "entity_id string, time timestamp, value double")
    spine = spark.createDataFrame([(e, date(2024, 1, d)) for e in "ab" for d in (1, 2, 3, 7)], "entity_id string, day date")
    want = {(r.entity_id, r.day): r.fingerprint for r in steps.fingerprints(points).collect()}
    for sparse in (False, True):
        found = steps.windows(points, spine, sparse=sparse).select("entity_id", "day", "n", "mark").distinct().collect()
        assert {(r.entity_id, r.day): r.mark for r in found} == {k: want.get(k) for k in [(r.entity_id, r.day) for r in spine.collect()]}
        assert sum(r.n > 0 for r in found) == 5
    plan = repair(points, spine)[1]._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" +-:").startswith("Window ") for line in plan.splitlines()) <= 12
