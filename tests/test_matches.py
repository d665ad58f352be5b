"""Matches in time, calendar frames, sessions, interval joins and sketches against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, calendar, intervals, sketches

DAY0 = dt.date(1969, 10, 20)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def keyed(rng, rows, span, hot=0.5):
    """(key, day number, serial): a hot key, missing keys and days, several rows of a day."""
    out = []
    for i in range(rows):
        key = "HOT" if rng.random() < hot else rng.choice(["A", "B", "C", None])
        out.append((key, None if rng.random() < 0.03 else rng.randrange(span), i))
    return out


@pytest.mark.parametrize("direction", [asof.BACKWARD, asof.FORWARD])
@pytest.mark.parametrize("chunk_days", [1, 9, 64, 10_000])
def test_as_of_equals_a_plain_search(rows, direction, chunk_days):
    rng = random.Random(chunk_days)
    left, right = keyed(rng, 300, 500), keyed(rng, 60, 500, 0.3)
    l_rows = rows([(k, day(d), i) for k, d, i in left], "ticker string, at date, i int")
    r_rows = rows([(k, day(d), i) for k, d, i in right], "name string, day date, price int")
    found = asof.as_of(
        l_rows, r_rows, key="ticker", time="at", right_key="name", right_time="day", carry=["price"],
        direction=direction, chunk_days=chunk_days,
    )
    assert found.columns == ["ticker", "at", "i", "day", "price"]
    want = set()
    for k, d, i in left:
        fit = [(x, p) for n, x, p in right if n is not None and n == k and None not in (x, d) and (x <= d if direction == asof.BACKWARD else x >= d)]
        best = (max if direction == asof.BACKWARD else min)(fit, default=(None, None))
        want.add((k, day(d), i, day(best[0]), best[1]))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(left) and set(got) == want


def test_as_of_takes_timestamps_and_empty_sides(rows):
    at = dt.datetime(2024, 1, 1, 10)
    left = rows([("A", at), ("A", at + dt.timedelta(hours=1))], "k string, t timestamp")
    right = rows([("A", at + dt.timedelta(minutes=30), 7)], "k2 string, t2 timestamp, v int")
    names = dict(key="k", time="t", right_key="k2", right_time="t2", carry=["v"])
    assert [r.v for r in asof.as_of(left, right, **names).orderBy("t").collect()] == [None, 7]
    assert [r.v for r in asof.as_of(left, right, **names, direction=asof.FORWARD).orderBy("t").collect()] == [7, None]
    assert [r.v for r in asof.as_of(left, right.limit(0), **names).collect()] == [None, None]
    assert asof.as_of(left.limit(0), right, **names).count() == 0
    with pytest.raises(ValueError):
        asof.as_of(left, right, **names, direction="nearest")


@pytest.mark.parametrize("days,chunk_days", [(1, 1), (5, 5), (5, 64), (30, 31)])
def test_recent_days_equal_plain_sums(rows, days, chunk_days):
    rng = random.Random(days)
    data = keyed(rng, 400, 300)
    df = rows([(k, day(d), i) for k, d, i in data], "k string, d date, v int")
    columns = {"n": "count(*) OVER recent", "total": "sum(v) OVER recent"}
    found = calendar.recent_days(df, key="k", date="d", days=days, columns=columns, carry=["v"], chunk_days=chunk_days)
    want = set()
    for k, d, v in data:
        near = [w for n, x, w in data if n == k and (x is None if d is None else x is not None and d - days < x <= d)]
        want.add((k, day(d), v, len(near), sum(near)))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(data) and set(got) == want
    with pytest.raises(ValueError):
        calendar.recent_days(df, key="k", date="d", days=chunk_days + 1, columns=columns, carry=["v"], chunk_days=chunk_days)


def test_recent_days_have_no_window_by_key_alone(rows, capsys):
    df = rows([("A", day(1), 1)], "k string, d date, v int")
    found = calendar.recent_days(df, key="k", date="d", days=5, columns={"n": "count(*) OVER recent"}, carry=["v"])
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "hashpartitioning(k#" in plan.replace(" ", "") and "_chunk" in plan
    for line in plan.splitlines():
        if "hashpartitioning" in line:
            assert "_chunk" in line


def test_sessions_end_after_the_gap(rows):
    numbers = {"A": [0, 3, 6, 10, 11, 40], "B": [5], None: [1, 2]}
    data = [(k, day(n), 2) for k, of in numbers.items() for n in of] + [("A", None, 9)]
    df = rows(data, "k string, d date, v int")
    found = calendar.activity_sessions(df, key="k", date="d", gap_days=3, totals={"days": F.count("*"), "v": F.sum("v")})
    assert {tuple(r) for r in found.collect()} == {
        ("A", day(0), day(6), 3, 6), ("A", day(10), day(11), 2, 4), ("A", day(40), day(40), 1, 2),
        ("B", day(5), day(5), 1, 2), (None, day(1), day(2), 2, 4),
    }
    assert calendar.activity_sessions(df.limit(0), key="k", date="d", gap_days=3, totals={"n": F.count("*")}).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bucket_days", [1, 8, 5000])
def test_interval_join_equals_all_pairs(rows, how, bucket_days):
    rng = random.Random(bucket_days)
    points = keyed(rng, 200, 300)
    spans = [(rng.choice(["HOT", "A", "B", None]), rng.choice([None, *range(300)]), rng.randrange(-5, 40), i) for i in range(60)]
    p = rows([(k, day(d), i) for k, d, i in points], "k string, d date, i int")
    s = rows([(k, day(a), day(None if a is None else a + n), i) for k, a, n, i in spans], "name string, low date, high date, j int")
    found = intervals.interval_join(p, s, key="k", interval_key="name", date="d", bucket_days=bucket_days, how=how)
    want = []
    for k, d, i in points:
        met = [(a, a + n, j) for name, a, n, j in spans if None not in (name, a, d, k) and name == k and a <= d <= a + n]
        if how == "left" and not met:
            met = [(None, None, None)]
        want += [(k, day(d), i, day(a), day(b), j) for a, b, j in met]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_interval_join_is_an_equality_on_buckets(rows, capsys):
    p = rows([("A", day(1), 1)], "k string, d date, i int")
    s = rows([("A", day(0), day(3))], "name string, low date, high date")
    intervals.interval_join(p, s, key="k", interval_key="name", date="d").explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_bucket" in plan


def test_distinct_over_frames(spark, rows):
    rng = random.Random(6)
    data = [(rng.choice(["A", "B", None]), day(rng.choice([None, *range(40)])), rng.choice([None, *map(str, range(300))])) for _ in range(3000)]
    df = rows(data, "k string, d date, name string")
    names = {"key": "k", "date": "d"}
    want = {}
    for key in ("A", "B", None):
        days = sorted({d for k, d, _ in data if k == key}, key=lambda d: (d is None, d or DAY0))
        for i, d in enumerate(days):
            frame = days[max(i - 4, 0) : i + 1]
            want[key, d] = len({n for k, x, n in data if k == key and x in frame and n is not None})
    exact = {(r.k, r.d): r.distinct_values for r in sketches.exact_over_frames(df, **names, value="name").collect()}
    assert exact == want
    merged = sketches.merged_over_frames(sketches.daily_sketches(df, **names, value="name"), **names)
    got = {(r.k, r.d): r.estimate for r in merged.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - n) <= max(1, sketches.BOUND * n) for k, n in want.items())


def test_the_bound_holds_for_large_counts(spark):
    wide = spark.range(200_000).selectExpr("'A' AS k", "date_add(date'2024-01-01', cast(id % 10 AS INT)) AS d", "cast(id AS STRING) AS name")
    names = {"key": "k", "date": "d"}
    merged = sketches.merged_over_frames(sketches.daily_sketches(wide, **names, value="name"), **names).orderBy("d").collect()
    for i, r in enumerate(merged):
        assert abs(r.estimate - 20_000 * min(i + 1, 5)) <= sketches.BOUND * 20_000 * min(i + 1, 5)
