"""As-of joins, span joins, sessions and trailing counts against plain Python."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from addrspark.operators import asof, intervals, timewindows
from addrspark.workload.queries import QUERIES
from test_plans import plan

START = datetime(2024, 1, 1)


def as_of(left, right):
    out = []
    for row in left:
        key, at = row[0], row[1]
        found = [r for r in right if r[0] == key and None not in (key, at, r[1]) and r[1] <= at]
        best = max(found, key=lambda r: (r[1], r[2])) if found else (None, None, None)
        out.append((*row, best[1], best[2]))
    return Counter(out)


@pytest.mark.parametrize("bucket,heavy", [(3, 5), (10, 1000), (1000, 20)])
def test_as_of_join(spark, bucket, heavy):
    rng = random.Random(bucket)
    key = lambda: rng.choice([1] * 6 + [2, 3, 4, None])  # noqa: E731  one key on more than half of the rows
    time = lambda: rng.choice([None, *range(-40, 40)])
    left = [(key(), time(), i) for i in range(300)] + [(1, 7, -1)] * 40
    right = [(key(), time(), f"v{i:03}") for i in range(60)] + [(1, 3, "same"), (1, 3, "same")]
    got = asof.as_of_join(
        spark.createDataFrame(left, "k int, at bigint, id int"), spark.createDataFrame(right, "k int, since bigint, v string"),
        ["k"], "at", "since", bucket, heavy,
    )
    assert Counter(map(tuple, got.collect())) == as_of(left, right)


def test_as_of_join_of_times_and_empty_tables(spark):
    left = spark.createDataFrame([("a", START + timedelta(days=40)), ("a", START), ("b", START)], "k string, at timestamp")
    right = spark.createDataFrame([("a", START.date(), 1), ("a", (START + timedelta(days=39)).date(), 2)], "k string, since date, v int")
    got = {(r.k, r.at): r.v for r in asof.as_of_join(left, right, ["k"], "at", "since").collect()}
    assert got == {("a", START + timedelta(days=40)): 2, ("a", START): 1, ("b", START): None}
    assert asof.as_of_join(left.limit(0), right, ["k"], "at", "since").count() == 0
    assert [r.v for r in asof.as_of_join(left, right.limit(0), ["k"], "at", "since").collect()] == [None] * 3
    with pytest.raises(ValueError, match="both sides"):
        asof.as_of_join(left, right.withColumnRenamed("v", "at"), ["k"], "at", "since")
    text = plan(asof.as_of_join(left, right, ["k"], "at", "since"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_join_spans(spark):
    rng = random.Random(2)
    points = [(i, rng.choice([0, 0, 0, 1, None]), rng.choice([None, *range(-3000, 3000)])) for i in range(400)]
    points += [(1000 + i, 0, 77) for i in range(50)]  # many in one place
    spans = []
    for i in range(200):
        low = rng.randrange(-3000, 3000)
        spans.append((i, rng.choice([0, 0, 1, None]), low, low + rng.choice([0, 1, 3, 4, 5, 63, 64, 65, 900, 5000, -2])))
    spans += [(500, 0, None, 5), (501, 0, 5, None), (502, 1, -(10**15), 10**15), (503, 0, 77, 77), (503, 0, 77, 77)]
    met = intervals.join_spans(
        spark.createDataFrame(points, "p int, k int, at bigint"), spark.createDataFrame(spans, "s int, k int, low bigint, high bigint"),
        "at", "low", "high", ["k"],
    )
    want = Counter(
        (p, k, at, s, low, high)
        for p, k, at in points for s, key, low, high in spans
        if k is not None and k == key and None not in (at, low, high) and low <= at <= high
    )
    assert Counter(map(tuple, met.select("p", "k", "at", "s", "low", "high").collect())) == want


def test_long_spans_do_not_multiply(spark):
    lengths = [0, 1, 2, 3, 4, 5, 15, 16, 17, 10**6, 10**12, 2**61]
    spans = spark.createDataFrame([(i, 12_345, 12_345 + n) for i, n in enumerate(lengths)], "s int, low bigint, high bigint")
    for r in intervals.span_levels(spans, "low", "high").collect():
        width = 1 << (r.span_level * intervals.LEVEL_BITS)
        assert width >= r.high - r.low + 1 and (width >> intervals.LEVEL_BITS) < r.high - r.low + 1 or width == 1
        assert r.high // width - r.low // width <= 1
    none = intervals.join_spans(spans.select("s"). withColumnRenamed("s", "at"), spans.limit(0), "at", "low", "high")
    assert none.count() == 0


LEAST, GREATEST = -(2**63), 2**63 - 1


def test_totals_of_spans(spark):
    rng = random.Random(5)
    places = [None, LEAST, GREATEST, -1, 0, 77, *range(-3000, 3000), *range(10**15, 10**15 + 40)]
    points = [(rng.choice([i, i, None]), rng.choice([0, 0, 0, 1, None]), rng.choice(places)) for i in range(600)]
    points += [(2000 + i, 0, 77) for i in range(50)] + [(3000 + i, 1, p) for i, p in enumerate(places[:6])]
    spans = []
    for i in range(150):
        low = rng.randrange(-3000, 3000)
        spans.append((i, rng.choice([0, 0, 1, None]), low, low + rng.choice([0, 1, 3, 4, 15, 16, 17, 255, 256, 900, 5000, -2])))
    spans += [(500, 0, None, 5), (501, 0, 5, None), (502, 1, LEAST, GREATEST), (503, 0, 77, 77), (503, 0, 77, 77), (504, 0, -1, 0)]
    spans += [(505, 0, 3, GREATEST), (506, 1, LEAST, LEAST), (507, 1, GREATEST, GREATEST), (508, 0, 10**15 + 1, 10**15 + 33)]
    spans += [(None, 0, -50, 50), (None, 1, -70, 10), (509, 0, LEAST, -1)]
    left = spark.createDataFrame(points, "p int, k int, at bigint")
    right = spark.createDataFrame(spans, "s int, k int, low bigint, high bigint")
    totals = {"n": ("count", "*"), "numbered": ("count", "p"), "least": ("min", "p"), "greatest": ("max", "p"), "whole": ("sum", "p")}
    merged = [F.sum("n"), F.sum("numbered"), F.min("least"), F.max("greatest"), F.sum("whole")]

    def want(keys):
        found = {}
        for p, k, at in points:
            for s, key, low, high in spans:
                if None not in (at, low, high) and low <= at <= high and (not keys or (k is not None and k == key)):
                    found.setdefault(s, []).append(p)
        known = {s: [p for p in ps if p is not None] for s, ps in found.items()}
        return {s: (len(ps), len(q := known[s]), min(q, default=None), max(q, default=None), sum(q) if q else None) for s, ps in found.items()}

    for most, keys in [(1, ["k"]), (20, []), (128, ["k"])]:
        met = intervals.join_spans(left if keys else left.drop("k"), right, "at", "low", "high", keys, totals, most)
        assert met.columns == ["s", "k", "low", "high", *totals]
        assert {r[0]: tuple(r)[1:] for r in met.groupBy("s").agg(*merged).collect()} == want(keys)
    for some, others in [(left.limit(0), right), (left, right.limit(0)), (left, right.filter("low = high"))]:
        met = intervals.join_spans(some, others, "at", "low", "high", ["k"], totals).groupBy("s").agg(*merged).collect()
        assert {r[0] for r in met} == (set() if 0 in (some.count(), others.count()) else {503, 506, 507} | {
            s for s, k, low, high in spans if low == high and low is not None and any((b, at) == (k, low) and k is not None for _, b, at in points)
        })
    with pytest.raises(ValueError, match="both spans and totals"):
        intervals.join_spans(left, right, "at", "low", "high", ["k"], {"s": ("count", "*")})
    with pytest.raises(ValueError, match="median"):
        intervals.join_spans(left, right, "at", "low", "high", ["k"], {"n": ("median", "p")})


def test_totals_need_few_rows_a_span(spark):
    # A burst within one second besides one point in a minute; every span holds about half of the points.
    places = [60_000_000 * i for i in range(1_000)] + [500 * 60_000_000 + 97 * i for i in range(9_000)]
    points = spark.createDataFrame([(p,) for p in places], "at bigint")
    spans = spark.createDataFrame([(i, places[i], 500 * 60_000_000 + 900 * i) for i in range(300)], "s int, low bigint, high bigint")
    met = intervals.join_spans(points, spans, "at", "low", "high", totals={"n": ("count", "*")})
    rows = met.groupBy("s").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n")).collect()
    assert {r.s: r.n for r in rows} == {i: sum(places[i] <= p <= 500 * 60_000_000 + 900 * i for p in places) for i in range(300)}
    assert max(r.parts for r in rows) <= 2 * intervals.MOST_PLACES + 30 * 9
    text = plan(met)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_events_in_spans_makes_no_pairs(spark, tmp_path, monkeypatch):
    events = spark.range(8_000).select(
        F.col("id").alias("event_id"), F.lit("view").alias("event_type"), (F.lit(START) + F.make_dt_interval(secs=F.col("id"))).alias("ts")
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    made = []
    join = intervals.join_spans
    monkeypatch.setattr(intervals, "join_spans", lambda *a, **b: made.append(join(*a, **b)) or made[-1])
    got = {r.span_id: (r.events, r.first_event, r.last_event) for r in QUERIES["events_in_spans"](spark, str(tmp_path)).collect()}
    want = {}
    for i in range(0, 8_000, 20):
        last = min(7_999, i + 60 * (30_000 if i % 400 == 0 else i % 500 * 3))
        want[i] = (last - i + 1, i, last)
    assert got == want
    assert sum(n for n, _, _ in want.values()) > 1_500_000 and made[0].count() < 100_000


def user_sessions(rows, gap):
    out, by_key = [], {}
    for k, at in rows:
        if at is not None:
            by_key.setdefault(k, []).append(at)
    for k, times in by_key.items():
        times.sort()
        begin, last, n = times[0], times[0], 0
        for t in times:
            if t - last > gap:
                out.append((k, begin, last, n))
                begin, n = t, 0
            last, n = t, n + 1
        out.append((k, begin, last, n))
    return Counter(out)


@pytest.mark.parametrize("chunk", [30, 3600, 86_400])
def test_sessions(spark, chunk):
    rng = random.Random(chunk)
    rows = [(rng.choice([1, 1, 1, 2, None]), START + timedelta(seconds=rng.randrange(20_000))) for _ in range(500)]
    rows += [(1, START)] * 30 + [(2, None), (None, None)]
    rows += [(3, START + timedelta(seconds=60 * i)) for i in range(200)]  # one session over many chunks
    table = spark.createDataFrame(rows, "k int, at timestamp")
    got = Counter(map(tuple, timewindows.sessions(table, ["k"], "at", 60, chunk).collect()))
    assert got == user_sessions(rows, timedelta(seconds=60))
    assert timewindows.sessions(table.limit(0), ["k"], "at", 60).count() == 0


def test_trailing_counts(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 1, 2, None]), rng.choice([None, START + timedelta(seconds=rng.randrange(3000))])) for i in range(300)]
    rows += [(900 + i, 1, START + timedelta(seconds=600)) for i in range(40)] + [(5, 1, START)] * 2
    table = spark.createDataFrame(rows, "id int, k int, at timestamp")
    got = Counter(map(tuple, timewindows.trailing_counts(table, ["k"], "at", 600).collect()))
    hour = timedelta(seconds=600)
    want = Counter(
        (i, k, at, None if at is None else sum(1 for _, q, t in rows if q == k and t is not None and at - hour <= t <= at))
        for i, k, at in rows
    )
    assert got == want
    assert timewindows.trailing_counts(table.limit(0), ["k"], "at", 600).count() == 0
