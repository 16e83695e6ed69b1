import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexgrain.operators.intervals import periods, periods_and_gaps

SCHEMA = "k string, s date, e date, lo string, kind int"
D = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)


def plain(rows):
    """Day by day."""
    out = []
    for k in sorted({r[0] for r in rows}, key=str):
        days = set()
        open_from = None
        for _, s, e in [r for r in rows if r[0] == k]:
            if s is None or (e is not None and e <= s):
                continue
            if e is None:
                open_from = s if open_from is None else min(open_from, s)
            else:
                days |= {s + dt.timedelta(days=i) for i in range((e - s).days)}
        end = open_from
        if end is not None:
            days = {d for d in days if d < end}
        run = []
        for d in sorted(days):
            if run and d == run[-1][1]:
                run[-1][1] = d + dt.timedelta(days=1)
            else:
                run.append([d, d + dt.timedelta(days=1)])
        if end is not None:
            if run and run[-1][1] == end:
                run[-1][1] = None
            else:
                run.append([end, None])
        out += [(k, a, b) for a, b in run]
    return sorted(out, key=str)


def of(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted([(r["k"], r["lo"], r["hi"]) for r in periods(df, ["k"], "s", "e").collect()], key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 40)), st.one_of(st.none(), st.integers(0, 60))), max_size=14))
def test_against_days(spark, rows):
    rows = [(k, None if s is None else D(s), None if e is None else D(e)) for k, s, e in rows]
    assert of(spark, rows) == plain(rows)


def test_nested_touching_repeated_and_far(spark):
    rows = [("a", D(0), D(10)), ("a", D(2), D(5)), ("a", D(10), D(12)), ("a", D(0), D(10)), ("a", D(4000), D(4001)), ("a", D(5), D(5)), ("a", None, D(3))]
    assert of(spark, rows) == [("a", D(0), D(12)), ("a", D(4000), D(4001))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = {(r["kind"], r["lo"], r["hi"]) for r in periods_and_gaps(df.drop("kind", "lo"), ["k"], "s", "e").collect()}
    assert got == {("period", D(0), D(12)), ("gap", D(12), D(4000)), ("period", D(4000), D(4001))}


def test_long_interval_bridges_buckets(spark):
    rows = [("a", D(0), D(9000)), ("a", D(4000), D(4100)), ("a", D(8999), None)] + [("a", D(i * 7), D(i * 7 + 3)) for i in random.Random(1).sample(range(1000), 200)]
    assert of(spark, rows) == [("a", D(0), None)]


def test_empty(spark):
    assert of(spark, []) == []
