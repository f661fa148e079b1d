"""Sketches of landed months, and frequent values by bucket counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from shop import at, event, frame, random_events

from sessionloom import operators as op
from sessionloom.checks.queries import monthly_files
from sessionloom.operators import profile
from sessionloom.operators.clean import is_shared, user_spread, users_of_sessions
from sessionloom.sources import MissingMonthsError, land_pending

FIELDS = ["user_id", "user_session", "brand"]


@pytest.fixture(scope="module")
def raw(spark):
    """Months with 9,000 users each, 3,000 of them in both; sessions of their own; no brand."""
    rows = [
        event(at("00:00:00", day), session=f"{day}-{n}", user=f"u{n}", brand=None)
        for day, users in ((1, range(9000)), (32, range(6000, 15_000))) for n in range(users.start, users.stop)
    ]
    return monthly_files(frame(spark, rows))


def test_sketches_of_months(spark, raw, tmp_path):
    zone, one, both = str(tmp_path), ("2019-10-01 00:00:00",) * 2, ("2019-10-01 00:00:00", "2019-11-30 00:00:00")
    land_pending(spark, raw, zone, *one)
    assert op.sketch_pending(spark, zone, FIELDS) == ["2019-Oct"]
    with pytest.raises(MissingMonthsError):
        op.distinct_in_months(spark, zone, *both)
    land_pending(spark, raw, zone, *both)
    assert op.sketch_pending(spark, zone, FIELDS) == ["2019-Nov"]
    assert op.sketch_pending(spark, zone, FIELDS) == []
    error = 3 * 1.04 / 2**8  # three standard errors
    for bounds, users, sessions in ((one, 9000, 9000), (both, 15_000, 18_000)):
        found = {row["field"]: row["distinct"] for row in op.distinct_in_months(spark, zone, *bounds).collect()}
        assert found["brand"] == 0
        assert abs(found["user_id"] - users) <= error * users
        assert abs(found["user_session"] - sessions) <= error * sessions
    plan = op.distinct_in_months(spark, zone, *both)._jdf.queryExecution().executedPlan().toString()
    assert "_sketches" in plan and "event_time" not in plan


def test_exact_counts_of_months(spark, raw, tmp_path):
    """More values than a sketch counts exactly, in two months that share some."""
    zone, one, both = str(tmp_path), ("2019-10-01 00:00:00",) * 2, ("2019-10-01 00:00:00", "2019-11-30 00:00:00")
    land_pending(spark, raw, zone, *one)
    assert op.sketch_pending(spark, zone, FIELDS) == op.values_pending(spark, zone, FIELDS) == ["2019-Oct"]
    with pytest.raises(MissingMonthsError):
        op.exact_distinct_in_months(spark, zone, *both)
    land_pending(spark, raw, zone, *both)
    op.sketch_pending(spark, zone, FIELDS)
    assert op.values_pending(spark, zone, FIELDS) == ["2019-Nov"]
    assert op.values_pending(spark, zone, FIELDS) == []
    for bounds, users, sessions in ((one, 9000, 9000), (both, 15_000, 18_000)):
        found = op.exact_distinct_in_months(spark, zone, *bounds).collect()
        assert sorted(map(tuple, found)) == [("brand", 0), ("user_id", users), ("user_session", sessions)]
    # Values of a month that its sketches do not know.
    spark.createDataFrame([("brand", f"b{n}") for n in range(50)], "field string, value string").write.mode(
        "append"
    ).parquet(f"{zone}/_values/month=2019-Nov")
    with pytest.raises(Exception, match="sketches and values differ: brand"):
        op.exact_distinct_in_months(spark, zone, *both).collect()


def drawn(seed, count=4000):
    pick = random.Random(seed)
    return [
        (None if pick.random() < 0.1 else f"v{int(pick.paretovariate(0.7))}", pick.choice([1, 2, 2, None]), f"r{n}")
        for n in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("buckets", [1, 64, 1 << 16])
def test_frequent_values(spark, seed, buckets):
    df = spark.createDataFrame(drawn(seed), "skewed string, few int, single string")
    fields = ["skewed", "few", "single"]
    found = op.frequent_values(df, fields, 7, buckets)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, op.top_values(df, fields, 7).collect()))
    assert op.frequent_values(df.where("false"), fields).collect() == []


def test_few_values_are_shuffled(spark, monkeypatch):
    rows = drawn(3, 20_000)
    df = spark.createDataFrame(rows, "skewed string, few int, single string")
    tables, write = {}, profile.materialise
    monkeypatch.setattr(profile, "materialise", lambda x, label: tables.setdefault(label, write(x, label)))
    op.frequent_values(df, ["skewed"], 5).collect()
    values = len(Counter(row[0] for row in rows))
    assert values > 500 and tables["full-buckets"].count() < 40


@pytest.mark.parametrize("seed", [1, 4])
def test_spread_of_users(spark, seed):
    events = frame(spark, random_events(seed) + [event("10:00:00", session="n", user=None)] * 3)
    by_count = users_of_sessions(events).select("user_session", "rows", (F.col("users") > 1).alias("many"))
    assert sorted(map(repr, user_spread(events).collect())) == sorted(map(repr, by_count.collect()))
    plan = user_spread(events).where(is_shared())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
