"""Running totals, sliced and windowed."""

import random

import pytest
from pyspark.sql import functions as F
from shop import expected_features, frame, random_events, rows_of

from sessionloom.operators import heavy_keys, running_total
from sessionloom.operators.history import sliced_total
from sessionloom.plans import feature_table

SCHEMA = "key string, place int, amount int"


def skewed(seed=0, count=500):
    """A third of the rows under one key, a third under no key, the rest spread."""
    pick = random.Random(seed)
    keys = ["hot"] * 10 + [None] * 10 + [f"k{i}" for i in range(10)]
    return [(pick.choice(keys), place, pick.randrange(5)) for place in range(count)]


def expected(rows):
    sums, totals = {}, {}
    for key, place, amount in sorted(rows, key=lambda row: row[1]):
        totals[(key, place)] = sums.get(key, 0)
        sums[key] = sums.get(key, 0) + amount
    return totals


def totals(df):
    return {(row["key"], row["place"]): row["total"] for row in df.collect()}


@pytest.mark.parametrize("slices", [1, 7, None])
def test_sliced_total(spark, slices):
    rows = skewed()
    df = spark.createDataFrame(rows, SCHEMA)
    result = sliced_total(df, ["key"], ["place"], F.col("amount"), "total", slices)
    assert result.columns == ["key", "place", "amount", "total"]
    assert totals(result) == expected(rows)


def test_slices_share_a_hot_key(spark):
    """The cut follows the rows, not the keys: no slice holds much more than its share."""
    df = spark.createDataFrame([("hot", place, 1) for place in range(4000)], SCHEMA)
    cut = df.repartitionByRange(8, "key", "place").groupBy(F.spark_partition_id()).count().collect()
    assert len(cut) == 8 and max(row["count"] for row in cut) < 1000
    result = sliced_total(df, ["key"], ["place"], F.col("amount"), "total", 8)
    assert totals(result) == {("hot", place): place for place in range(4000)}


def test_only_heavy_keys_are_sliced(spark):
    rows = skewed(1)
    df = spark.createDataFrame(rows, SCHEMA)
    heavy = heavy_keys(df, ["key"], limit=100)
    assert {row["key"] for row in heavy.collect()} == {"hot", None}
    result = running_total(df, ["key"], ["place"], F.col("amount"), "total", heavy=heavy)
    assert totals(result) == expected(rows)


def test_no_heavy_keys(spark):
    df = spark.createDataFrame(skewed(), SCHEMA)
    assert heavy_keys(df, ["key"], limit=10_000) is None
    assert heavy_keys(df.where("false"), ["key"]) is None


def peers(seed, count=300):
    """Rows of few places, so that most have peers, under a hot key, no key and others."""
    pick = random.Random(seed)
    return [
        (pick.choice(["hot"] * 6 + [None, "a", "b"]), pick.choice([None, *range(6)]), at, pick.randrange(-2, 5))
        for at in range(count)
    ]


@pytest.mark.parametrize("slices", [None, 1, 2, 7, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_peers_do_not_count_for_each_other(spark, slices, seed):
    rows = peers(seed)
    place = lambda row: (row[1] is not None, row[1] or 0)
    expected = sorted(
        (row[2], sum(x[3] for x in rows if x[0] == row[0] and place(x) < place(row))) for row in rows
    )
    df = spark.createDataFrame(rows, "key string, place int, sort int, amount int").repartition(3)
    arguments = (["key"], ["place", "sort"], F.col("amount"), "total")
    if slices is None:
        found = running_total(df, *arguments, heavy=heavy_keys(df, ["key"], 100), apart=1)
    else:
        found = sliced_total(df, *arguments, slices, apart=1)
    assert found.columns == [*df.columns, "total"]
    assert sorted((row["sort"], row["total"]) for row in found.collect()) == expected


@pytest.mark.parametrize("limit", [0, 40, 10**6])
def test_session_level_history(spark, limit):
    events = random_events(3)
    expected = expected_features(events, session_level=True)
    assert expected != expected_features(events)
    assert rows_of(feature_table(frame(spark, events), heavy_limit=limit, session_level=True)) == expected
