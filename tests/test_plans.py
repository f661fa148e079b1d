"""Physical plans: what is read, pushed down and shuffled."""

import re

import pytest
from shop import at, frame, random_events

from pyspark.sql import functions as F

from sessionloom import operators as op
from sessionloom import session
from sessionloom.operators import clean, features, history, profile
from sessionloom.plans import feature_table, table
from sessionloom.sinks import write_csv
from sessionloom.sources import land_pending, read_landed


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "events")
    frame(spark, random_events(11)).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return re.findall(r" Exchange (\w+)\(", plan)


def inputs_of(run):
    """Paths of the scans of each job that `run` starts, by the plans of what it writes."""
    plans, write = [], session.materialise

    def listening(df, label):
        plans.append((label, plan_of(df)))
        return write(df, label)

    modules = (clean, features, history, profile, table)
    for module in modules:
        module.materialise = listening
    try:
        plans.append(("result", plan_of(run())))
    finally:
        for module in modules:
            module.materialise = write
    return plans


def scans_of(plans, path):
    path = path.removeprefix("file:").lstrip("/")
    return [label for label, plan in plans for _ in re.findall(rf"FileScan.*{re.escape(path)}", plan)]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_feature_table_reads_events_twice(spark, landed, limit):
    """For the list of sessions and for the visits, with heavy users and without."""
    plans = inputs_of(lambda: feature_table(landed, at("00:10:00"), at("00:50:00", 3), limit))
    path = landed.inputFiles()[0].rsplit("/", 1)[0]
    assert scans_of(plans, path) == ["shared-sessions", "visits"]


def test_feature_table_shuffles_twice(spark, landed):
    """Once for the visits and once by user; no join besides the filter by session list."""
    plans = dict(inputs_of(lambda: feature_table(landed, at("00:10:00"), at("00:50:00", 3))))
    assert shuffles(plans["visits"]) == shuffles(plans["result"]) == ["hashpartitioning"]
    assert re.findall(r"(\w+Join) ", plans["visits"]) == ["BroadcastHashJoin"]
    assert "Join" not in plans["result"]
    assert not any("SortAggregate" in plan or "Python" in plan for plan in plans.values())


@pytest.mark.parametrize("limit", [0, 10**6])
def test_session_steps_read_events_once(spark, landed, limit):
    path = landed.inputFiles()[0].rsplit("/", 1)[0]
    plans = inputs_of(lambda: op.features_session(landed, limit))
    assert scans_of(plans, path) == ["session-spans"]


@pytest.mark.parametrize("rule", ["merge", "size"])
def test_product_step_joins_buckets(spark, landed, monkeypatch, rule):
    """Both inputs are computed once, and neither the join nor what counts its rows shuffles them."""
    if rule == "merge":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    written, write = [], session.bucketed
    monkeypatch.setattr(features, "bucketed", lambda df, label, keys: written.append((label, plan_of(df))) or write(df, label, keys))
    path = landed.inputFiles()[0].rsplit("/", 1)[0]
    try:
        products, sessions = op.features_product(landed), op.features_session(landed)
        plans = inputs_of(lambda: op.features_session_product(products, sessions))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [label for label, _ in plans] == ["heavy-keys", "heavy-keys", "result"]
    assert [label for label, _ in written] == ["per-product", "per-session"]
    assert scans_of(written, path) == ["per-product"] and scans_of(plans, path) == []
    for plan in (plans[1][1], plans[2][1]):
        assert "Join" in plan and "hashpartitioning(user_session" not in plan
        below = plan[plan.index("Join"):]
        assert rule == "size" or "Exchange" not in below
    assert "Bucketed: true" in plans[2][1]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_product_step_shuffles_a_session_too_large_for_a_bucket(spark, landed):
    products, sessions = op.features_product(landed), op.features_session(landed)
    plans = inputs_of(lambda: op.features_session_product(products, sessions, 2))
    assert "Bucketed: true" not in plans[-1][1]
    expected = op.features_session_product(products, sessions)
    found = op.features_session_product(products, sessions, 2)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_session_list_takes_one_shuffle(spark, landed):
    plans = dict(inputs_of(lambda: op.clean_sessions(landed)))
    assert shuffles(plans["shared-sessions"]) == ["hashpartitioning"]
    assert "SortAggregate" not in plans["shared-sessions"]
    assert re.search(r"ReadSchema: struct<(.*?)>", plans["shared-sessions"]).group(1) == "user_id:string,user_session:string"


def test_counts_of_steps_read_events_twice(spark, landed):
    path = landed.inputFiles()[0].rsplit("/", 1)[0]
    plans = inputs_of(lambda: op.step_counts(landed, at("00:10:00")))
    assert scans_of(plans, path) == ["shared-sessions", "result"]


def scan_of(plan):
    return next(line for line in plan.splitlines() if "FileScan" in line and "event_time" in line)


def test_feature_table_scan(spark, landed):
    plans = dict(inputs_of(lambda: feature_table(landed, at("00:10:00"), at("00:50:00", 3))))
    scan = scan_of(plans["visits"])
    assert "category_id" not in scan
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    assert "GreaterThanOrEqual(event_time" in pushed and "LessThanOrEqual(event_time" in pushed
    assert "IsNotNull(user_session)" in pushed


def test_landed_events_are_pruned_by_month_and_day(spark, tmp_path):
    raw, zone = f"{tmp_path}/raw", f"{tmp_path}/zone"
    text = F.col("event_time").cast("string")
    write_csv(frame(spark, random_events(12)).withColumn("event_time", text), f"{raw}/2019-Oct.csv")
    bounds = "2019-10-02 00:00:00", "2019-10-02 12:00:00"
    land_pending(spark, raw, zone, *bounds)
    events = read_landed(spark, zone, *bounds)
    scan = scan_of(dict(inputs_of(lambda: feature_table(events, *bounds)))["visits"])
    assert "month" in re.search(r"PartitionFilters: \[(.*?)\], Pushed", scan).group(1)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan).group(1)
    assert "GreaterThanOrEqual(event_date,2019-10-02)" in pushed
    assert "LessThanOrEqual(event_date,2019-10-02)" in pushed
    found = op.date_range(events, *bounds)
    assert found.select("event_date").distinct().count() == 1


def test_session_list_reads_two_columns(spark, landed):
    plan = plan_of(op.multi_user_sessions(landed))
    assert re.search(r"ReadSchema: struct<(.*?)>", plan).group(1) == "user_id:string,user_session:string"
    assert "SortAggregate" not in plan


def test_top_values_keeps_few_rows_per_task(spark, landed):
    assert "WindowGroupLimit" in plan_of(op.top_values(landed, ["brand", "category_code"]))


def test_top_pair_does_not_sort_everything(spark, landed):
    assert "TakeOrderedAndProject" in plan_of(op.top_pair(landed))


def test_plans_of_profiles_are_single_passes(spark, landed):
    for report in (op.null_counts(landed), op.non_null_counts(landed), op.dup_impact(landed)):
        assert plan_of(report).count("FileScan") == 1


def test_a_hot_session_is_split_in_the_join(spark):
    """Adaptive execution divides the product rows of a session that holds most of them."""
    numbers = spark.range(60_000)
    hot = F.when(F.col("id") < 40_000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500))
    events = numbers.select(
        F.lit("2019-10-01 00:00:00").cast("timestamp_ntz").alias("event_time"),
        F.lit("view").alias("event_type"), F.col("id").cast("string").alias("product_id"),
        F.lit("c").alias("category_code"), F.lit("b").alias("brand"), F.lit(1.0).alias("price"),
        F.lit("u").alias("user_id"), hot.alias("user_session"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = op.features_product(events).join(op.features_session(events), "user_session")
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
