"""The feature table against hand-computed rows and a brute-force account of random events."""

from datetime import datetime

import pytest
from shop import at, event, expected_features, frame, random_events, rows_of

from sessionloom.operators import (
    clean_sessions, date_range, features_product, features_session, features_session_product,
)
from sessionloom.operators.features import composed_features, visits
from sessionloom.operators.history import running_total
from sessionloom.plans import feature_table
from sessionloom.schema import FEATURE_COLUMNS, FEATURE_SCHEMA


def one(df, **where):
    found = [row for row in rows_of(df) if all(row[k] == v for k, v in where.items())]
    assert len(found) == 1, found
    return found[0]


# A day of one shopper: three visits to p1, one of them also to p2.
VISITS = [
    event("09:00:00", session="a"),
    event("09:00:40", session="a"),
    event("09:01:10", "purchase", session="a"),
    event("10:30:00", session="b"),
    event("10:30:00", session="b"),
    event("10:31:30", product="p2", session="b", brand=None, price=111.97),
    event("12:00:00", session="c"),
]


def test_golden_visits(spark):
    table = feature_table(frame(spark, VISITS))
    assert table.columns == FEATURE_COLUMNS
    assert [f.dataType for f in table.schema] == [f.dataType for f in FEATURE_SCHEMA]
    shared = {"category_code": "c", "user_id": "u1", "start_weekday": "Tuesday"}
    assert rows_of(table) == [
        dict(shared, user_session="a", product_id="p1", brand="b", price=10.0, purchased=1,
             num_views_product=2, num_views_session=1, start_time="09:00", duration=70,
             num_prev_sessions=0, num_prev_product_views=0),
        dict(shared, user_session="b", product_id="p1", brand="b", price=10.0, purchased=0,
             num_views_product=2, num_views_session=2, start_time="10:30", duration=90,
             num_prev_sessions=1, num_prev_product_views=2),
        dict(shared, user_session="b", product_id="p2", brand=None, price=111.97, purchased=0,
             num_views_product=1, num_views_session=2, start_time="10:30", duration=90,
             num_prev_sessions=1, num_prev_product_views=0),
        dict(shared, user_session="c", product_id="p1", brand="b", price=10.0, purchased=0,
             num_views_product=1, num_views_session=1, start_time="12:00", duration=0,
             num_prev_sessions=2, num_prev_product_views=4),
    ]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bounded", [False, True])
def test_random_events(spark, seed, bounded):
    events = random_events(seed)
    bounds = (datetime(2019, 10, 1, 0, 12), datetime(2019, 10, 3, 0, 50)) if bounded else (None, None)
    expected = expected_features(events, *bounds)
    assert len(expected) > 40
    assert rows_of(feature_table(frame(spark, events), *bounds)) == expected


@pytest.mark.parametrize("heavy_limit", [0, 40])
def test_heavy_users_give_the_same_rows(spark, heavy_limit):
    events = random_events(4)
    assert rows_of(feature_table(frame(spark, events), heavy_limit=heavy_limit)) == expected_features(events)


def test_composition_of_operators_gives_the_same_rows(spark):
    events = random_events(5)
    bounds = at("00:10:00"), at("00:40:00", 3)
    kept = date_range(clean_sessions(frame(spark, events)), *bounds).where("user_session is not null")
    composed = composed_features(visits(kept), running_total).select(FEATURE_COLUMNS)
    assert rows_of(composed) == expected_features(events, *bounds)
    steps = features_session_product(features_product(kept), features_session(kept)).select(FEATURE_COLUMNS)
    assert rows_of(steps) == expected_features(events, *bounds)


@pytest.mark.parametrize("limit", [0, 5])
def test_steps_with_heavy_groups(spark, limit):
    events = random_events(8)
    kept = clean_sessions(frame(spark, events)).where("user_session is not null")
    steps = features_session_product(features_product(kept), features_session(kept, limit), limit)
    assert rows_of(steps.select(FEATURE_COLUMNS)) == expected_features(events)


def test_result_does_not_depend_on_partitioning(spark):
    events = frame(spark, random_events(6))
    reference = rows_of(feature_table(events))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert rows_of(feature_table(events.orderBy("price").repartition(5))) == reference
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_bounds_are_inclusive(spark):
    events = [event("08:00:00", session="a"), event("09:00:00", session="b"), event("09:00:01", session="c")]
    table = feature_table(frame(spark, events), "2019-10-01 08:00:00 UTC", "2019-10-01 09:00:00")
    assert [row["user_session"] for row in rows_of(table)] == ["a", "b"]


def test_second_user_outside_the_range_still_removes_the_session(spark):
    events = [event("08:00:00", session="a"), event("20:00:00", session="a", user="u2")]
    assert rows_of(feature_table(frame(spark, events), end=at("09:00:00"))) == []


def test_null_user_counts_as_a_user(spark):
    events = [
        event("08:00:00", session="mixed"), event("08:01:00", session="mixed", user=None),
        event("08:00:00", session="only null", user=None),
    ]
    assert [row["user_session"] for row in rows_of(feature_table(frame(spark, events)))] == ["only null"]


def test_events_without_a_session_give_no_row_and_no_history(spark):
    events = [
        event("07:00:00", session=None), event("07:00:00", session=None, user="u2"),
        event("08:00:00", session="a"),
    ]
    row = one(feature_table(frame(spark, events)))
    assert (row["num_prev_sessions"], row["num_prev_product_views"]) == (0, 0)


def test_range_cuts_straddling_sessions_and_history(spark):
    events = [
        event("07:00:00", session="a"), event("08:30:00", session="a"), event("09:30:00", session="b"),
        event("06:00:00", session="gone"),
    ]
    table = feature_table(frame(spark, events), start=at("08:00:00"))
    first, second = rows_of(table)
    assert (first["start_time"], first["duration"], first["num_views_product"]) == ("08:30", 0, 1)
    assert (second["num_prev_sessions"], second["num_prev_product_views"]) == (1, 1)


def test_cart_only_session_counts_as_earlier_and_cart_events_shape_a_session(spark):
    events = [
        event("07:00:00", "cart", session="cart"),
        event("07:59:00", "cart", session="a"), event("08:00:00", session="a"),
    ]
    row = one(feature_table(frame(spark, events)))
    assert (row["num_prev_sessions"], row["start_time"], row["duration"]) == (1, "07:59", 60)


def test_purchase_without_view(spark):
    row = one(feature_table(frame(spark, [event("07:00:00", "purchase")])))
    assert (row["purchased"], row["num_views_product"], row["num_views_session"]) == (1, 0, 0)


def test_repeated_events_all_count(spark):
    assert one(feature_table(frame(spark, [event("07:00:00")] * 3)))["num_views_product"] == 3


def test_price_change_gives_rows_that_see_each_other(spark):
    events = [
        event("07:00:00", price=2.0), event("07:01:00", price=1.0), event("07:02:00", price=1.0),
        event("07:03:00", price=1.0, brand=None),
    ]
    table = feature_table(frame(spark, events))
    before = {(r["brand"], r["price"]): r["num_prev_product_views"] for r in rows_of(table)}
    assert before == {(None, 1.0): 0, ("b", 1.0): 1, ("b", 2.0): 3}
    assert {r["num_views_session"] for r in rows_of(table)} == {1}


def test_sessions_starting_in_the_same_second_are_ordered_by_id(spark):
    events = [event("07:00:00", session="b"), event("07:00:00", session="a")]
    before = {r["user_session"]: r["num_prev_sessions"] for r in rows_of(feature_table(frame(spark, events)))}
    assert before == {"a": 0, "b": 1}


def test_history_is_per_user(spark):
    events = [event("07:00:00", session="a"), event("08:00:00", session="b", user="u2")]
    assert {r["num_prev_product_views"] for r in rows_of(feature_table(frame(spark, events)))} == {0}


def test_session_count_is_of_products_not_views(spark):
    events = [event("07:00:00"), event("07:01:00"), event("07:02:00", product="p2")]
    assert {r["num_views_session"] for r in rows_of(feature_table(frame(spark, events)))} == {2}


@pytest.mark.parametrize("zone", ["Europe/Paris", "America/Sao_Paulo"])
def test_session_time_zone_has_no_effect(spark, zone):
    # 2019-10-27 02:30 does not exist once and 2019-03-31 02:30 not at all in Paris wall time.
    events = [event(datetime(2019, 3, 31, 2, 30), session="a"), event(datetime(2019, 10, 31, 23, 59), session="b")]
    expected = expected_features(events)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows_of(feature_table(frame(spark, events), "2019-03-31 02:30:00")) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_times_fall_out_of_a_range(spark):
    events = [event(None, session="a"), event("07:00:00", session="b")]
    assert len(rows_of(feature_table(frame(spark, events)))) == 2
    assert len(rows_of(feature_table(frame(spark, events), start=at("00:00:00")))) == 1


def test_no_events(spark):
    assert rows_of(feature_table(frame(spark, []))) == []
