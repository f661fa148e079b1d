"""History that earlier runs leave behind."""

from datetime import datetime

import pytest
from shop import at, event, expected_after, expected_features, frame, random_events, rows_of

from sessionloom.operators import History, OverlappingHistory
from sessionloom.plans import feature_table

# Three ranges that follow each other; the cuts fall among the events.
RANGES = [
    (at("00:00:00"), datetime(2019, 10, 1, 0, 29, 59)),
    (datetime(2019, 10, 1, 0, 30), datetime(2019, 10, 2, 0, 30)),
    (datetime(2019, 10, 2, 0, 30, 1), at("02:00:00", 3)),
]


@pytest.mark.parametrize("limit", [0, 25, 10**6])
@pytest.mark.parametrize("seed", [1, 8])
def test_runs_in_turn_equal_one_run(spark, tmp_path, limit, seed):
    events = random_events(seed)
    history, cuts = History(spark, str(tmp_path / "history")), [start for start, _ in RANGES]
    plain = 0
    for start, end in RANGES:
        found = rows_of(feature_table(frame(spark, events), start, end, limit, history=history))
        assert found == expected_after(events, cuts, start, end)
        plain += found == expected_features(events, start, end)
    assert plain == 1
    assert history.ranges() == RANGES


def test_a_repeated_run_counts_once(spark, tmp_path):
    events, history = frame(spark, random_events(2)), History(spark, str(tmp_path / "history"))
    runs = [rows_of(feature_table(events, *RANGES[k], history=history)) for k in (0, 1, 0, 1, 1)]
    assert runs[1] == runs[3] == runs[4] and runs[0] == runs[2]


def test_a_run_that_broke_off_counts_for_nothing(spark, tmp_path):
    events, path = random_events(2), tmp_path / "history"
    history = History(spark, str(path))
    feature_table(frame(spark, events), *RANGES[0], history=history)
    next(path.glob("*/_DONE")).unlink()
    assert history.ranges() == []
    found = rows_of(feature_table(frame(spark, events), *RANGES[1], history=history))
    assert found == expected_features(events, *RANGES[1])


def test_overlap_and_open_ranges_raise(spark, tmp_path):
    events, history = frame(spark, random_events(2)), History(spark, str(tmp_path / "history"))
    feature_table(events, *RANGES[1], history=history)
    with pytest.raises(OverlappingHistory):
        feature_table(events, RANGES[0][0], RANGES[1][0], history=history)
    with pytest.raises(ValueError):
        feature_table(events, RANGES[0][0], history=history)


def test_later_ranges_do_not_count(spark, tmp_path):
    events, history = random_events(6), History(spark, str(tmp_path / "history"))
    feature_table(frame(spark, events), *RANGES[2], history=history)
    found = rows_of(feature_table(frame(spark, events), *RANGES[0], history=history))
    assert found == expected_features(events, *RANGES[0])


def test_users_without_sessions_and_null_users(spark, tmp_path):
    history = History(spark, str(tmp_path / "history"))
    days = [at("00:00:00", day) for day in (1, 2, 3)]
    events = [
        event(at("10:00:00"), session="a", user=None), event(at("10:00:00"), session="b", user="u2"),
        event(at("10:00:00", 2), session="c", user=None), event(at("11:00:00", 2), session="d", user="u3"),
    ]
    feature_table(frame(spark, events), days[0], datetime(2019, 10, 1, 23, 59, 59), history=history)
    found = rows_of(feature_table(frame(spark, events), days[1], days[2], history=history))
    assert [(r["user_session"], r["num_prev_sessions"], r["num_prev_product_views"]) for r in found] == [("c", 1, 1), ("d", 0, 0)]
    assert rows_of(feature_table(frame(spark, []), at("00:00:00", 5), at("00:00:00", 6), history=history)) == []
