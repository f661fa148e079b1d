"""Readers, months and landing."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import distinct_in_months, sketch_pending
from sessionloom.schema import RAW_COLUMNS
from sessionloom import sources

HEADER = ",".join(RAW_COLUMNS)


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def line(time, session="s1", price="1.50", brand="b"):
    return f"{time},view,p1,9,c,{brand},{price},u1,{session}"


def months(df):
    return sorted(row[0] for row in df.collect())


def test_text_reader_keeps_text_and_checks_the_header(spark, tmp_path):
    write(tmp_path, "2019-Oct.csv", line("2019-10-01 00:00:00 UTC", brand=""))
    row = sources.read_strings(spark, str(tmp_path / "2019-Oct.csv")).first()
    assert (row["event_time"], row["price"], row["brand"]) == ("2019-10-01 00:00:00 UTC", "1.50", None)
    (tmp_path / "other.csv").write_text(HEADER.replace("brand", "colour") + "\n" + line("x") + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_strings(spark, str(tmp_path / "other.csv")).collect()


def test_typed_reader(spark, tmp_path):
    write(
        tmp_path, "a.csv", line("2019-10-01 02:28:32 UTC"), line("2019-10-01 02:28:32"),
        line("2019-10-01"), line("yesterday"), line("", price="cheap"), line("2019-13-01 00:00:00"),
        line("2019-10-01 02:28:32 CET"),
    )
    path = str(tmp_path / "a.csv")
    rows = sources.read_typed(spark, path).collect()
    time = datetime(2019, 10, 1, 2, 28, 32)
    assert [row["event_time"] for row in rows] == [time, time, None, None, None, None, None]
    assert [row["price"] for row in rows] == [1.5] * 4 + [None] + [1.5] * 2
    assert sources.rejected(sources.read_strings(spark, path)).count() == 5


def test_inferred_reader(spark, tmp_path):
    write(tmp_path, "a.csv", line("2019-10-01 02:28:32"))
    assert dict(sources.read_inferred(spark, str(tmp_path / "a.csv")).dtypes)["price"] == "double"


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris"])
def test_zoned_times_become_utc(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = spark.range(1).select(
            *[
                (F.timestamp_micros(F.lit(1553995800_123456)) if name == "event_time" else F.lit("1")).alias(name)
                for name in RAW_COLUMNS
            ]
        )
        assert sources.typed(raw).first()["event_time"] == datetime(2019, 3, 31, 1, 30, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2019-12-16 00:00:00", "2020-01-15 00:00:00", ["2019-Dec", "2020-Jan"]),
        ("2020-01-31 00:00:00", "2020-03-01 00:00:00", ["2020-Feb", "2020-Jan", "2020-Mar"]),
        ("2020-01-05 00:00:00", "2020-01-05 23:00:00 UTC", ["2020-Jan"]),
        ("2020-01-05 00:00:00", "2020-01-05 00:00:00", ["2020-Jan"]),
    ],
)
def test_months_in_range(spark, start, end, expected):
    assert months(sources.months_in_range(spark, start, end)) == expected


def test_zoned_bounds_become_utc():
    paris = timezone(timedelta(hours=2))
    first, _ = sources.check_range(datetime(2019, 10, 1, 1, 0, tzinfo=paris), "2019-10-01 00:00:00")
    assert first == datetime(2019, 9, 30, 23, 0)


@pytest.mark.parametrize("start, end", [("2020-01-02 00:00:00", "2020-01-01 00:00:00"), ("soon", "later")])
def test_bad_ranges(start, end):
    with pytest.raises(ValueError):
        sources.check_range(start, end)


def test_missing_months(spark, tmp_path):
    write(tmp_path, "2019-Oct.csv", line("2019-10-01 00:00:00"))
    present = sources.listed_months(spark, f"{tmp_path}/*.csv")
    assert present == ["2019-Oct"]
    required = sources.months_in_range(spark, "2019-10-31 00:00:00", "2019-11-01 00:00:00")
    assert months(sources.missing_months(required, sources.month_frame(spark, present))) == ["2019-Nov"]
    with pytest.raises(sources.MissingMonthsError, match="2019-Nov"):
        sources.require_months(sources.month_names(required), present)


def test_landing_is_incremental_and_repeatable(spark, tmp_path):
    raw, zone = tmp_path / "raw", str(tmp_path / "zone")
    write(raw, "2019-Oct.csv", line("2019-10-31 23:00:00 UTC", "s1"), line("broken", "s2"))
    span = ("2019-10-20 00:00:00", "2019-11-10 00:00:00")
    with pytest.raises(sources.MissingMonthsError):
        sources.land_pending(spark, str(raw), zone, *span)
    first = sources.land_pending(spark, str(raw), zone, span[0], span[0])
    assert first == {"months": ["2019-Oct"], "rows": 2, "rejected": 1, "broken": 0}
    with pytest.raises(sources.MissingMonthsError):
        sources.read_landed(spark, zone, *span)

    write(raw, "2019-Nov.csv", line("2019-11-01 01:00:00 UTC", "s3"))
    second = sources.land_pending(spark, str(raw), zone, *span)
    assert second == {"months": ["2019-Nov"], "rows": 1, "rejected": 0, "broken": 0}
    assert sources.land_pending(spark, str(raw), zone, *span)["months"] == []
    landed = sources.read_landed(spark, zone, *span)
    assert sorted(row["user_session"] for row in landed.collect()) == ["s1", "s2", "s3"]
    assert landed.schema["event_time"].dataType.simpleString() == "timestamp_ntz"


def test_a_landing_that_broke_off_is_repeated(spark, tmp_path):
    raw, zone = tmp_path / "raw", tmp_path / "zone"
    write(raw, "2019-Oct.csv", line("2019-10-30 23:00:00", "s1"), line("2019-10-31 23:00:00", "s2"))
    span = ("2019-10-20 00:00:00", "2019-10-31 00:00:00")
    sources.land_pending(spark, str(raw), str(zone), *span)
    (zone / "_landed" / "2019-Oct").unlink()
    with pytest.raises(sources.MissingMonthsError):
        sources.read_landed(spark, str(zone), *span)
    assert sources.land_pending(spark, str(raw), str(zone), *span)["rows"] == 2
    assert sources.read_landed(spark, str(zone), *span).count() == 2


def test_broken_records_are_no_events(spark, tmp_path):
    raw, zone = tmp_path / "raw", tmp_path / "zone"
    good = [line(f"2019-10-01 00:00:{second:02}", f"s{second}") for second in range(20)]
    broken = [line("2019-10-01 00:01:00", brand='"two\nlines"'), "2019-10-01 00:02:00,view", good[0] + ",more"]
    write(raw, "2019-Oct.csv", *good, *broken)
    span = ("2019-10-01 00:00:00", "2019-10-02 00:00:00")
    with pytest.raises(sources.TooManyBrokenError):
        sources.land_pending(spark, str(raw), str(zone), *span)
    assert sources.landed_months(spark, str(zone)) == []
    report = sources.land_pending(spark, str(raw), str(zone), *span, tolerated=0.5)
    assert report == {"months": ["2019-Oct"], "rows": 20, "rejected": 0, "broken": 4}
    landed = sources.read_landed(spark, str(zone), *span).collect()
    assert sorted(row["user_session"] for row in landed) == sorted(f"s{second}" for second in range(20))
    assert spark.read.json(f"{zone}/_rejects/month=2019-Oct").count() == 4


def test_a_sample_keeps_whole_sessions(spark):
    rows = [(f"s{i % 200}" if i % 7 else None, f"u{i % 50}", i) for i in range(2000)]
    events = spark.createDataFrame(rows, "user_session string, user_id string, n int")
    kept = {(r.user_session, r.n) for r in sources.sample_sessions(events, 0.3).collect()}
    sessions = {session for session, _ in kept if session}
    assert 30 < len(sessions) < 90
    assert {n for s, n in kept if s} == {n for s, _, n in rows if s in sessions}
    assert 0 < sum(s is None for s, _ in kept) < 286
    assert sources.sample_sessions(events, 1).count() == 2000
    assert sources.sample_sessions(events, 0).count() == 0
    with pytest.raises(ValueError):
        sources.in_sample(1.5)


def test_a_month_that_is_delivered_again_is_landed_again(spark, tmp_path):
    raw, zone, span = tmp_path / "raw", str(tmp_path / "zone"), ("2019-10-01 00:00:00", "2019-11-30 00:00:00")
    write(raw, "2019-Oct.csv", line("2019-10-01 00:00:00"), line("2019-10-02 00:00:00"))
    write(raw, "2019-Nov.csv", line("2019-11-01 00:00:00"))
    assert sources.land_pending(spark, str(raw), zone, *span)["months"] == ["2019-Nov", "2019-Oct"]
    sketch_pending(spark, zone, ["user_id", "user_session"])
    assert sources.land_pending(spark, str(raw), zone, *span)["months"] == []
    write(raw, "2019-Oct.csv", line("2019-10-03 00:00:00", session="other"))
    # A range without the month leaves it alone.
    assert sources.land_pending(spark, str(raw), zone, "2019-11-01 00:00:00", span[1])["months"] == []
    assert sources.land_pending(spark, str(raw), zone, *span)["months"] == ["2019-Oct"]
    found = sources.read_landed(spark, zone, *span)
    assert sorted(row["user_session"] for row in found.collect()) == ["other", "s1"]
    assert sketch_pending(spark, zone, ["user_id", "user_session"]) == ["2019-Oct"]
    counts = {row["field"]: row["distinct"] for row in distinct_in_months(spark, zone, *span).collect()}
    assert counts == {"user_id": 1, "user_session": 2}
    (raw / "2019-Oct.csv").unlink()
    assert sources.land_pending(spark, str(raw), zone, *span)["months"] == []
