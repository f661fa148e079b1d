"""Time expressions on zone-less UTC timestamps; none reads the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(text: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss', with or without the ' UTC' suffix; anything else gives null."""
    body = F.when(text.endswith(" UTC"), F.substring(text, 1, 19)).otherwise(text)
    well_formed = (F.length(body) == 19) & F.length(text).isin(19, 23)
    return F.when(well_formed, body.try_cast("timestamp_ntz"))


def utc_wall_clock(instant: Column) -> Column:
    """A zoned timestamp as the UTC wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def hhmm(time: Column) -> Column:
    return F.concat(
        F.lpad(F.hour(time).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(F.minute(time).cast("string"), 2, "0"),
    )


def weekday(time: Column) -> Column:
    """Full English name of the day."""
    return F.date_format(time.cast("date"), "EEEE")


def seconds_between(first: Column, last: Column) -> Column:
    return F.unix_timestamp(last) - F.unix_timestamp(first)


def month_label(day: Column) -> Column:
    """'2019-Oct': the name of a monthly file."""
    return F.date_format(day.cast("date"), "yyyy-MMM")
