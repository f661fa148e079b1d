"""Row filters: shared sessions, date range, event types."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sessionloom.functions import is_product_event, is_view
from sessionloom.schema import EVENT_DATE, EVENT_TIME, SESSION, USER
from sessionloom.session import materialise, observed
from sessionloom.sources.months import parse_bound


def users_of_sessions(events: DataFrame) -> DataFrame:
    """Users and rows of each session; a null user counts as a user, and no session as one.

    Rows are counted per session and user, then per session.  Both steps combine within tasks
    before they shuffle, so neither a session nor a user with very many rows meets in one task.
    """
    pairs = events.groupBy(SESSION, USER).agg(F.count(F.lit(1)).alias("rows"))
    return pairs.groupBy(SESSION).agg(F.count(F.lit(1)).alias("users"), F.sum("rows").alias("rows"))


def user_spread(events: DataFrame) -> DataFrame:
    """For each session its rows, and whether it has `many` users, in one aggregate and shuffle.

    Users are told apart by two hashes of 64 bits, whose least and greatest values differ if there
    are several; numbers are combined by a hash aggregate within tasks, which texts are not.  A
    null user counts as one.  Neither a session nor a user with very many rows meets in one task.
    """
    hashes = {"_one": F.xxhash64(USER), "_two": F.xxhash64(F.lit("user"), USER)}
    known = F.when(F.col(USER).isNotNull(), 1)
    spread = events.select(SESSION, USER).withColumns(hashes).groupBy(SESSION).agg(
        *[F.min(F.when(F.col(USER).isNotNull(), F.col(name))).alias(f"{name}_low") for name in hashes],
        *[F.max(F.when(F.col(USER).isNotNull(), F.col(name))).alias(f"{name}_high") for name in hashes],
        F.count(known).alias("_known"), F.count(F.lit(1)).alias("rows"),
    )
    differ = [F.col(f"{name}_low") < F.col(f"{name}_high") for name in hashes]
    some_null = (F.col("_known") > 0) & (F.col("_known") < F.col("rows"))
    many = F.coalesce(differ[0], F.lit(False)) | F.coalesce(differ[1], F.lit(False)) | some_null
    return spread.select(SESSION, "rows", many.alias("many"))


def is_shared() -> Column:
    """Of a row of `user_spread`: a session with more than one user."""
    return F.col(SESSION).isNotNull() & F.col("many")


def multi_user_sessions(events: DataFrame) -> DataFrame:
    """Sessions seen with more than one user, and how many; the null session too."""
    sessions = users_of_sessions(events)
    return sessions.where("users > 1").select(SESSION, F.col("users").alias("count"))


def clean_sessions(events: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """Events without those of multi-user sessions; events without a session stay.

    The session list is written out first (one job), which also gives `counts` the rows loaded
    and those left.  A few sessions in a million are shared, so Catalyst, seeing the size of the
    written list, broadcasts it and the events are filtered where they are read; should the list
    be large, it joins by shuffle instead.  Events without a session match nothing, but may be
    many; a second key deals them evenly then.
    """
    sessions = user_spread(events)
    seen = Observation()
    if counts is not None:
        dropped = F.sum(F.when(is_shared(), F.col("rows")))
        sessions = sessions.observe(seen, F.sum("rows").alias("rows"), dropped.alias("dropped"))
    shared = sessions.where(is_shared()).select(SESSION, F.lit(0).cast("long").alias("_deal"))
    bad = materialise(shared, "shared-sessions")
    if counts is not None:
        loaded, gone = (observed(seen).get(name, 0) for name in ("rows", "dropped"))
        counts |= {"loaded": loaded, "cleaned": loaded - gone}
    deal = F.when(F.col(SESSION).isNull(), F.pmod(F.xxhash64(USER, EVENT_TIME), F.lit(4096)))
    dealt = events.withColumn("_deal", F.coalesce(deal, F.lit(0).cast("long")))
    return dealt.join(bad, [SESSION, "_deal"], "left_anti").select(events.columns)


def events_of(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events belonging to the given sessions."""
    return events.join(sessions.select(SESSION), SESSION, "left_semi").select(events.columns)


def since(start: str | datetime) -> Column:
    return F.col(EVENT_TIME) >= _bound(start)


def until(end: str | datetime) -> Column:
    return F.col(EVENT_TIME) <= _bound(end)


def date_range(
    events: DataFrame, start: str | datetime | None = None, end: str | datetime | None = None
) -> DataFrame:
    """Events between the given bounds, both inclusive; a null time never matches a bound.

    Landed events also carry their day, by which Parquet row groups outside the range are skipped.
    """
    by_day = EVENT_DATE in events.columns
    if start is not None:
        events = events.where(since(start))
        if by_day:
            events = events.where(F.col(EVENT_DATE) >= F.lit(parse_bound(start).date()))
    if end is not None:
        events = events.where(until(end))
        if by_day:
            events = events.where(F.col(EVENT_DATE) <= F.lit(parse_bound(end).date()))
    return events


def views(events: DataFrame) -> DataFrame:
    return events.where(is_view())


def product_events(events: DataFrame) -> DataFrame:
    """Views and purchases."""
    return events.where(is_product_event())


def _bound(bound: str | datetime) -> Column:
    return F.lit(parse_bound(bound).isoformat(" ")).cast("timestamp_ntz")
