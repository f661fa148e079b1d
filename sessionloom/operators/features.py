"""The three feature steps as separate operators.

`plans.table` computes the same rows from `visits` with fewer shuffles; the separate steps are
for use on their own, and on visits for users too large for one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions import (
    as_flag, hhmm, is_product_event, is_purchase, is_view, seconds_between, weekday,
)
from sessionloom.schema import EVENT_TIME, PRODUCT, PRODUCT_ATTRIBUTES, SESSION, USER
from sessionloom.session import bucketed, materialise

from .clean import product_events
from .history import HEAVY_GROUP_ROWS, heavy_keys, running_total, sliced_total

START, END = "temp_start_dt", "temp_end_dt"

# Columns of `visits`: whether the row is of views and purchases, and its first and last event.
TOUCHED, FIRST, LAST = "_touched", "_first", "_last"

# Ties on the start second are ordered, so that repeated runs agree.
SESSION_ORDER = [START, SESSION]
PRODUCT_ORDER = [START, SESSION, *PRODUCT_ATTRIBUTES]


def visits(events: DataFrame) -> DataFrame:
    """One row per user, session, product and attributes, for all that is computed from views and
    purchases; events of other types make one row per session, without a product."""
    touched = F.coalesce(is_product_event(), F.lit(False))
    variant = [F.when(touched, F.col(name)).alias(name) for name in [PRODUCT, *PRODUCT_ATTRIBUTES]]
    return events.groupBy(USER, SESSION, touched.alias(TOUCHED), *variant).agg(
        *_views_and_purchases(), F.min(EVENT_TIME).alias(FIRST), F.max(EVENT_TIME).alias(LAST)
    )


def _views_and_purchases() -> list[Column]:
    return [
        F.max(as_flag(is_purchase())).alias("purchased"),
        F.sum(as_flag(is_view())).alias("num_views_product"),
    ]


def features_product(events: DataFrame) -> DataFrame:
    """Purchase flag and view count per session, product and attributes.

    A price, brand or category change within a session gives one row per variant.  Repeated
    identical events all count.
    """
    per_variant = product_events(events).groupBy(PRODUCT, *PRODUCT_ATTRIBUTES, SESSION)
    return per_variant.agg(*_views_and_purchases())


def session_spans(events: DataFrame) -> DataFrame:
    """First and last event and the number of distinct viewed products per session and user."""
    return events.groupBy(SESSION, USER).agg(
        F.count_distinct(F.when(is_view(), F.col(PRODUCT))).alias("num_views_session"),
        F.min(EVENT_TIME).alias(START),
        F.max(EVENT_TIME).alias(END),
    )


def spans_of_visits(rows: DataFrame) -> DataFrame:
    """The same from `visits`."""
    viewed = F.when(F.col("num_views_product") > 0, F.col(PRODUCT))
    return rows.groupBy(SESSION, USER).agg(
        F.count_distinct(viewed).alias("num_views_session"),
        F.min(FIRST).alias(START),
        F.max(LAST).alias(END),
    )


def describe_sessions(spans: DataFrame) -> DataFrame:
    return spans.withColumns(
        {
            "start_time": hhmm(F.col(START)),
            "start_weekday": weekday(F.col(START)),
            "duration": seconds_between(F.col(START), F.col(END)),
        }
    )


def features_session(events: DataFrame, heavy_limit: int = HEAVY_GROUP_ROWS) -> DataFrame:
    """Span, distinct viewed products and number of the user's earlier sessions.

    Every event type shapes a session.  Sessions without a product row count as earlier ones.
    Runs a job when called: the sessions are written once, and users with too many of them for
    one task are found there.
    """
    spans = materialise(session_spans(events), "session-spans")
    return _numbered(spans, running_total, heavy=heavy_keys(spans, [USER], heavy_limit), limit=heavy_limit)


def _numbered(spans: DataFrame, total, **options) -> DataFrame:
    # Events without a session id make a row here, but that is no earlier session of the user.
    has_id = as_flag(F.col(SESSION).isNotNull())
    return total(describe_sessions(spans), [USER], SESSION_ORDER, has_id, "num_prev_sessions", **options)


def features_session_product(
    per_product: DataFrame, per_session: DataFrame, heavy_limit: int = HEAVY_GROUP_ROWS,
    session_level: bool = False,
) -> DataFrame:
    """Product rows with their session's features and the user's earlier views of the product,
    with `session_level` those in earlier sessions only.

    Runs jobs when called: both inputs are written by buckets (`joined_steps`), and pairs of user
    and product with too many rows for one task, which need another way, are counted there.
    """
    joined = joined_steps(per_product, per_session, heavy_limit)
    heavy = heavy_keys(joined, [USER, PRODUCT], heavy_limit)
    return with_product_history(
        joined, running_total, session_level, heavy=heavy, limit=heavy_limit
    )


def joined_steps(
    per_product: DataFrame, per_session: DataFrame, heavy_limit: int = HEAVY_GROUP_ROWS
) -> DataFrame:
    """Product rows with their session's features.

    Both inputs are computed once and written by buckets of the session, so that neither this join
    nor what counts its rows shuffles them.  Should a session have too many product rows for one
    bucket, the same files are joined by a shuffle, which adaptive execution splits.  Rows without
    a session join nothing and are left out before.
    """
    has_session = F.col(SESSION).isNotNull()
    left = bucketed(per_product.where(has_session), "per-product", [SESSION])
    right = bucketed(per_session.where(has_session), "per-session", [SESSION])
    if heavy_keys(left, [SESSION], heavy_limit) is not None:
        read = left.sparkSession.read
        left, right = (read.schema(x.schema).parquet(x.written_to) for x in (left, right))
    return left.join(right, SESSION).select(
        SESSION, *[x for x in left.columns if x != SESSION], *[x for x in right.columns if x != SESSION]
    )


def with_product_history(joined: DataFrame, total, session_level: bool = False, **options) -> DataFrame:
    """Views in earlier rows or, `session_level`, in earlier sessions only: variants of a product
    in one session then do not see each other."""
    return total(
        joined,
        [USER, PRODUCT],
        PRODUCT_ORDER,
        F.col("num_views_product"),
        "num_prev_product_views",
        apart=len(SESSION_ORDER) if session_level else 0,
        **options,
    )


def composed_features(
    rows: DataFrame, total=sliced_total, session_level: bool = False, **options
) -> DataFrame:
    """All three steps on visits of cleaned events, with the given running total."""
    per_product = rows.where(TOUCHED).drop(USER, TOUCHED, FIRST, LAST)
    joined = per_product.join(_numbered(spans_of_visits(rows), total, **options), SESSION)
    return with_product_history(joined, total, session_level, **options).drop(START, END)
