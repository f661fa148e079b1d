"""The feature table: one row per session, product and product attributes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sessionloom.functions import as_flag
from sessionloom.operators.clean import clean_sessions, date_range
from sessionloom.operators.features import (
    END, FIRST, LAST, PRODUCT_ORDER, SESSION_ORDER, START, TOUCHED, composed_features, describe_sessions,
    visits,
)
from sessionloom.operators.history import (
    HEAVY_GROUP_ROWS, earlier_sum, heavy_keys, with_keys, without_keys,
)
from sessionloom.operators.snapshot import SESSIONS, VIEWS, History
from sessionloom.schema import FEATURE_COLUMNS, PRODUCT, SESSION, USER
from sessionloom.session import materialise, observed


def feature_table(
    events: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    heavy_limit: int = HEAVY_GROUP_ROWS,
    counts: dict[str, int] | None = None,
    history: History | None = None,
    session_level: bool = False,
) -> DataFrame:
    """Cleaned, date-limited events as training rows.

    Cleaning looks at all given events, so a session whose second user appears outside the
    range is removed too.  Spans and history only see the range.

    Events are read twice, in jobs that run when this is called: the columns of session and user
    for the list of shared sessions, and once for the visits, which are written.  Everything else
    reads the visits: the count of their rows per user, the windows, and, for users with more
    than `heavy_limit` rows, the steps that divide them between tasks.

    With `history` earlier sessions and views also count those of ranges that were run before this
    one, without their events: totals stored by those runs come in as rows of each user before all
    others, and this range's are stored for the next.  Both bounds must be given.  A session on
    both sides of a bound is one in each range, as it is for any range.  `session_level` counts
    views of earlier sessions only, so that variants of a product in one session do not see each
    other.

    `counts` gets the rows after each step: loaded, cleaned, in_range (those with a session) and
    visits.
    """
    seen = Observation()
    cleaned = clean_sessions(events, counts).where(F.col(SESSION).isNotNull())
    in_range = date_range(cleaned, start, end)
    if counts is not None:
        in_range = in_range.observe(seen, F.count(F.lit(1)).alias("in_range"))
    rows = materialise(visits(in_range), "visits")
    if counts is not None:
        counts["in_range"] = observed(seen).get("in_range", 0)
        counts["visits"] = rows.count()
    before = None
    if history is not None:
        if start is None or end is None:
            raise ValueError("history needs both bounds of the range")
        before = history.before(start, end)
        history.extend(rows, start, end)
    heavy = heavy_keys(rows, [USER], heavy_limit)
    if heavy is None:
        return _by_user(rows, before, session_level)
    light = before and tuple(without_keys(part, heavy) for part in before)
    large = composed_features(with_keys(rows, heavy), session_level=session_level, limit=heavy_limit)
    large = large.select(FEATURE_COLUMNS)
    if before is not None:
        large = _with_totals(large, *(with_keys(part, heavy) for part in before))
    return _by_user(without_keys(rows, heavy), light, session_level).unionByName(large)


def _with_totals(features: DataFrame, sessions: DataFrame, views: DataFrame) -> DataFrame:
    """Features of heavy users with earlier totals added, by joins that can be split."""
    same = features[USER].eqNullSafe(sessions[USER])
    joined = features.join(sessions, same, "left").drop(sessions[USER])
    same = joined[USER].eqNullSafe(views[USER]) & joined[PRODUCT].eqNullSafe(views[PRODUCT])
    joined = joined.join(views, same, "left").drop(views[USER], views[PRODUCT])
    plus = lambda name, more: F.col(name) + F.coalesce(more, F.lit(0))
    return joined.withColumns({
        "num_prev_sessions": plus("num_prev_sessions", SESSIONS),
        "num_prev_product_views": plus("num_prev_product_views", VIEWS),
    }).select(FEATURE_COLUMNS)


def _by_user(
    rows: DataFrame, before: tuple[DataFrame, DataFrame] | None = None, session_level: bool = False
) -> DataFrame:
    """All features of visits from a single partitioning by user.

    After cleaning a session has one user, so session spans, session counts and product
    history all stay within a user.  Earlier totals join in as rows without a session or times,
    which sort before all others and give no feature rows.
    """
    earlier: Column = F.lit(0)
    if before is not None:
        sessions, views = before
        views = views.select(USER, PRODUCT, F.col(VIEWS).alias("num_views_product"))
        rows = rows.unionByName(sessions, allowMissingColumns=True).unionByName(views, allowMissingColumns=True)
        rows = rows.withColumn("num_views_product", F.coalesce("num_views_product", F.lit(0)))
        earlier = F.coalesce(F.sum(SESSIONS).over(Window.partitionBy(USER)), F.lit(0))
    rows = rows.repartition(USER)
    session = Window.partitionBy(USER, SESSION)
    variants = Window.partitionBy(USER, SESSION, PRODUCT).orderBy(F.col("num_views_product").desc())
    sessions_so_far = Window.partitionBy(USER).orderBy(START, SESSION)
    # One variant of each viewed product stands for it in the session's count.
    stands_for_product = (
        (F.row_number().over(variants) == 1)
        & (F.col("num_views_product") > 0)
        & F.col(PRODUCT).isNotNull()
    )
    spans = rows.withColumn("_counts", as_flag(stands_for_product)).withColumns(
        {
            "num_views_session": F.coalesce(F.sum("_counts").over(session), F.lit(0)),
            START: F.min(FIRST).over(session),
            END: F.max(LAST).over(session),
        }
    )
    # Totals from before are one session more, the first.
    rank = F.dense_rank().over(sessions_so_far) - 1
    if before is not None:
        rank = rank - F.max(F.col(SESSION).isNull().cast("int")).over(Window.partitionBy(USER))
    history = spans.withColumns(
        {
            "num_prev_sessions": (rank + earlier).cast("long"),
            "num_prev_product_views": earlier_sum(
                [USER, PRODUCT], PRODUCT_ORDER, F.col("num_views_product"),
                len(SESSION_ORDER) if session_level else 0,
            ),
        }
    )
    return describe_sessions(history.where(TOUCHED)).select(FEATURE_COLUMNS)
