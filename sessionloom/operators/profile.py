"""Data profiling: each report reads the events once; those on shared sessions or on the feature
table add the passes that these take."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions import is_product_event
from sessionloom.schema import PRODUCT, PRODUCT_ATTRIBUTES, SESSION, USER
from sessionloom.session import materialise

from .clean import is_shared, since, until, user_spread
from .features import START, joined_steps, with_product_history
from .history import HEAVY_GROUP_ROWS, heavy_keys, running_total, with_keys


def step_counts(
    events: DataFrame, start: str | datetime | None = None, end: str | datetime | None = None
) -> DataFrame:
    """Rows loaded, without shared sessions, within the range too, and product rows of those.

    One pass over the events, besides the one for the list of shared sessions: each event is
    flagged, events are counted per product row and flags, and those counts are added up.
    """
    bad = materialise(
        user_spread(events).where(is_shared()).select(SESSION, F.lit(True).alias("_shared")),
        "shared-sessions",
    )
    ranges = [since(start)] if start is not None else []
    ranges += [until(end)] if end is not None else []
    inside = F.coalesce(reduce(and_, ranges, F.lit(True)), F.lit(False))
    touched = F.coalesce(is_product_event(), F.lit(False))
    keys = [F.when(touched, F.col(name)).alias(name) for name in (PRODUCT, *PRODUCT_ATTRIBUTES, SESSION)]
    flagged = events.join(bad, SESSION, "left")
    grouped = flagged.groupBy(
        F.col("_shared").isNull().alias("_clean"), inside.alias("_inside"), touched.alias("_touched"), *keys
    ).agg(F.count(F.lit(1)).alias("_rows"))
    kept = F.col("_clean") & F.col("_inside")
    none = F.lit(0).cast("long")
    counts = grouped.agg(
        F.coalesce(F.sum("_rows"), none).alias("loaded"),
        F.coalesce(F.sum(F.when(F.col("_clean"), F.col("_rows"))), none).alias("of one user"),
        F.coalesce(F.sum(F.when(kept, F.col("_rows"))), none).alias("in range"),
        F.count_if(kept & F.col("_touched")).alias("product rows"),
    )
    return counts.unpivot([], counts.columns, "step", "row_count")


def non_null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count(name).alias(name) for name in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])


def approx_distinct(df: DataFrame, fields: list[str], rsd: float = 0.05) -> DataFrame:
    return df.agg(*[F.approx_count_distinct(name, rsd).alias(name) for name in fields])


def approx_distinct_holds(df: DataFrame, fields: list[str], rsd: float = 0.05) -> DataFrame:
    """Whether each field's estimate lies within three standard deviations of the exact count."""
    flags = []
    for name in fields:
        estimate, exact = F.approx_count_distinct(name, rsd), F.count_distinct(name)
        flags.append((F.abs(estimate - exact) <= 3 * rsd * exact).alias(name))
    return df.agg(*flags).unpivot([], fields, "field", "holds")


def top_values(df: DataFrame, fields: list[str], k: int = 5) -> DataFrame:
    """The `k` most frequent values of each field, null being a value; ties by value.

    All fields are counted in one pass, and the ranking keeps only `k` rows per field and task
    before it shuffles.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value")) for n in fields])
    )
    counts = (
        df.select(pairs.alias("pair")).select("pair.*")
        .groupBy("field", "value").count()
        .withColumnRenamed("count", "frequency")
    )
    by_frequency = Window.partitionBy("field").orderBy(
        F.col("frequency").desc(), F.col("value").asc_nulls_first()
    )
    return (
        counts.withColumn("_rank", F.row_number().over(by_frequency))
        .where(F.col("_rank") <= k)
        .drop("_rank")
    )


def frequent_values(df: DataFrame, fields: list[str], k: int = 5, buckets: int = 1 << 16) -> DataFrame:
    """The rows of `top_values`, for fields of very many values, of which few are shuffled.

    Rows are first counted by hash buckets of the values, a summary of fixed size that tasks add
    up.  A value occurs at most as often as its bucket.  The values of the fullest buckets are
    counted, and the k-th count among them is one that a top value reaches; so only values of
    buckets that reach it are counted, exactly.  Reads the fields three times and runs jobs.
    """
    listed = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value")) for n in fields
    ])).alias("pair")).select("pair.*")
    listed = listed.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    loads = materialise(listed.groupBy("field", "bucket").agg(F.count(F.lit(1)).alias("load")), "bucket-loads")

    def ranked(counts: DataFrame, by: str, ties: str) -> DataFrame:
        best = Window.partitionBy("field").orderBy(F.col(by).desc(), F.col(ties).asc_nulls_first())
        return counts.withColumn("_rank", F.row_number().over(best))

    def counted(among: DataFrame) -> DataFrame:
        kept = listed.join(among.select("field", "bucket"), ["field", "bucket"], "left_semi")
        return kept.groupBy("field", "value").agg(F.count(F.lit(1)).alias("frequency"))

    fullest = materialise(ranked(loads, "load", "bucket").where(F.col("_rank") <= 4 * k), "fullest-buckets")
    reached = ranked(counted(fullest), "frequency", "value").where(F.col("_rank") == k)
    reached = materialise(reached.select("field", F.col("frequency").alias("least")), "reached")
    among = materialise(
        loads.join(reached, "field", "left").where(F.col("load") >= F.coalesce("least", F.lit(0))), "full-buckets"
    )
    return ranked(counted(among), "frequency", "value").where(F.col("_rank") <= k).drop("_rank")


def top_values_wide(
    df: DataFrame, field: str, k: int = 5, null_label: str = "null", values: list[str | None] | None = None
) -> DataFrame:
    """`top_values` of one field as a single row with one column per value.

    The null group gets a label first, since a transposition would drop it; it is lengthened by
    underscores while a value is spelled like it.  Only the `k` values reach the driver.

    `values` fixes the columns, whatever the data: those values in their order, None being null,
    with a null frequency for what is not among the first `k`.  Nothing reaches the driver then.
    """
    if values is None:
        top = materialise(top_values(df, [field], k), "top-values")
        found = {row["value"] for row in top.select("value").collect()}
    else:
        top, found = top_values(df, [field], k), set(values)
    while null_label in found:
        null_label += "_"
    if values is not None:
        return top.agg(F.lit("frequency").alias(field), *[
            F.max(F.when(F.col("value").eqNullSafe(F.lit(value)), F.col("frequency"))).alias(
                null_label if value is None else value
            )
            for value in values
        ])
    named = top.select(F.coalesce("value", F.lit(null_label)).alias(field), "frequency")
    return named.transpose(F.col(field)).withColumnRenamed("key", field)


def dup_impact(events: DataFrame) -> DataFrame:
    """How many events, and what share, belong to multi-user sessions.

    Adds up counts per session instead of joining the events with a list of sessions.
    """
    to_delete = F.coalesce(F.sum(F.when(is_shared(), F.col("rows"))), F.lit(0))
    return user_spread(events).agg(
        to_delete.alias("rows_to_delete"),
        (to_delete / F.sum("rows") * 100).alias("percent_to_delete"),
    )


def top_pair(features: DataFrame) -> DataFrame:
    """The user and product with most feature rows; ties by user, then product."""
    return (
        features.groupBy(USER, PRODUCT).count()
        .orderBy(F.col("count").desc(), USER, PRODUCT)
        .limit(1)
    )


def top_pair_history(
    per_product: DataFrame, per_session: DataFrame, heavy_limit: int = HEAVY_GROUP_ROWS
) -> DataFrame:
    """The history features of the top pair, to check them by eye.

    The pair is found in the keys of the joined steps, and the running total is computed for its
    rows alone.  It stays a one-row DataFrame; nothing passes through the driver.
    """
    joined = joined_steps(per_product, per_session, heavy_limit)
    pair = materialise(top_pair(joined).select(USER, PRODUCT), "top-pair")
    rows = with_keys(joined, pair)
    heavy = heavy_keys(rows, [USER, PRODUCT], heavy_limit)
    history = with_product_history(rows, running_total, heavy=heavy, limit=heavy_limit)
    return history.select(
        "num_prev_sessions", "num_views_product", "num_prev_product_views", "start_time", START
    )
