"""Monthly files: which ones a date range needs and which are missing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions import month_label
from sessionloom.session import list_names

BOUND_FORMAT = "%Y-%m-%d %H:%M:%S"


class MissingMonthsError(FileNotFoundError):
    """Months of the requested range have no file."""


def parse_bound(bound: str | datetime | None) -> datetime | None:
    """A date bound in UTC, 'YYYY-MM-DD HH:MM:SS' with an optional ' UTC' suffix."""
    if isinstance(bound, datetime) and bound.tzinfo is not None:
        return bound.astimezone(timezone.utc).replace(tzinfo=None)
    if bound is None or isinstance(bound, datetime):
        return bound
    try:
        return datetime.strptime(bound.removesuffix(" UTC"), BOUND_FORMAT)
    except ValueError as error:
        raise ValueError(f"the date bound {bound!r} is not spelled YYYY-MM-DD HH:MM:SS") from error


def check_range(start: str | datetime, end: str | datetime) -> tuple[datetime, datetime]:
    """Parsed bounds; an empty range (start = end) is allowed, a reversed one is not."""
    first, last = parse_bound(start), parse_bound(end)
    if first is None or last is None:
        raise ValueError("both date bounds are needed to choose monthly files")
    if first > last:
        raise ValueError("the start date must not be after the end date")
    return first, last


def months_covering(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """One row per calendar month touched by a row's [start, end], as file labels.

    Steps from month start to month start, so a range opening late in its first month
    still includes its last month.
    """
    steps = F.sequence(
        F.trunc(F.col(start).cast("date"), "MM"),
        F.trunc(F.col(end).cast("date"), "MM"),
        F.expr("interval 1 month"),
    )
    return (
        ranges.select(F.explode(steps).alias("_month"))
        .select(month_label(F.col("_month")).alias("month"))
        .distinct()
    )


def months_in_range(spark: SparkSession, start: str | datetime, end: str | datetime) -> DataFrame:
    first, last = check_range(start, end)
    bounds = spark.range(1).select(
        F.lit(first.isoformat(" ")).cast("timestamp_ntz").alias("start"),
        F.lit(last.isoformat(" ")).cast("timestamp_ntz").alias("end"),
    )
    return months_covering(bounds, "start", "end")


def listed_months(spark: SparkSession, pattern: str) -> list[str]:
    """Months found by listing `pattern`, a path whose '*' stands for the month label."""
    prefix, suffix = pattern.rsplit("/", 1)[1].split("*")
    return [name.removeprefix(prefix).removesuffix(suffix) for name in list_names(spark, pattern)]


def month_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(name,) for name in names], "month string")


def missing_months(required: DataFrame, present: DataFrame) -> DataFrame:
    return required.join(present, "month", "left_anti")


def month_names(months: DataFrame) -> list[str]:
    """Month labels on the driver: one per calendar month of the range, whatever the data."""
    return sorted(row["month"] for row in months.collect())


def require_months(required: list[str], present: list[str]) -> None:
    missing = [name for name in required if name not in present]
    if missing:
        raise MissingMonthsError(f"no source file for: {', '.join(missing)}")
