"""Landing of monthly files in a typed, columnar zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sessionloom.schema import EVENT_DATE, EVENT_TIME, LANDED_SCHEMA, MONTH, RAW_COLUMNS
from sessionloom.session import file_stamps, list_names, observed, remove, touch

from .events import BROKEN, read_checked, typed_columns
from .months import (
    listed_months, missing_months, month_frame, month_names, months_in_range, require_months,
)

_MONTH_IN_PATH = r"/(\d{4}-[A-Z][a-z]{2})\.csv"

# Spark's readers skip folders with a leading underscore.
_MARKERS = "_landed"
_REJECTS = "_rejects"
# Names of files here are a month and the length and time of the file that it was landed from.
_DELIVERED = "_delivered"
SKETCHES = "_sketches"
VALUES = "_values"


class TooManyBrokenError(ValueError):
    """A larger share of the raw records than tolerated has too few or too many fields."""


def landed_months(spark: SparkSession, zone_dir: str) -> list[str]:
    return listed_months(spark, f"{zone_dir}/{_MARKERS}/*")


def _delivered_again(spark: SparkSession, zone_dir: str, given: dict[str, str]) -> list[str]:
    """Landed months whose raw file is there and is not the one that they were landed from."""
    known = dict(name.split(".", 1) for name in list_names(spark, f"{zone_dir}/{_DELIVERED}/*"))
    landed = landed_months(spark, zone_dir)
    return [name for name in landed if name in known and given.get(f"{name}.csv", known[name]) != known[name]]


def land_pending(
    spark: SparkSession, raw_dir: str, zone_dir: str, start: str | datetime, end: str | datetime,
    tolerated: float = 0.01,
) -> dict:
    """Bring the months of the range that are not landed yet into `zone_dir`.

    The zone is Parquet partitioned by file month: text is parsed once, and later jobs read only
    the columns they need.  Events carry their day as a column and are ordered by time within
    each task's file, so that row groups outside a range are skipped: Spark uses the statistics
    of dates for that, but not those of zone-less timestamps.

    Each task writes the month of the file split it reads, so nothing is shuffled.  A month
    counts as landed once its marker is there, which is set after the whole write; a run that
    broke off lands the month again, replacing what it had written.  So does a file that was
    delivered again: one whose length or time is not that of the file the month was landed from.
    What is known of the month besides, its sketches and values, goes then too.

    A record with too few or too many fields, such as one half of a text with a line break, is no
    event.  Such records go to the folder `_rejects` of the zone, by month, as JSON with their
    text and what could be read of it; if they are
    more than the share `tolerated`, this raises and no month counts as landed.  A time or price
    that does not parse becomes null.  Reported: months, rows, of these `rejected` (with such a
    time or price), and `broken` records.
    """
    required = months_in_range(spark, start, end)
    landed = month_frame(spark, landed_months(spark, zone_dir))
    names = month_names(missing_months(required, landed))
    given = file_stamps(spark, f"{raw_dir}/*.csv")
    anew = [name for name in _delivered_again(spark, zone_dir, given) if name in month_names(required)]
    for name in anew:
        folders = (f"{part}{MONTH}={name}" for part in (f"{SKETCHES}/", f"{VALUES}/", "", f"{_REJECTS}/"))
        for part in (f"{_MARKERS}/{name}", *folders):
            remove(spark, f"{zone_dir}/{part}")
    names = sorted({*names, *anew})
    if not names:
        return {"months": [], "rows": 0, "rejected": 0, "broken": 0}
    require_months(names, listed_months(spark, f"{raw_dir}/*.csv"))

    raw = read_checked(spark, [f"{raw_dir}/{name}.csv" for name in names])
    month = F.regexp_extract(F.col("_metadata.file_path"), _MONTH_IN_PATH, 1)
    written = F.struct(F.col(EVENT_TIME).isNotNull().alias("time"), F.col("price").isNotNull().alias("price"))
    whole = F.col(BROKEN).isNull()
    unparsed = (F.col("_given.time") & F.col(EVENT_TIME).isNull()) | (
        F.col("_given.price") & F.col("price").isNull()
    )
    seen = Observation()
    events = (
        raw.select(*typed_columns(raw.select(RAW_COLUMNS)), month.alias(MONTH), written.alias("_given"), BROKEN)
        .observe(
            seen, F.count_if(whole).alias("rows"), F.count_if(whole & unparsed).alias("rejected"),
            F.count_if(~whole).alias("broken"),
        )
        .where(whole).drop("_given", BROKEN)
        .withColumn(EVENT_DATE, F.col(EVENT_TIME).cast("date"))
        .sortWithinPartitions(MONTH, EVENT_TIME)
    )
    (
        events.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(zone_dir)
    )
    report = {"rows": 0, "rejected": 0, "broken": 0} | observed(seen)
    if report["broken"]:
        broken = raw.select("*", month.alias(MONTH)).where(~whole)
        broken.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).json(
            f"{zone_dir}/{_REJECTS}"
        )
        if report["broken"] > tolerated * (report["rows"] + report["broken"]):
            raise TooManyBrokenError(f"{report['broken']} of the raw records are broken")
    for name in names:
        for old in list_names(spark, f"{zone_dir}/{_DELIVERED}/{name}.*"):
            remove(spark, f"{zone_dir}/{_DELIVERED}/{old}")
        touch(spark, f"{zone_dir}/{_DELIVERED}/{name}.{given[f'{name}.csv']}")
        touch(spark, f"{zone_dir}/{_MARKERS}/{name}")
    return {"months": names, **report}


def read_landed(
    spark: SparkSession, zone_dir: str, start: str | datetime, end: str | datetime
) -> DataFrame:
    """Events of the months a date range touches; other months are pruned unread.

    Keeps the event day, by which `operators.date_range` prunes further.
    """
    names = month_names(months_in_range(spark, start, end))
    require_months(names, landed_months(spark, zone_dir))
    landed = spark.read.schema(LANDED_SCHEMA).parquet(zone_dir)
    return landed.where(F.col(MONTH).isin(names)).drop(MONTH)
