"""Distinct counts from what is stored with each landed month: sketches, which estimate, and the
distinct values, which give the exact count."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.schema import LANDED_SCHEMA, MONTH
from sessionloom.session import list_names
from sessionloom.sources.landing import SKETCHES, VALUES, landed_months
from sessionloom.sources.months import month_names, months_in_range, require_months

# Registers of a sketch as a power of two: 64 KB at most, a standard error of 0.4 %.
LOG_SIZE = 16


# Standard errors by which an estimate may differ from the exact count.
TOLERATED_ERRORS = 6


def sketched_months(spark: SparkSession, zone_dir: str) -> list[str]:
    return [name.removeprefix(f"{MONTH}=") for name in list_names(spark, f"{zone_dir}/{SKETCHES}/{MONTH}=*")]


def valued_months(spark: SparkSession, zone_dir: str) -> list[str]:
    return [name.removeprefix(f"{MONTH}=") for name in list_names(spark, f"{zone_dir}/{VALUES}/{MONTH}=*")]


def sketch_pending(
    spark: SparkSession, zone_dir: str, fields: list[str], log_size: int = LOG_SIZE
) -> list[str]:
    """Store a sketch of each field's values for the landed months that have none; returns them.

    One pass over those months that reads the fields only.  Sketches are combined within tasks,
    so one row per task and month is shuffled.  A month that is sketched again is replaced whole.
    """
    names = sorted(set(landed_months(spark, zone_dir)) - set(sketched_months(spark, zone_dir)))
    if not names:
        return []
    events = spark.read.schema(LANDED_SCHEMA).parquet(zone_dir).where(F.col(MONTH).isin(names))
    sketches = events.groupBy(MONTH).agg(
        *[F.hll_sketch_agg(F.col(name).cast("string"), F.lit(log_size)).alias(name) for name in fields]
    )
    # Months without events have no row, but are sketched too.
    listed = spark.createDataFrame([(name,) for name in names], f"{MONTH} string")
    sketches = listed.join(sketches, MONTH, "left")
    (
        sketches.unpivot([MONTH], fields, "field", "sketch").repartition(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH).parquet(f"{zone_dir}/{SKETCHES}")
    )
    return names


def distinct_in_months(
    spark: SparkSession, zone_dir: str, start: str | datetime, end: str | datetime
) -> DataFrame:
    """field, distinct: estimates for the months that a date range touches, whole.

    Reads sketches and no events.  Up to some thousand values a sketch holds their hashes, and the
    estimate is the count; beyond, the standard error is that of LOG_SIZE.  Nulls do not count.
    A month without sketches raises.
    """
    names = month_names(months_in_range(spark, start, end))
    require_months(names, sketched_months(spark, zone_dir))
    stored = spark.read.schema(f"field string, sketch binary, {MONTH} string").parquet(f"{zone_dir}/{SKETCHES}")
    union = stored.where(F.col(MONTH).isin(names)).groupBy("field").agg(F.hll_union_agg("sketch").alias("sketch"))
    return union.select("field", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("distinct"))


def values_pending(spark: SparkSession, zone_dir: str, fields: list[str]) -> list[str]:
    """Store the distinct values of each field for the landed months that have none; returns them.

    One pass over those months that reads the fields only.  Tasks drop repeated values before they
    shuffle.  A month that is listed again is replaced whole.
    """
    names = sorted(set(landed_months(spark, zone_dir)) - set(valued_months(spark, zone_dir)))
    if not names:
        return []
    events = spark.read.schema(LANDED_SCHEMA).parquet(zone_dir).where(F.col(MONTH).isin(names))
    listed = events.select(MONTH, F.explode(F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("value")) for name in fields
    ])).alias("pair")).select(MONTH, "pair.*")
    # A null for each month and field: months without values have a folder too.
    shape = f"{MONTH} string, field string, value string"
    none = spark.createDataFrame([(month, field, None) for month in names for field in fields], shape)
    (
        listed.union(none).distinct()
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH).parquet(f"{zone_dir}/{VALUES}")
    )
    return names


def exact_distinct_in_months(
    spark: SparkSession, zone_dir: str, start: str | datetime, end: str | datetime, log_size: int = LOG_SIZE
) -> DataFrame:
    """field, distinct: the rows of `distinct_in_months` with exact counts.

    Reads the months' sketches and distinct values, and no events; a value is shuffled once for
    each month that has it.  The sketches check the values: if an estimate is further from the
    count than TOLERATED_ERRORS standard errors (of sketches of `log_size`), the two are not of the
    same events, which raises.  So does a month without either, or a field without values.
    """
    names = month_names(months_in_range(spark, start, end))
    require_months(names, valued_months(spark, zone_dir))
    stored = spark.read.schema(f"field string, value string, {MONTH} string").parquet(f"{zone_dir}/{VALUES}")
    exact = stored.where(F.col(MONTH).isin(names)).groupBy("field").agg(F.count_distinct("value").alias("exact"))
    error = TOLERATED_ERRORS * 1.04 / 2 ** (log_size / 2)
    holds = F.abs(F.col("distinct") - F.col("exact")) <= 1 + error * F.col("exact")
    unlike = F.raise_error(F.concat(F.lit("sketches and values differ: "), F.col("field"))).cast("long")
    return distinct_in_months(spark, zone_dir, start, end).join(exact, "field", "left").select(
        "field", F.when(holds, F.col("exact")).otherwise(unlike).alias("distinct")
    )
