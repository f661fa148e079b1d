"""Readers for raw event files (CSV with a header)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions import parse_event_time, utc_wall_clock
from sessionloom.schema import EVENT_SCHEMA, EVENT_TIME, RAW_SCHEMA, SESSION, USER

BROKEN = "_broken_record"


def read_strings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All columns as text.  The header of each file must name the documented columns."""
    return (
        spark.read.schema(RAW_SCHEMA)
        .option("enforceSchema", False)
        .csv(paths, header=True)
    )


def read_checked(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`read_strings` with a column that holds a record's text if it has too few or too many
    fields, and is null otherwise."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(BROKEN, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", BROKEN)
        .csv(paths, header=True)
    )


def read_inferred(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Types inferred by Spark, which costs a second pass over the files."""
    return spark.read.csv(paths, header=True, inferSchema=True)


def read_typed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return typed(read_strings(spark, paths))


def typed(raw: DataFrame) -> DataFrame:
    """Event columns in their types; text that does not parse becomes null (see `rejected`).

    Takes text columns as read from files as well as already typed ones.
    """
    return raw.select(typed_columns(raw))


def typed_columns(raw: DataFrame) -> list[Column]:
    columns = []
    for field in EVENT_SCHEMA:
        column, given = F.col(field.name), raw.schema[field.name].dataType
        if field.name == EVENT_TIME and isinstance(given, T.StringType):
            column = parse_event_time(column)
        elif field.name == EVENT_TIME and isinstance(given, T.TimestampType):
            column = utc_wall_clock(column)
        elif given != field.dataType:
            column = column.try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return columns


def unparsable() -> Column:
    """An event time or price in a text row that is present but does not parse."""
    bad_time = F.col(EVENT_TIME).isNotNull() & parse_event_time(F.col(EVENT_TIME)).isNull()
    bad_price = F.col("price").isNotNull() & F.col("price").try_cast("double").isNull()
    return bad_time | bad_price


def rejected(raw: DataFrame) -> DataFrame:
    return raw.where(unparsable())


def in_sample(fraction: float) -> Column:
    """Whether an event belongs to a sample of about that share of the sessions.

    Decided by a hash of the session, so a session is in it as a whole, in every run.  Events
    without a session are drawn by their user.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"a sample takes a share between 0 and 1, not {fraction}")
    drawn = F.substring(F.md5(F.coalesce(F.col(SESSION), F.col(USER), F.lit(""))), 1, 8)
    # Compared as numbers of eight hexadecimal digits; "g" comes after all of them.
    below = F.lit(f"{int(fraction * 16**8):08x}" if fraction < 1 else "g")
    return drawn < below


def sample_sessions(events: DataFrame, fraction: float) -> DataFrame:
    """Debug mode: a share of the sessions, each with all its events."""
    return events.where(in_sample(fraction))
