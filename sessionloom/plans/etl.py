"""Batch runs: monthly files in, verified CSV out."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sessionloom.operators import HEAVY_GROUP_ROWS, History, views
from sessionloom.session import build_session, drop_tables, materialise, new_path
from sessionloom.sinks import write_verified
from sessionloom.sources import check_range, land_pending, read_landed, read_typed, sample_sessions

from .table import feature_table


@dataclass(frozen=True)
class RunConfig:
    """What a run reads, computes and writes.  Paths are any Hadoop file system's."""

    raw_dir: str
    start: str
    end: str
    destination: str = "data/processed"
    zone_dir: str | None = None  # where months stay landed for later runs; None: for this run
    sample: float | None = None  # debug mode: share of the sessions
    tolerated: float = 0.01  # share of broken raw records above which the run stops
    rows_per_file: int | None = None  # None: files are sized by bytes
    compression: str | None = None
    heavy_limit: int = HEAVY_GROUP_ROWS
    history_dir: str | None = None  # totals of earlier runs, extended by this one; None: none
    session_level: bool = False  # earlier views are those of earlier sessions only


MINIMAL_COLUMNS = ["event_time", "brand", "price", "user_id"]


@dataclass(frozen=True)
class MinimalConfig:
    raw_path: str
    destination: str


def etl_run(spark: SparkSession, config: RunConfig) -> dict:
    """Extract, transform, load.  Any failure raises, an incomplete load included.

    Text is parsed once, by landing the months of the range.  The report has the rows loaded,
    cleaned, in range, aggregated to visits, and written, all counted by the jobs themselves.
    """
    check_range(config.start, config.end)
    zone_dir = config.zone_dir or new_path(spark, "zone")
    landed = land_pending(
        spark, config.raw_dir, zone_dir, config.start, config.end, config.tolerated
    )
    logging.info("landed: %s", landed)

    events = read_landed(spark, zone_dir, config.start, config.end)
    if config.sample is not None:
        events = sample_sessions(events, config.sample)
    counts: dict[str, int] = {}
    history = History(spark, config.history_dir) if config.history_dir else None
    features = feature_table(
        events, config.start, config.end, config.heavy_limit, counts, history, config.session_level
    )
    logging.info("rows: %s", counts)

    report = write_verified(features, config.destination, config.compression, config.rows_per_file)
    logging.info("%s rows in %s files", report["rows"], report["files"])
    return {"landed": landed, "counts": counts, **report}


def etl_cloud_min(spark: SparkSession, config: MinimalConfig) -> dict:
    """The smallest run: all views, four columns, CSV; checked like any other."""
    events = read_typed(spark, config.raw_path)
    return write_verified(views(events).select(MINIMAL_COLUMNS), config.destination)


def first_views(events: DataFrame, rows: int, order: Sequence[str]) -> DataFrame:
    """The first `rows` views by `order`."""
    return views(events).select(MINIMAL_COLUMNS).orderBy(*order).limit(rows)


def computed_once(df: DataFrame, reused: bool) -> DataFrame:
    """`df` as a table in the shared folder if it is `reused`, so that it is computed once.

    For work that reads `df` in several branches; `feature_table` reads its events in one and
    needs none.
    """
    return materialise(df, "computed-once") if reused else df


def main(arguments: list[str] | None = None) -> int:
    """Command line run; the exit code is 1 on any failure."""
    parser = argparse.ArgumentParser(description=etl_run.__doc__)
    parser.add_argument("--raw-dir", required=True)
    parser.add_argument("--date-start", required=True, help="YYYY-MM-DD HH:MM:SS")
    parser.add_argument("--date-end", required=True, help="YYYY-MM-DD HH:MM:SS, inclusive")
    parser.add_argument("--destination", default=RunConfig.destination)
    parser.add_argument("--zone-dir")
    parser.add_argument("--sample", type=float, help="debug mode: share of the sessions")
    parser.add_argument("--tolerated", type=float, default=RunConfig.tolerated, help="share of broken records")
    parser.add_argument("--compression")
    parser.add_argument("--rows-per-file", type=int)
    parser.add_argument("--heavy-limit", type=int, default=RunConfig.heavy_limit)
    parser.add_argument("--history-dir", help="totals of earlier runs, extended by this one")
    parser.add_argument("--session-level", action="store_true", help="earlier views only of earlier sessions")
    given = parser.parse_args(arguments)
    config = RunConfig(
        raw_dir=given.raw_dir.rstrip("/"),
        start=given.date_start,
        end=given.date_end,
        destination=given.destination.rstrip("/"),
        zone_dir=given.zone_dir and given.zone_dir.rstrip("/"),
        sample=given.sample,
        tolerated=given.tolerated,
        compression=given.compression,
        rows_per_file=given.rows_per_file,
        heavy_limit=given.heavy_limit,
        history_dir=given.history_dir and given.history_dir.rstrip("/"),
        session_level=given.session_level,
    )
    logging.basicConfig(level=logging.INFO, format="%(asctime)s: %(message)s")
    spark = build_session()
    try:
        etl_run(spark, config)
    except Exception:
        logging.exception("run failed")
        return 1
    finally:
        drop_tables(spark)
    return 0
