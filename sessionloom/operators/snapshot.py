"""History from before the range: totals of users and products that outlast a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.schema import PRODUCT, SESSION, USER
from sessionloom.session import exists, list_names, touch
from sessionloom.sources.months import parse_bound

SESSIONS, VIEWS = "sessions_before", "views_before"
_STAMP = "%Y%m%dT%H%M%S"


class OverlappingHistory(ValueError):
    """The range of a run meets one whose history is stored already."""


class History:
    """Sessions of each user and views of each product by each user, stored by range.

    Every run adds what its own range holds, under a folder named by the range, so a run that is
    repeated replaces its own part and nothing is counted twice; a part counts once its marker is
    there.  Nothing stored is ever read to be extended.  `before` adds up the parts that end
    before a range: one row per user, and per user and product, that had any.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def ranges(self) -> list[tuple[datetime, datetime]]:
        """The ranges of finished parts, in order."""
        names = [name for name in list_names(self.spark, f"{self.path}/*_*") if exists(self.spark, f"{self.path}/{name}/_DONE")]
        return sorted(tuple(datetime.strptime(x, _STAMP) for x in name.split("_")) for name in names)

    def _folder(self, start: datetime, end: datetime) -> str:
        return f"{self.path}/{start.strftime(_STAMP)}_{end.strftime(_STAMP)}"

    def _checked(self, start: str | datetime, end: str | datetime) -> tuple[datetime, datetime]:
        own = parse_bound(start), parse_bound(end)
        for other in self.ranges():
            if other != own and other[0] <= own[1] and own[0] <= other[1]:
                raise OverlappingHistory(f"{own} meets the stored range {other}")
        return own

    def before(self, start: str | datetime, end: str | datetime) -> tuple[DataFrame, DataFrame]:
        """(user, sessions_before) and (user, product, views_before) of all parts before a range.

        A part that overlaps the range raises, unless it is that of the very range.
        """
        own = self._checked(start, end)
        folders = [self._folder(*other) for other in self.ranges() if other[1] < own[0]]
        read = lambda name, schema: (
            self.spark.read.schema(schema).parquet(*[f"{folder}/{name}" for folder in folders])
            if folders else self.spark.createDataFrame([], schema)
        )
        sessions = read("sessions", f"{USER} string, {SESSIONS} long")
        views = read("views", f"{USER} string, {PRODUCT} string, {VIEWS} long")
        if len(folders) > 1:
            sessions = sessions.groupBy(USER).agg(F.sum(SESSIONS).alias(SESSIONS))
            views = views.groupBy(USER, PRODUCT).agg(F.sum(VIEWS).alias(VIEWS))
        return sessions, views

    def extend(self, visits: DataFrame, start: str | datetime, end: str | datetime) -> None:
        """Store the totals of a range's `visits`; a part of the same range is replaced."""
        folder = self._folder(*self._checked(start, end))
        sessions = visits.where(F.col(SESSION).isNotNull()).select(USER, SESSION).distinct()
        sessions = sessions.groupBy(USER).agg(F.count(F.lit(1)).alias(SESSIONS))
        views = visits.where("num_views_product > 0").groupBy(USER, PRODUCT).agg(
            F.sum("num_views_product").alias(VIEWS)
        )
        sessions.write.mode("overwrite").parquet(f"{folder}/sessions")
        views.write.mode("overwrite").parquet(f"{folder}/views")
        touch(self.spark, f"{folder}/_DONE")
