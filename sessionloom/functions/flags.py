"""Predicates on the event type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionloom.schema import EVENT_TYPE, PURCHASE, VIEW


def is_view() -> Column:
    return F.col(EVENT_TYPE) == VIEW


def is_purchase() -> Column:
    return F.col(EVENT_TYPE) == PURCHASE


def is_product_event() -> Column:
    """Events that make a product row; the others only shape their session."""
    return F.col(EVENT_TYPE).isin(PURCHASE, VIEW)


def as_flag(condition: Column) -> Column:
    return condition.cast("int")
