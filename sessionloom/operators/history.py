"""Running totals over a key's earlier rows, also for keys too large for one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.session import materialise

# A window sorts each group within one task.  Groups up to this size sort in seconds to a minute;
# larger ones are cut into slices, small enough that even one such group keeps many tasks busy.
HEAVY_GROUP_ROWS = 5_000_000
SLICE_ROWS = 300_000


def heavy_keys(rows: DataFrame, keys: list[str], limit: int = HEAVY_GROUP_ROWS) -> DataFrame | None:
    """Keys with more than `limit` rows, or None if there are none.

    Runs one job over `rows`: a count combined within tasks that reads only the key columns.
    Heavy keys, at most rows/limit of them, are written out, so that later joins know their size.
    `rows` should be the rows that a window will read, as a written table.
    """
    counts = rows.groupBy(*keys).count().where(F.col("count") > limit)
    heavy = materialise(counts.select(*keys), "heavy-keys")
    return None if heavy.isEmpty() else heavy


def with_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    return _match(rows, keys, "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    return _match(rows, keys, "left_anti")


def _match(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    same = [rows[name].eqNullSafe(keys[name]) for name in keys.columns]
    return rows.join(keys, reduce(and_, same), how)


def running_total(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    heavy: DataFrame | None = None,
    limit: int = HEAVY_GROUP_ROWS,
    apart: int = 0,
) -> DataFrame:
    """Adds `name`: the sum of `value` over rows of the same `keys` ordered strictly earlier.

    `keys` and `order` together must identify a row, nulls sort first, and the first row of a
    group gets 0.  Null keys form a group.  `heavy` lists keys (some of `keys`) whose groups
    exceed one task.  With `apart`, rows that agree in so many first columns of `order` are peers,
    which do not count towards each other, however the rest of `order` sorts them.
    """
    if heavy is None:
        return _windowed(rows, keys, order, value, name, apart)
    light = _windowed(without_keys(rows, heavy), keys, order, value, name, apart)
    sliced = sliced_total(
        with_keys(rows, heavy), keys, order, value, name, limit=limit, apart=apart
    )
    return light.unionByName(sliced)


def earlier_sum(keys: list[str], order: list[str], value: Column, apart: int = 0) -> Column:
    """The window expression of `running_total`."""
    if not apart:
        rows = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(rows), F.lit(0)).cast("long")
    # All up to the last peer, less the peers; both windows need one sort.
    peers = order[:apart]
    so_far = Window.partitionBy(*keys).orderBy(*peers).rangeBetween(Window.unboundedPreceding, 0)
    own = F.coalesce(F.sum(value).over(Window.partitionBy(*keys, *peers)), F.lit(0))
    return (F.coalesce(F.sum(value).over(so_far), F.lit(0)) - own).cast("long")


def _windowed(rows, keys, order, value, name, apart=0) -> DataFrame:
    return rows.withColumn(name, earlier_sum(keys, order, value, apart))


def sliced_total(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    slices: int | None = None,
    limit: int = HEAVY_GROUP_ROWS,
    apart: int = 0,
) -> DataFrame:
    """`running_total` that divides the rows evenly between tasks, whatever their keys.

    The rows are written, so that sampling them for the ranges computes nothing again and their
    number gives the number of slices, of at most `limit` and SLICE_ROWS rows.  They are then range partitioned by
    key and order, which cuts a large key into consecutive slices, and written so that the cut
    is fixed.  A row's total is the running total in
    its slice plus the sum of the key's earlier slices.  There is one such sum per key and
    slice it touches: at most one per slice and one per key.  Of peers that a cut divides, those
    in later slices leave out the ones in earlier slices: see `_cut_peers`.
    """
    whole = materialise(rows, "to-slice")
    slices = slices or max(1, -(-whole.count() // max(1, min(limit, SLICE_ROWS))))
    cuts = [F.col(column).asc_nulls_first() for column in [*keys, *order]]
    spread = whole.repartitionByRange(slices, *cuts)
    cut = materialise(
        # A struct is never null itself, so null keys match like any other below.
        spread.select(
            "*",
            F.struct(*keys).alias("_key"),
            *([F.struct(*order[:apart]).alias("_peers")] if apart else []),
            F.spark_partition_id().alias("_slice"),
            value.cast("long").alias("_value"),
        ),
        "slices",
    )
    earlier_slices = (
        Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy("_key", "_slice")
        .agg(F.sum("_value").alias("_sum"))
        .select(
            "_key",
            "_slice",
            F.coalesce(F.sum("_sum").over(earlier_slices), F.lit(0)).alias("_offset"),
        )
    )
    in_slice = _windowed(cut, ["_key", "_slice"], order, F.col("_value"), "_within", apart)
    joined = in_slice.join(offsets, ["_key", "_slice"])
    total = F.col("_within") + F.col("_offset")
    if apart:
        joined = joined.join(_cut_peers(cut), ["_key", "_slice", "_peers"], "left")
        total = total - F.coalesce("_before", F.lit(0))
    return joined.select(*rows.columns, total.alias(name))


def _cut_peers(cut: DataFrame) -> DataFrame:
    """_key, _slice, _peers, _before: for peers that earlier slices hold too, their sum there.

    Only the first and the last peers of a key in a slice can go on in another, so there are two
    rows at most for each key and slice.
    """
    ends = cut.groupBy("_key", "_slice").agg(F.min("_peers").alias("first"), F.max("_peers").alias("last"))
    ends = ends.select("_key", "_slice", F.explode(F.array_distinct(F.array("first", "last"))).alias("_peers"))
    sums = cut.join(ends, ["_key", "_slice", "_peers"], "left_semi").groupBy("_key", "_slice", "_peers").agg(
        F.sum("_value").alias("_sum")
    )
    earlier = (
        Window.partitionBy("_key", "_peers").orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sums.select("_key", "_slice", "_peers", F.sum("_sum").over(earlier).alias("_before")).where(
        F.col("_before").isNotNull()
    )
