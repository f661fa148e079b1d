"""Mixing sources to target weights along a curriculum, in DataFrame operations only.

Each source has a weight schedule over training time 0 to 1.  Its integral is the source's share
of the words; its running integral says how many of the source's words are due by any time, and
inverting that gives the time at which a given word of the source is due.  A source's documents
follow each other in an order drawn by hash, again and again until its target is reached.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.session import materialise

from .rows import chosen, numbered, row_key, unused, words

MOST_PASSES = 3
# Words are added up in hash buckets of about so many documents of the largest source.
BUCKET_ROWS = 2000

# Shapes of the schedules, at evenly spaced times: level, rising, falling.  Each has integral 1.
SHAPES = [[1.0, 1.0, 1.0], [0.5, 1.0, 1.5], [1.5, 1.0, 0.5]]


def ranked_schedules(sources: DataFrame) -> DataFrame:
    """Default schedules: by code point of the source, null last, weights 1, 2, 3 in turn.

    One row per source, ranked in one task.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3
    shapes = F.array(*[F.array(*map(F.lit, [w * (k + 1) for w in shape])) for k, shape in enumerate(SHAPES)])
    return sources.withColumn("schedule", F.get(shapes, turn))


def _areas(schedule: Column) -> Column:
    """Integral of the schedule up to each of its times, straight lines between them."""
    steps = F.size(schedule) - 1
    parts = F.transform(schedule, lambda w, j: F.when(j < steps, (w + F.get(schedule, j + 1)) / 2 / steps))
    return F.transform(schedule, lambda _, j: F.aggregate(
        F.transform(parts, lambda part, i: F.when(i < j, part).otherwise(0.0)),
        F.lit(0.0), lambda total, x: total + x,
    ))


def _time(schedule: Column, areas: Column, share: Column) -> Column:
    """The time by which the given share of the whole integral is due."""
    steps = F.size(schedule) - 1
    area = share * F.element_at(areas, -1)
    at = F.greatest(F.lit(0), F.least(steps - 1, F.size(F.filter(areas, lambda x: x <= area)) - 1))
    begin, end = F.get(schedule, at), F.get(schedule, at + 1)
    rest = F.greatest(area - F.get(areas, at), F.lit(0.0))
    root = F.sqrt(F.greatest(begin * begin + 2 * (end - begin) * steps * rest, F.lit(0.0)))
    within = F.coalesce(F.try_divide(2 * rest, begin + root), F.lit(0.0))
    return F.least(at / steps + within, F.lit(1.0))


def targets(sources: DataFrame) -> DataFrame:
    """`sources` (source, source_size, schedule) with target and areas.

    All sizes are shared by weight; a target stops at three times its source's size, and the
    excess is shared anew by weight until none is above.  Each sharing is an aggregate of which
    a few numbers reach the driver.
    """
    weighed = materialise(
        sources.withColumn("areas", _areas(F.col("schedule")))
        .withColumn("weight", F.element_at("areas", -1)),
        "sources",
    )
    cap = MOST_PASSES * F.col("source_size")
    share, capped = 0.0, -1
    while True:
        above = cap < F.col("weight") * share
        total, held, weight, now = weighed.agg(
            F.sum("source_size"), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))),
            F.count_if(above),
        ).first()
        if now == capped or not weight:
            break
        share, capped = ((total or 0) - (held or 0)) / weight, now
    return weighed.withColumn("target", F.least(cap, F.col("weight") * share).cast("double"))


def _placed(rows: DataFrame, schedules) -> DataFrame:
    """`rows` (_row, _id, hash, source, size) with source_size, target, copies and positions.

    Documents follow each other by an unsigned hash of id and text; buckets are shares of it, so
    how many there are changes nothing but where sums are made.
    """
    sources = materialise(rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    ), "source-sizes")
    largest = sources.agg(F.max("source_rows")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, largest / BUCKET_ROWS))))
    aimed = materialise(
        targets(schedules(sources)).withColumn("number", F.monotonically_increasing_id()), "targets"
    )
    key = F.xxhash64("_id", "hash")
    dealt = materialise(
        rows.join(aimed.withColumnRenamed("source", "_of"), rows["source"].eqNullSafe(F.col("_of")))
        .withColumn("key", key)
        .drop("_of", "source_rows", "hash")
        .withColumn("bucket", F.shiftrightunsigned(F.shiftrightunsigned("key", 63 - bits), 1))
        .withColumn("key", F.col("key").bitwiseXOR(F.lit(-(1 << 63)))),  # signed order as unsigned
        "dealt",
    )
    earlier = lambda *by: (
        Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    )
    # Sums before each bucket in two levels, so that no task has all buckets of a source.
    words_of = dealt.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    words_of = materialise(words_of.withColumn("coarse", F.shiftright("bucket", bits // 2)), "bucket-words")
    before = lambda order: F.coalesce(F.sum("words").over(order), F.lit(0))
    coarse = words_of.groupBy("number", "coarse").agg(F.sum("words").alias("words")).select(
        "number", "coarse", before(earlier("number").orderBy("coarse")).alias("first")
    )
    inner = words_of.withColumn("start", before(earlier("number", "coarse").orderBy("bucket")))
    starts = materialise(
        inner.join(coarse, ["number", "coarse"])
        .select("number", "bucket", (F.col("start") + F.col("first")).alias("start")),
        "bucket-starts",
    )
    within = F.sum("size").over(earlier("number", "bucket").orderBy("key", "_id", "size", "_row"))
    middle = F.col("start") + F.coalesce(F.col("within"), F.lit(0)) + F.col("size") / 2
    passes = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))).cast("long")
    rest = F.col("target") - passes * F.col("source_size")
    copies = passes + F.when(middle < rest, 1).otherwise(0)
    turns = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    share = lambda turn: F.try_divide(turn * F.col("source_size") + F.col("middle"), F.col("target"))
    return (
        dealt.withColumn("within", within)
        .join(starts, ["number", "bucket"])
        .withColumns({"middle": middle, "copies": copies})
        .withColumn("positions", F.transform(turns, lambda turn: F.coalesce(
            _time(F.col("schedule"), F.col("areas"), share(turn)), F.lit(0.0)
        )))
        .select("_row", "_id", "source", "size", "source_size", "target", "copies", "positions")
    )


def mix(
    docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
    schedules=ranked_schedules,
) -> DataFrame:
    """One row per row of `docs`, sorted by the time it is first trained on, unused ones last:
    doc_id, source, size, source_size, target, copies, taken, positions.

    Size counts words, null and empty texts having none; those are taken for no words.  A null
    source is a source.  Rows that repeat an id are separate documents, and rows that repeat id and
    text too, next to each other in the source's order.  A document is used whole: whenever its middle word falls below the
    target, so a source misses its target by at most half a document.  Other columns are not read.
    Runs jobs when called.  `schedules` adds a column `schedule`, an array of at least two
    weights, to the sources.
    """
    rows = numbered(
        docs.select(
            F.col(id).alias("_id"), F.col(source).alias("source"),
            F.xxhash64(text).alias("hash"), F.size(words(F.col(text))).cast("long").alias("size"),
        ),
        "_row", "sizes",
    )
    # Written before the sort, whose sampling would compute it once more.
    placed = materialise(_placed(rows, schedules), "placed")
    return placed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "_id", "_row").select(
        F.col("_id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), "positions",
    )


def mixture(
    docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
    schedules=ranked_schedules,
) -> DataFrame:
    """The documents in training order, as often as the mix takes them, with all their columns.

    Null and empty texts have no words and are taken for none; null ids and sources, ties and
    repeated rows are as in `mix`.  Of rows that agree in id, text and source the first stands for
    all, as often as they are taken together.
    """
    key = row_key(F.col(id), F.col(text), F.col(source))
    size = F.size(words(F.col(text))).cast("long").alias("size")
    rows = docs.select(
        key.alias("_key"), F.col(id).alias("_id"), F.col(source).alias("source"), F.xxhash64(text).alias("hash"), size
    )
    rows = numbered(rows, "_row", "sizes")
    at = unused("_at", docs.columns)
    uses = _placed(rows.drop("_key"), schedules).select("_row", F.explode("positions").alias(at))
    uses = materialise(rows.join(uses, "_row").select("_key", at), "uses")
    return chosen(docs, key, uses, rows).orderBy(at, id).select(docs.columns)
