"""What the operators share: words, row numbers and column names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.session import materialise

# ASCII white space; the same six characters that Python's bytes.split() takes.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def whole(text: Column) -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for null."""
    inner = F.btrim(whole(text), F.lit(SPACE_CHARS))
    none = F.array().cast("array<string>")
    return F.when(inner == "", none).otherwise(F.split(inner, SPACES))


def unused(name: str, columns: Iterable[str]) -> str:
    """`name`, lengthened until no column is called so (Spark ignores case in names)."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, row: str, label: str) -> DataFrame:
    """A written copy of `df` with a column of distinct row numbers.

    The numbers are fixed by the write, so that rows stay told apart, repeated ones included,
    when tasks run again.
    """
    return materialise(df.withColumn(row, F.monotonically_increasing_id()), label)


def few(column: str, of: int, count: int) -> Column:
    """Whether a value is among about `count` of all `of` distinct ones, by its hash.

    A ranking of what is drawn so brings a number of rows to the driver that does not grow.
    """
    share = min(1.0, count / max(1, of))
    return F.pmod(F.xxhash64(column), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))


def row_key(id: Column, text: Column, source: Column | None = None) -> Column:
    """A digest by which rows that agree in id, text and source are found again."""
    parts = [F.coalesce(id.cast("string"), F.lit("-"))]
    if source is not None:
        parts.append(F.coalesce(F.concat(F.length(source), F.lit(":"), source), F.lit("-")))
    return F.unhex(F.sha2(F.concat_ws("|", *parts, whole(text)), 256))


def chosen(docs: DataFrame, key: Column, keys: DataFrame, rows: DataFrame) -> DataFrame:
    """`docs` joined with `keys` (`_key` and perhaps more), one for each row of `keys`.

    `rows` has `_key` of all of `docs`.  Rows that share a key are alike in all that matters here,
    and the first of them stands for all.  Only this join moves whole documents.
    """
    name = unused("_key_", docs.columns)
    keyed = docs.withColumn(name, key)
    if not rows.groupBy("_key").count().where("count > 1").isEmpty():
        keyed = keyed.dropDuplicates([name])
    return keyed.join(keys.withColumnRenamed("_key", name), name)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into ones of at most `limit` bytes in `column`, or a single row."""
    for batch in batches:
        sizes = [size or 0 for size in pc.binary_length(batch.column(column)).to_pylist()]
        start = held = 0
        for at, size in enumerate(sizes):
            if at > start and held + size > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
