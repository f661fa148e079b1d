"""CSV output: plain, sized and verified writes, and the reader of what they write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F

from sessionloom.schema import FEATURE_SCHEMA
from sessionloom.session import exists, materialise, observed, release

# Fixed values of the output sizing rule.
ROWS_PER_FILE = 200_000
MIN_PARTITIONS = 10
# Rows of a file that is read back; so many are a task's work if texts hold line breaks.
CHECKED_ROWS = 1_000_000
# Names of wrong files that an error lists.
NAMED = 20

# Quotes are doubled, blanks stay, times have all their digits.  Null is nothing and the empty
# text a pair of quotes; a reader tells them apart by a word for null that no text contains.
_SPELLING = {
    "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
_NULL = "\ue000null\ue001"


class LoadVerificationError(RuntimeError):
    """The written output is incomplete."""


def optimal_partitions(rows: int) -> int:
    return max(MIN_PARTITIONS, rows // ROWS_PER_FILE)


def write_csv(
    df: DataFrame, path: str, compression: str | None = None, rows_per_file: int | None = None
) -> None:
    """Overwrite `path` with headed CSV part files.

    A task writes one file, whose bytes adaptive execution chose when it shuffled last;
    `rows_per_file` bounds them by rows instead, without a count and without a shuffle.
    """
    writer = df.write.mode("overwrite").options(**_SPELLING, nullValue="", emptyValue='""')
    if compression is not None:
        writer = writer.option("compression", compression)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path, header=True)


def read_written(spark: SparkSession, schema, line_breaks: bool = True) -> DataFrameReader:
    """Reader of what `write_csv` wrote, for a given schema.

    If texts may hold line breaks, a file is read by one task; without any, a plain file is read
    by as many tasks as its size asks for.
    """
    return spark.read.schema(schema).options(
        **_SPELLING, header=True, multiLine=line_breaks, nullValue=_NULL, emptyValue=""
    )


def write_balanced(
    df: DataFrame, path: str, compression: str | None = None, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write parts of even size, whatever the sizes of the partitions of `df`.

    Adaptive execution rebalances by the bytes that it finds in a shuffle: it splits large
    partitions and joins small ones to the session's advisory size
    (`spark.sql.adaptive.advisoryPartitionSizeInBytes`); `rows_per_file` is a bound besides.
    Nothing is counted beforehand, and one job does it all.
    """
    write_csv(df.hint("rebalance"), path, compression, rows_per_file)


def write_repartitioned(df: DataFrame, path: str, rows: int | None = None) -> int:
    """Write evenly sized parts, about 200,000 rows each and at least ten.

    Without a known row count `df` is counted first, which for a table reads no columns.  Costs
    a full shuffle; `write_csv`, with or without `rows_per_file`, does not.
    """
    parts = optimal_partitions(df.count() if rows is None else rows)
    write_csv(df.repartition(parts), path)
    return parts


def _row_hash(df: DataFrame) -> Column:
    places = F.xxhash64(*[F.coalesce(F.col(name).cast("string"), F.lit(_NULL)) for name in df.columns])
    return F.pmod(places, F.lit(1 << 31))


def _content(df: DataFrame) -> list[Column]:
    """Row count, and a sum over hashes of the rows, which does not depend on their order."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(_row_hash(df)).alias("hashes")]


def _line_breaks(df: DataFrame) -> Column:
    """Number of rows with a line break in a text."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    found = [F.coalesce(F.col(name).rlike("[\\r\\n]"), F.lit(False)) for name in texts]
    return F.count_if(F.greatest(*found, F.lit(False), F.lit(False))).alias("broken")


def write_verified(
    df: DataFrame, path: str, compression: str | None = None, rows_per_file: int | None = None
) -> dict[str, int]:
    """Write, then check the success marker and that every row arrived with its values.

    Rows and a sum of their hashes are taken by the write itself and again from the files, all of
    which are read back; a difference raises.  Returns the numbers of rows and files.  Files are
    read in pieces unless the write saw texts with line breaks or compresses them; a file's rows
    are bounded in any case, so none takes one task long.
    """
    seen = Observation()
    write_csv(
        df.observe(seen, *_content(df), _line_breaks(df)), path, compression,
        min(rows_per_file or CHECKED_ROWS, CHECKED_ROWS),
    )
    spark = df.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        raise LoadVerificationError(f"no success marker in {path}")
    written = observed(seen)
    # The schema is given, since inferring the names would fail on an output without files.
    found = read_written(spark, df.schema, "broken" in written).csv(path)
    again = found.select(*df.columns, "_metadata.file_path").agg(
        *_content(df), F.count_distinct("file_path").alias("files")
    ).first()
    if (again.rows, again.hashes or 0) != (written.get("rows", 0), written.get("hashes", 0)):
        raise LoadVerificationError(
            f"{written.get('rows', 0)} rows written to {path}, {again.rows} found, or with other values"
        )
    return {"rows": again.rows, "files": again.files}


def write_listed(
    df: DataFrame, path: str, compression: str | None = None, rows_per_file: int | None = None
) -> DataFrame:
    """Write, and return what each file must hold: part, number, rows, hashes, broken.

    The rows are written as a table first.  A task then writes what it scans of that table, file
    after file of so many rows, and a second scan of the same splits counts and hashes the rows of
    each file by the task's number and the row's place in it.  The list is a table in the shared
    folder; `check_files` compares it with the files, now or after they were moved.
    """
    limit = min(rows_per_file or CHECKED_ROWS, CHECKED_ROWS)
    table = materialise(df, "to-list")
    write_csv(table, path, compression, limit)
    place = F.monotonically_increasing_id()
    numbered = table.select(
        "*", F.shiftright(place, 33).alias("_part"),
        F.floor(place.bitwiseAND((1 << 33) - 1) / limit).alias("_number"),
    )
    counted = numbered.groupBy(F.col("_part").alias("part"), F.col("_number").alias("number")).agg(
        *_content(df), _line_breaks(df)
    )
    listed = materialise(counted, "file-list")
    release(df.sparkSession, table)
    return listed


def check_files(listed: DataFrame, path: str, schema) -> dict[str, int]:
    """Compare the files of a folder, each by itself, with the list that `write_listed` made.

    Raises with the names of files that lack rows, hold other values, are missing or are not on
    the list.  Returns the numbers of rows and files.
    """
    spark = listed.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        raise LoadVerificationError(f"no success marker in {path}")
    total = listed.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("broken").alias("broken")).first()
    found = read_written(spark, schema, bool(total.broken)).csv(path)
    names = found.columns
    piece = lambda at: F.regexp_extract("_file", r"part-(\d+)-.*-c(\d+)\.", at).try_cast("long")
    held = found.select("*", F.col("_metadata.file_name").alias("_file")).groupBy("_file").agg(*_content(found.select(names)))
    held = held.select(
        piece(1).alias("part"), piece(2).alias("number"), "_file",
        F.col("rows").alias("_rows"), F.col("hashes").alias("_hashes"),
    )
    both = listed.join(held, ["part", "number"], "full")
    wrong = both.where(~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("hashes").eqNullSafe(F.col("_hashes"))))
    label = F.coalesce("_file", F.concat(F.lit("part-"), F.lpad(F.col("part").cast("string"), 5, "0"), F.lit(" (missing)")))
    bad = sorted(row[0] for row in wrong.select(label).limit(NAMED).collect())
    if bad:
        raise LoadVerificationError(f"files of {path} that differ from what was written: {', '.join(bad)}")
    return {"rows": total.rows or 0, "files": total.files}


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A written feature table, typed."""
    return read_written(spark, FEATURE_SCHEMA).csv(path)
