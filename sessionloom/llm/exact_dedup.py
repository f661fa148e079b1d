"""Exact dedup against a persistent digest index.

The index is a Parquet table of the digests seen so far, bucketed and sorted by digest.  A batch
is reduced to its distinct digests (combined within tasks, so a text with very many copies costs
one row per task), those are merged with the index bucket by bucket, and the new ones are
appended to their buckets.  The index itself is never shuffled.  Beside each digest is the batch
that brought it: a batch that is run again, after its digests were stored but its result was lost,
finds its own digests and keeps what it kept before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.session import drop, materialise, new_path

from .rows import SPACES, chosen, numbered, row_key, whole


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(whole(text), SPACES, " ")


class DigestIndex:
    """Digests, the id of the document that stays for each, and the batch that brought it.

    The files live at `path` and outlast the session: opening the same path again continues the
    index.  `buckets` must stay the same for a path; choose it so that a bucket's part of all
    digests (some 40 bytes each) fits a task.  By default it is the session's number of shuffle
    partitions.  The catalog names the files until `close`.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append_new(self, rows: DataFrame, batch: str) -> None:
        """Append the digests of `rows` (digest, keep_id; distinct) that the index lacks."""
        dealt = rows.select("digest", "keep_id").repartition(self.buckets, "digest")
        dealt.join(self.table().hint("merge"), "digest", "left_anti").select(
            "digest", "keep_id", F.lit(batch).alias("batch")
        ).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def lookup(self, batch: DataFrame) -> DataFrame:
        """`batch`, by distinct digest, with the `keep_id` that the index holds."""
        dealt = batch.repartition(self.buckets, "digest")
        return dealt.join(self.table().drop("batch").hint("merge"), "digest")


def batch_of(digests: DataFrame) -> str:
    """A name for a batch by what it holds: its rows and a sum over hashes of them."""
    places = F.pmod(F.xxhash64("_id", "digest"), F.lit(1 << 40))
    rows, total = digests.agg(F.count(F.lit(1)), F.sum(places)).first()
    return f"{rows}-{total or 0}"


def decide(digests: DataFrame, index: DigestIndex | None, batch: str | None = None) -> DataFrame:
    """One row per row of `digests` (_row, _id, digest): whether it stays, and who stays for it.

    Of equal texts new to the index the one with the smallest id stays, null ids last; of rows
    that repeat the id too, the first by row number.  A text that the index knows from another
    batch is dropped, and `keep_id` is the id it was first kept by.  `group_size` counts the rows of
    this batch.  Without an index, an empty one is used and closed.
    """
    own = index is None
    index = index or DigestIndex(digests.sparkSession)
    batch = batch or batch_of(digests)
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_row")).alias("first")
    groups = materialise(
        digests.groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size")), "digest-groups"
    )
    firsts = groups.select("digest", F.col("first._id").alias("keep_id"))
    known = materialise(
        groups.select("digest").repartition(index.buckets, "digest")
        .join(
            index.table().where(~F.col("batch").eqNullSafe(F.lit(batch))).hint("merge"), "digest", "left_semi"
        ),
        "known-digests",
    )
    index.append_new(firsts, batch)
    fresh = materialise(
        index.lookup(groups)
        .join(known.withColumn("known", F.lit(True)), "digest", "left")
        .select(
            F.col("digest").alias("_digest"), "keep_id", "group_size",
            F.when(F.col("known").isNull(), F.col("first._row")).alias("_keep_row"),
        ),
        "digest-decisions",
    )
    if own:
        index.close()
    drop(groups, known)
    # Rows of one text may be a large part of all: a plain join, which adaptive execution splits.
    return digests.join(fresh, digests["digest"] == fresh["_digest"]).select(
        "_row", F.col("_id").alias("doc_id"), "keep_id", "group_size",
        F.coalesce(F.col("_row") == F.col("_keep_row"), F.lit(False)).alias("kept"), "digest",
    )


def exact_dedup(
    docs: DataFrame, index: DigestIndex | None = None, id: str = "doc_id", text: str = "text",
    batch: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts are equal.  Other columns of `docs` are not
    read and not returned.  Without an index, an empty one is used.  An empty batch gives no
    rows.  Runs jobs when called: the index is appended to.  `batch` names the batch; a batch run
    again under its name gives the same rows.  By default the name is made of the batch's rows, so
    the very same rows are the same batch.
    """
    digests = numbered(
        docs.select(
            F.col(id).alias("_id"),
            F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"),
        ),
        "_row", "digests",
    )
    return decide(digests, index, batch).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_first(
    docs: DataFrame, index: DigestIndex | None = None, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that stay, with all their columns; one of each set of equal texts.

    Nulls, ties, repeated rows and texts that the index knows are as in `exact_dedup`.
    """
    key = row_key(F.col(id), F.col(text))
    digest = F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest")
    rows = numbered(docs.select(key.alias("_key"), F.col(id).alias("_id"), digest), "_row", "digests")
    kept = decide(rows.drop("_key"), index).where("kept")
    stay = materialise(rows.join(kept.select("_row"), "_row", "left_semi").select("_key"), "kept-rows")
    return chosen(docs, key, stay, rows).select(docs.columns)
