"""Token counts through a digest cache.

A count depends on the content and the tokenizer only, so it is stored under the digests of both
and looked up before anything is encoded.  Of a batch only the distinct contents that the cache
lacks are encoded, one document for each, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.session import materialise, new_path

from .rows import numbered, pieces, whole

BATCH_BYTES = 1 << 22


class CountCache:
    """Counts by content digest and tokenizer digest, as a Parquet table bucketed by content.

    The files live at `path`, outlast the session and serve any number of tokenizers.  `buckets`
    must stay the same for a path; by default it is the session's number of shuffle partitions.
    The catalog names the files until `close`.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "count-cache")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"counts_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, tokenizer STRING, n_tokens BIGINT) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def of(self, tokenizer: str) -> DataFrame:
        return self.spark.table(self.name).where(F.col("tokenizer") == tokenizer).drop("tokenizer")

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, counts: DataFrame, tokenizer: str) -> None:
        """Append counts (digest, n_tokens; distinct digests that the cache lacks)."""
        counts.repartition(self.buckets, "digest").select(
            "digest", F.lit(tokenizer).alias("tokenizer"), "n_tokens"
        ).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def tokenizer_file(path: str) -> tuple[bytes, str]:
    """A vocabulary file's bytes and their digest with the format, which names its version."""
    with open(path, "rb") as file:
        content = file.read()
    return content, f"{path.rpartition('.')[2]}:{hashlib.sha256(content).hexdigest()}"


def counter(content: bytes, kind: str) -> Callable[[list[str]], list[int]]:
    """Counts tokens of whole texts by the library that the kind of file belongs to."""
    if kind == "model":
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def encoded_counts(rows: DataFrame, content: bytes, kind: str) -> DataFrame:
    """digest, n_tokens for rows (digest, text)."""
    file = rows.sparkSession.sparkContext.broadcast(content)  # a vocabulary, a few MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(file.value, kind)
        for batch in pieces(batches, "text", BATCH_BYTES):
            texts = [value.as_py().decode(errors="replace") for value in batch.column("text")]
            counts = pa.array(count(texts) if texts else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), counts], ["digest", "n_tokens"])

    return rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        run, "digest binary, n_tokens long"
    )


def token_counts(
    docs: DataFrame, path: str, cache: CountCache | None = None, id: str = "doc_id",
    text: str = "text", normalise: Callable[[Column], Column] = whole, limit: int = 4096,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    Content is the text after `normalise`, which must not change a count; by default null counts
    as empty and nothing else changes, as tokenizers tell white space and letter forms apart.
    Bytes that are no UTF-8 count as the replacement character.  Null ids and repeated rows are
    rows like any other, encoded once.  Other columns are not read.  Without a cache, an empty one
    is used and closed.  A long text is encoded in one piece.  Runs jobs when called: the cache is appended to.
    """
    own, cache = cache is None, cache or CountCache(docs.sparkSession)
    file, version = tokenizer_file(path)
    content = normalise(F.col(text))
    digest = F.unhex(F.sha2(content, 256))
    rows = numbered(
        docs.select(
            F.col(id).alias("doc_id"), F.octet_length(whole(F.col(text))).cast("long").alias("n_bytes"),
            digest.alias("digest"),
        ),
        "row", "content-digests",
    )
    distinct = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    misses = materialise(
        distinct.repartition(cache.buckets, "digest")
        .join(cache.of(version).hint("merge"), "digest", "left_anti"),
        "misses",
    )
    # One document for each missing digest, found by its id; null ids match too.
    texts = docs.select(F.col(id).alias("_id"), content.alias("text")).withColumn(
        "_digest", F.unhex(F.sha2("text", 256))
    )
    wanted = texts.join(
        misses, texts["_id"].eqNullSafe(misses["doc_id"]) & (texts["_digest"] == misses["digest"])
    ).select("digest", "text")
    # Rows that repeat both id and text are found together; one of them is encoded.
    if not rows.groupBy("doc_id", "digest").count().where("count > 1").isEmpty():
        wanted = wanted.dropDuplicates(["digest"])
    fresh = encoded_counts(wanted, file, path.rpartition(".")[2])
    cache.append(fresh.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), version)
    counts = materialise(
        distinct.select("digest").repartition(cache.buckets, "digest")
        .join(cache.of(version).hint("merge"), "digest")
        .withColumnRenamed("digest", "_digest"),
        "counts",
    )
    if own:
        cache.close()
    return rows.join(counts, rows["digest"] == counts["_digest"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
