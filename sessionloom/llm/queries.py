"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .alignment import alignment
from .exact_dedup import exact_dedup
from .license_scan import license_scan
from .mixing import mix
from .personal import BASE, personal_data
from .phrases import collocations
from .quality import quality_rules
from .secrets import KINDS, secret_scan
from .simhash import simhash
from .suffix_dedup import suffix_dedup
from .token_counts import token_counts
from .warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "positions")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(_table(spark, sf_dir, "documents"))
    order = F.array(*map(F.lit, KINDS))
    span = lambda x, kind: F.struct(x["start"], F.array_position(order, kind), kind.alias("kind"), x["end"])
    base = F.transform("base", lambda x: span(x, x["kind"]))
    learned = F.transform("learned", lambda x: span(x, F.lit("learned")))
    joined = lambda spans: F.array_join(F.transform(
        F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    ), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, learned)).alias("spans"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(_table(spark, sf_dir, "documents"))
    removed = F.aggregate(
        F.transform("removed", lambda x: x["end"] - x["start"]), F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.when(F.col("kept").isNull(), F.col("text_sha256")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct("licences.family")), ",").alias("families"),
        F.array_join(
            F.transform("licences", lambda x: F.concat_ws(":", x["paragraph"], x["family"])), ","
        ).alias("paragraphs"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(_table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
    base = F.filter("spans", lambda x: x["kind"].isin(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_byte_bpe, op2_exact_dedup, op3_warc, op4_quality_rules, op5_source_mix,
        op6_secret_scan, op7_token_counts, op8_suffix_dedup, op9_simhash,
        op10_license_scan, op11_token_alignment, op12_personal_data, op13_phrase_mining,
    )
}
