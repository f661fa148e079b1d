"""SimHash near-dedup with covering bit masks.

Fingerprints are made in one pass over the texts.  From then on only distinct fingerprints
matter: copies, however many, are one row.  Links are found in tables of masked fingerprints.
Give each bit one of the 2**(r+1) - 1 nonzero vectors of r+1 bits, and let table v mask the bits
whose vector has an odd product with v.  For any r bits some v is orthogonal to all their
vectors, so fingerprints that differ in r bits or fewer agree on that table's mask.  Within a
table, two fingerprints at distance 2 both lie one bit from a third, found by flipping one bit
outside the mask; so members of a table entry are grouped by those, at most 65 to a group, and
all of a group are linked.  No pairs are listed and no entry is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.session import drop, materialise

from .components import components
from .rows import numbered, pieces, whole

BITS = 64
SEED = 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of the text's word shingles; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    width = min(width, len(words))
    begin = [0, *(ends + 1).tolist()]
    stop = ends[width - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(stop), _BLOCK):
        spans = zip(begin[at:at + _BLOCK], stop[at:at + _BLOCK])
        hashes = np.array([xxhash.xxh64_intdigest(flat[b:e], SEED) for b, e in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(stop)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str, name: str) -> DataFrame:
    """`docs` without `text`, with a long column of fingerprints."""
    rest = [column for column in docs.columns if column != text]
    shape = docs.select(*[F.col(f"`{c}`") for c in rest], F.lit(0).cast("long").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, 1 << 24):
            values = np.array([fingerprint(x.as_py()) for x in batch.column(text)], np.uint64)
            kept = [batch.column(column) for column in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values.view(np.int64))], [*rest, name])

    return docs.withColumn(text, whole(F.col(f"`{text}`")).cast("binary")).mapInArrow(run, shape.schema)


def covering_masks(radius: int) -> list[int]:
    """Masks of which any two fingerprints within the radius agree on at least one."""
    vectors = range(1, 1 << (radius + 1))
    return [
        sum(1 << bit for bit in range(BITS) if (v & vectors[bit % len(vectors)]).bit_count() % 2)
        for v in vectors
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect exactly what differs by 2 bits or fewer; `prints`: distinct fp."""
    masks = covering_masks(2)
    tables = F.explode(F.array(*[
        F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for v, mask in enumerate(masks)
    ]))
    entries = prints.select("fp", tables.alias("t")).select("fp", "t.*")
    shared = materialise(
        entries.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "shared-entries",
    )
    flips = F.array(*[
        F.array(*[F.lit(_signed(1 << bit)) for bit in range(BITS) if not mask >> bit & 1])
        for mask in masks
    ])
    near = (
        entries.join(shared, ["v", "key"], "left_semi")
        .select("fp", F.explode(F.concat(
            F.array(F.col("fp")),
            F.transform(F.get(flips, F.col("v")), lambda flip: F.col("fp").bitwiseXOR(flip)),
        )).alias("near"))
    )
    # A group's members are `near` and what is one bit from it.
    groups = near.groupBy("near").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    return groups.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b")


def near_components(prints: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """fp, component_id, first_row for written rows (_row, _id, fp); by `links` without edges.

    component_id is the smallest id that is reachable, null ids aside; first_row is the row that
    has it, the smallest of several (and if all ids are null, the smallest of those).
    """
    first = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_row")
    distinct = materialise(prints.groupBy("fp").agg(F.min(first).alias("first")), "fingerprints")
    edges = links(distinct.select("fp")) if edges is None else edges
    roots = components(edges)
    rooted = materialise(
        distinct.join(roots.toDF("fp", "root"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")),
        "rooted-fingerprints",
    )
    of_root = materialise(rooted.groupBy("root").agg(F.min("first").alias("least")), "component-ids")
    found = materialise(
        rooted.join(of_root, "root").select(
            "fp", F.col("least._id").alias("component_id"), F.col("least._row").alias("first_row")
        ),
        "fingerprint-components",
    )
    drop(distinct, roots, rooted, of_root)
    return found


def simhash(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Links are transitive.  Null, empty and blank texts have fingerprint zero and are linked like
    any other.  Texts of fewer than three words are one shingle.  Other columns are not read.
    A null id is never a component's id unless all its ids are null.  Runs jobs when called.
    """
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    prints = numbered(fingerprints(rows, "_text", "fp"), "_row", "prints")
    joined = prints.join(near_components(prints), "fp")
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
