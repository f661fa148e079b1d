"""Removal of long repeated strings by a distributed sort of suffixes.

Sorting the suffixes at every byte would exchange the corpus a hundredfold, so the sort is given
only those that can matter, and none that can is left out:

1. Equal texts are reduced to the first; the others are covered altogether.
2. Every window of MATCH bytes has an anchor, the gram in it with the smallest hash (the first of
   several), so equal windows have equal anchors at the same offset.  Neighbouring windows mostly
   share theirs: there is an anchor for every thirty bytes or so.  Windows whose anchor gram
   occurs once in the corpus occur once.
3. The stretches of text that the windows of a repeated anchor cover are sorted, each at its full
   length, by `sorted_runs`: front-coded runs, merged by a loser tree.  Of equal stretches all
   windows repeat, so all but the first are settled.
4. What is left are anchors with several different stretches, at the edges of repeated passages.
   They are few, and equal windows among them have the same anchor gram, so the stretches of one
   gram meet, and their windows are looked up in turn.  A gram with very many stretches is dealt
   to several groups; of those the first windows go through the sort as well.

Steps are written tables, dropped with their shuffle files when the next ones are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.session import materialise, release

from .rows import numbered, pieces, whole
from .sorted_runs import DOC, Record, cut_strings, first_places

MATCH = 100
GRAM = 40
# Windows of a text are looked at in segments of so many.
SEGMENT = 1 << 19
# A task looks for anchors in so many bytes of texts at a time, and stretches of one gram meet in
# groups of so many.
BATCH_BYTES = 1 << 25
GROUP_STRETCHES = 2000
_LOW = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15


class Anchors:
    """Anchors of the windows of texts."""

    def __init__(self, match: int = MATCH, gram: int = GRAM):
        self.match, self.gram = match, gram
        size = SEGMENT + match
        self.up, self.down = np.ones((2, size), np.uint64)
        self.up[1:], self.down[1:] = _BASE, pow(_BASE, -1, 1 << 64)
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def _hashes(self, text: np.ndarray) -> np.ndarray:
        n = len(text)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        hashes = (sums[self.gram:] - sums[: -self.gram]) * self.down[: n - self.gram + 1]
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        return hashes ^ (hashes >> np.uint64(29))

    def of(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """For stretches of windows with one anchor: first and last window, the anchor's place
        and the hash of its gram.  Texts shorter than a window have none."""
        every = np.frombuffer(text, np.uint8)
        windows = len(text) - self.match + 1
        grams = self.match - self.gram + 1
        for begin in range(0, windows, SEGMENT):
            count = min(SEGMENT, windows - begin)
            hashes = self._hashes(every[begin:begin + count + self.match - 1])
            least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
            width = 1
            while width < grams:
                step = min(width, grams - width)
                least = np.minimum(least[:-step], least[step:])
                width += step
            at = (least & _LOW).astype(np.int64)
            first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
            last = np.append(first[1:] - 1, count - 1)
            yield first + begin, last + begin, at[first] + begin, hashes[at[first]].view(np.int64)


def _identified(docs: DataFrame, id: str, text: str) -> DataFrame:
    """no_id, doc_id, text_hash (what tells documents apart), n_bytes, digest and text bytes."""
    digest = F.unhex(F.sha2(whole(F.col(text)), 256))
    return docs.select(
        F.col(id).isNull().alias("no_id"), F.coalesce(F.col(id), F.lit(0)).cast("long").alias("doc_id"),
        F.xxhash64(digest).alias("text_hash"),
        F.octet_length(whole(F.col(text))).cast("long").alias("n_bytes"), digest.alias("digest"),
        whole(F.col(text)).cast("binary").alias("text"),
    )


# A stretch in one number: its first window, and after it as 7 bits each the last window and the
# anchor's place, counted from the first; both are less than a window away.
def _packed(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    return first << 14 | (last - first) << 7 | (place - first)


def _unpacked(at: int) -> tuple[int, int, int]:
    return at >> 14, at >> 7 & 127, at & 127


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """text_hash, at (packed) of the stretches whose anchor's gram occurs at several places.

    Copies of a text are one text here.  A task reduces what it sees of a gram to one row and
    deals the others, which it knows to be repeated, anywhere; so however often a gram occurs, one
    row per batch meets where the gram is dealt.
    """
    names = ["deal", "text_hash", "at", "known"]
    shape = "deal long, text_hash long, at long, known boolean"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors()
        for batch in pieces(batches, "text", BATCH_BYTES):
            found = [(np.zeros(0, np.int64),) * 3]
            for key, text in zip(batch.column("text_hash").to_pylist(), batch.column("text"), strict=True):
                for first, last, place, mark in find.of(text.as_py()):
                    found.append((np.full(len(mark), key), _packed(first, last, place), mark))
            key, at, mark = map(np.concatenate, zip(*found, strict=True))
            order = np.lexsort((at, key, mark))
            key, at, mark = key[order], at[order], mark[order]
            new = np.ones(len(mark), bool)
            new[1:] = (mark[1:] != mark[:-1]) | (key[1:] != key[:-1]) | (at[1:] != at[:-1])
            key, at, mark = key[new], at[new], mark[new]
            head = np.ones(len(mark), bool)
            head[1:] = mark[1:] != mark[:-1]
            begin = np.flatnonzero(head)
            known = np.repeat(np.diff(np.append(begin, len(mark))) > 1, np.diff(np.append(begin, len(mark))))
            anywhere = (key ^ (at * np.int64(-7046029254386353131))) | 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (np.where(head, mark, anywhere), key, at, known)], names
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a deal follow each other; the last one of a batch may go on in the next."""
        held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]

        def repeated(columns: list[np.ndarray]) -> pa.RecordBatch:
            deal, key, at, known = columns
            begin = np.flatnonzero(np.append(True, deal[1:] != deal[:-1])) if len(deal) else np.zeros(0, int)
            if len(begin):
                differ = np.zeros(len(begin), bool)
                for column in (key, at):
                    differ |= np.minimum.reduceat(column, begin) != np.maximum.reduceat(column, begin)
                known = known | np.repeat(differ, np.diff(np.append(begin, len(deal))))
            return pa.RecordBatch.from_arrays([pa.array(key[known]), pa.array(at[known])], names[1:3])

        for batch in batches:
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            held = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            if len(held[0]):
                end = np.searchsorted(held[0], held[0][-1])  # deals come in order
                yield repeated([column[:end] for column in held])
                held = [column[end:] for column in held]
        yield repeated(held)

    dealt = docs.select("text_hash", "text").mapInArrow(scan, shape)
    return dealt.repartition("deal").sortWithinPartitions("deal").mapInArrow(
        compare, "text_hash long, at long"
    )


def _stretches(batch: pa.RecordBatch) -> Iterator[Record]:
    docs = zip(*[batch.column(name).to_pylist() for name in DOC], strict=True)
    for doc, text, spans in zip(docs, batch.column("text"), batch.column("spans"), strict=True):
        text = text.as_py()
        for at in spans.as_py():
            first, length, place = _unpacked(at)
            # The anchor's offset is part of what must be equal.
            yield text[first:first + length + MATCH] + bytes([place]), (*doc, first)


def _gram(stretch: bytes) -> int:
    """A hash of the stretch's anchor gram, as Spark's long."""
    hashed = xxhash.xxh64_intdigest(stretch[stretch[-1]:stretch[-1] + GRAM])
    return hashed - (1 << 64) if hashed >> 63 else hashed


def _edge_windows(edges: DataFrame) -> DataFrame:
    """DOC, start, end, string for stretches (DOC, start, mark, deals, string), all different.

    Runs of windows that repeat an earlier one of the group have no string; where a gram is dealt
    to several groups, each first window has its string.
    """
    names = [*DOC, "start", "end", "string"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups follow each other, each in order of places."""
        group, seen = None, set()
        for batch in batches:
            found = []
            for row in zip(*[batch.column(n).to_pylist() for n in (*DOC, "start", "mark", "salt", "deals", "string")], strict=True):
                *doc, start, mark, salt, deals, string = row
                if group != (mark, salt):
                    group, seen = (mark, salt), set()
                begin = None
                for at in range(len(string) - MATCH):  # the last byte is no part of the text
                    window = string[at:at + MATCH]
                    if window in seen:
                        begin = at if begin is None else begin
                        continue
                    seen.add(window)
                    if begin is not None:
                        found.append((*doc, start + begin, start + at - 1 + MATCH, None))
                        begin = None
                    if deals > 1:
                        found.append((*doc, start + at, start + at + MATCH, window))
                if begin is not None:
                    found.append((*doc, start + begin, start + len(string) - 1, None))
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            types = [pa.bool_(), *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    salted = edges.withColumn("salt", F.pmod(F.xxhash64("text_hash", "start"), F.col("deals")))
    grouped = salted.repartition("mark", "salt").sortWithinPartitions("mark", "salt", *DOC, "start")
    return grouped.mapInArrow(
        look_up, "no_id boolean, doc_id long, text_hash long, start long, end long, string binary"
    )


def _windows(batch: pa.RecordBatch) -> Iterator[Record]:
    docs = zip(*[batch.column(name).to_pylist() for name in (*DOC, "start")], strict=True)
    return zip(batch.column("string").to_pylist(), docs, strict=True)


def covered(docs: DataFrame, first: DataFrame, repeated_rows: bool) -> tuple[DataFrame, DataFrame]:
    """Spans (DOC, cover) of `docs` that repeat an earlier window, for those documents of `first`
    (DOC, one for each text) that have any, and the texts of these and others."""
    spark = docs.sparkSession
    several = repeated_anchors(docs).groupBy("text_hash").agg(F.collect_set("at").alias("spans"))
    spans = materialise(several.join(first, "text_hash").select(*DOC, "spans"), "repeated-anchors", "zstd")
    release(spark)
    texts = docs.join(spans, DOC)
    texts = materialise(texts.dropDuplicates(DOC) if repeated_rows else texts, "texts-with-anchors", "zstd")
    release(spark, spans)

    drawn = texts.select("text", F.explode("spans").alias("at")).select(
        F.expr("substring(text, int(shiftright(at, 14)) + 1, int(shiftright(at, 7) & 127) + 100)").alias("string")
    )
    count = texts.agg(F.sum(F.size("spans"))).first()[0] or 0
    stretches = first_places(texts.select(*DOC, "text", "spans"), _stretches, cut_strings(drawn, count), _gram)

    different = stretches.where(~F.col("again")).select(*DOC, "start", "mark", "string")
    deals = F.ceil(F.count(F.lit(1)) / GROUP_STRETCHES).alias("deals")
    marks = different.groupBy("mark").agg(F.count(F.lit(1)).alias("n"), deals).where("n > 1")
    marks = materialise(marks.select("mark", "deals"), "edge-marks")
    windows = materialise(_edge_windows(different.join(marks, "mark")), "edge-windows", "zstd")
    firsts = windows.where(F.col("string").isNotNull())
    again = first_places(firsts, _windows, cut_strings(firsts.select("string"), firsts.count()))
    end = F.col("start") + F.col("size")
    cover = (
        stretches.where("again").select(*DOC, "start", (end - 1).alias("end"))
        .unionByName(windows.where(F.col("string").isNull()).select(*DOC, "start", "end"))
        .unionByName(again.where("again").select(*DOC, "start", end.alias("end")))
    )
    gathered = cover.groupBy(*DOC).agg(F.collect_list(F.struct("start", "end")).alias("cover"))
    gathered = materialise(gathered, "covered-spans", "zstd")
    release(spark, stretches, marks, windows, again)
    return gathered, texts.drop("spans")


def _cut(texts: DataFrame) -> DataFrame:
    """Removed spans (maximal, in order) and what is kept, for covered texts."""
    names = [*DOC, "n_bytes", "digest", "removed", "kept"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 24):
            spans, kept = [], []
            for text, cover in zip(batch.column("text"), batch.column("cover"), strict=True):
                merged: list[list[int]] = []
                for begin, end in sorted((x["start"], x["end"]) for x in cover.as_py()):
                    if merged and begin <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([begin, end])
                rest, at = [], 0
                content = text.as_py()
                for begin, end in merged:
                    rest.append(content[at:begin])
                    at = end
                spans.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join([*rest, content[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in names[:5]]
                + [pa.array(spans, span), pa.array(kept, pa.binary())],
                names,
            )

    return texts.mapInArrow(
        run, "no_id boolean, doc_id long, text_hash long, n_bytes long, digest binary, "
        "removed array<struct<start:long,end:long>>, kept binary"
    )


def suffix_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, removed (maximal spans of bytes), kept (the
    bytes that remain; null if all do), text_sha256.

    Removed is each byte in a string of MATCH bytes that also starts earlier: in a smaller id, or
    earlier in the document.  Null ids come last; texts that share an id are ordered by a hash of
    the text, and of rows that repeat id and text one is the first.  Null and empty texts have no
    bytes.  Other columns are not read.  Runs jobs when called.
    """
    known = _identified(docs, id, text)
    rows = numbered(known.drop("text"), "row", "text-digests")
    first = materialise(
        rows.groupBy("digest").agg(F.min(F.struct(*DOC, "row")).alias("first")), "first-texts"
    )
    repeated_rows = not rows.groupBy(*DOC).count().where("count > 1").isEmpty()
    cover, texts = covered(known, first.select("first.*").select(*DOC), repeated_rows)

    placed = rows.join(first.withColumnRenamed("digest", "_digest"), rows["digest"] == F.col("_digest"))
    copy = F.col("row") != F.col("first.row")
    none = F.array().cast("array<struct<start:long,end:long>>")
    whole_text = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    gone = copy & (F.col("n_bytes") >= MATCH)
    others = (
        placed.join(cover.select(*DOC, F.lit(True).alias("has")), DOC, "left")
        .where(copy | F.col("has").isNull())
        .select(
            *DOC, "n_bytes", "digest", F.when(gone, whole_text).otherwise(none).alias("removed"),
            F.when(gone, F.lit(b"")).alias("kept"),
        )
    )
    return _cut(texts.join(cover, DOC)).unionByName(others).select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "n_bytes", "removed", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
