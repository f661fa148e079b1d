"""Phrase collocations from weighted acyclic automata.

Each shard of the texts counts its n-grams, sorts them and builds count transducers, one for each
language and prefix range.  A prefix range is a share of the hash values of the first word, within
it a share of those of the second and of the third, so that ranges are even without a sample and
no first word is too much for one.  All transducers of a range are united, counts added, and what
stays below the least count is dropped: nothing rarer can be part of a phrase that counts.  The
parts of phrases are looked up by composing automata of the parts asked for with those counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.session import materialise

from .rows import whole
from .transducer import Transducer, build, composed, merged

LEAST = 10
TOP = 2000
# Words of a shard, bytes of text taken at once, and bytes of text for each prefix range.
SHARD_WORDS = 5_000_000
WINDOW = 1 << 22
RANGE_BYTES = 1 << 24
# Into how many parts a language's phrases are dealt to be ranked.
RANKED_APART = 16

# ASCII letters in lower case, piece ends as full stops, tabs as spaces.
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"." * 10 + b" "
)


def _windows(text: bytes) -> Iterator[list[bytes]]:
    """The words, with `.` at the ends of pieces, of one part of the text after the other."""
    text, start = text.translate(_FOLD), 0
    while start < len(text):
        end = text.find(b" ", start + WINDOW)
        end = len(text) if end < 0 else end
        yield text[start:end].replace(b".", b" . ").split()
        start = end


class Shard:
    """Numbers of the words of one language in order; 0 at the ends of pieces and texts.

    `before` are the two words that the shard follows: they are context and not counted.
    """

    def __init__(self, before: tuple[bytes, bytes] = (b".", b".")):
        self.numbers: dict[bytes, int] = {b".": 0}
        self.parts: list[np.ndarray] = []
        self.before, self.size = before, 0
        self.add(list(before))
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        numbers = self.numbers
        for word in set(words):
            if word not in numbers:
                numbers[word] = len(numbers)
        self.parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)
        self.before = (*self.before, *words[-2:])[-2:]

    def grams(self) -> tuple[list[bytes], list[tuple[np.ndarray, np.ndarray]]]:
        """Sorted words and, for each length, n-grams as rows of their numbers, and counts; those
        that end in one of the words added."""
        words = sorted(self.numbers.keys() - {b"."})
        place = np.zeros(len(self.numbers), np.int32)
        place[[self.numbers[word] for word in words]] = np.arange(1, len(words) + 1)
        ids, wide = place[np.concatenate(self.parts)], len(words) + 1
        self.parts.clear()
        third, second, first = ids[2:], ids[1:-1], ids[:-2]
        count = np.bincount(third, minlength=wide)
        single = np.flatnonzero(count[1:]) + 1
        found = [(self._rows(single), count[single])]
        both = (second > 0) & (third > 0)
        pair, count = np.unique(second[both] * np.int64(wide) + third[both], return_counts=True)
        found.append((self._rows(pair // wide, pair % wide), count))
        # A pair's own number keeps a triple below 64 bits.
        three = both & (first > 0)
        begin = first[three] * np.int64(wide) + second[three]
        pair = np.unique(begin)
        own = np.searchsorted(pair, begin)
        del begin, both
        triple, count = np.unique(own * wide + third[three], return_counts=True)
        pair = pair[triple // wide]
        found.append((self._rows(pair // wide, pair % wide, triple % wide), count))
        return words, found

    @staticmethod
    def _rows(*columns: np.ndarray) -> np.ndarray:
        return np.column_stack([column.astype(np.int32) for column in columns]) - np.int32(1)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(word, 42) for word in words], np.uint64)


def ranges_of(hashes: np.ndarray, rows: np.ndarray, bits: int) -> np.ndarray:
    """The prefix range, a number of `bits` bits, of each n-gram, given as numbers of hashed words:
    shares of the hashes of its words in order.  Where a gram has no further word, its own hash
    tells the share."""
    own = hashes[rows]
    end = np.full(len(rows), 42, np.uint64)
    for column in own.T:
        end = (end ^ column) * np.uint64(0x9E3779B97F4A7C15)
        end ^= end >> np.uint64(29)
    later = bits // 3
    out = np.zeros(len(rows), np.int64)
    for depth, share in enumerate((bits - 2 * later, later, later)):
        value = own[:, depth] if depth < own.shape[1] else end * np.uint64(2 * depth + 1)
        if share:
            out = out << share | (value >> np.uint64(64 - share)).astype(np.int64)
    return out


def by_range(words: list[bytes], grams: list[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[tuple[int, bytes]]:
    """A transducer for each prefix range that has n-grams; `grams` as in `Shard.grams`."""
    parts, hashes = [], hashes_of(words)
    for rows, count in grams:
        part = ranges_of(hashes, rows, bits)
        order = np.argsort(part, kind="stable")
        parts.append((rows[order], count[order], np.searchsorted(part[order], np.arange((1 << bits) + 1))))
    for number in range(1 << bits):
        cut = [(rows[at[number]:at[number + 1]], count[at[number]:at[number + 1]]) for rows, count, at in parts]
        if any(len(count) for _, count in cut):
            used = np.zeros(len(words), bool)
            for rows, _ in cut:
                used[rows.ravel()] = True
            place = np.cumsum(used) - 1
            listed = [words[at] for at in np.flatnonzero(used).tolist()]
            yield number, build(listed, [(place[rows], count) for rows, count in cut]).to_bytes()


def shards(rows: DataFrame, bits: int) -> DataFrame:
    """lang, part (the prefix range), blob (a count transducer) and n, the words of a shard, in one
    of its rows, for rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Shard] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, shard in list(open_.items()):
                words, grams = shard.grams()
                n = int(grams[0][1].sum())
                for part, blob in by_range(words, grams, bits):
                    yield pa.RecordBatch.from_pylist(
                        [{"lang": lang, "part": part, "blob": blob, "n": n}],
                        pa.schema([("lang", pa.string()), ("part", pa.int64()), ("blob", pa.binary()), ("n", pa.int64())]),
                    )
                    n = 0
            open_.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for words in _windows(text.as_py()):
                    shard = open_.get(lang) or open_.setdefault(lang, Shard())
                    shard.add(words)
                    if sum(one.size for one in open_.values()) >= SHARD_WORDS:
                        before = shard.before
                        yield from counted()
                        open_[lang] = Shard(before)
                if lang in open_:
                    open_[lang].add([b".", b"."])
        yield from counted()

    return rows.mapInArrow(run, "lang string, part long, blob binary, n long")


def united(rows: DataFrame, least: int) -> DataFrame:
    """lang, part, blob, n: the union of all transducers of a prefix range, from `least` on, and
    the sum of n."""

    def run(table: pa.Table) -> pa.Table:
        blob = merged([Transducer.from_bytes(x.as_py()) for x in table.column("blob")], least).to_bytes()
        return table.slice(0, 1).select(["lang", "part"]).append_column(
            "blob", pa.array([blob], pa.binary())
        ).append_column("n", pa.array([sum(table.column("n").to_pylist())], pa.int64()))

    return rows.groupBy("lang", "part").applyInArrow(run, "lang string, part long, blob binary, n long")


def listed(counts: DataFrame) -> DataFrame:
    """lang, words (an array), a for each n-gram of transducers."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.binary())), ("a", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob")):
                found = Transducer.from_bytes(blob.as_py())
                for rows, count in found.paths():
                    grams = [[found.words[at] for at in row] for row in rows.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.list_(pa.binary())), pa.array(count, pa.int64())],
                        schema=schema,
                    )

    return counts.select("lang", "blob").mapInArrow(run, "lang string, words array<binary>, a long").withColumn(
        "words", F.transform("words", lambda x: x.cast("string"))
    )


def looked_up(parts: DataFrame, counts: DataFrame, bits: int) -> DataFrame:
    """lang, phrase, count for distinct parts (lang, phrase) of at most two words."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = []
            for phrase in batch.column("phrase"):
                words = phrase.as_py().split(b" ")
                numbers.append(int(ranges_of(hashes_of(words), np.arange(len(words))[None, :], bits)[0]))
            yield batch.append_column("part", pa.array(numbers, pa.int64()))

    def compose(asked: pa.Table, own: pa.Table) -> pa.Table:
        lang = [*asked.column("lang").to_pylist()[:1], *own.column("lang").to_pylist()[:1]][0]
        grams = sorted(x.as_py().split(b" ") for x in asked.column("phrase"))
        words = sorted({word for gram in grams for word in gram})
        number = {word: at for at, word in enumerate(words)}
        by_length = []
        for length in (1, 2, 3):
            rows = [[number[word] for word in gram] for gram in grams if len(gram) == length]
            by_length.append((np.array(rows, np.int64).reshape(-1, length), np.ones(len(rows), np.int64)))
        found = [
            pair for blob in own.column("blob")
            for pair in composed(build(words, by_length), Transducer.from_bytes(blob.as_py()))
        ]
        return pa.table({
            "lang": pa.array([lang] * len(found), pa.string()),
            "phrase": pa.array([phrase for phrase, _ in found], pa.binary()),
            "count": pa.array([count for _, count in found], pa.int64()),
        })

    placed = parts.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(
        place, "lang string, phrase binary, part long"
    )
    found = placed.groupBy("lang", "part").cogroup(counts.drop("n").groupBy("lang", "part")).applyInArrow(
        compose, "lang string, phrase binary, count long"
    )
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def _joined(words: Column, first: int, count: Column | int) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the `top` phrases of two and three
    words by score, then count, then phrase.

    a, l, r count the phrase and the two parts of its worst cut, n the language's words, all over
    the whole table; score is floor(1000000 a a / (l r)), exact (decimals of 38 digits, so counts
    up to 10^15).  Phrases under `least`, and those within a longer phrase that is at least half
    as frequent, are left out.  A null lang is `und`, null and empty texts have no words, repeated
    rows count as often as they occur, ids and other columns are not read.  A long text is taken
    in parts of some MB, of which only the last two words carry over.  Runs jobs when called.
    """
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), whole(F.col(text)).cast("binary").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / RANGE_BYTES))))
    counts = materialise(united(shards(rows, bits), least), "united-counts")
    words = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    grams = materialise(listed(counts).where(F.size("words") > 1), "frequent-phrases")
    length = F.size("words")
    cuts = grams.withColumn("k", F.explode(F.sequence(F.lit(1), length - 1))).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "k",
        _joined(F.col("words"), 1, F.col("k")).alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, length), " ").alias("rest"),
    )
    parts = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).distinct()
    found = materialise(looked_up(parts, counts, bits), "parts-of-phrases")
    number = lambda name: F.col(name).cast("decimal(19,0)")
    small = F.col("a").cast("decimal(15,0)")
    scored = (
        cuts.join(found.toDF("lang", "first", "l"), ["lang", "first"])
        .join(found.toDF("lang", "rest", "r"), ["lang", "rest"])
        .withColumns({"_above": F.lit(1000000).cast("decimal(7,0)") * small * small, "_below": number("l") * number("r")})
        .withColumn("score", F.expr("_above div _below"))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = grams.where(length == 3).select("lang", "a", F.explode(F.array(
        _joined(F.col("words"), 1, 2), _joined(F.col("words"), 2, 2)
    )).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    # Ranked among some of a language's phrases first, so that few meet for the last ranking.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_APART))).orderBy(*order)
    best = Window.partitionBy("lang").orderBy(*order)
    return (
        scored.join(inner, ["lang", "phrase"], "left")
        .where(F.coalesce(2 * F.col("longer") < F.col("a"), F.lit(True)))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(best).cast("long"))
        .where(F.col("rank") <= top)
        .join(words, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
