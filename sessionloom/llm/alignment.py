"""Alignment of two tokenizers over the same text.

Texts are shuffled in full, so that equal ones meet; each distinct text is tokenised by both
vocabularies and aligned once, and the documents that have it weigh its pair counts.  Byte offsets
where tokens of both end cut a text into groups; every token of the one is linked to every token
of the other in its group.

Both tokenizers treat a word with the space before it apart from what surrounds it: the one splits
there before it merges, the other has no piece that goes on over a space.  So texts are cut there,
and an aligned word is remembered for the next time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.session import materialise, release

from .rows import pieces

BATCH_BYTES = 1 << 22
# Words remembered by a task, and pairs that it counts before it passes them on.
CACHED = 400_000
HELD_PAIRS = 2_000_000
# Pair counts of at most so many rows go to every task; more are joined by a shuffle.
FEW_PAIRS = 2_000_000

# A space that goes on after a character that is no white space of any kind, before more text.
_CUT = re.compile(r"(?<=\S)(?= (?!\Z))")
_ODD = re.compile(r"\s | \Z")
_MARK = "▁"


def byte_symbols() -> dict[str, int]:
    """The bytes that the characters of byte-level tokens stand for: printable ones themselves,
    the others, in order, the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + at): b for at, b in enumerate(others)}


class Aligner:
    """Aligns words by a byte-level vocabulary (A) and one of pieces (B), and remembers them.

    Words are numbered: `known` has the number of a word, -1 if the tokens do not spell it, and the
    lists and arrays below it have its measures, its groups as text, and where its pairs are.
    """

    def __init__(self, byte_level: bytes, piece_model: bytes):
        # A task has one core; the library would take all.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=piece_model)
        symbols = byte_symbols()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            self.bytes_a[number] = bytes(symbols.get(x, 255) for x in token)
        self.bytes_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            own = bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(_MARK, " ").encode()
            self.bytes_b.append(own)
        self.length_a, self.length_b = (np.array([*map(len, x)], np.int64) for x in (self.bytes_a, self.bytes_b))
        # A token's number as text with what follows it: in a group, after its A and its B tokens.
        spelt = [f"{number}{mark}" for mark in ",|" for number in range(len(self.bytes_a))]
        spelt += [f"{number}{mark}" for mark in ",;" for number in range(len(self.bytes_b))]
        self.spelt = np.array(spelt, object)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 3), np.int64)  # tokens of A and B, groups
        self.at, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        """Align words, each of which begins with a space.

        A word that ends in text is encoded by A in one text with others, of which it is apart.
        """
        apart = [word for word in words if not word[-1].isspace()]
        tails = [word for word in words if word[-1].isspace()]
        words = apart + tails
        joined = ["".join(apart[at:at + 1000]) for at in range(0, len(apart), 1000)]
        a = [self.a.encode(text, add_special_tokens=False).ids for text in joined + tails]
        b = self.b.encode([word[1:] for word in words], num_threads=1)
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
        content = [word.encode() for word in words]
        if self._spell(b"".join(content), a, b):
            self._align(words, np.cumsum([*map(len, content)]), a, b)
        elif len(words) == 1:
            self.known[words[0]] = -1
        else:  # halves, until what is not spelt is alone
            self.learn(words[::2])
            self.learn(words[1::2])

    def _spell(self, content: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        return all(
            b"".join(map(spelt.__getitem__, ids.tolist())) == content
            for spelt, ids in ((self.bytes_a, a), (self.bytes_b, b))
        )

    def _align(self, words: list[str], stops: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """All words at once: `stops` are their ends in bytes, one after the other."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)  # their groups
        in_a, in_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        word_of = np.searchsorted(stops, cuts)
        # Every A token with every B token of its group.
        times = in_b[of_a]
        each = np.repeat(np.arange(len(a)), times)
        other = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times) + first_b[of_a[each]]
        pairs = a[each] << 32 | b[other]
        # The groups as text: the A tokens of each, then its B tokens.
        wide_a, wide_b, start = len(self.bytes_a), len(self.bytes_b), first_a + first_b
        pieces_ = np.empty(len(a) + len(b), np.int64)
        place_a, place_b = np.arange(len(a)) - first_a[of_a], np.arange(len(b)) - first_b[of_b]
        pieces_[start[of_a] + place_a] = a + wide_a * (place_a == in_a[of_a] - 1)
        pieces_[start[of_b] + in_a[of_b] + place_b] = 2 * wide_a + b + wide_b * (place_b == in_b[of_b] - 1)
        spelt = self.spelt[pieces_].tolist()
        count = lambda of: np.bincount(word_of, of, len(words)).astype(np.int64)
        n_a, n_b, n_groups = count(in_a), count(in_b), np.bincount(word_of, minlength=len(words))
        stop = np.cumsum(n_a + n_b).tolist()
        self.known |= {word: len(self.groups) + at for at, word in enumerate(words)}
        self.groups += ["".join(spelt[begin:end])[:-1] for begin, end in zip([0, *stop], stop)]
        self.counts = np.concatenate([self.counts, np.column_stack([n_a, n_b, n_groups])])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(count(in_a * in_b))])
        self.pairs = np.concatenate([self.pairs, pairs])

    def texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text the numbers of its words, none if the tokens do not spell it."""
        cut = [self.words(text) for text in texts]
        distinct = {word for words in cut for word in words}
        fresh = distinct - self.known.keys()
        if len(self.known) + len(fresh) > CACHED:
            self._forget()
            fresh = distinct
        if fresh:
            self.learn(sorted(fresh))
        for words in cut:
            numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            yield numbers if len(words) and numbers.min() >= 0 else numbers[:0]

    def measures(self, numbers: np.ndarray) -> tuple:
        """Of the words of a text: tokens of A and B, groups and links, the digest of the groups,
        the distinct pairs and how often each is linked."""
        if not len(numbers):
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32)
        spelt = ";".join(map(self.groups.__getitem__, numbers.tolist()))
        words, often = np.unique(numbers, return_counts=True)
        size = self.at[words + 1] - self.at[words]
        flat = self.pairs[np.repeat(self.at[words] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        pairs, at = np.unique(flat, return_inverse=True)
        times = np.bincount(at, np.repeat(often, size), len(pairs)).astype(np.int64)
        n_a, n_b, n_groups = self.counts[numbers].sum(axis=0).tolist()
        digest = hashlib.sha256(spelt.encode()).hexdigest()
        return n_a, n_b, n_groups, int(times.sum()), digest, pairs, times.astype(np.int32)

    @staticmethod
    def words(text: str) -> list[str]:
        """The text with a space before it, cut before spaces where neither tokenizer goes on."""
        if not text:
            return []
        if _MARK in text or text[0] == " " or _ODD.search(text):
            return _CUT.split(" " + text)
        return [" " + word for word in text.split(" ")]


_MEASURES = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(rows: DataFrame, byte_level: bytes, piece_model: bytes) -> DataFrame:
    """`rows` (digest, copies, text) with n_a, n_b, n_groups, n_links, groups_sha256, pairs and
    times in place of the text: the distinct linked pairs, sorted, and how often each is linked."""
    files = rows.sparkSession.sparkContext.broadcast((byte_level, piece_model))  # two vocabularies
    kinds = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [*_MEASURES, "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        for batch in pieces(batches, "text", BATCH_BYTES):
            texts = [x.as_py().decode(errors="replace") for x in batch.column("text")]
            found = list(zip(*map(aligner.measures, aligner.texts(texts)))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("copies"), *map(pa.array, found, kinds)],
                ["digest", "copies", *names],
            )

    return rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        run, f"digest binary, copies long, {', '.join(f'{name} long' for name in _MEASURES)}, "
        "groups_sha256 string, pairs array<long>, times array<int>",
    )


def counted(texts: DataFrame) -> DataFrame:
    """pair, count for aligned texts with `copies`: how many documents hold it linked.

    A task adds up what it reads before pairs are shuffled, some millions at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            pair, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            weight = np.zeros(len(pair), np.int64)
            np.add.at(weight, at, np.concatenate([x for _, x in held]))
            return pair, weight

        size = 0
        for batch in batches:
            lists = batch.column("pairs")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            counts = np.repeat(batch.column("copies").to_numpy(), lists.value_lengths().to_numpy())
            held.append((values, counts))
            size += len(values)
            if size > 2 * HELD_PAIRS:
                held = [summed()]
                size = len(held[0][0])
                if size > HELD_PAIRS:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, held[0])], ["pair", "count"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.array, summed())], ["pair", "count"])

    parts = texts.select("pairs", "copies").mapInArrow(run, "pair long, count long")
    return parts.groupBy("pair").agg(F.sum("count").alias("count"))


def alignment(
    docs: DataFrame, byte_level_path: str, piece_model_path: str, id: str = "doc_id",
    text: str = "text", few: int = FEW_PAIRS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    A is a byte-level vocabulary of the tokenizers library, which gets the text after a space, B a
    model of sentencepiece, which adds one.  A pair's count is the number of documents, copies
    included, that hold it linked; n_best counts links whose count is the highest of their A
    token, ties included; count_sum adds up the counts of links.  Null and empty texts, and texts
    that the tokens of A or B do not spell, have zeros and no digest; bytes that are no UTF-8
    count as the replacement character.  Null ids and repeated rows are rows like any other; other
    columns are not read.  A long text is aligned in one piece, in memory in proportion to it.
    Runs jobs when called.
    """
    with open(byte_level_path, "rb") as a, open(piece_model_path, "rb") as b:
        files = a.read(), b.read()
    content = F.make_valid_utf8(F.col(text))
    some = F.col("text").isNotNull() & (F.col("text") != "")
    distinct = docs.select(content.alias("text")).where(some).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = distinct.select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text")
    texts = materialise(aligned(keyed, *files), "aligned-texts", "zstd")
    counts = materialise(counted(texts), "pair-counts")
    first = F.shiftright("pair", 32)
    best = counts.groupBy(first.alias("first")).agg(F.max("count").alias("most"))
    judged = materialise(
        counts.withColumn("first", first).join(best, "first")
        .select("pair", "count", (F.col("count") == F.col("most")).alias("best")),
        "judged-pairs",
    )
    release(docs.sparkSession, counts)
    # At most `few` rows go to every task; with more the join is left to a shuffle on the pair.
    looked = F.broadcast(judged) if judged.count() <= few else judged
    links = texts.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "digest", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times")
    )
    sums = links.join(looked, "pair").groupBy("digest").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    measures = materialise(
        texts.select("digest", *_MEASURES, "groups_sha256").join(sums, "digest", "left"), "alignment-measures"
    ).withColumnRenamed("digest", "_digest")
    release(docs.sparkSession, texts, judged)
    rows = docs.select(F.col(id).alias("doc_id"), content.alias("text")).select(
        "doc_id", F.when(some, F.unhex(F.sha2("text", 256))).alias("_of"),
        F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("_deal"),
    )
    # Rows without a text match nothing, but may be many: they are dealt evenly.
    deal = F.when(F.col("_of").isNull(), F.pmod("_deal", F.lit(4096))).otherwise(0)
    joined = rows.withColumn("_deal", deal).join(
        measures.withColumn("_deal", F.lit(0).cast("long")).withColumnRenamed("_deal", "_own"),
        (F.col("_of") == F.col("_digest")) & (F.col("_deal") == F.col("_own")), "left",
    )
    none = {name: F.coalesce(name, F.lit(0).cast("long")) for name in (*_MEASURES, "n_best", "count_sum")}
    return joined.withColumns(none | {"groups_sha256": F.coalesce("groups_sha256", F.lit(""))}).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
