"""Distributed merge sort of byte strings that never compares a known prefix again.

Each task sorts its strings into a run, one for each range of strings, and front-codes it: of a
string only what follows its common prefix with the one before is kept.  Ranges are cut by whole
strings, so that any two different ones can be told apart; beyond a bounded number of cuts a range
is dealt further by a hash of the string.  The runs of a range meet in one task, which merges them with a loser tree.  Beside its string every contender keeps
the length of its common prefix with the last winner of its match: the contender with the longer
one is smaller, and only equal ones are compared, from there on.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.session import materialise, release

# A task sorts so many strings at a time, and a range holds about so many.
RUN_RECORDS = 200_000
PART_RECORDS = 50_000
# Of each range so many strings are sampled, and so many cuts at most come to the driver.
SAMPLED = 300
MOST_CUTS = 20_000

# Where a string is: whether the document has no id, its id (0 then), a hash of its text, and the
# string's start.  Places are compared as tuples.
Place = tuple[bool, int, int, int]
Record = tuple[bytes, Place]

DOC = ["no_id", "doc_id", "text_hash"]
PLACE = "no_id boolean, doc_id long, text_hash long, start long"
# Packed around the rest of a string: lengths of shared prefix and rest, and the place.
_HEAD, _TAIL = "<II", "<?qqq"


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes need no look."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:  # they differ between low and high
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_code(records: list[Record]) -> bytes:
    """A sorted run, packed: length of the prefix shared with the string before, rest, place."""
    packed, last = [], b""
    for string, place in records:
        shared = common_prefix(last, string)
        packed += [
            struct.pack(_HEAD, shared, len(string) - shared), string[shared:],
            struct.pack(_TAIL, *place),
        ]
        last = string
    return zlib.compress(b"".join(packed), 1)


def run_records(packed: bytes) -> Iterator[tuple[int, bytes, Place]]:
    """The records of a front-coded run, each with the length of its shared prefix."""
    packed = zlib.decompress(packed)
    at, last = 0, b""
    while at < len(packed):
        shared, rest = struct.unpack_from(_HEAD, packed, at)
        at += struct.calcsize(_HEAD)
        last = last[:shared] + packed[at:at + rest]
        at += rest
        place = struct.unpack_from(_TAIL, packed, at)
        at += struct.calcsize(_TAIL)
        yield shared, last, place


class LoserTree:
    """Merges sorted runs; yields records with the prefix length shared with the one before."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, Place]]]):
        self.runs = runs
        self.size = 1
        while self.size < max(2, len(runs)):
            self.size *= 2
        # Contender: prefix length shared with the last winner it met, string, place, run.
        self.losers: list[tuple | None] = [None] * self.size
        self.winner = self._build(1)

    def _pull(self, run: int) -> tuple | None:
        if run >= len(self.runs):
            return None
        record = next(self.runs[run], None)
        return None if record is None else (*record, run)

    def _build(self, node: int) -> tuple | None:
        if node >= self.size:
            first = self._pull(node - self.size)
            return first and (0, *first[1:])
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, self.losers[node] = self._match(a, b)
        return winner

    @staticmethod
    def _match(a: tuple | None, b: tuple | None) -> tuple[tuple | None, tuple | None]:
        """Winner and loser of two contenders whose prefixes refer to the same string, the last
        winner, which is not larger than either.  The loser's prefix then refers to the winner."""
        if a is None or b is None:
            return (b, a) if a is None else (a, b)
        if a[0] != b[0]:
            # The longer prefix is the smaller string, and the loser shares the shorter one.
            return (a, b) if a[0] > b[0] else (b, a)
        shared = common_prefix(a[1], b[1], a[0])
        rest_a, rest_b = a[1][shared:shared + 1], b[1][shared:shared + 1]
        if (rest_a, a[2]) <= (rest_b, b[2]):
            return a, (shared, *b[1:])
        return b, (shared, *a[1:])

    def __iter__(self) -> Iterator[tuple[int, bytes, Place]]:
        while self.winner is not None:
            yield self.winner[:3]
            run = self.winner[3]
            contender = self._pull(run)  # its prefix refers to the winner, as the losers' do
            node = (self.size + run) // 2
            while node:
                contender, self.losers[node] = self._match(contender, self.losers[node])
                node //= 2
            self.winner = contender


def split_run(records: list[Record], cuts: list[bytes], deals: int = 1) -> Iterator[tuple[int, bytes]]:
    """A sorted run as part numbers and front-coded runs.

    Looks up the cuts between the run's own strings only, however many there are.  With several
    `deals` a range is dealt by the strings' hashes, so equal strings stay together.
    """
    begin = 0
    while begin < len(records):
        number, end = bisect_right(cuts, records[begin][0]), len(records)
        if number < len(cuts):
            end = bisect_left(records, cuts[number], begin, key=lambda record: record[0])
        if deals == 1:
            yield number, front_code(records[begin:end])
        else:
            dealt: dict[int, list[Record]] = {}
            for record in records[begin:end]:
                dealt.setdefault(xxhash.xxh64_intdigest(record[0]) % deals, []).append(record)
            for deal, some in dealt.items():
                yield number * deals + deal, front_code(some)
        begin = end


def cut_strings(strings: DataFrame, count: int) -> tuple[list[bytes], int]:
    """Strings that cut `strings` (`string` binary, one row each), of which there are `count`,
    into ranges, and into how many parts each is dealt so that one has about PART_RECORDS.

    Some in a thousand strings, drawn by hash, are ranked by Spark; only the cuts, MOST_CUTS at
    most, reach the driver.
    """
    parts = -(-count // PART_RECORDS)
    if parts < 2:
        return [], 1
    ranges = min(parts, MOST_CUTS)
    rate = min(1.0, SAMPLED * ranges / count)
    drawn = strings.where(
        F.pmod(F.xxhash64("string", F.lit(1)), F.lit(1 << 40)) < F.lit(int(rate * (1 << 40)))
    ).select("string")
    place = F.monotonically_increasing_id()
    ranked = materialise(drawn.orderBy("string").withColumn("place", place), "drawn-strings")
    piece = F.shiftright("place", 33).alias("piece")
    sizes = sorted(map(tuple, ranked.groupBy(piece).count().collect()))  # a row for each sorted piece
    before, total = [], 0
    for number, size in sizes:
        before.append((number, total))
        total += size
    if not total:
        return [], -(-parts // ranges)
    starts = strings.sparkSession.createDataFrame(before, "piece long, before long")
    at = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
    every = max(1, total // ranges)
    cuts = ranked.withColumn("piece", piece).join(F.broadcast(starts), "piece").where(at % every == every - 1)
    found = sorted({bytes(row[0]) for row in cuts.select("string").collect()})
    release(strings.sparkSession, ranked)
    return found, -(-parts // ranges)


def first_places(
    rows: DataFrame, make: Callable[[pa.RecordBatch], Iterator[Record]], cuts: tuple[list[bytes], int],
    mark: Callable[[bytes], int] | None = None,
) -> DataFrame:
    """Places of strings, and whether an equal string has a smaller place.

    `make` turns batches of `rows` into records.  A task reduces equal strings to the first before
    they are exchanged, so a string that is everywhere is one record per run.  Result: PLACE, size
    of the string and again; where a string is first and `mark` is given, its mark and itself.  A
    place that occurs twice with one string counts once.
    """
    names = ["part", "run", *DOC, "start", "size"]
    types = [pa.int32(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def table(kind, found: list[tuple], names: list[str], types: list):
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        return kind([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def sorted_run(records: list[Record]) -> pa.RecordBatch:
        records.sort()
        found, first = [], []
        for record in records:
            if not first or first[-1][0] != record[0]:
                first.append(record)
            elif first[-1][1] != record[1]:
                found.append((None, None, *record[1], len(record[0])))
        found += [(part, run, *[None] * 5) for part, run in split_run(first, *cuts)]
        return table(pa.RecordBatch.from_arrays, found, names, types)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[Record] = []
        for batch in batches:
            for record in make(batch):
                records.append(record)
                if len(records) == RUN_RECORDS:
                    yield sorted_run(records)
                    records = []
        yield sorted_run(records)

    shape = f"part int, run binary, {PLACE}, size int"
    sent = materialise(rows.mapInArrow(sort, shape), "sorted-runs", "zstd")
    found_names = [*names[2:], "again", "mark", "string"]
    found_types = [*types[2:], pa.bool_(), pa.int64(), pa.binary()]

    def merge(group: pa.Table) -> pa.Table:
        found, last, place = [], None, None
        for shared, string, at in LoserTree([run_records(run.as_py()) for run in group.column("run")]):
            if last is None or shared != len(string) or shared != len(last):
                last, place = string, at
                own = (mark(string), string) if mark else (None, None)
                found.append((*at, len(string), False, *own))
            elif at != place:
                found.append((*at, len(string), True, None, None))
        return table(pa.table, found, found_names, found_types)

    merged = (
        sent.where(F.col("part").isNotNull()).select("part", "run").groupBy("part")
        .applyInArrow(merge, f"{PLACE}, size int, again boolean, mark long, string binary")
    )
    local = sent.where(F.col("part").isNull()).select(
        *DOC, "start", "size", F.lit(True).alias("again"), F.lit(None).cast("long").alias("mark"),
        F.lit(None).cast("binary").alias("string"),
    )
    places = materialise(merged.unionByName(local), "string-places", "zstd")
    release(rows.sparkSession, sent)
    return places
