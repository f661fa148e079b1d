"""Byte-level BPE: encoding with token offsets, and decoding.

Texts are cut into pieces without a regular expression.  Each character becomes a symbol (its
class, refined by what follows it), each symbol a function on the states of a small automaton,
and composing functions is associative, so the states at all characters come from a blocked
prefix scan over whole arrays of texts.  A character's state and symbol say whether a piece
starts there.  Pieces are then merged by ranks; results are cached, as text repeats its words.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import pieces, unused, whole

# Texts are cut in batches of about so many bytes, and a worker's cache keeps so many pieces.
BATCH_BYTES = 1 << 20
CACHED_PIECES = 300_000

# Symbols.  Q1, Q2: an apostrophe before one or two letters of a contraction.  IN: white space
# before white space or the end; BLANK, LAST: a blank, other white space before anything else.
PAD, BREAK, LETTER, NUMBER, OTHER, Q1, Q2, IN, BLANK, LAST = range(10)
# States: at a fresh start; within a piece of letters, numbers, others, white space; after a
# blank that joins what follows; one or two letters before a contraction's end.
FRESH, LETTERS, NUMBERS, OTHERS, WHITE, JOIN, ONE, TWO = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at the symbol."""
    if symbol == PAD:
        return state, False
    if symbol == BREAK:
        return FRESH, True
    if symbol == LETTER:
        if state in (ONE, TWO):
            return (FRESH if state == ONE else ONE), False
        return LETTERS, state not in (LETTERS, JOIN)
    if symbol == NUMBER:
        return NUMBERS, state not in (NUMBERS, JOIN)
    if symbol in (OTHER, Q1, Q2):
        if symbol == OTHER or state in (OTHERS, JOIN):
            return OTHERS, state not in (OTHERS, JOIN)
        return (ONE if symbol == Q1 else TWO), True
    if symbol == IN:
        return WHITE, state != WHITE
    return (JOIN if symbol == BLANK else FRESH), True


def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function numbers of the symbols, products of functions, the state each function leads to
    from a fresh start, and whether a piece starts at [state, symbol]."""
    states = range(8)
    functions = {tuple(states): 0}
    of_symbol = []
    for symbol in range(10):
        f = tuple(_step(state, symbol)[0] for state in states)
        of_symbol.append(functions.setdefault(f, len(functions)))
    size = 0
    while size < len(functions):
        size = len(functions)
        for f in list(functions):
            for g in list(functions):
                functions.setdefault(tuple(g[s] for s in f), len(functions))
    product = np.array(
        [[functions[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8
    )
    reached = np.array([f[FRESH] for f in functions], np.uint8)
    starts = np.array([[_step(state, symbol)[1] for symbol in range(10)] for state in states])
    return np.array(of_symbol, np.uint8), product, reached, starts


def _scan(functions: np.ndarray, product: np.ndarray, block: int = 64) -> np.ndarray:
    """The product of all functions up to each place."""
    flat, n = product.ravel(), len(product)

    def times(f: np.ndarray, g: np.ndarray) -> np.ndarray:
        return flat.take(f.astype(np.uint16) * n + g)

    if len(functions) <= block:
        found = functions.copy()
        for at in range(1, len(found)):
            found[at] = product[found[at - 1], found[at]]
        return found
    blocks = -(-len(functions) // block)
    padded = np.zeros(blocks * block, np.uint8)
    padded[: len(functions)] = functions
    table = np.ascontiguousarray(padded.reshape(blocks, block).T)
    for at in range(1, block):
        table[at] = times(table[at - 1], table[at])
    before = np.concatenate([np.zeros(1, np.uint8), _scan(table[-1], product)[:-1]])
    return times(np.broadcast_to(before, table.shape), table).T.ravel()[: len(functions)]


def class_table() -> bytes:
    """The symbol of each code point, as the library's own character classes have it."""
    points = np.array([*range(0xD800), *range(0xE000, 0x110000)], np.uint32)
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    single = {bytes([byte]): byte for byte in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, symbol in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", IN)):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        inside = bytes(found.encode_ordinary(text)).decode()
        table[np.frombuffer(inside.encode("utf-32-le"), "<u4")] = symbol
    return table.tobytes()


class Cutter:
    """Cuts texts into pieces."""

    def __init__(self, classes: bytes):
        self.classes = np.frombuffer(classes, np.uint8)
        self.of_symbol, self.product, self.reached, self.starts = _automaton()

    def cut(self, texts: list[str]) -> Iterator[list[str]]:
        if not texts:
            return
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        breaks = np.cumsum([len(text) + 1 for text in texts]) - 1
        symbols = self.classes.take(points)
        symbols[breaks] = BREAK
        after = np.append(symbols[1:], np.uint8(BREAK))
        last = (symbols == IN) & (after != IN) & (after != BREAK)
        symbols[last] = np.where(points[last] == 32, BLANK, LAST)
        for at in np.flatnonzero(points == 39).tolist():
            if joined[at + 1] in "stmd":
                symbols[at] = Q1
            elif joined[at + 1:at + 3] in ("re", "ve", "ll"):
                symbols[at] = Q2
        # The last character of `joined` is a break, so at + 1 above exists.
        reached = self.reached.take(_scan(self.of_symbol.take(symbols), self.product))
        states = np.append(np.uint8(FRESH), reached[:-1])
        starts = np.flatnonzero(self.starts[states, symbols])
        ends = np.searchsorted(starts, breaks).tolist()
        places = starts.tolist()
        first = 0
        for end in ends:
            yield [joined[a:b] for a, b in pairwise(places[first:end + 1])]
            first = end + 1


class Merger(dict):
    """Packed ids of a piece (unsigned 32-bit, little-endian), computed when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = np.array(self.merge(piece.encode()), "<u4").tobytes()
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Merges the pair of lowest rank, the leftmost of several, until there is none."""
        rank = self.ranks.get
        if (whole_piece := rank(piece)) is not None:
            return [whole_piece]
        parts = [piece[i:i + 1] for i in range(len(piece))]
        if len(parts) > 60:
            return self._merge_long(parts)
        pairs = [rank(a + b, 1 << 40) for a, b in pairwise(parts)]
        while pairs:
            least = min(pairs)
            if least == 1 << 40:
                break
            at = pairs.index(least)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], 1 << 40)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], 1 << 40)
        return [self.ranks[part] for part in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        """The same with a heap of pairs, for pieces of any length."""
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(at: int) -> None:
            if 0 <= at and right[at] < n:
                found = self.ranks.get(parts[at] + parts[right[at]])
                if found is not None:
                    heapq.heappush(heap, (found, at, len(parts[at]), len(parts[right[at]])))

        for at in range(n - 1):
            offer(at)
        while heap:
            _, at, own, other = heapq.heappop(heap)
            after = right[at]
            if len(parts[at]) != own or after >= n or len(parts[after]) != other:
                continue  # one of the two has been merged since
            parts[at] += parts[after]
            parts[after] = b""
            right[at] = right[after]
            if right[at] < n:
                left[right[at]] = at
            offer(left[at])
            offer(at)
        return [self.ranks[part] for part in parts if part]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, ids, starts.

    `ids` are packed unsigned 32-bit integers, little-endian; `starts` has, packed alike, the
    byte in the text's UTF-8 at which each token starts.  Null and empty texts have no tokens.
    Bytes that are no UTF-8 count as the replacement character.  Other columns are not read.
    The rank file, read by the driver, is some 50,000 entries; its size is that of a vocabulary.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(path))
    classes = zlib.compress(class_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, merger = Cutter(zlib.decompress(classes)), Merger(ranks.value)
        lengths = np.zeros(max(merger.ranks.values(), default=0) + 1, np.int64)
        lengths[list(merger.ranks.values())] = [len(token) for token in merger.ranks]
        for batch in pieces(batches, "text", BATCH_BYTES):
            texts = [value.as_py().decode(errors="replace") for value in batch.column("text")]
            ids = [b"".join(map(merger.__getitem__, found)) for found in cutter.cut(texts)]
            if len(merger) > CACHED_PIECES:
                merger.clear()
            starts = []
            for packed in ids:
                sizes = lengths.take(np.frombuffer(packed, "<u4"))
                starts.append((np.cumsum(sizes) - sizes).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(packed) // 4 for packed in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(starts, pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids", "starts"],
            )

    rows = docs.select(
        F.col(id).alias("doc_id"), whole(F.col(text)).cast("binary").alias("text")
    )
    shape = rows.select(
        "doc_id", F.lit(0).cast("long").alias("n_tokens"), F.col("text").alias("ids"),
        F.col("text").alias("starts"),
    )
    return rows.mapInArrow(run, shape.schema)


def decode(
    encoded: DataFrame, path: str, ids: str = "ids", span: tuple[int, int] | None = None,
    starts: str = "starts",
) -> DataFrame:
    """`encoded` with the bytes that its packed ids stand for, as the column `decoded`.

    With a `span` of bytes only those are decoded, from the tokens that `starts` says hold them.
    Null ids give no bytes.  Should `decoded` be taken, the name is lengthened by underscores.
    """
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    name = unused("decoded", encoded.columns)
    columns = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sorted(ranks.value.items(), key=lambda item: item[1])
        table = np.frombuffer(b"".join(token for token, _ in tokens), np.uint8)
        size = np.zeros(max((rank for _, rank in tokens), default=0) + 1, np.int64)
        place = np.zeros_like(size)
        numbers = [rank for _, rank in tokens]
        size[numbers] = [len(token) for token, _ in tokens]
        place[numbers] = np.cumsum(size[numbers]) - size[numbers]

        def back(packed: bytes, block: int = 1 << 16) -> bytes:
            found = []
            every = np.frombuffer(packed, "<u4")
            for at in range(0, len(every), block):
                some = every[at:at + block]
                sizes = size.take(some)
                skip = place.take(some) - (np.cumsum(sizes) - sizes)
                found.append(table.take(np.repeat(skip, sizes) + np.arange(sizes.sum())).tobytes())
            return b"".join(found)

        def within(packed: bytes, places: bytes) -> bytes:
            begin, end = span
            at = np.frombuffer(places, "<u4")
            first = max(0, int(np.searchsorted(at, begin, "right")) - 1)
            last = int(np.searchsorted(at, end))
            if first >= last:
                return b""
            some = back(packed[4 * first:4 * last])
            return some[max(0, begin - int(at[first])):max(0, end - int(at[first]))]

        for batch in pieces(batches, ids, 4 * BATCH_BYTES):
            if span is None:
                found = [back(x.as_py() or b"") for x in batch.column(ids)]
            else:
                both = zip(batch.column(ids), batch.column(starts), strict=True)
                found = [within(x.as_py() or b"", at.as_py() or b"") for x, at in both]
            decoded = pa.array(found, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*columns, name])

    shape = encoded.withColumn(name, F.lit(b""))
    return encoded.mapInArrow(run, shape.schema)
