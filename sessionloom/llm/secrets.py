"""Secret scans: patterns, and formats learned from what the patterns find.

The patterns label credentials.  For each kind a prefix tree of labelled values is reduced by
merging states whose futures agree statistically (state merging under Hoeffding's bound), which
leaves a probabilistic automaton of the format.  The same is learned from ordinary strings.  All
candidate strings are then scored by how much likelier a format makes them than ordinary text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.session import drop, materialise

from .rows import pieces, whole

KINDS = ["assign", "access", "hex", "learned"]

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

# Candidates: what labelled values are made of, and as long.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")

# Values to learn from, of each kind and of ordinary strings, drawn by hash so that reruns agree: a
# bound of what the driver gathers.  Longer values are not drawn, since none is learned in part.
SAMPLE = 2000
LEARNED_LENGTH = 200
# Scores that a task remembers, by format.
REMEMBERED = 200_000
# Confidence of a state merge, and the log likelihood ratio that makes a secret: its mean by symbol,
# and its sum, which a few letters do not reach by chance.
ALPHA = 0.05
THRESHOLD = 0.5
EVIDENCE = 8.0

# Formats are told apart by character classes: a-f, g-z, A-F, G-Z, digits, and marks as they are.
SYMBOLS = str.maketrans(
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0" * 10 + "a" * 6 + "g" * 20 + "A" * 6 + "G" * 20,
)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """start, end, kind and value of each base match, in code points, in order."""
    found = []
    for match in ASSIGN.finditer(text):
        if len(match[2]) >= LEAST["assign"]:
            found.append((match.start(), match.end(), "assign", match[2]))
    for match in ACCESS.finditer(text):
        if len(match[0]) >= LEAST["access"]:
            found.append((match.start(), match.end(), "access", match[0]))
    for match in HEX.finditer(text):
        found.append((match.start(), match.end(), "hex", match[0]))
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def candidates(text: str, known: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int]]:
    """start and end of the strings that base matches leave; those are sorted by start.

    A run that a base match touches is cut there, and each part that is long enough is a
    candidate by itself.
    """
    at, reach = 0, 0
    for match in CANDIDATE.finditer(text):
        begin, end = max(match.start(), reach), match.end()
        while at < len(known) and known[at][0] < end:
            if known[at][0] - begin >= LEAST["assign"]:
                yield begin, known[at][0]
            reach = max(reach, known[at][1])
            begin, at = max(begin, reach), at + 1
        if end - begin >= LEAST["assign"]:
            yield begin, end


class Automaton:
    """A deterministic probabilistic automaton learned from strings by state merging.

    States are numbers; `next[state]` maps a symbol to the state it leads to, `count[state]` a
    symbol, or "" for the end, to how often it was seen there.
    """

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        for string in strings:
            self._add(string.translate(SYMBOLS))
        self._merge(alpha)
        self.logs: list[dict[str, float]] = []
        self.unseen: list[float] = []
        kinds = len({s for counts in self.count for s in counts}) + 1
        for counts in self.count:
            total = math.log(sum(counts.values()) + 0.1 * kinds)
            self.logs.append({s: math.log(n + 0.1) - total for s, n in counts.items()})
            self.unseen.append(math.log(0.1) - total)

    def _add(self, string: str) -> None:
        state = 0
        for s in string:
            self.count[state][s] = self.count[state].get(s, 0) + 1
            if s not in self.next[state]:
                self.next[state][s] = len(self.next)
                self.next.append({})
                self.count.append({})
            state = self.next[state][s]
        self.count[state][""] = self.count[state].get("", 0) + 1

    def _compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether the frequencies after both states, and after what follows them, agree."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = sum(self.count[a].values()), sum(self.count[b].values())
            bound = math.sqrt(math.log(2 / alpha) / 2) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for s in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a].get(s, 0) / n - self.count[b].get(s, 0) / m) > bound:
                    return False
                if s in self.next[a] and s in self.next[b]:
                    todo.append((self.next[a][s], self.next[b][s]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below `b` to the states from `a` on."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for s, n in self.count[b].items():
                self.count[a][s] = self.count[a].get(s, 0) + n
            for s, below in self.next[b].items():
                if s in self.next[a]:
                    todo.append((self.next[a][s], below))
                else:
                    self.next[a][s] = below

    def _merge(self, alpha: float) -> None:
        """Goes through the states next to those kept; each is merged with a kept one or kept."""
        kept = [0]
        while True:
            beside = [
                (state, s) for state in kept for s in sorted(self.next[state])
                if self.next[state][s] not in kept
            ]
            if not beside:
                break
            origin, s = beside[0]
            state = self.next[origin][s]
            same = next((other for other in kept if self._compatible(other, state, alpha)), None)
            if same is None:
                kept.append(state)
            else:
                self.next[origin][s] = same
                self._fold(same, state)
        number = {state: at for at, state in enumerate(kept)}
        self.count = [self.count[state] for state in kept]
        self.next = [{s: number[b] for s, b in self.next[state].items()} for state in kept]

    def score(self, coded: str) -> float:
        """Mean log probability of the symbols and the end; after an unseen one, from the start."""
        state, total = 0, 0.0
        for s in coded:
            total += self.logs[state].get(s, self.unseen[state])
            state = self.next[state].get(s, 0)
        return (total + self.logs[state].get("", self.unseen[state])) / (len(coded) + 1)


_SPAN = [pa.field("start", pa.int64()), pa.field("end", pa.int64())]
_BASE = pa.list_(pa.struct([*_SPAN, pa.field("kind", pa.string())]))
_LEARNED = pa.list_(pa.struct([*_SPAN, pa.field("score", pa.float64())]))


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("doc_id"), whole(F.col(text)).cast("binary").alias("text"))


class Least:
    """The formats of distinct values with the least hashes, a bounded number of them."""

    def __init__(self, most: int):
        self.most, self.held, self.bound = most, {}, 1 << 63

    def add(self, value: str) -> None:
        place = xxhash.xxh64_intdigest(value.encode()) >> 1
        if place < self.bound:
            self.held[place] = value.translate(SYMBOLS)
            if len(self.held) > 2 * self.most:
                self.held = dict(sorted(self.held.items())[:self.most])
                self.bound = max(self.held)


def drawn(docs: DataFrame, id: str, text: str, sample: int) -> DataFrame:
    """kind ("" for ordinary strings), place, format: of each task the values to learn from.

    Formats are symbol classes: no value leaves the task that read it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {kind: Least(sample) for kind in ("", *LEAST)}
        for batch in batches:
            for item in batch.column("text"):
                content = item.as_py().decode(errors="replace")
                known = base_spans(content)
                for _, _, kind, value in known:
                    if len(value) <= LEARNED_LENGTH:
                        kept[kind].add(value)
                for start, end in candidates(content, known):
                    if end - start <= LEARNED_LENGTH:
                        kept[""].add(content[start:end])
        rows = [(kind, *x) for kind, own in kept.items() for x in sorted(own.held.items())[:sample]]
        kinds, places, formats = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(places, pa.int64()), pa.array(formats, pa.string())],
            ["kind", "place", "format"],
        )

    return _texts(docs, id, text).select("text").mapInArrow(run, "kind string, place long, format string")


def learn(docs: DataFrame, id: str, text: str, sample: int = SAMPLE) -> dict[str, Automaton]:
    """Automata of the labelled kinds, and of ordinary strings under "".

    Learns from at most `sample` distinct values of each, those whose hashes are smallest in the
    whole table; so bounded is also what reaches the driver.  Ordinary strings that a format makes
    likelier may be credentials that no pattern labels: they are learned without in a second round.
    """
    found = materialise(drawn(docs, id, text, sample), "formats-to-learn")
    automata = {}
    for kind in ["", *LEAST]:
        rows = found.where(F.col("kind") == kind).select("place", "format").distinct()
        strings = [row.format for row in rows.orderBy("place", "format").limit(sample).collect()]
        if strings:
            automata[kind] = Automaton(strings)
            if kind == "":
                ordinary = strings
    drop(found)
    return without_credentials(automata, ordinary) if "" in automata else automata


def without_credentials(automata: dict[str, Automaton], ordinary: list[str]) -> dict[str, Automaton]:
    """The automata, that of ordinary strings learned without those that a format makes likelier."""
    formats = [automaton for kind, automaton in automata.items() if kind]
    if not formats:
        return automata
    usual = automata[""]
    kept = [x for x in ordinary if max(a.score(x) for a in formats) <= usual.score(x)]
    return automata | {"": Automaton(kept)} if kept else automata


def scored(docs: DataFrame, id: str, text: str, automata: dict[str, Automaton], threshold: float) -> DataFrame:
    """doc_id, base and learned spans: candidates that some format makes likely enough."""
    ordinary = automata.get("")
    formats = [automaton for kind, automaton in automata.items() if kind]

    def ratio(coded: str) -> float:
        if ordinary is None or not formats:
            return -math.inf
        return max(a.score(coded) for a in formats) - ordinary.score(coded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_ratios: dict[str, float] = {}
        for batch in pieces(batches, "text", 1 << 22):
            base, learned = [], []
            for item in batch.column("text"):
                content = item.as_py().decode(errors="replace")
                known, spans = base_spans(content), []
                base.append([dict(zip(("start", "end", "kind"), x)) for x in known])
                coded = content.translate(SYMBOLS)
                for start, end in candidates(content, known):
                    form = coded[start:end]
                    value = known_ratios.get(form)
                    if value is None:
                        if len(known_ratios) >= REMEMBERED:
                            known_ratios.clear()
                        value = known_ratios[form] = ratio(form)
                    if value > threshold and value * (end - start + 1) > EVIDENCE:
                        spans.append({"start": start, "end": end, "score": value})
                learned.append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, _BASE), pa.array(learned, _LEARNED)],
                ["doc_id", "base", "learned"],
            )

    rows = _texts(docs, id, text)
    span = "start:long,end:long"
    shape = rows.select(
        "doc_id", F.lit(None).cast(f"array<struct<{span},kind:string>>").alias("base"),
        F.lit(None).cast(f"array<struct<{span},score:double>>").alias("learned"),
    )
    return rows.mapInArrow(run, shape.schema)


def secret_scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: doc_id, base and learned, arrays of spans in code points.

    Base spans have a kind, learned ones a score; those lie outside the base spans and are at least
    six characters of what values are made of.  Null and empty texts have none.  Bytes that are no
    UTF-8 count as the replacement character.  Repeated rows each give a row, but a value counts
    once for learning, and ties of hashes are broken by the format; other columns are not read.  A
    long text costs in proportion to its length.  Without labelled credentials nothing is learned,
    and base spans remain.  Runs a job over the texts when called, to learn; the result reads them
    again.
    """
    return scored(docs, id, text, learn(docs, id, text, sample), threshold)
