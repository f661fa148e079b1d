"""Acyclic automata that map n-grams of up to three words to counts.

A state is a run of arcs (word, count, next state), sorted by word.  The words along a path are an
n-gram and the count of its last arc is the n-gram's, 0 for what is only the beginning of others.
States that agree in all their arcs are one state.  They are built from sorted n-grams from the
last words backwards, so a state's followers are final when it is looked up in the register.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

DEPTH = 3


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


@dataclass
class Transducer:
    """words: sorted; first[s] to first[s + 1]: the arcs of state s.  State 0 has none, and the
    last state is the start."""

    words: list[bytes]
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    def to_bytes(self) -> bytes:
        head = np.array([len(self.words), len(self.first), len(self.label)], "<i8").tobytes()
        return zlib.compress(b"".join([
            head, np.diff(self.first, prepend=0).astype("<i4").tobytes(), self.label.astype("<i4").tobytes(),
            self.weight.astype("<i8").tobytes(), self.target.astype("<i4").tobytes(), b" ".join(self.words),
        ]), 1)

    @staticmethod
    def from_bytes(blob: bytes) -> Transducer:
        data = zlib.decompress(blob)
        words, states, arcs = np.frombuffer(data, "<i8", 3).tolist()
        at = 24

        def numbers(kind: str, count: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(data, kind, count, at)
            at += values.nbytes
            return values.astype(np.int64)

        first, label, weight, target = (
            np.cumsum(numbers("<i4", states)), numbers("<i4", arcs), numbers("<i8", arcs),
            numbers("<i4", arcs),
        )
        return Transducer(data[at:].split(b" ") if words else [], first, label, weight, target)

    def paths(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length the n-grams with a count, as rows of word numbers, and their counts."""
        states, rows, found = np.array([len(self.first) - 2]), np.zeros((1, 0), np.int64), []
        for _ in range(DEPTH):
            count = self.first[states + 1] - self.first[states]
            arcs = np.repeat(self.first[states] - np.cumsum(count) + count, count) + np.arange(count.sum())
            rows = np.column_stack([np.repeat(rows, count, axis=0), self.label[arcs]])
            kept = self.weight[arcs] > 0
            found.append((rows[kept], self.weight[arcs][kept]))
            states = self.target[arcs]
        return found

    def arcs(self, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        span = slice(self.first[state], self.first[state + 1])
        return self.label[span], self.weight[span], self.target[span]


def build(words: list[bytes], grams: list[tuple[np.ndarray, np.ndarray]]) -> Transducer:
    """`grams`: for each length distinct rows of numbers into the sorted `words`, and counts."""
    wide = max(1, len(words))
    # Number the beginnings of each length: a beginning and a further word are one number.
    keys: list[np.ndarray] = []
    ends: list[list[np.ndarray]] = []
    for depth in range(DEPTH):
        parts = []
        for rows, _ in grams[depth:]:
            before = np.searchsorted(keys[-1], ends[-1][len(parts) + 1]) * wide if depth else 0
            parts.append(before + rows[:, depth])
        keys.append(np.unique(np.concatenate(parts)))
        ends.append(parts)
    states = np.zeros(len(keys[-1]), np.int64)
    sizes, arcs, made = [np.zeros(2, np.int64)], [np.zeros((0, 3), np.int64)], 1
    for depth in reversed(range(DEPTH)):
        count = np.zeros(len(keys[depth]), np.int64)
        if len(ends[depth][0]):
            count[np.searchsorted(keys[depth], ends[depth][0])] = grams[depth][1]
        run = np.column_stack([keys[depth] % wide, count, states])
        states = np.zeros(len(keys[depth - 1]) if depth else 1, np.int64)
        for owners, size, own in _registered(run, keys[depth] // wide):
            number, place = own
            states[owners] = made + place
            made += len(number)
            sizes.append(size)
            arcs.append(run[np.repeat(number - np.cumsum(size) + size, size) + np.arange(size.sum())])
    if not len(keys[0]):  # without n-grams: a start without arcs
        sizes.append(np.zeros(1, np.int64))
    label, weight, target = np.concatenate(arcs).T
    return Transducer(words, np.cumsum(np.concatenate(sizes)), label, weight, target)


def _registered(run: np.ndarray, parent: np.ndarray):
    """States with these arcs, equal ones as one, for arcs sorted by the number of the beginning
    that they go on from.  Yields beginnings, the numbers of arcs of each new state, and a pair:
    where in `run` each new state's arcs begin, and the new state of each beginning."""
    starts = _runs(parent)
    sizes = np.diff(np.r_[starts, len(parent)])
    single = sizes == 1
    at = starts[single]
    if len(at):
        # Most states have one arc: all of them are told apart at once.
        order = np.lexsort(run[at].T)
        new = np.r_[True, (run[at][order][1:] != run[at][order][:-1]).any(axis=1)]
        place = np.empty(len(at), np.int64)
        place[order] = np.cumsum(new) - 1
        number = at[order][new]
        yield parent[at], np.ones(len(number), np.int64), (number, place)
    register: dict[bytes, int] = {}
    begins, lengths, place = [], [], []
    for begin, size in zip(starts[~single].tolist(), sizes[~single].tolist()):
        state = register.setdefault(run[begin:begin + size].tobytes(), len(register))
        if state == len(begins):
            begins.append(begin)
            lengths.append(size)
        place.append(state)
    if begins:
        yield parent[starts[~single]], np.array(lengths), (np.array(begins), np.array(place))


def merged(parts: list[Transducer], least: int = 1) -> Transducer:
    """The union, counts of equal n-grams added; only counts from `least` on are kept."""
    words = sorted(set().union(*(part.words for part in parts)))
    number = {word: at for at, word in enumerate(words)}
    wide = max(1, len(words))
    maps = [np.fromiter(map(number.__getitem__, p.words), np.int64, len(p.words)) for p in parts]
    listed = [part.paths() for part in parts]
    grams = []
    for depth in range(DEPTH):
        rows = np.concatenate([own[one[depth][0]] for own, one in zip(maps, listed)] or [np.zeros((0, depth + 1), np.int64)])
        count = np.concatenate([one[depth][1] for one in listed] or [np.zeros(0, np.int64)])
        key = np.zeros(len(rows), np.int64)
        for column in rows.T:  # of equal beginnings and words; numbered anew to stay below 64 bits
            key = np.unique(key, return_inverse=True)[1] * wide + column
        order = np.argsort(key, kind="stable")
        starts = _runs(key[order])
        count = np.add.reduceat(count[order], starts) if len(starts) else count
        kept = count >= least
        grams.append((rows[order][starts][kept], count[kept]))
    if least > 1:  # words of which nothing is kept
        used = np.unique(np.concatenate([rows.ravel() for rows, _ in grams]))
        words = [words[at] for at in used.tolist()]
        grams = [(np.searchsorted(used, rows), count) for rows, count in grams]
    return build(words, grams)


def composed(asked: Transducer, counts: Transducer) -> list[tuple[bytes, int]]:
    """The n-grams of `asked` (space-joined) that `counts` has, with their counts: walks pairs of
    states from both starts, along arcs of the same word."""
    number = {word: at for at, word in enumerate(counts.words)}
    same = np.array([number.get(word, -1) for word in asked.words], np.int64)
    found, todo = [], [(len(asked.first) - 2, len(counts.first) - 2, b"")]
    while todo:
        a, b, prefix = todo.pop()
        label, weight, target = asked.arcs(a)
        own, count, below = counts.arcs(b)
        if not len(own) or not len(label):
            continue
        at = np.minimum(np.searchsorted(own, same[label]), len(own) - 1)
        for i in np.flatnonzero(own[at] == same[label]).tolist():
            j, phrase = at[i], prefix + asked.words[label[i]]
            if weight[i] and count[j]:
                found.append((phrase, int(count[j])))
            if target[i] and below[j]:
                todo.append((target[i], below[j], phrase + b" "))
    return found
