"""Count transducers and phrases against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sessionloom.llm import phrases
from sessionloom.llm.phrases import collocations, hashes_of, ranges_of
from sessionloom.llm.transducer import Transducer, build, composed, merged


def drawn(seed, words=12, count=400):
    draw = random.Random(seed)
    names = [bytes(draw.choice(b"abc\xc3") for _ in range(draw.randrange(1, 6))) for _ in range(words)]
    return Counter(tuple(draw.choice(names) for _ in range(draw.randrange(1, 4))) for _ in range(count))


def transducer(counts):
    words = sorted({word for gram in counts for word in gram})
    number = {word: at for at, word in enumerate(words)}
    grams = []
    for length in (1, 2, 3):
        own = sorted((tuple(number[w] for w in gram), n) for gram, n in counts.items() if len(gram) == length)
        grams.append((
            np.array([g for g, _ in own], np.int64).reshape(-1, length), np.array([n for _, n in own], np.int64)
        ))
    return build(words, grams)


def content(found):
    return {
        tuple(found.words[at] for at in row): n
        for rows, counts in found.paths() for row, n in zip(rows.tolist(), counts.tolist())
    }


@pytest.mark.parametrize("seed", range(6))
def test_transducers(seed):
    counts = drawn(seed)
    found = transducer(counts)
    assert content(found) == counts
    assert content(Transducer.from_bytes(found.to_bytes())) == counts
    parts = [drawn(seed * 10 + k, count=50 * k) for k in range(4)]
    total = sum(parts, Counter())
    assert content(merged([transducer(part) for part in parts])) == total
    frequent = {gram: n for gram, n in total.items() if n >= 5}
    assert content(merged([transducer(part) for part in parts], 5)) == frequent
    asked = Counter({gram: 1 for gram in drawn(seed + 77)} | {gram: 1 for gram in list(total)[::3]})
    expected = sorted((b" ".join(gram), n) for gram, n in total.items() if gram in asked)
    assert sorted(composed(transducer(asked), transducer(total))) == expected


def test_equal_states_are_shared():
    counts = {(first, second, b"z"): 1 for first in (b"a", b"b", b"c") for second in (b"x", b"y")}
    found = transducer(counts)
    assert len(found.first) - 1 == 4 and len(found.label) == 1 + 2 + 3


def test_ranges_of_equal_beginnings():
    words = [b"%d" % k for k in range(200)]
    rows = np.array([(1, k, j) for k in range(20) for j in range(50)])
    parts = ranges_of(hashes_of(words), rows, 9)
    assert len(set(parts >> 6)) == 1 and len(set(parts)) > 30
    alone = ranges_of(hashes_of(words), np.arange(200)[:, None], 9)
    assert len(set(alone)) > 100


def brute(rows, least, top):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        found = []
        candidates = {gram: a for gram, a in own.items() if len(gram) > 1 and a >= least}
        for gram, a in candidates.items():
            cuts = [(10**6 * a * a // (own[gram[:k]] * own[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            if not any(100 * b >= 50 * a and len(g) > len(gram) and gram in (g[:2], g[1:]) for g, b in candidates.items()):
                found.append((-score, -a, " ".join(gram).encode(), own[gram[:k]], own[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def talk(seed, count=120):
    draw = random.Random(seed)
    words = "Alpha beta gamma, delta. the of the of x\ty é Ünder ß".split(" ")
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(40))) for _ in range(count)]
    return [(draw.choice(["en", "de", None, "und"]), text) for text in texts] + [("en", None), ("fr", ""), (None, " \t\n")]


@pytest.mark.parametrize("setting", ["plain", "small", "ranges"])
def test_phrases(spark, monkeypatch, setting):
    if setting == "small":
        monkeypatch.setattr(phrases, "SHARD_WORDS", 37)
        monkeypatch.setattr(phrases, "WINDOW", 16)
    if setting != "plain":
        monkeypatch.setattr(phrases, "RANGE_BYTES", 300)
    rows = talk(3)
    frame = spark.createDataFrame([(1, *row, 7, 8) for row in rows], "doc_id long, lang string, text string, part long, n long").repartition(3)
    found = collocations(frame, least=5, top=25)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 25)


def test_documents_with_repeated_rows(docs, rows):
    found = collocations(docs, least=4)
    assert sorted(map(tuple, found.collect())) == brute([(r.lang, r.text) for r in rows], 4, 2000)


def test_empty_table_and_long_text(spark, no_docs):
    assert collocations(no_docs).count() == 0
    text = "one two three " * 400_000
    found = collocations(spark.createDataFrame([("en", text)], "lang string, text string")).collect()
    assert {(r.phrase, r.a) for r in found} == {("one two three", 400_000), ("two three one", 399_999), ("three one two", 399_999)}
    assert {r.n for r in found} == {1_200_000}
