"""Alignment of two tokenizers against both libraries on whole texts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from sessionloom.llm.alignment import Aligner, alignment, byte_symbols

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n b", "a \n b \n", "x▁y", "▁",
    "<|endoftext|> and <s> </s> <unk>", "日本語 テキスト", "　a b c", "tab\t here\t", "é" * 90,
    "\x00 nul", "\x1c a\x1c b", "!!! ??? ...", "naïve  café   déjà", "12345 678 9", "a" * 70 + " " + "b" * 70,
    "it's we'll I'VE 'sx ½ \U0001F600!!", "line one.\nLine two.\n\n  indented", "word " * 300, "  a  b",
]


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B_PATH)


def brute_groups(libraries, text):
    """Groups of a whole text as pairs of lists of ids; None if a tokenizer does not spell it."""
    a, b = libraries
    if not text:
        return []
    symbols = byte_symbols()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    of_a = [bytes(symbols[x] for x in a.id_to_token(i)) for i in ids_a]
    of_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    content = (" " + text).encode()
    if b"".join(of_a) != content or b"".join(of_b) != content:
        return []
    ends = lambda parts: [sum(map(len, parts[:k + 1])) for k in range(len(parts))]
    ends_a, ends_b = ends(of_a), ends(of_b)
    groups, last = [], 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        inside = lambda ids, at: [i for i, end in zip(ids, at) if last < end <= cut]  # noqa: B023, E731
        groups.append((inside(ids_a, ends_a), inside(ids_b, ends_b)))
        last = cut
    return groups


def brute(libraries, texts):
    groups = [brute_groups(libraries, text) for text in texts]
    links = [[(x, y) for a, b in own for x in a for y in b] for own in groups]
    count = Counter(pair for own in links for pair in set(own))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    rows = []
    for own, pairs in zip(groups, links):
        spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        rows.append((
            sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(pairs),
            sum(count[pair] == most[pair[0]] for pair in pairs), sum(count[pair] for pair in pairs),
            hashlib.sha256(spelt.encode()).hexdigest() if own else "",
        ))
    return rows


@pytest.mark.parametrize("few", [10**6, 0])
def test_measures(spark, docs, rows, libraries, few):
    frame = spark.createDataFrame([(1000 + i, x) for i, x in enumerate(ODD)], "doc_id long, text string")
    both = docs.select("doc_id", "text", "_row", "kept").unionByName(frame, allowMissingColumns=True)
    found = alignment(both, A_PATH, B_PATH, few=few)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    ids = [row.doc_id for row in rows] + [1000 + i for i in range(len(ODD))]
    expected = [(i, *x) for i, x in zip(ids, brute(libraries, [r.text for r in rows] + ODD))]
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, expected))


def test_words_are_cut_where_neither_goes_on(libraries, texts):
    aligner = Aligner(open(A_PATH, "rb").read(), open(B_PATH, "rb").read())
    for text in [x for x in [*ODD, *texts] if x]:
        words = aligner.words(text)
        assert "".join(words) == " " + text and all(word[0] == " " for word in words)
        assert not any("▁" in piece[1:].lstrip("▁") for piece in map(aligner.b.id_to_piece, range(32000)))


def test_empty_table(no_docs):
    assert alignment(no_docs, A_PATH, B_PATH).count() == 0


def test_long_text(spark, libraries):
    text = "Several words, again and again; " * 30_000
    row = alignment(spark.createDataFrame([(1, text)], "doc_id long, text string"), A_PATH, B_PATH).first()
    a, b = libraries
    assert row.n_a == len(a.encode(" " + text, add_special_tokens=False).ids) and row.n_b == len(b.encode(text))
    assert row.count_sum == row.n_links >= row.n_a
