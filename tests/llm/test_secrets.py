"""The secret scan against scanners written without patterns."""

import hashlib
import random
import string

import pytest

from sessionloom.llm import queries, secrets

VALUE = set(string.ascii_letters + string.digits + "+/_.=-")
NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey"]
ORDER = ["assign", "access", "hex", "learned"]


def run_from(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def assign_at(text, at):
    lower = "".join(c.lower() if c in string.ascii_uppercase else c for c in text[at:at + 8])
    name = next((x for x in NAMES if lower.startswith(x)), None)
    if name is None:
        return None
    at += len(name)
    at += text[at:at + 1] in ("'", '"') and at < len(text)
    at = run_from(text, at, " ")
    if text[at:at + 1] not in (":", "="):
        return None
    at = run_from(text, at + 1, " ")
    at += text[at:at + 1] in ("'", '"') and at < len(text)
    end = run_from(text, at, VALUE)
    return (end, end - at) if end > at else None


def brute_base(text):
    found = []
    for kind in ORDER[:3]:
        at = 0
        while at < len(text):
            if kind == "assign":
                match = assign_at(text, at)
                least = 6
            elif kind == "access":
                end = run_from(text, at + 4, string.ascii_uppercase + string.digits) if text[at:at + 4] == "AKIA" else at
                match, least = ((end, end - at) if end > at + 4 else None), 20
            else:
                end = run_from(text, at, "0123456789abcdef")
                match, least = ((end, end - at) if end > at else None), 24
            if match is None:
                at += 1
                continue
            if match[1] >= least:
                found.append((at, ORDER.index(kind), match[0]))
            at = match[0]
    return sorted(found)


def brute_parts(text):
    """Strings of six or more characters of values that base matches leave."""
    free = [c in VALUE for c in text]
    for start, _, end in brute_base(text):
        free[start:end] = [None] * (end - start)
    parts, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and free[end]:
            end += 1
        if end - at >= 6:
            parts.append((at, end))
        at = max(end, at + 1)
    return parts


def make_texts(seed=4, count=260):
    draw = random.Random(seed)
    pick = lambda alphabet, n: "".join(draw.choice(alphabet) for _ in range(n))
    key = lambda: pick(string.ascii_uppercase + string.digits, 4) + "." + pick("0123456789", 6)
    parts = "the tion and er ed of it in house over night no thing where ver peo ple".split()
    said = ["".join(draw.choices(parts, k=draw.randrange(1, 5))) for _ in range(800)]
    texts = [None, "", "password=", "token:'short'", "AKIA", "secret =  \"a.b.c.d\"", "x" * 3000,
             "0123456789abcdef0123456789abcdef-ZZZZYYYYXXXXWWWW1234", "tOKEN: tokentoken: tokentoken",
             "apikey==abcdef passwd='' password: 'p", "AKIA" + "A1" * 20 + "tail-piece", "é" * 9 + "secret=ééé"]
    for _ in range(count):
        words = [draw.choice(said) for _ in range(draw.randrange(3, 20))]
        kind = draw.random()
        extra = (f"token = '{key()}'" if kind < 0.5 else f"api_key:{key()}" if kind < 0.7 else pick("0123456789abcdef", 32) if kind < 0.8 else "")
        words.insert(draw.randrange(len(words)), extra)
        texts.append(" ".join(words))
    bare = [key() for _ in range(20)]
    texts += [f"we {draw.choice(said)} {x} over it" for x in bare]
    texts += [f"left {pick('0123456789abcdef', 30)}-{x}, it" for x in bare]
    return texts, bare


@pytest.fixture(scope="module")
def scanned(spark, tmp_path_factory):
    texts, bare = make_texts()
    folder = str(tmp_path_factory.mktemp("secrets"))
    rows = [(i, text, "a", "b") for i, text in enumerate(texts)]
    rows += [rows[20]] * 3 + [(None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, base string, learned string")
    frame.write.parquet(f"{folder}/documents.parquet")
    found = queries.op6_secret_scan(spark, folder).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((r[0] is None, r[0] or 0) for r in rows)
    return texts, bare, found


def spelt(spans):
    return ",".join(f"{ORDER[kind]}:{start}:{end}" for start, kind, end in spans)


def test_base_spans_counts_and_digests(scanned):
    texts, _, found = scanned
    for row in found:
        text = (texts[row.doc_id] if row.doc_id is not None else None) or ""
        base = brute_base(text)
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == kind for _, k, _ in base) for kind in range(3)]
        assert row.base_sha256 == hashlib.sha256(spelt(base).encode()).hexdigest()
        spans = [x.split(":") for x in row.spans.split(",") if x]
        spans = [(int(start), ORDER.index(kind), int(end)) for kind, start, end in spans]
        assert spans == sorted(spans) and [x for x in spans if x[1] < 3] == base
        assert {(start, end) for start, kind, end in spans if kind == 3} <= set(brute_parts(text))


def test_bare_keys_are_found_by_their_format(scanned):
    """Ten characters with a dot, and what follows a base match in the same run."""
    texts, bare, found = scanned
    learned, wrong = set(), 0
    for row in found:
        text = (texts[row.doc_id] if row.doc_id is not None else None) or ""
        for span in row.spans.split(","):
            kind, start, end = span.split(":") if span else ("", 0, 0)
            if kind == "learned":
                part = text[int(start):int(end)].strip("-")
                learned.add(part) if part in bare else None
                wrong += part.isalpha() and part.islower()
    assert len(learned) >= 18 and wrong <= 3


def test_candidates():
    for text in [x for x in make_texts(9, 80)[0] if x]:
        known = secrets.base_spans(text)
        assert [(start, kind, end) for start, end, kind in [(a, b, ORDER.index(k)) for a, b, k, _ in known]] == brute_base(text)
        assert list(secrets.candidates(text, known)) == brute_parts(text)


def test_least_hashes_are_kept():
    values = [str(n) for n in range(5000)]
    whole, parts = secrets.Least(100), [secrets.Least(100) for _ in range(7)]
    for at, value in enumerate(values * 2):
        whole.add(value)
        parts[at % 7].add(value)
    best = lambda some: sorted(set().union(*[own.held.items() for own in some]))[:100]
    assert best([whole]) == best(parts) and len(whole.held) <= 200


def test_long_text_and_empty_table(spark, no_docs):
    text = "secret = abcdef " + "word " * 100_000 + "x" * 200_000
    row = secrets.secret_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(x.start, x.end, x.kind) for x in row.base] == [(0, 15, "assign")]
    assert secrets.secret_scan(no_docs).count() == 0
