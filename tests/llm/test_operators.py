"""Each operator against a brute-force account, on texts full of odd cases."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from .conftest import plain
from pyspark.sql import functions as F

from sessionloom.llm import (
    bpe, components, exact_dedup, license_scan, mixing, quality, queries, secrets, simhash,
    sorted_runs, suffix_dedup, token_counts, warc,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPACES = re.compile("[\x20\x09-\x0d]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text):
    return [w for w in SPACES.split(text or "") if w]


@pytest.fixture(scope="module")
def folder(docs, spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{path}/documents.parquet")
    return str(path)


# ---- byte-level BPE


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, folder, rows, library):
    found = queries.op1_byte_bpe(spark, folder)
    expected = []
    for row in rows:
        ids = library.encode_ordinary(row.text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((row.doc_id, len(ids), sha(packed), sha((row.text or "").encode())))
    assert plain(found) == sorted(expected, key=repr)


def test_pieces_equal_the_pattern():
    import random

    draw = random.Random(5)
    alphabet = "  \t\n 　'''sstmdrevlSaé1½!?日😀\x00"
    cutter = bpe.Cutter(bpe.class_table())
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(300))) for _ in range(300)]
    import regex

    assert list(cutter.cut(texts)) == [regex.findall(public_tokenizers.PATTERN, text) for text in texts]


def test_bpe_offsets_and_long_pieces(spark, library):
    text = "x" * 3000 + " the end of " + "é" * 500
    row = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS).first()
    ids = np.frombuffer(row.ids, "<u4").tolist()
    assert ids == library.encode_ordinary(text)
    starts = np.frombuffer(row.starts, "<u4").tolist()
    data = text.encode()
    assert [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])] == [
        library.decode_single_token_bytes(i) for i in ids
    ]


def test_spans_are_decoded(spark, docs, rows):
    encoded = bpe.encode(docs, RANKS)
    for begin, end in ((0, 10), (7, 200), (4990, 5010), (30, 30)):
        found = bpe.decode(encoded, RANKS, span=(begin, end)).collect()
        expected = sorted(((r.doc_id, (r.text or "").encode()[begin:end]) for r in rows), key=repr)
        assert sorted(((r.doc_id, bytes(r.decoded)) for r in found), key=repr) == expected


# ---- exact dedup


def test_exact_dedup(docs, rows):
    groups = defaultdict(list)
    key = lambda row: SPACES.sub(" ", row.text or "")
    for row in rows:
        groups[key(row)].append(row.doc_id)
    found = exact_dedup.exact_dedup(docs).collect()
    assert len(found) == len(rows)
    by_text = defaultdict(list)
    for row in found:
        by_text[row.text_sha256].append(row)
    assert len(by_text) == len(groups)
    for text, ids in groups.items():
        least = min((i is None, i or 0) for i in ids)
        keep = None if least[0] else least[1]
        some = by_text[sha(text.encode())]
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in some) == sorted((i is None, i or 0) for i in ids)
        assert {(r.keep_id, r.group_size) for r in some} == {(keep, len(ids))}
        assert [r.doc_id for r in some if r.kept] == [keep]


def test_index_goes_on(spark, tmp_path):
    path, shape = f"file://{tmp_path}/index", "doc_id long, text string"
    first = spark.createDataFrame([(5, "a  b"), (6, "c")], shape)
    index = exact_dedup.DigestIndex(spark, path, buckets=3)
    assert {r.doc_id for r in exact_dedup.exact_dedup(first, index).where("kept").collect()} == {5, 6}
    again = exact_dedup.DigestIndex(spark, path, buckets=3)
    second = spark.createDataFrame([(1, "a b"), (2, "d"), (3, "d")], shape)
    found = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in exact_dedup.exact_dedup(second, again).collect()}
    assert found == {1: (5, False, 1), 2: (2, True, 2), 3: (2, False, 2)}
    assert again.table().count() == 3


def test_a_batch_that_is_run_again_gives_the_same_rows(spark, docs, rows):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    other = spark.createDataFrame([(77, "known before"), (78, rows[0].text)], "doc_id long, text string")
    exact_dedup.exact_dedup(other, index)
    runs = [plain(exact_dedup.exact_dedup(docs, index)) for _ in range(3)]
    assert runs[0] == runs[1] == runs[2]
    assert sum(row[3] for row in runs[0]) == len({SPACES.sub(" ", r.text or "") for r in rows} - {SPACES.sub(" ", rows[0].text or "")})
    named = [plain(exact_dedup.exact_dedup(docs.limit(9), index, batch=name)) for name in ("b", "b", "c")]
    assert named[0] == named[1] == named[2] and not any(row[3] for row in named[0])
    index.close()
    exact_dedup.exact_dedup(docs).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("digests_") and t.name == index.name]


def test_index_is_merged_without_a_shuffle(spark, docs):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    exact_dedup.exact_dedup(docs, index)
    batch = index.table().select("digest", F.lit(1).alias("x"))
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    plan = index.lookup(batch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_keep_first(docs, rows):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [SPACES.sub(" ", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({SPACES.sub(" ", r.text or "") for r in rows})


# ---- WARC


@pytest.mark.parametrize("gzip", [False, True])
def test_archive_readers(gzip):
    import gzip as g

    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\nWARC/1.1\r\nhttp://x 0 1 a 5\n"
    fields = f"2 0 me\n{warc.ARC_FIELDS[2]}\n"
    file = f"filedesc://x 0 20200101000000 text/plain {len(fields)}\n{fields}\n".encode()
    file += f"http://a b/ 1.2.3.4 20200102030405 text/html 200 - - 0 x.arc {len(body)}\n".encode() + body + b"\n"
    file = g.compress(file[:100]) + g.compress(file[100:]) if gzip else file
    record, = warc.arc_records(file)
    assert record["URL"] == "http://a b/" and record["Result-code"] == "200" and record["body"] == body
    with pytest.raises(ValueError):
        list(warc.arc_records((file if not gzip else b"http://a 1 2 t 100\n")[:-5]))


def test_warc(spark, tmp_path):
    big, other = "<p>é</p>" * 200, "y" * 999
    pages = [(i, f"http://h/{i}", big) for i in (4, 9, 2)] + [
        (1, "a b\nc", other), (3, None, other), (5, "", None), (6, "u", ""), (7, "u", "z" * 1000),
        (7, "u", "z" * 1000), (None, "u", "WARC/1.1\r\n\r\n" * 200),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    found = warc.archive_pages(frame.repartition(3), folder=f"file://{tmp_path}/a")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect())
    expected = Counter()
    for i, _, html in pages:
        data = (html or "").encode()
        kind, of = "response", None
        if html == big and i != 9:
            kind, of = "revisit", 9
        if i == 7 and expected:
            kind, of = ("revisit", 7) if any(k[0] == 7 for k in expected) else (kind, of)
        expected[(i, len(data), hashlib.sha1(data).hexdigest(), kind, of)] += 1
    assert got == expected
    payloads = {r.page_id: r.payload for r in warc.read_warc(spark, f"file://{tmp_path}/a/warc").collect()}
    assert payloads[9].decode() == big and payloads[2] == b"" and payloads[1].decode() == other


def test_warc_of_nothing(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(none).count() == 0


# ---- quality rules


def measures(text):
    ws = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = {i + k for i in range(len(ws) - 7) if windows[tuple(ws[i:i + 8])] > 1 for k in range(8)}
    stop = sum(w.lower() in quality.STOP_WORDS for w in ws)
    return (
        len(ws), sum(map(len, ws)), len(re.findall("[#*$%&|<>]", text or "")), len(lines),
        len(lines) - len(set(lines)), len(covered), stop,
    )


def test_quality_rules(docs, rows):
    expected = []
    for row in rows:
        n, chars, symbols, lines, dup, repeated, stop = m = measures(row.text)
        failed = n < 20 or 100 * repeated > 30 * n
        kept = not failed and 2 <= chars / n <= 20 and symbols / n <= 0.1 and stop / n >= 0.02 and dup / lines <= 0.6
        expected.append((row.doc_id, *m, failed, kept))
    assert plain(quality.quality_rules(docs)) == sorted(expected, key=repr)
    assert 0 < sum(e[-1] for e in expected) < len(expected)


def test_keep_good(docs, rows):
    good = {r.doc_id for r in quality.quality_rules(docs).where("kept").collect()}
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == good


def test_repeated_words_of_a_long_text(spark):
    text = " ".join(["a b c d e f g h"] * 2000 + [str(i) for i in range(20000)])
    row = quality.quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_words == 36000 and row.n_repeat_words == 16000


# ---- mixing


def test_mix(docs, rows):
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for row in rows:
        sizes[row.source] += len(words(row.text))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, total, capped = {}, sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in sizes if s not in capped]
        share = rest / sum(weight[s] for s in free)
        target = {s: 3 * sizes[s] if s in capped else weight[s] * share for s in sizes}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    taken = Counter()
    for row in found:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(target[row.source])
        assert row.taken == row.copies * row.size <= 3 * row.size and len(row.positions) == row.copies
        assert all(0 <= x <= 1 for x in row.positions) and row.positions == sorted(row.positions)
        taken[row.source] += row.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(r.size for r in found if r.source == s) / 2 + 1e-6
    firsts = [r.positions[0] for r in found if r.positions]
    assert firsts == sorted(firsts) and len(firsts) < len(found)
    assert sorted(map(tuple, found), key=repr) == plain(mixing.mix(docs.repartition(5)))


def test_times_invert_the_integral(spark):
    shapes = [[1.0, 1.0], [0.5, 1.0, 1.5], [4.5, 3.0, 1.5], [0.0, 2.0, 0.0, 2.0]]
    rows = [(s, x / 20) for s in shapes for x in range(21)]
    frame = spark.createDataFrame(rows, "s array<double>, x double")
    areas = mixing._areas(F.col("s"))
    found = frame.withColumn("areas", areas).withColumn("u", mixing._time(F.col("s"), F.col("areas"), F.col("x")))
    for row in found.collect():
        at = np.linspace(0, row.u, 2001)
        due = np.trapezoid(np.interp(at, np.linspace(0, 1, len(row.s)), row.s), at)
        assert due == pytest.approx(row.x * row.areas[-1], abs=1e-4)


def test_mixture_repeats_documents(docs):
    taken = {(r.doc_id, r.size): r.copies for r in mixing.mix(docs).collect()}
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in mixing.mix(docs).collect())
    for key, n in Counter((r.doc_id, len(words(r.text))) for r in mixed.collect()).items():
        assert key in taken and n >= 1


def test_buckets_do_not_change_the_mix(spark, monkeypatch):
    rows = [(k, " ".join(["word"] * (1 + k * 7 % 23)), f"s{min(k % 7, 2)}") for k in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = []
    for size in (2000, 20, 5, 1):
        monkeypatch.setattr(mixing, "BUCKET_ROWS", size)
        found.append(plain(mixing.mix(frame)))
    assert found[0] == found[1] == found[2] == found[3]


def test_mix_without_ids(spark, monkeypatch):
    """Documents without an id are told apart by their texts, and fill more than one bucket."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    rows = [(None, f"text {k} " * (1 + k % 5), "a" if k % 3 else None) for k in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(frame).collect()
    assert len(found) == 90 and sum(r.size for r in found) == sum(len(words(text)) for _, text, _ in rows)
    for source in ("a", None):
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10
        assert max(r.copies for r in own) <= 3


# ---- secrets


def test_secret_scan(spark):
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(300)]
    labelled = [f'say token = "{h}" now' for h in hexes[:250]]
    prose = ["the thingtionedanereingtion of wordlikestringsandsuch is nothing-but-words"] * 3
    odd = ["secret: token: abcdef", "API_KEY=abc PASSWORD='hunter22'", "AKIA" + "B1" * 10, None, "",
           "paſſwd=toolong1 é token=éé", "AKIAABC"]
    bare = [f"lost {h.upper()} here" for h in hexes[250:260]]
    rows = list(enumerate([*labelled, *prose, *odd, *bare]))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in secrets.secret_scan(frame).collect()}
    for i, text in rows:
        spans = [(x.start, x.end, x.kind) for x in found[i].base]
        assert spans == [x[:3] for x in secrets.base_spans(text or "")]
        if i < len(labelled):
            assert [(text or "")[x.start:x.end] for x in found[i].base] == [f'token = "{hexes[i]}', hexes[i]]
        if len(labelled) <= i < len(labelled) + len(prose) + len(odd):
            assert not found[i].learned
    by_text = {text: [text[x.start:x.end] for x in found[i].base] for i, text in rows if text}
    assert by_text["secret: token: abcdef"] == []
    assert by_text["API_KEY=abc PASSWORD='hunter22'"] == ["PASSWORD='hunter22"]
    assert by_text["AKIAABC"] == [] and by_text["AKIA" + "B1" * 10] == ["AKIA" + "B1" * 10]


def test_formats_are_told_apart():
    import random

    draw = random.Random(3)
    make = lambda alphabet, n: "".join(draw.choice(alphabet) for _ in range(n))
    hexes = [make("0123456789abcdef", 40) for _ in range(300)]
    prose = [make(["the", "ing", "er", "tion", "ou"], 8) for _ in range(300)]
    format_, usual = secrets.Automaton(hexes[:200]), secrets.Automaton(prose[:200])
    ratio = lambda s: format_.score(s.translate(secrets.SYMBOLS)) - usual.score(s.translate(secrets.SYMBOLS))
    assert sum(ratio(s) > secrets.THRESHOLD for s in hexes[200:]) >= 99
    assert sum(ratio(s) > secrets.THRESHOLD for s in prose[200:]) == 0
    assert len(format_.count) < 40


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "plain words only")], "doc_id long, text string")
    assert secrets.secret_scan(frame).first().learned == []


# ---- token counts


def test_token_counts(docs, rows):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    expected = []
    for row in rows:
        text = row.text or ""
        n = len(model.encode(text))
        expected.append((row.doc_id, len(text.encode()), n, n > 4096))
    assert plain(token_counts.token_counts(docs, PIECES)) == sorted(expected, key=repr)


def test_counts_are_cached(spark, docs, rows):
    cache = token_counts.CountCache(spark, buckets=3)
    before = plain(token_counts.token_counts(docs, PIECES, cache))
    held = spark.table(cache.name)
    stored = held.count()
    assert stored == len({r.text or "" for r in rows})
    held.withColumn("n_tokens", F.lit(-1).cast("long")).write.parquet(f"{cache.path}-copy")
    assert plain(token_counts.token_counts(docs, PIECES, cache)) == before
    assert spark.table(cache.name).count() == stored
    token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), cache).collect()
    assert spark.table(cache.name).count() == 2 * stored


def test_copies_are_encoded_once(spark, monkeypatch):
    rows = [(1, "the same text")] * 500 + [(k, "the same text") for k in range(2, 50)] + [(None, "another")] * 9
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    encoded, encode = [], token_counts.encoded_counts
    monkeypatch.setattr(token_counts, "encoded_counts", lambda rows, *rest: encoded.append(rows.count()) or encode(rows, *rest))
    before = {t.name for t in spark.catalog.listTables()}
    found = token_counts.token_counts(frame, PIECES).collect()
    assert encoded == [2] and len(found) == len(rows)
    assert {t.name for t in spark.catalog.listTables()} == before


# ---- suffix dedup


def removed(texts: list[tuple[int, str]]):
    seen, found = set(), {}
    for i, text in sorted(texts):
        data = text.encode()
        covered = bytearray(len(data))
        for at in range(len(data) - 99):
            window = data[at:at + 100]
            if window in seen:
                covered[at:at + 100] = b"\1" * 100
            seen.add(window)
        spans = re.findall(b"\1+", bytes(covered))
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        found[i] = (len(data), sum(covered), len(spans), sha(kept))
    return found


def test_suffix_dedup(spark, folder, rows):
    by_id = defaultdict(list)
    for row in rows:
        by_id[row.doc_id].append(row)
    clear = [(i, some[0].text or "") for i, some in by_id.items() if len(some) == 1 and i is not None]
    # Texts that share an id come in some order, which matters to themselves alone.
    expected = removed([(r.doc_id if r.doc_id is not None else 10**9, r.text or "") for r in rows])
    found = {r.doc_id: tuple(r)[1:] for r in queries.op8_suffix_dedup(spark, folder).collect()}
    assert {i: found[i] for i, _ in clear} == {i: expected[i] for i, _ in clear}
    assert sum(e[1] > 0 for e in expected.values()) > 5


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_of_few_letters(spark, monkeypatch, seed):
    import random

    monkeypatch.setattr(sorted_runs, "PART_RECORDS", 300)
    monkeypatch.setattr(sorted_runs, "MOST_CUTS", 2 if seed == 2 else 20_000)
    monkeypatch.setattr(suffix_dedup, "GROUP_STRETCHES", 1 + 3 * (seed % 2))
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 1000)
    draw = random.Random(seed)
    base = "".join(draw.choice("abc ") for _ in range(2000))
    texts = []
    for i in range(30):
        text = "".join(draw.choice("ab \né") for _ in range(draw.randrange(200)))
        for _ in range(draw.randrange(4)):
            at = draw.randrange(1900)
            text += base[at:at + draw.randrange(60, 400)]
        texts.append((i, text + "xy" * draw.choice([0, 0, 150])))
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = {
        r.doc_id: (r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed),
                   r.text_sha256 if r.kept is None else sha(bytes(r.kept)))
        for r in suffix_dedup.suffix_dedup(frame).collect()
    }
    assert found == removed(texts)


def test_repeated_rows_keep_one(spark):
    text = "".join(sha(bytes([i])) for i in range(5))
    frame = spark.createDataFrame([(1, text), (1, text), (None, text), (0, None)], "doc_id long, text string")
    found = sorted((repr(r.doc_id), len(r.removed)) for r in suffix_dedup.suffix_dedup(frame).collect())
    assert found == [("0", 0), ("1", 0), ("1", 1), ("None", 1)]


def test_loser_tree():
    import random

    draw = random.Random(4)
    runs = []
    for run in range(7):
        strings = sorted({bytes(draw.choices(b"ab", k=draw.randrange(1, 9))) for _ in range(run * 9)})
        runs.append([(s, (False, draw.randrange(50), 0, 0)) for s in strings])
    merged = list(sorted_runs.LoserTree([sorted_runs.run_records(sorted_runs.front_code(r)) for r in runs]))
    assert [m[1:] for m in merged] == sorted(r for run in runs for r in run)
    for before, after in zip(merged, merged[1:]):
        assert after[0] == sorted_runs.common_prefix(before[1], after[1])


def test_strings_with_one_beginning_are_cut_apart(spark, monkeypatch):
    """100,000 different strings that share 24 bytes, sorted and merged in even ranges."""
    monkeypatch.setattr(sorted_runs, "PART_RECORDS", 10_000)
    strings = spark.range(100_000).select(
        F.concat(F.lit("the same twenty-four byte"), F.sha1(F.col("id").cast("string"))).cast("binary").alias("string")
    )
    cuts, deals = sorted_runs.cut_strings(strings, 100_000)
    assert len(cuts) >= 8 and deals == 1 and cuts == sorted(cuts)
    records = sorted((bytes(row[0]), (False, at, 0, 0)) for at, row in enumerate(strings.collect()))
    sizes = {part: sum(1 for _ in sorted_runs.run_records(run)) for part, run in sorted_runs.split_run(records, cuts)}
    assert sum(sizes.values()) == 100_000 and max(sizes.values()) < 20_000 and len(sizes) == len(cuts) + 1
    monkeypatch.setattr(sorted_runs, "MOST_CUTS", 3)
    few, deals = sorted_runs.cut_strings(strings, 100_000)
    assert len(few) <= 3 and deals == 4
    dealt = list(sorted_runs.split_run(records, few, deals))
    assert len({part for part, _ in dealt}) == len(dealt) > 9
    assert sorted(r for _, run in dealt for r in [x[1:] for x in sorted_runs.run_records(run)]) == records


def test_a_run_looks_up_few_of_many_cuts():
    class Counted(list):
        seen = 0

        def __getitem__(self, at):
            self.seen += 1
            return super().__getitem__(at)

    cuts = Counted(b"%08d" % n for n in range(100_000))
    records = [(b"%08d" % (n * 1000), (False, n, 0, 0)) for n in range(50)]
    parts = list(sorted_runs.split_run(records, cuts))
    assert len(parts) == 50 and cuts.seen < 50 * 20
    assert [r[1] for _, run in parts for r in sorted_runs.run_records(run)] == [r[0] for r in records]


def test_anchors_of_equal_windows_agree(monkeypatch):
    import random

    monkeypatch.setattr(suffix_dedup, "SEGMENT", 257)
    draw = random.Random(6)
    passage = bytes(draw.choices(b"abcdefgh ", k=300))
    find = suffix_dedup.Anchors()
    anchored = []
    for _ in range(5):
        before = bytes(draw.choices(b"abcdefgh ", k=draw.randrange(700)))
        at = {}
        for first, last, place, mark in find.of(before + passage + before):
            for f, l, p, m in zip(first, last, place, mark):
                at |= {w: (p - w, m) for w in range(f, l + 1)}
        assert sorted(at) == list(range(len(2 * before + passage) - 99))
        anchored.append([at[len(before) + w] for w in range(201)])
    assert all(a == anchored[0] for a in anchored)


# ---- SimHash


def brute_fingerprint(text):
    ws = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not ws:
        return 0
    shingles = [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [b" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Ids of each component by its least fingerprint, which is also given for each fingerprint;
    prints: (id, fingerprint)."""
    group = {fp: {fp} for _, fp in prints}
    for a in sorted(group):
        for b in sorted(group):
            if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
                group[a] |= group[b]
                for fp in group[b]:
                    group[fp] = group[a]
    found = defaultdict(list)
    for i, fp in prints:
        found[min(group[fp])].append(i)
    return found, {fp: min(group[fp]) for fp in group}


def brute_components(prints):
    """Least id of each fingerprint's component."""
    groups, roots = brute_groups(prints)
    least = {fp: min((i for i in ids if i is not None), default=None) for fp, ids in groups.items()}
    return {fp: least[root] for fp, root in roots.items()}


def test_simhash(docs, rows):
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    of = brute_components(prints)
    assert plain(simhash.simhash(docs)) == sorted(((i, f"{fp:016x}", of[fp]) for i, fp in prints), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_links_of_random_fingerprints(spark, seed):
    import random

    draw = random.Random(seed)
    fps = [draw.getrandbits(64) for _ in range(20)]
    for _ in range(150):
        fp = draw.choice(fps)
        for _ in range(draw.randrange(4)):
            fp ^= 1 << draw.randrange(64)
        fps.append(fp)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints = list(enumerate(fps))
    frame = spark.createDataFrame([(i, i, signed(fp)) for i, fp in prints], "_row long, _id long, fp long")
    found = {r.fp: r.component_id for r in simhash.near_components(frame).collect()}
    assert found == {signed(fp): least for fp, least in brute_components(prints).items()}


def test_masks_cover():
    masks = simhash.covering_masks(2)
    for a in range(64):
        for b in range(a, 64):
            assert any(not mask & (1 << a | 1 << b) for mask in masks)


def test_components_of_a_path(spark):
    frame = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (7, 600)], "a long, b long")
    found = components.components(frame).collect()
    assert {r.node for r in found} == {*range(201), 600} and len({r.root for r in found}) == 1


# ---- licences


def test_license_scan(spark):
    notices = [n for some in license_scan.NOTICES.values() for n in some]
    prose = [f"the {i} cats of the house sat on mats and it was {i * 7} times good" for i in range(300)]
    rows = [(i, text) for i, text in enumerate(prose)] + [
        (1000, "one line\n" + notices[0] + "\n\n \t\nlast"), (1001, "Licensed under the Zebra License."),
        (1002, None), (1003, ""),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = license_scan.train(license_scan.corpus_sample(frame, "text"))
    found = {r.doc_id: r for r in license_scan.license_scan(frame, model=model).collect()}
    assert found[1000].n_paragraphs == 3
    assert [(x.paragraph, x.family) for x in found[1000].licences] == [(1, "agpl")]
    assert [x.family for x in found[1001].licences] == ["unknown"]
    assert found[1002].n_paragraphs == found[1003].n_paragraphs == 0
    assert not any(found[i].licences for i in range(300))
    held_out = license_scan.examples(prose[::2], seed=77, variants=8)
    right = sum(model.judge(" ".join(words_))[0] == family for words_, family in held_out)
    assert right / len(held_out) > 0.95


# ---- empty tables


@pytest.mark.parametrize("run", [
    lambda d: bpe.decode(bpe.encode(d, RANKS), RANKS), exact_dedup.exact_dedup, exact_dedup.keep_first,
    quality.quality_rules, quality.keep_good, mixing.mix, mixing.mixture, secrets.secret_scan,
    lambda d: token_counts.token_counts(d, PIECES), suffix_dedup.suffix_dedup, simhash.simhash,
    license_scan.license_scan,
])
def test_no_documents(no_docs, run):
    assert run(no_docs).count() == 0
