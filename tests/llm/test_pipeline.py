"""The pipeline against a brute-force account of its stages."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from sessionloom.llm import mixing

from .test_near_text import brute_kept
from .test_operators import measures


def test_stages_follow_each_other():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "near-dedup", "source mix", "token ids"
    ]


def test_rows(spark, docs, rows, tmp_path):
    """With near copies on both sides of the bound, which fingerprints would tell otherwise."""
    said = "the cat of the house sat on a mat and it was good for all that is to be with you".split()
    long_ = " ".join(f"{word} {at}" for at, word in enumerate(said * 4))
    for number, text in ((900, long_), (901, long_ + " end"), (902, long_.replace(" 7 ", " other ").replace(" 40 ", " other ").replace(" 60 ", " x "))):
        rows = [*rows, type(rows[0])(*[number, text, "en", "s1", number, "x"])]
    docs = spark.createDataFrame(rows, docs.schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = docs.collect()
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    good = []
    for row in rows:
        n, chars, symbols, lines, dup, repeated, stop = measures(row.text)
        if n >= 20 and 100 * repeated <= 30 * n and 2 <= chars / n <= 20 and symbols / n <= 0.1:
            if stop / n >= 0.02 and dup / lines <= 0.6:
                good.append(row)
    order = lambda row: (row.doc_id is None, row.doc_id or 0)
    first = {}
    for row in sorted(good, key=order):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", row.text), row)
    numbered = list(enumerate(sorted(first.values(), key=order)))
    stays = brute_kept([(at, row.text) for at, row in numbered])
    left = [row for at, row in numbered if at in stays]
    assert 2 < len(left) < len(numbered)

    # The mix is checked in its own tests; here its copies are taken as given.
    frame = spark.createDataFrame(left, docs.schema)
    copies = {r.doc_id: r.copies for r in mixing.mix(frame).collect() if r.copies}
    assert Counter(r.doc_id for r in found) == Counter(copies)

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {row.doc_id: row.text for row in left}
    for row in found:
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(texts[row.doc_id])
        assert row.text_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_stages_keep_columns_and_take_empty_tables(spark, docs, no_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, no_docs, "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, "").count() == 0
