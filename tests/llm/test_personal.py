"""Personal data against Python's own pattern engine, and the query against its SQL."""

import re

import pytest

from sessionloom.llm.personal import AFTER, BEFORE, DOUBT, KINDS, personal_data, sums_before
from pyspark.sql import functions as F

TEXTS = [
    None, "", "nothing here", "a@b.c_d@e.f.g", "a@b a@b. a@.b @b.c a.b+c%d@x-y.z9.", "x@y.z@w.v",
    "1.2.3.4 256.1.1.1 1.2.3 01.002.0003.255 1.2.3.4.5.6.7.8 999999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "0000 0000 0000",
    "+49 (30) 1234.567-8", "+1 234", "++12345678901", "+1((((((((", "+123456789012345678",
    "IBAN DE89 3704 0044 0532 0130 00 AND MORE", "GB82WEST12345698765432", "ES9121000418450200051332 X",
    "DE89 3704 0044 0532 0130 01", "my ssn is 123-45-6789.", "123-45-6789", "ssn 000-12-3456",
    "born 3.4.1980", "version born 3.4.1980", "on 3.4.1980", "dob: 31/12/1999", "birthday 32-1-2001",
    "é日本 \U0001F600 mail: \U0001F600a@b.deé card 378282246310005\n+1 (555) 010-9999",
    "a@b.c " * 700, "sample a@b.c", "5" * 5000, "x" * 50_000 + "@y.z", "1.1.1.1 " * 600,
]


def brute(text):
    text, found = text or "", []
    for order, kind in enumerate(KINDS):
        end = 0
        matches = list(re.finditer(kind.pattern, text, re.ASCII))
        for at, match in enumerate(matches):
            before = text[end:match.start()][-BEFORE:]
            after = text[match.end():matches[at + 1].start() if at + 1 < len(matches) else None][:AFTER]
            end, value = match.end(), match[0]
            digits = re.sub("[^0-9]", "", value)
            near = lambda words: any(
                re.search(f"(?i)(?:^|[^A-Za-z])(?:{words})(?:[^A-Za-z]|$)", x, re.ASCII) for x in (before, after)  # noqa: B023
            )
            if kind.name == "ip":
                value = value if all(int(x) <= 255 for x in value.split(".")) else None
            elif kind.name == "card":
                doubled = [int(x) * (1 + i % 2) for i, x in enumerate(reversed(digits))]
                good = 12 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
                value = value if good else None
            elif kind.name == "phone":
                value = value if 9 <= len(digits) <= 15 else None
            elif kind.name == "iban":
                def holds(x):
                    x = x.replace(" ", "")
                    return 15 <= len(x) <= 34 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1
                shorter = re.sub(r"\x20[A-Z0-9]{1,4}$", "", value)
                value = value if holds(value) else shorter if holds(shorter) else None
            elif kind.name == "ssn":
                value = None if re.search("^(000|666|9)|-00-|-0000$", value) or not near(kind.words) else value
            elif kind.name == "birth":
                day, month = map(int, re.split("[./-]", value)[:2])
                good = 1 <= min(day, month) <= 12 and max(day, month) <= 31
                value = value if good and near(kind.words) and not near(DOUBT) else None
            if value is not None:
                score = kind.score + 0.4 * near(kind.words) - 0.3 * near(DOUBT)
                found.append((match.start(), order, kind.name, match.start() + len(value), round(min(score, 1.0), 2)))
    return sorted(found)


def spans(row):
    return [(x.start, x.order, x.kind, x.end, round(x.score, 2)) for x in row.spans]


def test_spans(spark):
    frame = spark.createDataFrame([(i, x, "a", "b") for i, x in enumerate(TEXTS)], "doc_id long, text string, spans string, _text string")
    found = {row.doc_id: spans(row) for row in personal_data(frame).collect()}
    for i, text in enumerate(TEXTS):
        assert found[i] == brute(text), text and text[:80]


def test_rows_and_empty_table(docs, rows, no_docs):
    found = personal_data(docs).collect()
    assert sorted(map(repr, ((r.doc_id, spans(r)) for r in found))) == sorted(map(repr, ((r.doc_id, brute(r.text)) for r in rows)))
    assert personal_data(no_docs).count() == 0


def test_further_kinds_need_words_and_base_kinds_do_not(spark):
    kinds = lambda text: [x.kind for x in personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans]
    assert kinds("GB82 WEST 1234 5698 7654 32 is it") == ["iban"]
    assert kinds("123-45-6789") == [] and kinds("taxpayer 123-45-6789") == ["ssn"]
    assert kinds("example a@b.c") == ["email"]


def test_no_python_in_the_plan(docs):
    plan = personal_data(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("size", [1, 255, 256, 257, 3000])
def test_sums(spark, size):
    found = spark.range(1).select(sums_before(F.sequence(F.lit(1).cast("long"), F.lit(size).cast("long")))).first()[0]
    assert found == [k * (k + 1) // 2 for k in range(size)]
