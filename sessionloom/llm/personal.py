"""Personal data: patterns propose spans, checks confirm them, nearby words adjust their score.

DataFrame functions only.  A pattern's matches and the pieces of text between them have lengths
that add up to where each match starts; what a match is near to is the ends of the pieces beside
it.  Four kinds are always kept (`BASE`); further ones are kept if their score is high enough.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import unused, whole

# Characters before and after a match that are looked at for words, and the change that they make.
BEFORE, AFTER = 48, 24
NEAR, AGAINST = 0.4, -0.3
THRESHOLD = 0.5
# Matches are counted up in blocks of so many, so that many matches cost in proportion.
BLOCK = 256

# What a word is beside, so that it is a whole word in any engine.
_WORD = "(?i)(?:^|[^A-Za-z])(?:{})(?:[^A-Za-z]|$)"
# Words that speak against personal data.
DOUBT = "example|sample|dummy|version|isbn|order|invoice|build|release"


@dataclass(frozen=True)
class Kind:
    """`pattern` as in the list of kinds; `linear` matches the same in time that grows with the
    text: runs are taken whole, and only from where they begin.  `confirm` maps a match to what
    remains of it, or null.  `score` is that of a confirmed match without words beside it."""

    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    words: str
    linear: str | None = None


def _kept(value: Column, holds: Column) -> Column:
    return F.when(holds, value)


def _digits(text: Column) -> Column:
    return F.transform(F.split(text, ""), lambda x: x.cast("int"))


def _small(parts: Column, most: int) -> Column:
    """Whether each text of digits is a number up to `most`, however many zeros lead it."""
    def holds(part: Column) -> Column:
        rest = F.ltrim(part, F.lit("0"))
        return (F.length(rest) <= len(str(most))) & (F.coalesce(rest.try_cast("int"), F.lit(0)) <= most)

    return F.forall(parts, holds)


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    doubled = lambda x, i: x * (1 + i % 2)
    parts = F.transform(_digits(F.reverse(digits)), lambda x, i: doubled(x, i) - F.when(doubled(x, i) > 9, 9).otherwise(0))
    return F.aggregate(parts, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number, letters and digits alone, leaves 1 modulo 97 as IBANs do."""
    turned = F.concat(F.substring(account, 5, 1 << 20), F.substring(account, 1, 4))
    number = lambda x: F.ascii(x) - F.when(x <= "9", 48).otherwise(55)
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda rest, x: (rest * F.when(x <= "9", 10).otherwise(100) + number(x)) % 97,
    ) == 1


def _card(value: Column) -> Column:
    digits = F.translate(value, " -", "")
    return _kept(value, F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False))


def _phone(value: Column) -> Column:
    return _kept(value, F.length(F.translate(value, "+ ().-", "")).between(9, 15))


def _iban(value: Column) -> Column:
    """The match, or, as the last group may be a word that follows, the match without it."""
    shorter = F.regexp_replace(value, r"\x20[A-Z0-9]{1,4}$", "")
    holds = lambda x: F.length(F.translate(x, " ", "")).between(15, 34) & mod97(F.translate(x, " ", ""))
    return F.when(holds(value), value).when(holds(shorter), shorter)


def _ssn(value: Column) -> Column:
    return _kept(value, ~value.rlike("^(000|666|9)|-00-|-0000$"))


def _birth(value: Column) -> Column:
    parts = F.split(value, "[./-]")
    part = lambda i: F.get(parts, i).cast("int")
    low, high = F.least(part(0), part(1)), F.greatest(part(0), part(1))
    return _kept(value, (low >= 1) & (low <= 12) & (high <= 31))


# The kinds in the order in which spans of one start are listed, base kinds first.
KINDS = [
    Kind(
        "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: x, 0.9,
        "mail|email|contact|write|reply",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    Kind(
        "ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda x: _kept(x, _small(F.split(x, r"\."), 255)), 0.6, "ip|address|host|server|login|from",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    ),
    Kind(
        "card", r"[0-9]([\x20-]?[0-9])+", _card, 0.7, "card|visa|credit|payment|karte|carte|tarjeta",
        r"[0-9](?:[\x20-]?[0-9])++",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6,
        "phone|tel|call|mobile|fax|telefon|handy",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})", _iban, 0.9,
        "iban|account|konto|compte|cuenta|bank",
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ssn, 0.4, "ssn|social|security|taxpayer",
    ),
    Kind(
        "birth", r"[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}", _birth, 0.3,
        "born|birth|birthday|dob|geboren|geburtstag|naissance|nacido|nacimiento",
    ),
]
BASE = [kind.name for kind in KINDS[:4]]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda total, x: total + x)


def _sums(numbers: Column, start: Column) -> Column:
    """`start` and the sums of it and the first, the first two, ... of a few numbers."""
    return F.aggregate(
        numbers, F.array(start), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    )


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def sums_before(numbers: Column) -> Column:
    """For each of an array of longs, one at least, the sum of those before it."""
    def added(blocks: Column) -> Column:
        totals = _sums(F.transform(blocks, _total), F.lit(0).cast("long"))
        return _with(totals, lambda starts: F.flatten(F.transform(blocks, lambda block, i: F.slice(
            _sums(block, F.get(starts, i)), 1, F.size(block)
        ))))

    cut = lambda all_of: F.transform(
        F.sequence(F.lit(1), F.size(all_of), F.lit(BLOCK)), lambda at: F.slice(all_of, at, BLOCK)
    )
    return _with(numbers, lambda all_of: _with(cut(all_of), added))


def _spans(kind: Kind, order: int, found: Column, pieces: Column, starts: Column) -> Column:
    """Confirmed matches as structs, with their scores."""
    def span(value: Column, i: Column) -> Column:
        before, after = F.get(pieces, i), F.get(pieces, i + 1)
        near = lambda words: (
            F.right(before, F.lit(BEFORE)).rlike(_WORD.format(words))
            | F.left(after, F.lit(AFTER)).rlike(_WORD.format(words))
        )
        score = (
            F.lit(kind.score) + F.when(near(kind.words), NEAR).otherwise(0.0)
            + F.when(near(DOUBT), AGAINST).otherwise(0.0)
        )
        start = F.get(starts, i) + F.length(before)
        return F.struct(
            start.alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"),
            (start + F.length(value)).alias("end"),
            F.round(F.least(score, F.lit(1.0)), 2).alias("score"),
        )

    confirmed = F.transform(found, kind.confirm)
    spans = F.transform(confirmed, lambda value, i: F.when(value.isNotNull(), span(value, i)))
    stays = F.lit(True) if kind.name in BASE else None
    return F.filter(spans, lambda x: x.isNotNull() & (stays if stays is not None else x["score"] >= THRESHOLD))


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and spans, sorted by start, then kind as listed.

    A span has start and end in code points, end exclusive, kind, order (the kind's place in the
    list) and score from 0 to 1.  Matches of one kind do not overlap; those of several kinds may.
    Null and empty texts have none; bytes that are no UTF-8 count as the replacement character.
    Null ids and repeated rows are rows like any other; other columns are not read.  The cost is
    in proportion to the text, also for a long one and one of many matches: patterns take runs
    whole, and starts are added up in blocks.  One projection over the table, no shuffle.
    """
    spans_type = "array<struct<start:long,order:int,kind:string,end:long,score:double>>"
    none = F.array().cast("array<string>")
    rows = docs.select(
        F.col(id).alias("doc_id"), F.make_valid_utf8(whole(F.col(text))).alias("_text")
    )
    # What a step makes is used several times by the next, so each has its own projection.
    all_of = lambda kind: F.regexp_extract_all("_text", F.lit(kind.linear or kind.pattern), F.lit(0))
    hint = {"email": F.contains(F.col("_text"), F.lit("@")), "phone": F.contains(F.col("_text"), F.lit("+"))}
    digit = F.col("_text").rlike("[0-9]")
    rows = rows.select("*", *[
        F.when(hint.get(kind.name, digit), all_of(kind)).otherwise(none).alias(f"_found_{kind.name}")
        for kind in KINDS
    ])
    rows = rows.select("doc_id", *[f"_found_{kind.name}" for kind in KINDS], *[
        F.when(
            F.size(f"_found_{kind.name}") > 0, F.split("_text", kind.linear or kind.pattern)
        ).otherwise(none).alias(f"_pieces_{kind.name}")
        for kind in KINDS
    ])
    step = lambda kind: F.transform(f"_found_{kind.name}", lambda x, i: (
        F.length(x) + F.length(F.get(f"_pieces_{kind.name}", i))
    ).cast("long"))
    rows = rows.select("*", *[
        F.when(F.size(f"_found_{kind.name}") > 0, sums_before(step(kind))).alias(f"_starts_{kind.name}")
        for kind in KINDS
    ])
    spans = [
        F.when(F.size(f"_found_{kind.name}") > 0, _spans(
            kind, order, F.col(f"_found_{kind.name}"), F.col(f"_pieces_{kind.name}"),
            F.col(f"_starts_{kind.name}"),
        ).cast(spans_type)).otherwise(F.array().cast(spans_type))
        for order, kind in enumerate(KINDS)
    ]
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))
