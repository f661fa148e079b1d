"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Everything about a document is computed from its own row, so there is no shuffle.  The steps
below are projections on top of each other only to name what is used twice; Spark runs them in
one stage.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import SPACE_CHARS, SPACES, unused, whole

WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = """
the of and to in that is was for it with as be on by at this are from or an a
der die das und zu den von mit ist im nicht ein auf des für sich es
le la les de et du une un en que pour est dans qui sur
el los y se del por con para una no las
""".split()


@dataclass(frozen=True)
class Rule:
    """A document fails if a measure, divided by another if `per` names one, is out of bounds."""

    name: str
    measure: str
    per: str | None = None
    least: float | None = None
    most: float | None = None


# Base rules of length and repetition; a document that fails one is never kept.
BASE = [
    Rule("length", "n_words", least=20),
    Rule("repeated_words", "n_repeat_words", per="n_words", most=0.3),
]
RULES = [
    Rule("word_length", "word_chars", per="n_words", least=2, most=20),
    Rule("symbols", "n_symbols", per="n_words", most=0.1),
    Rule("stop_words", "n_stop_words", per="n_words", least=0.02),
    Rule("repeated_lines", "n_dup_lines", per="n_lines", most=0.6),
]


def failures(rules: list[Rule], measures: Column | None = None) -> Column:
    """True if any rule fails; a ratio with nothing to divide by fails none.

    The measures are fields of the given struct, or columns.
    """
    def measure(name: str) -> Column:
        return F.col(name) if measures is None else measures[name]

    tests = [F.lit(False)]
    for rule in rules:
        value = measure(rule.measure)
        if rule.per is not None:
            value = F.try_divide(value, measure(rule.per))
        if rule.least is not None:
            tests.append(F.coalesce(value < rule.least, F.lit(False)))
        if rule.most is not None:
            tests.append(F.coalesce(value > rule.most, F.lit(False)))
    return reduce(or_, tests)


def _repeated(windows: Column, size: int) -> Column:
    """Number of words in windows that occur twice or more, given the hash of each window.

    Windows are sorted by hash, which brings equal ones together; the positions of those are
    sorted again, and each adds the words up to the next one, at most a window.
    """
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = _with(by_hash, lambda s: F.filter(
        F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]
        )),
        lambda i: i.isNotNull(),
    ))
    return _with(F.sort_array(twice), lambda p: F.aggregate(
        F.transform(p, lambda i, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - i, F.lit(size)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    ))


def _with(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the struct column of measures that the rules speak of.

    Null and empty texts have no words, and every measure is 0.  The name of the new column is
    `measures`, lengthened by underscores if `docs` has one of that name.
    """
    name = {n: unused(n, docs.columns) for n in ("_text", "_words", "_lines", "_hashes", "_windows", "measures")}
    c = {n: F.col(f"`{own}`") for n, own in name.items()}
    inner = F.btrim(c["_text"], F.lit(SPACE_CHARS))
    no_words = F.array().cast("array<string>")
    no_windows = F.array().cast("array<bigint>")
    window = lambda i: F.xxhash64(*[F.get(c["_hashes"], i + k) for k in range(WINDOW)])
    n_words = F.size(c["_words"])
    distinct = F.size(F.array_distinct(c["_windows"]))
    stop = F.filter(c["_words"], lambda w: F.lower(w).isin(STOP_WORDS))
    return (
        docs.withColumn(name["_text"], whole(F.col(text)))
        .withColumn(name["_words"], F.when(inner == "", no_words).otherwise(F.split(inner, SPACES)))
        .withColumn(name["_lines"], F.filter(
            F.split(c["_text"], "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""
        ))
        .withColumn(name["_hashes"], F.transform(c["_words"], lambda w: F.xxhash64(w)))
        .withColumn(name["_windows"], F.when(n_words < WINDOW, no_windows).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(n_words - WINDOW, F.lit(0))), window)
        ))
        .withColumn(name["measures"], F.struct(
            n_words.cast("long").alias("n_words"),
            F.length(F.array_join(c["_words"], "")).cast("long").alias("word_chars"),
            (F.length(c["_text"]) - F.length(F.regexp_replace(c["_text"], "[#*$%&|<>]", "")))
            .cast("long").alias("n_symbols"),
            F.size(c["_lines"]).cast("long").alias("n_lines"),
            (F.size(c["_lines"]) - F.size(F.array_distinct(c["_lines"])))
            .cast("long").alias("n_dup_lines"),
            F.when(distinct == F.size(c["_windows"]), F.lit(0).cast("long"))
            .otherwise(_repeated(c["_windows"], WINDOW)).alias("n_repeat_words"),
            F.size(stop).cast("long").alias("n_stop_words"),
        ))
        .select(*[F.col(f"`{x}`") for x in docs.columns], c["measures"])
    )


def quality_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rules: list[Rule] = RULES
) -> DataFrame:
    """One row per row of `docs`: its id, the measures, base_failed and kept.

    Null, empty and blank texts have no words and fail the base rules.  Repeated rows each give
    a row; other columns are not read.
    """
    judged = measured(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")))
    return judged.select("doc_id", "measures.*").withColumns(
        {"base_failed": failures(BASE), "kept": ~failures([*BASE, *rules])}
    )


def keep_good(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The documents that pass all rules, with all their columns."""
    judged = measured(docs, text)
    failed, at = unused("_failed", docs.columns), unused("_at", docs.columns)
    # Spark would move a filter below the projections and compute each measure anew for each
    # rule; it leaves one where it is that asks for a number given to rows as they come.
    return (
        judged.withColumn(failed, failures([*BASE, *rules], F.col(f"`{judged.columns[-1]}`")))
        .withColumn(at, F.monotonically_increasing_id())
        .where(~F.col(failed) & (F.col(at) >= 0))
        .select(*[F.col(f"`{x}`") for x in docs.columns])
    )
