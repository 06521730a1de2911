"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a column expression over the whole text: no user functions, no shuffle. The rules
are rows of :data:`RULES`; :func:`judge` turns them into one boolean per rule and a verdict.

Defined results: a null text has no words, measures 0 everywhere, and fails the word count. Repeated
rows are judged each on their own. Columns named like a result are replaced; all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but, text_of, words

# Frequent function words of the corpus languages (en, de, fr, es).
STOP_WORDS = (
    "a", "and", "are", "as", "be", "for", "in", "is", "it", "of", "on", "that", "the", "this", "to", "was", "with",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ist", "mit", "nicht", "und", "von", "zu",
    "avec", "dans", "des", "du", "en", "est", "et", "la", "le", "les", "pour", "que", "qui", "sur", "un", "une",
    "con", "del", "el", "es", "los", "no", "para", "por", "se", "su", "una", "y",
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("mean_word", "symbol_ratio", "shout_ratio", "dup_line_ratio", "repeat_ratio", "n_stop_words")


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= measure <= high; an open end is None."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        value, tests = F.col(self.measure), []
        if self.low is not None:
            tests.append(value >= F.lit(self.low))
        if self.high is not None:
            tests.append(value <= F.lit(self.high))
        return F.coalesce(tests[0] if len(tests) == 1 else tests[0] & tests[1], F.lit(False))


# The first two are the base: they alone make up base_failed.
BASE = (Rule("length", "n_words", low=50), Rule("repetition", "repeat_ratio", high=0.5))
RULES = (
    *BASE,
    Rule("word_length", "mean_word", low=2.0, high=15.0),
    Rule("symbols", "symbol_ratio", high=1.0),
    Rule("shouting", "shout_ratio", high=0.5),
    Rule("lines", "dup_line_ratio", high=0.4),
    Rule("stop_words", "n_stop_words", low=1.0),
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append MEASURES (long) and RATIOS (double) of each row's whole text.

    ``n_repeat_words`` compares the windows of a text by a 64-bit hash: it sorts them with their
    positions, keeps those equal to a neighbour, and adds up what they cover, n log n in the length
    of a text. Texts whose hashes are all different have none and are not sorted.
    """
    keep = columns_but(docs, *MEASURES, *RATIOS)
    body = text_of(text)
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    table = docs.select(*keep, words(body).alias("__w"), lines.alias("__l"))
    hashes = F.when(F.size("__w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("__w") - 3),
        lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2))))
    table = table.select(*keep, "__w", "__l", hashes.alias("__h"))
    windows = F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(
        F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.expr("array()"))
    table = table.select(*keep, "__w", "__l", windows.alias("__g"))
    repeated = F.filter("__g", lambda g, k: (
        ((k > 0) & (F.get("__g", k - 1)["h"] == g["h"]))
        | F.coalesce(F.get("__g", k + 1)["h"] == g["h"], F.lit(False))))
    table = table.select(
        *keep, "__w", "__l", F.sort_array(F.transform(repeated, lambda g: g["i"])).alias("__p"))
    covered = F.transform("__p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("__p", k + 1) - p, F.lit(3))))
    n = F.size("__w").cast("long")
    counted = table.select(
        *keep, n.alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
        F.size("__l").alias("__lines"),
        F.size(F.array_intersect("__w", F.array(*map(F.lit, STOP_WORDS)))).cast("double").alias("n_stop_words"),
        (F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))).alias("__shouts"),
    )

    def per(top: str, below: str) -> Column:
        return F.when(F.col(below) > 0, F.col(top) / F.col(below)).otherwise(F.lit(0.0))

    # Put out by a generator, so that no later filter on a measure is moved below to compute it again.
    return counted.select(*keep, F.inline(F.array(F.struct(
        *MEASURES, per("word_chars", "n_words").alias("mean_word"),
        per("n_symbols", "n_words").alias("symbol_ratio"), per("__shouts", "n_words").alias("shout_ratio"),
        per("n_dup_lines", "__lines").alias("dup_line_ratio"), per("n_repeat_words", "n_words").alias("repeat_ratio"),
        "n_stop_words",
    ))))


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Append the measures, ``failed`` (names of the rules a row fails, in table order),
    ``base_failed`` (any of ``base``), and ``kept`` (it fails none)."""
    def none_failed(some: tuple[Rule, ...]) -> Column:
        verdict = F.lit(True)
        for r in some:
            verdict = verdict & r.passes()
        return verdict

    measured = measure(docs, text)
    return measured.select(
        *columns_but(measured, "failed", "base_failed", "kept"),
        F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules])).alias("failed"),
        (~none_failed(base)).alias("base_failed"), none_failed(base + rules).alias("kept"),
    )
