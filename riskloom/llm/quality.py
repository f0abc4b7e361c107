"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_of

BLANKS = " \t\n\x0b\x0c\r"
#: Function words by language, in lower case; running text has them at a steady rate. A corpus in others passes its own.
STOP_WORDS = {
    "en": ("the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "it", "for", "was", "on", "are"),
    "fr": ("le", "la", "les", "de", "des", "et", "que", "un", "une", "est", "dans", "pour", "du", "en", "avec"),
    "de": ("der", "die", "das", "und", "zu", "den", "von", "mit", "ist", "ein", "eine", "nicht", "dem", "im", "auch"),
    "es": ("el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "por", "con", "para", "es", "del"),
}


#: A word without a letter.
LETTERLESS = r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])"


def stop_forms(stop_words: Mapping[str, Sequence[str]] = STOP_WORDS) -> list[str]:
    """The stop words of all languages in lower case."""
    return sorted({word.lower() for words in stop_words.values() for word in words})


@dataclass(frozen=True)
class Rule:
    """``measure`` / ``per`` must lie within the bounds; with nothing to divide by it holds."""

    name: str
    measure: str
    per: str | None = None
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        value = F.col(self.measure).cast("double")
        if self.per:
            # x / n <= b as x <= b * n: no division, so nothing is divided by zero
            scale = F.col(self.per).cast("double")
        else:
            scale = F.lit(1.0)
        bounds = []
        if self.least is not None:
            bounds.append(value >= self.least * scale)
        if self.most is not None:
            bounds.append(value <= self.most * scale)
        return functools.reduce(operator.and_, bounds)


BASE = (Rule("enough_words", "n_words", least=50), Rule("repeated_words", "n_repeat_words", "n_words", most=0.5))
RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.5, most=12),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("letters", "n_letter_words", "n_words", least=0.7),
    Rule("stop_words", "n_stop_words", "n_words", least=0.06),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.3),
    Rule("bullets", "n_bullet_lines", "n_lines", most=0.9),
    Rule("ellipses", "n_ellipsis_lines", "n_lines", most=0.3),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letter_words", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines",
)


def covered(places: Column) -> Column:
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(
        F.coalesce(places, F.array().cast("array<int>")),
        start,
        lambda acc, at: F.struct(at.alias("last"), (acc["total"] + F.least(F.lit(3), at - acc["last"])).alias("total")),
        lambda acc: acc["total"],
    )


def measured(docs: DataFrame, stop_words: Mapping[str, Sequence[str]] = STOP_WORDS) -> DataFrame:
    """(doc_id, all of MEASURES as longs) of every row, in one pass without a shuffle.

    ``n_stop_words`` counts the words that are stop words of any language, as often as they occur, in either case.
    Windows of three words are compared by 64-bit hashes. Only a row with a repeated
    one is sorted: a hash gives its lowest bits to the window's place, as many as
    the row needs, so that equal windows are neighbours in a sorted array of longs.
    """
    stop = stop_forms(stop_words)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    spaced = F.regexp_replace("_text", r"[\x09-\x0D]", " ")
    rows = rows.withColumn("_words", F.array_remove(F.split(spaced, " "), ""))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""))
    rows = rows.withColumn("n_words", F.size("_words"))
    words, n_windows = F.col("_words"), F.col("n_words") - 2
    hashes = F.transform(
        F.sequence(F.lit(0), n_windows - 1), lambda k: F.xxhash64(F.get(words, k), F.get(words, k + 1), F.get(words, k + 2))
    )
    rows = rows.withColumn("_hashes", F.when(n_windows > 1, hashes))
    bits = F.length(F.bin(n_windows))
    rows = rows.withColumn("_mask", F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    whole, mask = F.col("_hashes"), F.col("_mask")
    placed = F.transform(whole, lambda h, k: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(k))
    repeats = F.size(F.array_distinct(whole)) < F.size(whole)
    rows = rows.withColumn("_placed", F.when(repeats, F.sort_array(placed)))
    order = F.col("_placed")

    def beside(x: Column, k: Column) -> Column:
        other = F.get(order, k)
        return F.coalesce(F.get(whole, other.bitwiseAND(mask).cast("int")) == F.get(whole, x.bitwiseAND(mask).cast("int")), F.lit(False))

    places = F.transform(F.filter(order, lambda x, k: beside(x, k + 1) | beside(x, k - 1)), lambda x: x.bitwiseAND(mask).cast("int"))
    rows = rows.withColumn("_places", F.sort_array(places))
    lines = F.col("_lines")
    bullets = F.filter(lines, lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*•‣–][ \t]"))
    ellipses = F.filter(lines, lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))
    measures = {
        "n_words": F.col("n_words"),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count("_text", F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered(F.col("_places")),
        "n_lines": F.size(lines),
        "n_letter_words": F.col("n_words") - F.regexp_count("_text", F.lit(LETTERLESS)),
        "n_stop_words": F.size(F.filter(words, lambda word: F.lower(word).isin(stop))),
        "n_bullet_lines": F.size(bullets),
        "n_ellipsis_lines": F.size(ellipses),
    }
    return rows.select("doc_id", *[measures[name].cast("long").alias(name) for name in MEASURES])


def judged(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    base: tuple[Rule, ...] = BASE,
    stop_words: Mapping[str, Sequence[str]] = STOP_WORDS,
) -> DataFrame:
    """(doc_id, MEASURES, base_failed, kept, failed_rules) of every row of ``docs`` (doc_id, text).

    Words end at ASCII white space, lines at line feeds; lines without a word do not
    count. A null or empty text has no words and fails the base. ``failed_rules``
    names the rules that do not hold. Everything is built-in functions of the row
    itself: no shuffle, and no state beyond one text.
    """
    failed = F.filter(
        F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in (*base, *rules)]), lambda name: name.isNotNull()
    )
    base_failed = ~functools.reduce(operator.and_, [rule.holds() for rule in base])
    return measured(docs, stop_words).select("*", base_failed.alias("base_failed"), failed.alias("failed_rules")).withColumn(
        "kept", F.size("failed_rules") == 0
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Verdicts of the rows that stay."""
    return judged(docs, rules).where("kept")
