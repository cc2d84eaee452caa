"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import SPACES, col, words

# Frequent short words of the languages the rules are for; a text has few of them if it isn't prose.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "for", "with", "on",
    "der", "die", "das", "und", "den", "von", "zu", "nicht", "ist", "des",
    "de", "la", "le", "les", "et", "un", "une", "que", "pour", "dans",
    "el", "los", "y", "en", "del", "se", "por", "con", "no", "las",
)
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Kept while ``top / bottom`` is at least ``low`` and at most ``high``; a bottom of 0 passes."""

    name: str
    top: str
    bottom: str | None = None
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        """Multiplied out, so that whole numbers are compared without rounding."""
        below = F.lit(1) if self.bottom is None else F.col(self.bottom)
        tests = [F.col(self.top) < F.lit(self.low) * below] if self.low is not None else []
        tests += [F.col(self.top) > F.lit(self.high) * below] if self.high is not None else []
        return reduce(Column.__or__, tests)


# The first two are those every verdict begins with.
BASE_RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("repeats_itself", "n_repeat_words", "n_words", high=0.5),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.5, high=12),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("exclamations", "n_exclamations", "n_words", high=0.3),
    Rule("letterless_words", "n_letterless", "n_words", high=0.2),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("bullet_lines", "n_bullets", "n_lines", high=0.9),
    Rule("unfinished_lines", "n_ellipses", "n_lines", high=0.3),
)


def _count_chars(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def with_features(docs: DataFrame, into: str = "features", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct of whole numbers: n_words, word_chars, n_symbols, n_exclamations, n_letterless,
    n_stop_words, n_lines, n_dup_lines, n_bullets, n_ellipses (lines count that hold a word), n_repeat_words.

    Repeated windows are found by sorting a text's windows of three words: equal ones stand side by side.
    """
    text = F.coalesce(col(docs, text_col), F.lit(""))
    own, found, sorted_ = "q_words", "q_lines", "q_windows"
    step = docs.select(F.struct("*").alias("q_row"), text.alias("q_text"), words(text).alias(own), F.filter(
        F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACES}]")).alias(found))
    w = F.col(own)
    windows = F.transform(
        F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i")))
    step = step.withColumn(sorted_, F.sort_array(windows))
    s = F.col(sorted_)
    # where a repeated window begins, then every word in one
    twice = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["g"] == x["g"], F.lit(False))
                     | F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False)))
    inside = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    t, lines = F.col("q_text"), F.col(found)
    feature = {
        "n_words": F.size(w),
        "word_chars": F.char_length(F.regexp_replace(t, f"[{SPACES}]+", "")),
        "n_symbols": _count_chars(t, SYMBOLS),
        "n_exclamations": _count_chars(t, "!"),
        "n_letterless": F.regexp_count(t, F.lit(rf"(?<![^{SPACES}])[^{SPACES}\p{{L}}]++(?![^{SPACES}])")),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_bullets": F.size(F.filter(lines, lambda x: x.rlike(rf"^[{SPACES}]*[-*•]"))),
        "n_ellipses": F.size(F.filter(lines, lambda x: x.rlike(rf"(\.\.\.|…)[{SPACES}]*$"))),
        "n_repeat_words": F.size(inside),
    }
    struct = F.struct(*[c.cast("long").alias(n) for n, c in feature.items()]).alias(into)
    return step.select("q_row.*", struct)


def judged(
    docs: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES,
    into: str = "quality", text_col: str = "text",
) -> DataFrame:
    """``docs`` with a struct ``into``: the features, failed (names of the rules broken), base_failed, kept.

    All is one projection over whole texts: nothing is shuffled. A null or empty text has no words and fails
    the base; a very long text is judged like any other; repeated rows are judged each; an empty table
    stays empty. Other columns stay; ``into`` must not be one of them.
    """
    featured = with_features(docs, into, text_col)
    names = [f"{into}.{f}" for f in featured.schema[into].dataType.names]
    short = {n.split(".")[-1]: n for n in names}

    def broken(rule: Rule) -> Column:
        own = Rule(rule.name, short[rule.top], rule.bottom and short[rule.bottom], rule.low, rule.high)
        return own.fails()

    failed = F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in (*base, *rules)]))
    base_failed = reduce(Column.__or__, [broken(r) for r in base])
    verdict = F.struct(f"{into}.*", failed.alias("failed"), base_failed.alias("base_failed"), (F.size(failed) == 0).alias("kept"))
    return featured.withColumn(into, verdict)
