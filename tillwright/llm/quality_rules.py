"""Quality rules: a threshold table compiled into one projection.

Nulls and empty texts have no words and fail the base rule. Texts of any length
are read whole; equal rows get equal results; extra columns are kept, and a
result column replaces an input column of the same name. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.columns import WORD, let, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or",
    "that", "the", "this", "to", "was", "with",
    "als", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist",
    "mit", "nicht", "sich", "und", "von", "zu",
    "avec", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pour", "que",
    "qui", "sur", "un", "une",
    "al", "como", "con", "del", "el", "es", "las", "los", "no", "para", "por", "se", "su", "y",
)


@dataclass(frozen=True)
class Rule:
    """A statistic must lie within [low, high]; texts under ``from_words`` words are exempt."""

    name: str
    statistic: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The threshold table. Ratios of texts without words are null and fail no rule.
RULES = (
    Rule("mean_word_length", "mean_word_length", 2.0, 15.0),
    Rule("symbol_ratio", "symbol_ratio", None, 0.10),
    Rule("shouting_ratio", "shouting_ratio", None, 0.50, 10),
    Rule("stop_word_ratio", "stop_word_ratio", 0.02, None, 50),
    Rule("duplicate_line_ratio", "duplicate_line_ratio", None, 0.50),
)


def statistics(text: Column) -> Column:
    """All counts of a text as one struct, each word array computed once.

    word_chars: code points in words. n_symbols: characters of ``#*$%&|<>``.
    n_lines: ``\\n``-split lines with a word; n_dup_lines: those equal to an
    earlier line. n_repeat_words: words in 5-word windows found at least twice.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))
    return let(word_array(whole), lambda w: let(lines, lambda ln: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size(ln).cast("long").alias("n_lines"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        repeat_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long")
        .alias("n_stop_words"),
        F.size(F.filter(w, lambda x: x.rlike(r"^\P{Ll}*\p{Lu}\P{Ll}*$") & (F.length(x) > 1)))
        .cast("long").alias("n_shouted"),
    )))


def repeat_words(words: Column) -> Column:
    """Number of words inside windows of five words that occur at least twice.

    Hashes of the windows tell the texts without a repeated window, as equal
    windows always have equal hashes; only the others compare the windows
    themselves.
    """
    last = F.size(words) - WINDOW
    starts = F.sequence(F.lit(0), last)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    distinct = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return (F.when(last < 1, F.lit(0)).when(distinct, F.lit(0))
            .otherwise(_covered(words, starts)))


def _covered(words: Column, starts: Column) -> Column:
    windows = F.sort_array(F.transform(starts, lambda i: F.struct(
        F.concat_ws(" ", F.slice(words, i + 1, WINDOW)).alias("w"), i.alias("i"))))
    repeated = let(windows, lambda s: F.transform(s, lambda e, k: F.when(
        F.coalesce(F.get(s, k - 1)["w"] == e["w"], F.lit(False))
        | F.coalesce(F.get(s, k + 1)["w"] == e["w"], F.lit(False)), e["i"])))
    places = F.sort_array(F.array_compact(repeated))
    # Each window covers its words up to the next repeated window, at most five.
    return let(places, lambda p: F.aggregate(
        F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(
            F.get(p, k + 1) - i, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x))


def ratios(s: str) -> dict[str, Column]:
    """Ratios by name from the struct column ``s`` of :func:`statistics`."""
    n = F.col(f"{s}.n_words")
    return {
        "mean_word_length": F.try_divide(F.col(f"{s}.word_chars"), n),
        "symbol_ratio": F.try_divide(F.col(f"{s}.n_symbols"), F.col(f"{s}.word_chars")),
        "shouting_ratio": F.try_divide(F.col(f"{s}.n_shouted"), n),
        "stop_word_ratio": F.try_divide(F.col(f"{s}.n_stop_words"), n),
        "duplicate_line_ratio": F.try_divide(F.col(f"{s}.n_dup_lines"), F.col(f"{s}.n_lines")),
    }


def base_failed(s: str) -> Column:
    n = F.col(f"{s}.n_words")
    return ((n < MIN_WORDS)
            | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PERCENT * n))


def failed_rules(s: str, rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules of the table that the text breaks."""
    values = ratios(s)
    broken = []
    for rule in rules:
        value = values[rule.statistic]
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        bad = F.coalesce(bad & (F.col(f"{s}.n_words") >= rule.from_words), F.lit(False))
        broken.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def assess(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    s = "__statistics"
    counted = docs.withColumn(s, statistics(F.col(f"`{text}`")))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = counted.withColumns({
        **{n: F.col(f"{s}.{n}") for n in names},
        "base_failed": base_failed(s),
        "failed_rules": failed_rules(s, rules),
    })
    return out.withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop(s)


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows of ``docs`` that pass, with their own columns only."""
    s = "__statistics"
    return (docs.withColumn(s, statistics(F.col(f"`{text}`")))
            .where(~base_failed(s) & (F.size(failed_rules(s, rules)) == 0)).drop(s))
