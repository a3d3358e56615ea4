"""Quality rules: one threshold table compiled into one Spark projection.

``measures`` computes counts of a text with built-in functions only (no user
function, no shuffle: the plan is scan -> project), ``THRESHOLDS`` bounds
ratios of them, and ``apply_rules`` compiles the table into one boolean.

Words are runs of characters other than space and the controls 9 to 13.

Defined results
    null or empty text   no words; fails the base rule (fewer than 10 words)
    very long text       read whole; work grows as n log n only where a
                         5-word window repeats, else linearly
    ties, repeated rows  each row is judged by itself
    empty table          empty result
    clashing columns     ``documents`` columns that carry the name of an
                         added column are replaced by the added one
A ratio whose denominator is 0 passes its threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalyze.llm.common import let

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
BASE_MIN_WORDS = 10
BASE_MAX_REPEAT_PERCENT = 20

# Frequent function words of the corpus languages.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "as",
           "was", "by", "are", "this", "at", "from"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "mit", "von", "ist", "ein", "eine", "nicht",
           "auch", "auf", "dem", "des", "sich", "im", "an"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "una",
           "su", "para", "es", "al", "lo", "como"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui",
           "dans", "par", "sur", "au", "aux", "il"],
}


@dataclass(frozen=True)
class Rule:
    """``low <= measure / per <= high``; an open side is None."""
    name: str
    measure: str
    per: str | None
    low: float | None
    high: float | None


THRESHOLDS: tuple[Rule, ...] = (
    Rule("length", "n_words", None, 10, None),
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.10),
    Rule("exclamations_per_word", "n_exclamations", "n_words", None, 0.15),
    Rule("upper_case_share", "n_upper", "n_letters", None, 0.30),
    Rule("letters_per_char", "n_letters", "word_chars", 0.40, None),
    Rule("words_per_stop_word", "n_words", "n_stop_words_and_one", None, 40.0),
    Rule("words_like_the_previous", "n_again", "n_words", None, 0.30),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.50),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """Words covered by windows of ``width`` words that occur twice or more.

    Windows compare by a 64-bit hash of their words.  A text without a
    repeated window (most are) stops after the distinct count; else windows
    are sorted by hash, repeated ones found next to each other, and the
    length of the union of their spans summed in one pass.
    """
    def hashes(w: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
        return F.transform(F.sequence(F.lit(0), F.size(w) - width), at)

    def span_words(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def flagged(p: Column) -> Column:
            same = F.filter(p, lambda x, k: (
                F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def union_length(s: Column) -> Column:
            gaps = F.transform(s, lambda x, k: F.least(
                F.lit(width), F.coalesce(F.get(s, k + 1) - x, F.lit(width))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        return let(pairs, lambda p: let(flagged(p), union_length))

    def counted(w: Column) -> Column:
        return F.when(F.size(w) < width, F.lit(0).cast("long")).otherwise(let(hashes(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(span_words(h))))

    return let(words, counted)


def measures(text: Column) -> Column:
    """Struct of the counts the rules are made of."""
    text = F.coalesce(text, F.lit(""))
    stop = sorted({v for ws in STOP_WORDS.values() for w in ws for v in (w, w.capitalize())})

    def made(words: Column, body: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
        letters = F.regexp_replace(body, r"[^\p{L}]+", "")
        n_stop = F.size(F.filter(words, lambda w: w.isin(stop)))
        n_again = F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False))))
        return let(lines, lambda rows: let(letters, lambda alpha: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(body).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.regexp_replace(body, f"[{SYMBOLS}]+", ""))).cast("long")
            .alias("n_symbols"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
            repeated_window_words(words).alias("n_repeat_words"),
            F.size(rows).cast("long").alias("n_lines"),
            F.length(alpha).cast("long").alias("n_letters"),
            (F.length(alpha) - F.length(F.regexp_replace(alpha, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
            (F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))).cast("long")
            .alias("n_exclamations"),
            (n_stop + 1).cast("long").alias("n_stop_words_and_one"),
            n_again.cast("long").alias("n_again"))))

    return let(words_of(text), lambda w: let(F.array_join(w, ""), lambda body: made(w, body)))


def verdict(m: Column, rules: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """The table as one boolean: every bound holds."""
    ok = F.lit(True)
    for rule in rules:
        value = m[rule.measure].cast("double")
        if rule.per:
            value = F.try_divide(value, m[rule.per].cast("double"))
        if rule.low is not None:
            ok = ok & F.coalesce(value >= rule.low, F.lit(True))
        if rule.high is not None:
            ok = ok & F.coalesce(value <= rule.high, F.lit(True))
    return ok


def base_failed(m: Column) -> Column:
    return ((m["n_words"] < BASE_MIN_WORDS)
            | (100 * m["n_repeat_words"] > BASE_MAX_REPEAT_PERCENT * m["n_words"]))


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS,
                text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``."""
    def judged(m: Column) -> Column:
        failed = base_failed(m)
        return F.struct(*[m[c].alias(c) for c in ADDED], failed.alias("base_failed"),
                        (~failed & verdict(m, rules)).alias("kept"))

    added = (*ADDED, "base_failed", "kept")
    kept = [c for c in docs.columns if c not in added]
    made = "_m"
    while made in kept:
        made += "_"
    done = docs.select(*kept, let(measures(F.col(text_col)), judged).alias(made))
    return done.select(*kept, *[F.col(f"{made}.{c}").alias(c) for c in added])


def is_kept(text: Column, rules: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """The verdict alone, as a condition."""
    return let(measures(text), lambda m: ~base_failed(m) & verdict(m, rules))
