"""Quality, safety and anomaly scores of one text, as Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L
from . import text as X
from .measures import counts, repeated

# The functions over `counts` of a text take the struct where it is there already; else they have it made.


def readability(text: Column) -> Column:
    """Shorter words and sentences read easier; 0 without words."""
    k = counts(text, "words", "word_chars", "stops")
    n = k["words"]
    return F.when(n > 0, X.clamped(1 - (k["word_chars"] / n - 4) / 10 - (n / (k["stops"] + 1) - 15) / 50)).otherwise(F.lit(0.0))


def trigram_repetition(text: Column, lowered: Column | None = None) -> Column:
    k = lowered if lowered is not None else counts(F.lower(text), "words", "words3")
    return repeated(k["words3"], k["words"] - 2)


def boilerplate(text: Column, lowered: Column | None = None) -> Column:
    k = lowered if lowered is not None else counts(F.lower(text), "boilerplate")
    return F.least(F.lit(1.0), k["boilerplate"] / F.lit(3.0))


def composite(read: Column, repetition: Column, entropy: Column, boiler: Column) -> Column:
    return 0.3 * read + 0.3 * (1 - repetition) + 0.2 * entropy + 0.2 * (1 - boiler)


#: Words that one of four languages uses much and the others do not.
COMMON_WORDS = {"en": ("the", "of", "and", "with", "that"), "de": ("der", "und", "die", "nicht", "ist"), "fr": ("le", "les", "et", "des", "qui"), "es": ("el", "los", "por", "una", "del")}


def by_common_words(text: Column) -> tuple[Column, Column]:
    """(language of the most common words, its share of their hits); null where there are none. A plain detector for `detected_language`."""
    words = F.split(F.lower(text), " ")
    count = lambda own: F.size(F.filter(words, lambda w: w.isin(*own)))
    hits = F.array(*map(count, COMMON_WORDS.values()))
    best = X.let(hits, lambda h: F.when(F.array_max(h) > 0, F.get(F.array(*map(F.lit, COMMON_WORDS)), (F.array_position(h, F.array_max(h)) - 1).cast("int"))))
    return best, X.let(hits, lambda h: F.array_max(h) / F.aggregate(h, F.lit(0), lambda a, b: a + b).cast("double"))


def by_ascii(text: Column) -> tuple[Column, Column]:
    """The portable rule: pure ASCII counts as English."""
    return F.when(F.rlike(text, F.lit(r"^[\x00-\x7F]*\z")), "en").otherwise("non_ascii"), F.lit(1.0)


def detected_language(text: Column, detector: Callable[[Column], tuple[Column, Column]] = by_ascii, least: int = 50) -> Column:
    """struct<language, confidence> by a detector: any function from a text Column to both Columns, such as Arrow UDFs over a library.

    Texts of fewer than `least` characters, null and those without an answer are `unknown` with 0.
    """
    known = F.length(F.coalesce(text, F.lit(""))) >= least
    language, confidence = detector(text)
    found = known & language.isNotNull()
    return F.struct(F.when(found, language).otherwise("unknown").alias("language"), F.when(found, confidence).otherwise(F.lit(0.0)).alias("confidence"))


def pii_types(text: Column) -> Column:
    return F.array_compact(F.array(*(F.when(F.rlike(text, F.lit(p)), F.lit(n)) for n, p in L.PII.items())))


def keyword_risk(text: Column) -> Column:
    return F.least(F.lit(1.0), X.hits(F.lower(text), L.RISK_WORDS) / F.lit(3.0))


def unsafe_scores(text: Column, lowered: Column | None = None) -> dict[str, Column]:
    """Score of each category: matches times weight, at most 1. A text without the words that a match must hold is not searched."""
    k = lowered if lowered is not None else counts(F.lower(text), *L.UNSAFE)
    score = lambda p, w: F.least(F.lit(1.0), F.regexp_count(text, F.lit("(?i)" + "|".join(p))) * F.lit(w))
    return {name: F.when(k[name] == 0, F.lit(0.0)).otherwise(score(p, w)) for name, (p, w) in L.UNSAFE.items()}


def unsafe(text: Column, lowered: Column | None = None) -> tuple[Column, Column]:
    """(highest category score, categories over 0.3)."""
    scores = unsafe_scores(text, lowered)
    return F.greatest(*scores.values()), F.array_compact(F.array(*(F.when(s > 0.3, F.lit(n)) for n, s in scores.items())))


def entropy_score(bits: Column, low: float = 2.0, high: float = 6.0) -> Column:
    def scored(e: Column) -> Column:
        over = 1 - F.least((e - high) / 2, F.lit(0.5))
        return F.when(e < low, e / low * 0.5).when(e > high, over).otherwise(0.5 + 0.5 * (e - low) / (high - low))

    return X.let(bits, scored)


#: What `repetition` and `anomaly_flags` read of `counts`.
REPETITION = ("top", "lines", "lines1", "chars2", "words", "words3", "words4")
ANOMALY = ("bits", "letters", "vowels", "control", "punctuation")


def repetition(text: Column, k: Column | None = None) -> Column:
    """Highest of five: most frequent character, lines, character pairs, word 3-grams and 4-grams; 0 under 10 characters."""
    k = k if k is not None else counts(text, *REPETITION)
    n = F.length(text)
    parts = [k["top"] / n, repeated(k["lines1"], k["lines"]), repeated(k["chars2"], n - 1), repeated(k["words3"], k["words"] - 2), repeated(k["words4"], k["words"] - 3)]
    return F.when(n >= 10, F.greatest(*parts)).otherwise(F.lit(0.0))


def novelty(text: Column, lowered: Column | None = None) -> Column:
    """Twice the share of distinct words, at most 1; 0 without words."""
    k = lowered if lowered is not None else counts(F.lower(text), "words", "words1")
    return F.least(2 * X.share(k["words1"], k["words"]), F.lit(1.0))


def gibberish(text: Column, k: Column | None = None) -> Column:
    """Ten Latin letters or more, with few or many vowels, or long with hardly any variety."""
    k = k if k is not None else counts(text, "bits", "letters", "vowels")
    vowels = X.share(k["vowels"], k["letters"])
    return (k["letters"] >= 10) & ((vowels < 0.15) | (vowels > 0.6) | ((F.length(text) > 50) & (k["bits"] < 2.0)))


def broken_encoding(text: Column, k: Column | None = None) -> Column:
    k = k if k is not None else counts(text, "control")
    return F.contains(text, F.lit("\ufffd")) | (X.share(k["control"], F.length(text)) > 0.1)


def punctuation_share(text: Column, k: Column | None = None) -> Column:
    k = k if k is not None else counts(text, "punctuation")
    return X.share(F.coalesce(k["punctuation"], F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]"))), F.length(text))


def anomaly_flags(text: Column, tokens: Column | None = None, k: Column | None = None) -> Column:
    """Names of what is odd about a text, in a fixed order."""
    k = k if k is not None else counts(text, *ANOMALY)
    n = F.length(text)
    checks = [("too_short", n < 10), ("too_long", n > 1_000_000)]
    if tokens is not None:
        checks.append(("too_many_tokens", tokens > 100_000))
    checks += [("gibberish", gibberish(text, k)), ("encoding_issues", broken_encoding(text, k)), ("excessive_punctuation", punctuation_share(text, k) > 0.3)]
    return F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in checks)))


def overall(entropy: Column, repeated: Column, gain: Column, risk: Column, flags: Column) -> Column:
    raw = 0.25 * entropy + 0.25 * (1 - repeated) + 0.3 * gain + 0.2 * (1 - risk)
    return F.greatest(F.lit(0.0), raw - F.least(0.1 * F.size(flags), F.lit(0.5)))
