"""Text statistics as Columns: words, n-grams, entropies, repetition, keyword scores.

Built-in expressions without a shuffle; only entropies of characters take counts made on Arrow batches
(`measures`). Counts of equal words come from runs of a sorted array, which is n log n for texts of any length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .measures import counts

#: What splits words: Unicode white space, which Java's \s does not cover.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def share(part: Column, whole: Column) -> Column:
    """part / whole as double; 0 where whole is 0."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once; inside a lambda an expression would be worked out for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ngrams(tokens: Column, n: int, between: str = "\x01") -> Column:
    def grams(t: Column) -> Column:
        last = F.greatest(F.size(t) - n + 1, F.lit(1))
        return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(t, i, n), between))).otherwise(F.array().cast("array<string>"))

    return let(tokens, grams)


def repeated_share(items: Column) -> Column:
    """1 - distinct / all; 0 for none."""
    return let(items, lambda x: F.when(F.size(x) > 0, 1 - F.size(F.array_distinct(x)).cast("double") / F.size(x)).otherwise(F.lit(0.0)))


def run_lengths(tokens: Column) -> Column:
    """How often each distinct element stands in the array."""

    def counted(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)))
        counts = let(starts, lambda s: F.transform(s, lambda at, k: F.coalesce(F.get(s, k + 1), n + 1) - at))
        return F.when(n > 0, counts).otherwise(F.array().cast("array<int>"))

    return let(F.array_sort(tokens), counted)


def entropy_bits(counts: Column, total: Column) -> Column:
    """Shannon entropy in bits of counts that add up to total: log2 n - sum(c log2 c) / n."""
    inner = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * F.log2(c.cast("double")))
    return F.when(total > 0, F.log2(total.cast("double")) - inner / total).otherwise(F.lit(0.0))


def word_entropy(tokens: Column) -> Column:
    """Entropy of the words, divided by log2 of their distinct number; 0 for one or none."""
    return let(run_lengths(tokens), _normal)


def _normal(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0), lambda acc, c: acc + c)
    return F.when(F.size(counts) > 1, entropy_bits(counts, total) / F.log2(F.size(counts).cast("double"))).otherwise(F.lit(0.0))


def char_entropy(text: Column) -> Column:
    """Bits per character."""
    return counts(F.coalesce(text, F.lit("")), "bits")["bits"]


def char_entropy_normal(text: Column, lowered: Column | None = None) -> Column:
    """Entropy of the lower-cased characters, divided by log2 of their distinct number; their `counts` may be given."""
    k = lowered if lowered is not None else counts(F.lower(F.coalesce(text, F.lit(""))), "bits", "chars")
    return F.when(k["chars"] > 1, k["bits"] / F.log2(k["chars"].cast("double"))).otherwise(F.lit(0.0))


def hits(lowered: Column | str, phrases: list[str]) -> Column:
    """How many of the phrases a lower-cased text holds. A text given as SQL makes one expression of one call, which builds plans much faster."""
    if isinstance(lowered, str):
        quoted = ("'" + p.replace("\\", "\\\\").replace("'", "\\'") + "'" for p in phrases)
        return F.expr(" + ".join(f"CAST(contains({lowered}, {q}) AS INT)" for q in quoted))
    return reduce(lambda a, b: a + b, (F.contains(lowered, F.lit(p)).cast("int") for p in phrases))


def first_highest(scores: dict[str, Column], none: str) -> Column:
    """Name of the first highest score; `none` if all are 0."""
    top = F.greatest(*scores.values())
    out = F.lit(none)
    for name, score in reversed(scores.items()):
        out = F.when(score == top, name).otherwise(out)
    return F.when(top == 0, none).otherwise(out)


def ranked(scores: dict[str, Column]) -> Column:
    """Names of scores over 0, highest first, ties in the order given."""
    entries = [F.struct((-s).alias("s"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, s) in enumerate(scores.items())]
    return F.transform(F.filter(F.array_sort(F.array(*entries)), lambda e: e["s"] < 0), lambda e: e["n"])


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping places of a string."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(len(part))).cast("int")


def clamped(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def fixed3(value: Column) -> Column:
    """value >= 0 with three decimals, rounded by its exact binary value as Python and C do; Java's %.3f rounds the shortest decimals (0.7875 up, though the double is less).

    Twice a thousandth is the unit: an odd nearest number is a tie, which the sign of the exact remainder decides. Both
    products are exact, as a float has 24 bits and 2000 has 11.
    """

    def thousandths(v: Column) -> Column:
        n = F.rint(v * 2000).cast("long")
        high = v.cast("float").cast("double")
        rest = (high * 2000 - n) + (v - high) * 2000
        down = F.floor(n / 2)  # n - 1 halves for an odd n
        up = (rest > 0) | ((rest == 0) & (down % 2 == 1))
        return F.when((n % 2 == 1) & up, down + 1).otherwise(down)

    def shown(k: Column) -> Column:
        return F.format_string("%d.%03d", F.floor(k / 1000), k % 1000)

    return F.when(value.isNotNull(), let(thousandths(value), shown))
