"""Counts over one text by numpy on Arrow batches.

Runs of equal characters, pairs and word n-grams take built-in expressions milliseconds for a text of
usual length, as lambdas are interpreted element by element; here they take some tens of microseconds. What is made
of the counts stays an expression.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as L

#: Counts up to here are by position in a table, beyond by sorting.
TABLE = 1 << 14


def distinct_grams(ids: np.ndarray, bound: int, n: int) -> int:
    """How many different runs of n numbers (all less than bound) there are."""
    if len(ids) < n:
        return 0
    key, most = ids, bound
    for i in range(1, n):
        if most * bound >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            most = int(key.max()) + 1
        key = key[:-1] * bound + ids[i:]
        most *= bound
    if most <= max(TABLE, 4 * len(key)):
        return int(np.count_nonzero(np.bincount(key)))
    key = np.sort(key)
    return 1 + int(np.count_nonzero(key[1:] != key[:-1]))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """By code under 0x2070: 1 for what is no letter, number or ASCII white space, 2 where only the JVM's own tables tell.

    Latin letters and general punctuation are the same in all versions of Unicode; \\s is ASCII in its patterns.
    """
    import unicodedata

    table = np.full(0x2070, 2, np.int8)
    for c in (*range(0x250), *range(0x2000, 0x2070)):
        table[c] = unicodedata.category(chr(c))[0] not in "LN" and chr(c) not in " \t\n\x0b\f\r"
    return table


def _set(characters: str) -> np.ndarray:
    return np.frombuffer(characters.encode("latin-1"), np.uint8).astype(np.int64)


_LETTERS = _set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_VOWELS = _set("aeiouAEIOU")
_STOPS = _set(".!?")
_CONTROL = _set("".join(map(chr, (*range(9), 11, 12, *range(14, 32)))))


class Counts:
    """Counts of one text, each worked out when it is asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def _chars(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of each character, distinct codes in order, how often each stands)."""
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        if not len(codes):
            return codes, codes, codes
        most = int(codes.max()) + 1
        if most > TABLE:
            found, ids, n = np.unique(codes, return_inverse=True, return_counts=True)
            return ids.astype(np.int64), found, n
        table = np.bincount(codes)
        found = np.flatnonzero(table)
        place = np.zeros(most, np.int64)
        place[found] = np.arange(len(found))
        return place[codes], found, table[found]

    @cached_property
    def _ascii(self) -> np.ndarray:
        """How often each ASCII character stands."""
        table = np.zeros(128, np.int64)
        _, found, n = self._chars
        low = np.searchsorted(found, 128)
        table[found[:low]] = n[:low]
        return table

    def _of(self, codes: np.ndarray) -> int:
        return int(self._ascii[codes].sum())

    @cached_property
    def _words(self) -> list[str]:
        return self.text.split()

    @cached_property
    def _distinct(self) -> dict[str, None]:
        return dict.fromkeys(self._words)

    @cached_property
    def _word_ids(self) -> tuple[np.ndarray, int]:
        number = {w: i for i, w in enumerate(self._distinct)}
        return np.fromiter(map(number.__getitem__, self._words), np.int64, len(self._words)), len(number)

    def _word_grams(self, n: int) -> int:
        if "\x01" in self.text:  # it also stands between the words of an n-gram
            return len({"\x01".join(self._words[i : i + n]) for i in range(len(self._words) - n + 1)})
        return distinct_grams(*self._word_ids, n)

    @cached_property
    def _lines(self) -> list[str]:
        return [s for x in self.text.split("\n") if (s := x.strip())]

    def bits(self) -> float:
        """Entropy of the characters."""
        n = self._chars[2].astype(np.float64)
        total = n.sum()
        return abs(float(np.log2(total) - (n * np.log2(n)).sum() / total)) if len(n) else 0.0

    def chars(self) -> int:
        return len(self._chars[1])

    def top(self) -> int:
        """Of the most frequent character."""
        return int(self._chars[2].max()) if len(self._chars[2]) else 0

    def chars2(self) -> int:
        return distinct_grams(self._chars[0], self.chars(), 2)

    def chars3(self) -> int:
        return distinct_grams(self._chars[0], self.chars(), 3)

    def chars4(self) -> int:
        return distinct_grams(self._chars[0], self.chars(), 4)

    def letters(self) -> int:
        return self._of(_LETTERS)

    def vowels(self) -> int:
        return self._of(_VOWELS)

    def stops(self) -> int:
        return self._of(_STOPS)

    def control(self) -> int:
        return self._of(_CONTROL)

    def punctuation(self) -> int | None:
        """Null where a character is in it of which the JVM's tables may say otherwise."""
        _, found, n = self._chars
        if not len(found):
            return 0
        if found[-1] >= 0x2070:
            return None
        kinds = _classes()[found]
        return None if (kinds == 2).any() else int(n[kinds == 1].sum())

    def words(self) -> int:
        return len(self._words)

    def word_chars(self) -> int:
        return sum(map(len, self._words))

    def words1(self) -> int:
        return len(self._distinct)

    def words3(self) -> int:
        return self._word_grams(3)

    def words4(self) -> int:
        return self._word_grams(4)

    def boilerplate(self) -> int:
        """How many of the phrases a lower-cased text holds."""
        return sum(p in self.text for p in L.BOILERPLATE)

    def injection(self) -> int:
        """Whether a lower-cased text may hold what these patterns find, so do the next two."""
        return self._may("injection")

    def jailbreak(self) -> int:
        return self._may("jailbreak")

    def exfiltration(self) -> int:
        return self._may("exfiltration")

    def _may(self, category: str) -> int:
        return int(any(all(w in self.text for w in words) for words in L.UNSAFE_WORDS[category]))

    def lines(self) -> int:
        return len(self._lines)

    def lines1(self) -> int:
        return len(set(self._lines))


def counts(text: Column, *names: str, once: bool = False) -> Column:
    """struct of the named methods of Counts; null for a null text. With `once` the optimizer does not copy it into the filters and projections that use it."""
    kinds = [pa.float64() if n == "bits" else pa.int64() for n in names]

    @F.arrow_udf("struct<" + ", ".join(f"{n}: {'double' if n == 'bits' else 'bigint'}" for n in names) + ">")
    def counted(texts: pa.Array) -> pa.Array:
        out: list[list] = [[] for _ in names]
        there = []
        for t in texts.cast(pa.binary()):
            there.append(not t.is_valid)
            one = Counts(t.as_py().decode("utf-8", "replace") if t.is_valid else "")
            for column, n in zip(out, names, strict=True):
                column.append(getattr(one, n)())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=list(names), mask=pa.array(there, pa.bool_()))

    return (counted.asNondeterministic() if once else counted)(text)


def repeated(distinct: Column, count: Column) -> Column:
    """1 - distinct / count; 0 for none."""
    return F.when(count > 0, 1 - distinct.cast("double") / count).otherwise(F.lit(0.0))
