"""Text normalisation as Columns; two steps that built-ins cannot express are Arrow UDFs."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import stripped

# Characters without width, and quotes, dashes and spaces with their plain forms.
ZERO_WIDTH = "​‌‍﻿⁠­"
PLAIN = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", " ": " "}


def without_control(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]", "")


def without_zero_width(text: Column) -> Column:
    return F.translate(text, ZERO_WIDTH, "")


def plain_space(text: Column, line_end: str = "\n", tab: int = 4) -> Column:
    """Line ends made one kind, tabs and runs of blanks one blank, three or more empty lines one."""
    out = F.regexp_replace(text, "\r\n?", "\n")
    out = F.regexp_replace(F.replace(out, F.lit("\t"), F.lit(" " * tab)), "[ \t]+", " ")
    out = F.regexp_replace(out, "\n{3,}", "\n\n")
    return F.replace(out, F.lit("\n"), F.lit(line_end)) if line_end != "\n" else out


def collapsed(text: Column, most: int = 2) -> Column:
    return F.regexp_replace(text, "\n{" + str(most + 1) + ",}", "\n" * most)


def plain_quotes(text: Column) -> Column:
    for old, new in PLAIN.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def encoding_issues(text: Column) -> Column:
    """Names of what is wrong, in a fixed order."""
    bare = F.replace(text, F.lit("\r\n"), F.lit(""))
    kinds = F.contains(text, F.lit("\r\n")).cast("int") + F.contains(bare, F.lit("\n")).cast("int") + F.contains(bare, F.lit("\r")).cast("int")
    checks = {
        "replacement_chars": F.contains(text, F.lit("�")),
        "bom": F.startswith(text, F.lit("﻿")),
        "mixed_line_endings": kinds > 1,
        "control_chars": F.rlike(text, F.lit(r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}]")),
    }
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())))


def unicode_form(text: Column, form: str = "NFC") -> Column:
    """The text in a Unicode form, which no built-in gives; ASCII texts are normal in every form and come back as they are."""

    @F.pandas_udf(T.StringType())
    def normal(values: pd.Series) -> pd.Series:
        return values.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize(form, t))

    return normal(text)


_SPACES = re.compile(r"\s*")


def break_lines(text: str, width: int) -> str:
    """`broken_lines` of one text; a line of any length is gone over once."""
    out = []
    for line in text.split("\n"):
        at = 0
        while len(line) - at > width:
            cut = line.rfind(" ", at + int(width * 0.8) + 1, at + width + 1)
            cut = cut if cut >= 0 else at + width
            out.append(line[at:cut])
            at = _SPACES.match(line, cut).end()
        out.append(line[at:])
    return "\n".join(out)


def broken_lines(text: Column, width: int) -> Column:
    """Lines over width are broken at the last blank in their last fifth, else at width."""

    @F.pandas_udf(T.StringType())
    def apply(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else break_lines(t, width))

    return apply(text)


def char_categories(text: Column) -> Column:
    """Unicode categories of the characters and their counts, as JSON with sorted keys."""

    @F.pandas_udf(T.StringType())
    def counted(values: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def one(t: str) -> str:
            total: Counter = Counter()
            for c, n in Counter(t).items():
                total[known.setdefault(c, unicodedata.category(c))] += n
            return "{" + ", ".join(f'"{k}": {total[k]}' for k in sorted(total)) + "}"

        return values.map(lambda t: None if t is None else one(t))

    return counted(text)


def normal(text: Column, form: str | None = "NFC") -> Column:
    """The whole chain: Unicode form, control characters, zero width, white space, ends, empty lines."""
    out = unicode_form(text, form) if form else text
    return collapsed(stripped(plain_space(without_zero_width(without_control(out)))))
