"""Text of generic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_of_messages(messages: Column) -> Column:
    """`[role]: content` of each message, an empty line between."""
    part = lambda m: F.concat(F.lit("["), F.coalesce(m["role"], F.lit("")), F.lit("]: "), F.coalesce(m["content"], F.lit("")))
    return F.array_join(F.transform(messages, part), "\n\n")


def text_of_record(df: DataFrame) -> Column:
    """First of text, content, messages that is there and not empty; else the whole record as JSON."""
    found = []
    for name in ("text", "content"):
        if name in df.columns:
            found.append(F.when(F.col(name).cast("string") != "", F.col(name).cast("string")))
    if "messages" in df.columns:
        found.append(F.when(F.size("messages") > 0, text_of_messages(F.col("messages"))))
    return F.coalesce(*found, F.to_json(F.struct(*df.columns)))
