"""Token counts: plain estimates as Columns, byte-pair encodings as Arrow UDFs."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import lexicons as L
from .text import words


def char_tokens(text: Column) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long")


def word_tokens(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def estimated(text: Column, how: str = "char_ratio") -> Column:
    """char_ratio: characters / 4; words: words times 1.3; hybrid: the mean of both."""
    by_char = F.length(text) / 4
    by_word = F.size(words(text)) * F.lit(1.3)
    value = {"char_ratio": by_char, "words": by_word, "hybrid": (by_char + by_word) / 2}[how]
    return value.cast("long")


def code_points(text: Column) -> Column:
    """The character backend's ids."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def context_fit(tokens: Column) -> dict[str, Column]:
    return {f"fit_{n}": tokens <= w for n, w in L.WINDOWS.items()} | {f"cut_{n}": F.greatest(F.lit(0), tokens - w) for n, w in L.WINDOWS.items()}


def special_counts(ids: Column, vocabulary: int) -> tuple[Column, Column]:
    """(ids under 100, ids outside of the vocabulary)."""
    return F.size(F.filter(ids, lambda i: i < 100)), F.size(F.filter(ids, lambda i: i >= vocabulary))


def truncated(ids: Column, window: int, side: str = "right") -> Column:
    """The ids that stay when the right (or left) end is cut."""
    return F.slice(ids, 1, window) if side == "right" else F.when(F.size(ids) > window, F.slice(ids, -window, window)).otherwise(ids)


@lru_cache(maxsize=4)
def _encoding(ranks: str, pattern: str):
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("lexiloom", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def bpe_tokens(text: Column, ranks: str, pattern: str) -> Column:
    """Exact counts of a byte-pair vocabulary; the file is read once per worker."""

    @F.pandas_udf(T.LongType())
    def count(values: pd.Series) -> pd.Series:
        encode = _encoding(ranks, pattern).encode_ordinary
        return values.map(lambda t: 0 if t is None else len(encode(t)))

    return count(text)


def whole_text_tokens(spark: SparkSession, path: str, ranks: str, pattern: str) -> DataFrame:
    """One row, n: tokens of the text that the files under path make in the order of their names, each of whole lines.

    Counts do not add up over any parts, but over those before a line break that follows no white space: a piece of the
    pattern of byte_bpe_50k holds white space only at its start, and looks no further back. So each split of a file counts what lies
    between two such breaks; what is before its first and after its last one is put together in order by one task.
    """
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.option("lineSep", "\n").text(path).select(*where, "value")

    def count(text: str) -> int:
        return len(_encoding(ranks, pattern).encode_ordinary(text))

    def split(batches):
        def row(key, head, held, n):
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            values = (*key, head, "".join(held), n)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["file", "start", "head", "tail", "n"])

        key, head, held, n = None, None, [], 0
        for batch in batches:
            for now, line in zip(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True), batch.column("value").to_pylist(), strict=True):
                if now != key:
                    if key is not None:
                        yield row(key, head, held, n)
                    key, head, held, n = now, None, [], 0
                held.append(line)
                if line and not line[-1].isspace():
                    text = "".join(held)
                    if head is None:
                        head = text
                    else:
                        n += count(text)
                    held = []
                held.append("\n")
        if key is not None:
            yield row(key, head, held, n)

    def joined(batches):
        held, n = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                n += r["n"]
                if r["head"] is not None:
                    held.append(r["head"])
                    n += count("".join(held))
                    held = []
                held.append(r["tail"])
        n += count("".join(held))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    parts = lines.mapInArrow(split, "file string, start long, head string, tail string, n long")
    return parts.repartition(1).sortWithinPartitions("file", "start").mapInArrow(joined, "n long")


def with_token_counts(rows: DataFrame, text: str, count, name: str) -> DataFrame:
    """Counts each distinct text once: repeated texts meet by digest before the tokenizer runs."""
    keyed = rows.withColumn("_h", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    once = keyed.groupBy("_h").agg(F.first(text).alias("_t")).select("_h", count(F.col("_t")).alias(name))
    return keyed.join(once, "_h").drop("_h")
