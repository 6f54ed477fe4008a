r"""Benchmark decontamination with an FM-index per training shard.

Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased. The test phrases are all
windows of 10 consecutive words of an item (an item of fewer words is one window). A shard
is a bounded slice of documents; its text is the sequence of their words as numbers, with a
separator after each document. The index of a shard is its Burrows-Wheeler transform in a
wavelet tree, with suffix positions sampled; all phrases are searched backward at once, their
occurrences located by walking to the next sampled position, and overlapping or touching
occurrences merged to removal spans. Words that no phrase holds share one number in the index, and a
run of them is one such word there, since no search can ask for them; positions are those of the
whole text.

The phrases are dealt in blocks of `block_words` item words, which bounds what is broadcast and what a
worker holds (some 150 bytes a word). One block (the usual case) costs no shuffle at all. Over
several, the texts are written once with a number for each row, each block gives the
numbers of rows with hits and their spans, and these are merged and joined.

Defined results: a null or empty text has no words and no hits; a very long text is a shard of
its own, searched whole; a null or empty item has no window; words that a window of an item without
an id occurs in are hit, but such an item has no id to name and is not counted; windows that several
items share count for each; repeated items (one item_id on several rows) count once; repeated
documents are searched one by one; an empty benchmark hits nothing; other columns are not looked
at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alnum_words, arrow_map, byte_list, written


@dataclass(frozen=True)
class Search:
    window: int = 10
    sample: int = 16
    #: Text bytes of a shard, about.
    shard_bytes: int = 3 << 20
    #: Words of the items of one block of phrases, which is broadcast.
    block_words: int = 200_000


# ---- suffix array, wavelet tree, FM-index


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes by doubling; only suffixes that are still tied are sorted again."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    sorted_rank = rank[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]]))
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))  # a group's rank is its first row
    tied = _tied_rows(starts, n)
    while len(tied) and step < n:
        at = order[tied]
        nxt = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        group = rank[at]
        key = group * (n + 1) + (nxt + 1)
        inner = np.argsort(key, kind="stable")
        order[tied] = at[inner]
        key = key[inner]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(key)))
        rank[order[tied]] = np.repeat(tied[first], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


def _tied_rows(starts: np.ndarray, n: int) -> np.ndarray:
    sizes = np.diff(np.append(starts, n))
    return np.flatnonzero(np.repeat(sizes > 1, sizes))


class WaveletTree:
    """rank(symbol, position) over a sequence of small numbers, one bit vector with counts per level."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = sequence.astype(np.int32)
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            ones = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            low = bit == 0
            self.zeros.append(int(low.sum()))
            current = np.concatenate([current[low], current[~low]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Times that each symbol stands before each position."""
        start, end = np.zeros_like(at), at.copy()
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            ones, zeros = self.ones[i], self.zeros[i]
            bit = ((symbol >> level) & 1).astype(bool)
            so, eo = ones[start], ones[end]
            start = np.where(bit, zeros + so, start - so)
            end = np.where(bit, zeros + eo, end - eo)
        return end - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols at the positions, their ranks there)."""
        symbol, where, start = np.zeros_like(at), at.copy(), np.zeros_like(at)
        for i in range(self.levels):
            ones, zeros = self.ones[i], self.zeros[i]
            bit = (ones[where + 1] - ones[where]).astype(np.int64)
            symbol = symbol * 2 + bit
            wo, so = ones[where], ones[start]
            where = np.where(bit == 1, zeros + wo, where - wo)
            start = np.where(bit == 1, zeros + so, start - so)
        return symbol, where - start


class FMIndex:
    """Backward search and location over one shard."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int):
        """text: numbers from 1 to sigma - 1; 0 is kept for the end."""
        text = np.append(text, 0)
        order = suffix_array(text)
        last = text[order - 1]  # the character before each suffix; of the whole text, the end mark
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))]).astype(np.int64)
        self.tree = WaveletTree(last, sigma)
        kept = order % sample == 0
        self.marks = np.zeros(len(kept) + 1, np.int64)
        np.cumsum(kept, out=self.marks[1:])
        self.samples = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases (rows padded on the left, so that all end in the last column)."""
        symbol = phrases[:, -1]
        low, high = self.first[symbol], self.first[symbol + 1]
        for back in range(2, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            s = phrases[live, -back]
            ends = self.tree.rank(np.concatenate([s, s]), np.concatenate([low[live], high[live]]))
            low[live], high[live] = self.first[s] + ends[: len(live)], self.first[s] + ends[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows, steps = rows.copy(), np.zeros_like(rows)
        out = np.empty_like(rows)
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            hit = self.marks[at + 1] > self.marks[at]
            done = open_[hit]
            out[done] = self.samples[self.marks[rows[done]]] + steps[done]
            open_ = open_[~hit]
            if len(open_):
                symbol, rank = self.tree.access(rows[open_])
                rows[open_] = self.first[symbol] + rank
                steps[open_] += 1
        return out


# ---- phrases


@dataclass
class Phrases:
    number: dict[bytes, int]  # word to number, from 3; 1 separates documents, 2 is any other word
    rows: np.ndarray  # phrases, padded on the left
    lengths: np.ndarray
    of: np.ndarray  # for each phrase, where its items begin in `items`
    items: np.ndarray  # indices of items; -1 for one without an id
    item_ids: list[str]


def phrases_of(items: list[tuple[str | None, bytes]], window: int) -> Phrases:
    """Distinct phrases of the items, built in arrays."""
    number: dict[bytes, int] = {}
    ids = sorted({i for i, _ in items if i is not None})
    index = {x: i for i, x in enumerate(ids)}
    rows, owners = [], []
    for item, text in items:
        own = np.array([number.setdefault(w, len(number) + 3) for w in alnum_words(text)], np.int32)
        if not len(own):
            continue
        padded = np.concatenate([np.zeros(max(0, window - len(own)), np.int32), own])
        rows.append(np.lib.stride_tricks.sliding_window_view(padded, window))
        owners.append(np.full(len(rows[-1]), index.get(item, -1), np.int32))
    if not rows:
        none = np.zeros(0, np.int32)
        return Phrases({}, np.zeros((0, window), np.int32), none, np.zeros(1, np.int64), none, ids)
    found, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.ravel(), np.concatenate(owners)]), axis=1)
    of = np.searchsorted(pairs[0], np.arange(len(found) + 1))
    return Phrases(number, found, (found != 0).sum(1).astype(np.int32), of, pairs[1].astype(np.int32), ids)


def occurrences(texts: list[bytes | None], phrases: Phrases, how: Search) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text; document, first word and phrase of each occurrence) of one shard."""
    words = [alnum_words(t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    none = np.zeros(0, np.int64)
    if not len(phrases.lengths) or not sizes.sum():
        return sizes, none, none, none
    get = phrases.number.get
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    whole = np.ones(int(sizes.sum() + len(words)), np.int32)
    inside = np.ones(len(whole), bool)
    inside[starts + sizes] = False
    whole[inside] = np.fromiter((get(w, 2) for ws in words for w in ws), np.int32, int(sizes.sum()))
    # A run of words that no phrase holds is as good as one such word: runs are shortened, positions kept.
    keep = np.ones(len(whole), bool)
    keep[1:] = ~((whole[1:] <= 2) & (whole[:-1] <= 2))
    position = np.flatnonzero(keep)
    index = FMIndex(whole[position], len(phrases.number) + 3, how.sample)
    low, high = index.search(phrases.rows, phrases.lengths)
    many = high - low
    which = np.repeat(np.arange(len(many)), np.maximum(many, 0))
    if not len(which):
        return sizes, none, none, none
    before = np.cumsum(many) - many
    rows = low[which] + np.arange(len(which)) - before[which]
    at = position[index.locate(rows)]
    doc = np.searchsorted(starts, at, side="right") - 1
    return sizes, doc, at - starts[doc], which


def spans_of(doc: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged spans (document, first word, word after the last); touching ones become one."""
    if not len(doc):
        return doc, first, first
    order = np.lexsort((first, doc))
    doc, first, end = doc[order], first[order], (first + length)[order]
    base = doc * (int(end.max()) + 2)  # documents never touch
    reach = np.maximum.accumulate(base + end)
    new = np.concatenate([[True], (base + first)[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return doc[at], first[at], (np.maximum.reduceat(base + end, at) - base[at]).astype(np.int64)


# ---- Spark

RESULT = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("items", T.ArrayType(T.StringType()))]


def _searched(docs: DataFrame, items: list[tuple[str, bytes]], how: Search, text: str) -> DataFrame:
    """docs with n_words, spans ([first word, word after the last]) and items for one block of phrases."""
    spread = docs.sparkSession.sparkContext.broadcast(phrases_of(items, how.window))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        phrases = spread.value
        sizes, doc, first, which = occurrences(byte_list(batch.column(text)), phrases, how)
        spans: list[list] = [[] for _ in sizes]
        for d, a, b in zip(*(x.tolist() for x in spans_of(doc, first, phrases.lengths[which] if len(which) else which)), strict=True):
            spans[d].append([a, b])
        hit: list[set] = [set() for _ in sizes]
        for d, w in zip(doc.tolist(), which.tolist(), strict=True):
            hit[d].update(phrases.items[phrases.of[w] : phrases.of[w + 1]].tolist())
        names = [sorted(phrases.item_ids[i] for i in h if i >= 0) for h in hit]
        new = [pa.array(sizes), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(names, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *(f.name for f in RESULT)])

    return arrow_map(docs, step, T.StructType([*docs.schema.fields, *RESULT]), text, how.shard_bytes)


def item_blocks(benchmark: DataFrame, how: Search) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's items in blocks of bounded size; a table of any size passes the driver block by block."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where("t IS NOT NULL")
    for r in rows.toLocalIterator():
        data = r.t.encode("utf-8", "surrogatepass")
        n = len(alnum_words(data))
        if block and size + n > how.block_words:
            yield block
            block, size = [], 0
        block.append((r.i, data))
        size += n
    yield block


def find(docs: DataFrame, benchmark: DataFrame, how: Search = Search(), text: str = "text") -> DataFrame:
    """docs with n_words, spans and items; all other columns stay (columns of these names are replaced)."""
    docs = docs.drop(*(f.name for f in RESULT), "_row")
    blocks = item_blocks(benchmark, how)
    first = next(blocks)
    if (second := next(blocks, None)) is None:
        return _searched(docs, first, how, text)
    docs = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    hits = None
    for block in chain((first, second), blocks):  # a phrase may lie in several blocks, a row of an item never
        found = written(_searched(docs.select("_row", text), block, how, text).where(F.size("spans") > 0).select("_row", "spans", "items"), "hits")
        hits = found if hits is None else hits.unionByName(found)
    merged = hits.groupBy("_row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = F.aggregate(F.array_sort("spans"), F.lit([]).cast("array<array<bigint>>"), _join_span)
    counted = _searched(docs, [], how, text).drop("spans", "items").join(merged.withColumn("spans", joined), "_row", "left").drop("_row")
    nothing = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    return counted.withColumn("spans", nothing("spans", "array<array<bigint>>")).withColumn("items", nothing("items", "array<string>"))


def _join_span(done, span):
    last = F.try_element_at(done, F.lit(-1))
    joined = F.array_append(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(last[0], F.greatest(last[1], span[1])))
    return F.when((F.size(done) > 0) & (span[0] <= last[1]), joined).otherwise(F.array_append(done, span))


def report(found: DataFrame) -> DataFrame:
    """Figures of each document from `find`'s output."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def removed(text: bytes, spans: list[list[int]]) -> bytes:
    """The text without its spans, from each span's first word to the end of its last."""
    import re

    words = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text)]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : words[first][0]])
        at = words[end - 1][1]
    return b"".join([*out, text[at:]])


