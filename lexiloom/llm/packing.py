"""Best-fit packing of token pieces into sequences, bettered by a swap-based local search.

Pieces have at most `size` tokens, so the packing problem is told by one count per length.
The plan is made on those counts alone (`size` numbers, whatever the number of documents):
bins of one content form a class (content, number of bins). Best-fit decreasing fills the
first classes; the local search then moves a piece, swaps one for one or two for one between
classes of underfull bins, each step raising the sum of squared fills, until bins empty.

A full piece is a sequence of its own and needs no rank, so the length that most pieces have
costs no shuffle. The others, at most one for each document, get their places by rank: the k-th
piece of a length takes the k-th slot of that length. Ranks are counted within (length, bucket);
the number of buckets follows the number of pieces, so a task never sorts much more than
`bucket_rows` rows, even where one length has them all.

Defined results: a null or empty text is the end token alone; a very long text is cut into
pieces, none dropped; repeated rows are packed one by one; a null doc_id is kept; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, written


@dataclass(frozen=True)
class Packing:
    size: int = 1024
    end_id: int = 2
    #: Ranks of a length are counted in parts of about so many rows, at least `least_buckets` of them.
    bucket_rows: int = 2_000_000
    least_buckets: int = 8
    #: Files of the tokenizer: the library `tokenizers`' form, and the same vocabulary as ranks.
    tokenizer: str = ""
    ranks: str = ""


# The split of texts that belongs to the vocabulary, and its special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}
#: Both libraries class these characters alike; texts with others go through `tokenizers`.
_BEYOND = re.compile("[^\x00-ɏ‐-‧€]")


class Encoder:
    """Ids as `tokenizers` gives them; plain Latin texts take the same vocabulary's ranks, which is four times as fast."""

    def __init__(self, tokenizer: str, ranks: str = ""):
        self._path, self._slow, self._fast = tokenizer, None, None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=table, special_tokens=SPECIAL)

    def __call__(self, text: str) -> list[int]:
        if self._fast is not None and not _BEYOND.search(text):
            return self._fast.encode(text, allowed_special="all", disallowed_special=())
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
        return self._slow.encode(text, add_special_tokens=False).ids


def default_packing() -> Packing:
    import public_tokenizers

    return Packing(tokenizer=public_tokenizers.path("byte_bpe_50k.json"), ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than size."""
    if length <= size:
        return [(0, length)]
    first = length % size or size
    return [(0, first), *((at, size) for at in range(first, length, size))]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, how: Packing, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece; with_ids adds the token ids themselves."""
    cache: list[Encoder] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.append(Encoder(how.tokenizer, how.ranks))
        cols: list[list] = [[] for _ in range(6)]
        for key, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.array([*cache[0](said or ""), how.end_id], "<u4")
            for i, (start, length) in enumerate(cuts(len(ids), how.size)):
                part = ids[start : start + length]
                row = (key, i, start, length, zlib.crc32(part.tobytes()), part.astype(np.int32) if with_ids else None)
                for col, value in zip(cols, row, strict=True):
                    col.append(value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        n = 6 if with_ids else 5
        return pa.RecordBatch.from_arrays(arrays[:n], names=names[:n])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return arrow_map(rows, step, PIECES + (", ids array<int>" if with_ids else ""), "text")


Bins = list[tuple[tuple[int, ...], int]]  # (lengths, descending; number of such bins)


def best_fit(counts: np.ndarray, size: int) -> Bins:
    """Best-fit decreasing on counts by length: each bin takes the longest pieces that fit, a bin's content is used as often as it can be."""
    left, bins = counts.astype(np.int64).copy(), []
    while (have := np.flatnonzero(left)).size:
        room, content, used = size, [], {}
        while have.size and room:
            at = int(np.searchsorted(have, room, side="right")) - 1
            while at >= 0 and left[have[at]] <= used.get(int(have[at]), 0):
                at -= 1
            if at < 0:
                break
            length = int(have[at])
            take = int(min(room // length, left[length] - used.get(length, 0)))
            content += [length] * take
            used[length] = used.get(length, 0) + take
            room -= take * length
        times = int(min(left[length] // n for length, n in used.items()))
        for length, n in used.items():
            left[length] -= n * times
        bins.append((tuple(content), times))
    return bins


def sums(content: tuple[int, ...], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths that one piece of the bin has, sums that two of its pieces have) as flags; distinct lengths tell all."""
    one, two = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    lengths = np.unique(content)
    one[lengths] = True
    for i, x in enumerate(lengths):
        two[x + lengths[i + 1 :]] = True
        if content.count(x) > 1:
            two[2 * x] = True
    return one, two


def pair_of(content: tuple[int, ...], total: int) -> tuple[int, int]:
    """Two pieces of a bin with this sum."""
    return next((x, total - x) for x in sorted(set(content)) if total - x in content and (2 * x != total or content.count(x) > 1))


def exchange(a: tuple[int, ...], b: tuple[int, ...], size: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """The best exchange that makes bin a, at least as full as b, fuller at b's cost: none, one or two pieces of a for one or two of b (not two for two)."""
    room, best = size - sum(a), (0, (), ())  # gain in a's fill, out of a, out of b
    out_of, into = [np.flatnonzero(x) for x in sums(a, size)], [np.flatnonzero(x) for x in sums(b, size)]
    for n_out, n_in in ((0, 1), (1, 1), (1, 2), (2, 1)):
        outs = np.zeros(1, np.int64) if not n_out else out_of[n_out - 1]
        ins = into[n_in - 1]
        if not len(outs) or not len(ins):
            continue
        at = np.searchsorted(ins, outs + room, side="right") - 1  # the most that still fits
        gain = np.where(at >= 0, ins[np.maximum(at, 0)] - outs, 0)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            out, more = int(outs[k]), int(ins[at[k]])
            best = (int(gain[k]), (() if not n_out else (out,) if n_out == 1 else pair_of(a, out)), ((more,) if n_in == 1 else pair_of(b, more)))
    if not best[0]:
        return None
    new_a, new_b = list(a), list(b)
    for x in best[1]:
        new_a.remove(x)
        new_b.append(x)
    for x in best[2]:
        new_b.remove(x)
        new_a.append(x)
    return tuple(sorted(new_a, reverse=True)), tuple(sorted(new_b, reverse=True))


class OpenClasses:
    """Classes of underfull bins, indexed by what one and two of their pieces add up to.

    For each class: `gives` flags the sums it can give (one piece, two pieces); `wants` those that would
    raise its fill without passing the size. A row of `wants` against all rows of `gives` finds every
    partner at once, so that no two classes are left untried.
    """

    def __init__(self, size: int):
        self.size, self.number, self.free = size, {}, []
        self.width = -(-(size + 1) // 64)
        self.content: list[tuple[int, ...] | None] = []
        self.fill = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)
        self.gives = np.zeros((2, 0, self.width), np.uint64)
        self.wants = np.zeros((2, 0, self.width), np.uint64)

    def _flags(self, x: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.width * 64, bool)
        padded[: len(x)] = x
        return np.packbits(padded).view(np.uint64)

    def _wanted(self, out: np.ndarray, room: int) -> np.ndarray:
        """Sums from one more than an out-sum to room more."""
        edges = np.zeros(self.size + 2, np.int64)
        at = np.flatnonzero(out)
        np.add.at(edges, np.minimum(at + 1, self.size + 1), 1)
        np.add.at(edges, np.minimum(at + room + 1, self.size + 1), -1)
        return np.cumsum(edges)[: self.size + 1] > 0

    def add(self, content: tuple[int, ...], n: int) -> int:
        """The class's row."""
        if (row := self.number.get(content)) is not None:
            self.times[row] += n
            return row
        if not self.free:
            more = max(64, len(self.content))
            self.free = list(range(len(self.content) + more - 1, len(self.content) - 1, -1))
            self.content += [None] * more
            grow = lambda x: np.concatenate([x, np.zeros(more, np.int64)])
            self.fill, self.times = grow(self.fill), grow(self.times)
            wide = np.zeros((2, more, self.width), np.uint64)
            self.gives, self.wants = np.concatenate([self.gives, wide], 1), np.concatenate([self.wants, wide], 1)
        row = self.free.pop()
        one, two = sums(content, self.size)
        nothing = np.zeros(self.size + 1, bool)
        nothing[0] = True
        room = self.size - sum(content)
        self.number[content], self.content[row] = row, content
        self.fill[row], self.times[row] = sum(content), n
        self.gives[0, row], self.gives[1, row] = self._flags(one), self._flags(two)
        self.wants[0, row], self.wants[1, row] = self._flags(self._wanted(nothing | one | two, room)), self._flags(self._wanted(one, room))
        return row

    def take(self, row: int, n: int) -> None:
        self.times[row] -= n
        if not self.times[row]:
            del self.number[self.content[row]]
            self.content[row] = None
            self.gives[:, row] = 0
            self.wants[:, row] = 0
            self.fill[row] = 0
            self.free.append(row)

    def partner(self, row: int) -> tuple[int, int] | None:
        """(receiver, giver) of an exchange that this class can take part in: the emptiest giver, else the fullest receiver."""
        alone = self.times[row] < 2
        fits = ((self.wants[:, row][:, None] & self.gives).any(axis=(0, 2))) & (self.fill <= self.fill[row])
        if alone:
            fits[row] = False
        if len(at := np.flatnonzero(fits)):
            return row, int(at[self.fill[at].argmin()])
        fits = ((self.gives[:, row][:, None] & self.wants).any(axis=(0, 2))) & (self.fill >= self.fill[row])
        if alone:
            fits[row] = False
        if len(at := np.flatnonzero(fits)):
            return int(at[self.fill[at].argmax()]), row
        return None


def local_search(bins: Bins, size: int) -> Bins:
    """Exchanges between classes of underfull bins until none raises the sum of squared fills.

    Every exchange raises that sum, so the search ends by itself; it stops at a packing in which no move of one
    piece, no swap of one for one and none of two for one betters any two bins.
    """
    full: dict[tuple[int, ...], int] = {}
    open_ = OpenClasses(size)
    todo: dict[tuple[int, ...], None] = {}

    def put(content: tuple[int, ...], n: int) -> None:
        if not content or not n:
            return
        if sum(content) == size:
            full[content] = full.get(content, 0) + n
        else:
            open_.add(content, n)
            todo[content] = None

    for content, n in sorted(bins, key=lambda x: -sum(x[0])):
        put(tuple(sorted(content, reverse=True)), n)
    while todo:
        content = next(iter(todo))
        row = open_.number.get(content)
        if row is None or (found := open_.partner(row)) is None:
            del todo[content]
            continue
        a, b = found
        of_a, of_b = open_.content[a], open_.content[b]
        new = exchange(of_a, of_b, size)
        times = int(open_.times[a] // 2 if a == b else min(open_.times[a], open_.times[b]))
        if a == b:
            open_.take(a, 2 * times)
        else:
            open_.take(a, times)
            open_.take(b, times)
        for x in new:
            put(x, times)
    return [*full.items(), *((c, int(open_.times[r])) for c, r in open_.number.items())]


def plan(counts: np.ndarray, size: int) -> Bins:
    return local_search(best_fit(counts, size), size)


def slots(bins: Bins) -> dict[str, np.ndarray]:
    """Runs of slots by length: first rank, pieces a bin, first bin, offset of the first. Sorted by (length, first rank)."""
    runs, taken, base = [], {}, 0
    for content, times in bins:
        at = 0
        for length in sorted(set(content), reverse=True):
            n = content.count(length)
            runs.append((length, taken.get(length, 0), n, base, at))
            taken[length] = taken.get(length, 0) + n * times
            at += n * length
        base += times
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "each", "bin", "offset"), table.T, strict=True))


def pack(cut: DataFrame, how: Packing) -> DataFrame:
    """cut (see `pieces`) with sequence_id and offset; full pieces have sequence ids below 0."""
    cut = written(cut, "pieces")
    fields = cut.schema.fields
    full = cut.where(F.col("length") == how.size).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = cut.where(F.col("length") < how.size)
    buckets = max(how.least_buckets, -(-part.count() // how.bucket_rows))
    # The bucket comes from the row alone, so a task that runs again deals the row to the same one.
    part = part.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counted = part.groupBy("length", "_bucket").count().toArrow()  # at most size x buckets rows of 20 bytes
    counts = np.zeros((how.size + 1, buckets), np.int64)
    counts[counted.column("length").to_numpy(), counted.column("_bucket").to_numpy()] = counted.column("count").to_numpy()
    before = np.cumsum(counts, axis=1) - counts
    spread = cut.sparkSession.sparkContext.broadcast((before, slots(plan(counts.sum(1), how.size))))
    rank = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")) - 1
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        first, table = spread.value
        key = table["length"] * (1 << 40) + table["rank"]
        for batch in batches:
            length, bucket, rank_in = (batch.column(c).to_numpy() for c in ("length", "_bucket", "_rank"))
            k = first[length, bucket] + rank_in
            run = np.searchsorted(key, length * (1 << 40) + k, side="right") - 1
            k = k - table["rank"][run]
            each = table["each"][run]
            own = [batch.column(f.name) for f in fields]
            out = [pa.array(table["bin"][run] + k // each), pa.array(table["offset"][run] + k % each * length)]
            yield pa.RecordBatch.from_arrays([*own, *out], names=[*(f.name for f in fields), "sequence_id", "offset"])

    return full.unionByName(part.withColumn("_rank", rank).mapInArrow(place, schema))


def assemble(packed: DataFrame) -> DataFrame:
    """The sequences themselves (packed must carry ids): sequence_id, doc_ids, ids; at most `size` tokens each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.flatten("p.ids").alias("ids"))
