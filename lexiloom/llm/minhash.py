r"""Near-duplicate classes: MinHash bands, odd sketches, exact confirmation, components.

A text's set: distinct shingles of its words ([^\x20\x09-\x0D]+ after A-Z are lower-cased).
1. Every text gets a digest of its set and 128 MinHash values in 32 bands. Texts of equal sets
   form a class, told by its smallest document id; only classes go on.
2. Classes that share a band with another are candidates. Each gets its whole set and an odd
   sketch: 1024 MinHash samples folded into 2048 parity bits. The XOR of two sketches has
   about n (1 - exp(-4 k (1 - J) / n)) / 2 bits set, which tells a high J within 0.014.
3. First round: each class is paired with the smallest of each bucket, which makes pairs in
   proportion to classes. Sketches sort out, whole sets confirm, links make components.
4. Second round: in large buckets that still hold several components, all rows outside the largest of
   these are paired with its smallest class, in proportion to classes again.
5. Third round: in buckets that still hold several components, the rows outside the largest one are held
   against each other and against the largest one's, by sketches inside blocks of bounded size;
   rows of the largest one are never held against each other. Only pairs of different components that
   the sketches do not rule out are put out and confirmed. So a huge group of copies costs one pair
   for each, a stray in it one more, and no link between different components is lost.
6. Components by alternating large and small stars over the links.

A pair at J = 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8; the sketch margin is
five standard deviations.

Defined results: a text without words, or null, has an empty set and is linked with nothing;
rows of one document id count as one document; a row with a null id is linked with nothing;
ties go to the smallest id; very long texts give whole sets; other columns are not looked at; an
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, arrow_map, byte_list, discard, mix64, written


@dataclass(frozen=True)
class Near:
    words: int = 4
    percent: int = 80
    bands: int = 32
    rows: int = 4
    samples: int = 1024
    bits: int = 2048
    #: Sketch estimates this far below the threshold still go to the exact check.
    margin: float = 0.07
    #: Ids of candidate classes up to this number (8 bytes each) are broadcast; beyond it texts are joined by shuffle.
    max_broadcast: int = 2_000_000
    #: Buckets are compared in blocks of so many classes; buckets of more than `large` get the second round.
    block: int = 256
    large: int = 1024


def shingles(texts: list[bytes | None], size: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit shingle) of each distinct shingle, documents in order."""
    words = [t.lower().split() if t else [] for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = hashes([w for ws in words for w in ws]) if counts.sum() else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(texts)), counts)
    with np.errstate(over="ignore"):
        n = len(flat) - size + 1
        acc = np.zeros(max(n, 0), np.uint64)
        for i in range(size):
            acc = mix64(acc + flat[i : i + len(acc)] * np.uint64(0x9E3779B97F4A7C15))
        ok = doc[: len(acc)] == doc[size - 1 : size - 1 + len(acc)] if n > 0 else np.zeros(0, bool)
        key, owner = acc[ok], doc[: len(acc)][ok]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            starts = np.cumsum(counts) - counts
            whole = []
            for d in short:
                h = np.uint64(counts[d])
                for x in flat[starts[d] : starts[d] + counts[d]]:
                    h = mix64(np.array([h + x * np.uint64(0xD1B54A32D192ED03)], np.uint64))[0]
                whole.append(h)
            key, owner = np.concatenate([key, np.array(whole, np.uint64)]), np.concatenate([owner, short])
        tagged = mix64(key ^ mix64(owner.astype(np.uint64)))
    order = np.argsort(tagged, kind="stable")
    repeat = tagged[order][1:] == tagged[order][:-1]
    once = np.ones(len(key), bool)
    once[order[1:][repeat]] = False
    key, owner = key[once], owner[once]
    if len(short):
        order = np.argsort(owner, kind="stable")
        key, owner = key[order], owner[order]
    return owner, key


def _minima(key: np.ndarray, starts: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """(documents, samples): smallest of each sample's hash over each document's shingles."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(starts), samples), np.uint64)
    ends = np.append(starts[1:], len(key))
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):  # slices that stay in the processor's cache
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + 32768, side="right")))
            part, own = key[starts[at] : ends[stop - 1]], starts[at:stop] - starts[at]
            room = np.empty_like(part)
            for j in range(samples):
                np.multiply(part, factor[j], out=room)
                np.minimum.reduceat(room, own, out=out[at:stop, j])
            at = stop
    return out


def signature(owner: np.ndarray, key: np.ndarray, how: Near) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each document with a set: its number, set size, two digests and its bands (32-bit)."""
    present, starts, sizes = np.unique(owner, return_index=True, return_counts=True)
    if not len(present):
        return present, sizes, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((0, how.bands), np.int32)
    with np.errstate(over="ignore"):
        one = np.add.reduceat(mix64(key), starts)
        two = np.add.reduceat(mix64(key ^ np.uint64(0xA5A5A5A55A5A5A5A)), starts)
        low = _minima(key, starts, how.bands * how.rows, 11).reshape(len(present), how.bands, how.rows)
        band = np.zeros((len(present), how.bands), np.uint64)
        for r in range(how.rows):
            band = mix64(band + low[:, :, r])
    return present, sizes, one, two, (band >> np.uint64(32)).astype(np.uint32).view(np.int32)


def odd_sketch(key: np.ndarray, starts: np.ndarray, how: Near) -> np.ndarray:
    """(documents, bits / 64) parity words: each sample flips one bit."""
    low = _minima(key, starts, how.samples, 12)
    with np.errstate(over="ignore"):
        bit = mix64(low + np.arange(how.samples, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(how.bits)
    place = (np.arange(len(starts), dtype=np.int64)[:, None] * how.bits + bit.astype(np.int64)).ravel()
    odd = (np.bincount(place, minlength=len(starts) * how.bits) & 1).astype(np.uint8).reshape(len(starts), how.bits)
    return np.packbits(odd, axis=1).view(np.uint64)


def estimate(different: np.ndarray, how: Near) -> np.ndarray:
    """J from the number of bits in which two sketches differ."""
    return 1 + how.bits / (4 * how.samples) * np.log(np.maximum(1 - 2 * different / how.bits, 1e-6))


def most_different(how: Near) -> float:
    """Differing bits at the threshold less its margin."""
    return how.bits / 2 * (1 - np.exp(-4 * how.samples / how.bits * (1 - how.percent / 100 + how.margin)))


# ---- Spark: sets


def signatures(docs: DataFrame, how: Near) -> DataFrame:
    """doc_id, n, one, two, bands of each row; null digests for empty sets."""
    cache: list[WordHashes] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.append(WordHashes())
        count = batch.num_rows
        present, sizes, one, two, bands = signature(*shingles(byte_list(batch.column(1)), how.words, cache[0]), how)
        n = np.zeros(count, np.int64)
        n[present] = sizes
        digest = [np.zeros(count, np.int64) for _ in range(2)]
        for d, v in zip(digest, (one, two), strict=True):
            d[present] = v.view(np.int64)
        lists = np.zeros((count, how.bands), np.int32)
        lists[present] = bands
        values = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * how.bands, pa.int32()), pa.array(lists.ravel()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *map(pa.array, digest), values], names=["doc_id", "n", "one", "two", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, step, "doc_id long, n long, one long, two long, bands array<int>", "text")


def full_sets(docs: DataFrame, ids: DataFrame, n_ids: int, how: Near) -> DataFrame:
    """rep, n, keys (the sorted shingles) and sketch of the documents named in ids(rep)."""
    cache: list[WordHashes] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not cache:
            cache.append(WordHashes())
        owner, key = shingles(byte_list(batch.column("text")), how.words, cache[0])
        present, starts, sizes = np.unique(owner, return_index=True, return_counts=True)
        if not len(present):
            return None
        sketches = odd_sketch(key, starts, how)
        keys = [np.sort(key[a : a + n]).tobytes() for a, n in zip(starts, sizes, strict=True)]
        own = batch.column("rep").take(pa.array(present))
        return pa.RecordBatch.from_arrays([own, pa.array(sizes), pa.array(keys, pa.binary()), pa.array([s.tobytes() for s in sketches], pa.binary())], names=["rep", "n", "keys", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    wanted = F.broadcast(ids) if n_ids <= how.max_broadcast else ids
    return arrow_map(rows.join(wanted, "rep", "left_semi"), step, "rep long, n long, keys binary, sketch binary", "text")


# ---- Spark: pairs


def sketched(pairs: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""
    limit = most_different(how)
    side = lambda c: sets.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= how.percent * F.greatest("n_a", "n_b"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("s_a", "s_b"))
            near = pa.array(np.bitwise_count(x ^ y).sum(1) <= limit)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(near) for c in ("a", "b")], names=["a", "b"])

    return joined.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    side = lambda c: sets.select(F.col("rep").alias(c), F.col("keys").alias(f"k_{c}"))

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("k_a"), batch.column("k_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # two sorted runs
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= how.percent * (len(both) - common))
            near = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(near) for c in ("a", "b")], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "k_a", "k_b").mapInArrow(run, "a long, b long")


def mixed_buckets(named: DataFrame) -> DataFrame:
    """key, main (the largest component; ties to the smallest), pivot2 (its smallest class), m and rest (rows in all, outside main) of buckets that hold several components."""
    parts = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"), F.min("rep").alias("low"))
    buckets = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("k").alias("m"), F.max(F.struct("k", (-F.col("comp")).alias("c"), "low")).alias("top")).where("parts > 1")
    return buckets.select("key", (-F.col("top.c")).alias("main"), F.col("top.low").alias("pivot2"), "m", (F.col("m") - F.col("top.k")).alias("rest"))


def block_pairs(members: DataFrame, how: Near) -> DataFrame:
    """Pairs (a, b) of different components in one bucket that sizes and sketches do not rule out.

    members: key, band, rep, comp, n, bands, sketch and the bucket's main, m and rest. Rows outside the main
    component are cut into blocks by a hash of rep, and so are its own rows. Units of work are two blocks of the
    former (i <= j), or one of each (j below 0). A pair is put out in the first of its common bands only.
    """
    limit, percent = most_different(how), how.percent
    blocks = lambda n: F.greatest(F.ceil(n / how.block), F.lit(1)).cast("int")
    rest, main = blocks(F.col("rest")), blocks(F.col("m") - F.col("rest"))
    in_main = F.col("comp") == F.col("main")
    own = F.pmod(F.xxhash64("rep"), F.when(in_main, main).otherwise(rest)).cast("int")
    rows = members.withColumn("in_main", in_main).withColumn("own", own)
    unit_of = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    mine = F.col("own")
    with_rest = F.transform(F.sequence(F.lit(0), rest - 1), lambda x: F.when(F.col("in_main"), unit_of(x, -1 - mine)).otherwise(unit_of(F.least(x, mine), F.greatest(x, mine))))
    with_main = F.when(~F.col("in_main"), F.transform(F.sequence(F.lit(0), main - 1), lambda x: unit_of(mine, -1 - x))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    rows = rows.withColumn("u", F.explode(F.concat(with_rest, with_main))).withColumn("own", F.when(F.col("in_main"), -1 - mine).otherwise(mine))
    n = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select("key", "u.i", "u.j", "own", "band", "rep", "comp", "n", "bands", "sketch").repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def unit(rows: list[tuple]) -> tuple[list[int], list[int]]:
        i, j, band = rows[0][1], rows[0][2], rows[0][4]
        own, rep, comp, size = (np.array([r[k] for r in rows], np.int64) for k in (3, 5, 6, 7))
        if (comp == comp[0]).all():
            return [], []
        bands = np.stack([r[8] for r in rows])
        sketch = np.frombuffer(b"".join(r[9] for r in rows), np.uint64).reshape(len(rows), -1)
        left, right = [], []
        for x in range(len(rows)):
            y = np.arange(x + 1, len(rows)) if i == j else np.flatnonzero(own != own[x]) if own[x] == i else np.zeros(0, np.int64)
            y = y[(comp[y] != comp[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x]))]
            if len(y) and band:
                y = y[~(bands[y, :band] == bands[x, :band]).any(1)]
            if len(y):
                y = y[np.bitwise_count(sketch[y] ^ sketch[x]).sum(1) <= limit]
                left.append(np.minimum(rep[y], rep[x]))
                right.append(np.maximum(rep[y], rep[x]))
        return (np.concatenate(left).tolist(), np.concatenate(right).tolist()) if left else ([], [])

    def run(batches):
        held: list[tuple] = []
        a: list[int] = []
        b: list[int] = []
        told = lambda: pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        for batch in batches:
            names = ("key", "i", "j", "own", "band", "rep", "comp", "n", "bands", "sketch")
            cols = [batch.column(c).to_pylist() for c in names[:8]]
            lists = batch.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for row in zip(*cols, lists, batch.column("sketch").to_pylist(), strict=True):
                if held and row[:3] != held[0][:3]:
                    x, y = unit(held)
                    a, b, held = a + x, b + y, []
                held.append(row)
            if len(a) > 50_000:
                yield told()
                a, b = [], []
        if held:
            x, y = unit(held)
            a, b = a + x, b + y
        yield told()

    return dealt.mapInArrow(run, "a long, b long")


# ---- Spark: components


def components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """node, comp (the smallest node reachable) of all nodes that links(a, b) name, by alternating stars."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def seen(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = seen(edges)
    for _ in range(most_rounds):
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "edges")
        # Small star: smaller neighbours and the node itself go to the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        before_last, edges = edges, written(small, "edges")
        discard(before_last, large)
        now = seen(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


# ---- the whole


def told_apart(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members with the component of each class, buckets that hold several)."""
    comp = components(links)
    named = members.drop("m", "pivot").join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    return named, written(mixed_buckets(named), "mixed")


def near_duplicates(docs: DataFrame, how: Near = Near()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row."""
    docs = docs.select("doc_id", "text")
    sig = written(signatures(docs, how), "signatures")
    filled = sig.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(filled.groupBy("one", "two").agg(F.min(F.struct("doc_id", "n", "bands")).alias("c")).select("one", "two", F.col("c.doc_id").alias("rep"), F.col("c.n").alias("n"), F.col("c.bands").alias("bands")), "classes")
    spread = classes.select("rep", "n", F.posexplode("bands").alias("band", "value"))
    spread = spread.select("rep", "n", "band", F.shiftleft(F.col("band").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))
    buckets = spread.groupBy("key").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("m")).where("m > 1")
    members = written(spread.join(buckets, "key").select("key", "band", "rep", "n", "pivot", "m"), "members")
    ids = written(members.select("rep").distinct(), "candidates")
    sets = written(full_sets(docs, ids, ids.count(), how), "sets")
    star = members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = written(confirmed(sketched(star, sets, how), sets, how), "links")
    named, mixed = told_apart(members, links)
    large = mixed.where(F.col("m") > how.large)
    if large.limit(1).count():
        star = named.join(large, "key").where(F.col("comp") != F.col("main")).select(F.least("rep", "pivot2").alias("a"), F.greatest("rep", "pivot2").alias("b")).distinct()
        links = written(links.unionByName(confirmed(sketched(star, sets, how), sets, how)), "links")
        named, mixed = told_apart(members, links)
    extra = classes.select("rep", "bands").join(sets.select("rep", "sketch"), "rep")
    open_ = named.select("key", "band", "rep", "comp", "n").join(mixed.drop("pivot2"), "key").join(extra, "rep")
    pairs = written(block_pairs(open_, how), "pairs")
    second = written(links.unionByName(confirmed(pairs, sets, how)), "links")
    comp = written(components(second), "components")
    by_class = classes.select("one", "two", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("one", "two", F.coalesce("comp", "rep").alias("comp"))
    out = sig.select("doc_id", "n", F.when(F.col("n") > 0, F.col("one")).alias("one"), "two").join(by_class, ["one", "two"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))
