"""Duplicates of samples: exact, by prefix, by MinHash signature, by SimHash, and the hybrid.

"First" is by an explicit position column. First-seen lookups are joins with a per-key
minimum, which Spark sums up before it shuffles, so a key that a third of the rows share
does not gather in one task.
"""

from __future__ import annotations

from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by(rows: DataFrame, key, position: str, name: str) -> DataFrame:
    """Adds the position of the first row of the same key."""
    keyed = rows.withColumn("_k", key)
    return keyed.join(keyed.groupBy("_k").agg(F.min(position).alias(name)), "_k").drop("_k")


def exact(rows: DataFrame, text: str = "t", position: str = "doc_id") -> DataFrame:
    """sha, first_id and is_duplicate."""
    hashed = rows.withColumn("sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return first_by(hashed, F.col("sha"), position, "first_id").withColumn("is_duplicate", F.col("first_id") != F.col(position))


def by_prefix(rows: DataFrame, length: int = 100, text: str = "t", position: str = "doc_id") -> DataFrame:
    """cluster_id: the first row with the same first characters. The prefix is the feature."""
    return first_by(rows, F.substring(F.coalesce(F.col(text), F.lit("")), 1, length), position, "cluster_id")


def _shingle_hashes(text: str, size: int) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    acc = np.zeros(max(1, len(points) - size + 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(size, len(points))):
            part = points[i : i + len(acc)]
            acc = (acc + part) * np.uint64(0x9E3779B97F4A7C15)
            acc ^= acc >> np.uint64(29)
    return acc


def minhash_signatures(rows: DataFrame, text: str = "t", position: str = "doc_id", hashes: int = 128, size: int = 5, seed: int = 42) -> DataFrame:
    """position and signature (array of 32-bit values) over the distinct character shingles."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                h = np.unique(_shingle_hashes(t or "", size))
                low = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
                with np.errstate(over="ignore"):
                    for at in range(0, len(h), 4096):
                        np.minimum(low, (h[at : at + 4096, None] * factor).min(0), out=low)
                out.append((low >> np.uint64(32)).astype(np.uint32).view(np.int32))
            values = np.concatenate(out) if out else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * hashes, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["position", "signature"])

    return rows.select(F.col(position).cast("long"), F.col(text)).mapInArrow(run, "position long, signature array<int>")


def agreement(a, b):
    """Share of signature values that agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x) / F.size(a).cast("double")


def star_pairs(members: DataFrame) -> DataFrame:
    """Distinct (a, b): the smallest row of each bucket with every other; members: rep, key. In proportion to the members, whatever the size of a bucket."""
    first = members.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "a")
    return members.join(first, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def matched(members: DataFrame, judged) -> DataFrame:
    """Pairs (a before b) that `judged` lets pass, so many that every row with an earlier match in a bucket has one.

    First each bucket's smallest row is held against the others. Rows that match none of these are
    then held against all earlier rows of their buckets, and only they: a group of near-copies so
    costs one pair for each bucket of a row, not one for each two rows.
    """
    star = star_pairs(members)
    good = judged(star)
    open_ = star.select("b").distinct().join(good.select("b").distinct(), "b", "left_anti")
    right = members.join(open_.withColumnRenamed("b", "rep"), "rep").withColumnRenamed("rep", "b")
    more = members.withColumnRenamed("rep", "a").join(right, "key").where("a < b").select("a", "b").distinct()
    return good.unionByName(judged(more.join(star, ["a", "b"], "left_anti")))


def band_members(signatures: DataFrame, bands: int = 16, width: int = 8) -> DataFrame:
    """rep and key: the buckets of each distinct signature, under its first position."""
    once = signatures.groupBy("signature").agg(F.min("position").alias("rep"))
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.slice("signature", i * width + 1, width)))
    return once.select("rep", F.explode(keys).alias("key"))


def banded_pairs(signatures: DataFrame, bands: int = 16, width: int = 8) -> DataFrame:
    """Candidates (a < b): the first row of each bucket of a band with every other row of it.

    Rows of equal signatures are one, under the first position. Any two rows of a bucket are linked by way of its first.
    """
    return star_pairs(band_members(signatures, bands, width))


def near(signatures: DataFrame, threshold: float = 0.85) -> DataFrame:
    """position, match (of the earlier rows compared, see `matched`, that which agrees best, ties to the smallest) and agreement; null without one."""
    first = signatures.groupBy("signature").agg(F.min("position").alias("rep"))
    own = signatures.join(first, "signature")
    side = lambda c: own.where("position = rep").select(F.col("position").alias(c), F.col("signature").alias(f"s_{c}"))

    def judged(pairs: DataFrame) -> DataFrame:
        return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", agreement(F.col("s_a"), F.col("s_b")).alias("agreement")).where(F.col("agreement") >= threshold)

    best = matched(band_members(signatures), judged).groupBy("b").agg(F.max(F.struct("agreement", (-F.col("a")).alias("na"))).alias("m")).select(F.col("b").alias("position"), (-F.col("m.na")).alias("match"), F.col("m.agreement").alias("agreement"))
    copies = own.where("position <> rep").select("position", F.col("rep").alias("match"), F.lit(1.0).alias("agreement"))
    found = best.unionByName(copies)
    return signatures.select("position").join(found, "position", "left")


def simhashes(rows: DataFrame, text: str = "t", position: str = "doc_id", size: int = 4) -> DataFrame:
    """position and simhash (64 bits): sign of the sum of +1 and -1 over all shingles, repeats too."""

    def run(batches):
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                h = _shingle_hashes(t or "", size)
                total = np.zeros(64, np.int64)
                for at in range(0, len(h), 8192):
                    part = h[at : at + 8192]
                    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    total += 2 * bits.sum(0, dtype=np.int64) - len(part)
                out.append(np.packbits(total > 0, bitorder="little").view(np.int64)[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(out, np.int64))], names=["position", "simhash"])

    return rows.select(F.col(position).cast("long"), F.col(text)).mapInArrow(run, "position long, simhash long")


def near_by_simhash(hashes: DataFrame, distance: int = 3) -> DataFrame:
    """position, match (of the earlier rows compared, see `matched`, the nearest within the distance, ties to the smallest), distance.

    The 64 bits are cut into distance + 3 blocks; two hashes within the distance agree in three of them
    at least, so buckets are all choices of three blocks: some 32 bits each, which hashes that are
    not alike hardly share. Equal hashes are one row first.
    """
    first = hashes.groupBy("simhash").agg(F.min("position").alias("rep"))
    edges = [64 * i // (distance + 3) for i in range(distance + 4)]
    block = [F.shiftrightunsigned("simhash", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in pairwise(edges)]
    keys = F.array(*(F.xxhash64(F.lit(i), *(block[x] for x in chosen)) for i, chosen in enumerate(combinations(range(len(block)), 3))))
    members = first.select("rep", F.explode(keys).alias("key"))
    side = lambda c, v: first.select(F.col("rep").alias(c), F.col("simhash").alias(v))

    def judged(pairs: DataFrame) -> DataFrame:
        return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).alias("d")).where(F.col("d") <= distance)

    best = matched(members, judged).groupBy("b").agg(F.min(F.struct("d", "a")).alias("m")).select(F.col("b").alias("position"), F.col("m.a").alias("match"), F.col("m.d").alias("distance"))
    copies = hashes.join(first, "simhash").where("position <> rep").select("position", F.col("rep").alias("match"), F.lit(0).alias("distance"))
    return hashes.select("position").join(best.unionByName(copies), "position", "left")


def hybrid(rows: DataFrame, text: str = "t", position: str = "doc_id") -> DataFrame:
    """Exact duplicates first; only the others reach the near index. method is exact, near or unique."""
    marked = exact(rows, text, position)
    found = near(minhash_signatures(marked.where("NOT is_duplicate"), text, position))
    joined = marked.select(F.col(position).alias("position"), "first_id", "is_duplicate").join(found, "position", "left")
    method = F.when(F.col("is_duplicate"), "exact").when(F.col("match").isNotNull(), "near").otherwise("unique")
    return joined.select("position", method.alias("method"), F.when(F.col("is_duplicate"), F.col("first_id")).otherwise(F.col("match")).alias("match"))
