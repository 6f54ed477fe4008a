r"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, word pairs and pairs with one word between, hashed
into 2^bits coordinates. FTRL-proximal keeps a rate per coordinate and an L1 term, which
leaves few weights other than 0; only those are broadcast (at most 2^bits of 8 bytes).

The fit reads a bounded sample: of the `Fit.max_rows` labelled ids with the smallest
xxhash64(doc_id), in that order, those whose features stay within `Fit.max_features` together.
Features are made on the executors; the driver gets numbers of coordinates, never texts.
Scoring reads every whole text.

Defined results: a null, empty or wordless text is scored by the bias alone; a very long text is
scored whole (one whose features alone pass the bound is not learnt from); without labelled rows
the score is 0; of rows of one id the fit reads one, and the highest label; repeated rows are
scored one by one; an empty table gives no rows; other columns, also ones named like an output,
are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, alnum_words, arrow_map, byte_list, give_back_memory, mix64, written


@dataclass(frozen=True)
class Fit:
    bits: int = 20
    #: The bounded sample: labelled ids that the fit reads at most, and their distinct coordinates together (4 bytes each).
    max_rows: int = 16_000
    max_features: int = 16_000_000
    epochs: int = 2
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.02


@dataclass(frozen=True)
class Model:
    bits: int
    bias: float
    index: np.ndarray  # int32, ascending: coordinates with a weight
    weight: np.ndarray  # float32


def features(texts: list[bytes | None], hashes: WordHashes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, coordinate) of every n-gram and skip-gram of the texts; repeats are left in."""
    words = [alnum_words(t) if t else [] for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = hashes([w for ws in words for w in ws]) if lengths.sum() else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    shift = np.uint64(64 - bits)
    parts, owners = [mix64(flat) >> shift], [doc]
    with np.errstate(over="ignore"):
        for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xD1B54A32D192ED03)):
            if len(flat) > gap:
                same = doc[:-gap] == doc[gap:]
                pair = (flat[:-gap] * np.uint64(salt) + flat[gap:])[same]
                parts.append(mix64(pair) >> shift)
                owners.append(doc[:-gap][same])
    return np.concatenate(owners), np.concatenate(parts).astype(np.int32)


def distinct(texts: list[bytes | None], hashes: WordHashes, bits: int) -> list[np.ndarray]:
    """Distinct coordinates of each text, ascending."""
    owner, coord = features(texts, hashes, bits)
    key = np.unique(owner.astype(np.int64) << 32 | coord)
    ends = np.searchsorted(key, np.arange(1, len(texts)) << 32)
    return np.split((key & 0xFFFFFFFF).astype(np.int32), ends)


def fit(own: list[np.ndarray], labels: np.ndarray, how: Fit = Fit()) -> Model:
    """FTRL-proximal on the coordinates of each text, one after the other in the order given; every fifth calibrates the score."""
    if not len(labels):
        return Model(how.bits, -30.0, np.zeros(0, np.int32), np.zeros(0, np.float32))
    size = 1 << how.bits
    z, n = np.zeros(size), np.zeros(size)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    bias, bias_n = float(np.log(share / (1 - share))), 0.0

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        w = -(zi - np.sign(zi) * how.l1) / ((how.beta + np.sqrt(ni)) / how.alpha + how.l2)
        return np.where(np.abs(zi) <= how.l1, 0.0, w)

    held = np.arange(len(labels)) % 5 == 4
    for _ in range(how.epochs):
        for i in np.flatnonzero(~held):
            idx = own[i]
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
            g = p - labels[i]
            new = ni + g * g
            z[idx] = zi + g - (np.sqrt(new) - np.sqrt(ni)) / how.alpha * w
            n[idx] = new
            bias_n += g * g
            bias -= 0.05 * g / (1 + np.sqrt(bias_n))
    w = weights(z, n)
    index = np.flatnonzero(w).astype(np.int32)
    logit = np.array([w[own[i]].sum() + bias for i in np.flatnonzero(held)])
    slope, offset = calibrated(logit, labels[held])
    return Model(how.bits, slope * bias + offset, index, (slope * w[index]).astype(np.float32))


def calibrated(logit: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Platt scaling: slope and offset of the logistic curve through (logit, y), by damped Newton steps."""
    if len(y) < 50 or not 0 < y.mean() < 1:
        return 1.0, 0.0
    ab, x = np.array([1.0, 0.0]), np.stack([logit, np.ones_like(logit)])
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -30, 30)))
        gradient, v = x @ (p - target), p * (1 - p) + 1e-6
        ab = ab - np.clip(np.linalg.solve((x * v) @ x.T + 1e-3 * np.eye(2), gradient), -1, 1)
    return (float(ab[0]), float(ab[1])) if ab[0] > 0 else (1.0, 0.0)


def score(texts: list[bytes | None], model: Model, dense: np.ndarray, hashes: WordHashes) -> np.ndarray:
    owner, coord = features(texts, hashes, model.bits)
    hit = dense[coord] != 0
    key = np.unique(owner[hit].astype(np.int64) << 32 | coord[hit])
    total = np.bincount(key >> 32, weights=dense[key & 0xFFFFFFFF], minlength=len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, how: Fit = Fit(), label: str = "toxic") -> Model:
    """Fits on the labelled documents; `labels` holds only rows that may be learnt from."""
    spark = docs.sparkSession
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    sample = rows.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.max_rows).collect()
    if not sample:
        return fit([], np.zeros(0), how)
    y_of = {r.doc_id: r.y for r in sample}
    ids = spark.createDataFrame([(r.doc_id,) for r in sample], "doc_id long")
    cache: list[WordHashes] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.append(WordHashes())
        own = distinct(byte_list(batch.column("text")), cache[0], how.bits)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], names=["doc_id", "n", "own"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id", "left_semi")
    made = written(arrow_map(texts, step, "doc_id long, n long, own binary", "text"), "features")
    one = made.groupBy("doc_id").agg(F.min(F.struct("n", F.xxhash64("own").alias("h"))).alias("f")).select("doc_id", "f.n", "f.h")
    size_of = {r.doc_id: (r.n, r.h) for r in one.collect()}  # max_rows at most
    chosen, room = {}, how.max_features
    for r in sample:
        if r.doc_id in size_of and size_of[r.doc_id][0] <= room:
            room -= size_of[r.doc_id][0]
            chosen[r.doc_id] = size_of[r.doc_id][1]
    if not chosen:
        return fit([], np.zeros(0), how)
    wanted = spark.createDataFrame(list(chosen.items()), "doc_id long, h long")
    got = made.withColumn("h", F.xxhash64("own")).join(F.broadcast(wanted), ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "own").toArrow()
    at = {d: i for i, d in enumerate(got.column("doc_id").to_pylist())}
    order = sorted(chosen, key=lambda d: int(mix64(np.array([d]).astype(np.uint64))[0]))
    blob = got.column("own")
    own = [np.frombuffer(blob[at[d]].as_buffer(), np.int32) for d in order]
    model = fit(own, np.array([y_of[d] for d in order], np.float64), how)
    del own, blob, got
    give_back_memory()
    return model


def scored(docs: DataFrame, model: Model, column: str = "score", text: str = "text") -> DataFrame:
    """docs with one more column, the score of each whole text; a column of that name is replaced."""
    from pyspark.sql import types as T

    docs = docs.drop(column)
    spread = docs.sparkSession.sparkContext.broadcast(model)
    cache: list = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            m = spread.value
            dense = np.zeros(1 << m.bits, np.float32)
            dense[m.index] = m.weight
            cache.extend((m, dense, WordHashes()))
        m, dense, hashes = cache
        out = score(byte_list(batch.column(text)), m, dense, hashes)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, column])

    return arrow_map(docs, step, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]), text)
