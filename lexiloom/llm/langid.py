r"""Language identification by a byte convolutional network, trained and applied in numpy.

A text's UTF-8 bytes are cut into windows of fixed length that together cover the whole text
(neighbours share `widest - 1` bytes, so no filter position is lost). Each window goes
through filters of several widths, a maximum over its positions and a softmax; a text's
class is that of the mean of its windows' log-probabilities, weighted by their bytes.

A filter of width k is a sum of k rows of tables (256 bytes by filters), so a window costs
table lookups and no embedding. The fit reads a bounded sample: `Fit.windows_each` windows of
each of the `Fit.max_rows` ids with the smallest xxhash64(doc_id). Windows are cut on the executors;
the driver gets these alone. Prediction reads every byte.

Defined results: a text that is null or has no letter is `und` with score 0; a very long text
is predicted from all its windows; without rows to learn from every text is `und`; rows with a null
language are not learnt from; of rows of one id the fit reads one; repeated rows are predicted
one by one; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, byte_list, mix64


@dataclass(frozen=True)
class Fit:
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    window: int = 256
    #: The bounded sample: labelled texts that the fit reads at most, and windows of each.
    max_rows: int = 4000
    windows_each: int = 4
    epochs: int = 6
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Model:
    classes: list[str]
    window: int
    tables: list[list[np.ndarray]]  # for each width, a table (256, filters) for each offset
    bias: np.ndarray
    dense: np.ndarray  # (all filters, classes)
    dense_bias: np.ndarray

    @property
    def step(self) -> int:
        return self.window - max(len(t) for t in self.tables) + 1


def windows_of(text: bytes, window: int, step: int) -> np.ndarray:
    """(windows, window) bytes that cover the text; the last is filled with zeros."""
    count = max(1, -(-(len(text) - (window - step)) // step))
    filled = np.zeros((count - 1) * step + window, np.uint8)
    filled[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(filled, window)[::step]


def convolve(bytes_in: np.ndarray, tables: list[list[np.ndarray]]) -> list[np.ndarray]:
    """For each width, (windows, positions, filters)."""
    size = bytes_in.shape[1]
    out = []
    for table in tables:
        positions = size - len(table) + 1
        total = table[0][bytes_in[:, :positions]]
        for offset in range(1, len(table)):
            total += table[offset][bytes_in[:, offset : offset + positions]]
        out.append(total)
    return out


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def sampled(text: bytes, doc_id: int, how: Fit) -> np.ndarray:
    """Up to windows_each windows of a text, chosen by its id; half of them shortened, so that short texts are known."""
    rng = np.random.default_rng([how.seed, doc_id & 0xFFFFFFFFFFFFFFFF])
    own = windows_of(text, how.window, how.window - max(how.widths) + 1)
    own = own[rng.permutation(len(own))[: how.windows_each]]
    keep = np.where(rng.random(len(own)) < 0.5, rng.integers(16, how.window + 1, len(own)), how.window)
    return np.where(np.arange(how.window) < keep[:, None], own, 0).astype(np.uint8)


def fit(windows: np.ndarray, labels: list[str], how: Fit = Fit()) -> Model | None:
    """Adam on the cross-entropy of windows; the maximum passes the gradient to one position of each filter."""
    classes = sorted(set(labels))
    if not classes:
        return None
    rng = np.random.default_rng(how.seed)
    number = {c: i for i, c in enumerate(classes)}
    x, y = windows, np.array([number[c] for c in labels])
    nf, nw, nc = how.filters, len(how.widths), len(classes)
    params = {f"t{k}": rng.normal(0, 0.3, (w, 256, nf)).astype(np.float32) for k, w in enumerate(how.widths)}
    params |= {"b": np.zeros(nf * nw, np.float32), "d": rng.normal(0, 0.2, (nf * nw, nc)).astype(np.float32), "c": np.zeros(nc, np.float32)}
    for k in range(nw):
        params[f"t{k}"][:, 0] = 0
    m, v = ({k: np.zeros_like(p) for k, p in params.items()} for _ in range(2))
    share = np.bincount(y, minlength=nc)
    weight = (len(y) / (nc * np.maximum(share, 1)))[y].astype(np.float32)
    tick = 0
    for _ in range(how.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), how.batch):
            rows = order[at : at + how.batch]
            xb, yb = x[rows], y[rows]
            maps = convolve(xb, [list(params[f"t{k}"]) for k in range(nw)])
            where = [a.argmax(1) for a in maps]
            top = np.concatenate([np.take_along_axis(a, w[:, None], 1)[:, 0] for a, w in zip(maps, where, strict=True)], 1) + params["b"]
            hidden = np.maximum(top, 0)
            g = np.exp(log_softmax(hidden @ params["d"] + params["c"]))
            g[np.arange(len(rows)), yb] -= 1
            g *= weight[rows, None] / len(rows)
            back = (g @ params["d"].T) * (top > 0)
            grads = {"d": hidden.T @ g, "c": g.sum(0), "b": back.sum(0)}
            for k, w in enumerate(how.widths):
                gk = np.zeros_like(params[f"t{k}"])
                part = back[:, k * nf : (k + 1) * nf]
                for offset in range(w):
                    byte = np.take_along_axis(xb, where[k] + offset, 1)
                    np.add.at(gk[offset], (byte, np.arange(nf)[None]), part)
                gk[:, 0] = 0  # the filling has no say
                grads[f"t{k}"] = gk
            tick += 1
            for k, p in params.items():
                m[k] += 0.1 * (grads[k] - m[k])
                v[k] += 0.001 * (grads[k] ** 2 - v[k])
                p -= how.rate * (m[k] / (1 - 0.9**tick)) / (np.sqrt(v[k] / (1 - 0.999**tick)) + 1e-8)
    return Model(classes, how.window, [list(params[f"t{k}"]) for k in range(nw)], params["b"], params["d"], params["c"])


def log_probabilities(windows: np.ndarray, model: Model, at_once: int = 128) -> np.ndarray:
    out = []
    for at in range(0, len(windows), at_once):
        top = np.concatenate([a.max(1) for a in convolve(windows[at : at + at_once], model.tables)], 1) + model.bias
        out.append(log_softmax(np.maximum(top, 0) @ model.dense + model.dense_bias))
    return np.concatenate(out)


def has_letter(text: bytes) -> bool:
    return text.upper() != text.lower() or (not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))


def predict(texts: list[bytes | None], model: Model | None) -> tuple[list[str], np.ndarray]:
    score = np.zeros(len(texts))
    name = ["und"] * len(texts)
    lettered = [i for i, t in enumerate(texts) if t and has_letter(t)] if model else []
    if not lettered:
        return name, score
    cut = [windows_of(texts[i], model.window, model.step) for i in lettered]
    counts = np.array([len(c) for c in cut])
    logp = log_probabilities(np.concatenate(cut), model)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    covered = np.full(len(logp), model.window, np.float64)
    covered[first + counts - 1] = np.array([len(texts[i]) for i in lettered]) - (counts - 1) * model.step
    total = np.add.reduceat(logp * covered[:, None], first) / np.add.reduceat(covered, first)[:, None]
    p = np.exp(log_softmax(total))
    for i, best, row in zip(lettered, p.argmax(1), p, strict=True):
        name[i], score[i] = model.classes[best], row[best]
    return name, score


def train(docs: DataFrame, how: Fit = Fit()) -> Model | None:
    """Fits on docs(doc_id, text, lang), which holds only rows that may be learnt from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    ids = rows.select("doc_id").groupBy("doc_id").agg(F.lit(1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.max_rows).collect()
    if not ids:
        return None
    wanted = docs.sparkSession.createDataFrame([(r.doc_id,) for r in ids], "doc_id long")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, keys = byte_list(batch.column("text")), batch.column("doc_id").to_pylist()
        own = [sampled(t, k, how).tobytes() if has_letter(t) else None for t, k in zip(texts, keys, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(own, pa.binary())], names=["doc_id", "lang", "windows"])

    cut = arrow_map(rows.join(F.broadcast(wanted), "doc_id", "left_semi"), step, "doc_id long, lang string, windows binary", "text").where("windows IS NOT NULL")
    got = cut.groupBy("doc_id").agg(F.min(F.struct("lang", "windows")).alias("r")).select("doc_id", "r.*").collect()  # max_rows x windows_each x window bytes at most
    got.sort(key=lambda r: int(mix64(np.array([r.doc_id]).astype(np.uint64))[0]))
    windows = [np.frombuffer(r.windows, np.uint8).reshape(-1, how.window) for r in got]
    return fit(np.concatenate(windows) if windows else np.zeros((0, how.window), np.uint8), [r.lang for r, w in zip(got, windows, strict=True) for _ in w], how)


def predicted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; columns of these names are replaced, the rest stay."""
    docs = docs.drop("lang_pred", "score")
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = predict(byte_list(batch.column(text)), spread.value)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"])

    return arrow_map(docs, step, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]), text)
