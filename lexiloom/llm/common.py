"""What the operators of this subpackage share: tables, shared storage, Arrow batches, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one step inside a Python worker handles at once.
CHUNK_BYTES = 3 << 19
_own_dirs: dict[str, str] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_open: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and Spark is local."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="lexiloom-")
    return _own_dirs[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, and a lost executor costs a reread."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    for made in _open:
        made.append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` made and that no later read needs."""
    for t in tables:
        if path := _paths.pop(t, None):
            _delete(t.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end what `written` made inside, but for tables passed to the function it gives."""
    made: list[str] = []
    kept: list[str] = []
    _open.append(made)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(_paths[df])
        return df

    try:
        yield keep
    finally:
        _open.remove(made)
        for path in made:
            if path not in kept:
                _delete(spark, path)


def join_by_key(rows: DataFrame, table: DataFrame, key: str, columns: list[str], weight: str, small: bool, kind: str, hot_share: float = 0.002) -> DataFrame:
    """rows joined with a written table of one row per key, which tells in `weight` how many rows have it.

    A small table is broadcast whole. Of a larger one only the keys with over hot_share of all weight are, of which
    there are at most 1 / hot_share; the others are joined by shuffle, where no key has a large part. `columns` may
    not be null in the table.
    """
    own = table.select(key, *columns)
    if small:
        return rows.join(F.broadcast(own), key, kind)
    whole = table.agg(F.sum(weight)).first()[0] or 0
    hot = own.join(F.broadcast(table.where(F.col(weight) > hot_share * whole).select(key)), key, "left_semi")
    names = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(names, key, "left_anti").join(own, key, kind))


def byte_list(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of the text column each; a longer text is a slice of its own."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back_memory() -> None:
    """Python workers live on after a task: what it freed goes back to the system, where the C library can do that."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def arrow_map(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str, most: int = CHUNK_BYTES) -> DataFrame:
    """df.mapInArrow over slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text, most):
            if (out := step(part)) is not None:
                yield out
        give_back_memory()

    return df.mapInArrow(run, schema)


#: Bytes kept as parts of words, A-Z made a-z; all other ASCII is a gap.
_ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def alnum_words(text: bytes) -> list[bytes]:
    r"""Lower-cases A-Z; words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+."""
    return text.translate(_ALNUM).split()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on uint64."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordHashes:
    """64-bit hashes of words, remembered up to a fixed number of words."""

    def __init__(self, most: int = 150_000):
        import xxhash

        self._hash, self._most, self._known = xxhash.xxh3_64_intdigest, most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, hash_of = self._known, self._hash
        if len(known) > self._most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            known.update((w, hash_of(w)) for w in set(words).difference(known))
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
