r"""Quality rules: robust multivariate outliers by minimum covariance determinant (MCD).

Each text becomes exact counts (words are [^\x20\x09-\x0D]+) and a transformed vector of six
statistics. Rows are judged by the MCD estimate of their (language, source) group, or of their
language where the group has under `min_rows` rows, or of all rows where the language has.

MCD: of all shares `h` of a group's rows, that whose covariance has the least determinant. Three
deterministic starts (spreads alone; with correlations of tanh-transformed values; with
correlations of spatial signs) each take concentration steps, which keep the rows of the `h`
smallest distances and take their mean and covariance anew, until the determinant no longer
falls; the start that ends with the least wins. A row is rejected if its Mahalanobis distance is
over the cutoff.

A step is one aggregation over the narrow table of statistics: sums by (group, start, bin of the
distance). The nearest share `h` are the bins up to it, with a part of the last bin, so a step
is the same in every run and a hot source costs partial sums, never a task of its own.

Floors on the spread of each statistic keep the estimate regular where most rows agree
exactly (no symbols, no repeated line), as in the regularised MCD.

Defined results: a null text has no words; null language or source is a group of its own; a
text that fails the base rules is not kept and not part of an estimate; very long texts are
read whole; repeated rows are judged one by one, and rows that all agree keep each other; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHashes, arrow_map, byte_list, join_by_key, mix64, written

#: Statistics and the least spread (standard deviation) that each is given.
FLOORS = {"s_symbol": 0.05, "s_upper": 0.07, "s_dup": 0.2, "s_repeat": 0.2, "s_punct": 0.06, "s_length": 0.12}
NAMES = tuple(FLOORS)
PAIRS = tuple(combinations_with_replacement(range(len(NAMES)), 2))


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    h: float = 0.75
    #: A start has settled when a step lowers the logarithm of its determinant by less than this.
    settled: float = 0.01
    #: Squared distance; the 0.99999 quantile of chi-squared with six degrees of freedom.
    cutoff: float = 33.11
    min_rows: int = 100
    #: Bins of the squared distance for each doubling, from 2^-5 to 2^20.
    bins_each: int = 8
    #: Quartiles, which only begin the search, are those of values rounded to this part of 1.
    grid: int = 128
    #: Estimates up to this number (400 bytes each) are broadcast; beyond it those of groups with many rows are.
    max_broadcast: int = 20_000


_SYMBOLS, _SPACE = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_PUNCT = b"!\"'(),-./:;?@[]\\^_`{}~+="
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIELDS = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.DoubleType()) for c in NAMES]


def repeated_words(words: list[list[bytes]], hashes: WordHashes) -> np.ndarray:
    """For each text, the words inside 3-word windows that the text holds twice or more."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = hashes([w for ws in words for w in ws])
    if len(flat) < 4:
        return np.zeros(len(words), np.int64)
    doc = np.repeat(np.arange(len(words), dtype=np.uint64), sizes)
    with np.errstate(over="ignore"):
        keyed = flat * np.uint64(0x9E3779B97F4A7C15) + mix64(doc)
        key = mix64(mix64(keyed[:-2]) + flat[1:-1]) + flat[2:]
    whole = np.flatnonzero(doc[:-2] == doc[2:])
    key = key[whole]
    order = np.argsort(key)
    in_order = key[order]
    same = in_order[1:] == in_order[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    start = whole[twice]
    hit = np.zeros(len(flat), bool)
    for gap in range(3):
        hit[start + gap] = True
    return np.bincount(doc[hit].astype(np.int64), minlength=len(words))


def measure(texts: list[bytes | None], hashes: WordHashes) -> dict[str, np.ndarray]:
    """Counts and transformed statistics of whole texts."""
    texts = [t or b"" for t in texts]
    words = [t.split() for t in texts]
    n = np.zeros((len(texts), 8), np.int64)
    for i, (t, ws) in enumerate(zip(texts, words, strict=True)):
        lines = t.split(b"\n")
        with_word = [x for x in lines if x and not x.isspace()] if len(lines) > 1 else []
        size = len(t)
        visible = len(t.translate(None, _SPACE))
        # Bytes 80..BF continue a code point.
        inside = 0 if t.isascii() else size - len(t.decode("utf-8", "replace"))
        n[i] = (
            len(ws),
            visible - inside,
            size - len(t.translate(None, _SYMBOLS)),
            len(with_word) - len(set(with_word)),
            0,
            size - len(t.translate(None, _UPPER)),
            size - len(t.translate(None, _PUNCT)),
            len(with_word) or 1,
        )
    n[:, 4] = repeated_words(words, hashes)
    chars, count = np.maximum(n[:, 1], 1), np.maximum(n[:, 0], 1)
    share = lambda j, of: np.sqrt(np.minimum(n[:, j] / of, 1.0))
    out = {c: n[:, j] for j, c in enumerate(COUNTS)}
    out |= {"s_symbol": share(2, chars), "s_upper": share(5, chars), "s_dup": share(3, n[:, 7]), "s_repeat": share(4, count), "s_punct": share(6, chars), "s_length": np.log(chars / count)}
    return out


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns of `measure`; columns of these names are replaced, the rest stay."""
    docs = docs.drop(*(f.name for f in FIELDS))
    cache: list[WordHashes] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.append(WordHashes())
        new = measure(byte_list(batch.column(text)), cache[0])
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(new[f.name]) for f in FIELDS)], names=[*batch.schema.names, *(f.name for f in FIELDS)])

    return arrow_map(docs, step, T.StructType([*docs.schema.fields, *FIELDS]), text)


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def group_key(level: int) -> Column:
    """Level 0: language and source, 1: language, 2: all."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    return [F.concat_ws("\x01", F.lit("0"), part("lang"), part("source")), F.concat_ws("\x01", F.lit("1"), part("lang")), F.lit("2")][level]


def distance(center: str = "center", precision: str = "precision") -> Column:
    """Squared Mahalanobis distance of the row's statistics; precision holds the upper triangle of the inverse."""
    d = [F.col(c) - F.col(center)[i] for i, c in enumerate(NAMES)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        total = total + F.col(precision)[k] * d[i] * d[j] * (1.0 if i == j else 2.0)
    return total


def consistency(h: float, p: int = len(NAMES)) -> float:
    """h / P(chi2(p + 2) <= the h-quantile of chi2(p)): what makes up for the spread that the farthest rows of a normal sample take with them; p even."""
    def below(x: float, df: int) -> float:
        term, total = 1.0, 1.0
        for j in range(1, df // 2):
            term *= x / 2 / j
            total += term
        return 1 - float(np.exp(-x / 2)) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle, p) < h else (low, middle)
    return h / below(low, p + 2)


# ---- estimates; `cov` and `precision` are upper triangles

FLOOR = np.diag(np.square(list(FLOORS.values())))
STATE = "grp string, n long, start int, center array<double>, cov array<double>, precision array<double>, logdet double, open boolean"


def square(triangle: np.ndarray) -> np.ndarray:
    p = len(NAMES)
    out = np.zeros((p, p))
    for k, (i, j) in enumerate(PAIRS):
        out[i, j] = out[j, i] = triangle[k]
    return out


def triangle(matrix: np.ndarray) -> list[float]:
    return [float(matrix[i, j]) for i, j in PAIRS]


def starts(median: np.ndarray, spread: np.ndarray, tanh: np.ndarray, sign: np.ndarray) -> list[np.ndarray]:
    """Covariances to begin with: diagonal, and with the correlations of two sums of products (triangles)."""
    out = [np.diag(spread**2)]
    for products in (tanh, sign):
        m = square(products)
        root = np.sqrt(np.maximum(np.diag(m), 1e-12))
        corr = np.clip(m / np.outer(root, root), -0.99, 0.99)
        np.fill_diagonal(corr, 1.0)
        out.append(corr * np.outer(spread, spread))
    return out


def concentrated(bins: list[tuple[int, list[float]]], n: int, h: float) -> tuple[np.ndarray, np.ndarray]:
    """(mean, covariance) of the h * n rows in the lowest bins; sums of a bin: rows, then values, then products."""
    p, left, total = len(NAMES), h * n, np.zeros(1 + len(NAMES) + len(PAIRS))
    for _, sums in sorted(bins):
        part = min(1.0, left / sums[0])
        total += part * np.array(sums)
        left -= part * sums[0]
        if left <= 1e-9 * n:
            break
    center = total[1 : 1 + p] / total[0]
    return center, square(total[1 + p :] / total[0]) - np.outer(center, center)


def _python(rows: DataFrame, step, schema: str) -> DataFrame:
    """rows.mapInArrow over dicts; each row is one group or less."""
    empty = rows.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(empty)

    def run(batches):
        for batch in batches:
            if out := [x for r in batch.to_pylist() for x in step(r)]:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def groups(stats: DataFrame, rules: Rules) -> DataFrame:
    """grp (of level 0), n, used (the group whose estimate judges its rows), own (the groups whose estimates its rows make)."""
    own = stats.where(~base_failed(rules)).groupBy(group_key(0).alias("grp"), group_key(1).alias("language")).agg(F.count(F.lit(1)).alias("n"))
    own = written(own, "groups")
    language = own.groupBy("language").agg(F.sum("n").alias("n1"), (F.min("n") < rules.min_rows).alias("need1"))
    need2 = bool(language.where(F.col("n1") < rules.min_rows).limit(1).count())
    joined = own.join(language, "language")  # one row per group: no key holds many
    enough0, enough1 = F.col("n") >= rules.min_rows, F.col("n1") >= rules.min_rows
    used = F.when(enough0, F.col("grp")).when(enough1, F.col("language")).otherwise(F.lit("2"))
    makes = F.array_compact(F.array(F.when(enough0, F.col("grp")), F.when(enough1 & F.col("need1"), F.col("language")), F.lit("2" if need2 else None).cast("string")))
    return written(joined.select("grp", "n", used.alias("used"), makes.alias("own")), "groups")


def fit(stats: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, int]:
    """(grp of level 0, n, center, precision of the estimate that judges it; their number) from rows with lang, source and the statistics."""
    known = groups(stats, rules)
    n_groups = known.count()
    few = n_groups <= rules.max_broadcast
    rows = stats.where(~base_failed(rules)).select(group_key(0).alias("grp"), *NAMES)
    rows = join_by_key(rows, known, "grp", ["own"], "n", few, "inner").select(F.explode("own").alias("grp"), *NAMES)

    quartiles = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *(F.percentile(F.round(F.col(c) * rules.grid) / rules.grid, [0.25, 0.5, 0.75]).alias(f"p{i}") for i, c in enumerate(NAMES)))
    spread = [F.greatest((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, F.lit(FLOORS[c])) for i, c in enumerate(NAMES)]
    first = written(quartiles.select("grp", "n", F.array(*(F.col(f"p{i}")[1] for i in range(len(NAMES)))).alias("median"), F.array(*spread).alias("spread")), "mcd")
    z = [(F.col(c) - F.col("median")[i]) / F.col("spread")[i] for i, c in enumerate(NAMES)]
    scaled = join_by_key(rows, first, "grp", ["median", "spread"], "n", few, "inner").select("grp", *(x.alias(f"z{i}") for i, x in enumerate(z)))
    squares = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(NAMES))), F.lit(1e-12))
    scaled = scaled.withColumn("zz", squares)
    products = [F.sum(F.tanh(f"z{i}") * F.tanh(f"z{j}")).alias(f"t{k}") for k, (i, j) in enumerate(PAIRS)] + [F.sum(F.col(f"z{i}") * F.col(f"z{j}") / F.col("zz")).alias(f"g{k}") for k, (i, j) in enumerate(PAIRS)]
    sums = scaled.groupBy("grp").agg(*products)
    begun = sums.select("grp", F.array(*(f"t{k}" for k in range(len(PAIRS)))).alias("tanh"), F.array(*(f"g{k}" for k in range(len(PAIRS)))).alias("sign")).join(first, "grp")

    def begin(r: dict) -> list[dict]:
        out = []
        for start, cov in enumerate(starts(*(np.array(r[c]) for c in ("median", "spread", "tanh", "sign")))):
            out.append({"grp": r["grp"], "n": r["n"], "start": start, "center": r["median"], "cov": triangle(cov), "precision": triangle(np.linalg.inv(cov + FLOOR)), "logdet": float("inf"), "open": True})
        return out

    state = written(_python(begun, begin, STATE), "mcd")
    lowest, highest = -5 * rules.bins_each, 20 * rules.bins_each
    while (open_ := state.where("open").select("grp", "n", F.struct("start", "center", "precision").alias("s"))).limit(1).count():
        todo = written(open_.groupBy("grp").agg(F.first("n").alias("n"), F.collect_list("s").alias("s")), "mcd")  # three starts at most
        far = join_by_key(rows, todo, "grp", ["s"], "n", few, "inner").select("grp", *NAMES, F.explode("s").alias("s")).select("grp", *NAMES, "s.start", "s.center", "s.precision")
        at = F.least(F.greatest(F.floor(F.log2(F.greatest(distance(), F.lit(1e-12))) * rules.bins_each), F.lit(lowest)), F.lit(highest))
        moments = [F.count(F.lit(1)).cast("double").alias("m"), *(F.sum(c).alias(f"s{i}") for i, c in enumerate(NAMES)), *(F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"q{k}") for k, (i, j) in enumerate(PAIRS))]
        binned = far.groupBy("grp", "start", at.alias("bin")).agg(*moments)
        sums = F.array("m", *(f"s{i}" for i in range(len(NAMES))), *(f"q{k}" for k in range(len(PAIRS))))
        gathered = binned.groupBy("grp", "start").agg(F.collect_list(F.struct("bin", sums.alias("sums"))).alias("bins"))  # at most 200 bins

        def concentrate(r: dict) -> list[dict]:
            center, cov = concentrated([(b["bin"], b["sums"]) for b in r["bins"]], r["n"], rules.h)
            logdet = float(np.linalg.slogdet(cov + FLOOR)[1])
            row = {c: r[c] for c in ("grp", "n", "start", "center", "cov", "precision", "logdet")}
            if logdet < row["logdet"]:
                row |= {"center": center.tolist(), "cov": triangle(cov), "precision": triangle(np.linalg.inv(cov + FLOOR)), "logdet": logdet}
            return [row | {"open": logdet < r["logdet"] - rules.settled}]

        stepped = _python(state.where("open").join(gathered, ["grp", "start"]), concentrate, STATE)
        state = written(stepped.unionByName(state.where("NOT open")), "mcd")
    factor = consistency(rules.h)

    def finish(r: dict) -> list[dict]:
        return [{"used": r["grp"], "center": r["center"], "precision": triangle(np.linalg.inv(square(r["cov"]) * factor + FLOOR))}]

    least = state.groupBy("grp").agg(F.min(F.struct("logdet", "start", "center", "cov")).alias("b")).select("grp", "b.center", "b.cov")
    best = _python(least, finish, "used string, center array<double>, precision array<double>")
    # One row per group on the left; a language's estimate may serve many groups, but each of them is one row.
    small = best.count() <= rules.max_broadcast
    return written(known.join(F.broadcast(best) if small else best, "used").select("grp", "n", "center", "precision"), "estimates"), n_groups


def judged(stats: DataFrame, estimates: DataFrame, n_groups: int, rules: Rules = Rules()) -> DataFrame:
    """stats with base_failed, d2 (squared distance, null if no estimate) and kept; all its columns stay."""
    out = stats.drop("base_failed", "d2", "kept", "_mcd_group", "_mcd_center", "_mcd_precision")
    table = estimates.withColumnsRenamed({"grp": "_mcd_group", "n": "_mcd_rows", "center": "_mcd_center", "precision": "_mcd_precision"})
    out = join_by_key(out.withColumn("_mcd_group", group_key(0)), table, "_mcd_group", ["_mcd_center", "_mcd_precision"], "_mcd_rows", n_groups <= rules.max_broadcast, "left")
    out = out.withColumn("base_failed", base_failed(rules)).withColumn("d2", distance("_mcd_center", "_mcd_precision"))
    kept = ~F.col("base_failed") & (F.col("d2").isNull() | (F.col("d2") <= rules.cutoff))
    return out.withColumn("kept", kept).drop("_mcd_group", "_mcd_center", "_mcd_precision")
