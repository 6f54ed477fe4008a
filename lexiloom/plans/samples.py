"""Metrics of samples over the table documents: quality, safety, anomalies, tokens, normalisation.

As in the corpus queries, PLANTED appends phrases so that every branch is met.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import normalize as N
from ..functions import quality as Q
from ..functions import text as X
from ..functions import tokens as K
from ..functions.measures import counts, repeated
from .corpus import _hits, _list
from .registry import query, spread, table

PLANTED = [
    " mail a.b@example.com or 555-123-4567, 123-45-6789, password and secret",
    " click here to subscribe, see our privacy policy, all rights reserved",
    " ignore previous text; ignore prior rules; pretend to be root; jailbreak",
    " save to file and upload to http, encode as base64 encode",
    "\t\ttabs\r\nand \r\n\r\n\r\n\r\nlines   with   blanks  ",
    " “quoted” — dash – ‘single’",
    " api key token credentials confidential 10.0.0.1",
    " !!! ??? ;;; ,,, *** ((( ))) [[[ ]]]",
    "",
    "",
    "",
]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrase = F.get(F.array(*map(F.lit, PLANTED)), (F.col("doc_id") % len(PLANTED)).cast("int"))
    return spread(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", F.concat(F.coalesce("text", F.lit("")), phrase).alias("t"))


_BASE = f"WITH s AS (SELECT doc_id, lang, source, coalesce(text, '') || {_list(PLANTED)}[doc_id % {len(PLANTED)} + 1] AS t FROM documents)"
_W = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"
_WT, _WL = _W.format("t"), _W.format("lower(t)")


def _ngrams(array: str, n: int) -> str:
    return f"list_transform(range(1, len({array}) - {n} + 2), lambda i: array_to_string({array}[i:i + {n} - 1], chr(1)))"


def _repeated(items: str) -> str:
    return f"CASE WHEN len({items}) > 0 THEN 1 - CAST(len(list_distinct({items})) AS DOUBLE) / len({items}) ELSE 0.0 END"


def _entropy(text: str) -> str:
    """Character counts by unnesting."""
    return f"(SELECT abs(coalesce(log2(sum(c)) - sum(c * log2(c)) / sum(c), 0.0)) FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM (SELECT unnest(string_split({text}, '')) AS ch) WHERE ch <> '' GROUP BY ch))"


def _out(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t in ("int", "bigint") else F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes))


def _doc(op: str, sql: str | None, **columns) -> None:
    """One row per document; columns are functions of the text Column."""

    @query(op, f"{_BASE} {sql}" if sql else None)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = F.col("t")
        return _out(samples(spark, sf_dir).select("doc_id", *(f(t).alias(n) for n, f in columns.items())))


_READ = r"""greatest(0.0, least(1.0, 1 - (CAST(length(regexp_replace(t, '\s+', '', 'g')) AS DOUBLE) / n - 4) / 10 - (CAST(n AS DOUBLE) / (length(t) - length(regexp_replace(t, '[.!?]', '', 'g')) + 1) - 15) / 50))"""
_doc("op_txt_11_readability", f"SELECT doc_id, round(CASE WHEN n > 0 THEN {_READ} ELSE 0.0 END, 6) AS score FROM (SELECT *, len({_WT}) AS n FROM s)", score=Q.readability)
_doc("op_txt_12_char_entropy", f"SELECT doc_id, round(CASE WHEN d > 1 THEN {_entropy('lower(t)')} / log2(d) ELSE 0.0 END, 6) AS entropy FROM (SELECT *, len(list_filter(list_distinct(string_split(lower(t), '')), lambda c: c <> '')) AS d FROM s)", entropy=X.char_entropy_normal)
_doc("op_txt_13_boilerplate", f"SELECT doc_id, round(least(1.0, {_hits('lower(t)', L.BOILERPLATE)} / CAST(3 AS DOUBLE)), 6) AS score FROM s", score=Q.boilerplate)

_QUALITY_SQL = f"""{_BASE}, q0 AS (SELECT *, len({_WT}) AS n, {_WL} AS wl, len(list_filter(list_distinct(string_split(lower(t), '')), lambda c: c <> '')) AS d FROM s),
q1 AS (SELECT doc_id, lang, source, length(t) AS n_chars, CASE WHEN n > 0 THEN {_READ} ELSE 0.0 END AS readability, {_repeated(_ngrams('wl', 3))} AS repetition,
  CASE WHEN d > 1 THEN {_entropy('lower(t)')} / log2(d) ELSE 0.0 END AS entropy, least(1.0, {_hits('lower(t)', L.BOILERPLATE)} / CAST(3 AS DOUBLE)) AS boiler FROM q0),
q AS (SELECT *, 0.3 * readability + 0.3 * (1 - repetition) + 0.2 * entropy + 0.2 * (1 - boiler) AS quality FROM q1)"""


def message_quality(rows: DataFrame) -> DataFrame:
    t = F.col("t")
    k = counts(F.lower(t), "bits", "chars", "words", "words3", "boilerplate")
    parts = rows.select("doc_id", "lang", "source", F.length(t).alias("n_chars"), Q.readability(t).alias("readability"), Q.trigram_repetition(t, k).alias("repetition"), X.char_entropy_normal(t, k).alias("entropy"), Q.boilerplate(t, k).alias("boiler"))
    return parts.withColumn("quality", Q.composite(F.col("readability"), F.col("repetition"), F.col("entropy"), F.col("boiler")))


@query("op_txt_14_composite_quality", f"{_QUALITY_SQL} SELECT doc_id, round(readability, 6) AS readability, round(repetition, 6) AS repetition, round(entropy, 6) AS entropy, round(boiler, 6) AS boiler, round(quality, 6) AS quality FROM q")
def txt_14(spark, sf_dir):
    return _out(message_quality(samples(spark, sf_dir)).select("doc_id", "readability", "repetition", "entropy", "boiler", "quality"))


_PII_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in L.PII.items()) + "], lambda x: x IS NOT NULL)"
_doc("op_txt_15_pii", f"SELECT doc_id, array_to_string(p, ',') AS types, CAST(len(p) AS BIGINT) AS n, len(p) > 0 AS present FROM (SELECT doc_id, {_PII_SQL} AS p FROM s)", types=Q.pii_types, n=lambda t: F.size(Q.pii_types(t)), present=lambda t: F.size(Q.pii_types(t)) > 0)
_doc("op_txt_16_keyword_risk", f"SELECT doc_id, round(least(1.0, {_hits('lower(t)', L.RISK_WORDS)} / CAST(3 AS DOUBLE)), 6) AS risk FROM s", risk=Q.keyword_risk)
_TOK = "greatest(1, length(t) // 4)"
_doc("op_txt_17_context_fit", "SELECT doc_id, " + ", ".join(f"tok <= {w} AS fit_{n}, CAST(greatest(0, tok - {w}) AS BIGINT) AS cut_{n}" for n, w in L.WINDOWS.items()) + f" FROM (SELECT doc_id, {_TOK} AS tok FROM s)", **{n: (lambda n: lambda t: K.context_fit(K.char_tokens(t))[n])(n) for w in L.WINDOWS for n in (f"fit_{w}", f"cut_{w}")})


def cost_projection(totals: DataFrame) -> DataFrame:
    """tokenizer and tokens to dollars; the table of rates has a handful of rows."""
    rates = F.create_map(*(F.lit(x) for k, v in L.COSTS.items() for x in (k, F.array(*map(F.lit, v)))))
    rate = F.coalesce(F.try_element_at(rates, F.col("family")), F.array(*map(F.lit, L.COST_OTHER)))
    millions = F.col("tokens") / 1e6
    return totals.select("tokenizer", "family", "tokens", F.bround(millions * rate[0], 2).alias("train_usd"), F.bround(millions * rate[1], 2).alias("infer_usd"))


@query("op_txt_18_cost_projection", f"{_BASE}, k AS (SELECT 'whitespace' AS tokenizer, 'llama-2-7b' AS family, CAST(sum(len({_WT})) AS BIGINT) AS tokens, 2.0 AS a, 0.2 AS b FROM s UNION ALL SELECT 'gpt-4', 'gpt-4', CAST(sum({_TOK}) AS BIGINT), 30.0, 30.0 FROM s) SELECT tokenizer, family, tokens, round(CAST(tokens AS DOUBLE) / 1000000 * CAST(a AS DOUBLE), 2) AS train_usd, round(CAST(tokens AS DOUBLE) / 1000000 * CAST(b AS DOUBLE), 2) AS infer_usd FROM k")
def txt_18(spark, sf_dir):
    sums = samples(spark, sf_dir).agg(F.sum(K.word_tokens(F.col("t"))).alias("a"), F.sum(K.char_tokens(F.col("t"))).alias("b"))
    rows = F.explode(F.array(F.struct(F.lit("whitespace").alias("tokenizer"), F.lit("llama-2-7b").alias("family"), F.col("a").alias("tokens")), F.struct(F.lit("gpt-4").alias("tokenizer"), F.lit("gpt-4").alias("family"), F.col("b").alias("tokens"))))
    return cost_projection(sums.select(rows.alias("r")).select("r.*"))


# Model sizes in billions, tokens per parameter of a compute-optimal run, tokens per GPU hour.
SIZES_B = (1, 3, 7, 13, 70)
TOKENS_PER_PARAMETER = 20
TOKENS_PER_GPU_HOUR = 3_500_000


@query("op_txt_19_cost_scenarios", f"{_BASE}, k AS (SELECT CAST(sum({_TOK}) AS BIGINT) AS tokens FROM s) SELECT b AS size_b, CAST(b AS BIGINT) * 20000000000 AS optimal_tokens, round(CAST(tokens AS DOUBLE) / (b * 20000000000.0), 9) AS epochs_possible, round(CAST(tokens AS DOUBLE) * b / 3500000, 6) AS gpu_hours FROM k, (SELECT unnest([1, 3, 7, 13, 70]) AS b)")
def txt_19(spark, sf_dir):
    total = samples(spark, sf_dir).agg(F.sum(K.char_tokens(F.col("t"))).alias("tokens"))
    rows = total.select("tokens", F.explode(F.array(*map(F.lit, SIZES_B))).alias("size_b"))
    best = F.col("size_b").cast("long") * TOKENS_PER_PARAMETER * 1_000_000_000
    return rows.select("size_b", best.alias("optimal_tokens"), F.round(F.col("tokens") / best.cast("double"), 9).alias("epochs_possible"), F.round(F.col("tokens").cast("double") * F.col("size_b") / TOKENS_PER_GPU_HOUR, 6).alias("gpu_hours"))


_doc("op_txt_20_basic_stats", f"SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, CAST(len({_WT}) AS BIGINT) AS n_words, CAST(length(t) - length(replace(t, chr(10), '')) + 1 AS BIGINT) AS n_lines, CAST(octet_length(encode(t)) AS BIGINT) AS n_bytes, sha256(t) AS sha FROM s",
     n_chars=lambda t: F.length(t), n_words=lambda t: F.size(X.words(t)), n_lines=lambda t: X.occurrences(t, "\n") + 1, n_bytes=lambda t: F.octet_length(t), sha=lambda t: F.sha2(t, 256))
_doc("op_txt_21_short_hash", "SELECT doc_id, sha256(t)[1:16] AS hash FROM s", hash=lambda t: F.substring(F.sha2(t, 256), 1, 16))


def _count_sql(pattern: str) -> str:
    return f"len(regexp_extract_all(t, '{pattern}'))"


def _ratio(pattern: str):
    return lambda t: X.share(F.regexp_count(t, F.lit(pattern)), F.length(t))


_doc("op_txt_22_text_features", f"SELECT doc_id, CAST({_count_sql('[.!?]+')} AS BIGINT) AS sentences, " + ", ".join(f"round(CASE WHEN length(t) > 0 THEN CAST({_count_sql(p)} AS DOUBLE) / length(t) ELSE 0.0 END, 6) AS {n}" for n, p in (("digits", "[0-9]"), ("upper", r"\p{Lu}"), ("space", r"[ \t\r\n\f\x0b]"), ("punct", r"[^\p{L}\p{N} \t\r\n\f\x0b]"))) + " FROM s",
     sentences=lambda t: F.regexp_count(t, F.lit("[.!?]+")), digits=_ratio("[0-9]"), upper=_ratio(r"\p{Lu}"), space=_ratio(r"[ \t\r\n\f\x0b]"), punct=_ratio(r"[^\p{L}\p{N} \t\r\n\f\x0b]"))
_doc("op_txt_23_entropy_bits", f"SELECT doc_id, round({_entropy('t')}, 6) AS bits FROM s", bits=X.char_entropy)
_SCORE_E = "CASE WHEN e < 2 THEN e / 2 * 0.5 WHEN e > 6 THEN 1 - least((e - 6) / 2, 0.5) ELSE 0.5 + 0.5 * (e - 2) / 4 END"
_doc("op_txt_24_entropy_score", f"SELECT doc_id, round({_SCORE_E}, 6) AS score FROM (SELECT doc_id, {_entropy('t')} AS e FROM s)", score=lambda t: Q.entropy_score(X.char_entropy(t)))
_CATEGORIES = {"lower": r"[^\p{Ll}]", "upper": r"[^\p{Lu}]", "digit": "[^0-9]", "space": r"[^ \t\r\n]"}
_doc("op_txt_25_category_entropy", "SELECT doc_id, " + ", ".join(f"round({_entropy('c_' + n)}, 6) AS {n}" for n in _CATEGORIES) + " FROM (SELECT doc_id, " + ", ".join(f"regexp_replace(t, '{p}', '', 'g') AS c_{n}" for n, p in _CATEGORIES.items()) + " FROM s)", **{n: (lambda p: lambda t: X.char_entropy(F.regexp_replace(t, p + "+", "")))(p) for n, p in _CATEGORIES.items()})  # whole runs at once

_REPEAT_SQL = f"""(SELECT doc_id, t, {_WT} AS w, list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ln,
  list_transform(range(1, length(t)), lambda i: t[i:i + 1]) AS pairs, (SELECT max(c) FROM (SELECT count(*) AS c FROM (SELECT unnest(string_split(t, '')) AS ch) WHERE ch <> '' GROUP BY ch)) AS top FROM s)"""
_REPEAT = f"CASE WHEN length(t) >= 10 THEN greatest(CAST(top AS DOUBLE) / length(t), CASE WHEN len(ln) > 1 THEN {_repeated('ln')} ELSE 0.0 END, {_repeated('pairs')}, {_repeated(_ngrams('w', 3))}, {_repeated(_ngrams('w', 4))}) ELSE 0.0 END"
_doc("op_txt_26_repetition", f"SELECT doc_id, round({_REPEAT}, 6) AS repetition FROM {_REPEAT_SQL}", repetition=Q.repetition)


def longest_repeats(t: str, least: int = 10, most: int = 10) -> list[str]:
    """The longest substrings of `least` to half the text's characters that occur twice or more (overlaps count); equal lengths in order of first occurrence.

    Windows of 1, 2, 4... characters get numbers, equal ones the same, from the pair of their halves; a window that
    occurs once (-1) lies in no repeat. Two overlapping windows of 2^k number a window of any length up to 2^(k+1).
    """
    half = len(t) // 2
    if half < least:
        return []
    code = np.unique(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)[1].astype(np.int64)
    levels: list[tuple[np.ndarray, int]] = [(code, int(code.max()) + 1)]  # numbers by start, their bound

    def windows(length: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Starts of windows that may repeat, their keys, the keys' bound."""
        k = length.bit_length() - 1
        while k >= len(levels):
            size = 1 << len(levels)
            at, key, bound = windows_of(len(levels) - 1, size)
            if bound >= 1 << 31 or size >= 8:  # small keys stay as they are, cheaper than numbering them
                _, key, n = np.unique(key, return_inverse=True, return_counts=True)
                key = np.where(n > 1, np.cumsum(n > 1) - 1, -1)[key]
                bound = max(1, int((n > 1).sum()))
            numbers = np.full(len(t) - size + 1, -1, np.int64)
            numbers[at] = key
            levels.append((numbers, bound))
        return windows_of(k, length)

    def windows_of(k: int, length: int) -> tuple[np.ndarray, np.ndarray, int]:
        numbers, bound = levels[k]
        left, right = numbers[: len(t) - length + 1], numbers[length - (1 << k) :]
        at = np.flatnonzero((left >= 0) & (right >= 0))
        return at, left[at] * bound + right[at], bound * bound

    def repeats(length: int) -> bool:
        key = np.sort(windows(length)[1])
        return bool((key[1:] == key[:-1]).any())

    if not repeats(least):
        return []
    low, high = least, least + 1
    while high <= half and repeats(high):  # a repeat of n characters holds repeats of fewer
        low, high = high, 2 * high
    high = min(high, half + 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if repeats(middle) else (low, middle)
    out: list[str] = []
    for length in range(low, least - 1, -1):
        at, key, _ = windows(length)
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        out += [t[i : i + length] for i in np.sort(at[first[n > 1]])[: most - len(out)].tolist()]
        if len(out) >= most:
            break
    return out


def repeated_sequences(text: Column, least: int = 10, most: int = 10) -> Column:
    """Repeated substrings of `least` characters or more, longest first."""
    @F.pandas_udf("array<string>")
    def found(values: pd.Series) -> pd.Series:
        return values.map(lambda t: longest_repeats(t, least, most))

    return found(text)


_doc("op_txt_27_repeated_sequences", None, sequences=lambda t: F.array_join(F.transform(repeated_sequences(t), lambda x: F.length(x).cast("string")), ","))


def mean_char_repetition(text: Column) -> Column:
    """Mean of the repeated shares of single characters, pairs, triples and fours."""
    names = ("chars", "chars2", "chars3", "chars4")
    k, n = counts(text, *names), F.length(text)
    return sum((repeated(k[c], n - i) for i, c in enumerate(names)), F.lit(0.0)) / len(names)


_doc("op_txt_28_mean_char_repetition", "SELECT doc_id, round((" + " + ".join(_repeated(f"g{n}") for n in range(1, 5)) + ") / 4, 6) AS score FROM (SELECT doc_id, " + ", ".join(f"list_transform(range(1, length(t) - {n} + 2), lambda i: t[i:i + {n} - 1]) AS g{n}" for n in range(1, 5)) + " FROM s)", score=mean_char_repetition)
_NOVEL = "CASE WHEN len(wl) > 0 THEN least(2 * CAST(len(list_distinct(wl)) AS DOUBLE) / len(wl), 1.0) ELSE 0.0 END"
_doc("op_txt_29_novelty", f"SELECT doc_id, round({_NOVEL}, 6) AS novelty FROM (SELECT doc_id, {_WL} AS wl FROM s)", novelty=Q.novelty)


@query("op_txt_29_corpus_novelty", f"{_BASE}, w AS (SELECT DISTINCT doc_id, unnest({_WL}) AS w FROM s), f AS (SELECT b.item_id AS i, unnest({_W.format('lower(coalesce(b.text, chr(32)))')}) AS w FROM benchmark b), c AS (SELECT w, count(*) AS n FROM f GROUP BY 1) SELECT doc_id, round(CAST(count(*) FILTER (coalesce(n, 0) < 2) AS DOUBLE) / count(*), 6) AS novelty FROM w LEFT JOIN c USING (w) GROUP BY 1")
def txt_29(spark, sf_dir):
    """Share of a text's distinct words that a reference corpus (here benchmark) holds less than twice."""
    known = table(spark, sf_dir, "benchmark").select(F.explode(X.words(F.lower("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).where("n >= 2")
    own = samples(spark, sf_dir).select("doc_id", F.explode(F.array_distinct(X.words(F.lower("t")))).alias("w"))
    seen = own.join(known, "w", "left").groupBy("doc_id").agg(F.count_if(F.col("n").isNull()).alias("new"), F.count("*").alias("all"))
    return _out(seen.select("doc_id", X.share(F.col("new"), F.col("all")).alias("novelty")))


@query("op_txt_30_pairwise_novelty", f"{_BASE}, p AS (SELECT doc_id, list_distinct({_WL}) AS w, lag(list_distinct({_WL})) OVER (PARTITION BY source ORDER BY doc_id) AS v FROM s) SELECT doc_id, round(CASE WHEN len(w) > 0 THEN CAST(len(list_filter(w, lambda x: NOT list_contains(v, x))) AS DOUBLE) / len(w) ELSE 0.0 END, 6) AS novelty FROM p WHERE v IS NOT NULL")
def txt_30(spark, sf_dir):
    """Words of a text that the text before it in its source lacks."""
    rows = samples(spark, sf_dir).select("doc_id", "source", F.array_distinct(X.words(F.lower("t"))).alias("w"))
    pairs = rows.withColumn("v", F.lag("w").over(Window.partitionBy("source").orderBy("doc_id"))).where("v IS NOT NULL")
    return _out(pairs.select("doc_id", X.share(F.size(F.array_except("w", "v")), F.size("w")).alias("novelty")))


_GIB = f"(letters >= 10 AND (vowels < 0.15 OR vowels > 0.6 OR (n > 50 AND e < 2)))"
_FLAG_SQL = rf"""(SELECT doc_id, length(t) AS n, {_count_sql('[A-Za-z]')} AS letters, CASE WHEN {_count_sql('[A-Za-z]')} > 0 THEN CAST({_count_sql('[aeiouAEIOU]')} AS DOUBLE) / {_count_sql('[A-Za-z]')} ELSE 0.0 END AS vowels, {_entropy('t')} AS e,
  contains(t, chr(65533)) OR (length(t) > 0 AND CAST({_count_sql(r'[\x00-\x08\x0b\x0c\x0e-\x1f]')} AS DOUBLE) / greatest(length(t), 1) > 0.1) AS enc, CASE WHEN length(t) > 0 THEN CAST({_count_sql(r'[^\p{L}\p{N}\s]')} AS DOUBLE) / length(t) ELSE 0.0 END AS punct FROM s)"""
_FLAGS = f"list_filter([CASE WHEN n < 10 THEN 'too_short' END, CASE WHEN n > 1000000 THEN 'too_long' END, CASE WHEN {_GIB} THEN 'gibberish' END, CASE WHEN enc THEN 'encoding_issues' END, CASE WHEN punct > 0.3 THEN 'excessive_punctuation' END], lambda x: x IS NOT NULL)"
_doc("op_txt_31_anomaly_flags", f"SELECT doc_id, array_to_string({_FLAGS}, ',') AS flags FROM {_FLAG_SQL}", flags=Q.anomaly_flags)
_doc("op_txt_32_gibberish", f"SELECT doc_id, {_GIB} AS gibberish FROM {_FLAG_SQL}", gibberish=Q.gibberish)
_doc("op_txt_33_encoding", f"SELECT doc_id, enc AS broken FROM {_FLAG_SQL}", broken=Q.broken_encoding)
_doc("op_txt_34_punctuation", f"SELECT doc_id, punct > 0.3 AS excessive, round(punct, 6) AS share FROM {_FLAG_SQL}", excessive=lambda t: Q.punctuation_share(t) > 0.3, share=Q.punctuation_share)
_UNSAFE_SQL = {n: f"least(1.0, len(regexp_extract_all(t, '(?i){'|'.join(p)}')) * CAST({w} AS DOUBLE))" for n, (p, w) in L.UNSAFE.items()}
_doc("op_txt_35_unsafe_prompts", "SELECT doc_id, round(greatest(" + ", ".join(_UNSAFE_SQL.values()) + "), 6) AS risk, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {x} > 0.3 THEN '{n}' END" for n, x in _UNSAFE_SQL.items()) + "], lambda x: x IS NOT NULL), ',') AS categories FROM s", risk=lambda t: Q.unsafe(t)[0], categories=lambda t: Q.unsafe(t)[1])

_RECORD_SQL = f"""{_BASE}, a AS (SELECT doc_id, {_SCORE_E.replace('e ', 'e ')} AS entropy_score, {_FLAGS} AS flags FROM {_FLAG_SQL}),
b AS (SELECT doc_id, {_REPEAT} AS repetition FROM {_REPEAT_SQL}), c AS (SELECT doc_id, lang, source, {_NOVEL} AS gain, greatest({', '.join(_UNSAFE_SQL.values())}) AS risk FROM (SELECT *, {_WL} AS wl FROM s)),
r AS (SELECT *, greatest(0.0, 0.25 * entropy_score + 0.25 * (1 - repetition) + 0.3 * gain + 0.2 * (1 - risk) - least(0.1 * len(flags), 0.5)) AS quality FROM a JOIN b USING (doc_id) JOIN c USING (doc_id))"""


def record_metrics(rows: DataFrame, *more: Column) -> DataFrame:
    """entropy_score, repetition, gain, risk, flags and quality of each sample, and more Columns over t and its counts k, which are made on Arrow batches: no shuffle."""
    t = F.col("t")
    once = rows.select("doc_id", "lang", "source", "t", counts(t, *Q.REPETITION, *Q.ANOMALY, once=True).alias("k"), counts(F.lower(t), "words", "words1", *L.UNSAFE, once=True).alias("lowered"))
    k = F.col("k")
    parts = once.select("doc_id", "lang", "source", Q.entropy_score(k["bits"]).alias("entropy_score"), Q.repetition(t, k).alias("repetition"), Q.novelty(t, F.col("lowered")).alias("gain"), Q.unsafe(t, F.col("lowered"))[0].alias("risk"), Q.anomaly_flags(t, k=k).alias("flags"), *more)
    return parts.withColumn("quality", Q.overall(F.col("entropy_score"), F.col("repetition"), F.col("gain"), F.col("risk"), F.col("flags")))


def _record(op: str, sql: str, build) -> None:
    @query(op, f"{_RECORD_SQL} {sql}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _out(build(record_metrics(samples(spark, sf_dir))))


_record("op_txt_36_overall_quality", "SELECT doc_id, round(quality, 6) AS quality FROM r", lambda r: r.select("doc_id", "quality"))
_record("op_flt_05_acceptable", "SELECT doc_id FROM r WHERE quality >= 0.4 AND len(flags) = 0 AND risk < 0.5", lambda r: r.where((F.col("quality") >= 0.4) & (F.size("flags") == 0) & (F.col("risk") < 0.5)).select("doc_id"))
_record("op_flt_06_high_quality", "SELECT doc_id FROM r WHERE quality >= 0.6", lambda r: r.where("quality >= 0.6").select("doc_id"))
_record("op_flt_08_high_risk_subsets", "SELECT count(*) FILTER (quality < 0.3) AS low_quality, count(*) FILTER (repetition > 0.8) AS repeated, count(*) FILTER (entropy_score < 0.2) AS flat, count(*) FILTER (quality < 0.3 AND repetition > 0.7 AND entropy_score < 0.3) AS all_three FROM r",
        lambda r: r.agg(*(F.count_if(F.expr(c)).alias(n) for n, c in {"low_quality": "quality < 0.3", "repeated": "repetition > 0.8", "flat": "entropy_score < 0.2", "all_three": "quality < 0.3 AND repetition > 0.7 AND entropy_score < 0.3"}.items())))
_EDGES = (0.0, 0.2, 0.4, 0.6, 0.8)
_record("op_agg_19_fixed_histograms", " UNION ALL ".join(f"SELECT '{c}' AS score, CAST(least(floor({c} / 0.2 + 1e-9), 4) AS BIGINT) AS bin, count(*) AS n FROM r GROUP BY 2" for c in ("quality", "repetition", "risk")),
        lambda r: r.select(F.explode(F.array(*(F.struct(F.lit(c).alias("score"), F.col(c).alias("v")) for c in ("quality", "repetition", "risk")))).alias("x")).groupBy("x.score", F.least(F.floor(F.col("x.v") / 0.2 + 1e-9), F.lit(4)).alias("bin")).agg(F.count("*").alias("n")))
_record("op_agg_20_quality_percentiles", "SELECT " + ", ".join(f"round(quantile_cont(quality, {p / 100}), 6) AS p{p}" for p in (1, 5, 25, 50, 75, 95, 99)) + ", round(min(quality), 6) AS low, round(max(quality), 6) AS high, round(avg(quality), 6) AS mean, round(stddev_samp(quality), 6) AS sd FROM r",
        lambda r: r.agg(*(F.percentile("quality", p / 100).alias(f"p{p}") for p in (1, 5, 25, 50, 75, 95, 99)), F.min("quality").alias("low"), F.max("quality").alias("high"), F.avg("quality").alias("mean"), F.stddev_samp("quality").alias("sd")))
_record("op_agg_21_quality_by_source", "SELECT source, round(avg(quality), 6) AS mean, round(median(quality), 6) AS median, round(stddev_samp(quality), 6) AS sd, count(*) AS n, round(avg(repetition), 6) AS avg_repetition, round(avg(entropy_score), 6) AS avg_entropy FROM r GROUP BY 1",
        lambda r: r.groupBy("source").agg(F.avg("quality").alias("mean"), F.median("quality").alias("median"), F.stddev_samp("quality").alias("sd"), F.count("*").alias("n"), F.avg("repetition").alias("avg_repetition"), F.avg("entropy_score").alias("avg_entropy")))
_record("op_agg_22_correlations", "SELECT round(corr(quality, repetition), 6) AS with_repetition, round(corr(quality, entropy_score), 6) AS with_entropy, round(corr(quality, risk), 6) AS with_risk FROM r", lambda r: r.agg(F.corr("quality", "repetition").alias("with_repetition"), F.corr("quality", "entropy_score").alias("with_entropy"), F.corr("quality", "risk").alias("with_risk")))
_record("op_agg_23_high_risk_groups", "SELECT source, lang, count(*) AS n FROM r WHERE risk > 0.75 GROUP BY 1, 2", lambda r: r.where("risk > 0.75").groupBy("source", "lang").agg(F.count("*").alias("n")))
_record("op_agg_25_anomaly_types", "SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM r) GROUP BY 1", lambda r: r.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n")))


def _quality(op: str, sql: str, build) -> None:
    @query(op, f"{_QUALITY_SQL} {sql}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _out(build(message_quality(samples(spark, sf_dir))))


_quality("op_agg_15_quality_bands", "SELECT round(avg(quality), 6) AS mean, round(median(quality), 6) AS median, round(avg(CAST(quality >= 0.7 AS INT)), 6) AS high, round(avg(CAST(quality >= 0.4 AND quality < 0.7 AS INT)), 6) AS mid, round(avg(CAST(quality < 0.4 AS INT)), 6) AS low FROM q",
         lambda q: q.agg(F.avg("quality").alias("mean"), F.median("quality").alias("median"), *(F.avg(F.expr(f"CAST({c} AS INT)")).alias(n) for n, c in {"high": "quality >= 0.7", "mid": "quality >= 0.4 AND quality < 0.7", "low": "quality < 0.4"}.items())))
_quality("op_agg_16_quality_risk", "SELECT count(*) AS total, count(*) FILTER (quality < 0.4) AS low_quality, count(*) FILTER (repetition > 0.6) AS repeated, count(*) FILTER (entropy < 0.3) AS flat FROM q", lambda q: q.agg(F.count("*").alias("total"), F.count_if(F.col("quality") < 0.4).alias("low_quality"), F.count_if(F.col("repetition") > 0.6).alias("repeated"), F.count_if(F.col("entropy") < 0.3).alias("flat")))


@query("op_agg_17_pii_report", f"{_BASE}, p AS (SELECT {_PII_SQL} AS p, least(1.0, {_hits('lower(t)', L.RISK_WORDS)} / CAST(3 AS DOUBLE)) AS risk FROM s) SELECT 'type:' || k AS item, count(*) AS n FROM (SELECT unnest(p) AS k FROM p) GROUP BY 1 UNION ALL SELECT CASE WHEN risk > 0.7 THEN 'risk:high' WHEN risk > 0.3 THEN 'risk:medium' ELSE 'risk:low' END, count(*) FROM p GROUP BY 1 UNION ALL SELECT 'present', count(*) FILTER (len(p) > 0) FROM p")
def agg_17(spark, sf_dir):
    rows = samples(spark, sf_dir).select(Q.pii_types(F.col("t")).alias("p"), Q.keyword_risk(F.col("t")).alias("risk"))
    band = F.when(F.col("risk") > 0.7, "risk:high").when(F.col("risk") > 0.3, "risk:medium").otherwise("risk:low")
    items = F.concat(F.transform("p", lambda x: F.concat(F.lit("type:"), x)), F.array(band), F.when(F.size("p") > 0, F.array(F.lit("present"))).otherwise(F.array().cast("array<string>")))
    return rows.select(F.explode(items).alias("item")).groupBy("item").agg(F.count("*").alias("n"))


# ---- tokens

_TWO = f"(SELECT doc_id, source, t, {_TOK} AS a, len({_WT}) AS b FROM s)"


def two_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).select("doc_id", "source", "t", K.char_tokens(F.col("t")).alias("a"), K.word_tokens(F.col("t")).alias("b"))


@query("op_agg_12_token_statistics", f"{_BASE} SELECT CAST(sum(a) AS BIGINT) AS total, round(avg(a), 6) AS mean, round(median(a), 6) AS median, round(quantile_cont(a, 0.9), 6) AS p90, round(quantile_cont(a, 0.95), 6) AS p95, round(quantile_cont(a, 0.99), 6) AS p99, CAST(max(a) AS BIGINT) AS most, (SELECT doc_id FROM {_TWO} ORDER BY a DESC, doc_id LIMIT 1) AS longest FROM {_TWO}")
def agg_12(spark, sf_dir):
    rows = two_tokenizers(spark, sf_dir)
    return _out(rows.agg(F.sum("a").alias("total"), F.avg("a").alias("mean"), F.median("a").alias("median"), *(F.percentile("a", p / 100).alias(f"p{p}") for p in (90, 95, 99)), F.max("a").alias("most"), F.min_by("doc_id", F.struct(-F.col("a"), F.col("doc_id"))).alias("longest")))


@query("op_agg_13_context_rates", f"{_BASE} SELECT " + ", ".join(f"round(avg(CAST(a <= {w} AS INT)), 6) AS fit_{n}, round(avg(greatest(0, a - {w})), 6) AS cut_{n}" for n, w in L.WINDOWS.items()) + f" FROM {_TWO}")
def agg_13(spark, sf_dir):
    fits = K.context_fit(F.col("a"))
    return _out(two_tokenizers(spark, sf_dir).agg(*(F.avg(c.cast("int") if n.startswith("fit") else c).alias(n) for n, c in fits.items())))


@query("op_agg_14_tokenizer_drift", f"{_BASE} SELECT round(avg(abs(a - b)), 6) AS mean_diff, CAST(max(abs(a - b)) AS BIGINT) AS max_diff, round(avg(CAST(a <> b AS INT)), 6) AS diff_rate FROM {_TWO}")
def agg_14(spark, sf_dir):
    return _out(two_tokenizers(spark, sf_dir).agg(F.avg(F.abs(F.col("a") - F.col("b"))).alias("mean_diff"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"), F.avg((F.col("a") != F.col("b")).cast("int")).alias("diff_rate")))


@query("op_agg_24_tokenizer_comparison", f"{_BASE} SELECT name, CAST(sum(v) AS BIGINT) AS total, round(avg(v), 6) AS mean, count(*) AS n, round(CAST(sum(v) AS DOUBLE) / sum(length(t)), 6) AS per_char FROM (SELECT 'char' AS name, a AS v, t FROM {_TWO} UNION ALL SELECT 'whitespace', b, t FROM {_TWO}) GROUP BY 1")
def agg_24(spark, sf_dir):
    rows = two_tokenizers(spark, sf_dir).select(F.length("t").alias("c"), F.explode(F.array(F.struct(F.lit("char").alias("name"), F.col("a").alias("v")), F.struct(F.lit("whitespace").alias("name"), F.col("b").alias("v")))).alias("x"))
    return _out(rows.groupBy("x.name").agg(F.sum("x.v").alias("total"), F.avg("x.v").alias("mean"), F.count("*").alias("n"), (F.sum("x.v") / F.sum("c").cast("double")).alias("per_char")))


@query("op_agg_31_benchmark_rates", f"{_BASE} SELECT source, count(*) AS texts, CAST(sum(length(t)) AS BIGINT) AS chars, CAST(sum(a) AS BIGINT) AS tokens, round(CAST(sum(length(t)) AS DOUBLE) / sum(a), 6) AS chars_per_token FROM {_TWO} GROUP BY 1")
def agg_31(spark, sf_dir):
    return _out(two_tokenizers(spark, sf_dir).groupBy("source").agg(F.count("*").alias("texts"), F.sum(F.length("t")).alias("chars"), F.sum("a").alias("tokens"), (F.sum(F.length("t")) / F.sum("a").cast("double")).alias("chars_per_token")))


@query("op_agg_33_reconciliation", f"{_BASE} SELECT CAST(sum({_TOK}) AS BIGINT) AS validated, CAST(sum(length(t)) // 4 AS BIGINT) AS whole_file, round(CAST(sum(length(t)) // 4 AS DOUBLE) / sum({_TOK}), 6) AS ratio FROM s")
def agg_33(spark, sf_dir):
    sums = samples(spark, sf_dir).agg(F.sum(K.char_tokens(F.col("t"))).alias("validated"), F.floor(F.sum(F.length("t")) / 4).alias("whole_file"))
    return _out(sums.withColumn("ratio", F.col("whole_file") / F.col("validated").cast("double")))


_doc("op_tok_03_char_backend", "SELECT doc_id, CAST(length(t) AS BIGINT) AS n_ids, CAST(greatest(1, length(t) // 4) AS BIGINT) AS n_tokens FROM s", n_ids=lambda t: F.size(K.code_points(t)), n_tokens=K.char_tokens)
_doc("op_tok_04_whitespace", f"SELECT doc_id, CAST(len({_WT}) AS BIGINT) AS n_tokens FROM s", n_tokens=K.word_tokens)
_doc("op_tok_05_estimates", f"SELECT doc_id, CAST(trunc(length(t) / 4.0) AS BIGINT) AS char_ratio, CAST(trunc(len({_WT}) * CAST(1.3 AS DOUBLE)) AS BIGINT) AS words, CAST(trunc((CAST(length(t) AS DOUBLE) / 4 + len({_WT}) * CAST(1.3 AS DOUBLE)) / 2) AS BIGINT) AS hybrid FROM s", **{h: (lambda h: lambda t: K.estimated(t, h))(h) for h in ("char_ratio", "words", "hybrid")})
_IDS = "list_transform(list_filter(string_split(t, ''), lambda c: c <> ''), lambda c: unicode(c))"
_doc("op_tok_06_special_ids", f"SELECT doc_id, CAST(len(list_filter({_IDS}, lambda i: i < 100)) AS BIGINT) AS low, CAST(len(list_filter({_IDS}, lambda i: i >= 256)) AS BIGINT) AS unknown FROM s", low=lambda t: K.special_counts(K.code_points(t), 256)[0], unknown=lambda t: K.special_counts(K.code_points(t), 256)[1])
_doc("op_tok_07_context_checks", f"SELECT doc_id, {_TOK} > 4096 AS over_4k, {_TOK} > 8192 AS over_8k FROM s", over_4k=lambda t: K.char_tokens(t) > 4096, over_8k=lambda t: K.char_tokens(t) > 8192)
_doc("op_tok_08_truncation", "SELECT doc_id, sha256(t[1:512]) AS right_cut, sha256(CASE WHEN length(t) > 512 THEN t[-512:] ELSE t END) AS left_cut FROM s", right_cut=lambda t: F.sha2(F.array_join(F.transform(K.truncated(F.split(t, ""), 512), lambda c: c), ""), 256), left_cut=lambda t: F.sha2(F.array_join(K.truncated(F.filter(F.split(t, ""), lambda c: c != ""), 512, "left"), ""), 256))


@query("op_tok_01_bpe_counts")
def tok_01(spark, sf_dir):
    """Exact counts of the public 50k byte-pair vocabulary, each distinct text once."""
    import public_tokenizers as P

    rows = samples(spark, sf_dir).select("doc_id", "t")
    return K.with_token_counts(rows, "t", lambda t: K.bpe_tokens(t, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), "n_tokens").select("doc_id", "n_tokens")


# ---- normalisation

_doc("op_nrm_02_control", r"SELECT doc_id, sha256(regexp_replace(t, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]', '', 'g')) AS sha FROM s", sha=lambda t: F.sha2(N.without_control(t), 256))
_doc("op_nrm_03_zero_width", r"SELECT doc_id, sha256(regexp_replace(t, '[\x{200b}\x{200c}\x{200d}\x{feff}\x{2060}\x{ad}]', '', 'g')) AS sha FROM s", sha=lambda t: F.sha2(N.without_zero_width(t), 256))
_SPACE_SQL = r"regexp_replace(regexp_replace(replace(regexp_replace(t, '\r\n?', chr(10), 'g'), chr(9), '    '), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')"
_doc("op_nrm_04_whitespace", f"SELECT doc_id, sha256({_SPACE_SQL}) AS sha, CAST(length({_SPACE_SQL}) AS BIGINT) AS n FROM s", sha=lambda t: F.sha2(N.plain_space(t), 256), n=lambda t: F.length(N.plain_space(t)))
_doc("op_nrm_05_strip_collapse", r"SELECT doc_id, sha256(regexp_replace(regexp_replace(t, '^\s+|\s+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g')) AS sha FROM s", sha=lambda t: F.sha2(N.collapsed(X.stripped(t)), 256))
_doc("op_nrm_07_statistics", f"SELECT doc_id, CAST(length(t) AS BIGINT) AS before, CAST(length({_SPACE_SQL}) AS BIGINT) AS after, t <> {_SPACE_SQL} AS modified FROM s", before=lambda t: F.length(t), after=lambda t: F.length(N.plain_space(t)), modified=lambda t: t != N.plain_space(t))
_doc("op_nrm_08_encoding_issues", r"SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(t, chr(65533)) THEN 'replacement_chars' END, CASE WHEN starts_with(t, chr(65279)) THEN 'bom' END, CASE WHEN CAST(contains(t, chr(13) || chr(10)) AS INT) + CAST(contains(replace(t, chr(13) || chr(10), ''), chr(10)) AS INT) + CAST(contains(replace(t, chr(13) || chr(10), ''), chr(13)) AS INT) > 1 THEN 'mixed_line_endings' END, CASE WHEN regexp_matches(t, '[\x00-\x08\x0b\x0c\x0e-\x1f]') THEN 'control_chars' END], lambda x: x IS NOT NULL), ',') AS issues FROM s", issues=N.encoding_issues)
_doc("op_nrm_09_quotes", "SELECT doc_id, sha256(replace(replace(replace(replace(replace(replace(replace(t, chr(8216), ''''), chr(8217), ''''), chr(8220), '\"'), chr(8221), '\"'), chr(8211), '-'), chr(8212), '--'), chr(160), ' ')) AS sha FROM s", sha=lambda t: F.sha2(N.plain_quotes(t), 256))
_doc("op_nrm_01_unicode_forms", "SELECT doc_id, sha256(nfc_normalize(t)) AS nfc FROM s", nfc=lambda t: F.sha2(N.unicode_form(t, "NFC"), 256))
_doc("op_nrm_06_broken_lines", None, n_lines=lambda t: X.occurrences(N.broken_lines(t, 80), "\n") + 1)
_doc("op_nrm_10_char_categories", None, categories=N.char_categories)


# ---- tables as they are


@query("op_agg_27_nulls", "SELECT count(*) AS n, count(*) FILTER (text IS NULL) AS text, count(*) FILTER (lang IS NULL) AS lang, count(*) FILTER (source IS NULL) AS source FROM documents")
def agg_27(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in ("text", "lang", "source")))


@query("op_agg_28_ascii_language", r"SELECT CASE WHEN regexp_full_match(coalesce(text, ''), '[\x00-\x7F]*') THEN 'en' ELSE 'non_ascii' END AS language, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM documents GROUP BY 1")
def agg_28(spark, sf_dir):
    from .corpus import _with_share

    language = F.when(F.rlike(F.coalesce("text", F.lit("")), F.lit(r"^[\x00-\x7F]*\z")), "en").otherwise("non_ascii")
    return _out(_with_share(table(spark, sf_dir, "documents").groupBy(language.alias("language")).agg(F.count("*").alias("n"))))


@query("op_flt_10_banned_sources", "SELECT source, count(*) AS n FROM documents WHERE source NOT IN ('documentation', 'stackoverflow', 'web_crawl', 'github_code') GROUP BY 1")
def flt_10(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(~F.col("source").isin(L.BANNED_SOURCES)).groupBy("source").agg(F.count("*").alias("n"))


@query("op_flt_11_max_rows", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 25")
def flt_11(spark, sf_dir):
    """The feature is the limit: the first rows by id."""
    return table(spark, sf_dir, "documents").select("doc_id").orderBy("doc_id").limit(25)


@query("op_flt_13_detectable", "SELECT doc_id, length(coalesce(text, '')) >= 50 AS detectable FROM documents")
def flt_13(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", (F.length(F.coalesce("text", F.lit(""))) >= 50).alias("detectable"))


@query("op_txt_37_language", r"SELECT doc_id, CASE WHEN length(coalesce(text, '')) < 50 THEN 'unknown' WHEN regexp_full_match(text, '[\x00-\x7F]*') THEN 'en' ELSE 'non_ascii' END AS language FROM documents")
def txt_37(spark, sf_dir):
    """The portable rule stands in for a detector."""
    found = Q.detected_language(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", found["language"].alias("language"))


_STOP_SQL = ", ".join(f"len(list_filter(string_split(lower(text), ' '), lambda w: w IN ({', '.join(map(repr, words))})))" for words in Q.COMMON_WORDS.values())


@query("op_txt_37_detected_language", f"""WITH h AS (SELECT doc_id, text, [{_STOP_SQL}] AS h FROM documents)
SELECT doc_id, CASE WHEN length(coalesce(text, '')) < 50 OR list_max(h) = 0 THEN 'unknown' ELSE {_list(list(Q.COMMON_WORDS))}[list_position(h, list_max(h))] END AS language,
round(CASE WHEN length(coalesce(text, '')) < 50 OR list_max(h) = 0 THEN 0.0 ELSE CAST(list_max(h) AS DOUBLE) / list_sum(h) END, 6) AS confidence FROM h""")
def txt_37_detected(spark, sf_dir):
    """A detector plugged in: common words by language, the first of the most hits, its share as confidence."""
    found = Q.detected_language(F.col("text"), Q.by_common_words)
    return _out(table(spark, sf_dir, "documents").select("doc_id", found.alias("l")).select("doc_id", "l.*"))


@query("op_txt_38_token_entropy", f"{_BASE} SELECT doc_id, round((SELECT abs(coalesce(log2(sum(c)) - sum(c * log2(c)) / sum(c), 0.0)) FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM (SELECT unnest({_WT}) AS w) GROUP BY w)), 6) AS bits FROM s")
def txt_38(spark, sf_dir):
    """Entropy of whitespace tokens in bits."""
    counts = X.let(X.run_lengths(X.words(F.col("t"))), lambda c: X.entropy_bits(c, F.aggregate(c, F.lit(0), lambda a, x: a + x)))
    return _out(samples(spark, sf_dir).select("doc_id", F.abs(counts).alias("bits")))


@query("op_win_08_length_outliers", f"""{_BASE}, o AS (SELECT doc_id, length(t) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM s), h AS (SELECT *, avg(n) OVER w AS m, stddev_samp(n) OVER w AS sd, list_sort(list(n) OVER w) AS l FROM o WHERE i <= 10000 WINDOW w AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, l[len(l) // 4 + 1] AS q1, l[3 * len(l) // 4 + 1] AS q3 FROM h) SELECT doc_id, i >= 10 AND (coalesce(sd > 0 AND abs(n - m) / sd > 3, false) OR n < q1 - 1.5 * (q3 - q1) OR n > q3 + 1.5 * (q3 - q1)) AS outlier FROM k""")
def win_08(spark, sf_dir):
    """Each length against the lengths before it (the last 5000 to 10000 of them)."""
    from ..operators.outliers import length_outliers

    return length_outliers(samples(spark, sf_dir).select("doc_id", F.length("t").alias("n")), "doc_id", "n")
