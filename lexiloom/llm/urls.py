r"""URL filter: association rules mined by FP-growth from labelled urls, matched by an inverted index.

A url becomes a set of tokens: `net`, `example.net`, `www.example.net` (all domains its host lies in),
`h:word` (words of the host), `d:segment` (words of the path, digits as `#`), `n:3` (depth of the path),
`q:key` (query keys) and `scheme:x`. The labels come from the given allow and block rules: every url
that a rule fits is a transaction of its tokens and its label.

Mining takes every token of every labelled url that stands in min_support of them. Tokens that stand
in exactly the same labelled urls are one (the first by name speaks for all). As in FP-growth each
token has a conditional base, the labelled urls with it and their more frequent tokens (ties by
name), as sets with counts; a task grows the token sets of one base. Rules `tokens => label` that
pass support and confidence, and that no shorter, at least as confident subset makes needless, form
the filter.

A set is grown only where a rule that is not needless may come of it, so urls that share many
tokens need no limit on the tokens of a url or of a rule: every token of such a rule keeps out some
url of another label that all its other tokens let in, so this holds for each part of the rule too,
and a set where it does not hold is left with all that grows from it. So is a set whose urls,
against those of other labels that hold all tokens it may still take, are no more sure than it is.
Both lose no rule. What remains grows with the rules there are to find, which can be exponentially
many. So a base that is not done after `patience` sets is grown anew for the urls to be judged: a set
is then left, too, where no rule can come of it that is the best for one of them, by the rules
found so far. That leaves out rules, but no url's best one.

Rules match by an inverted index: each rule is filed under its rarest token, so a url looks
up only its own tokens and tests the few rules filed there. Among the rules that match, the
most confident wins, then the one with more tokens, more support, and the first by name;
without one the verdict is the default.

Defined results: a null url, or one without `://`, has an empty host and path, no rule and
the default verdict; a very long url is read whole; repeated rows are judged one by one; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, written
from .html import host_of

# The given rules: verdict, host, path.
GIVEN = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Mining:
    min_support: float = 0.005
    min_confidence: float = 0.8
    #: None: all frequent tokens of a url go into the mining; a number: only so many, those that tell most of the label.
    max_items: int | None = None
    #: Sets of one base that are grown for all rules; beyond it only those that can give the best rule of a url to be judged.
    patience: int = 1000
    #: Most different urls to be judged (by their frequent tokens) that a base is grown for; with more it is grown for all rules.
    most_wanted: int = 100_000
    default: str = "allow"


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = GIVEN) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones lie outside, so the longest is asked first
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(begin)
        rule = F.when(fits, at + begin).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column) -> Column:
    """Distinct tokens of a url, sorted; none for a null url or one without `://`."""
    rest = F.regexp_extract(url, r"(?s)://([^#]*)", 1)
    before, query = F.substring_index(rest, "?", 1), F.regexp_extract(rest, r"(?s)\?(.*)", 1)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    words = F.flatten(F.transform(F.slice(labels, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda x: F.regexp_extract_all(x, F.lit(r"([\p{L}\p{N}]+)"), 1)))
    path = F.lower(F.regexp_extract(before, r"(?s)/(.*)", 1))
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    names = F.regexp_extract_all(F.regexp_replace(path, r"\d+", "#"), F.lit(r"([\p{L}\p{N}#]+)"), 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.lower(F.substring_index(x, "=", 1)))
    mark = lambda kind, values: F.transform(values, lambda x: F.concat(F.lit(kind), x))
    depth = F.when(F.contains(before, F.lit("/")), F.array(F.concat(F.lit("n:"), F.size(segments).cast("string")))).otherwise(F.array().cast("array<string>"))
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))))
    every = F.concat(F.filter(domains, lambda x: x != ""), mark("h:", words), mark("d:", names), mark("q:", keys), depth, scheme)
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(every))).otherwise(F.array().cast("array<string>"))


def tokenized(pages: DataFrame) -> DataFrame:
    """pages with host, path and tokens."""
    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return rows.withColumn("tokens", tokens(F.col("url"), F.col("host")))


@dataclass(frozen=True)
class Rule:
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: int


def pruned(found: list[Rule]) -> list[Rule]:
    """Rules that no subset with the same verdict and at least their confidence makes needless."""
    often = Counter(t for r in found for t in r.tokens)
    filed: dict[tuple[str, str], list[tuple[frozenset[str], float]]] = {}  # kept rules under their rarest token
    kept = []
    for r in sorted(found, key=lambda r: (len(r.tokens), r.tokens, r.verdict)):
        own = frozenset(r.tokens)
        if not any(sure >= r.confidence and body < own for t in r.tokens for body, sure in filed.get((t, r.verdict), ())):
            kept.append(r)
            filed.setdefault((min(r.tokens, key=lambda t: (often[t], t)), r.verdict), []).append((own, r.confidence))
    return kept


def gain(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Information gain about the label; counts: (tokens, labels) of transactions with the token, totals: of all."""
    def entropy(x: np.ndarray) -> np.ndarray:
        p = x / np.maximum(x.sum(-1, keepdims=True), 1)
        return -(p * np.log2(np.where(p > 0, p, 1))).sum(-1)

    n, rest = totals.sum(), totals - counts
    return entropy(totals) - (counts.sum(1) * entropy(counts) + rest.sum(1) * entropy(rest)) / n


def vocabulary(labelled: DataFrame, how: Mining) -> dict[str, tuple[int, int]]:
    """Ranks of each frequent token, by what it tells and by how often it is; of tokens that stand in the same urls only the first by name.

    A frequent token stands in min_support of the urls, so there are at most (mean tokens of a url) / min_support.
    """
    rows = labelled.withColumn("own", F.xxhash64(F.monotonically_increasing_id()))
    kinds = sorted(r.verdict for r in labelled.select("verdict").distinct().collect())  # allow, block
    totals = {r.verdict: r["count"] for r in labelled.groupBy("verdict").count().collect()}
    n = sum(totals.values())
    each = [F.count_if(F.col("verdict") == k).alias(f"c{i}") for i, k in enumerate(kinds)]
    found = rows.select("verdict", "own", F.explode("tokens").alias("token")).groupBy("token").agg(*each, F.bit_xor("own").alias("x"), F.bit_xor(F.xxhash64("own")).alias("y"))
    frequent = found.where(sum((F.col(f"c{i}") for i in range(len(kinds))), F.lit(0)) >= how.min_support * n)
    alike = frequent.groupBy("x", "y", *(f"c{i}" for i in range(len(kinds)))).agg(F.min("token").alias("token")).collect()
    if not alike:
        return {}
    counts = np.array([[r[f"c{i}"] for i in range(len(kinds))] for r in alike], float)
    told = gain(counts, np.array([totals[k] for k in kinds], float))
    rank = [{alike[i]["token"]: at for at, i in enumerate(sorted(range(len(alike)), key=lambda i: (-x[i], alike[i]["token"])))} for x in (np.round(told, 12), counts.sum(1))]
    return {t: (at, rank[1][t]) for t, at in rank[0].items()}


def most_telling(own: Iterable[str], rank: dict[str, tuple[int, int]], most: int | None) -> list[int]:
    """The frequent tokens, the most frequent first; of all of them, or of so many that tell most."""
    return sorted(often for _, often in sorted(rank[t] for t in own if t in rank)[:most])


def transactions(labelled: DataFrame, rank: dict[str, tuple[int, int]], how: Mining) -> DataFrame:
    """items: ranks of the frequent tokens of labelled urls, the most frequent first; verdict; n: how many urls are so."""
    spread = labelled.sparkSession.sparkContext.broadcast(rank)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = spread.value
        items = [most_telling(own, known, how.max_items) for own in batch.column("tokens").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.int32())), batch.column("verdict")], names=["items", "verdict"])

    return arrow_map(labelled.select("tokens", "verdict"), step, "items array<int>, verdict string", "verdict").groupBy("items", "verdict").agg(F.count("*").alias("n"))


def bases(marked: DataFrame) -> DataFrame:
    """The conditional base of each token: head, items (the more frequent tokens of urls with it), verdict, n."""
    each = marked.select(F.posexplode("items").alias("at", "head"), "items", "verdict", "n")
    return each.withColumn("items", F.slice("items", F.lit(1), F.col("at"))).groupBy("head", "items", "verdict").agg(F.sum("n").alias("n"))


class Unfinished(Exception):
    """A base has more sets than asked for."""


def grown(has: np.ndarray, weight: np.ndarray, need: float, least: float, wanted: np.ndarray | None = None, most: float = np.inf) -> Iterator[tuple[list[int], int, int, int]]:
    """(columns, label, urls with the columns and the label, urls with the columns) of the rules in one conditional base.

    has: (rows, columns) which token a row holds; weight: (rows, labels) how many urls it stands for. Gives every rule of
    the base's token, alone or with columns, that passes `need` and `least` and that no part with that token makes needless.
    wanted: (rows, columns) of urls to be judged; then only rules that may be the best of one of them. Unfinished after `most` sets.
    """
    def sums(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        return has[np.ix_(rows, columns)].T.astype(float) @ weight[rows]

    def holding(asked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """For each wanted url the rows' urls that hold all it has of the columns; in blocks of 4 million pairs."""
        lack, step = (~has[np.ix_(rows, columns)]).T.astype(np.float32), max(1, 4_000_000 // len(rows))
        blocks = (asked[i : i + step] for i in range(0, len(asked), step))
        return np.concatenate([(wanted[np.ix_(x, columns)].astype(np.float32) @ lack == 0) @ weight[rows] for x in blocks])

    counts = weight.sum(0)
    sure = counts / counts.sum()
    alone = np.flatnonzero((counts >= need) & (sure >= least))
    for v in alone:
        yield [], int(v), int(counts[v]), int(counts.sum())
    reach = np.full(0 if wanted is None else len(wanted), sure[alone].max(initial=0.0))  # the most confidence found for a wanted url
    # A set: its columns, the rows that hold it, for each column the rows that hold all others but not it, the columns it
    # may still take, its counts, the labels it may still tell, the most confidence of its parts, the wanted urls it is for.
    todo = [([], np.arange(len(has)), [], np.arange(has.shape[1]), counts, counts >= need, sure, np.arange(len(reach)))]
    looked = 0
    while todo:
        body, rows, near, columns, counts, open_, best, asked = todo.pop()
        if (looked := looked + 1) > most:
            raise Unfinished
        if wanted is not None:
            if not len(asked):
                continue
            last = holding(asked, rows, columns)
            bound = counts / np.maximum(counts + last.sum(1, keepdims=True) - last, 1)
            may = open_ & (bound >= np.maximum(reach[asked], least)[:, None]) & (bound > best)
            asked, open_ = asked[may.any(1)], may.any(0)
        with_ = sums(rows, columns)
        total = with_.sum(1, keepdims=True)
        out = (counts.sum() - counts) - (total - with_)  # urls of other labels that the column keeps out
        live = open_ & (with_ >= need) & (out > 0)
        for others in near:
            still = sums(others, columns)
            live &= still.sum(1, keepdims=True) - still > 0
        keep = live.any(1)
        columns, with_, total, live = columns[keep], with_[keep], total[keep], live[keep]
        share = with_ / total
        for i, c in enumerate(columns):
            for_ = asked if wanted is None else asked[wanted[asked, c]]
            for v in np.flatnonzero(live[i] & (share[i] >= least) & (share[i] > best)):
                if wanted is None or (reach[for_] <= share[i, v]).any():
                    reach[for_] = np.maximum(reach[for_], share[i, v])
                    yield [*body, int(c)], int(v), int(with_[i, v]), int(total[i, 0])
            held = has[rows, c]
            inside, further = rows[held], columns[:i]
            last = weight[inside[has[np.ix_(inside, further)].all(1)]].sum(0)  # urls that hold all it may still take
            bound = with_[i] / np.maximum(with_[i] + last.sum() - last, 1)
            top = np.maximum(best, share[i])
            if i and (alive := live[i] & (bound >= least) & (bound > top)).any():
                todo.append(([*body, int(c)], inside, [*(x[has[x, c]] for x in near), rows[~held]], further, with_[i], alive, top, for_))


def base_rules(base: pa.Table, kinds: list[str], need: float, least: float, judged: bool, most: float) -> pa.Table:
    """Rules of one token's conditional base; rows without a verdict are urls to be judged. No verdict: it was not finished."""
    items, head = base.column("items").combine_chunks(), base.column("head")[0].as_py()
    label = np.array([-1 if v is None else kinds.index(v) for v in base.column("verdict").to_pylist()])
    known = label >= 0
    weight = np.zeros((len(items), len(kinds)))
    weight[known, label[known]] = base.column("n").to_numpy()[known]
    tokens = items.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(items)), np.diff(items.offsets.to_numpy()))
    often = np.zeros((head, len(kinds)))
    np.add.at(often, tokens, weight[row])
    columns = np.flatnonzero((often >= need).any(1))  # only these pass with the head
    at = np.full(head + 1, -1)
    at[columns] = np.arange(len(columns))
    passes = at[tokens] >= 0
    has = np.zeros((len(items), len(columns)), bool)
    has[row[passes], at[tokens[passes]]] = True
    try:
        found = [([*(int(columns[c]) for c in body), head], kinds[v], n, of) for body, v, n, of in grown(has[known], weight[known], need, least, np.unique(has[~known], axis=0) if judged else None, most)]
    except Unfinished:
        found = [([head], None, 0, 0)]
    return pa.Table.from_pylist([dict(zip(("items", "verdict", "n", "of"), x, strict=True)) for x in found], pa.schema([("items", pa.list_(pa.int32())), ("verdict", pa.string()), ("n", pa.int64()), ("of", pa.int64())]))


def mine(labelled: DataFrame, how: Mining = Mining(), wanted: DataFrame | None = None) -> list[Rule]:
    """Rules from rows of tokens and verdict: all that pass and that no part makes needless.

    wanted: rows of tokens; then at least all rules that are the best of one of these rows.
    """
    labelled = written(labelled, "labelled-urls")
    if not (rank := vocabulary(labelled, how)):
        return []
    names = sorted(rank, key=lambda t: rank[t][1])
    kinds = sorted(r.verdict for r in labelled.select("verdict").distinct().collect())
    need, least = max(1, how.min_support * labelled.count()), how.min_confidence
    marked = written(transactions(labelled, rank, how), "transactions")

    def rules(base: DataFrame, judged: bool, most: float) -> list[Row]:
        return base.groupBy("head").applyInArrow(lambda x: base_rules(x, kinds, need, least, judged, most), "items array<int>, verdict string, n long, of long").collect()

    found = rules(bases(marked), False, np.inf if wanted is None else how.patience)
    if left := [r["items"][0] for r in found if r.verdict is None]:
        asked = written(transactions(wanted.withColumn("verdict", F.lit(None).cast("string")), rank, replace(how, max_items=None)), "wanted")
        judged = asked.count() <= how.most_wanted
        base = bases(marked.unionByName(asked) if judged else marked).where(F.col("head").isin(left))
        found = [r for r in found if r.verdict is not None] + rules(base, judged, np.inf)
    return pruned([Rule(tuple(sorted(names[i] for i in r["items"])), r.verdict, r.n / r["of"], r.n) for r in found])


class Index:
    """Rules filed under their rarest token."""

    def __init__(self, rules: list[Rule]):
        often: dict[str, int] = {}
        for r in rules:
            for t in r.tokens:
                often[t] = often.get(t, 0) + 1
        self._filed: dict[str, list[tuple[frozenset[str], Rule]]] = {}
        for r in rules:
            self._filed.setdefault(min(r.tokens, key=lambda t: (often[t], t)), []).append((frozenset(r.tokens), r))

    def best(self, tokens: list[str]) -> Rule | None:
        own = set(tokens)
        fits = [r for t in tokens for need, r in self._filed.get(t, ()) if need <= own]
        return min(fits, key=lambda r: (-r.confidence, -len(r.tokens), -r.support, r.tokens, r.verdict), default=None)


def judge(pages: DataFrame, how: Mining = Mining(), given: tuple[tuple[str, str, str], ...] = GIVEN) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (tokens of the mined rule that decided), confidence."""
    rows = tokenized(pages.select("page_id", "url"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), given)
    rows = rows.withColumn("rule", rule).withColumn("given", verdict)
    rules = mine(rows.where("given IS NOT NULL").select("tokens", F.col("given").alias("verdict")), how, rows.where("given IS NULL").select("tokens"))
    spread = pages.sparkSession.sparkContext.broadcast(rules)
    cache: list[Index] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.append(Index(spread.value))
        verdict, mined, sure = [], [], []
        for fixed, own in zip(batch.column("given").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
            r = None if fixed else cache[0].best(own)
            verdict.append(fixed or (r.verdict if r else how.default))
            mined.append(" ".join(r.tokens) if r else None)
            sure.append(r.confidence if r else None)
        own = [batch.column(c) for c in ("page_id", "host", "path", "rule")]
        return pa.RecordBatch.from_arrays([*own, pa.array(verdict), pa.array(mined, pa.string()), pa.array(sure, pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "mined", "confidence"])

    schema = T.StructType([*(rows.schema[c] for c in ("page_id", "host", "path", "rule")), T.StructField("verdict", T.StringType()), T.StructField("mined", T.StringType()), T.StructField("confidence", T.DoubleType())])
    return arrow_map(rows, step, schema, "url")
