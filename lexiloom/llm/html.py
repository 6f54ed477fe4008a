r"""Main text of web pages by wrapper induction over pages of one host.

1. Every page is parsed once to a tree of blocks (see `dom`) and written with its text runs.
2. Each host with `min_pages` pages gets a pivot, the page of median size; its nodes are the
   slots of the host's wrapper. All its pages are matched with the pivot by simple tree matching
   (see `wrapper`). Pages are sorted by host and dealt by range, so that a host with a third
   of all pages lies on many tasks; each page is held against the page before it: slots where
   the two have equal text count as constant, others as varying.
3. The wrapper follows: the slot that holds most of the varying text is the main slot; slots beside it
   that hold prose or a fair part of the varying text are content too, all others are template.
   A landmark (article, main) around the main slot widens it to the landmark. In content, a
   block whose slot is constant loses the text that the host repeats there; blocks in it are
   judged by themselves. A page whose content would nearly all go by this keeps it whole.
4. Each page's nodes take the verdict of their slot, unmatched ones that of the block around
   them. A page without a wrapper, or without any of its content slots, is read by its landmarks or,
   without one, whole. Menus, headers, footers, sidebars, notices, adverts, forms, scripts,
   styles and comments are left out by tags and labels, also where their text varies.

Texts: character references decoded, white space inside a block made one space, blocks
trimmed and joined in page order by one space.

Defined results: null or empty html gives an empty text; a page without a url, or of a host of
fewer pages, has no wrapper; very long and very deep pages are read whole, in linear time for the
parser; repeated rows are read one by one; cut-off markup ends at the cut; other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, join_by_key, written
from .dom import DROP, LANDMARK, PROSE_TAG, Page, parents, parse
from .wrapper import CONTENT, OUTSIDE, PATH, Judge, Matcher, Tree, constant, tree, verdicts


@dataclass(frozen=True)
class Wrapper(Judge):
    #: Hosts of fewer pages get no wrapper.
    min_pages: int = 5
    #: A text is the host's own in a slot if it was equal in so many pairs, and in this share of them.
    text_share: float = 0.05
    #: Of a page's content, so much at least must stay beside repeated texts, or none of these goes.
    least_left: float = 0.1
    #: Pivots or wrappers of up to so many bytes together are broadcast; beyond it hosts are joined by shuffle,
    #: but for those with over `hot_share` of the pages (at most 1 / hot_share of them).
    max_broadcast_bytes: int = 32 << 20
    hot_share: float = 0.002


@dataclass
class Slots:
    """A host's wrapper as applied to a page."""

    verdict: np.ndarray
    fixed: dict[int, frozenset[int]]  # constant slots and the texts that the host repeats there
    main_chars: float
    by_landmark: bool


# ---- reading one page


def alone(page: Page) -> list[bool]:
    """Which runs are content of a page without a wrapper: those in landmarks, or all."""
    up = parents(page.depth.tolist())
    inside = [False] * len(up)
    flags = page.flags.tolist()
    for i, p in enumerate(up):
        inside[i] = not flags[i] & DROP and bool(flags[i] & LANDMARK or (p >= 0 and inside[p]))
    kept = [inside[i] for i in page.run_node.tolist()]
    return kept if any(kept) else [True] * len(kept)


def wrapped(page: Page, own: Tree, slots: list[int], w: Slots, how: Wrapper) -> list[bool] | None:
    """Which runs are content by the wrapper; None if the page has none of its content slots."""
    verdict = w.verdict.tolist()
    if not any(s >= 0 and verdict[s] == CONTENT for s in slots):
        return None
    flags, n = page.flags.tolist(), len(slots)
    chars, linked = page.own.astype(np.int64).tolist(), page.link.astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        if not flags[i] & DROP:
            chars[own.up[i]] += chars[i]
            linked[own.up[i]] += linked[i]
    state = [OUTSIDE] * n
    for i in range(n):
        around = state[own.up[i]] if i else PATH
        if flags[i] & DROP:
            continue
        if around == CONTENT or flags[i] & LANDMARK:
            state[i] = CONTENT
        elif slots[i] >= 0:
            state[i] = verdict[slots[i]] if around == PATH else OUTSIDE
        elif around == PATH and not w.by_landmark:
            enough = flags[i] & PROSE_TAG or chars[i] >= how.beside_share * w.main_chars
            state[i] = CONTENT if enough and linked[i] <= how.link_share * chars[i] else OUTSIDE
        elif around == PATH:
            state[i] = PATH
    text = page.text.tolist()
    kept, repeated = [], []
    for i in page.run_node.tolist():
        inside = state[i] == CONTENT or (state[i] == PATH and not w.by_landmark)
        own_text = inside and slots[i] in w.fixed and text[i] in w.fixed[slots[i]]
        kept.append(inside and not own_text)
        repeated.append(inside and own_text)
    size = lambda which: sum(len(r) for r, k in zip(page.runs, which, strict=True) if k)
    if any(repeated) and size(kept) < how.least_left * (size(kept) + size(repeated)):
        return [a or b for a, b in zip(kept, repeated, strict=True)]  # pages of a host that share their content
    return kept


def main_text(page: Page, kept: list[bool]) -> str:
    return " ".join(r for r, k in zip(page.runs, kept, strict=True) if k)


# ---- Spark


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


ARRAYS = {"depth": np.uint32, "label": np.uint32, "flags": np.uint8, "own": np.uint32, "link": np.uint32, "text_hash": np.uint32, "run_node": np.uint32}


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, spread, n (nodes), the arrays of the page as binaries, runs."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(len(ARRAYS) + 2)]
        for html in batch.column("html").to_pylist():
            page = parse(html or "")
            row = (len(page.depth), *(x.tobytes() for x in (page.depth, page.label, page.flags, page.own, page.link, page.text, page.run_node)), page.runs)
            for col, value in zip(cols, row, strict=True):
                col.append(value)
        kinds = [pa.int64(), *[pa.binary()] * len(ARRAYS), pa.list_(pa.string())]
        new = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host", "spread")), *new], names=["page_id", "url", "host", "spread", "n", *ARRAYS, "runs"])

    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.xxhash64("url", "html").alias("spread"), "html")
    more = [T.StructField("n", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in ARRAYS), T.StructField("runs", T.ArrayType(T.StringType()))]
    return arrow_map(rows, step, T.StructType([*(rows.schema[c] for c in ("page_id", "url", "host", "spread")), *more]), "html")


def pivots(blocks: DataFrame, how: Wrapper) -> DataFrame:
    """host, pages, and the arrays p_depth, p_label, p_flags of its pivot: of the pages nearest to the median size, that of the smallest hash."""
    sizes = blocks.where("host <> ''").select("host", "n", "spread")
    middle = sizes.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.percentile(F.least("n", F.lit(100_000)), 0.5).alias("median")).where(F.col("pages") >= how.min_pages)
    chosen = sizes.join(middle, "host").groupBy("host").agg(F.min(F.struct(F.abs(F.col("n") - F.col("median")), "spread")).alias("c"), F.first("pages").alias("pages"))
    chosen = chosen.select("host", "pages", F.col("c.spread").alias("spread"))
    arrays = blocks.select("host", "spread", "depth", "label", "flags").join(chosen, ["host", "spread"])
    return arrays.groupBy("host").agg(F.first("pages").alias("pages"), F.min(F.struct("depth", "label", "flags")).alias("p")).select("host", "pages", *(F.col(f"p.{c}").alias(f"p_{c}") for c in ("depth", "label", "flags")))


def by_host(rows: DataFrame, table: DataFrame, columns: list[str], how: Wrapper, kind: str) -> DataFrame:
    """rows joined with a written table of one row per host; the way depends on that table's bytes, never the result."""
    small = (table.agg(F.sum("bytes")).first()[0] or 0) <= how.max_broadcast_bytes
    return join_by_key(rows, table, "host", columns, "pages", small, kind, how.hot_share)


SLOT_SUMS = ("own", "link", "same", "pairs")


def evidence(blocks: DataFrame, pivot: DataFrame, how: Wrapper) -> DataFrame:
    """host, slot, text and sums: at text 0 those of the slot (SLOT_SUMS), else in `same` the pairs in which this text was equal."""
    spread = max(1, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bones = by_host(blocks.select("host", "spread", "depth", "label", "own", "link", "text_hash"), pivot, ["p_depth", "p_label"], how, "inner")
    dealt = bones.repartitionByRange(spread, "host", "spread").sortWithinPartitions("host", "spread")
    schema = "host string, slot long, text long, own long, link long, same long, pairs long"

    def run(batches):
        matcher, host, sums, texts, before = Matcher(), None, None, Counter(), None

        def told():
            rows = [(i, 0, *r) for i, r in enumerate(sums.T.tolist()) if any(r)] + [(s, t, 0, 0, k, 0) for (s, t), k in texts.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array([host] * len(rows), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names=["host", "slot", "text", *SLOT_SUMS])

        for batch in batches:
            names = ("host", "depth", "label", "own", "link", "text_hash", "p_depth", "p_label")
            for h, depth, label, own, link, text, p_depth, p_label in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if h != host or len(texts) > 50_000:
                    if host is not None:
                        yield told()
                    if h != host:
                        before = None
                    host, sums = h, np.zeros((4, len(p_depth) // 4), np.int64)
                    texts.clear()
                page = tree(np.frombuffer(depth, np.uint32), np.frombuffer(label, np.uint32))
                slots = matcher(h, p_depth, p_label, page)
                near = list(slots)  # the slot of a node or of the nearest matched block around it
                for i in range(1, len(near)):
                    if near[i] < 0:
                        near[i] = near[page.up[i]]
                at = np.array(near)
                if (at >= 0).all():
                    np.add.at(sums[0], at, np.frombuffer(own, np.uint32))
                    np.add.at(sums[1], at, np.frombuffer(link, np.uint32))
                words = np.frombuffer(text, np.uint32).tolist()
                now = {s: words[i] for i, s in enumerate(slots) if s >= 0}
                for s in now.keys() & before.keys() if before is not None else ():
                    if now[s] or before[s]:
                        sums[3, s] += 1
                        if now[s] == before[s]:
                            sums[2, s] += 1
                            texts[s, now[s]] += 1
                before = now
        if host is not None:
            yield told()

    found = dealt.mapInArrow(run, schema)
    return found.groupBy("host", "slot", "text").agg(*(F.sum(c).alias(c) for c in SLOT_SUMS))


def wrappers(blocks: DataFrame, how: Wrapper = Wrapper()) -> DataFrame:
    """host, pages, bytes, the pivot's arrays and, of each slot with evidence, its sums and repeated texts; a row is bounded by its pivot."""
    pivot = pivots(blocks, how)
    pivot = written(pivot.withColumn("bytes", F.octet_length("p_depth") + F.octet_length("p_label") + F.octet_length("p_flags")), "pivots")
    found = written(evidence(blocks, pivot, how), "evidence")
    slots = found.where("text = 0").select("host", "slot", *SLOT_SUMS)
    texts = found.where("text <> 0").join(slots.select("host", "slot", F.col("pairs").alias("of")), ["host", "slot"])
    texts = texts.where((F.col("same") >= how.min_pairs) & (F.col("same") >= how.text_share * F.col("of")) & (F.col("of") >= how.min_pairs))
    texts = texts.groupBy("host", "slot").agg(F.sort_array(F.collect_list("text")).alias("texts"))  # at most 1 / text_share of them
    rows = slots.join(texts, ["host", "slot"], "left").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", *SLOT_SUMS, "texts"))).alias("slots"))
    out = pivot.join(rows, "host").withColumn("bytes", F.col("bytes") + 60 * F.size("slots"))
    return written(out, "wrappers")


def applied(host: dict, how: Wrapper) -> tuple[Slots, int]:
    """(the wrapper of a row of `wrappers`; its template slots)."""
    pivot = tree(np.frombuffer(host["p_depth"], np.uint32), np.frombuffer(host["p_label"], np.uint32))
    sums = np.zeros((4, len(pivot.label)), np.int64)
    texts = {}
    for s in host["slots"]:
        sums[:, s["slot"]] = [s[c] for c in SLOT_SUMS]
        if s["texts"]:
            texts[s["slot"]] = frozenset(s["texts"])
    own, link, same, pairs = sums
    fixed = constant(same, pairs, how)
    flags = np.frombuffer(host["p_flags"], np.uint8)
    verdict, chars, by_landmark = verdicts(pivot, flags, host["pages"], fixed, own, link, how)
    n_template = int(((verdict != CONTENT) & (verdict != PATH) | fixed).sum())
    return Slots(verdict, {int(s): texts.get(int(s), frozenset()) for s in np.flatnonzero(fixed)}, chars, by_landmark), n_template


def extract(pages: DataFrame, how: Wrapper = Wrapper()) -> DataFrame:
    """page_id, url, text, n_chars, n_template (slots of the host's wrapper that are template; 0 without one)."""
    pages = pages.select("page_id", "url", "html")
    blocks = written(parsed(pages), "blocks")
    known = wrappers(blocks, how)
    joined = by_host(blocks.select("page_id", "url", "host", *ARRAYS, "runs"), known, ["pages", "p_depth", "p_label", "p_flags", "slots"], how, "left")
    schema = T.StructType([*(pages.schema[c] for c in ("page_id", "url")), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_template", T.LongType())])
    wrapper_columns = ("pages", "p_depth", "p_label", "p_flags", "slots")

    def run(batches):
        matcher = Matcher()
        kept: dict[str, tuple[Slots, int]] = {}
        for batch in batches:
            # Rows of one host stand together, so that the matcher changes its pivot once a host.
            batch = batch.take(pa.compute.sort_indices(batch.column("host")))
            texts, counts, last, row = [], [], None, None
            hosts = batch.column("host").to_pylist()
            arrays = {c: batch.column(c) for c in ARRAYS}
            for i, host in enumerate(hosts):
                a = {c: np.frombuffer(arrays[c][i].as_buffer(), kind) for c, kind in ARRAYS.items()}
                page = Page(a["depth"], a["label"], a["flags"], a["own"], a["link"], a["text_hash"], a["run_node"], batch.column("runs")[i].as_py())
                if host != last:
                    row = {c: batch.column(c)[i].as_py() for c in wrapper_columns} if batch.column("slots")[i].is_valid else None
                    last = host
                    if row is not None and host not in kept:
                        if len(kept) > 1000:
                            kept.clear()
                        kept[host] = applied(row, how)
                which, n = None, 0
                if row is not None and page.runs:
                    w, n = kept[host]
                    own = tree(page.depth, page.label)
                    which = wrapped(page, own, matcher(host, row["p_depth"], row["p_label"], own), w, how)
                elif row is not None:
                    n = kept[host][1]
                texts.append(main_text(page, alone(page) if which is None else which))
                counts.append(n)
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_template"])

    return joined.mapInArrow(run, schema)
