"""Operators of lexiloom.llm against brute force, round trips and edge cases on small tables."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lexiloom.llm import chat, decontam, dom, html, langid, license, minhash, packing, quality, toxicity, urls, wrapper
from lexiloom.llm.queries import ORACLES, QUERIES

LONG = "alpha beta gamma delta " * 4000
EDGES = [None, "", "   \n\t", "x", "a b c", "the same words again and again here", "the same words again and again here", "é ñ ü", "<|im_start|>", LONG]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, spans string"


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, ["en", None][i % 2], ["a", "b", None][i % 3], None, 0.5, True, "x") for i, t in enumerate(EDGES)]
    rows += [(3, "x", None, None, 1, 0.1, False, "y"), (None, "a text of a row without id", "en", "a", 1, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---- op3


def test_chat_matches_sql_free_digest(spark):
    rows = [(1, 1, "user", "hi <|im_end|>"), (1, 0, "system", "be <\\|x"), (1, 2, "assistant", None), (2, 0, "assistant", "first"), (2, 1, "user", "a<\\\\|b"), (2, 1, "user", "a<\\\\|b"), (None, None, None, "lost"), (3, 0, "role\nwith\\line<|", "text")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        text = "".join(f"{role}\n{t}\n" for _, role, t in own)
        loss = "".join(t for _, role, t in own if role == "assistant")
        got = out[conv]
        assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == (len(own), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert out[1].valid and not out[2].valid and out[2].wrong_turn == 0
    assert chat.format_chats(df.limit(0)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="<|\\im_startend> a\n", max_size=20), min_size=1, max_size=5))
def test_chat_round_trip(spark, texts):
    df = spark.createDataFrame([(1, i, t[:3], t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    turns = chat.format_chats(df).select(chat.read_back(F.col("formatted")).alias("t")).first().t
    assert [(r.role, r.text) for r in turns] == [(t[:3], t) for t in texts]


# ---- op1


def test_toxicity_learns_and_bounds_scores(spark):
    docs = [(i, ("you are a blip and a " if i % 5 else "such a slur and a ") + f"word{i} more words {i % 7}") for i in range(600)]
    labels = [(i, int(i % 5 == 0)) for i in range(600)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash"))
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int").where("doc_id < 400"))
    out = toxicity.scored(d, model).select("doc_id", "score").toPandas()
    held = out[out.doc_id >= 400]
    assert ((held.score >= 0.7) == (held.doc_id % 5 == 0)).mean() > 0.97
    assert out.score.between(0, 1).all()
    assert len(model.index) < 4000


def test_toxicity_fit_against_brute_force():
    """FTRL-proximal with dictionaries, one coordinate at a time."""
    rng = np.random.default_rng(8)
    how = toxicity.Fit(bits=8, l1=0.3, epochs=3)
    own = [np.unique(rng.integers(0, 256, rng.integers(1, 30))).astype(np.int32) for _ in range(40)]  # too few held-out rows to calibrate
    y = (rng.random(40) < 0.3).astype(float)
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    bias, bias_n = np.log(share / (1 - share)), 0.0
    w_of = lambda i: 0.0 if abs(z[i]) <= how.l1 else -(z[i] - np.sign(z[i]) * how.l1) / ((how.beta + n[i] ** 0.5) / how.alpha + how.l2)
    for _ in range(how.epochs):
        for d in range(40):
            if d % 5 == 4:
                continue
            w = {i: w_of(i) for i in own[d].tolist()}
            g = 1 / (1 + np.exp(-(bias + sum(w.values())))) - y[d]
            for i, wi in w.items():
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / how.alpha * wi
                n[i] += g * g
            bias_n += g * g
            bias -= 0.05 * g / (1 + bias_n**0.5)
    model = toxicity.fit(own, y, how)
    want = {i: w_of(i) for i in z if w_of(i)}
    assert set(model.index.tolist()) == set(want) and abs(model.bias - bias) < 1e-9
    assert all(abs(want[i] - w) < 1e-6 for i, w in zip(model.index.tolist(), model.weight.tolist(), strict=True))


def test_toxicity_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"w{i} common words " + " ".join(f"x{i}_{j}" for j in range(20))) for i in range(60)] + [(3, "again")] + [(70, " ".join(f"y{j}" for j in range(2000)))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(71)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, toxicity.Fit(max_features=500))
    assert isinstance(model, toxicity.Model) and toxicity.train(docs, labels, toxicity.Fit(max_features=0)).bias == -30.0


def test_toxicity_edges(spark, edges, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(edges, none)
    assert toxicity.scored(edges, model).count() == len(EDGES) + 2
    assert toxicity.scored(empty, model).count() == 0


def test_toxicity_features_are_repeats_free_of_document_borders():
    from lexiloom.llm.common import WordHashes

    owner, coord = toxicity.features([b"a b c", b"", b"d"], WordHashes(), 20)
    assert collections.Counter(owner.tolist()) == {0: 3 + 2 + 1, 2: 1}


# ---- op2


def brute_components(docs, words=4, percent=80):
    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))
        sets[d] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def near_fixture(seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for group in range(12):
        base = list(rng.choice(vocabulary, 60))
        for _ in range(int(rng.integers(1, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, 60))] = str(rng.choice(vocabulary))
            docs.append((len(docs), " ".join(own)))
    return docs + [(900, None), (901, ""), (902, "A b"), (903, "a B"), (904, "a b c d"), (905, docs[0][1].upper())]


def test_near_duplicates_match_brute_force(spark):
    docs = near_fixture()
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


@pytest.mark.parametrize("large", [2, 1024])
def test_near_duplicates_later_rounds_in_blocks(spark, large):
    """A chain whose ends are no near-copies; tiny blocks make every unit of work cross."""
    words = [f"c{i}" for i in range(120)]
    docs = []
    for step in range(14):
        docs.append((step if step % 2 else 100 + step, " ".join(words)))
        words = words[2:] + [f"n{step}a", f"n{step}b"]
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), minhash.Near(block=3, large=large)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(docs)


def link_pairs(docs, words, percent):
    """All pairs at the threshold, by counting shared shingles."""
    sets, holders, shared = {}, collections.defaultdict(list), collections.Counter()
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))
        sets[d] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
        for x in sets[d]:
            for e in holders[x]:
                shared[e, d] += 1
            holders[x].append(d)
    return sets, {p: k / (len(sets[p[0]]) + len(sets[p[1]]) - k) for p, k in shared.items() if 100 * k >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - k)}


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_of_the_tables(spark, words):
    """Components of a whole table, and the recall of its links at 0.80 and 0.85."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in df.collect()]
    sets, links = link_pairs(docs, words, 80)
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, minhash.Near(words=words)).collect()}
    for at in (0.80, 0.85):
        own = [p for p, j in links.items() if j >= at]
        print(f"{words} words, J >= {at}: recall {sum(out[a] == out[b] for a, b in own) / len(own):.4f} of {len(own)} links")
    assert out == {d: root(d) for d in sets}




def test_near_duplicates_edges(spark, edges, empty):
    out = minhash.near_duplicates(edges).collect()
    assert len(out) == len(EDGES) + 2
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[0].n_shingles == 0 and by[0].kept and by[6].component_id == 5 and not by[6].kept
    lost = next(r for r in out if r.doc_id is None)
    assert lost.kept and lost.component_id is None
    assert minhash.near_duplicates(empty).count() == 0


def test_odd_sketch_estimates():
    rng = np.random.default_rng(0)
    how = minhash.Near()
    for share in (0.75, 0.85, 0.95):
        n = 400
        common = rng.integers(0, 1 << 63, int(2 * n * share / (1 + share)), dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, n - len(common), dtype=np.uint64)]) for _ in range(2))
        s = minhash.odd_sketch(np.concatenate([a, b]), np.array([0, n]), how)
        assert abs(minhash.estimate(np.bitwise_count(s[0] ^ s[1]).sum(), how) - share) < 0.06


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (3, 4), (7, 4), (20, 21), (21, 22), (23, 22), (20, 23)]
    got = {r.node: r.comp for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 7: 1, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20, 23: 20}


# ---- op4


def test_license_scan(spark, edges, empty):
    docs = [(1, "Released under the MIT License. Under the mit-license"), (2, "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nx"), (3, "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0"), (4, "underthe mit license"), (5, None)]
    out = {r.doc_id: r for r in license.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert (out[1].n_base, out[1].first_word, out[1].last_word, out[1].base_labels) == (2, 1, 5, "mit")
    assert out[2].labels == "apache-2.0,gpl-2.0-only-with-classpath-exception-2.0,mit" and out[2].expressions == "mit apache-2.0 or gpl-2.0-only classpath-exception-2.0 with and"
    assert out[3].base_labels == "apache-2,cc-by-nc"
    assert out[4].n_base == 0 and out[5].n_words == 0 and out[5].first_word is None
    assert license.scan_licenses(edges).count() == len(EDGES) + 2 and license.scan_licenses(empty).count() == 0


def test_license_expressions():
    assert license.to_rpn("MIT or (Apache-2.0 and BSD-3-Clause) and GPL-2.0+ with Classpath-exception-2.0") == (["mit", "apache-2.0", "bsd-3-clause", "and", "gpl-2.0+", "classpath-exception-2.0", "with", "and", "or"], True)
    assert license.to_rpn("MIT AND") == (["mit"], False) and not license.to_rpn("")[1]
    assert license.to_rpn("MIT and some more prose follows") == (["mit"], True) and license.to_rpn("MIT AND some") == (["mit"], False)
    assert license.to_rpn("prose MIT") == ([], False) and license.to_rpn("LicenseRef-Own-1 */") == (["licenseref-own-1"], True)
    rpn = license.to_rpn("(MIT or ISC) and Zlib")[0]
    assert license.evaluate(rpn, {"mit", "zlib"}) and not license.evaluate(rpn, {"mit", "isc"})


def test_license_long_expression_and_prose(spark):
    names = sorted(x for x in license.KNOWN if not x.startswith("cc"))[:60]
    docs = [(1, "// SPDX-License-Identifier: " + " OR ".join(names) + "\nMIT"), (2, "spdx license identifier is a tag. MIT"), (3, "# SPDX-License-Identifier: MIT and some more prose follows"), (4, "SPDX-License-Identifier: GPL-3.0-only\nthen SPDX-License-Identifier: ISC")]
    out = {r.doc_id: r for r in license.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[1].labels.split(",") == names and out[1].allowed and len(out[1].expressions) > 400
    assert (out[2].labels, out[2].allowed) == ("", None) and (out[3].labels, out[3].allowed) == ("mit", True)
    assert out[4].labels == "gpl-3.0-only,isc" and out[4].allowed is False


def test_license_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license.scan_licenses(docs).collect()}
    for d, t in docs.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
        hits = [(i, label) for phrase, label in license.BASE_PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in hits]
        assert got[d] == (len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))


# ---- op5


def brute_tokens(url):
    if url is None or "://" not in url:
        return set()
    scheme, _, rest = url.partition("://")
    before, _, query = rest.partition("#")[0].partition("?")
    host, slash, path = before.partition("/")
    labels = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host).split(".") if x]
    segments = [x for x in path.lower().split("/") if x]
    out = {"scheme:" + scheme.lower()} | {".".join(labels[i:]) for i in range(len(labels))}
    out |= {"h:" + w for x in labels[:-1] for w in re.findall(r"[^\W_]+", x)} | {"q:" + p.split("=")[0].lower() for p in query.split("&") if p}
    out |= {"d:" + w for x in segments for w in re.findall(r"(?:[^\W_]|#)+", re.sub(r"\d+", "#", x))}
    return out | ({f"n:{len(segments)}"} if slash else set())


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute_given(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.GIVEN if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_rules(labelled, how):
    """Support, confidence and pruning by counting every subset."""
    import itertools

    n, where = len(labelled), collections.defaultdict(set)
    for i, (own, _) in enumerate(labelled):
        for t in own:
            where[t].add(i)
    frequent = {t: frozenset(s) for t, s in where.items() if len(s) >= how.min_support * n}
    first = {s: min(t for t in frequent if frequent[t] == s) for s in frequent.values()}
    kinds = sorted({v for _, v in labelled})
    totals = np.array([sum(v == k for _, v in labelled) for k in kinds], float)
    names = sorted(first.values())
    told = urls.gain(np.array([[sum(labelled[i][1] == k for i in frequent[t]) for k in kinds] for t in names], float), totals)
    rank = {t: (-round(float(g), 12), t) for t, g in zip(names, told, strict=True)}
    counts = collections.Counter()
    for own, v in labelled:
        kept = sorted((t for t in own if t in rank), key=rank.get)[: how.max_items]
        for size in range(1, len(kept) + 1):
            for body in itertools.combinations(sorted(kept), size):
                counts[body, None] += 1
                counts[body, v] += 1
    need = how.min_support * n
    rules = {(b, v): (c / counts[b, None], c) for (b, v), c in counts.items() if v and c >= need and c / counts[b, None] >= how.min_confidence}
    subsets = lambda b: (s for k in range(1, len(b)) for s in itertools.combinations(b, k))
    return {(b, v): x for (b, v), x in rules.items() if all(rules.get((s, v), (0,))[0] < x[0] for s in subsets(b))}


def test_url_filter(spark):
    given_urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x#y", "http://b.org/", "http://x.com/fr/2", "http://x.com/de/2", "nothing", None, "http://y.net/de/3", "http://y.net/fr/9", "ftp://z.com?x=://q", "http://c.org", "http://x.net/" + "a/" * 20_000]
    rows = [(i, u) for i, u in enumerate(given_urls)] + [(100 + i, f"http://h{i}.com/de/{i}") for i in range(40)] + [(200 + i, f"http://h{i}.com/fr/{i}") for i in range(40)]
    rows += rows[:3]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    out = {r.page_id: r for r in got}
    assert [out[i].rule for i in range(5)] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/"]
    assert out[10].rule is None  # an empty path begins with no `/`
    assert out[1].host == "example.org" and out[1].path == "/en/12" and out[1].verdict == "block"
    assert (out[5].host, out[5].path, out[6].host) == ("", "", "") and out[9].host == "z.com" and out[9].path == ""
    assert out[7].verdict == "block" and out[7].rule is None and "d:de" in out[7].mined and out[8].verdict == "allow"
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_filter_against_brute_force(spark, sf):
    """Host, path, tokens, given rules, mined rules and verdicts of every page by plain Python."""
    how = urls.Mining()
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    pages = pages.union(spark.createDataFrame([(-i, u) for i, u in enumerate([None, "x", "http://", "HTTP://A.B.Example.ORG:80/en/1_2-x/%20?a=1&&B=2&a#f?z", "s://é.Ü.com//fr//12a3", "a://b://c/d"], 1)], "page_id long, url string"))
    rows = {r.page_id: r.url for r in pages.collect()}
    own = {i: brute_tokens(u) for i, u in rows.items()}
    got = {r.page_id: r.tokens for r in urls.tokenized(pages).collect()}
    assert {i: set(t) for i, t in got.items()} == own and all(t == sorted(set(t), key=lambda x: x.encode()) for t in got.values())
    at = {i: brute_host_path(u) for i, u in rows.items()}
    given = {i: brute_given(*at[i]) for i in rows}
    rules = brute_rules([(own[i], given[i][1]) for i in rows if given[i][1]], how)
    mined = urls.mine(urls.tokenized(pages).withColumn("verdict", urls.given_rule(F.col("host"), F.col("path"))[1]).where("verdict IS NOT NULL").select("tokens", "verdict"), how)
    assert {(r.tokens, r.verdict): (r.confidence, r.support) for r in mined} == rules
    best = lambda i: min(((-c, -len(b), -n, b, v) for (b, v), (c, n) in rules.items() if set(b) <= own[i]), default=(how.default,))[-1]
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert out == {i: (*at[i], given[i][0], given[i][1] or best(i)) for i in rows}


def test_url_mining_bears_shared_keys(spark):
    """200 urls that share 30 query keys, and 200 that lack one of 30 each."""
    import time

    shared = "&".join(f"k{i}=1" for i in range(30))
    rows = [(i, f"http://a{i}.{['org', 'com'][i % 2]}/{['es', 'de'][i % 2]}/{i}?{shared}") for i in range(200)]
    rows += [(200 + i, f"http://b{i}.{['org', 'com'][i % 2]}/{['es', 'de'][i % 2]}/{i}?" + "&".join(f"m{j}=1" for j in range(30) if j != i % 30)) for i in range(200)]
    began = time.time()
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(out) == 400 and time.time() - began < 60


def test_url_mining_takes_all_tokens(spark):
    """Of two keys neither tells a label, both together do; eight others of each url tell more than either."""
    noise = lambda *without: "".join(f"&a{j}=1" for j in range(10) if j not in without)
    rows = [(i, f"http://x.com/de/?{['x=1&y=1', 'z=1'][i % 2]}{noise(i % 10)}") for i in range(40)]
    rows += [(100 + i, f"http://x.org/a/?{['x=1', 'y=1'][i % 2]}{noise(i % 10, (3 * i + 1) % 10)}") for i in range(40)]
    pages = spark.createDataFrame([*rows, (200, "http://n.net/?x=1&y=1"), (201, "http://n.net/?x=1"), (202, "http://n.net/?y=1")], "page_id long, url string")
    marked = urls.tokenized(pages).withColumn("verdict", urls.given_rule(F.col("host"), F.col("path"))[1]).where("verdict IS NOT NULL")
    how = urls.Mining(min_support=0.05, max_items=None)
    labelled = [(brute_tokens(u), "block" if i < 100 else "allow") for i, u in rows]
    got = {(r.tokens, r.verdict): (r.confidence, r.support) for r in urls.mine(marked.select("tokens", "verdict"), how)}
    assert got == brute_rules(labelled, how) and got[("q:x", "q:y"), "block"] == (1.0, 20)
    assert max(len(body) for body, _ in got) > 2
    out = {r.page_id: (r.verdict, r.mined) for r in urls.judge(pages).where("page_id >= 200").collect()}
    assert out == {200: ("block", "q:x q:y"), 201: ("allow", None), 202: ("allow", None)}


def test_url_rules_against_brute_force_on_random_sets():
    """Every set of up to nine tokens, grown in the base of each token."""
    rng, names, kinds = np.random.default_rng(5), "abcdefghi", ("allow", "block")
    for turn in range(40):
        size, need, least = int(rng.integers(5, 90)), int(rng.integers(1, 5)), float(rng.choice([0.3, 0.6, 0.8]))
        has = rng.random((size, 9)) < 0.3 + 0.6 * rng.random()
        label = np.where(rng.random(size) < 0.15, rng.integers(0, 2, size), has[:, :3].sum(1) > turn % 3)
        found = []
        for head in range(9):
            rows = has[:, head]
            if rows.any():
                for body, v, n, of in urls.grown(has[rows][:, :head], np.eye(2)[label[rows].astype(int)], need, least):
                    found.append(urls.Rule(tuple(names[c] for c in sorted([*body, head])), kinds[v], n / of, n))
        counts = collections.Counter()
        for own, v in zip(has, label, strict=True):
            held = [t for t, x in zip(names, own, strict=True) if x]
            for k in range(1, len(held) + 1):
                for body in itertools.combinations(held, k):
                    counts[body, None] += 1
                    counts[body, kinds[int(v)]] += 1
        rules = {(b, v): (c / counts[b, None], c) for (b, v), c in counts.items() if v and c >= need and c / counts[b, None] >= least}
        whole = {(b, v): x for (b, v), x in rules.items() if all(rules.get((s, v), (0,))[0] < x[0] for k in range(1, len(b)) for s in itertools.combinations(b, k))}
        assert {(r.tokens, r.verdict): (r.confidence, r.support) for r in urls.pruned(found)} == whole


def test_url_rules_for_wanted_urls_hold_the_best_of_each():
    """Rules grown for given token sets decide them as all rules do."""
    rng, kinds, decided = np.random.default_rng(6), ("allow", "block"), 0
    for turn in range(40):
        size, need, least = int(rng.integers(5, 90)), int(rng.integers(1, 5)), float(rng.choice([0.3, 0.6, 0.8]))
        has, wanted = (rng.random((n, 9)) < 0.3 + 0.6 * rng.random() for n in (size, int(rng.integers(0, 30))))
        label = np.where(rng.random(size) < 0.15, rng.integers(0, 2, size), has[:, :3].sum(1) > turn % 3).astype(int)
        index = []
        for some in (False, True):
            found = []
            for head in np.flatnonzero(has.any(0)):
                rows, own = has[:, head], wanted[wanted[:, head]][:, :head]
                for body, v, n, of in urls.grown(has[rows][:, :head], np.eye(2)[label[rows]], need, least, own if some else None):
                    found.append(urls.Rule(tuple("abcdefghi"[c] for c in sorted([*body, head])), kinds[v], n / of, n))
            index.append(urls.Index(urls.pruned(found)))
        for own in wanted:
            own = [t for t, x in zip("abcdefghi", own, strict=True) if x]
            assert index[0].best(own) == index[1].best(own)
            decided += index[0].best(own) is not None
    assert decided > 100


def test_url_verdicts_do_not_depend_on_patience(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    whole, *others = (sorted(map(tuple, urls.judge(pages, how).collect())) for how in (urls.Mining(), urls.Mining(patience=0), urls.Mining(patience=0, most_wanted=0)))
    assert len(whole) == 250 and any(r[5] for r in whole) and others == [whole, whole]


def test_url_mining_bears_exponentially_many_rules(spark):
    """200 blocked urls with all of 30 keys, 200 allowed ones that lack one: any 23 keys and more are a rule of their own."""
    import time

    keys = lambda *without: "&".join(f"m{j}=1" for j in range(30) if j not in without)
    rows = [(i, f"http://x.com/de/?{keys()}") for i in range(200)] + [(200 + i, f"http://x.org/de/?{keys(i % 30)}") for i in range(200)]
    asked = [(1000 + k, f"http://n.net/?{keys(*range(k))}") for k in range(30)]
    began = time.time()
    out = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows + asked, "page_id long, url string")).where("page_id >= 1000").collect()}
    assert time.time() - began < 60
    for k in range(30):
        allowed = sum(i % 30 < k for i in range(200))
        sure = 200 / (200 + allowed)
        assert (out[1000 + k].verdict, out[1000 + k].confidence) == (("block", sure) if sure >= 0.8 else ("allow", None))


def test_url_index_agrees_with_all_rules():
    rng = np.random.default_rng(1)
    rules = [urls.Rule(tuple(sorted(set(rng.choice(list("abcdef"), rng.integers(1, 4))))), str(rng.choice(["allow", "block"])), float(rng.random()), int(rng.integers(1, 9))) for _ in range(60)]
    index = urls.Index(rules)
    for _ in range(100):
        own = sorted(set(rng.choice(list("abcdefg"), rng.integers(0, 6))))
        fits = [r for r in rules if set(r.tokens) <= set(own)]
        best = min(fits, key=lambda r: (-r.confidence, -len(r.tokens), -r.support, r.tokens, r.verdict), default=None)
        assert index.best(own) == best


# ---- op6


def test_packing_plan_is_whole_and_fits():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 65, 500), rng.integers(30, 40, 200), np.array([64] * 5 + [1] * 3), np.zeros(0, int), np.full(100, 22)):
        counts = np.bincount(lengths, minlength=65)
        first = packing.best_fit(counts, 64)
        bins = packing.local_search(first, 64)
        got = collections.Counter()
        for content, n in bins:
            assert sum(content) <= 64
            for x in content:
                got[x] += n
        assert got == collections.Counter(lengths.tolist())
        assert sum(n for _, n in bins) <= sum(n for _, n in first)


def test_packing_search_empties_bins_and_settles():
    """Best-fit decreasing leaves a bin that the search empties; many small pieces of a bin are all offered."""
    for lengths, size, wanted in (([20, 18, 15, 14, 13, 11], 47, 2), ([15, 14, 8, 8, 7, 6, 3], 31, 2), ([13, 11, 10, 9, 7, 7, 5, 4], 22, 3)):
        first = packing.best_fit(np.bincount(lengths, minlength=size + 1), size)
        assert sum(n for _, n in first) == wanted + 1
        assert sum(n for _, n in packing.local_search(first, size)) == wanted
    # 60 pieces of 10 and one of 5 in a bin: only the last two can fill up the other bin.
    many = [((10,) * 60 + (5,), 1), ((1009,), 1)]
    assert sorted(sum(c) for c, n in packing.local_search(many, 1024)) == [590, 1024]
    lengths = np.random.default_rng(1).integers(200, 500, 4000)
    first = packing.best_fit(np.bincount(lengths, minlength=1025), 1024)
    last = packing.local_search(first, 1024)
    assert sum(n for _, n in last) < sum(n for _, n in first)
    left = [c for c, n in last if sum(c) < 1024 for _ in range(min(n, 2))]
    for i, a in enumerate(left):  # brute force: nothing betters any two bins
        for b in left[i + 1 :]:
            x, y = (a, b) if sum(a) >= sum(b) else (b, a)
            room = 1024 - sum(x)
            two = lambda c: {c[i] + c[j] for i in range(len(c)) for j in range(i)}
            gains = {p - o for p in y for o in {0, *x, *two(x)}} | {p - o for p in two(y) for o in x}
            assert not any(0 < g <= room for g in gains)


def test_packing_matches_the_tokenizer(spark, edges, empty):
    from tokenizers import Tokenizer

    how = packing.default_packing()
    out = packing.pack(packing.pieces(edges, how, with_ids=True), how)
    rows = out.collect()
    tok = Tokenizer.from_file(how.tokenizer)
    wanted = collections.Counter()
    for r in edges.collect():
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        for i, (a, n) in enumerate(packing.cuts(len(ids), 1024)):
            wanted[r.doc_id, i, a, n, zlib.crc32(ids[a : a + n].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack(packing.pieces(empty, how), how).count() == 0
    whole = packing.assemble(out).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in rows)


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "naïve café", "漢字 and Ω", "x" * 3000, " \r\n\t ", "I'm 12,345.6"])
def test_both_encoders_agree(text):
    how = packing.default_packing()
    assert packing.Encoder(how.tokenizer, how.ranks)(text) == packing.Encoder(how.tokenizer)(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=st.characters(max_codepoint=0x250), max_size=120), st.text(alphabet=" \t\n\r\x0b\x1c\x85\xa0'stvdlm09Aéß‘’–…<|endoftext|>", max_size=80)))
def test_both_encoders_agree_on_any_text(text):
    global _encoders
    try:
        fast, slow = _encoders
    except NameError:
        how = packing.default_packing()
        fast, slow = _encoders = packing.Encoder(how.tokenizer, how.ranks), packing.Encoder(how.tokenizer)
    assert fast(text) == slow(text)


def test_cuts():
    assert packing.cuts(5, 4) == [(0, 1), (1, 4)] and packing.cuts(8, 4) == [(0, 4), (4, 4)] and packing.cuts(1, 4) == [(0, 1)]


# ---- op7


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs.where("doc_id % 4 <> 2"))
    out = langid.predicted(docs, model).where("doc_id % 4 = 2").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.85 and out.score.between(0, 1).all()


def test_language_edges(spark, edges, empty):
    model = langid.fit(np.concatenate([langid.sampled(x, i, langid.Fit()) for i, x in enumerate([b"hello there", "él ñandú".encode()] * 5)]), ["en", "es"] * 5)
    out = langid.predicted(edges, model).collect()
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) for r in out)
    assert {r.lang_pred for r in langid.predicted(edges, None).collect()} == {"und"}
    assert langid.predicted(empty, model).count() == 0 and langid.train(empty) is None


def test_language_forward_pass_against_brute_force():
    """Filters, maxima, softmax and the mean over windows by plain loops."""
    rng = np.random.default_rng(2)
    how = langid.Fit(window=16, filters=3, widths=(2, 3))
    nf, classes = 6, ["a", "b"]
    tables = [[rng.normal(size=(256, 3)).astype(np.float32) for _ in range(w)] for w in how.widths]
    model = langid.Model(classes, 16, tables, rng.normal(size=nf).astype(np.float32), rng.normal(size=(nf, 2)).astype(np.float32), rng.normal(size=2).astype(np.float32))
    texts = [bytes(rng.integers(65, 91, n).astype(np.uint8)) for n in (1, 15, 16, 17, 40, 100)]
    names, score = langid.predict(texts, model)
    for text, name, p in zip(texts, names, score, strict=True):
        total, covered = np.zeros(2), 0
        for at in range(0, max(1, len(text) - 2), model.step):
            own = text[at : at + 16]
            x = own + bytes(16 - len(own))
            hidden = [max(0.0, max(sum(t[k][x[i + k]][f] for k in range(len(t))) for i in range(16 - len(t) + 1)) + model.bias[3 * j + f]) for j, t in enumerate(tables) for f in range(3)]
            z = np.array([sum(h * model.dense[i][c] for i, h in enumerate(hidden)) + model.dense_bias[c] for c in range(2)])
            total += len(own) * (z - np.log(np.exp(z).sum()))
            covered += len(own)
        mean = total / covered
        want = np.exp(mean) / np.exp(mean).sum()
        assert name == classes[want.argmax()] and abs(p - want.max()) < 1e-3


def test_language_sample_is_bounded(spark):
    rows = [(i % 50, ("the words of a long text " if i % 2 else "des mots et des phrases ") * 300, ["fr", "en"][i % 2]) for i in range(200)] + [(60, "123", "en"), (61, None, "en")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.Fit(max_rows=40, epochs=1))
    assert model.classes == ["en", "fr"]


def test_windows_cover_every_position():
    for n in (0, 1, 15, 16, 17, 29, 100):
        text = bytes(i % 250 + 1 for i in range(n))
        w = langid.windows_of(text, 16, 13)
        seen = {bytes(row[i : i + 4]) for row in w for i in range(13)}
        assert all(text[i : i + 4] in seen for i in range(n - 3))


# ---- op8


def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + k for i in range(len(w) - 2) if c[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab #\n\té|", max_size=40), max_size=6))
def test_quality_counts(texts):
    from lexiloom.llm.common import WordHashes

    got = quality.measure([t.encode() for t in texts], WordHashes())
    assert [tuple(int(got[c][i]) for c in quality.COUNTS) for i in range(len(texts))] == [brute_counts(t) for t in texts]


def test_quality_rejects_outliers(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 8)))
    rows = []
    for i in range(400):
        text = " ".join(word() for _ in range(120)) + "."
        rows.append((i, text if i % 10 else " ".join(w + "###" for w in text.split()), "en", "a" if i % 3 else None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    stats = quality.measured(df).cache()
    out = quality.judged(stats, *quality.fit(stats)).toPandas()
    assert (out.kept == (out.doc_id % 10 != 0)).all()
    few = quality.Rules(max_broadcast=0)  # the join without broadcast gives the same
    again = quality.judged(stats, *quality.fit(stats, few), few).toPandas()
    assert again.set_index("doc_id").kept.to_dict() == out.set_index("doc_id").kept.to_dict()


def brute_mcd(x, rules, tries=8):
    """Center, covariance and log-determinant of the best concentrated subset: the operator's starts and random ones, exact subsets."""
    floor, n = quality.FLOOR, len(x)
    rounded = np.round(x * rules.grid) / rules.grid
    q1, median, q3 = np.quantile(rounded, [0.25, 0.5, 0.75], axis=0)
    spread = np.maximum((q3 - q1) / 1.349, list(quality.FLOORS.values()))
    z = (x - median) / spread
    tri = lambda m: np.array(quality.triangle(m))
    first = [(median, c) for c in quality.starts(median, spread, tri(np.tanh(z).T @ np.tanh(z)), tri((z / ((z**2).sum(1) + 1e-12)[:, None]).T @ z))]
    rng = np.random.default_rng(0)
    for _ in range(tries):
        some = x[rng.choice(n, min(n, 20), replace=False)]
        first.append((some.mean(0), np.cov(some.T, bias=True)))
    best = []
    for center, cov in first:
        last = np.inf
        while True:
            d = x - center
            d2 = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov + floor), d)
            own = x[np.argsort(d2, kind="stable")[: max(1, int(round(rules.h * n)))]]
            new_center, new_cov = own.mean(0), np.cov(own.T, bias=True)
            logdet = np.linalg.slogdet(new_cov + floor)[1]
            if logdet >= last - 1e-9:
                break
            center, cov, last = new_center, new_cov, logdet
        best.append((last, center, cov))
    return min(best, key=lambda b: b[0])


def test_quality_verdicts_against_brute_force(spark):
    """Determinants as small as those of exact subsets from more starts, and the same verdicts but for rows at the cutoff."""
    rules = quality.Rules()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    stats = quality.measured(docs).cache()
    rows = quality.judged(stats, *quality.fit(stats)).toPandas()
    rows["lang"], rows["source"] = rows.lang.fillna("~"), rows.source.fillna("~")
    good = rows[~rows.base_failed]
    assert (good.n_words >= 50).all() and (~rows[rows.base_failed].kept).all()
    n0, n1 = good.groupby(["lang", "source"]).doc_id.count(), good.groupby("lang").doc_id.count()
    models, factor = {}, quality.consistency(rules.h)
    agree = 0
    for r in good.itertuples():
        key = (r.lang, r.source) if n0[r.lang, r.source] >= rules.min_rows else (r.lang,) if n1[r.lang] >= rules.min_rows else ()
        if key not in models:
            own = good[(good.lang == key[0]) & (good.source == key[1])] if len(key) == 2 else good[good.lang == key[0]] if key else good
            models[key] = brute_mcd(own[list(quality.NAMES)].to_numpy(), rules)
        _, center, cov = models[key]
        d = np.array([getattr(r, c) for c in quality.NAMES]) - center
        d2 = d @ np.linalg.inv(cov * factor + quality.FLOOR) @ d
        agree += (d2 <= rules.cutoff) == r.kept or abs(r.d2 / d2 - 1) < 0.1
    print(f"verdicts agree for {agree} of {len(good)} rows, {len(models)} groups, {(~good.kept).sum()} rejected")
    assert len(models) > 1 and agree >= 0.99 * len(good) and (~good.kept).any()


def test_quality_consistency_factor():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200_000, 6))
    d2 = (x**2).sum(1)
    for h in (0.5, 0.75, 0.9):
        near = x[d2 <= np.quantile(d2, h)]
        assert abs(near.var() * quality.consistency(h) - 1) < 0.02


def test_quality_edges(spark, edges, empty):
    for df in (edges, empty):
        stats = quality.measured(df)
        assert quality.judged(stats, *quality.fit(stats)).count() == df.count()


# ---- op9


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.lists(st.integers(3, 4), min_size=1, max_size=4), min_size=1, max_size=4))
def test_fm_index(text, phrases):
    index = decontam.FMIndex(np.array(text, np.int32), 5, 4)
    rows = np.zeros((len(phrases), 4), np.int64)
    for i, p in enumerate(phrases):
        rows[i, 4 - len(p) :] = p
    low, high = index.search(rows, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, low, high, strict=True):
        where = [i for i in range(len(text)) if text[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == where


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_suffix_array(text):
    text = [*text, -1]
    assert decontam.suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute_hits(docs, items, window=10):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = find.findall(ascii_lower(t))
        for a in range(max(1, len(w) - window + 1)) if w else ():
            windows[tuple(w[a : a + window])].update([] if i is None else [str(i)])
    out = {}
    for d, t in docs:
        w, hit, names = find.findall(ascii_lower(t)), set(), set()
        for p, who in windows.items():
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a : a + len(p)]) == p:
                    hit.update(range(a, a + len(p)))
                    names |= who
        out[d] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_words", [200_000, 20])
def test_decontamination(spark, block_words):
    rng = np.random.default_rng(4)
    items = [(i, " ".join(f"q{rng.integers(0, 30)}" for _ in range(n))) for i, n in enumerate([25, 12, 10, 3, 1])] + [(7, None), (8, ""), (3, "q1 Q2"), (None, "q3 q4 q5"), (9, "q3 q4 q5")]
    docs = []
    for d in range(60):
        w = [f"q{rng.integers(0, 30)}" if rng.random() < 0.5 else f"z{rng.integers(0, 99)}" for _ in range(rng.integers(0, 80))]
        if d % 3 == 0 and w:
            w[len(w) // 2 : len(w) // 2] = items[d % 4][1].upper().split()[: 8 + d % 9]
        docs.append((d, ", ".join(w)))
    docs += [(100, None), (101, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.report(decontam.find(df, bench, decontam.Search(block_words=block_words))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == brute_hits(docs, items)


def test_decontamination_edges(spark, edges, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not decontam.report(decontam.find(edges, none)).where("contaminated").count()
    assert decontam.find(empty, none).count() == 0
    long = "w " * 200_000 + "one two three"
    out = decontam.report(decontam.find(spark.createDataFrame([(1, long), (2, "two")], "doc_id long, text string"), spark.createDataFrame([(None, "one two three")], "item_id long, text string"))).collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in sorted(out)] == [(200_003, 3, 0, True), (1, 0, 0, False)]
    assert decontam.removed(b"one two, three four five.", [[1, 3]]) == b"one  four five."


# ---- op10


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li>Home<li>Menu {n}</ul></nav>
<div class="ad">buy {n}</div><article><h1>Title &eacute; {n}</h1><p>First <b>bold</b>text {n}<p>Second\n  line {n}</p><div class="share">share me</div><form>ask {n}</form></article><aside>side {n}</aside><div class="comments"><p>a reader {n}</p></div><footer>foot</footer></body></html>"""
BARE = """<html><body><div class="top">Site name here</div><div><p>Varying words of page {n} that tell one story or another {n}.</p><p>More {n} words.</p></div><p>Always the same closing words</p></body>"""


def test_html(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(n=i)) for i in range(8)] + [(100 + i, f"http://bare.example/{i}", BARE.format(n=i)) for i in range(8)]
    rows += [(200, None, PAGE.format(n=1)), (201, "http://x/", None), (202, "http://x/", ""), (203, "http://x/", "<article>cut <b>off &am"), (204, "http://x/", "plain < text")]
    out = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()}
    assert out[3].text == "Title é 3 First boldtext 3 Second line 3" and out[200].text == "Title é 1 First boldtext 1 Second line 1"
    assert out[102].text == "Varying words of page 2 that tell one story or another 2. More 2 words."
    assert out[102].n_template >= 2
    assert (out[201].text, out[202].text, out[203].text, out[204].text) == ("", "", "cut off &am", "plain < text")
    assert all(r.n_chars == len(r.text) for r in out.values())


def alone(page):
    parsed = dom.parse(page)
    return html.main_text(parsed, html.alone(parsed))


@pytest.mark.parametrize("page, text", [
    ("<body><div><p>intro</p><section>%s</section><p>outro</p></div>", "intro %s outro"),
    ("<body><div><p>before</p><ul><li>%s<li>two</ul><p>after</p></div>", "before %s two after"),
    ("<body><div>few <b>%s</b> words</div>", "few %s words"),
    ("<main><p>%s</p><article>teaser</article></main><article>apart</article>", "%s teaser apart"),
    ("<article>one</article><article>two %s</article>", "one two %s"),
    ("<article><div class='post-header'><h1>Title</h1></div><p>%s</p><section id='social-history'>On it</section></article>", "Title %s On it"),
    ("<article><header><h1>Title</h1></header>%s<div class='share-buttons'>x</div><ol class='comment-list'><li>x</ol></article>", "Title %s"),
    ("<body><div class='site-header'><h1>Site</h1></div><p data-id=ad aria-hidden=false>%s</p>", "%s"),
    ("<div>a<span class=ad>x<div>y</div></span>b<button>z</button></div>%s", "ab %s"),
])
def test_html_keeps_what_lies_beside_the_largest_part(page, text):
    long = "many words of the page " * 9 + "end"
    assert alone(page % long) == text % long


def test_html_parser_is_linear():
    import time

    for piece, tail in (("<b>", "</i>"), ('<a "x', ""), ("<a \"x'", ">"), ("<div>", "<li>x"), ("<center>", "<li></li>"), ("<p><b>", "<div></div>"), ("<span class=ad>", "</span>"), ("<", ""), ("<a", "")):
        took = []
        for n in (4000, 32000):
            began = time.process_time()
            dom.parse(piece * n + tail * n)
            took.append(time.process_time() - began)
        assert took[1] < 30 * took[0] + 0.5, piece


def brute_score(a, b):
    """Simple tree matching by its definition; trees are (label, children)."""
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_score(x, y))
    return best[-1][-1] + 1


TREES = st.recursive(st.builds(lambda x: (x, []), st.integers(0, 2)), lambda kids: st.tuples(st.integers(0, 2), st.lists(kids, max_size=5)), max_leaves=14)


def as_tree(t):
    label, up, todo = [], [], [(t, -1)]
    while todo:
        (x, kids), p = todo.pop()
        label.append(x)
        up.append(p)
        todo += [(k, len(label) - 1) for k in reversed(kids)]
    return wrapper.Tree(label, up)


@pytest.mark.parametrize("cells", [1 << 20, 1])
@settings(max_examples=150, deadline=None)
@given(TREES, TREES)
def test_tree_matching_is_whole(cells, a, b):
    """Slots pair as many nodes as the definition, also where lists are aligned by halves."""
    x, y, shapes = as_tree(a), as_tree(b), wrapper.Shapes()
    before, wrapper.TRACED_CELLS = wrapper.TRACED_CELLS, cells
    try:
        slots = wrapper.match(x, y, shapes, shapes.of(y.label, y.kids))
    finally:
        wrapper.TRACED_CELLS = before
    pairs = [(i, j) for i, j in enumerate(slots) if j >= 0]
    assert len(pairs) == brute_score(a, b) == len({j for _, j in pairs})
    assert all(x.label[i] == y.label[j] and (i == j == 0 or slots[x.up[i]] == y.up[j]) for i, j in pairs)


def test_tree_matching_of_wide_and_deep_pages():
    wide = ("r", [("p" if i % 3 else "q", []) for i in range(3000)])
    other = ("r", [("q" if i % 5 else "p", [("x", [])] if i % 7 == 0 else []) for i in range(2500)])
    deep = dom.parse("<div>" * 30_000)
    shapes, a, b = wrapper.Shapes(), as_tree(wide), as_tree(other)
    slots = wrapper.match(a, b, shapes, shapes.of(b.label, b.kids))
    assert sum(s >= 0 for s in slots) > 1000 and [s for s in slots if s >= 0] == sorted(s for s in slots if s >= 0)
    d = wrapper.tree(deep.depth, deep.label)
    assert wrapper.match(d, d, shapes, shapes.of(d.label, d.kids)) == list(range(30_001))


def expected_text(page):
    """The article of a page of the tables, by patterns alone."""
    import html as entities

    inner = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S)[1]
    inner = re.sub(r"</?(h1|p|br|li|ul|div|table|tr|td|th)[^>]*>", "\x01", inner)
    parts = entities.unescape(re.sub(r"<!--.*?-->|<[^>]*>", "", inner)).split("\x01")
    return " ".join(" ".join(x.split()) for x in parts if x.strip())


def test_html_of_the_tables_with_and_without_landmarks(spark):
    """The text of every page, and the same text where tags and labels that tell the content are stripped: the wrapper finds it."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = {r.page_id: expected_text(r.html) for r in pages.collect()}
    got = html.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == want
    bare = F.regexp_replace(F.regexp_replace("html", r"<(/?)(?:article|nav|footer)>", "<$1div>"), ' class="ad"', "")
    out = html.extract(pages.withColumn("html", bare).withColumn("host", F.lit("clash"))).withColumn("host", html.host_of(F.col("url"))).collect()
    size = collections.Counter(r.host for r in out)
    learnt = [r for r in out if size[r.host] >= 20]
    assert len(learnt) > 1500 and all(r.n_template >= 3 for r in learnt)
    right = sum(r.text == want[r.page_id] for r in learnt)
    print(f"without landmarks {right} of {len(learnt)} pages right")
    assert right >= 0.99 * len(learnt)


def test_html_ways_to_join_agree_and_edges(spark, sf):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(120)
    pages = pages.unionByName(pages.limit(10))  # repeated rows
    rows = lambda how: collections.Counter((r.page_id, r.text, r.n_template) for r in html.extract(pages, how).collect())
    assert rows(html.Wrapper()) == rows(html.Wrapper(max_broadcast_bytes=0)) == rows(html.Wrapper(max_broadcast_bytes=0, hot_share=1.0))
    assert html.extract(pages.limit(0)).count() == 0
    long = "<article>" + "<p>word &amp; more</p>" * 30_000 + "</article>"
    out = html.extract(spark.createDataFrame([(i, f"http://long.example/{i}", long) for i in range(6)], "page_id long, url string, html string")).collect()
    assert all(r.text == "word & more " * 29_999 + "word & more" for r in out)


def test_html_template_block_spares_blocks_in_it(spark):
    page = "<body><div>Posted in <b>news</b><p>story {n} of <i>the</i> day</p></div><p class=x>same</p>"
    rows = [(i, f"http://h.example/{i}", page.format(n=i)) for i in range(8)]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"story {i} of the day" for i in range(8)}


def test_html_template_judges_landmarks(spark):
    """A line that a host repeats in its articles goes; another text in its place stays, and so do articles that are alike."""
    page = "<article><h2>{top}</h2><p>story {n} of the day</p><p>and more {n}</p></article>"
    rows = [(i, f"http://h.example/{i}", page.format(n=i, top="Only here: a special" if i == 30 else "Read our magazine")) for i in range(60)]
    alike = "<article><h2>terms of use</h2><p>as ever and ever, the whole text of it</p><b>{n}</b></article>"
    rows += [(100 + i, f"http://same.example/{i}", alike.format(n=i)) for i in range(9)]
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[7] == "story 7 of the day and more 7" and out[30] == "Only here: a special story 30 of the day and more 30"
    assert out[104] == "terms of use as ever and ever, the whole text of it 4"


# ---- queries and pipeline


def test_queries_cover_whole_tables(spark, sf):
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11))
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op1_toxicity", "op4_license_scan", "op8_quality_rules"):
        assert QUERIES[name](spark, sf).count() == n
    assert set(ORACLES) <= set(QUERIES)


def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    one = P.written(P.quality_rules(spark, docs, sf), "t")
    kept = {r.doc_id for r in one.collect()}
    counts = {d: brute_counts(t) for d, t in text.items()}
    assert all(c[0] >= 50 and 100 * c[4] <= 50 * c[0] for d, c in counts.items() if d in kept)
    assert one.columns == docs.columns
    two = P.written(P.toxicity_filter(spark, one, sf), "t")
    three = P.written(P.near_dedup(spark, two, sf), "t")
    left = [(r.doc_id, r.text) for r in two.collect()]
    assert {r.doc_id for r in three.collect()} == {d for d, (_, c) in brute_components(left, words=5).items() if d == c}
    four = P.written(P.decontamination(spark, three, sf), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hits = brute_hits([(r.doc_id, r.text) for r in three.collect()], items)
    assert {r.doc_id for r in four.collect()} == {d for d, h in hits.items() if not h[4]}
    five = P.best_fit_packing(spark, four, sf)
    assert {r.doc_id for r in five.select("doc_id").distinct().collect()} == {r.doc_id for r in four.collect()}


def test_pipeline_leaves_only_its_result(spark, sf, tmp_path, monkeypatch):
    import corpus_pipeline as P
    from lexiloom.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    assert P.run(spark, sf).count() and len(list(tmp_path.iterdir())) == 1
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, empty, sf).count() == 0, name


def test_pipeline_stages_bear_odd_columns(spark, edges, sf):
    import corpus_pipeline as P

    for name, stage in P.STAGES[:4]:
        assert stage(spark, edges, sf).columns == edges.columns, name

