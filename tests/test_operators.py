"""Operators on hand-made rows: formulas, folds, sources, merge, streaming."""

import gzip
import hashlib
import json
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom import streaming
from lexiloom.functions import normalize as N
from lexiloom.functions import quality as Q
from lexiloom.functions import text as X
from lexiloom.functions import tokens as K
from lexiloom.operators import conversations as C
from lexiloom.operators import dedup as U
from lexiloom.operators import distill as D
from lexiloom.operators import merge as M
from lexiloom.operators import outliers as O
from lexiloom.operators import preference
from lexiloom.operators import schema as S
from lexiloom.operators import validate as V
from lexiloom.plans import catalog
from lexiloom.plans import samples as P
from lexiloom.sources import discover
from lexiloom.sources import exports as E
from lexiloom.sources import records as R


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} string" for k in inputs)
    return spark.createDataFrame([tuple(inputs.values())], schema).select(column.alias("v")).first().v


def one_conversation(spark, *turns):
    rows = [(1, i, role, text, float(i)) for i, (role, text) in enumerate(turns)]
    return C.conversation_metrics(C.clean_messages(spark.createDataFrame(rows, "conversation_id long, turn int, role string, text string, create_time double"))).first()


@pytest.mark.parametrize("text, tokens", [("a b c d e f g", 9), ("a b c d e f g h i j", 13)])
def test_heuristic_tokens(spark, text, tokens):
    assert one_conversation(spark, ("user", text), ("assistant", "x")).user_tokens == tokens


@pytest.mark.parametrize("text, bits", [("a a b", 0.918296), ("x x", 0.0), ("", 0.0)])
def test_word_entropy(spark, text, bits):
    assert value(spark, X.word_entropy(X.words(F.col("t"))), t=text) == pytest.approx(bits, abs=1e-6)


def test_char_entropy(spark):
    assert value(spark, X.char_entropy(F.col("t")), t="hello world") == pytest.approx(2.845351, abs=1e-6)
    assert value(spark, X.char_entropy_normal(F.col("t")), t="hello world") == pytest.approx(0.948450, abs=1e-6)
    assert value(spark, X.char_entropy_normal(F.col("t")), t="aaaa") == 0.0


@pytest.mark.parametrize("user, asst, gain", [("fix the parser bug", "the parser is fixed now", 0.714286), ("a b", "a b", 0.7), ("a", "b", 0.4)])
def test_information_gain(spark, user, asst, gain):
    assert one_conversation(spark, ("user", user), ("assistant", asst)).information_gain == pytest.approx(gain, abs=1e-6)


def test_gain_without_user_words(spark):
    assert one_conversation(spark, ("assistant", "b")).information_gain == 0.5


def test_repetition_and_readability(spark):
    assert value(spark, Q.trigram_repetition(F.col("t")), t="to be or not to be or not") == pytest.approx(1 / 3)
    assert value(spark, Q.readability(F.col("t")), t="The cat sat on the mat. It was warm!") == 1.0


@pytest.mark.parametrize("n, sizes", [(3, [1, 1, 1]), (7, [1, 1, 1, 1, 3]), (10, [2] * 5), (1439, [287, 287, 287, 287, 291])])
def test_periods(spark, n, sizes):
    rows = spark.range(n).select(F.col("id").alias("conversation_id"), (F.col("id") * 10.0).alias("created_at"))
    out = C.with_period(rows, ["created_at", "conversation_id"]).groupBy("period").count().orderBy("period").collect()
    assert [r["count"] for r in out] == sizes


def test_budget_skips_and_goes_on(spark):
    rows = spark.createDataFrame([(i, t, -float(i)) for i, t in enumerate([6, 5, 4, 1])], "conversation_id long, canonical_tokens long, information_gain double")
    out = {r.canonical_tokens: r.selected for r in D.select_within_budget(rows, 10).collect()}
    assert out == {6: True, 5: False, 4: True, 1: False}
    assert all(r.selected for r in D.select_within_budget(rows, 16).collect())


@pytest.mark.parametrize("corrections, name", [(0, "silver"), (1, "gold")])
def test_tier(spark, corrections, name):
    row = spark.createDataFrame([(0.65, 0.15, corrections)], "information_gain double, malicious_compliance double, correction_events int")
    assert row.select(D.tier().alias("t")).first().t == name


def test_tokens(spark):
    assert value(spark, K.char_tokens(F.col("t")), t="") == 1 and value(spark, K.char_tokens(F.col("t")), t="123456789") == 2
    assert value(spark, K.truncated(K.code_points(F.col("t")), 2, "left"), t="abc") == [98, 99]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="ab   \x1c\n　c", max_size=30))
def test_words_split_like_unicode_space(spark, text):
    assert value(spark, X.words(F.col("t")), t=text) == text.split()


def test_normalising(spark):
    assert value(spark, N.normal(F.col("t")), t=" é\x00​\ta\r\n\r\n\r\n\r\nb  ") == "é a\n\nb"
    assert value(spark, N.broken_lines(F.col("t"), 10), t="aaaa bbbb cccc") == "aaaa bbbb\ncccc"
    assert value(spark, N.char_categories(F.col("t")), t="Ab1") == '{"Ll": 1, "Lu": 1, "Nd": 1}'
    assert value(spark, N.encoding_issues(F.col("t")), t="﻿a\r\nb\n�") == ["replacement_chars", "bom", "mixed_line_endings"]


# ---- duplicates


def test_dedup(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away into the wide green woods " * 3
    docs = [(0, base), (1, base), (2, base.replace("lazy", "hazy", 1)), (3, "something else altogether, with nothing in common here"), (4, None), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, t string")
    exact = {r.doc_id: r.first_id for r in U.exact(df).collect()}
    assert exact == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4}
    near = {r.position: r.match for r in U.near(U.minhash_signatures(df)).collect()}
    assert near[1] == 0 and near[2] == 0 and near[3] is None and near[0] is None
    sim = {r.position: r.match for r in U.near_by_simhash(U.simhashes(df)).collect()}
    assert sim[1] == 0 and sim[3] is None
    kinds = {r.position: r.method for r in U.hybrid(df).collect()}
    assert kinds == {0: "unique", 1: "exact", 2: "near", 3: "unique", 4: "unique", 5: "exact"}


def test_minhash_recall(spark, sf):
    """Of rows with an earlier one at J >= 0.85 nearly all have a match; agreement of 128 values scatters by some 0.03, so it is asked for 0.78."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.col("text").alias("t"))
    sets = {r.doc_id: {r.t[i : i + 5] for i in range(max(1, len(r.t) - 4))} for r in docs.collect()}
    got = {r.position: r.match for r in U.near(U.minhash_signatures(docs), 0.78).collect()}
    ids = sorted(sets)
    wanted = {b for i, b in enumerate(ids) for a in ids[:i] if min(len(sets[a]), len(sets[b])) > 0.85 * max(len(sets[a]), len(sets[b])) and len(sets[a] & sets[b]) >= 0.85 * len(sets[a] | sets[b])}
    found = sum(got[b] is not None for b in wanted)
    print(f"recall {found / len(wanted):.4f} of {len(wanted)} rows at J >= 0.85")
    assert found >= 0.98 * len(wanted)
    assert all(len(sets[a] & sets[b]) >= 0.65 * len(sets[a] | sets[b]) for b, a in got.items() if a is not None)


def test_simhash_finds_all_within_the_distance(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 63), 1 << 63, 30)
    rows = []
    for h in base.tolist():
        rows.append(h)
        for _ in range(6):
            x = h & 0xFFFFFFFFFFFFFFFF
            for bit in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                x ^= 1 << int(bit)
            rows.append(x - (1 << 64) if x >> 63 else x)
    got = U.near_by_simhash(spark.createDataFrame(list(enumerate(rows)), "position long, simhash long")).collect()
    far = lambda a, b: ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count()
    for r in got:
        earlier = [far(rows[r.position], rows[i]) for i in range(r.position)]
        assert (r.match is not None) == any(d <= 3 for d in earlier)
        assert r.match is None or (far(rows[r.position], rows[r.match]) == r.distance <= 3 and r.match < r.position)


def test_band_candidates_grow_with_rows_only(spark):
    """A bucket of 300 different signatures that share a band gives 299 candidates."""
    rows = [(i, [7] * 8 + [i * 120 + j for j in range(120)]) for i in range(300)]
    df = spark.createDataFrame(rows, "position long, signature array<int>")
    assert U.banded_pairs(df).count() == 299 and U.near(df).where("match IS NOT NULL").count() == 0


def test_preference_pairs(spark):
    base = "the quick brown fox jumps over the lazy dog near the river bank"
    good = [(0, "user", "q " * 25), (1, "assistant", base), (2, "user", "that is wrong, the logic fails"), (3, "assistant", base + " and then it sleeps under the old tree")]
    rows = [(1, *m) for m in good] + [(1, p + 2, r, t) for p, r, t in good[2:]]  # overlapping candidates
    rows += [(2, p, r, base if p == 3 else t) for p, r, t in good]  # alike
    rows += [(3, p, r, "x" * 60 if p == 3 else t) for p, r, t in good]  # unrelated
    rows += [(4, p, r, "fine, go on" if p == 2 else t) for p, r, t in good]  # no correction
    got = preference.pairs(spark.createDataFrame(rows, "conversation_id long, position int, role string, text string")).collect()
    assert [(r.conversation_id, r.position, r.correction_type) for r in got] == [(1, 0, "logic_error")]
    assert abs(got[0].confidence - 1.0) < 1e-9 and 0.3 < got[0].similarity < 0.8


def test_families_and_workflows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "Let me think: deeper reasoning, consider this"), (2, 0, "user", "```x```"), (2, 1, "assistant", "look"), (3, 0, "user", "hi")]
    rows += [(4, p, ["assistant", "user"][p % 2], "```run```" if p % 2 == 0 else "Error: no") for p in range(6)]
    df = spark.createDataFrame(rows, "conversation_id long, position int, role string, text string")
    assert {r.conversation_id: (r.model, round(r.confidence, 3)) for r in preference.families(df).collect()} == {1: ("gpt-5-class", 1.0), 2: ("gpt-4.5", 0.2), 3: ("unknown", 0.0), 4: ("gpt-4.5", 0.2)}
    assert {r.conversation_id: r.workflow for r in preference.workflows(df).collect()} == {2: "code_review_focused", 4: "interactive_debugging"}


def test_claude_content_of_any_shape(spark):
    import json

    shapes = ["plain text", ["bare", {"type": "text", "text": "block"}, {"value": "v"}, {"type": "x"}, " "], [], None, "[not a list"]
    rec = {"uuid": "c", "name": "n", "chat_messages": [{"uuid": f"m{i}", "text": "", "sender": "human", "created_at": f"2024-01-01T00:00:0{i}Z", "content": c} for i, c in enumerate(shapes)]}
    parsed = spark.createDataFrame([(json.dumps(rec),)], "raw string").select(F.from_json("raw", E.CLAUDE).alias("r")).select("r.*")
    assert {r.message_id: r.text for r in E.claude(parsed).collect()} == {"m0": "plain text", "m1": "bare\n\nblock\n\nv", "m4": "[not a list"}


def test_budget_by_parts_is_the_plain_walk(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(t), float(r)) for i, (t, r) in enumerate(zip(rng.integers(1, 500, 400), rng.integers(0, 40, 400) / 40, strict=True))]
    df = spark.createDataFrame(rows, "conversation_id long, canonical_tokens long, information_gain double")
    for budget in (0, 3, 700, 20_000, 60_000, 99_000):
        used, want = 0, set()
        for i, t, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
            if used + t <= budget:
                used += t
                want.add(i)
        assert {r.conversation_id for r in D.select_within_budget(df, budget).where("selected").collect()} == want


def test_provider_guard():
    assert discover.guard_provider(" Claude ") == "claude" and discover.guard_provider("qwen", promote=True) == "qwen"
    for name, promote in (("deepseek", False), ("", True), (None, False)):
        with pytest.raises(ValueError):
            discover.guard_provider(name, promote)


def test_exact_tokens_by_provider(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    from lexiloom.plans import corpus

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for r in corpus.clean(spark, sf).collect():
        n, m = want.get(r.provider, (0, 0))
        want[r.provider] = (n + 1, m + len(tok.encode(r.text, add_special_tokens=False).ids))
    assert {r.provider: (r.messages, r.tokens) for r in catalog.QUERIES["op_agg_29_bpe_tokens"](spark, sf).collect()} == want


def test_repeated_outliers_follow_the_formula(spark):
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in rng.integers(90, 110, 60)] + [500, 100, 3]
    rows = spark.createDataFrame(list(enumerate(lengths)), "k long, n long")
    got = {r.k: r.outlier for r in O.length_outliers(rows, "k", "n").collect()}
    for i, x in enumerate(lengths):
        before = lengths[:i]
        want = False
        if i >= 10:
            sd = np.std(before, ddof=1)
            ordered = sorted(before)
            low, high = ordered[i // 4], ordered[3 * i // 4]
            want = bool((sd > 0 and abs(x - np.mean(before)) / sd > 3) or x < low - 1.5 * (high - low) or x > high + 1.5 * (high - low))
        assert got[i] == want


@pytest.mark.parametrize("i, size", [(10000, 10000), (10001, 5000), (15001, 10000), (15002, 5000)])
def test_history_window(i, size):
    h = O.History()
    for x in range(i):
        h.add(x)
    assert len(h.given) == size


@given(st.text(alphabet="ab \t\n\u3000", max_size=120), st.integers(5, 20))
@settings(max_examples=200, deadline=None)
def test_lines_broken_as_if_cut_one_by_one(text, width):
    def plain(line):
        out = []
        while len(line) > width:
            at = line.rfind(" ", int(width * 0.8) + 1, width + 1)
            at = at if at > 0 else width
            out.append(line[:at])
            line = line[at:].lstrip()
        return [*out, line]

    assert N.break_lines(text, width) == "\n".join(x for line in text.split("\n") for x in plain(line))


def test_char_categories_count_every_character(spark):
    got = json.loads(value(spark, N.char_categories(F.col("t")), t="aB 1\n\u00e4"))
    assert got == {"Ll": 2, "Lu": 1, "Zs": 1, "Nd": 1, "Cc": 1} and value(spark, N.char_categories(F.col("t")), t="") == "{}"


def test_checksums_are_those_of_the_files(spark, sf):
    got = {r.name: (r.length, r.sha256) for r in catalog.QUERIES["op_val_04_checksums"](spark, sf).collect()}
    content = {n: open(f"{sf}/{n}", "rb").read() for n in ("nation.parquet", "region.parquet")}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in content.items()}


def test_export_of(spark, tmp_path):
    for i, name in enumerate(("claude/a/conversations.json", "claude/b/conversations.json", "qwen/qwen-chat-export-2.json", "qwen/qwen-chat-export-1.json", "deepseek/conversations.json")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("[]")
        os.utime(tmp_path / name, (10 + i, 10 + i))
    found = lambda p: discover.export_of(spark, str(tmp_path), p).split(str(tmp_path))[1]
    assert [found(p) for p in ("claude", "qwen", "deepseek")] == ["/claude/b", "/qwen/qwen-chat-export-1.json", "/deepseek/conversations.json"]
    with pytest.raises(FileNotFoundError):
        found("chatgpt")


def test_detector_is_any_function_of_a_text(spark):
    long = "the word and the other word with that of the language, and more"
    both = lambda t, *how: value(spark, Q.detected_language(F.col("t"), *how), t=t)
    assert both(long, Q.by_common_words) == ("en", 1.0) and both(long) == ("en", 1.0)
    assert both("xx " * 30, Q.by_common_words) == ("unknown", 0.0) and both("short") == both(None) == ("unknown", 0.0)
    assert both(long, lambda t: (F.lit("tr"), F.lit(0.25))) == ("tr", 0.25)


# ---- merge


def merge_tables(spark):
    schema = "uid string, key string, v string"
    main = spark.createDataFrame([("u1", "k1", "v1"), ("u2", "k2", "v2")], schema)
    source = spark.createDataFrame([("u1", "k1", "v1"), ("u2", "k2", "v9"), ("u3", "k3", "v3"), ("u9", "k1", "other")], schema)
    return main, source


def test_merge_is_idempotent(spark):
    main, source = merge_tables(spark)
    first = M.dry_run(main, source, "uid", "key", ["v"]).first()
    assert (first.inserted, first.updated, first.skipped, first.pk_collision) == (1, 1, 2, 1)
    merged = M.merged(main, source, "uid", "key", ["v"])
    assert {(r.uid, r.key, r.v) for r in merged.collect()} == {("u1", "k1", "v1"), ("u2", "k2", "v9"), ("u3", "k3", "v3")}
    again = M.dry_run(merged, source, "uid", "key", ["v"]).first()
    assert (again.inserted, again.updated, again.skipped) == (0, 0, 4)


def test_versions(spark, tmp_path):
    main, _ = merge_tables(spark)
    assert M.write_version(main, str(tmp_path / "t")).endswith("v=1") and M.write_version(main, str(tmp_path / "t")).endswith("v=2")
    assert (tmp_path / "t" / "_current").read_text() == "2" and spark.read.parquet(str(tmp_path / "t" / "v=1")).count() == 2


# ---- validation and schemas


def test_gates(spark):
    rows = spark.createDataFrame([(1, None)], "a int, b boolean")
    g = V.gates(rows, {"A": F.col("a") == 1, "B": F.col("b"), "C": F.col("a") == 2})
    assert {r.gate: r.verdict for r in g.collect()} == {"A": "PASS", "B": "SKIP", "C": "FAIL"}
    assert V.overall(g).first().verdict == "FAIL" and V.overall(g.where("gate <> 'C'")).first().verdict == "PASS"


def test_digest_forgets_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert V.table_digest(a).first() == V.table_digest(a.orderBy(F.desc("a")).repartition(3)).first()
    assert V.table_digest(a).first() != V.table_digest(a.limit(1)).first()


def test_schema_inference(spark):
    texts = ['{"a": 1, "b": [1, "x", null], "c": {}}', '{"a": "s", "b": []}', "{bad", None]
    types = S.path_types(spark.createDataFrame([(t,) for t in texts], "raw string"), "raw")
    got = {r.path: (r.types, r.n, r.optional) for r in S.inferred(types).collect()}
    assert got["$.a"] == ("int|str", 2, False) and got["$.c"] == ("object", 1, True) and got["$.b[]"] == ("int|null|str", 3, False)
    assert {(r.path, r.anomaly) for r in S.anomalies(types).collect()} == {("$.c", "empty_object"), ("$.b", "empty_list"), ("$", "malformed")}
    assert "| $.a | int |  |" in S.rendered([("$.a", "int", False)])


# ---- sources


def test_files(spark, tmp_path):
    rec = [{"id": "c1", "title": None, "mapping": {"n1": {"id": "n1", "message": {"author": {"role": "user"}, "content": {"parts": ["hi", "", "there"]}, "create_time": 5.0}}, "n0": {"id": "n0", "message": None}, "n2": {"id": "n2", "message": {"author": {"role": "system"}, "content": {"parts": ["s"]}}}}}]
    with gzip.open(tmp_path / "export.json.gz", "wt") as f:
        json.dump(rec, f)
    rows = E.messages(spark, "chatgpt", str(tmp_path / "export.json.gz")).collect()
    assert [(r.conversation_id, r.title, r.created_at, r.text) for r in rows] == [("c1", "Untitled", 5.0, "hi there")]
    (tmp_path / "lines.jsonl").write_text('[\n{"k": 1},\n\n{"k": 2\n{"k": 3}\n]\n')
    good, bad = E.json_lines(spark, str(tmp_path / "lines.jsonl"), "k long")
    assert sorted(r.k for r in good.collect()) == [1, 3] and [r.line for r in bad.collect()] == ['{"k": 2']
    assert E.format_of("x.NDJSON.gz") == "jsonl" and E.format_of("notes") == "jsonl" and E.format_of("a.csv") == "csv"
    assert E.file_shards(spark, [str(tmp_path)], "*.jsonl").count() == 1


def test_claude(spark):
    raw = json.dumps({"uuid": "c", "name": " ", "chat_messages": [
        {"uuid": "b", "sender": "Human", "text": " hello ", "created_at": "2024-01-01T00:00:00Z"},
        {"uuid": None, "sender": "assistant", "text": "", "created_at": "2024-01-01T00:00:05Z", "content": [{"type": "text", "text": "one"}, {"type": "x", "output": "two"}]},
        {"uuid": "z", "sender": "robot", "text": "dropped"}]})
    rows = spark.createDataFrame([(raw,)], "raw string").select(F.from_json("raw", E.CLAUDE).alias("r")).select("r.*")
    out = {r.message_id: r for r in E.claude(rows).collect()}
    assert {k: (r.role, r.text, r.parent_id, r.title) for k, r in out.items()} == {"b": ("user", "hello", None, "Untitled"), "c_m2": ("assistant", "one\n\ntwo", "b", "Untitled")}


def test_deepseek_and_qwen(spark):
    deep = json.dumps({"id": "d", "inserted_at": "2024-01-01T00:00:00Z", "mapping": {"1": {"message": {"fragments": [{"type": "THINK", "content": "only thought"}]}}, "2": {"message": {"fragments": [{"type": "request", "content": "q"}, {"type": "RESPONSE", "content": "r"}]}}}})
    rows = spark.createDataFrame([(deep,)], "raw string").select(F.from_json("raw", E.DEEPSEEK).alias("r")).select("r.*")
    assert {r.message_id: (r.role, r.text) for r in E.deepseek(rows).collect()} == {"1": ("assistant", "only thought"), "2": ("user", "q")}
    qwen = json.dumps({"id": "q", "created_at": 0, "chat": {"history": {"messages": {"m": {"role": "assistant", "content": "plain", "content_list": [{"phase": "think", "content": "t"}]}, "n": {"role": "tool", "content": "x"}}}}})
    rows = spark.createDataFrame([(qwen,)], "raw string").select(F.from_json("raw", E.QWEN).alias("r")).select("r.*")
    got = E.qwen(rows).collect()
    assert [(r.text, r.created_at) for r in got] == [("plain", None)]


def test_record_text_and_code(spark):
    df = spark.createDataFrame([("", None, 1), (None, "c", 2), (None, None, 3)], "text string, content string, k int")
    assert [r.t for r in df.select(R.text_of_record(df).alias("t")).collect()] == ['{"text":"","k":1}', "c", '{"k":3}']
    blocks = value(spark, E.code_blocks(F.col("t")), t="x\n```py\na = 1\n```\n```\nb\n```")
    assert [(b.language, b.code) for b in blocks] == [("py", "a = 1\n"), ("", "b\n")]
    assert value(spark, E.scraped_number(F.col("t"), "total: ([0-9,]+)"), t="the total: 1,234 of") == 1234.0


# ---- streaming


def test_stream_state_spans_batches(spark, tmp_path):
    rows = [(i, "g", 100 + i % 3) for i in range(30)] + [(30, "g", 900)]
    df = spark.createDataFrame(rows, "k long, g string, n long")
    for i, part in enumerate((df.where("k < 15"), df.where("k >= 15"))):
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"b={i}"))
    stream = streaming.file_stream(spark, str(tmp_path / "in" / "*"), df.schema, files_per_trigger=1)
    out = streaming.to_end(streaming.rolling_outliers(stream, "g", "k", "n"), "t", str(tmp_path / "ck"))
    assert [r.k for r in out.where("outlier").collect()] == [30] and out.count() == 31


def all_repeats(text, least=10, most=10):
    out = []
    for n in range(least, len(text) // 2 + 1):
        seen = {}
        for i in range(len(text) - n + 1):
            seen[text[i : i + n]] = seen.get(text[i : i + n], 0) + 1
        out += [x for x, k in seen.items() if k > 1]
    return sorted(out, key=len, reverse=True)[:most]


@given(st.lists(st.sampled_from(["a", "b", "aab", "é", "😀 ", "abcabcabcd", "one long phrase of words. "]), max_size=40).map("".join), st.integers(1, 12))
@settings(max_examples=150, deadline=None)
def test_repeated_sequences_are_all(text, least):
    assert P.longest_repeats(text, least) == all_repeats(text, least)


def test_repeated_sequences_of_any_length(spark):
    """Passages of over 400 characters keep their length, also where two of them repeat."""
    rng = np.random.default_rng(3)
    one, two = ("".join(map(chr, rng.integers(97, 123, n))) for n in (1500, 1497))
    text = f"{one}.{two}!{one}?{two}:"
    got = value(spark, P.repeated_sequences(F.col("t")), t=text)
    assert got == P.longest_repeats(text) and [len(x) for x in got] == [1500, 1499, 1499, 1498, 1498, 1498, 1497, 1497, 1497, 1497]
    assert got[0] == one and two in P.longest_repeats(text, most=11)
    assert P.longest_repeats("x" * 5000)[0] == "x" * 2500


def test_row_metric_rules_find_each_fault(spark):
    good = {"sample_id": "a", "split": "train", "source": "s", "text_sha256": "0" * 64, "language": "en", "language_confidence": 0.5, "tokenizer_name": "t", "tokenizer_version": "1", "context_4k_fit": True, "context_8k_fit": True, "context_32k_fit": True, "anomaly_flags": ["x"]}
    good |= {c: 1 for c in ("raw_bytes", "char_count", "word_count", "line_count", "token_count", "special_token_count", "unk_token_count", "truncation_at_4k", "truncation_at_8k", "truncation_at_32k")}
    good |= {c: 0.5 for c in ("quality_score", "entropy_score", "repetition_score", "safety_risk_score")}
    bad = {"split": "dev", "source": None, "text_sha256": "0", "language": "eng", "language_confidence": 1.5, "tokenizer_name": None, "raw_bytes": -1, "token_count": None, "truncation_at_8k": -2, "quality_score": None, "safety_risk_score": 1.1, "repetition_score": float("nan")}
    schema = ", ".join(f"{k} {'array<string>' if k == 'anomaly_flags' else {str: 'string', float: 'double', int: 'long', bool: 'boolean'}[type(v)]}" for k, v in good.items())
    frame = lambda *rows: spark.createDataFrame([tuple((good | r).values()) for r in rows], schema)
    got = {r.check: r for r in V.row_metric_rules(frame({}, bad, {"sample_id": "b"})).collect()}
    assert {c for c, r in got.items() if r.verdict == "FAIL"} == {*bad, "sample_id"} and all(got[c].violations == 1 for c in (*bad, "sample_id"))
    assert got["exact_dup_group"].verdict == "SKIP" and got["language"].severity == "warning"
    typed = V.row_metric_rules(frame({}).withColumn("context_4k_fit", F.lit(1)).drop("split")).collect()
    assert {r.check: r.verdict for r in typed if r.verdict != "PASS"} == {"context_4k_fit": "FAIL", "split": "SKIP", "exact_dup_group": "SKIP", "near_dup_cluster_id": "SKIP"}


def test_raw_gates(spark):
    verdicts = lambda *a: "".join(r.verdict[0] for r in V.raw_gates(*a).orderBy("gate").collect())
    split = F.when(F.col("id") < 9039, "train").when(F.col("id") < 9526, "val").otherwise("test")
    rows = spark.range(10_000).select(split.alias("split"), F.lit("web_crawl").alias("source"))
    ledger, totals = {"counters": {"content_tokens_non_system": 5}, "source_sha256": "ab"}, {"summary": {"content_tokens_non_system": 5}}
    assert verdicts(rows) == "FFFSS" and verdicts(rows.limit(9_999), ledger, totals, "ab") == "FPPPP"
    assert verdicts(rows.drop("source", "split"), ledger, {"summary": {"content_tokens_non_system": 6}}, "cd") == "PPPFF"
    assert verdicts(rows.drop("split"), {"counters": {}}, totals) == "FPFSS"
