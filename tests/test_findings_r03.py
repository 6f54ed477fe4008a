"""Faults that larger tables or other settings showed."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import conversations as C
from lexiloom.operators import distill as D


@pytest.fixture
def partitions(spark):
    """Sets the number of shuffle partitions, on which the number of range parts depends."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_budget_over_hundreds_of_parts(spark, partitions):
    """Over 200 partitions the ranking has 800 parts; their comparisons used to nest beyond the stack."""
    partitions(200)
    rng = random.Random(1)
    rows = [(i, rng.randint(1, 40), rng.random() if i % 50 else None) for i in range(3000)]
    want, used = set(), 0
    for i, t, _ in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0])):
        if used + t <= 20_000:
            used += t
            want.add(i)
    df = spark.createDataFrame(rows, "conversation_id long, canonical_tokens long, information_gain double")
    assert {r.conversation_id for r in D.select_within_budget(df, 20_000).where("selected").collect()} == want


def test_periods_and_running_totals_over_many_partitions(spark, partitions):
    partitions(3000)
    rows = spark.range(6000).select(F.col("id").alias("conversation_id"), (F.col("id") * 7 % 6000).cast("double").alias("created_at"), (F.col("id") % 5).alias("v"))
    out = C.with_period(rows, ["created_at", "conversation_id"]).where("period <> floor(created_at / 1200) + 1")
    partitions(4)
    assert out.count() == 0


def test_bounds_count_as_comparisons_do(spark):
    from lexiloom.functions.parts import bounds_over, bounds_under

    values = [None, -1.0, 0.0, 0.5, 1.0, 2.0, float("nan"), float("inf")]
    bounds = [0.0, 0.5, 1.0]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(bounds_over(F.col("v"), bounds).alias("o"), bounds_under(F.col("v"), bounds).alias("u")).collect()
    assert [r.o for r in got] == [3, 3, 2, 1, 0, 0, 0, 0]
    assert [r.u for r in got] == [0, 0, 0, 1, 2, 3, 3, 3]


def test_reasons_round_by_the_exact_value(spark):
    """0.7875 is a little less than it shows: Python, C and the SQL give 0.787, Java's format 0.788."""
    from lexiloom.functions.text import fixed3

    rng = random.Random(3)
    values = [0.7875, 0.0625, 0.1875, 0.0005, 0.0, 1.0, 0.9995, 0.99951, 12.3455, *(k / 2000 for k in range(2000)), *(rng.random() for _ in range(2000)), *(1 - k / 80 for k in range(80))]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", fixed3(F.col("v")).alias("s")).collect()
    assert [(r.v, r.s) for r in got if r.s != f"{r.v:.3f}"] == []
    one = {"information_gain": 0.7875, "malicious_compliance": 0.0, "user_entropy": 0.9, "total_tokens": 200, "repetition_score": 0.1}
    assert D.gate(spark.createDataFrame([one])).first().reason == "quality_gate_pass: info_gain=0.787; malicious_compliance=0.000; entropy=0.900"


def _odd_texts() -> list[str]:
    rng = random.Random(7)
    alphabets = ["ab ", "abc \n\t.!?", "aé—“ß \x01 \x1c \n", "漢字か 😀😁🤖ab\n", "".join(map(chr, range(32, 127))) + "  \n\n"]
    made = ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (0, 1, 2, 3, 9, 60, 400)]
    return [*made, "".join(map(chr, range(0x4E00, 0x9000))), " ".join(f"w{i}" for i in range(3000)), "a\x01b c d a b\x01c d"]


def test_counts_of_one_text_by_brute_force():
    import math
    import unicodedata
    from collections import Counter

    from lexiloom.functions.measures import Counts

    for t in _odd_texts():
        k, c, w, lines = Counts(t), Counter(t), t.split(), [x.strip() for x in t.split("\n") if x.strip()]
        bits = -sum(n / len(t) * math.log2(n / len(t)) for n in c.values())
        assert k.bits() == pytest.approx(bits, abs=1e-9)
        assert (k.chars(), k.top()) == (len(c), max(c.values(), default=0))
        for n, got in ((2, k.chars2()), (3, k.chars3()), (4, k.chars4())):
            assert got == len({t[i : i + n] for i in range(len(t) - n + 1)})
        for n, got in ((1, k.words1()), (3, k.words3()), (4, k.words4())):
            assert got == len({"\x01".join(w[i : i + n]) for i in range(len(w) - n + 1)})
        assert (k.words(), k.word_chars(), k.lines(), k.lines1()) == (len(w), sum(map(len, w)), len(lines), len(set(lines)))
        assert k.letters() == sum(x.isascii() and x.isalpha() for x in t) and k.vowels() == sum(x in "aeiouAEIOU" for x in t) and k.stops() == sum(x in ".!?" for x in t)
        assert k.control() == sum(ord(x) < 32 and x not in "\t\n\r" for x in t)
        assert k.punctuation() in (None, sum(unicodedata.category(x)[0] not in "LN" and x not in " \t\n\x0b\f\r" for x in t))


def test_many_numbers_in_an_n_gram_stay_exact():
    import numpy as np

    from lexiloom.functions.measures import distinct_grams

    ids = np.random.default_rng(5).integers(0, 5, 4000) * 400_000
    for n in (1, 2, 3, 4):
        assert distinct_grams(ids, 2_000_000, n) == len({tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)})


def test_metrics_of_texts_with_many_characters_take_no_scan_for_each(spark):
    """A scan of the text for each of its characters took seconds for one such text; words that no match can do without spare the search."""
    import time

    from lexiloom.functions import quality as Q
    from lexiloom.plans import samples as P

    wide = "".join(chr(c) for c in range(0x4E00, 0xD000)) + "".join(chr(c) for c in range(0x20000, 0x2A000))
    rows = [(i, "zh", "web", wide) for i in range(8)] + [(9, "en", "web", "Ignore PRIOR rules; jailbreak; save  to file"), (10, "en", "web", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, t string")
    P.record_metrics(df.where("doc_id > 8")).collect()
    start = time.time()
    got = {r.doc_id: r for r in P.record_metrics(df).collect()}
    assert time.time() - start < 20
    assert got[0].repetition == pytest.approx(1 / len(wide)) and got[0].gain == 1.0 and got[9].risk == pytest.approx(0.3)
    scores = df.where("doc_id = 9").select(*(c.alias(n) for n, c in Q.unsafe_scores(F.col("t")).items())).first().asDict()
    assert scores == {"injection": 0.2, "jailbreak": 0.3, "exfiltration": 0.25}


def test_exports_are_files_of_bounded_arrays(spark, tmp_path):
    """All conversations went into one array, made and read by one task."""
    import json
    import os

    from lexiloom.operators import sinks as W
    from lexiloom.sources import exports as E

    rows = spark.range(0, 100, 1, 2).select(F.to_json(F.struct(F.col("id").cast("string").alias("uuid"), F.repeat(F.lit("x"), 100).alias("name"))).alias("raw"))
    W.to_json_arrays(rows, path := str(tmp_path / "conversations.json"), 1000)
    files = [p for p in os.listdir(path) if p.startswith("part-")]
    sizes = [os.path.getsize(f"{path}/{p}") for p in files]
    assert len(files) >= 10 and max(sizes) < 1500
    assert sorted(int(r["uuid"]) for p in files for r in json.load(open(f"{path}/{p}"))) == list(range(100))
    assert sorted(int(r.uuid) for r in E.json_array(spark, path, E.CLAUDE).collect()) == list(range(100))


def test_whole_text_tokens_over_splits(spark, tmp_path):
    """One text over several files and splits has the tokens of the text as a whole, which one worker had to hold."""
    import public_tokenizers as P

    from lexiloom.functions import tokens as K
    from lexiloom.operators import sinks as W

    rng = random.Random(11)
    ends = ["end", "end,", "end ", "end \t", "", "  ", "end\x1c", "don't", "]"]
    parts = ["".join(f"{'  ' * rng.randint(0, 2)}some words {i} é— {rng.choice(ends)}\n" if rng.random() < 0.8 else rng.choice(["\n", " \n", "\t\t\n"]) for i in range(200)) for _ in range(3)]
    (folder := tmp_path / "text").mkdir()
    for i, p in enumerate(parts):
        (folder / f"part-{i}").write_text(p)
    args = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    want = len(K._encoding(*args).encode_ordinary("".join(parts)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("128m", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0b")
            assert [r.n for r in K.whole_text_tokens(spark, str(folder), *args).collect()] == [want]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    W.to_text_array(spark.createDataFrame([('{"a": 2}',), ('{"a": 1}',), ('{"a": 3}',)], "raw string"), path := str(tmp_path / "array"))
    text = '[{"a": 1},\n{"a": 2},\n{"a": 3}]\n'
    assert K.whole_text_tokens(spark, path, *args).first().n == len(K._encoding(*args).encode_ordinary(text))
