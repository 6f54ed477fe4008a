"""Validation: rule counts in one pass, gates with verdicts, contracts, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_counts(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """check, violations and passed of each rule (true means violated), all in one scan."""
    counted = rows.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    entries = F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in rules))
    return counted.select(F.explode(entries).alias("r")).select("r.check", "r.violations", (F.col("r.violations") == 0).alias("passed"))


def required_columns(rows: DataFrame, required: list[str]) -> DataFrame:
    """One row for each required column and whether it is there."""
    spark = rows.sparkSession
    return spark.createDataFrame([(c, c in rows.columns) for c in required], "column string, present boolean")


def gates(rows: DataFrame, verdicts: dict[str, Column]) -> DataFrame:
    """gate and verdict: true is PASS, false FAIL, null SKIP. rows has one row."""
    entries = F.array(*(F.struct(F.lit(n).alias("gate"), F.when(c.isNull(), "SKIP").when(c, "PASS").otherwise("FAIL").alias("verdict")) for n, c in verdicts.items()))
    return rows.select(F.explode(entries).alias("g")).select("g.*")


def overall(verdicts: DataFrame) -> DataFrame:
    """FAIL if any gate fails; SKIP is no failure."""
    return verdicts.agg(F.when(F.count_if(F.col("verdict") == "FAIL") > 0, "FAIL").otherwise("PASS").alias("verdict"), F.count("*").alias("gates"))


def table_digest(rows: DataFrame) -> DataFrame:
    """n and a digest of the rows that does not depend on their order: sums of hashes, which add up over tasks."""
    row = F.to_json(F.struct(*sorted(rows.columns)))
    half = lambda a: F.sum(F.conv(F.substring(F.sha2(row, 256), a, 12), 16, 10).cast("decimal(38,0)"))
    return rows.agg(F.count("*").alias("n"), F.sha2(F.concat_ws(":", half(1).cast("string"), half(13).cast("string")), 256).alias("digest"))


def unique_violations(rows: DataFrame, key: str) -> DataFrame:
    """rows minus distinct keys."""
    return rows.agg((F.count("*") - F.count_distinct(key)).alias("collisions"))


# Fixed values of the reference's validator.
SPLITS = ("train", "val", "test", "unknown")
BANNED_SOURCES = ("documentation", "stackoverflow", "web_crawl", "github_code")
SYNTHETIC_SPLIT = {"train": 9039, "val": 487, "test": 474}


def row_metric_rules(rows: DataFrame) -> DataFrame:
    """check, severity, violations and verdict of the 14 rule groups over row metrics; a check whose column is missing is SKIP.

    The metrics are read once, in one row of counts a task. Repeated ids are counted over the ids alone: in the same
    aggregation they would make every count one of each id, and shuffle it.
    """
    no = lambda c: F.col(c).isNull()
    count = lambda c: no(c) | (F.col(c) < 0)
    outside = lambda c: (F.col(c) < 0) | (F.col(c) > 1)  # noqa: E731, and NaN is more than 1
    kinds = dict(rows.dtypes)
    typed = lambda kind: lambda c: F.lit(kinds[c] != kind)
    rules = {
        "sample_id": no, "split": lambda c: no(c) | ~F.col(c).isin(*SPLITS), "source": no, "text_sha256": lambda c: no(c) | (F.length(c) != 64),
        **dict.fromkeys(("raw_bytes", "char_count", "word_count", "line_count"), count),
        "language": lambda c: F.length(c) != 2, "language_confidence": lambda c: outside(c) & ~F.isnan(c),
        **dict.fromkeys(("tokenizer_name", "tokenizer_version"), no), **dict.fromkeys(("token_count", "special_token_count", "unk_token_count"), count),
        **dict.fromkeys(("context_4k_fit", "context_8k_fit", "context_32k_fit"), typed("boolean")),
        **dict.fromkeys(("truncation_at_4k", "truncation_at_8k", "truncation_at_32k"), lambda c: F.col(c) < 0),
        **dict.fromkeys(("quality_score", "entropy_score", "repetition_score", "safety_risk_score"), lambda c: no(c) | outside(c)),
        "anomaly_flags": typed("array<string>"), "exact_dup_group": lambda c: F.lit(False), "near_dup_cluster_id": lambda c: F.lit(False),  # the last two are only told, as in the reference
    }
    found = {c: F.count_if(F.coalesce(f(c), F.lit(False))) if c in kinds else F.lit(None).cast("long") for c, f in rules.items()}
    counted = rows.agg(F.count("*").alias("_n"), *(x.alias(c) for c, x in found.items()))
    if "sample_id" in kinds:
        counted = counted.crossJoin(unique_violations(rows.select("sample_id").where("sample_id IS NOT NULL"), "sample_id"))  # one row each
        counted = counted.withColumn("sample_id", F.col("sample_id") + F.col("collisions"))
    entries = F.array(*(F.struct(F.lit(c).alias("check"), F.lit("warning" if c == "language" else "error").alias("severity"), F.col(c).alias("violations")) for c in rules))
    verdict = F.when(F.col("r.violations").isNull(), "SKIP").when(F.col("r.violations") == 0, "PASS").otherwise("FAIL")
    return counted.select(F.explode(entries).alias("r")).select("r.*", verdict.alias("verdict"))


def raw_gates(rows: DataFrame, ledger: dict | None = None, forensics: dict | None = None, source_sha256: str | None = None) -> DataFrame:
    """gate and verdict of R1-R5: banned sources, split fingerprint, synthetic signature, token ledger against forensics, source hash.

    ledger and forensics are the parsed reports, source_sha256 the hash of the export itself. R4 and R5 are SKIP
    where one of these lacks its value; rows without source or split hold nothing synthetic and pass, as in the reference.
    """
    banned = F.count_if(F.col("source").isin(*BANNED_SOURCES)) if "source" in rows.columns else F.lit(0)
    split = F.col("split") if "split" in rows.columns else F.lit(None).cast("string")
    row = rows.agg(F.count("*").alias("n"), banned.alias("banned"), *(F.count_if(split == k).alias(f"split_{k}") for k in SYNTHETIC_SPLIT), F.count_if(~split.isin(*SYNTHETIC_SPLIT)).alias("split_other"))
    fingerprint = F.col("split_other") == 0
    for k, n in SYNTHETIC_SPLIT.items():
        fingerprint &= F.col(f"split_{k}") == n
    told = ((ledger or {}).get("counters") or {}).get("content_tokens_non_system")
    seen = ((forensics or {}).get("summary") or {}).get("content_tokens_non_system")
    digest = (ledger or {}).get("source_sha256")
    known = lambda ok, *values: F.lit(ok if all(v not in (None, "") for v in values) else None).cast("boolean")
    return gates(row, {
        "R1": F.col("banned") == 0, "R2": ~fingerprint, "R3": ~((F.col("n") == 10_000) & (F.col("banned") > 0)),
        "R4": known(told == seen, told, seen), "R5": known(digest == source_sha256, digest, source_sha256),
    })
