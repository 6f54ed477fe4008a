"""Duplicates, merge, validation, schemas, sources, reports and doc-only operators as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import conversations as C
from ..operators import dedup as U
from ..operators import merge as M
from ..operators import schema as S
from ..operators import validate as V
from ..sources import exports as E
from . import samples as P
from .corpus import _BASE as _MSGS
from .corpus import _CONV, clean, metrics
from .registry import query, spread, table

# ---- duplicates over documents


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t")))


_EXACT = "SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) AS first_id FROM documents"


def _exact(op: str):
    @query(op, f"SELECT doc_id, first_id, first_id <> doc_id AS is_duplicate FROM ({_EXACT})")
    def run(spark, sf_dir):
        return U.exact(texts(spark, sf_dir)).select("doc_id", "first_id", "is_duplicate")


_exact("op_dup_01_exact")
_exact("op_win_06_first_seen")


@query("op_win_07_prefix_clusters", "SELECT doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')[1:100]) AS cluster_id FROM documents")
def win_07(spark, sf_dir):
    return U.by_prefix(texts(spark, sf_dir)).select("doc_id", "cluster_id")


@query("op_dup_05_agent_dedup", f"SELECT doc_id, first_id = doc_id AS is_canonical, first_id <> doc_id AS is_exact_dup, min(doc_id) OVER (PARTITION BY coalesce(text, '')[1:100]) AS near_dup_cluster_id, doc_id AS semantic_cluster_id FROM documents JOIN ({_EXACT}) USING (doc_id)")
def dup_05(spark, sf_dir):
    rows = U.by_prefix(U.exact(texts(spark, sf_dir)))
    return rows.select("doc_id", (~F.col("is_duplicate")).alias("is_canonical"), F.col("is_duplicate").alias("is_exact_dup"), F.col("cluster_id").alias("near_dup_cluster_id"), F.col("doc_id").alias("semantic_cluster_id"))


_DEDUP_SUM = f"SELECT count(*) AS total, count(*) FILTER (first_id <> doc_id) AS duplicates, round(avg(CAST(first_id <> doc_id AS INT)), 6) AS rate, count(DISTINCT first_id) AS groups, round(1 - CAST(count(DISTINCT first_id) AS DOUBLE) / count(*), 6) AS one_minus_unique FROM ({_EXACT})"


def _dedup_summary(op: str):
    @query(op, _DEDUP_SUM)
    def run(spark, sf_dir):
        rows = U.exact(texts(spark, sf_dir))
        out = rows.agg(F.count("*").alias("total"), F.count_if("is_duplicate").alias("duplicates"), F.avg(F.col("is_duplicate").cast("int")).alias("rate"), F.count_if(~F.col("is_duplicate")).alias("groups"))
        return P._out(out.withColumn("one_minus_unique", 1 - F.col("groups") / F.col("total").cast("double")))


_dedup_summary("op_agg_18_dedup_report")
_dedup_summary("op_agg_30_dedup_stats")
_dedup_summary("op_dup_06_dedup_metrics")


@query("op_join_06_dedup_assembly", f"SELECT doc_id, sha256(coalesce(text, '')) AS sha, first_id AS exact_group, min(doc_id) OVER (PARTITION BY coalesce(text, '')[1:100]) AS prefix_group FROM documents JOIN ({_EXACT}) USING (doc_id)")
def join_06(spark, sf_dir):
    rows = U.by_prefix(U.exact(texts(spark, sf_dir)))
    return rows.select("doc_id", "sha", F.col("first_id").alias("exact_group"), F.col("cluster_id").alias("prefix_group"))


@query("op_dup_02_minhash")
def dup_02(spark, sf_dir):
    return U.near(U.minhash_signatures(texts(spark, sf_dir)))


@query("op_join_07_band_candidates")
def join_07(spark, sf_dir):
    return U.banded_pairs(U.minhash_signatures(texts(spark, sf_dir)))


@query("op_dup_03_simhash")
def dup_03(spark, sf_dir):
    return U.near_by_simhash(U.simhashes(texts(spark, sf_dir)))


@query("op_join_08_hamming_pairs")
def join_08(spark, sf_dir):
    return U.near_by_simhash(U.simhashes(texts(spark, sf_dir))).where("match IS NOT NULL")


@query("op_dup_04_hybrid")
def dup_04(spark, sf_dir):
    return U.hybrid(texts(spark, sf_dir))


@query("op_join_09_cluster_of")
def join_09(spark, sf_dir):
    """All signatures that agree with that of the first document."""
    signatures = U.minhash_signatures(texts(spark, sf_dir))
    one = signatures.orderBy("position").limit(1).select(F.col("signature").alias("s"), F.col("position").alias("asked"))
    scored = signatures.crossJoin(F.broadcast(one)).withColumn("agreement", U.agreement(F.col("signature"), F.col("s")))  # one row
    return scored.where("agreement >= 0.85").select("asked", "position", "agreement")


@query("op_flt_07_exclusions", f"{P._RECORD_SQL} SELECT (SELECT count(*) - count(DISTINCT coalesce(text, '')) FROM documents) AS exact_duplicates, count(*) FILTER (quality < 0.2) AS low_quality, count(*) FILTER (repetition > 0.9) AS repeated, count(*) FILTER (risk > 0.8) AS unsafe FROM r")
def flt_07(spark, sf_dir):
    copies = U.exact(texts(spark, sf_dir)).agg(F.count_if("is_duplicate").alias("exact_duplicates"))
    bad = P.record_metrics(P.samples(spark, sf_dir)).agg(F.count_if(F.col("quality") < 0.2).alias("low_quality"), F.count_if(F.col("repetition") > 0.9).alias("repeated"), F.count_if(F.col("risk") > 0.8).alias("unsafe"))
    return copies.withColumn("k", F.lit(1)).join(bad.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


# ---- merge: orders as main table and as a provider's source

COLUMNS = ["o_orderstatus", "o_totalprice", "o_orderpriority"]


def main_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return M.with_provenance(rows, {"provider": "main", "provider_run_id": "r1"}, ["o_orderkey"]).select("record_uid", "o_orderkey", *COLUMNS)


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders under their old uid, some with another price; low ones come under a uid of a second run."""
    rows = table(spark, sf_dir, "orders").where("o_orderpriority IN ('1-URGENT', '5-LOW')")
    rows = rows.withColumn("o_totalprice", F.when(F.col("o_totalprice") > 250000, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    rows = rows.withColumn("provider_run_id", F.when(F.col("o_orderpriority") == "5-LOW", "r2").otherwise("r1"))
    return M.with_provenance(rows, {"provider": "main"}, ["o_orderkey"]).select("record_uid", "o_orderkey", *COLUMNS)


_MERGE = """WITH m AS (SELECT 'main:r1:' || o_orderkey AS record_uid, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'),
s AS (SELECT 'main:' || CASE WHEN o_orderpriority = '5-LOW' THEN 'r2' ELSE 'r1' END || ':' || o_orderkey AS record_uid, o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 250000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')),
c AS (SELECT s.*, CASE WHEN m.record_uid IS NOT NULL THEN CASE WHEN m.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR m.o_totalprice IS DISTINCT FROM s.o_totalprice OR m.o_orderpriority IS DISTINCT FROM s.o_orderpriority THEN 'updated' ELSE 'skipped' END
  WHEN EXISTS (SELECT 1 FROM m k WHERE k.o_orderkey = s.o_orderkey) THEN 'pk_collision' ELSE 'inserted' END AS status FROM s LEFT JOIN m USING (record_uid))"""
_COUNTS = "SELECT count(*) FILTER (status = 'inserted') AS inserted, count(*) FILTER (status = 'updated') AS updated, count(*) FILTER (status = 'pk_collision') AS pk_collision, count(*) FILTER (status IN ('skipped', 'pk_collision')) AS skipped FROM c"
_RESULT = "SELECT m.record_uid, m.o_orderkey, coalesce(c.o_orderstatus, m.o_orderstatus) AS o_orderstatus, round(CASE WHEN c.status = 'updated' THEN c.o_totalprice ELSE m.o_totalprice END, 2) AS o_totalprice, m.o_orderpriority FROM m LEFT JOIN c ON c.record_uid = m.record_uid AND c.status = 'updated' UNION ALL SELECT record_uid, o_orderkey, o_orderstatus, round(o_totalprice, 2), o_orderpriority FROM c WHERE status = 'inserted'"


def _args(spark, sf_dir):
    return main_table(spark, sf_dir), source_table(spark, sf_dir), "record_uid", "o_orderkey", COLUMNS


@query("op_mrg_01_upsert", f"{_MERGE} {_RESULT}")
def mrg_01(spark, sf_dir):
    return M.merged(*_args(spark, sf_dir)).withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("op_mrg_02_dry_run", f"{_MERGE} {_COUNTS}")
def mrg_02(spark, sf_dir):
    return M.dry_run(*_args(spark, sf_dir))


@query("op_mrg_04_idempotence", f"{_MERGE} SELECT CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated, count(*) FILTER (status = 'pk_collision') AS pk_collision, count(*) AS skipped FROM c")
def mrg_04(spark, sf_dir):
    """Counters of a second merge: nothing new, nothing changed."""
    main, source, *rest = _args(spark, sf_dir)
    return M.dry_run(M.merged(main, source, *rest), source, *rest)


@query("op_mrg_07_provenance", "SELECT o_orderkey, 'main' AS provider, 'r1' AS provider_run_id, 'main:r1:' || o_orderkey AS record_uid FROM orders")
def mrg_07(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    return M.with_provenance(rows, {"provider": "main", "provider_run_id": "r1"}, ["o_orderkey"]).select("o_orderkey", "provider", "provider_run_id", "record_uid")


@query("op_mrg_08_migration_checks", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS missing_uid, CAST(1.0 AS DOUBLE) AS coverage, count(*) - count(DISTINCT o_orderkey) AS collisions FROM orders")
def mrg_08(spark, sf_dir):
    rows = mrg_07(spark, sf_dir)
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.col("record_uid").isNull()).alias("missing_uid"), F.avg(F.col("record_uid").isNotNull().cast("double")).alias("coverage"), (F.count("*") - F.count_distinct("record_uid")).alias("collisions"))


@query("op_mrg_09_state", "SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders")
def mrg_09(spark, sf_dir):
    return _counts(spark, sf_dir, ["customer", "nation", "orders"])


def _counts(spark, sf_dir, names):
    parts = [table(spark, sf_dir, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("op_mrg_05_merge_gates", f"{_MERGE}, k AS ({_COUNTS}), g AS (SELECT inserted + updated + skipped = (SELECT count(*) FROM s) AS g4, (SELECT count(*) FROM ({_RESULT})) = (SELECT count(*) FROM m) + inserted AS g5, pk_collision = 0 AS g6 FROM k) SELECT 'G4' AS gate, CASE WHEN g4 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM g UNION ALL SELECT 'G5', CASE WHEN g5 THEN 'PASS' ELSE 'FAIL' END FROM g UNION ALL SELECT 'G6', CASE WHEN g6 THEN 'PASS' ELSE 'FAIL' END FROM g UNION ALL SELECT 'G8', 'SKIP'")
def mrg_05(spark, sf_dir):
    main, source, *rest = _args(spark, sf_dir)
    counts = M.dry_run(main, source, *rest)
    for name, df in (("n_source", source), ("n_main", main), ("n_merged", M.merged(main, source, *rest))):
        counts = counts.withColumn("k", F.lit(1)).join(df.agg(F.count("*").alias(name)).withColumn("k", F.lit(1)), "k").drop("k")  # one row each
    col = F.col
    return V.gates(counts, {"G4": col("inserted") + col("updated") + col("skipped") == col("n_source"), "G5": col("n_merged") == col("n_main") + col("inserted"), "G6": col("pk_collision") == 0, "G8": F.lit(None).cast("boolean")})


@query("op_join_02_new_rows", f"{_MERGE} SELECT record_uid FROM s WHERE record_uid NOT IN (SELECT record_uid FROM m)")
def join_02(spark, sf_dir):
    main, source = main_table(spark, sf_dir), source_table(spark, sf_dir)
    return source.join(main, "record_uid", "left_anti").select("record_uid")  # uids are never null


@query("op_join_03_drift", f"{_MERGE} SELECT s.record_uid FROM s JOIN m USING (record_uid) WHERE s.o_totalprice IS DISTINCT FROM m.o_totalprice OR s.o_orderstatus IS DISTINCT FROM m.o_orderstatus OR s.o_orderpriority IS DISTINCT FROM m.o_orderpriority")
def join_03(spark, sf_dir):
    main, source = main_table(spark, sf_dir).alias("m"), source_table(spark, sf_dir).alias("s")
    return source.join(main, "record_uid").where(M.drifted(COLUMNS)).select("record_uid")


@query("op_join_04_update", f"{_MERGE} SELECT record_uid, round(o_totalprice, 2) AS o_totalprice FROM ({_RESULT}) WHERE record_uid IN (SELECT record_uid FROM m)")
def join_04(spark, sf_dir):
    main = main_table(spark, sf_dir)
    return M.merged(*_args(spark, sf_dir)).join(main.select("record_uid"), "record_uid", "left_semi").select("record_uid", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("op_join_05_insert_ignore", f"{_MERGE} SELECT record_uid FROM c WHERE status = 'inserted'")
def join_05(spark, sf_dir):
    return M.classified(*_args(spark, sf_dir)).where("status = 'inserted'").select("record_uid")


@query("op_join_13_ledger", f"{_MSGS} SELECT CAST(sum(char_count) AS BIGINT) AS in_table, CAST((SELECT sum(n_chars) FROM documents) AS BIGINT) AS in_ledger, CAST(sum(char_count) - (SELECT sum(n_chars) FROM documents) AS BIGINT) AS delta FROM msgs")
def join_13(spark, sf_dir):
    one = clean(spark, sf_dir).agg(F.sum("char_count").alias("in_table")).withColumn("k", F.lit(1))
    two = table(spark, sf_dir, "documents").agg(F.sum("n_chars").alias("in_ledger")).withColumn("k", F.lit(1))
    return one.join(two, "k", "left").select("in_table", "in_ledger", (F.col("in_table") - F.col("in_ledger")).alias("delta"))  # one row each


@query("op_join_14_run_delta", "SELECT name, n - base AS delta FROM (SELECT 'orders' AS name, count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS base FROM orders UNION ALL SELECT 'customer', count(*), count(*) FROM customer)")
def join_14(spark, sf_dir):
    now = _counts(spark, sf_dir, ["orders", "customer"])
    then = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").agg(F.count("*").alias("base")).select(F.lit("orders").alias("name"), "base").unionByName(table(spark, sf_dir, "customer").agg(F.count("*").alias("base")).select(F.lit("customer").alias("name"), "base"))
    return now.join(then, "name").select("name", (F.col("n") - F.col("base")).alias("delta"))


@query("op_join_15_self_consistency", f"{_CONV} SELECT count(*) AS providers, bool_and(a = b) AS equal FROM (SELECT provider, sum(total_turns) AS a FROM conv GROUP BY 1) FULL JOIN (SELECT provider, count(*) AS b FROM msgs GROUP BY 1) USING (provider)")
def join_15(spark, sf_dir):
    a = metrics(spark, sf_dir).groupBy("provider").agg(F.sum("total_turns").alias("a"))
    b = clean(spark, sf_dir).groupBy("provider").agg(F.count("*").alias("b"))
    return a.join(b, "provider", "full").agg(F.count("*").alias("providers"), F.bool_and(F.coalesce(F.col("a") == F.col("b"), F.lit(False))).alias("equal"))


@query("op_agg_32_uid_collisions", f"{_MERGE} SELECT count(*) - count(DISTINCT record_uid) AS collisions FROM (SELECT record_uid FROM m UNION ALL SELECT record_uid FROM s)")
def agg_32(spark, sf_dir):
    both = main_table(spark, sf_dir).select("record_uid").unionByName(source_table(spark, sf_dir).select("record_uid"))
    return V.unique_violations(both, "record_uid")


@query("op_agg_37_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("region", "nation", "customer", "orders", "documents", "conversations")))
def agg_37(spark, sf_dir):
    return _counts(spark, sf_dir, ["region", "nation", "customer", "orders", "documents", "conversations"])


_FIELDS = ("doc_id", "text", "lang", "source", "n_chars")


@query("op_agg_38_schema_map", " UNION ALL ".join(f"SELECT '{c}' AS field, CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof(any_value({c}))) END AS type, count(*) FILTER ({c} IS NULL) > 0 AS has_null FROM documents" for c in _FIELDS))
def agg_38(spark, sf_dir):
    """Fields, types and whether any value is null."""
    rows = table(spark, sf_dir, "documents")
    nulls = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns))
    entries = F.array(*(F.struct(F.lit(c).alias("field"), F.lit(t).alias("type"), (F.col(c) > 0).alias("has_null")) for c, t in rows.dtypes))
    return nulls.select(F.explode(entries).alias("e")).select("e.*")


# ---- validation

_RULES_SQL = {"empty_text": "length(coalesce(text, '')) = 0", "wrong_n_chars": "n_chars IS DISTINCT FROM length(text)", "no_source": "source IS NULL", "unknown_language": "lang NOT IN ('en', 'de', 'fr', 'es')", "too_long": "length(text) > 1000000"}


@query("op_val_01_row_rules", " UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) FILTER ({c}) AS violations, count(*) FILTER ({c}) = 0 AS passed FROM documents" for n, c in _RULES_SQL.items()))
def val_01(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    rules = {"empty_text": F.length(text) == 0, "wrong_n_chars": ~F.col("n_chars").eqNullSafe(F.length("text")), "no_source": F.col("source").isNull(), "unknown_language": ~F.col("lang").isin("en", "de", "fr", "es"), "too_long": F.length("text") > 1_000_000}
    return V.rule_counts(table(spark, sf_dir, "documents"), rules)


def row_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row metrics of the samples under the reference's names; split, language confidence, tokenizer and duplicate columns have no source here."""
    t, limits = F.col("t"), {"4k": 4096, "8k": 8192, "32k": 32768}
    more = [F.sha2(t, 256).alias("text_sha256"), F.octet_length(t).alias("raw_bytes"), F.length(t).alias("char_count"), F.col("k.words").alias("word_count"), (X.occurrences(t, "\n") + 1).alias("line_count"), P.K.char_tokens(t).alias("token_count")]
    rows = P.record_metrics(P.samples(spark, sf_dir), *more).withColumnsRenamed({"doc_id": "sample_id", "lang": "language", "repetition": "repetition_score", "risk": "safety_risk_score", "quality": "quality_score", "flags": "anomaly_flags"})
    n = F.col("token_count")
    return rows.withColumns({f"context_{k}_fit": n <= m for k, m in limits.items()} | {f"truncation_at_{k}": F.greatest(F.lit(0), n - m) for k, m in limits.items()})


#: Checks of op_val_01_row_metric_rules and when a row of `m` breaks them; those of None have no column in the tables.
_METRIC_RULES = {
    "sample_id": "doc_id IS NULL", "split": None, "source": "source IS NULL", "text_sha256": "length(sha256(t)) <> 64",
    "raw_bytes": "octet_length(encode(t)) < 0", "char_count": "length(t) < 0", "word_count": f"len({P._WT}) < 0", "line_count": "length(t) - length(replace(t, chr(10), '')) + 1 < 0",
    "language": "length(lang) <> 2", "language_confidence": None, "tokenizer_name": None, "tokenizer_version": None, "token_count": f"{P._TOK} < 0",
    "special_token_count": None, "unk_token_count": None, **dict.fromkeys(("context_4k_fit", "context_8k_fit", "context_32k_fit"), f"({P._TOK} <= 4096) IS NULL"),
    **{f"truncation_at_{k}": f"greatest(0, {P._TOK} - {n}) < 0" for k, n in {"4k": 4096, "8k": 8192, "32k": 32768}.items()},
    **{n: f"{c} IS NULL OR {c} < 0 OR {c} > 1" for n, c in {"quality_score": "quality", "entropy_score": "entropy_score", "repetition_score": "repetition", "safety_risk_score": "risk"}.items()},
    "anomaly_flags": "flags IS NULL", "exact_dup_group": None, "near_dup_cluster_id": None,
}
_RULE_COUNTS = ", ".join(
    f"{{'c': '{c}', 's': '{'warning' if c == 'language' else 'error'}', 'n': {'CAST(NULL AS BIGINT)' if x is None else f'count(*) FILTER ({x})' + (' + count(doc_id) - count(DISTINCT doc_id)' if c == 'sample_id' else '')}}}" for c, x in _METRIC_RULES.items()
)


@query("op_val_01_row_metric_rules", f"""{P._RECORD_SQL}, m AS (SELECT r.*, s.t FROM r JOIN s USING (doc_id)), k AS (SELECT unnest([{_RULE_COUNTS}]) AS e FROM m)
SELECT e.c AS "check", e.s AS severity, e.n AS violations, CASE WHEN e.n IS NULL THEN 'SKIP' WHEN e.n = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM k""")
def val_01_metrics(spark, sf_dir):
    """The reference's 14 rule groups; op_val_01_row_rules has rules on the raw documents."""
    return V.row_metric_rules(row_metrics(spark, sf_dir))


@query("op_val_02_required_columns", "SELECT c AS \"column\", c IN (SELECT column_name FROM (DESCRIBE documents)) AS present FROM (SELECT unnest(['doc_id', 'text', 'text_sha256']) AS c)")
def val_02(spark, sf_dir):
    return V.required_columns(table(spark, sf_dir, "documents"), ["doc_id", "text", "text_sha256"])


_GATES_SQL = "SELECT 'R1' AS gate, CASE WHEN count(*) FILTER (source IN ('documentation', 'stackoverflow', 'web_crawl', 'github_code')) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM documents UNION ALL SELECT 'R2', CASE WHEN count(*) = count(DISTINCT doc_id) THEN 'PASS' ELSE 'FAIL' END FROM documents UNION ALL SELECT 'R3', 'SKIP'"


@query("op_val_03_raw_gates", _GATES_SQL)
def val_03(spark, sf_dir):
    row = table(spark, sf_dir, "documents").agg(F.count_if(F.col("source").isin("documentation", "stackoverflow", "web_crawl", "github_code")).alias("banned"), F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))
    return V.gates(row, {"R1": F.col("banned") == 0, "R2": F.col("n") == F.col("ids"), "R3": F.lit(None).cast("boolean")})


@query("op_val_03_reference_gates", f"""WITH g AS (SELECT count(*) AS n, count(*) FILTER (source IN ({', '.join(f"'{s}'" for s in V.BANNED_SOURCES)})) AS banned FROM documents)
SELECT 'R1' AS gate, CASE WHEN banned = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM g UNION ALL SELECT 'R2', 'PASS' FROM g UNION ALL SELECT 'R3', CASE WHEN n = 10000 AND banned > 0 THEN 'FAIL' ELSE 'PASS' END FROM g
UNION ALL SELECT unnest(['R4', 'R5']), 'SKIP' FROM g""")
def val_03_reference(spark, sf_dir):
    """R1-R5 as the reference defines them; the tables bring no ledger, so R4 and R5 are SKIP."""
    return V.raw_gates(table(spark, sf_dir, "documents"))


@query("op_val_05_failures", f"SELECT gate, 'rerun ' || gate AS remedy FROM ({_GATES_SQL}) WHERE verdict = 'FAIL'")
def val_05(spark, sf_dir):
    return val_03(spark, sf_dir).where("verdict = 'FAIL'").select("gate", F.concat(F.lit("rerun "), "gate").alias("remedy"))


@query("op_val_06_verifier", f"{P._QUALITY_SQL} SELECT count(*) AS n, avg(quality) >= 0.5 AS mean_ok, avg(CAST(quality < 0.3 AS INT)) < 0.3 AS low_ok FROM q")
def val_06(spark, sf_dir):
    return P.message_quality(P.samples(spark, sf_dir)).agg(F.count("*").alias("n"), (F.avg("quality") >= 0.5).alias("mean_ok"), (F.avg((F.col("quality") < 0.3).cast("int")) < 0.3).alias("low_ok"))


@query("op_val_04_checksums")  # DuckDB SQL has no path of its tables
def val_04(spark, sf_dir):
    """Length and sha256 of the table files themselves."""
    return E.file_shards(spark, [f"{sf_dir}/nation.parquet", f"{sf_dir}/region.parquet"]).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "sha256")


def _digest_sql(name: str, columns: str) -> str:
    """Sums of two 48-bit parts of each row's hash; columns in order of their names."""
    half = lambda a: f"CAST(sum(CAST('0x' || h[{a}:{a + 11}] AS UBIGINT)) AS VARCHAR)"
    return f"SELECT count(*) AS n, sha256({half(1)} || ':' || {half(13)}) AS digest, '{name}' AS name FROM (SELECT sha256(to_json({{{', '.join(f"'{c}': {c}" for c in columns.split())}}})) AS h FROM {name})"


@query("op_val_07_reproducibility", _digest_sql("nation", "n_name n_nationkey n_regionkey") + " UNION ALL " + _digest_sql("customer", "c_acctbal c_custkey c_mktsegment c_name c_nationkey"))
def val_07(spark, sf_dir):
    """Digests of tables that do not depend on row order."""
    names = ["nation", "customer"]
    parts = [V.table_digest(table(spark, sf_dir, n)).withColumn("name", F.lit(n)) for n in names]
    return parts[0].unionByName(parts[1])


# ---- schemas

_PROPS = "SELECT '$' AS path, 'object' AS types, count(*) AS n, CAST(1 AS DOUBLE) AS presence, false AS optional FROM events WHERE props IS NOT NULL UNION ALL SELECT '$.k', 'int', count(*), CAST(1 AS DOUBLE), false FROM events WHERE props IS NOT NULL"


@query("op_sch_01_inference", f"SELECT path, types, n FROM ({_PROPS})")
def sch_01(spark, sf_dir):
    return S.inferred(S.path_types(table(spark, sf_dir, "events"), "props")).select("path", "types", "n")


@query("op_sch_02_optionality", f"SELECT path, presence, optional FROM ({_PROPS})")
def sch_02(spark, sf_dir):
    return S.inferred(S.path_types(table(spark, sf_dir, "events"), "props")).select("path", "presence", "optional")


@query("op_sch_03_fingerprint", "SELECT count(*) AS n, 'chatgpt' AS provider FROM (SELECT DISTINCT conv_id FROM conversations)")
def sch_03(spark, sf_dir):
    keys = F.expr("json_object_keys(raw)")
    return raw_exports(spark, sf_dir, "chatgpt").select(S.fingerprint(keys, F.lit("chatgpt.json")).alias("provider")).groupBy("provider").agg(F.count("*").alias("n"))


@query("op_sch_04_anomalies", "SELECT '$' AS path, 'malformed' AS anomaly, count(*) AS n FROM documents")
def sch_04(spark, sf_dir):
    """Texts that are no JSON, empty lists and empty objects; here every text with a suffix that breaks it."""
    broken = table(spark, sf_dir, "documents").select(F.concat(F.lit("{"), F.coalesce("text", F.lit(""))).alias("raw"))
    return S.anomalies(S.path_types(broken, "raw"))


# ---- sources: each provider's export, made from conversations, read back


def raw_exports(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    """One JSON text per conversation in the provider's shape."""
    rows = clean(spark, sf_dir).withColumn("id", F.concat_ws("-", "conversation_id", "turn"))
    rows = rows.withColumn("iso", F.date_format(F.timestamp_seconds("create_time"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    by = lambda item: rows.groupBy("conversation_id").agg(F.array_sort(F.collect_list(F.struct("turn", item.alias("v")))).alias("x"))
    entry = lambda v: F.struct(F.col("id").alias("key"), v.alias("value"))
    nodes = F.map_from_entries(F.transform("x", lambda e: e["v"]))
    cid = F.col("conversation_id").cast("string")
    if provider == "chatgpt":
        node = F.struct(F.col("id"), F.lit(None).cast("string").alias("parent"), F.struct(F.struct("role").alias("author"), F.struct(F.array("text").alias("parts")).alias("content"), "create_time").alias("message"))
        out = by(entry(node)).select("conversation_id", F.struct(cid.alias("id"), F.lit("t").alias("title"), F.lit(1.0).alias("create_time"), F.lit(2.0).alias("update_time"), nodes.alias("mapping")).alias("o"))
    elif provider == "claude":
        sender = F.when(F.col("role") == "user", "human").otherwise(F.col("role"))
        item = F.struct(F.col("id").alias("uuid"), F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise("").alias("text"), sender.alias("sender"), F.col("iso").alias("created_at"), F.array(F.struct(F.lit("text").alias("type"), F.col("text"))).alias("content"))
        out = by(item).select("conversation_id", F.struct(cid.alias("uuid"), F.lit("t").alias("name"), F.transform("x", lambda e: e["v"]).alias("chat_messages")).alias("o"))
    elif provider == "deepseek":
        kind = F.when(F.col("role") == "user", "REQUEST").otherwise("RESPONSE")
        parts = F.array(F.struct(F.lit("THINK").alias("type"), F.lit("hm").alias("content")), F.struct(kind.alias("type"), F.col("text").alias("content")))
        out = by(entry(F.struct(F.struct(F.col("iso").alias("inserted_at"), parts.alias("fragments")).alias("message")))).select("conversation_id", F.struct(cid.alias("id"), F.lit("t").alias("title"), nodes.alias("mapping")).alias("o"))
    else:
        answer = F.array(F.struct(F.lit("think").alias("phase"), F.lit("hm").alias("content")), F.struct(F.lit("answer").alias("phase"), F.col("text").alias("content")))
        node = F.struct("role", F.when(F.col("role") == "user", F.col("text")).alias("content"), F.when(F.col("role") != "user", answer).alias("content_list"), F.col("create_time").alias("timestamp"))
        out = by(entry(node)).select("conversation_id", F.struct(cid.alias("id"), F.lit("t").alias("title"), F.struct(F.struct(nodes.alias("messages")).alias("history")).alias("chat")).alias("o"))
    return out.select(F.to_json("o").alias("raw"))


_STRIPPED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"


def _source(op: str, provider: str, stripped: bool = True):
    who = "role" if provider != "deepseek" else "CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role"

    @query(op, f"{_MSGS} SELECT CAST(conversation_id AS VARCHAR) AS conversation_id, conversation_id || '-' || turn AS message_id, {who}, sha256({_STRIPPED if stripped else 'text'}) AS sha, create_time FROM msgs")
    def run(spark, sf_dir):
        rows = raw_exports(spark, sf_dir, provider).select(F.from_json("raw", E.SCHEMAS[provider]).alias("r")).select("r.*")
        return E.READERS[provider](rows).select("conversation_id", "message_id", "role", F.sha2("text", 256).alias("sha"), "create_time")


_source("op_src_05_chatgpt", "chatgpt", False)
_source("op_src_13_claude", "claude")
_source("op_src_15_deepseek", "deepseek")
_source("op_src_16_qwen", "qwen")


@query("op_win_11_parent_links", f"{_MSGS} SELECT conversation_id || '-' || turn AS message_id, lag(conversation_id || '-' || turn) OVER (PARTITION BY conversation_id ORDER BY create_time, conversation_id || '-' || turn) AS parent_id FROM msgs")
def win_11(spark, sf_dir):
    rows = raw_exports(spark, sf_dir, "claude").select(F.from_json("raw", E.CLAUDE).alias("r")).select("r.*")
    return E.claude(rows).select("message_id", "parent_id")


@query("op_src_03_json_lines", "SELECT 'good' AS kind, count(*) AS n FROM events WHERE props IS NOT NULL UNION ALL SELECT 'bad', count(*) FROM events WHERE props IS NOT NULL")
def src_03(spark, sf_dir):
    """Good and malformed lines of a payload in which each record comes once whole and once cut."""
    rows = table(spark, sf_dir, "events").where("props IS NOT NULL").select(F.concat("props", F.lit(",\n\n"), F.expr("substring(props, 1, length(props) - 1)")).alias("payload"))
    good, bad = E.text_payload(rows, "payload", "k long")
    return good.agg(F.count("*").alias("n")).select(F.lit("good").alias("kind"), "n").unionByName(bad.agg(F.count("*").alias("n")).select(F.lit("bad").alias("kind"), "n"))


@query("op_src_06_first_timestamp", "SELECT CAST(conv_id AS VARCHAR) AS id, CAST(1 AS DOUBLE) AS created_at FROM conversations WHERE role <> 'system' GROUP BY 1")
def src_06(spark, sf_dir):
    rows = raw_exports(spark, sf_dir, "chatgpt").select(F.from_json("raw", E.CHATGPT).alias("r")).select("r.*")
    return rows.select("id", E.first_time(rows).alias("created_at"))


@query("op_src_18_read_back", "SELECT n_nationkey, n_name FROM nation")
def src_18(spark, sf_dir):
    return E.any_records(spark, f"{sf_dir}/nation.parquet", "").select("n_nationkey", "n_name")


@query("op_src_22_number_scrape", r"SELECT doc_id, TRY_CAST(replace(regexp_extract(coalesce(text, ''), '([0-9][0-9,]*)', 1), ',', '') AS DOUBLE) AS number FROM documents")
def src_22(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", E.scraped_number(F.coalesce("text", F.lit("")), "([0-9][0-9,]*)").alias("number"))


@query("op_snk_09_june_chunk", f"{_MSGS}, b AS (SELECT conversation_id, turn, regexp_replace(text[1:2500], '\\n{{3,}}', chr(10) || chr(10), 'g') AS body FROM msgs WHERE strftime(to_timestamp(create_time) AT TIME ZONE 'UTC', '%m') = '06') SELECT conversation_id, turn, CAST(octet_length(encode(body)) AS BIGINT) AS bytes, sum(octet_length(encode(body))) OVER (ORDER BY conversation_id, turn) <= 100000 AS fits FROM b")
def snk_09(spark, sf_dir):
    """Bodies of one month and whether each still fits a byte budget in order; sums by conversation and by range of them keep the running sum off any one task."""
    rows = clean(spark, sf_dir).where(F.month(F.timestamp_seconds("create_time")) == 6)
    body = F.regexp_replace(F.substring("text", 1, 2500), "\n{3,}", "\n\n")
    sized = rows.select("conversation_id", "turn", F.octet_length(body).cast("long").alias("bytes"))
    by = sized.groupBy("conversation_id").agg(F.sum("bytes").alias("all"))
    before = C.running_total(by, "conversation_id", "all", "before").select("conversation_id", (F.col("before") - F.col("all")).alias("before"))
    running = F.col("before") + F.sum("bytes").over(Window.partitionBy("conversation_id").orderBy("turn"))
    return sized.join(before, "conversation_id").select("conversation_id", "turn", "bytes", (running <= 100000).alias("fits"))


# ---- report frames


@query("op_rpt_01_phase_space", f"{P._RECORD_SQL} SELECT doc_id, round(greatest(0.0, least(1.0, (1 - quality) * (0.65 + repetition))), 6) AS risk, round(greatest(0.0, least(1.0, quality * (0.55 + entropy_score))), 6) AS stability FROM r")
def rpt_01(spark, sf_dir):
    r = P.record_metrics(P.samples(spark, sf_dir))
    return P._out(r.select("doc_id", X.clamped((1 - F.col("quality")) * (0.65 + F.col("repetition"))).alias("risk"), X.clamped(F.col("quality") * (0.55 + F.col("entropy_score"))).alias("stability")))


@query("op_rpt_02_normal_histogram", f"{P._RECORD_SQL}, h AS (SELECT CAST(least(floor(quality * 10 + 1e-9), 9) AS BIGINT) AS bin, count(*) AS n FROM r GROUP BY 1) SELECT bin, round(CAST(n AS DOUBLE) / max(n) OVER (), 6) AS height FROM h")
def rpt_02(spark, sf_dir):
    h = P.record_metrics(P.samples(spark, sf_dir)).groupBy(F.least(F.floor(F.col("quality") * 10 + 1e-9), F.lit(9)).alias("bin")).agg(F.count("*").alias("n"))
    top = h.agg(F.max("n").alias("top"))
    return P._out(h.join(F.broadcast(top)).select("bin", (F.col("n") / F.col("top").cast("double")).alias("height")))  # one row


@query("op_rpt_03_truncation_pressure", f"{P._BASE}, k AS (SELECT greatest(1, length(t) // 4) AS a FROM s) SELECT '4k' AS label, round(avg(greatest(0, a - 4096)) / 100 * (1 + (1 - avg(CAST(a <= 4096 AS INT)))), 6) AS pressure FROM k UNION ALL SELECT '8k', round(avg(greatest(0, a - 8192)) / 100 * (1 + (1 - avg(CAST(a <= 8192 AS INT)))), 6) FROM k")
def rpt_03(spark, sf_dir):
    a = P.two_tokenizers(spark, sf_dir).select("a")
    row = a.agg(*(x for n, w in (("4k", 4096), ("8k", 8192)) for x in (F.avg(F.greatest(F.lit(0), F.col("a") - w)).alias(f"c{n}"), F.avg((F.col("a") <= w).cast("int")).alias(f"f{n}"))))
    entries = F.array(*(F.struct(F.lit(n).alias("label"), (F.col(f"c{n}") / 100 * (1 + (1 - F.col(f"f{n}")))).alias("pressure")) for n in ("4k", "8k")))
    return P._out(row.select(F.explode(entries).alias("e")).select("e.*"))


@query("op_rpt_04_network", "SELECT 'corpus' AS source, lang AS target, count(*) AS weight FROM documents GROUP BY 2 UNION ALL SELECT lang, source, count(*) FROM documents GROUP BY 1, 2")
def rpt_04(spark, sf_dir):
    """Weighted links of the report's star graph."""
    d = table(spark, sf_dir, "documents")
    hub = d.groupBy(F.col("lang").alias("target")).agg(F.count("*").alias("weight")).select(F.lit("corpus").alias("source"), "target", "weight")
    return hub.unionByName(d.groupBy(F.col("lang").alias("a"), F.col("source").alias("b")).agg(F.count("*").alias("weight")).select(F.col("a").alias("source"), F.col("b").alias("target"), "weight"))


@query("op_rpt_05_retained", f"{P._RECORD_SQL} SELECT count(*) AS total, count(*) FILTER (quality >= 0.4) AS retained, count(*) FILTER (quality < 0.4) AS interventions FROM r")
def rpt_05(spark, sf_dir):
    return P.record_metrics(P.samples(spark, sf_dir)).agg(F.count("*").alias("total"), F.count_if(F.col("quality") >= 0.4).alias("retained"), F.count_if(F.col("quality") < 0.4).alias("interventions"))


@query("op_top_06_label_order", "SELECT * FROM (VALUES ('4k', 4.0, 1), ('8k', 8.0, 2), ('32k', 32.0, 3), ('128k', 128.0, 4)) AS t(label, size, place)")
def top_06(spark, sf_dir):
    """Labels with units in numeric order."""
    rows = spark.createDataFrame([("128k",), ("4k",), ("32k",), ("8k",)], "label string")
    size = F.regexp_replace("label", "[^0-9.]", "").cast("double")
    return rows.withColumn("size", size).withColumn("all", F.lit(1)).select("label", F.col("size"), F.row_number().over(Window.partitionBy("all").orderBy("size")).alias("place"))
