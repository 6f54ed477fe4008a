"""Conversation metrics, selection and their rollups over the table conversations.

The table's texts are invented, so phrases of the lexicons hardly occur in them. PLANTED
appends one of a fixed set of phrases to each message, by conversation and turn, on both
sides; times, titles and providers are derived from the ids in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..operators import conversations as C
from ..operators import distill as D
from .registry import query, spread, table

PLANTED = [
    " actually, i meant the other bug in the parser",
    " you're right, absolutely",
    " let's verify the design together",
    " ```print(1)``` Error: failed >>> $",
    " deploy the docker container with kind: Pod apiVersion: v1",
    " i agree exactly, excellent great point",
    " rlhf dpo reward training data pipeline csv json",
    " maybe i think perhaps what if",
    " that's not right, try again",
    " | a | b | c | d |",
    " run the code in the terminal and execute the output",
    "",
    "",
    " let's design a system together, we can partner",
    "",
    "",
]
#: Words that both sides of every third conversation share, so that all branches of the information gain are met.
SHARED = " " + " ".join(f"shared{i}" for i in range(80))
BUDGET = 60_000


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns with planted phrases, create_time and provider."""
    rows = table(spark, sf_dir, "conversations")
    phrase = F.get(F.array(*map(F.lit, PLANTED)), F.pmod(F.col("conv_id") * 31 + F.col("turn") * 7, F.lit(len(PLANTED))).cast("int"))
    made = rows.select(
        F.col("conv_id").alias("conversation_id"),
        "turn",
        "role",
        F.concat(F.coalesce("text", F.lit("")), phrase, F.when(F.col("conv_id") % 3 == 0, SHARED).otherwise("")).alias("text"),
        (1700000000 + F.col("conv_id") * 200000 + F.col("turn") * 60).cast("double").alias("create_time"),
        F.concat(F.lit("p"), (F.col("conv_id") % 4).cast("string")).alias("provider"),
    )
    return spread(made, "conversation_id")


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """title, created_at, updated_at and provider of each conversation."""
    return messages(spark, sf_dir).groupBy("conversation_id").agg(F.concat(F.lit("data "), F.col("conversation_id").cast("string")).alias("title"), F.min("create_time").alias("created_at"), F.max("create_time").alias("updated_at"), F.min("provider").alias("provider"))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_messages(messages(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods come from narrow rows, so the metrics themselves are worked out once."""
    turns, head = clean(spark, sf_dir), heads(spark, sf_dir)
    there = head.select("conversation_id", "created_at").join(turns.select("conversation_id").distinct(), "conversation_id", "left_semi")
    periods = C.with_period(there, ["created_at", "conversation_id"]).select("conversation_id", "period")
    rows = C.conversation_metrics(turns, head).join(periods, "conversation_id")
    return rows.withColumn("provider", F.concat(F.lit("p"), (F.col("conversation_id") % 4).cast("string")))


def exact_tokens(spark: SparkSession, sf_dir: str) -> int:
    """Stand-in for exact counts: a quarter of the characters of each message, at least 1."""
    return clean(spark, sf_dir).agg(F.coalesce(F.sum(F.greatest(F.lit(1), F.floor(F.col("char_count") / 4))), F.lit(0))).first()[0]


POLICY = D.Policy(token_budget_min=20_000, token_budget_max=BUDGET)


def distilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.distil(metrics(spark, sf_dir), exact_tokens(spark, sf_dir), POLICY)


# ---- the same in SQL


def _list(items: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def _hits(column: str, phrases: list[str]) -> str:
    return f"len(list_filter({_list(phrases)}, lambda p: contains({column}, p)))"


def _tone(column: str) -> str:
    names = list(L.TONES)
    scores = "[" + ", ".join(_hits(column, L.TONES[n]) for n in names) + "]"
    return f"(SELECT CASE WHEN list_max(s) = 0 THEN 'neutral' ELSE {_list(names)}[list_position(s, list_max(s))] END FROM (SELECT {scores} AS s))"


_WORDS = r"list_filter(regexp_split_to_array(lower({0}), '\s+'), lambda w: w <> '')"
_TOPICS = list(L.TOPICS)
_BASE = f"""
WITH src AS (
  SELECT conv_id AS conversation_id, turn, role, coalesce(text, '') || {_list(PLANTED)}[CAST((conv_id * 31 + turn * 7) % {len(PLANTED)} AS INT) + 1] || CASE WHEN conv_id % 3 = 0 THEN '{SHARED}' ELSE '' END AS text,
    CAST(1700000000 + conv_id * 200000 + turn * 60 AS DOUBLE) AS create_time, 'p' || (conv_id % 4) AS provider
  FROM conversations),
heads AS (SELECT conversation_id, 'data ' || conversation_id AS title, min(create_time) AS created_at, max(create_time) AS updated_at FROM src GROUP BY 1),
msgs AS (
  SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY create_time, turn) - 1 AS position, length(text) AS char_count, lower(text) AS lt
  FROM src WHERE role <> 'system' AND trim(text) <> '')
"""
_CONV = (
    _BASE
    + f"""
, tones AS (SELECT *, {_tone('lt')} AS tone FROM msgs),
marked AS (SELECT *, lag(tone) OVER (PARTITION BY conversation_id ORDER BY position) AS prev FROM tones),
agg AS (
  SELECT conversation_id, count(*) AS n, count(*) FILTER (role = 'user') AS un, count(*) FILTER (role = 'assistant') AS an,
    coalesce(string_agg(text, ' ' ORDER BY position) FILTER (role = 'user'), '') AS utx, coalesce(string_agg(text, ' ' ORDER BY position) FILTER (role = 'assistant'), '') AS atx,
    count(*) FILTER (prev IS NOT NULL AND prev <> tone) AS shifts,
    count(*) FILTER (role = 'user' AND position > 0 AND {_hits('lt', L.CORRECTIONS)} > 0) AS corrections,
    count(*) FILTER (role = 'assistant' AND {_hits('lt', L.SYCOPHANCY)} >= 2) AS flattering
  FROM marked GROUP BY 1),
ws AS (SELECT *, {_WORDS.format('utx')} AS uw, {_WORDS.format('atx')} AS aw, utx || ' ' || atx AS allt FROM agg),
sims AS (SELECT *, len(list_distinct(uw)) AS ud, len(list_distinct(aw)) AS ad, len(list_distinct(list_concat(uw, aw))) AS bd,
  list_transform(range(1, len(aw) - 1), lambda i: aw[i] || chr(1) || aw[i + 1] || chr(1) || aw[i + 2]) AS tri,
  list_transform({_list(_TOPICS)}, lambda t: 0) AS zeros FROM ws JOIN heads USING (conversation_id)),
scored AS (SELECT *, CASE WHEN ud = 0 OR ad = 0 THEN NULL ELSE CAST(ud + ad - bd AS DOUBLE) / bd END AS sim,
  [{', '.join(_hits("lower(title || ' ' || allt)", L.TOPICS[t]) for t in _TOPICS)}] AS ts,
  row_number() OVER (ORDER BY created_at, conversation_id) - 1 AS idx, count(*) OVER () AS convs FROM sims),
ranks AS (SELECT conversation_id AS cid, list(t ORDER BY -s, i) AS topics FROM (SELECT conversation_id, unnest({_list(_TOPICS)}) AS t, unnest(ts) AS s, unnest(range({len(_TOPICS)})) AS i FROM scored) WHERE s > 0 GROUP BY 1),
conv AS (
  SELECT conversation_id, title, created_at, updated_at, 'p' || (conversation_id % 4) AS provider, n AS total_turns, un AS user_turns, an AS assistant_turns, (updated_at - created_at) / 60 AS duration_minutes,
    CAST(trunc(len(uw) * CAST(1.3 AS DOUBLE)) AS BIGINT) AS user_tokens, CAST(trunc(len(aw) * CAST(1.3 AS DOUBLE)) AS BIGINT) AS assistant_tokens,
    CAST(trunc(len(uw) * CAST(1.3 AS DOUBLE)) AS BIGINT) + CAST(trunc(len(aw) * CAST(1.3 AS DOUBLE)) AS BIGINT) AS total_tokens,
    CAST(trunc(len(uw) * CAST(1.3 AS DOUBLE)) AS DOUBLE) / greatest(trunc(len(aw) * CAST(1.3 AS DOUBLE)), 1) AS token_ratio,
    CASE WHEN ud > 1 THEN (SELECT -sum(c / t * log2(c / t)) FROM (SELECT CAST(count(*) AS DOUBLE) AS c, CAST(len(uw) AS DOUBLE) AS t FROM (SELECT unnest(uw) AS w) GROUP BY w)) / log2(ud) ELSE 0.0 END AS user_entropy,
    CASE WHEN len(uw) + len(aw) > 0 THEN CAST(bd AS DOUBLE) / (len(uw) + len(aw)) ELSE 0.0 END AS semantic_density,
    CASE WHEN sim IS NULL THEN 0.5 WHEN sim >= 0.15 AND sim <= 0.45 THEN 0.6 + (0.4 - sim) ELSE 0.4 + sim * 0.3 END AS information_gain,
    CASE WHEN len(aw) >= 3 THEN 1 - CAST(len(list_distinct(tri)) AS DOUBLE) / len(tri) ELSE 0.0 END AS repetition_score,
    CASE WHEN n > 1 THEN CAST(shifts AS DOUBLE) / (n - 1) ELSE 0.0 END AS tone_shift,
    CASE WHEN an > 0 THEN CAST(flattering AS DOUBLE) / an ELSE 0.0 END AS malicious_compliance,
    coalesce(topics[1], 'general') AS topic_primary, array_to_string(coalesce(topics[2:4], []), ',') AS topic_secondary,
    {_tone('lower(allt)')} AS tone_cluster,
    (length(allt) - length(replace(allt, '```', ''))) // 3 AS code_blocks, len(regexp_extract_all(allt, '>>>|\\$|# Output:|Error:')) AS terminal_outputs,
    CAST(length(allt) - length(replace(allt, '|', '')) > 4 AS INT) AS tables, len(regexp_extract_all(allt, 'kind:|apiVersion:|metadata:|spec:')) AS manifests,
    corrections AS correction_events, CAST(least(5, idx // greatest(1, convs // 5) + 1) AS INT) AS period
  FROM scored LEFT JOIN ranks ON cid = conversation_id)
"""
)
_GATED = (
    _CONV
    + f"""
, exact AS (SELECT sum(greatest(1, char_count // 4)) AS e FROM msgs), heur AS (SELECT sum(total_tokens) AS h FROM conv),
judged AS (SELECT conv.*, information_gain >= 0.40 AND malicious_compliance <= 0.35 AND user_entropy >= 0.40 AND total_tokens >= 100 AND repetition_score <= 0.60 AS passed,
  CASE WHEN information_gain < 0.4 THEN 'info_gain=' || printf('%.3f', information_gain) || '<0.4'
    WHEN malicious_compliance > 0.35 THEN 'malicious_compliance=' || printf('%.3f', malicious_compliance) || '>0.35'
    WHEN user_entropy < 0.4 THEN 'user_entropy=' || printf('%.3f', user_entropy) || '<0.4'
    WHEN total_tokens < 100 THEN 'total_tokens=' || total_tokens || '<100'
    WHEN repetition_score > 0.6 THEN 'repetition_score=' || printf('%.3f', repetition_score) || '>0.6'
    ELSE 'quality_gate_pass: info_gain=' || printf('%.3f', information_gain) || '; malicious_compliance=' || printf('%.3f', malicious_compliance) || '; entropy=' || printf('%.3f', user_entropy) END AS reason,
  CASE WHEN information_gain >= 0.65 AND malicious_compliance <= 0.15 AND correction_events > 0 THEN 'gold' WHEN information_gain >= 0.55 AND malicious_compliance <= 0.25 THEN 'silver' ELSE 'bronze' END AS quality_tier,
  CAST(trunc(total_tokens * (CAST(e AS DOUBLE) / greatest(h, 1))) AS BIGINT) AS canonical_tokens FROM conv, exact, heur)
"""
)


def _rounded(df: DataFrame, keys: tuple[str, ...] = ("created_at", "updated_at")) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t in ("int", "bigint") else F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes))


_KINDS = {"token_ratio": "d", "user_entropy": "d", "semantic_density": "d", "information_gain": "d", "repetition_score": "d", "tone_shift": "d", "malicious_compliance": "d", "duration_minutes": "d", "created_at": "d", "updated_at": "d", "topic_primary": "s", "topic_secondary": "s", "tone_cluster": "s", "title": "s", "provider": "s", "quality_tier": "s", "reason": "s", "passed": "s", "selected": "s"}


def _sql_cols(names: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if _KINDS.get(c) == "d" else c if _KINDS.get(c) else f"CAST({c} AS BIGINT) AS {c}" for c in names)


def _metric(op: str, *names: str) -> None:
    cols = ["conversation_id", *names]

    @query(op, f"{_CONV} SELECT {_sql_cols(cols)} FROM conv")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(metrics(spark, sf_dir).select(*cols))


_metric("op_txt_01_heuristic_tokens", "user_tokens", "assistant_tokens", "total_tokens", "token_ratio")
_metric("op_txt_02_user_entropy", "user_entropy")
_metric("op_txt_03_semantic_density", "semantic_density")
_metric("op_txt_04_trigram_repetition", "repetition_score")
_metric("op_txt_05_information_gain", "information_gain")
_metric("op_txt_06_tone", "tone_cluster")
_metric("op_txt_07_sycophancy", "malicious_compliance")
_metric("op_txt_08_topics", "topic_primary", "topic_secondary")
_metric("op_txt_09_artifacts", "code_blocks", "terminal_outputs", "tables", "manifests")
_metric("op_txt_10_duration", "duration_minutes")
_metric("op_win_01_period", "period")
_metric("op_win_02_tone_shift", "tone_shift")
_metric("op_win_03_corrections", "correction_events")
_metric("op_snk_01_conversation_table", "title", "created_at", "updated_at", "total_turns", "user_turns", "assistant_turns", "duration_minutes", "total_tokens", "user_entropy", "semantic_density", "information_gain", "repetition_score", "tone_shift", "malicious_compliance", "topic_primary", "tone_cluster", "code_blocks", "correction_events", "period")


@query("op_src_11_messages", f"{_BASE} SELECT conversation_id, turn, role, sha256(text) AS text_sha256, position, CAST(char_count AS BIGINT) AS char_count, CAST(len({_WORDS.format('text')}) AS BIGINT) AS word_count FROM msgs")
def src_11(spark, sf_dir):
    return clean(spark, sf_dir).select("conversation_id", "turn", "role", F.sha2("text", 256).alias("text_sha256"), F.col("position").cast("long"), F.col("char_count").cast("long"), F.col("word_count").cast("long"))


@query("op_flt_01_message_filter", f"{_BASE} SELECT role, count(*) AS n, CAST(sum(char_count) AS BIGINT) AS chars FROM msgs GROUP BY 1")
def flt_01(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.sum("char_count").alias("chars"))


@query("op_src_20_record_text", r"""SELECT conv_id, sha256(string_agg('[' || coalesce(role, '') || ']: ' || coalesce(text, ''), chr(10) || chr(10) ORDER BY turn)) AS text_sha256 FROM conversations GROUP BY 1""")
def src_20(spark, sf_dir):
    """A record's text from its messages."""
    from ..sources.records import text_of_messages

    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    return rows.select("conv_id", F.sha2(text_of_messages(F.col("messages")), 256).alias("text_sha256"))


# ---- gate, tiers, budget


@query("op_flt_02_quality_gate", f"{_GATED} SELECT conversation_id, passed, reason FROM judged")
def flt_02(spark, sf_dir):
    return distilled(spark, sf_dir).select("conversation_id", "passed", "reason")


@query("op_flt_03_quality_tier", f"{_GATED} SELECT conversation_id, quality_tier FROM judged")
def flt_03(spark, sf_dir):
    return metrics(spark, sf_dir).select("conversation_id", D.tier().alias("quality_tier"))


#: The fold in SQL: a recursive walk over the ranked rows.
_FOLD = (
    _GATED.replace("WITH src", "WITH RECURSIVE src", 1)
    + f"""
, ranked AS (SELECT conversation_id, canonical_tokens AS t, row_number() OVER (ORDER BY information_gain DESC, conversation_id) AS r FROM judged WHERE passed),
walk AS (SELECT 0 AS r, CAST(0 AS HUGEINT) AS used, CAST(NULL AS BIGINT) AS conversation_id, false AS selected
  UNION ALL SELECT ranked.r, CASE WHEN used + t <= {BUDGET} THEN used + t ELSE used END, ranked.conversation_id, used + t <= {BUDGET} FROM walk JOIN ranked ON ranked.r = walk.r + 1),
dist AS (SELECT judged.*, coalesce(selected, false) AS selected FROM judged LEFT JOIN walk USING (conversation_id))
"""
)


@query("op_win_04_budget_selection", f"{_FOLD} SELECT conversation_id, selected, CASE WHEN passed THEN canonical_tokens END AS canonical_tokens FROM dist")
def win_04(spark, sf_dir):
    return distilled(spark, sf_dir).select("conversation_id", "selected", F.when(F.col("passed"), F.col("canonical_tokens")).alias("canonical_tokens"))


@query("op_snk_02_distilled_table", f"{_FOLD} SELECT conversation_id, canonical_tokens AS total_tokens, quality_tier, reason AS inclusion_reason, period, provider FROM dist WHERE selected")
def snk_02(spark, sf_dir):
    return distilled(spark, sf_dir).where("selected").select("conversation_id", F.col("canonical_tokens").alias("total_tokens"), "quality_tier", F.col("reason").alias("inclusion_reason"), "period", "provider")


@query(
    "op_agg_39_distillation_manifest",
    f"""{_FOLD} SELECT count(*) AS input_conversations, count(*) FILTER (passed) AS quality_passed, count(*) FILTER (NOT passed) AS quality_rejected, count(*) FILTER (passed AND NOT selected) AS budget_trimmed,
  count(*) FILTER (selected) AS distilled_conversations, CAST(coalesce(sum(canonical_tokens) FILTER (selected), 0) AS BIGINT) AS distilled_tokens_selected, CAST(sum(total_tokens) AS BIGINT) AS heuristic_total,
  CASE WHEN sum(canonical_tokens) FILTER (selected) < 20000 THEN 'under_band' WHEN sum(canonical_tokens) FILTER (selected) > {BUDGET} THEN 'over_band' ELSE 'in_band' END AS budget_status,
  round(CAST(sum(canonical_tokens) FILTER (selected) AS DOUBLE) / any_value(e), 6) AS distilled_fraction, round(CAST(any_value(e) AS DOUBLE) / sum(total_tokens), 6) AS heuristic_scale_factor FROM dist, exact""",
)
def agg_39(spark, sf_dir):
    exact = exact_tokens(spark, sf_dir)
    return _rounded(D.manifest(D.distil(metrics(spark, sf_dir), exact, POLICY), exact, POLICY))


# ---- rollups over conversations

def _roll(op: str, sql: str, build, base: str = "conv") -> None:
    """build gets the metrics (base conv) or the distilled rows (dist) and returns the rollup."""
    prelude = _CONV if base == "conv" else _FOLD

    @query(op, f"{prelude} {sql}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(build(metrics(spark, sf_dir) if base == "conv" else distilled(spark, sf_dir)))



_roll("op_agg_01_totals", "SELECT count(*) AS conversations, CAST(sum(total_turns) AS BIGINT) AS turns, CAST(sum(total_tokens) AS BIGINT) AS tokens, round(avg(information_gain), 6) AS avg_ig, round(avg(malicious_compliance), 6) AS avg_mc, round(avg(token_ratio), 6) AS avg_ratio, CAST(sum(correction_events) AS BIGINT) AS corrections, CAST(sum(code_blocks + terminal_outputs + tables + manifests) AS BIGINT) AS artifacts FROM conv",
      lambda m: m.agg(F.count("*").alias("conversations"), F.sum("total_turns").alias("turns"), F.sum("total_tokens").alias("tokens"), F.avg("information_gain").alias("avg_ig"), F.avg("malicious_compliance").alias("avg_mc"), F.avg("token_ratio").alias("avg_ratio"), F.sum("correction_events").alias("corrections"), F.sum(F.expr("code_blocks + terminal_outputs + tables + manifests")).alias("artifacts")))


def _with_share(df: DataFrame) -> DataFrame:
    """share of n in all rows; the groups are few, so one more sum over them is cheap."""
    total = df.agg(F.sum("n")).first()[0] or 1
    return df.withColumn("share", F.col("n") / F.lit(float(total)))


_roll("op_agg_02_topic_distribution", "SELECT topic_primary, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM conv GROUP BY 1", lambda m: _with_share(m.groupBy("topic_primary").agg(F.count("*").alias("n"))))
_roll("op_agg_02_tone_distribution", "SELECT tone_cluster, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM conv GROUP BY 1", lambda m: _with_share(m.groupBy("tone_cluster").agg(F.count("*").alias("n"))))
_PERIOD_SQL = "count(*) AS n, CAST(sum(total_tokens) AS BIGINT) AS tokens, round(avg(information_gain), 6) AS avg_ig, round(avg(malicious_compliance), 6) AS avg_mc, round(avg(user_entropy), 6) AS avg_entropy, round(avg(token_ratio), 6) AS avg_ratio, CAST(sum(correction_events) AS BIGINT) AS corrections"
def _period_aggregates() -> list:
    return [F.count("*").alias("n"), F.sum("total_tokens").alias("tokens"), F.avg("information_gain").alias("avg_ig"), F.avg("malicious_compliance").alias("avg_mc"), F.avg("user_entropy").alias("avg_entropy"), F.avg("token_ratio").alias("avg_ratio"), F.sum("correction_events").alias("corrections")]
_roll("op_agg_03_period_rollup", f"SELECT CAST(period AS BIGINT) AS period, {_PERIOD_SQL} FROM conv GROUP BY 1", lambda m: m.groupBy("period").agg(*_period_aggregates()))
_roll("op_agg_04_topic_tone_matrix", "SELECT topic_primary, tone_cluster, count(*) AS n FROM conv GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 100", lambda m: m.groupBy("topic_primary", "tone_cluster").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic_primary", "tone_cluster").limit(100))
_roll("op_agg_05_dpo_potential", "SELECT topic_primary, count(*) AS n, CAST(sum(correction_events) AS BIGINT) AS corrections, round(avg(information_gain), 6) AS avg_ig FROM conv WHERE correction_events > 0 GROUP BY 1", lambda m: m.where("correction_events > 0").groupBy("topic_primary").agg(F.count("*").alias("n"), F.sum("correction_events").alias("corrections"), F.avg("information_gain").alias("avg_ig")))
_roll("op_agg_06_tier_distribution", "SELECT quality_tier, count(*) AS n, round(avg(information_gain), 6) AS avg_ig, round(avg(canonical_tokens), 6) AS avg_tokens FROM dist WHERE selected GROUP BY 1", lambda d: d.where("selected").groupBy("quality_tier").agg(F.count("*").alias("n"), F.avg("information_gain").alias("avg_ig"), F.avg("canonical_tokens").alias("avg_tokens")), "dist")
_roll("op_agg_07_provider_composition", "SELECT provider, count(*) AS n, CAST(sum(total_tokens) AS BIGINT) AS tokens FROM conv GROUP BY 1", lambda m: m.groupBy("provider").agg(F.count("*").alias("n"), F.sum("total_tokens").alias("tokens")))
_roll("op_agg_08_correction_coverage", "SELECT provider, count(*) FILTER (correction_events > 0) AS full_convs, CAST(coalesce(sum(correction_events) FILTER (correction_events > 0), 0) AS BIGINT) AS full_events, count(*) FILTER (selected AND correction_events > 0) AS distilled_convs, count(*) FILTER (selected AND quality_tier = 'gold') AS gold FROM dist GROUP BY 1",
      lambda d: d.groupBy("provider").agg(F.count_if(F.col("correction_events") > 0).alias("full_convs"), F.coalesce(F.sum(F.when(F.col("correction_events") > 0, F.col("correction_events"))), F.lit(0)).alias("full_events"), F.count_if(F.col("selected") & (F.col("correction_events") > 0)).alias("distilled_convs"), F.count_if(F.col("selected") & (F.col("quality_tier") == "gold")).alias("gold")), "dist")
_roll("op_agg_09_distilled_by_period", "SELECT CAST(period AS BIGINT) AS period, count(*) AS n, CAST(sum(canonical_tokens) AS BIGINT) AS tokens, min(quality_tier) AS first_tier FROM dist WHERE selected GROUP BY 1", lambda d: d.where("selected").groupBy("period").agg(F.count("*").alias("n"), F.sum("canonical_tokens").alias("tokens"), F.min("quality_tier").alias("first_tier")), "dist")
_roll("op_agg_26_column_summary", " UNION ALL ".join(f"SELECT '{c}' AS metric, round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, round(stddev_samp({c}), 6) AS sd, round(min({c}), 6) AS low, round(max({c}), 6) AS high FROM conv" for c in ("information_gain", "malicious_compliance", "user_entropy")),
      lambda m: m.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("v")) for c in ("information_gain", "malicious_compliance", "user_entropy")))).alias("x")).groupBy("x.metric").agg(F.avg("x.v").alias("mean"), F.median("x.v").alias("median"), F.stddev_samp("x.v").alias("sd"), F.min("x.v").alias("low"), F.max("x.v").alias("high")))
_roll("op_agg_34_tiers_by_period", "SELECT CAST(period AS BIGINT) AS period, count(*) FILTER (quality_tier = 'gold') AS gold, count(*) FILTER (quality_tier = 'silver') AS silver, count(*) FILTER (quality_tier = 'bronze') AS bronze FROM dist GROUP BY 1",
      lambda d: d.groupBy("period").pivot("quality_tier", ["gold", "silver", "bronze"]).count().na.fill(0, ["gold", "silver", "bronze"]), "dist")
_roll("op_agg_35_full_vs_distilled", "SELECT CAST(period AS BIGINT) AS period, round(avg(information_gain), 6) AS full_ig, round(avg(information_gain) FILTER (selected), 6) AS distilled_ig, round(avg(total_tokens), 6) AS full_tokens, round(avg(total_tokens) FILTER (selected), 6) AS distilled_tokens FROM dist GROUP BY 1",
      lambda d: d.groupBy("period").agg(F.avg("information_gain").alias("full_ig"), F.avg(F.when(F.col("selected"), F.col("information_gain"))).alias("distilled_ig"), F.avg("total_tokens").alias("full_tokens"), F.avg(F.when(F.col("selected"), F.col("total_tokens"))).alias("distilled_tokens")), "dist")


def equal_width(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal bins from the lowest to the highest value; the last bin is closed."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (high - low) / bins or 1.0
    return df.groupBy(F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"))


_roll("op_agg_36_equal_width_histogram", "SELECT CAST(least(floor((information_gain - mn) / ((mx - mn) / 30)), 29) AS BIGINT) AS bin, count(*) AS n FROM conv, (SELECT min(information_gain) AS mn, max(information_gain) AS mx FROM conv) GROUP BY 1", lambda m: equal_width(m, "information_gain", 30))
_roll("op_agg_40_high_signal_by_topic", "SELECT topic_primary, count(*) AS n FROM conv WHERE information_gain > 0.58 AND malicious_compliance < 0.25 GROUP BY 1", lambda m: m.where((F.col("information_gain") > 0.58) & (F.col("malicious_compliance") < 0.25)).groupBy("topic_primary").agg(F.count("*").alias("n")))
_roll("op_agg_41_topic_chart", "SELECT topic_primary, count(*) AS n, CAST(sum(total_tokens) AS BIGINT) AS tokens FROM conv GROUP BY 1 ORDER BY n DESC, 1 LIMIT 12", lambda m: m.groupBy("topic_primary").agg(F.count("*").alias("n"), F.sum("total_tokens").alias("tokens")).orderBy(F.desc("n"), "topic_primary").limit(12))
_roll("op_flt_04_high_signal_strict", "SELECT conversation_id FROM conv WHERE information_gain > 0.58 AND malicious_compliance < 0.25", lambda m: m.where((F.col("information_gain") > 0.58) & (F.col("malicious_compliance") < 0.25)).select("conversation_id"))
_roll("op_flt_04_high_signal_inclusive", "SELECT conversation_id FROM conv WHERE information_gain >= 0.58 AND malicious_compliance <= 0.25", lambda m: m.where((F.col("information_gain") >= 0.58) & (F.col("malicious_compliance") <= 0.25)).select("conversation_id"))
_roll("op_flt_09_contract_predicates", "SELECT conversation_id, correction_events > 10 AS heavy FROM conv WHERE topic_primary = 'architecture' AND period <= 4 AND information_gain > 0.41 AND correction_events > 0", lambda m: m.where((F.col("topic_primary") == "architecture") & (F.col("period") <= 4) & (F.col("information_gain") > 0.41) & (F.col("correction_events") > 0)).select("conversation_id", (F.col("correction_events") > 10).alias("heavy")))
_roll("op_flt_12_ratio_filter", "SELECT count(*) FILTER (token_ratio < 10) AS under_10, count(*) FILTER (token_ratio < 8) AS under_8 FROM conv", lambda m: m.agg(F.count_if(F.col("token_ratio") < 10).alias("under_10"), F.count_if(F.col("token_ratio") < 8).alias("under_8")))
_roll("op_top_01_correction_density", "SELECT conversation_id, round(correction_events * 1000.0 / nullif(total_tokens, 0), 4) AS density FROM conv ORDER BY density DESC NULLS LAST, conversation_id LIMIT 30", lambda m: m.select("conversation_id", F.round(F.try_divide(F.col("correction_events") * 1000.0, F.col("total_tokens")), 4).alias("density")).orderBy(F.desc_nulls_last("density"), "conversation_id").limit(30))
_roll("op_top_02_high_signal", "SELECT conversation_id, round(information_gain, 6) AS information_gain, round(malicious_compliance, 6) AS malicious_compliance FROM conv ORDER BY conv.information_gain DESC, conv.malicious_compliance, conversation_id LIMIT 50", lambda m: m.select("conversation_id", "information_gain", "malicious_compliance").orderBy(F.desc("information_gain"), "malicious_compliance", "conversation_id").limit(50))
_roll("op_top_03_corrections", "SELECT conversation_id, CAST(correction_events AS BIGINT) AS correction_events FROM conv ORDER BY conv.correction_events DESC, conversation_id LIMIT 15", lambda m: m.select("conversation_id", "correction_events").orderBy(F.desc("correction_events"), "conversation_id").limit(15))
_roll("op_top_04_largest", "SELECT conversation_id, CAST(total_tokens AS BIGINT) AS total_tokens FROM conv ORDER BY conv.total_tokens DESC, conversation_id LIMIT 20", lambda m: m.select("conversation_id", "total_tokens").orderBy(F.desc("total_tokens"), "conversation_id").limit(20))
_roll("op_top_05_most_common", "SELECT tone_cluster, count(*) AS n FROM conv GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10", lambda m: m.groupBy("tone_cluster").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tone_cluster").limit(10))
_metric("op_top_07_topic_ranking", "topic_primary", "topic_secondary")
_roll("op_win_05_top_per_period", "SELECT CAST(period AS BIGINT) AS period, conversation_id, CAST(r AS BIGINT) AS r FROM (SELECT period, conversation_id, row_number() OVER (PARTITION BY period ORDER BY total_tokens DESC, conversation_id) AS r FROM conv) WHERE r <= 10",
      lambda m: m.select("period", "conversation_id", F.row_number().over(Window.partitionBy("period").orderBy(F.desc("total_tokens"), "conversation_id")).alias("r")).where("r <= 10"))
_roll("op_join_10_topic_alignment", "SELECT topic_primary, count(*) AS n_full, count(*) FILTER (selected) AS n_distilled FROM dist GROUP BY 1",
      lambda d: d.groupBy("topic_primary").agg(F.count("*").alias("n_full")).join(d.where("selected").groupBy("topic_primary").agg(F.count("*").alias("n_distilled")), "topic_primary", "left").na.fill(0, ["n_distilled"]), "dist")


def _dominant(d: DataFrame) -> DataFrame:
    top = d.groupBy("topic_primary").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic_primary").limit(1)
    return d.where("selected").join(F.broadcast(top.select("topic_primary")), "topic_primary", "left_semi").select("conversation_id", "topic_primary")  # one row


_roll("op_join_11_dominant_topic", "SELECT conversation_id, topic_primary FROM dist WHERE selected AND topic_primary = (SELECT topic_primary FROM dist GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)", _dominant, "dist")


@query("op_join_12_drill_down", f"{_FOLD} SELECT m.conversation_id, m.turn, m.role FROM msgs m JOIN dist d USING (conversation_id) WHERE d.selected AND d.quality_tier <> 'bronze'")
def join_12(spark, sf_dir):
    """Turns of the selected conversations of higher tiers."""
    picked = distilled(spark, sf_dir).where("selected AND quality_tier <> 'bronze'").select("conversation_id")
    return clean(spark, sf_dir).join(picked, "conversation_id", "left_semi").select("conversation_id", "turn", "role")


_TOKENS = "CAST(sum(greatest(1, char_count // 4)) AS BIGINT)"


@query("op_join_01_distilled_recount", f"{_FOLD} SELECT m.provider, count(*) AS messages, {_TOKENS} AS tokens FROM msgs m JOIN dist d ON d.conversation_id = m.conversation_id AND d.provider = m.provider WHERE d.selected GROUP BY 1")
def join_01(spark, sf_dir):
    """Exact tokens of the messages whose conversation was selected."""
    picked = distilled(spark, sf_dir).where("selected").select("conversation_id", "provider")
    rows = clean(spark, sf_dir).join(picked, ["conversation_id", "provider"], "left_semi")
    return rows.groupBy("provider").agg(F.count("*").alias("messages"), F.sum(F.greatest(F.lit(1), F.floor(F.col("char_count") / 4))).alias("tokens"))


@query("op_agg_29_exact_tokens", f"{_BASE} SELECT provider, count(*) AS messages, {_TOKENS} AS tokens FROM msgs GROUP BY 1")
def agg_29(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("provider").agg(F.count("*").alias("messages"), F.sum(F.greatest(F.lit(1), F.floor(F.col("char_count") / 4))).alias("tokens"))


@query("op_agg_10_role_distribution", f"{_BASE} SELECT role, count(*) AS n FROM src GROUP BY 1")
def agg_10(spark, sf_dir):
    return messages(spark, sf_dir).groupBy("role").agg(F.count("*").alias("n"))


_MONTH = "strftime(to_timestamp(create_time) AT TIME ZONE 'UTC', '%Y-%m')"


def monthly(rows: DataFrame) -> DataFrame:
    """Messages and tokens by UTC month; rows without a time count as unknown."""
    month = F.coalesce(F.date_format(F.timestamp_seconds("create_time"), "yyyy-MM"), F.lit("unknown"))
    return rows.groupBy(month.alias("month")).agg(F.count("*").alias("messages"), F.sum("word_count").alias("words"))


@query("op_agg_11_monthly", f"{_BASE} SELECT {_MONTH} AS month, count(*) AS messages, CAST(sum(len({_WORDS.format('text')})) AS BIGINT) AS words FROM msgs GROUP BY 1")
def agg_11(spark, sf_dir):
    return monthly(clean(spark, sf_dir))


@query("op_win_09_cumulative_growth", f"{_BASE}, mo AS (SELECT {_MONTH} AS month, CAST(sum(len({_WORDS.format('text')})) AS BIGINT) AS words FROM msgs GROUP BY 1) SELECT month, CAST(sum(words) OVER (ORDER BY month) AS BIGINT) AS running FROM mo")
def win_09(spark, sf_dir):
    months = monthly(clean(spark, sf_dir)).withColumn("all", F.lit(1))  # one row per month
    return months.select("month", F.sum("words").over(Window.partitionBy("all").orderBy("month")).alias("running"))


@query("op_win_10_best_version", "SELECT conv_id, min(v) AS version FROM (SELECT conv_id, v, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, v) AS r FROM (SELECT conv_id, 0 AS v, count(*) AS n FROM conversations GROUP BY 1 UNION ALL SELECT conv_id, 1, count(*) FILTER (role <> 'system') FROM conversations GROUP BY 1)) WHERE r = 1 GROUP BY 1")
def win_10(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id")
    first = rows.agg(F.count("*").alias("n_messages")).withColumn("position", F.lit(0))
    second = rows.agg(F.count_if(F.col("role") != "system").alias("n_messages")).withColumn("position", F.lit(1))
    return D.best_versions(first.unionByName(second), "conv_id").select("conv_id", F.col("position").alias("version"))
