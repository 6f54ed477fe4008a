"""Operators that the reference's documents describe: preference pairs, release pack, families, workflows, terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import tokens as K
from ..operators import preference as R
from ..operators import sinks as W
from .corpus import _BASE, _CONV, _FOLD, _list, clean, distilled, metrics
from .files import folder
from .registry import query


def _any(column: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '" + p.replace("'", "''") + "')" for p in phrases) + ")"


def _words(column: str) -> str:
    return rf"list_filter(regexp_split_to_array({column}, '\s+'), lambda w: w <> '')"


#: The table's answers have next to no word in common and its users correct nothing, so texts get planted words, on both sides:
#: answers those that a revision shares with its first version, other turns one of these by conversation and turn.
PLANTED = ["the logic is wrong here, ", "please revise it in a cleaner style, ", "let me say it was unclear, ", "", "fix the bracket, "]
ANSWERED = [" ".join(f"kept{i}" for i in range(n)) + " " for n in (70, 95, 40)]


def said(spark, sf_dir):
    """Cleaned messages with planted words."""
    by = lambda items, key: F.get(F.array(*map(F.lit, items)), F.pmod(key, F.lit(len(items))).cast("int"))
    planted = F.when(F.col("role") == "assistant", by(ANSWERED, F.col("conversation_id"))).otherwise(by(PLANTED, F.col("conversation_id") + F.col("turn")))
    return clean(spark, sf_dir).withColumn("text", F.concat(planted, "text"))


_SAID = _BASE.replace("WITH src", "WITH RECURSIVE src", 1) + f""", said AS (SELECT * REPLACE (CASE WHEN role = 'assistant' THEN {_list(ANSWERED)}[CAST(conversation_id % {len(ANSWERED)} AS INT) + 1] ELSE {_list(PLANTED)}[CAST((conversation_id + turn) % {len(PLANTED)} AS INT) + 1] END || text AS text) FROM msgs)"""
_TYPE = " ".join(f"WHEN {_any('lower(t2)', signs) if signs else 'length(t3) > length(t1) * 1.5'} THEN '{name}'" for name, signs in L.PAIR_TYPES.items())
#: Candidates in `cand`, those that do not overlap in `pairs`.
_PAIRS = _SAID + f"""
, w AS (SELECT conversation_id, provider, position, role, text, {', '.join(f'lead(role, {i}) OVER o AS r{i}, lead(text, {i}) OVER o AS t{i}' for i in (1, 2, 3))} FROM said WINDOW o AS (PARTITION BY conversation_id ORDER BY position)),
shape AS (SELECT *, list_distinct({_words('t1')}[1:100]) AS x, list_distinct({_words('t3')}[1:100]) AS y FROM w
  WHERE role = 'user' AND r1 = 'assistant' AND r2 = 'user' AND r3 = 'assistant' AND length(t1) >= 50 AND length(t3) >= 50 AND {_any('lower(t2)', L.PAIR_SIGNS)}),
alike AS (SELECT *, CASE WHEN len(x) + len(y) > 0 THEN CAST(len(x) + len(y) - len(list_distinct(list_concat(x, y))) AS DOUBLE) / len(list_distinct(list_concat(x, y))) ELSE 0.0 END AS similarity FROM shape),
typed AS (SELECT *, CASE {_TYPE} ELSE 'other' END AS correction_type FROM alike WHERE similarity BETWEEN CAST(0.3 AS DOUBLE) AND CAST(0.95 AS DOUBLE)),
cand AS (SELECT *, CAST(least(10, 5 + CAST(len({_words('text')}) > 20 AS INT) + 2 * CAST(similarity > CAST(0.3 AS DOUBLE) AND similarity < CAST(0.8 AS DOUBLE) AS INT) + CAST(length(t2) > 10 AS INT) + CAST(correction_type IN ('logic_error', 'incomplete') AS INT)) AS DOUBLE) / 10 AS confidence FROM typed),
pick AS (SELECT conversation_id, min(position) AS position FROM cand GROUP BY 1
  UNION ALL SELECT p.conversation_id, min(c.position) FROM pick p JOIN cand c ON c.conversation_id = p.conversation_id AND c.position >= p.position + 4 GROUP BY p.conversation_id, p.position),
pairs AS (SELECT cand.* FROM cand JOIN pick USING (conversation_id, position))
"""


@query("op_doc_01_dpo_pairs", f"{_PAIRS} SELECT conversation_id, CAST(position AS BIGINT) AS position, round(similarity, 6) AS similarity, correction_type, round(confidence, 6) AS confidence, sha256(text || t1 || t2 || t3) AS sha FROM pairs")
def doc_01(spark, sf_dir):
    """Preference pairs with type and confidence."""
    p = R.pairs(said(spark, sf_dir))
    return p.select("conversation_id", F.col("position").cast("long").alias("position"), F.round("similarity", 6).alias("similarity"), "correction_type", F.round("confidence", 6).alias("confidence"), F.sha2(F.concat("prompt", "rejected", "correction", "chosen"), 256).alias("sha"))


@query("op_win_12_alternate_turns", f"{_PAIRS} SELECT conversation_id, CAST(position AS BIGINT) AS position FROM pairs")
def win_12(spark, sf_dir):
    """Of overlapping candidates the first stays."""
    return R.apart(R.pair_candidates(said(spark, sf_dir))).select("conversation_id", F.col("position").cast("long").alias("position"))


@query("op_snk_08_training_export", f"{_PAIRS} SELECT conversation_id, CAST(position AS BIGINT) AS position, sha256(text || t1 || t3) AS sha, correction_type, round(confidence, 6) AS confidence FROM pairs")
def snk_08(spark, sf_dir):
    """The pairs as JSON lines, read back."""
    rows = W.to_json_lines(W.dpo_records(said(spark, sf_dir)), folder(spark))
    return rows.select("conversation_id", F.col("position").cast("long").alias("position"), F.sha2(F.concat("prompt", "rejected", "chosen"), 256).alias("sha"), "correction_type", F.round("confidence", 6).alias("confidence"))


def _with_provider(rows):
    return rows.withColumn("provider", F.concat(F.lit("p"), (F.col("conversation_id") % 4).cast("string")))


_PACK = f"{_PAIRS}, pack AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY confidence DESC, conversation_id, position) AS place FROM pairs)"


@query("op_doc_02_release_pack", f"{_PACK} SELECT provider, conversation_id, CAST(position AS BIGINT) AS position, CAST(place AS BIGINT) AS place FROM pack WHERE place <= 50")
def doc_02(spark, sf_dir):
    return R.release_pack(_with_provider(R.pairs(said(spark, sf_dir)))).select("provider", "conversation_id", F.col("position").cast("long").alias("position"), F.col("place").cast("long").alias("place"))


@query("op_doc_02_manifest", f"{_PACK} SELECT provider, CAST(50 AS BIGINT) AS quota, count(*) AS pairs, count(*) FILTER (place <= 50) AS realized, count(*) FILTER (place > 50) AS beyond_quota, round(min(confidence) FILTER (place <= 50), 6) AS least_confidence FROM pack GROUP BY 1")
def doc_02_manifest(spark, sf_dir):
    """Quotas, realized counts, what the quota left out and the confidence reached."""
    p = R.release_pack(_with_provider(R.pairs(said(spark, sf_dir))), quota=2**31 - 1)
    inside = F.col("place") <= 50
    return p.groupBy("provider").agg(F.lit(50).cast("long").alias("quota"), F.count("*").alias("pairs"), F.count_if(inside).alias("realized"), F.count_if(~inside).alias("beyond_quota"), F.round(F.min(F.when(inside, F.col("confidence"))), 6).alias("least_confidence"))


def _family(name: str) -> str:
    signs, least, most = L.FAMILIES[name]
    hits = " + ".join("CAST(contains(lt, '" + s.lower().replace("'", "''") + "') AS INT)" for s in signs)
    return f"CAST({hits} + CAST(beyond BETWEEN CAST({least} AS DOUBLE) AND CAST({most} AS DOUBLE) AS INT) AS DOUBLE) / {len(signs) + 1}"


_FAMILY_NAMES = list(L.FAMILIES)


@query("op_doc_03_fingerprint", rf"""{_BASE}, a AS (SELECT *, CAST(length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS beyond FROM msgs WHERE role = 'assistant'),
s AS (SELECT conversation_id, position, [{', '.join(map(_family, _FAMILY_NAMES))}] AS v FROM a), t AS (SELECT *, list_max(v) AS confidence, [{', '.join(f"'{n}'" for n in _FAMILY_NAMES)}][list_position(v, list_max(v))] AS model FROM s),
e AS (SELECT conversation_id, model, count(*) AS n, min(position) AS p, sum(confidence) AS c FROM t GROUP BY 1, 2),
m AS (SELECT conversation_id, first(model ORDER BY n DESC, p) AS model, sum(c) / sum(n) AS confidence FROM e GROUP BY 1)
SELECT conversation_id, coalesce(model, 'unknown') AS model, round(coalesce(confidence, 0.0), 6) AS confidence FROM (SELECT DISTINCT conversation_id FROM msgs) LEFT JOIN m USING (conversation_id)""")
def doc_03(spark, sf_dir):
    """Model family of each conversation by its answers' phrases and characters."""
    return R.families(clean(spark, sf_dir)).select("conversation_id", "model", F.round("confidence", 6).alias("confidence"))


@query("op_doc_04_workflow", f"""{_BASE}, c AS (SELECT *, contains(text, '```') AS code, lag(contains(text, '```')) OVER (PARTITION BY conversation_id ORDER BY position) AS after_code FROM msgs),
u AS (SELECT conversation_id, count(*) FILTER (code) AS total_artifacts, count(*) FILTER (code AND role = 'user') AS code_requests, count(*) FILTER (code AND role = 'assistant') AS code_generations, count(*) FILTER (role = 'user' AND after_code AND {_any('text', L.FEEDBACK)}) AS debugging_loops FROM c GROUP BY 1)
SELECT *, CASE WHEN debugging_loops > 2 THEN 'interactive_debugging' WHEN code_generations > code_requests THEN 'code_generation_focused' WHEN code_requests > code_generations THEN 'code_review_focused' ELSE 'mixed' END AS workflow FROM u WHERE total_artifacts > 0""")
def doc_04(spark, sf_dir):
    return R.workflows(clean(spark, sf_dir))


_FOUND = [rf"regexp_extract_all(text, '\b(?:{p})\b')" for p in L.TERMS]
_TERMS = f"list_distinct(list_concat(list_concat({_FOUND[0]}, {_FOUND[1]}), {_FOUND[2]}))"


@query("op_doc_05_term_emergence", f"{_CONV} SELECT term, CAST(min(period) AS BIGINT) AS first_period, count(*) AS n FROM (SELECT conversation_id, unnest({_TERMS}) AS term FROM msgs WHERE role = 'user') JOIN conv USING (conversation_id) GROUP BY 1")
def doc_05(spark, sf_dir):
    return R.emergence(clean(spark, sf_dir), metrics(spark, sf_dir).select("conversation_id", "period"))


def _counted(rows):
    import public_tokenizers as P

    counted = K.with_token_counts(rows, "text", lambda t: K.bpe_tokens(t, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), "n_tokens")
    return counted.groupBy("provider").agg(F.count("*").alias("messages"), F.sum("n_tokens").alias("tokens"))


@query("op_agg_29_bpe_tokens")
def agg_29_bpe(spark, sf_dir):
    """Exact byte-pair tokens of all messages by provider."""
    return _counted(clean(spark, sf_dir).select("provider", "text"))


@query("op_join_01_bpe_recount")
def join_01_bpe(spark, sf_dir):
    """Exact byte-pair tokens of the messages whose conversation was selected, by provider."""
    picked = distilled(spark, sf_dir).where("selected").select("conversation_id", "provider")
    return _counted(clean(spark, sf_dir).join(picked, ["conversation_id", "provider"], "left_semi").select("provider", "text"))


_DIST = "SELECT provider, conversation_id, topic_primary, quality_tier, period, total_tokens, correction_events FROM dist WHERE selected"


@query("op_val_08_contracts", f"""{_FOLD}, d AS ({_DIST}) SELECT 'QC-1' AS contract, count(*) > 0 AS passed FROM d WHERE topic_primary = (SELECT topic_primary FROM conv GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
UNION ALL SELECT 'QC-2', count(DISTINCT period) > 0 AND sum(total_tokens) > 0 FROM d UNION ALL SELECT 'QC-3', count(*) > 0 FROM d WHERE quality_tier = 'gold'
UNION ALL SELECT 'QC-M1', count(DISTINCT provider) = 4 FROM conv UNION ALL SELECT 'QC-M2', count(DISTINCT provider) > 0 FROM conv WHERE correction_events > 0
UNION ALL SELECT 'QC-M3', count(DISTINCT provider) > 0 FROM d WHERE correction_events > 0 UNION ALL SELECT 'QC-M4', count(DISTINCT provider) > 0 FROM d WHERE quality_tier = 'gold'""")
def val_08(spark, sf_dir):
    """The seven query contracts as pass or fail, from one pass over the metrics."""
    rows = distilled(spark, sf_dir)
    top = rows.groupBy("topic_primary").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic_primary").limit(1).select(F.col("topic_primary").alias("top"))
    s, corrected, gold = F.col("selected"), F.col("correction_events") > 0, F.col("quality_tier") == "gold"
    some = lambda c: F.coalesce(F.max(c), F.lit(False))
    checks = {
        "QC-1": some(s & (F.col("topic_primary") == F.col("top"))),
        "QC-2": F.coalesce(F.sum(F.when(s, F.col("total_tokens"))) > 0, F.lit(False)),
        "QC-3": some(s & gold),
        "QC-M1": F.count_distinct("provider") == 4,
        "QC-M2": some(corrected),
        "QC-M3": some(s & corrected),
        "QC-M4": some(s & gold),
    }
    row = rows.join(F.broadcast(top)).agg(*(c.alias(n) for n, c in checks.items()))  # top is one row
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("contract"), F.col(f"`{n}`").alias("passed")) for n in checks))).alias("x")).select("x.*")
