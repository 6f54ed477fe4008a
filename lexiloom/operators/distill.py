"""Selection of conversations: quality gate, tiers, token budget, distilled table and manifest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parts import bounds_over
from ..functions.text import fixed3
from ..storage import written


@dataclass(frozen=True)
class Policy:
    # The thresholds of policy version 1.0.
    min_information_gain: float = 0.40
    max_malicious_compliance: float = 0.35
    min_user_entropy: float = 0.40
    min_total_tokens: int = 100
    max_repetition_score: float = 0.60
    token_budget_min: int = 90_000_000
    token_budget_max: int = 110_000_000
    version: str = "distill-v1.0"


def gate(metrics: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Adds passed and reason; the first rule that fails gives the reason."""
    show = fixed3
    rules = [
        ("info_gain", "information_gain", "<", policy.min_information_gain, show(F.col("information_gain"))),
        ("malicious_compliance", "malicious_compliance", ">", policy.max_malicious_compliance, show(F.col("malicious_compliance"))),
        ("user_entropy", "user_entropy", "<", policy.min_user_entropy, show(F.col("user_entropy"))),
        ("total_tokens", "total_tokens", "<", policy.min_total_tokens, F.col("total_tokens").cast("string")),
        ("repetition_score", "repetition_score", ">", policy.max_repetition_score, show(F.col("repetition_score"))),
    ]
    reason, failed = None, F.lit(False)
    for label, column, sign, bound, shown in rules:
        broken = F.col(column) < bound if sign == "<" else F.col(column) > bound
        text = F.concat(F.lit(f"{label}="), shown, F.lit(f"{sign}{bound}"))
        reason = F.when(broken, text) if reason is None else reason.when(broken, text)
        failed = failed | broken
    good = F.concat(F.lit("quality_gate_pass: info_gain="), show(F.col("information_gain")), F.lit("; malicious_compliance="), show(F.col("malicious_compliance")), F.lit("; entropy="), show(F.col("user_entropy")))
    return metrics.withColumn("passed", ~failed).withColumn("reason", reason.otherwise(good))


def tier() -> Column:
    gain, flattery = F.col("information_gain"), F.col("malicious_compliance")
    return F.when((gain >= 0.65) & (flattery <= 0.15) & (F.col("correction_events") > 0), "gold").when((gain >= 0.55) & (flattery <= 0.25), "silver").otherwise("bronze")


def select_within_budget(passed: DataFrame, budget: int, tokens: str = "canonical_tokens", rank: str = "information_gain", tie: str = "conversation_id") -> DataFrame:
    """Greedy by rank: an item that would overflow is left out, later ones are still tried.

    Where all fit, which one sum tells, nothing is ordered. Else rows are cut into parts by quantiles of the
    rank. Parts that fit whole are taken by their sums. Of the parts behind, only rows that still fit the room
    left can be taken at all: the first of them is walked in rank order, then the few rows of all others
    that are no larger than what is left after it. The choice of each depends on all before it, so a walk is one stream.
    """
    total = passed.agg(F.sum(tokens)).first()[0] or 0
    if total <= budget:
        return passed.withColumn("selected", F.lit(True))
    kind = passed.schema[tie].dataType.simpleString()
    narrow = passed.select(F.col(tie).alias("k"), F.col(tokens).cast("long").alias("t"), F.col(rank).alias("r"))
    n = 4 * max(1, int(passed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted(set(narrow.approxQuantile("r", [i / n for i in range(1, n)], 0.25 / n)), reverse=True)
    narrow = narrow.withColumn("part", bounds_over(F.col("r"), bounds))  # higher ranks first; rows without a rank last
    sums = {r["part"]: r["t"] for r in narrow.groupBy("part").agg(F.sum("t").alias("t")).collect()}
    used, whole = 0, -1
    for p in range(len(bounds) + 1):
        if used + sums.get(p, 0) > budget:
            break
        used, whole = used + sums.get(p, 0), p
    first, last = _walked(narrow.where(f"part = {whole + 1}"), budget - used, kind), narrow.where(f"part > {whole + 1}")
    chosen = narrow.where(f"part <= {whole}").select("k").unionByName(first.select("k"))
    left = budget - used - (first.agg(F.sum("t")).first()[0] or 0)
    chosen = chosen.unionByName(_walked(last.where(F.col("t") <= left), left, kind).select("k"))
    marked = chosen.withColumnRenamed("k", tie).withColumn("selected", F.lit(True))
    return passed.join(marked, tie, "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def _walked(narrow: DataFrame, room: int, kind: str) -> DataFrame:
    """k and t of the rows that a greedy walk in rank order takes."""

    def walk(batches):
        import numpy as np
        import pyarrow as pa

        used = 0
        for batch in batches:
            size = batch.column("t").to_numpy()
            take = np.zeros(len(size), bool)
            for i, t in enumerate(size.tolist()):
                if used + t <= room:
                    used += t
                    take[i] = True
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(take)) for c in ("k", "t")], names=["k", "t"])

    return narrow.repartition(1).sortWithinPartitions(F.desc("r"), "k").mapInArrow(walk, f"k {kind}, t long")


def distil(metrics: DataFrame, exact: int, policy: Policy = Policy()) -> DataFrame:
    """All metrics with passed, reason, quality_tier, canonical_tokens and selected; scale carries heuristic to exact tokens.

    The metrics are written once: what follows reads narrow rows several times.
    """
    metrics = written(metrics, "metrics")
    heuristic = metrics.agg(F.coalesce(F.sum("total_tokens"), F.lit(0))).first()[0]
    scale = exact / max(heuristic, 1)
    judged = gate(metrics, policy).withColumn("quality_tier", tier()).withColumn("canonical_tokens", (F.col("total_tokens") * F.lit(scale)).cast("long"))
    picked = select_within_budget(judged.where("passed"), policy.token_budget_max).select("conversation_id", "selected")
    return judged.join(picked, "conversation_id", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def manifest(distilled: DataFrame, exact: int, policy: Policy = Policy()) -> DataFrame:
    """One row of counts, the budget's status and shares."""
    chosen = F.col("selected")
    row = distilled.agg(
        F.count(F.lit(1)).alias("input_conversations"),
        F.count_if("passed").alias("quality_passed"),
        F.count_if(~F.col("passed")).alias("quality_rejected"),
        F.count_if(F.col("passed") & ~chosen).alias("budget_trimmed"),
        F.count_if(chosen).alias("distilled_conversations"),
        F.coalesce(F.sum(F.when(chosen, F.col("canonical_tokens"))), F.lit(0)).alias("distilled_tokens_selected"),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("heuristic_total"),
    )
    picked = F.col("distilled_tokens_selected")
    status = F.when(picked < policy.token_budget_min, "under_band").when(picked > policy.token_budget_max, "over_band").otherwise("in_band")
    return row.withColumn("budget_status", status).withColumn("distilled_fraction", picked / F.lit(float(max(exact, 1)))).withColumn("heuristic_scale_factor", F.lit(float(exact)) / F.greatest("heuristic_total", F.lit(1)))


def best_versions(exports: DataFrame, key: str = "uuid", size: str = "n_messages", position: str = "position") -> DataFrame:
    """For each key the version with the most messages; the first given wins ties."""
    order = Window.partitionBy(key).orderBy(F.desc(size), position)
    return exports.withColumn("_v", F.row_number().over(order)).where("_v = 1").drop("_v")
