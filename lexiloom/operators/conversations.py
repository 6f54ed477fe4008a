"""Messages to conversation metrics.

All metrics of a conversation come from one shuffle by conversation: a window puts messages
in order, and one aggregate gathers what the metrics need. Words are split once per message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..functions.parts import bounds_under


def clean_messages(messages: DataFrame) -> DataFrame:
    """Drops system turns and blank texts; adds position (0-based, by create_time then turn), char_count and word_count."""
    kept = messages.where((F.col("role") != "system") & (X.stripped(F.coalesce("text", F.lit(""))) != ""))
    order = Window.partitionBy("conversation_id").orderBy(F.coalesce("create_time", F.lit(0.0)), "turn")
    return kept.withColumn("position", F.row_number().over(order) - 1).withColumn("char_count", F.length("text")).withColumn("word_count", F.size(X.words(F.col("text"))))


def tone(lowered) -> Column:
    return X.first_highest({n: X.hits(lowered, p) for n, p in L.TONES.items()}, "neutral")


def marked_messages(clean: DataFrame) -> DataFrame:
    """Adds tone, the previous message's tone, is_correction and is_sycophantic."""
    lowered = "lower(text)"
    order = Window.partitionBy("conversation_id").orderBy("position")
    out = clean.withColumn("tone", tone(lowered)).withColumn("prev_tone", F.lag("tone").over(order))
    out = out.withColumn("is_correction", (F.col("role") == "user") & (F.col("position") > 0) & (X.hits(lowered, L.CORRECTIONS) > 0))
    return out.withColumn("is_sycophantic", (F.col("role") == "assistant") & (X.hits(lowered, L.SYCOPHANCY) >= 2))


def conversation_metrics(clean: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation. conversations may give title, created_at and updated_at."""
    marked = marked_messages(clean)
    is_user, is_asst = F.col("role") == "user", F.col("role") == "assistant"

    def in_order(condition, value):
        gathered = F.array_sort(F.collect_list(F.when(condition, F.struct("position", value.alias("v")))))
        return F.transform(gathered, lambda x: x["v"])

    count = lambda c: F.count_if(c).cast("int")
    by = marked.groupBy("conversation_id").agg(
        F.count(F.lit(1)).cast("int").alias("total_turns"),
        count(is_user).alias("user_turns"),
        count(is_asst).alias("assistant_turns"),
        in_order(is_user, F.col("text")).alias("user_texts"),
        in_order(is_asst, F.col("text")).alias("asst_texts"),
        count(F.col("prev_tone").isNotNull() & (F.col("tone") != F.col("prev_tone"))).alias("shifts"),
        count(F.col("is_correction")).alias("correction_events"),
        count(F.col("is_sycophantic")).alias("sycophantic"),
    )
    texts = by.withColumn("user_text", F.array_join("user_texts", " ")).withColumn("asst_text", F.array_join("asst_texts", " ")).drop("user_texts", "asst_texts")
    texts = texts.withColumn("uw", X.words(F.lower("user_text"))).withColumn("aw", X.words(F.lower("asst_text")))
    if conversations is None:
        texts = texts.withColumns({"title": F.lit(""), "created_at": F.lit(None).cast("double"), "updated_at": F.lit(None).cast("double")})
    else:
        texts = texts.join(conversations.select("conversation_id", "title", "created_at", "updated_at"), "conversation_id", "left")
    tokens = lambda c: (F.size(c) * F.lit(1.3)).cast("int")
    all_text = F.concat("user_text", F.lit(" "), "asst_text")
    all_words = F.concat("uw", "aw")
    similar = X.share(F.size(F.array_intersect("uw", "aw")), F.size(F.array_union("uw", "aw")))
    gain = F.when((F.size("uw") == 0) | (F.size("aw") == 0), F.lit(0.5)).when((similar >= 0.15) & (similar <= 0.45), 0.6 + (0.4 - similar)).otherwise(0.4 + similar * 0.3)
    wide = texts.withColumn("user_tokens", tokens("uw")).withColumn("assistant_tokens", tokens("aw")).withColumn("all_text", all_text)
    lowered = "lower(all_text)"
    topics = X.ranked({n: X.hits("lower(concat(coalesce(title, ''), ' ', all_text))", p) for n, p in L.TOPICS.items()})
    wide = wide.withColumn("topics", topics)
    return wide.select(
        "conversation_id",
        "title",
        "created_at",
        "updated_at",
        "total_turns",
        "user_turns",
        "assistant_turns",
        F.when((F.coalesce("created_at", F.lit(0.0)) != 0) & (F.coalesce("updated_at", F.lit(0.0)) != 0), (F.col("updated_at") - F.col("created_at")) / 60.0).otherwise(F.lit(0.0)).alias("duration_minutes"),
        "user_tokens",
        "assistant_tokens",
        (F.col("user_tokens").cast("double") / F.greatest("assistant_tokens", F.lit(1))).alias("token_ratio"),
        (F.col("user_tokens") + F.col("assistant_tokens")).alias("total_tokens"),
        X.word_entropy(F.col("uw")).alias("user_entropy"),
        X.share(F.size(F.array_distinct(all_words)), F.size(all_words)).alias("semantic_density"),
        gain.alias("information_gain"),
        X.repeated_share(X.ngrams(F.col("aw"), 3)).alias("repetition_score"),
        X.share(F.col("shifts"), F.col("total_turns") - 1).alias("tone_shift"),
        X.share(F.col("sycophantic"), F.col("assistant_turns")).alias("malicious_compliance"),
        F.coalesce(F.get("topics", F.lit(0)), F.lit("general")).alias("topic_primary"),
        F.slice("topics", 2, 3).alias("topic_secondary"),
        tone(lowered).alias("tone_cluster"),
        X.occurrences(F.col("all_text"), "```").alias("code_blocks"),
        F.regexp_count("all_text", F.lit(L.TERMINAL)).alias("terminal_outputs"),
        (X.occurrences(F.col("all_text"), "|") > 4).cast("int").alias("tables"),
        F.regexp_count("all_text", F.lit(L.MANIFEST)).alias("manifests"),
        "correction_events",
    )


def running_total(rows: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """rows with the sum of value over all rows up to each, by a numeric column without repeats.

    Sums come from one total for each range of the order plus the running sum inside it, so no task holds all rows.
    """
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted(set(rows.select(F.col(order).cast("double").alias("o")).approxQuantile("o", [i / n for i in range(1, n)], 0.01))) if n > 1 else []
    dealt = rows.withColumn("_part", bounds_under(F.col(order).cast("double"), bounds))
    sums = {r["_part"]: r["v"] for r in dealt.groupBy("_part").agg(F.sum(value).alias("v")).collect()}
    before, at = {0: 0}, 0
    for p in sorted(sums):
        before[p], at = at, at + sums[p]
    offset = F.element_at(F.create_map(*(F.lit(x) for kv in before.items() for x in kv)), F.col("_part"))
    inside = F.sum(value).over(Window.partitionBy("_part").orderBy(order))
    return dealt.withColumn(name, offset + inside).drop("_part")


def with_period(conversations: DataFrame, order: list[str], parts: int = 5) -> DataFrame:
    """Adds period 1..parts: equal counts in order, the remainder in the last.

    Ranks come from counts per range partition plus the rank inside it, so no task holds all
    rows and the rows themselves are not sorted on one executor.
    """
    spark = conversations.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = conversations.select("conversation_id", *(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)))
    keys = keys.withColumn("_o0", F.coalesce("_o0", F.lit(0)))
    by = [f"_o{i}" for i in range(len(order))]
    # Quantile bounds of a narrow key are few; each row finds its part, so ranks inside parts add up.
    dealt = keys.withColumn("_part", F.col("_o0").cast("double"))
    bounds = sorted(set(dealt.approxQuantile("_part", [i / n for i in range(1, n)], 0.01))) if n > 1 else []
    dealt = dealt.withColumn("_part", bounds_under(F.col("_part"), bounds))
    sizes = {r["_part"]: r["count"] for r in dealt.groupBy("_part").count().collect()}
    total, before, at = sum(sizes.values()), {}, 0
    for p in sorted(sizes):
        before[p], at = at, at + sizes[p]
    offset = F.element_at(F.create_map(*(F.lit(x) for kv in (before or {0: 0}).items() for x in kv)), F.col("_part"))
    index = offset + F.row_number().over(Window.partitionBy("_part").orderBy(*by)) - 1
    period = F.least(F.lit(parts), F.floor(index / max(1, total // parts)) + 1).cast("int")
    return conversations.join(dealt.select("conversation_id", period.alias("period")), "conversation_id")
