"""Preference pairs, model families, workflows and terms of conversations.

Every operator takes cleaned messages (conversation_id, position, role, text) and needs one
shuffle by conversation at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X


def any_of(text: str, phrases: list[str]) -> Column:
    """Whether a text, given as SQL, holds one of the phrases."""
    return X.hits(text, phrases) > 0


def similarity(a: Column, b: Column, most: int = 100) -> Column:
    """Jaccard of the distinct words among the first `most` of each; the first words are the definition."""
    x, y = F.slice(X.words(a), 1, most), F.slice(X.words(b), 1, most)
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union.cast("double")).otherwise(F.lit(0.0))


def pair_candidates(messages: DataFrame, least: int = 50, low: float = 0.3, high: float = 0.95) -> DataFrame:
    """Each place where a question, an answer, a correction and a revised answer follow each other, the answers long enough and neither alike nor unrelated.

    prompt, rejected, correction, chosen, similarity, correction_type and confidence.
    """
    order = Window.partitionBy("conversation_id").orderBy("position")
    rows = messages.select("conversation_id", "position", "role", F.col("text").alias("prompt"), *(F.lead("role", i).over(order).alias(f"r{i}") for i in (1, 2, 3)), *(F.lead("text", i).over(order).alias(n) for i, n in ((1, "rejected"), (2, "correction"), (3, "chosen"))))
    shape = (F.col("role") == "user") & (F.col("r1") == "assistant") & (F.col("r2") == "user") & (F.col("r3") == "assistant")
    rows = rows.where(shape & (F.length("rejected") >= least) & (F.length("chosen") >= least) & any_of("lower(correction)", L.PAIR_SIGNS))
    rows = rows.withColumn("similarity", similarity(F.col("rejected"), F.col("chosen"))).where(F.col("similarity").between(low, high))
    kind = F
    for name, signs in L.PAIR_TYPES.items():
        kind = kind.when(any_of("lower(correction)", signs) if signs else F.length("chosen") > F.length("rejected") * 1.5, name)
    rows = rows.withColumn("correction_type", kind.otherwise("other"))
    tenth = lambda c, n=1: F.when(c, n).otherwise(0)
    tenths = 5 + tenth(F.size(X.words(F.col("prompt"))) > 20) + tenth((F.col("similarity") > 0.3) & (F.col("similarity") < 0.8), 2) + tenth(F.length("correction") > 10) + tenth(F.col("correction_type").isin("logic_error", "incomplete"))
    return rows.withColumn("confidence", F.least(tenths, F.lit(10)) / F.lit(10.0)).select("conversation_id", "position", "prompt", "rejected", "correction", "chosen", "similarity", "correction_type", "confidence")


def apart(candidates: DataFrame, turns: int = 4) -> DataFrame:
    """Candidates that do not overlap: in order, each that begins `turns` or more after the last one kept."""
    places = candidates.groupBy("conversation_id").agg(F.array_sort(F.collect_list("position")).alias("p"))
    none = F.array().cast(f"array<{candidates.schema['position'].dataType.simpleString()}>")
    kept = F.aggregate("p", none, lambda acc, x: F.when(F.coalesce(x >= F.try_element_at(acc, F.lit(-1)) + turns, F.lit(True)), F.array_append(acc, x)).otherwise(acc))
    return candidates.join(places.select("conversation_id", F.explode(kept).alias("position")), ["conversation_id", "position"])


def pairs(messages: DataFrame) -> DataFrame:
    return apart(pair_candidates(messages))


def release_pack(pairs_: DataFrame, provider: str = "provider", quota: int = 50) -> DataFrame:
    """The pairs of most confidence of each provider, with their place; the quota is the feature. Ties by conversation and position."""
    order = Window.partitionBy(provider).orderBy(F.desc("confidence"), "conversation_id", "position")
    return pairs_.withColumn("place", F.row_number().over(order)).where(F.col("place") <= quota)


def families(messages: DataFrame) -> DataFrame:
    """conversation_id, model (that of most answers; ties to the one met first) and mean confidence; unknown without answers."""
    text, low = F.col("text"), F.lower("text")
    beyond = F.length(F.regexp_replace(text, r"[\x00-\x7F]", "")) / F.greatest(F.length(text), F.lit(1)).cast("double")
    scores = {}
    for name, (signs, least, most) in L.FAMILIES.items():
        hits = sum((F.contains(low, F.lit(s.lower())).cast("int") for s in signs), F.lit(0)) + beyond.between(least, most).cast("int")
        scores[name] = hits / F.lit(float(len(signs) + 1))
    best = F.greatest(*scores.values())
    model = F
    for name, score in scores.items():
        model = model.when(score == best, name)
    told = messages.where("role = 'assistant'").select("conversation_id", "position", model.alias("model"), best.alias("confidence"))
    each = told.groupBy("conversation_id", "model").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"), F.sum("confidence").alias("c"))
    mode = each.groupBy("conversation_id").agg(F.max(F.struct("n", (-F.col("first")).alias("f"), "model")).alias("m"), (F.sum("c") / F.sum("n")).alias("confidence"))
    every = messages.select("conversation_id").distinct().join(mode, "conversation_id", "left")
    return every.select("conversation_id", F.coalesce("m.model", F.lit("unknown")).alias("model"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def workflows(messages: DataFrame) -> DataFrame:
    """Code requests and generations, debugging loops and workflow of each conversation that has an artifact."""
    order = Window.partitionBy("conversation_id").orderBy("position")
    rows = messages.withColumn("code", F.contains("text", F.lit("```"))).withColumn("after_code", F.lag("code").over(order))
    by = rows.groupBy("conversation_id").agg(
        F.count_if("code").alias("total_artifacts"),
        F.count_if(F.col("code") & (F.col("role") == "user")).alias("code_requests"),
        F.count_if(F.col("code") & (F.col("role") == "assistant")).alias("code_generations"),
        F.count_if((F.col("role") == "user") & F.col("after_code") & any_of("text", L.FEEDBACK)).alias("debugging_loops"),
    )
    kind = F.when(F.col("debugging_loops") > 2, "interactive_debugging").when(F.col("code_generations") > F.col("code_requests"), "code_generation_focused")
    kind = kind.when(F.col("code_requests") > F.col("code_generations"), "code_review_focused").otherwise("mixed")
    return by.where("total_artifacts > 0").withColumn("workflow", kind)


def terms(text: Column) -> Column:
    """Distinct technical terms; a word border is one between ASCII letters, digits or underscores and anything else."""
    border = "(?<![A-Za-z0-9_])({})(?![A-Za-z0-9_])"
    return F.array_distinct(F.concat(*(F.regexp_extract_all(text, F.lit(border.format(p)), 1) for p in L.TERMS)))


def emergence(messages: DataFrame, periods: DataFrame) -> DataFrame:
    """term, first_period and n, the number of users' messages that hold it; periods: conversation_id, period."""
    said = messages.where("role = 'user'").join(periods, "conversation_id").select("period", F.explode(terms(F.col("text"))).alias("term"))
    return said.groupBy("term").agg(F.min("period").cast("long").alias("first_period"), F.count(F.lit(1)).alias("n"))
