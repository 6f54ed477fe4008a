"""Streaming queries over the table files; each equals its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import streaming as S
from ..storage import new_folder
from .registry import query, table


def _checkpoint(spark) -> str:
    return new_folder(spark, "stream")


@query("op_stm_01_distinct_texts", "SELECT count(DISTINCT coalesce(text, '')) AS n FROM documents")
def stm_01(spark, sf_dir):
    path = f"{sf_dir}/[d]ocuments.parquet"  # a pattern, since a table may be one file
    stream = S.file_stream(spark, path, table(spark, sf_dir, "documents").schema)
    rows = S.to_end(S.distinct_texts(stream.select("doc_id", "text"), "text").select("sha"), "distinct", _checkpoint(spark))
    return rows.agg(F.count("*").alias("n"))


@query("op_stm_02_windowed_counts", "SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stm_02(spark, sf_dir):
    stream = S.file_stream(spark, f"{sf_dir}/[e]vents.parquet", table(spark, sf_dir, "events").schema)
    counts = S.windowed_counts(stream.select(F.col("ts").cast("timestamp").alias("ts"), "event_type"), "ts", "1 day", "10 minutes", "event_type")
    return S.to_end(counts, "windowed", _checkpoint(spark), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("op_stm_03_running_counters", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def stm_03(spark, sf_dir):
    stream = S.file_stream(spark, f"{sf_dir}/[e]vents.parquet", table(spark, sf_dir, "events").schema)
    sums = stream.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return S.to_end(sums, "running", _checkpoint(spark), "complete")


@query("op_stm_04_rolling_outliers")
def stm_04(spark, sf_dir):
    """Outliers of length within each source, as a stream."""
    stream = S.file_stream(spark, f"{sf_dir}/[d]ocuments.parquet", table(spark, sf_dir, "documents").schema)
    rows = stream.select("doc_id", "source", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
    return S.to_end(S.rolling_outliers(rows, "source", "doc_id", "n"), "outliers", _checkpoint(spark))
