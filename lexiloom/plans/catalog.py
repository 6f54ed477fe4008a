"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import corpus, described, files, samples, streams, tables
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "described", "files", "flagship", "samples", "streams", "tables"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From messages to metrics, gate and topic rollup."""
    rows = corpus.D.gate(corpus.metrics(spark, sf_dir), corpus.POLICY)
    return rows.groupBy("topic_primary").agg(F.count(F.lit(1)).alias("conversations"), F.count_if("passed").alias("passed"), F.round(F.avg("information_gain"), 6).alias("avg_information_gain"))
