"""Structured Streaming forms of the stateful operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.outliers import History


def file_stream(spark: SparkSession, path: str, schema, format: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of a folder (or a path pattern)."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def to_end(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there now and gives its rows from files under the checkpoint folder."""
    out = f"{checkpoint}/rows"
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{checkpoint}/log").queryName(name).trigger(availableNow=True).start()
    else:  # each batch gives the whole result anew
        write = lambda df, _: df.write.mode("overwrite").parquet(out)
        query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{checkpoint}/log").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def distinct_texts(stream: DataFrame, text: str) -> DataFrame:
    """First row of each text. Without a watermark the state holds a digest of every text seen."""
    return stream.withColumn("sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).dropDuplicates(["sha"])


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts by time window; rows later than `late` are dropped and closed windows leave the state."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def rolling_outliers(stream: DataFrame, group: str, key: str, length: str) -> DataFrame:
    """key and outlier for each row, against the lengths of its group seen before; the history is the group's state."""
    schema = f"{key} long, outlier boolean"

    def step(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        history = History()
        if state.exists:
            for value in state.get[0]:
                history.add(value)
        for pdf in batches:
            pdf = pdf.sort_values(key)
            found = []
            for value in pdf[length].tolist():
                found.append(history.stands_out(value))
                history.add(value)
            yield pd.DataFrame({key: pdf[key], "outlier": found})
        state.update((history.given,))

    return stream.groupBy(group).applyInPandasWithState(step, schema, "given array<long>", "append", GroupStateTimeout.NoTimeout)
