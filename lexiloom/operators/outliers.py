"""Lengths that stand out from those before them."""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import DataFrame


class History:
    """Previous lengths: once over `most` of them are held, the last `keep` stay."""

    def __init__(self, most: int = 10_000, keep: int = 5_000):
        self.most, self.keep = most, keep
        self.given: list[int] = []
        self.ordered: list[int] = []
        self.total = self.squares = 0

    def stands_out(self, length: int, z: float = 3.0, fence: float = 1.5) -> bool:
        """More than z sample deviations from the mean, or outside of Tukey's fences; false under ten lengths."""
        n = len(self.given)
        if n < 10:
            return False
        mean = self.total / n
        variance = (self.squares - n * mean * mean) / (n - 1)
        if variance > 1e-9 and abs(length - mean) > z * variance**0.5:
            return True
        low, high = self.ordered[n // 4], self.ordered[3 * n // 4]
        return length < low - fence * (high - low) or length > high + fence * (high - low)

    def add(self, length: int) -> None:
        self.given.append(length)
        bisect.insort(self.ordered, length)
        self.total += length
        self.squares += length * length
        if len(self.given) > self.most:
            self.given = self.given[-self.keep :]
            self.ordered = sorted(self.given)
            self.total = sum(self.given)
            self.squares = sum(x * x for x in self.given)


def length_outliers(rows: DataFrame, key: str, length: str, within: str | None = None) -> DataFrame:
    """key and outlier. The order of all rows matters, so one group is one ordered stream of narrow rows; `within` gives groups that run side by side."""
    narrow = rows.select(key, length, *([within] if within else []))
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = narrow.repartition(n, within).sortWithinPartitions(within, key) if within else narrow.repartition(1).sortWithinPartitions(key)

    def run(batches):
        group, history = object(), History()
        for batch in batches:
            groups = batch.column(within).to_pylist() if within else [None] * batch.num_rows
            out = []
            for g, value in zip(groups, batch.column(length).to_pylist(), strict=True):
                if g != group:
                    group, history = g, History()
                out.append(history.stands_out(value))
                history.add(value)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out)], names=[key, "outlier"])

    return dealt.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, outlier boolean")
