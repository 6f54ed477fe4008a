"""Schema inference over JSON texts: paths, union types, presence, provider fingerprints."""

from __future__ import annotations

import json
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys that mark an export of each provider.
FINGERPRINTS = {
    "chatgpt": ["mapping", "create_time", "update_time", "current_node", "conversation_id"],
    "claude": ["uuid", "chat_messages", "account", "name", "created_at"],
    "deepseek": ["mapping", "inserted_at", "fragments", "updated_at"],
    "qwen": ["chat", "history", "created_at", "content_list"],
}

_KIND = {str: "str", bool: "bool", int: "int", float: "float", type(None): "null", dict: "object", list: "array"}


def paths_of(value: object, out: Counter) -> None:
    """Counts (path, type) of a parsed value; array elements share the path `[]`."""
    stack = [("$", value)]
    while stack:
        path, v = stack.pop()
        out[path, _KIND[type(v)]] += 1
        if isinstance(v, dict):
            stack.extend((f"{path}.{k}", x) for k, x in v.items())
            if not v:
                out[path, "empty_object"] += 1
        elif isinstance(v, list):
            stack.extend((f"{path}[]", x) for x in v)
            if not v:
                out[path, "empty_list"] += 1


def path_types(rows: DataFrame, column: str) -> DataFrame:
    """path, type and n over a column of JSON texts; a text that is no JSON counts as ($, malformed). Partial counts leave each task."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is None:
                    continue
                try:
                    paths_of(json.loads(text), seen)
                except ValueError:
                    seen["$", "malformed"] += 1
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in seen], pa.string()), pa.array([t for _, t in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["path", "type", "n"])

    return rows.select(column).mapInArrow(run, "path string, type string, n long").groupBy("path", "type").agg(F.sum("n").alias("n"))


MARKS = ("empty_list", "empty_object", "malformed")


def inferred(types: DataFrame) -> DataFrame:
    """path, types (sorted union), n, parent, presence (n of the path over objects of the parent) and optional."""
    real = types.where(~F.col("type").isin(*MARKS))
    union = real.groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("type")), "|").alias("types"), F.sum("n").alias("n"))
    union = union.withColumn("parent", F.regexp_replace("path", r"(\[\]|\.[^.\[\]]*)$", ""))
    objects = real.where("type IN ('object', 'array')").groupBy(F.col("path").alias("parent")).agg(F.sum("n").alias("parents"))
    out = union.join(objects, "parent", "left")
    inside = F.col("path").endswith("[]") | (F.col("path") == "$")
    presence = F.when(inside, F.lit(1.0)).otherwise(F.col("n") / F.col("parents").cast("double"))
    return out.select("path", "types", "n", presence.alias("presence"), (~inside & (presence < 1)).alias("optional"))


def anomalies(types: DataFrame) -> DataFrame:
    return types.where(F.col("type").isin(*MARKS)).select("path", F.col("type").alias("anomaly"), "n")


def fingerprint(keys: Column, name: Column | None = None) -> Column:
    """Best provider of an array of keys, or null: share of its marks that are there, at least 0.6, or 0.4 where the file's name holds the provider's."""
    entries = []
    for provider, marks in FINGERPRINTS.items():
        share = F.size(F.array_intersect(keys, F.array(*map(F.lit, marks)))) / F.lit(float(len(marks)))
        named = F.contains(F.lower(name), F.lit(provider)) if name is not None else F.lit(False)
        fits = (share >= 0.6) | (named & (share >= 0.4))
        entries.append(F.struct(fits.alias("fits"), named.alias("named"), share.alias("share"), F.lit(provider).alias("provider")))
    best = F.array_max(F.array(*entries))
    return F.when(best["fits"], best["provider"])


def rendered(paths: list[tuple[str, str, bool]]) -> str:
    """A Markdown table of (path, types, optional), for reports."""
    lines = ["| path | types | |", "|-|-|-|"]
    return "\n".join(lines + [f"| {p} | {t} | {'?' if o else ''} |" for p, t, o in sorted(paths)])
