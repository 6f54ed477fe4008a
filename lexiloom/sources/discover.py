"""Finding exports: newest run, guards, whole folders with their side files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as L
from . import exports as E


def listed(spark: SparkSession, base: str, pattern: str = "*") -> list[tuple[str, int]]:
    """(path, time of change) of what lies under base, by Spark's file systems."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/{pattern}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in found)


def newest(spark: SparkSession, base: str, pattern: str = "*") -> str | None:
    """The newest run: by time of change, then by name."""
    return max(listed(spark, base, pattern), key=lambda x: (x[1], x[0]), default=(None,))[0]


def guarded(name: Column, promote: Column) -> Column:
    """A provider's name in lower case; null for an empty one, and for a filler provider that is not promoted."""
    clean = F.lower(F.trim(name))
    return F.when((clean != "") & (~clean.isin(*L.FILLER_PROVIDERS) | promote), clean)


def guard_provider(name: str, promote: bool = False) -> str:
    """The same for one name before a merge; what is refused raises."""
    clean = (name or "").strip().lower()
    if not clean or (clean in L.FILLER_PROVIDERS and not promote):
        raise ValueError(f"not to be merged unless promoted: {name!r}")
    return clean


def export_of(spark: SparkSession, base: str, provider: str) -> str:
    """Where a provider's export lies under base: the folder or file that its readers take; raises where there is none.

    deepseek has one file, qwen its first file by name, claude its newest folder with conversations.json or else
    one file of an older kind.
    """
    if provider == "qwen":
        found = [p for p, _ in listed(spark, f"{base}/qwen", "qwen-chat-export-*.json")][:1]
    elif provider == "claude":
        whole = newest(spark, f"{base}/claude", "*/conversations.json")
        found = [whole.rsplit("/", 1)[0]] if whole else [p for p, _ in listed(spark, f"{base}/claude", "claude_conversations.json")]
    else:
        found = [p for p, _ in listed(spark, f"{base}/{provider}", "conversations.json")] if provider == "deepseek" else []
    if not found:
        raise FileNotFoundError(f"no export of {provider!r} under {base}")
    return found[0]


# Files that may lie beside conversations.json.
SIDE_FILES = ("projects.json", "memories.json", "users.json")


def claude_folder(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(messages of conversations.json, name, length, sha256 and count of the side files); count is null for a file that holds no list."""
    count = F.json_array_length(F.col("content").cast("string")).cast("long")
    read = lambda n: spark.read.format("binaryFile").load(f"{path}/{n}").select(F.lit(n).alias("name"), "length", F.sha2("content", 256).alias("sha256"), count.alias("count"))
    side = [read(n) for n in SIDE_FILES if listed(spark, path, n)]
    none = spark.createDataFrame([], "name string, length long, sha256 string, count long")
    return E.messages(spark, "claude", f"{path}/conversations.json"), reduce(DataFrame.unionByName, side, none)


def conversations_of(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Conversations of whole-file texts of any root shape.

    A list gives its items; an object with `conversations` those; one with `mapping` itself;
    any other object is a tree of nodes, each of which becomes a conversation of one message.
    """
    text = F.trim(F.col(column))
    item = f"struct<{_fields()}>"
    node = E.CHATGPT.split("map<string, ", 1)[1].rsplit(">", 1)[0]
    as_list = F.when(text.startswith("["), F.from_json(text, f"array<{item}>"))
    wrapped = F.from_json(text, f"conversations array<{item}>")["conversations"]
    single = F.from_json(text, _ddl())
    tree = F.from_json(text, f"map<string, {node}>")
    rows = raw.select(as_list.alias("a"), F.when(~text.startswith("["), wrapped).alias("w"), F.when(~text.startswith("["), single).alias("s"), F.when(~text.startswith("["), tree).alias("t"))
    nodes = F.transform(F.map_entries("t"), lambda e: F.struct(e["key"].alias("id"), e["key"].alias("conversation_id"), F.lit(None).cast("string").alias("title"), e["value"]["message"]["create_time"].alias("create_time"), F.lit(None).cast("double").alias("update_time"), F.map_from_arrays(F.array(e["key"]), F.array(e["value"])).alias("mapping")).cast(item))
    pick = F.when(F.col("a").isNotNull(), F.col("a")).when(F.col("w").isNotNull(), F.col("w")).when(F.col("s.mapping").isNotNull(), F.array(F.col("s").cast(item))).otherwise(nodes)
    return rows.select(F.explode(pick).alias("c")).select("c.*")


def _ddl() -> str:
    return E.CHATGPT.replace("\n", " ")


def _fields() -> str:
    head, mapping = _ddl().split(" mapping ", 1)
    return ", ".join(re.sub(r"^(\w+) ", r"\1: ", x.strip()) for x in head.rstrip(",").split(",") if x.strip()) + ", mapping: " + mapping
