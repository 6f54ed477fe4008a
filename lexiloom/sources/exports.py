"""Chat exports of four providers to one message table.

Each reader turns rows of parsed JSON into messages(conversation_id, title, created_at,
updated_at, message_id, parent_id, role, text, create_time). The work is expressions over
nested columns and one explode; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import stripped

# Senders and the roles that they stand for; other senders are dropped.
ROLES = {"human": "user", "user": "user", "assistant": "assistant", "ai": "assistant", "system": "system", "tool": "tool"}

CHATGPT = """id string, conversation_id string, title string, create_time double, update_time double,
mapping map<string, struct<id: string, parent: string, children: array<string>, message: struct<author: struct<role: string>, content: struct<content_type: string, parts: array<string>, text: string>, create_time: double, update_time: double>>>"""
CLAUDE = """uuid string, id string, name string, title string, summary string, created_at string, updated_at string, account struct<uuid: string>,
chat_messages array<struct<uuid: string, text: string, sender: string, created_at: string, content: string>>"""
#: A block of a message's content; its first field with text counts.
CLAUDE_BLOCK = "text string, content string, value string, result string, output string"
DEEPSEEK = """id string, title string, inserted_at string, updated_at string,
mapping map<string, struct<parent: string, children: array<string>, message: struct<inserted_at: string, fragments: array<struct<type: string, content: string>>>>>"""
QWEN = """id string, title string, created_at double, updated_at double,
chat struct<history: struct<messages: map<string, struct<role: string, content: string, content_list: array<struct<phase: string, content: string>>, timestamp: double, parentId: string, childrenIds: array<string>>>>>"""
SCHEMAS = {"chatgpt": CHATGPT, "claude": CLAUDE, "deepseek": DEEPSEEK, "qwen": QWEN}

MESSAGE = ("conversation_id", "title", "created_at", "updated_at", "message_id", "parent_id", "role", "text", "create_time")


# ---- reading


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array (or one object); gzip is read as it is. One task per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines with the column line) of JSON-lines files; blank lines, brackets and trailing commas are passed over."""
    lines = spark.read.text(path).select(F.regexp_replace(F.trim("value"), ",$", "").alias("line"))
    return parsed_lines(lines.where(~F.col("line").isin("", "[", "]", ",")), schema)


def parsed_lines(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    fields = schema if "_corrupt_record" in schema else f"{schema}, _corrupt_record string"
    rows = lines.select("line", F.from_json("line", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    return rows.where(~bad).select("r.*").drop("_corrupt_record"), rows.where(bad).select("line")


def text_payload(df: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The same over payloads in memory: a column of JSON lines."""
    lines = df.select(F.explode(F.split(column, "\r?\n")).alias("line")).select(F.regexp_replace(F.trim("line"), ",$", "").alias("line"))
    return parsed_lines(lines.where(~F.col("line").isin("", "[", "]", ",")), schema)


def format_of(path: str) -> str:
    """By name: json, jsonl, parquet or csv; unknown names count as JSON lines."""
    name = path.lower().removesuffix(".gz")
    for ending, kind in ((".jsonl", "jsonl"), (".ndjson", "jsonl"), (".json", "json"), (".parquet", "parquet"), (".csv", "csv")):
        if name.endswith(ending):
            return kind
    return "jsonl"


def any_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    kind = format_of(path)
    if kind == "json":
        return json_array(spark, path, schema)
    if kind == "jsonl":
        return json_lines(spark, path, schema)[0]
    return spark.read.parquet(path) if kind == "parquet" else spark.read.option("header", True).csv(path)


def file_shards(spark: SparkSession, paths: list[str], pattern: str = "*") -> DataFrame:
    """path, length and sha256 of the files below the paths, each once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(paths)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256")).dropDuplicates(["path"])


def scraped_number(text: Column, pattern: str) -> Column:
    """First match of the pattern's group, commas taken out."""
    return F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", "").try_cast("double")


def code_blocks(text: Column) -> Column:
    """array<struct<language, code>> of fenced blocks."""
    fence = r"(?s)```(\w*)\n(.*?)```"
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(fence), 1).alias("language"), F.regexp_extract_all(text, F.lit(fence), 2).alias("code"))


# ---- normalising


def iso_seconds(value: Column) -> Column:
    """ISO 8601 text to seconds; null if it is none."""
    return F.unix_micros(F.try_to_timestamp(value)) / 1e6


def _joined(parts: Column, between: str) -> Column:
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), between)


def chatgpt(exports: DataFrame, keep_system: bool = False, between: str = " ") -> DataFrame:
    """Blank texts go, system turns too unless they are kept."""
    nodes = exports.select(F.coalesce("id", "conversation_id", F.lit("unknown")).alias("conversation_id"), F.coalesce("title", F.lit("Untitled")).alias("title"), first_time(exports).alias("created_at"), F.col("update_time").alias("updated_at"), F.explode(F.map_entries("mapping")).alias("n"))
    message = F.col("n.value.message")
    rows = nodes.where(message.isNotNull()).select(
        "conversation_id", "title", "created_at", "updated_at",
        F.col("n.key").alias("message_id"), F.col("n.value.parent").alias("parent_id"),
        F.coalesce(message["author"]["role"], F.lit("unknown")).alias("role"),
        F.coalesce(F.when(F.size(message["content"]["parts"]) > 0, _joined(message["content"]["parts"], between)), message["content"]["text"], F.lit("")).alias("text"),
        message["create_time"].alias("create_time"),
    )
    kept = rows.where(stripped(F.col("text")) != "")
    return kept if keep_system else kept.where("role <> 'system'")


def first_time(exports: DataFrame) -> Column:
    """First time that is there: the conversation's, else any of its messages', in mapping order."""
    times = F.flatten(F.transform(F.map_values("mapping"), lambda n: F.array(n["message"]["create_time"], n["message"]["update_time"])))
    return F.coalesce(exports["create_time"], exports["update_time"], F.get(F.filter(times, lambda t: t.isNotNull()), F.lit(0)))


def content_text(content: Column) -> Column:
    """Text of a message's content, read as JSON text: a plain string is itself; of a list, bare strings and the first filled field of each block."""

    def block(b: Column) -> Column:
        parts = F.from_json(b, CLAUDE_BLOCK)
        filled = F.coalesce(*(F.when(stripped(parts[c]) != "", stripped(parts[c])) for c in ("text", "content", "value", "result", "output")))
        return F.when(b.startswith("{"), filled).when(stripped(b) != "", stripped(b))

    blocks = F.when(F.ltrim(content).startswith("["), F.from_json(content, "array<string>"))
    return F.when(blocks.isNotNull(), _joined(F.transform(blocks, block), "\n\n")).otherwise(stripped(content))


def claude(exports: DataFrame) -> DataFrame:
    """Text from the message or else its content blocks; each message's parent is the one before it."""
    key = F.coalesce("uuid", "id")
    title = F.coalesce(F.when(stripped(F.col("name")) != "", stripped(F.col("name"))), F.when(stripped(F.col("title")) != "", stripped(F.col("title"))), F.lit("Untitled"))
    rows = exports.where(key.isNotNull()).select(key.alias("conversation_id"), title.alias("title"), iso_seconds(F.col("created_at")).alias("_made"), iso_seconds(F.col("updated_at")).alias("_changed"), F.explode("chat_messages").alias("m"))
    direct = stripped(F.coalesce("m.text", F.lit("")))
    text = F.when(direct != "", direct).otherwise(F.coalesce(content_text(F.col("m.content")), F.lit("")))
    roles = F.create_map(*(F.lit(x) for kv in ROLES.items() for x in kv))
    order = Window.partitionBy("conversation_id").orderBy(F.coalesce("create_time", F.lit(0.0)), F.coalesce("m.uuid", F.lit("")))
    placed = rows.withColumn("create_time", iso_seconds(F.col("m.created_at"))).withColumn("i", F.row_number().over(order) - 1)
    placed = placed.withColumn("role", F.try_element_at(roles, stripped(F.lower("m.sender")))).withColumn("text", text).where("role IS NOT NULL AND text <> ''")
    named = placed.withColumn("message_id", F.coalesce("m.uuid", F.concat("conversation_id", F.lit("_m"), F.col("i").cast("string"))))
    chain, whole = Window.partitionBy("conversation_id").orderBy("i"), Window.partitionBy("conversation_id").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return named.select(
        "conversation_id", "title",
        F.coalesce("_made", F.first("create_time").over(whole)).alias("created_at"), F.coalesce("_changed", F.last("create_time").over(whole)).alias("updated_at"),
        "message_id", F.lag("message_id").over(chain).alias("parent_id"), "role", "text", "create_time",
    )


def deepseek(exports: DataFrame) -> DataFrame:
    """A request fragment makes the message a user's; thoughts stay only where nothing else is."""
    nodes = exports.select(F.col("id").alias("conversation_id"), F.coalesce("title", F.lit("Untitled")).alias("title"), iso_seconds(F.col("inserted_at")).alias("created_at"), iso_seconds(F.col("updated_at")).alias("updated_at"), F.explode(F.map_entries("mapping")).alias("n"))
    parts = F.col("n.value.message.fragments")
    asked = F.exists(parts, lambda f: F.upper(F.coalesce(f["type"], F.lit(""))) == "REQUEST")
    texts = lambda keep: F.transform(F.filter(parts, keep), lambda f: f["content"])
    answer = _joined(texts(lambda f: F.upper(F.coalesce(f["type"], F.lit(""))) != "THINK"), "\n\n")
    text = F.when(asked, _joined(texts(lambda f: F.upper(f["type"]) == "REQUEST"), "\n\n")).when(answer != "", answer).otherwise(_joined(F.transform(parts, lambda f: f["content"]), "\n\n"))
    rows = nodes.where(F.size(parts) > 0).select("conversation_id", "title", "created_at", "updated_at", F.col("n.key").alias("message_id"), F.col("n.value.parent").alias("parent_id"), F.when(asked, "user").otherwise("assistant").alias("role"), stripped(text).alias("text"), F.coalesce(iso_seconds(F.col("n.value.message.inserted_at")), F.col("created_at")).alias("create_time"))
    return rows.where("text <> ''")


def qwen(exports: DataFrame) -> DataFrame:
    """Answers come from the phase `answer` where there is one; a time of 0 is none."""
    some = lambda c: F.when(F.col(c) != 0, F.col(c))
    nodes = exports.select(F.col("id").alias("conversation_id"), F.coalesce("title", F.lit("Untitled")).alias("title"), some("created_at").alias("created_at"), some("updated_at").alias("updated_at"), F.explode(F.map_entries("chat.history.messages")).alias("n"))
    m = F.col("n.value")
    answer = _joined(F.transform(F.filter(m["content_list"], lambda i: i["phase"] == "answer"), lambda i: i["content"]), "\n\n")
    plain = F.coalesce(m["content"], F.lit(""))
    text = F.when(m["role"] == "user", plain).otherwise(F.when(F.coalesce(answer, F.lit("")) != "", answer).otherwise(plain))
    rows = nodes.where(m["role"].isin("user", "assistant")).select("conversation_id", "title", "created_at", "updated_at", F.col("n.key").alias("message_id"), m["parentId"].alias("parent_id"), m["role"].alias("role"), stripped(text).alias("text"), F.coalesce(m["timestamp"], F.col("created_at")).alias("create_time"))
    return rows.where("text <> ''")


READERS = {"chatgpt": chatgpt, "claude": claude, "deepseek": deepseek, "qwen": qwen}


def messages(spark: SparkSession, provider: str, path: str) -> DataFrame:
    return READERS[provider](any_records(spark, path, SCHEMAS[provider]))
