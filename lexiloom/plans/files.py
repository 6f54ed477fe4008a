"""Sinks and file sources as queries: each writes to the shared folder and reads back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokens as K
from ..operators import merge as M
from ..operators import schema as S
from ..operators import sinks as W
from ..operators import validate as V
from ..sources import discover as D
from ..sources import exports as E
from ..storage import written
from . import samples as P
from . import tables as T
from .corpus import _BASE as _MSGS
from .corpus import _CONV, clean, metrics
from .registry import query, table
from .streams import _checkpoint as folder

_TOK = "greatest(1, length(t) // 4)"


@query("op_snk_03_parquet_metrics", f"{P._BASE} SELECT doc_id, source, CAST({_TOK} AS BIGINT) AS n_tokens FROM s")
def snk_03(spark, sf_dir):
    rows = P.samples(spark, sf_dir).select("doc_id", "source", K.char_tokens(F.col("t")).alias("n_tokens"))
    return W.to_parquet(rows, folder(spark), ["source"]).select("doc_id", "source", "n_tokens")


@query("op_snk_04_csv_report", f"{P._BASE} SELECT source, CAST(sum({_TOK}) AS BIGINT) AS n_tokens FROM s GROUP BY 1")
def snk_04(spark, sf_dir):
    rows = P.samples(spark, sf_dir).groupBy("source").agg(F.sum(K.char_tokens(F.col("t"))).alias("n_tokens"))
    return W.to_csv(rows, folder(spark))


@query("op_snk_05_artifact", "SELECT '{\"documents\":' || count(*) || ',\"chars\":' || sum(n_chars) || '}' AS json FROM documents")
def snk_05(spark, sf_dir):
    row = table(spark, sf_dir, "documents").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))
    return spark.createDataFrame([(W.artifact(row),)], "json string")


def _section_sql(place: int, title: str, column: str) -> str:
    rows = f"SELECT '| ' || {column} || ' | ' || count(*) || ' | ' || CAST(sum(total_tokens) AS BIGINT) || ' |' AS text, row_number() OVER (ORDER BY count(*) DESC, {column}) + 4 AS i FROM conv GROUP BY {column}"
    head = f"SELECT unnest(['', '## {title}', '', '| {column} | n | tokens |', '|-|-|-|']) AS text, unnest(range(5)) AS i"
    return f"SELECT {place} AS place, i, text FROM ({head} UNION ALL SELECT text, i FROM ({rows}) WHERE i < 55)"


@query("op_snk_06_markdown_report", f"{_CONV}, report AS (SELECT 0 AS place, 0 AS i, '# Corpus' AS text UNION ALL {_section_sql(1, 'Topics', 'topic_primary')} UNION ALL {_section_sql(2, 'Tones', 'tone_cluster')}) SELECT CAST(row_number() OVER (ORDER BY place, i) - 1 AS INT) AS line, text FROM report")
def snk_06(spark, sf_dir):
    m = metrics(spark, sf_dir).select("topic_primary", "tone_cluster", "total_tokens").cache()
    counted = lambda c: m.groupBy(c).agg(F.count("*").alias("n"), F.sum("total_tokens").alias("tokens")).orderBy(F.desc("n"), c)
    text = W.markdown("Corpus", {"Topics": counted("topic_primary"), "Tones": counted("tone_cluster")})
    m.unpersist()
    return spark.createDataFrame([(i, line) for i, line in enumerate(text.split("\n"))], "line int, text string")


@query("op_snk_07_dashboard_frames", f"{_CONV} SELECT 'period' AS frame, CAST(period AS VARCHAR) AS label, CAST(sum(total_tokens) AS BIGINT) AS v FROM conv GROUP BY 2 UNION ALL SELECT 'topic', topic_primary, count(*) FROM conv GROUP BY 2 UNION ALL SELECT 'tone', tone_cluster, count(*) FROM conv GROUP BY 2")
def snk_07(spark, sf_dir):
    m = metrics(spark, sf_dir)
    items = F.array(F.struct(F.lit("period").alias("frame"), F.col("period").cast("string").alias("label"), F.col("total_tokens").cast("long").alias("x")), F.struct(F.lit("topic").alias("frame"), F.col("topic_primary").alias("label"), F.lit(1).cast("long").alias("x")), F.struct(F.lit("tone").alias("frame"), F.col("tone_cluster").alias("label"), F.lit(1).cast("long").alias("x")))
    return m.select(F.explode(items).alias("i")).groupBy("i.frame", "i.label").agg(F.sum("i.x").alias("v"))


def _written_export(spark: SparkSession, sf_dir: str, provider: str, as_array: bool) -> str:
    """Export files of a provider in a new shared folder: JSON lines, or arrays of conversations."""
    base = folder(spark)
    raw = T.raw_exports(spark, sf_dir, provider)
    if as_array:
        W.to_json_arrays(raw, base)
    else:
        raw.write.text(base)
    return base


_IDS = "SELECT CAST(conversation_id AS VARCHAR) AS conversation_id, count(*) AS n FROM msgs GROUP BY 1"


def _per_conversation(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conversation_id").agg(F.count("*").alias("n"))


@query("op_src_01_json_array", f"{_MSGS} {_IDS}")
def src_01(spark, sf_dir):
    return _per_conversation(E.chatgpt(E.json_array(spark, _written_export(spark, sf_dir, "chatgpt", True), E.CHATGPT)))


@query("op_src_02_line_fallback", f"{_MSGS} {_IDS}")
def src_02(spark, sf_dir):
    """An array read line by line: brackets and trailing commas are passed over, nothing comes twice."""
    path = _written_export(spark, sf_dir, "chatgpt", True)
    lines = spark.read.text(path).select(F.regexp_replace(F.regexp_replace(F.trim("value"), r"^\[|\]$", ""), ",$", "").alias("line")).where("line <> ''")
    return _per_conversation(E.chatgpt(E.parsed_lines(lines, E.CHATGPT)[0]))


@query("op_src_04_payloads", "SELECT count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events")
def src_04(spark, sf_dir):
    good, _ = E.text_payload(table(spark, sf_dir, "events").select("props"), "props", "k long")
    return good.agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("op_src_07_record_messages", f"{_MSGS} SELECT CAST(conversation_id AS VARCHAR) AS conversation_id, sha256(string_agg(text, '|' ORDER BY create_time NULLS LAST, conversation_id || '-' || turn)) AS sha FROM msgs GROUP BY 1")
def src_07(spark, sf_dir):
    """Messages in time order, those without a time last."""
    rows = E.chatgpt(E.json_lines(spark, _written_export(spark, sf_dir, "chatgpt", False), E.CHATGPT)[0], keep_system=True)
    key = F.struct(F.col("create_time").isNull().alias("late"), "create_time", "message_id", "text")
    return rows.groupBy("conversation_id").agg(F.array_sort(F.collect_list(key)).alias("x")).select("conversation_id", F.sha2(F.array_join(F.transform("x", lambda e: e["text"]), "|"), 256).alias("sha"))


@query("op_src_08_shards", "SELECT 3 AS n, true AS all_hashed")
def src_08(spark, sf_dir):
    paths = [f"{sf_dir}/{t}.parquet" for t in ("nation", "region", "supplier")]
    return E.file_shards(spark, [*paths, paths[0]]).agg(F.count("*").cast("int").alias("n"), F.bool_and(F.length("sha256") == 64).alias("all_hashed"))


@query("op_src_09_auto_detect", "SELECT * FROM (VALUES ('a.json.gz', 'json'), ('b.JSONL', 'jsonl'), ('c.parquet', 'parquet'), ('d.csv', 'csv'), ('e', 'jsonl')) AS t(name, kind)")
def src_09(spark, sf_dir):
    return spark.createDataFrame([(n, E.format_of(n)) for n in ("a.json.gz", "b.JSONL", "c.parquet", "d.csv", "e")], "name string, kind string")


def _roots(spark, sf_dir) -> DataFrame:
    """The same conversations under four root shapes: list, wrapper, single, bare tree."""
    raw = T.raw_exports(spark, sf_dir, "chatgpt").select("raw", F.get_json_object("raw", "$.id").cast("long").alias("id"))
    tree = F.get_json_object("raw", "$.mapping")
    shape = F.when(F.col("id") % 4 == 0, F.concat(F.lit("["), "raw", F.lit("]"))).when(F.col("id") % 4 == 1, F.concat(F.lit('{"conversations": ['), "raw", F.lit("]}"))).when(F.col("id") % 4 == 2, F.col("raw")).otherwise(tree)
    return raw.select(shape.alias("raw"))


@query("op_src_10_root_shapes", f"{_MSGS} SELECT CASE WHEN conversation_id % 4 = 3 THEN conversation_id || '-' || turn ELSE CAST(conversation_id AS VARCHAR) END AS conversation_id, count(*) AS n FROM msgs GROUP BY 1")
def src_10(spark, sf_dir):
    """List or tree roots; each node of a bare tree becomes a conversation."""
    return _per_conversation(E.chatgpt(D.conversations_of(_roots(spark, sf_dir))))


@query("op_src_12_all_roles", f"{_MSGS} SELECT role, count(*) AS n FROM msgs GROUP BY 1")
def src_12(spark, sf_dir):
    """Five root shapes with system turns kept."""
    return E.chatgpt(D.conversations_of(_roots(spark, sf_dir)), keep_system=True).groupBy("role").agg(F.count("*").alias("n"))


def _as_array(rows: DataFrame, column: str) -> DataFrame:
    """The JSON texts of a small table as one array."""
    return rows.agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(column)), ",\n"), F.lit("]")).alias(column)).coalesce(1)


_USERS_SQL = "SELECT '[' || string_agg('\"' || n_name || '\"', ',' || chr(10) ORDER BY n_name) || ']' || chr(10) AS body, count(*) AS n FROM nation"


@query("op_src_14_claude_folder", f"""{_MSGS}, users AS ({_USERS_SQL}) SELECT CAST(conversation_id AS VARCHAR) AS item, count(*) AS n, NULL AS sha256 FROM msgs GROUP BY 1
UNION ALL SELECT 'users.json', n, sha256(body) FROM users UNION ALL SELECT 'projects.json', NULL, sha256('{{}}' || chr(10))""")
def src_14(spark, sf_dir):
    """A folder with conversations.json and two side files, of which one is no list: messages by conversation, counts and hashes of the side files."""
    base = folder(spark)
    W.to_json_arrays(T.raw_exports(spark, sf_dir, "claude"), f"{base}/conversations.json")
    _as_array(table(spark, sf_dir, "nation").select(F.to_json(F.array("n_name")).alias("v")).select(F.expr("substring(v, 2, length(v) - 2)").alias("v")), "v").write.text(f"{base}/users.json")
    spark.range(1).select(F.lit("{}")).coalesce(1).write.text(f"{base}/projects.json")
    messages, side = D.claude_folder(spark, base)
    own = _per_conversation(messages).select(F.col("conversation_id").alias("item"), "n", F.lit(None).cast("string").alias("sha256"))
    return own.unionByName(side.select(F.col("name").alias("item"), F.col("count").alias("n"), "sha256"))


@query("op_src_17_discovery", f"{_MSGS}, p AS (SELECT unnest(['claude', 'deepseek', 'qwen']) AS provider, unnest(['new', 'conversations.json', 'qwen-chat-export-1.json']) AS found) SELECT p.provider, found, count(*) AS messages, sum(length(text)) AS chars FROM p, msgs GROUP BY 1, 2")
def src_17(spark, sf_dir):
    """Each provider's export found among others of its folder and read."""
    base, out = folder(spark), []
    put = lambda provider, name: W.to_json_arrays(T.raw_exports(spark, sf_dir, provider), f"{base}/{provider}/{name}")
    spark.range(1).select(F.lit("[]")).write.text(f"{base}/claude/old/conversations.json")
    spark.range(1).select(F.lit("[]")).write.text(f"{base}/claude/claude_conversations.json")
    put("claude", "new/conversations.json")
    put("deepseek", "conversations.json")
    put("qwen", "qwen-chat-export-1.json")
    spark.range(1).select(F.lit("[]")).write.text(f"{base}/qwen/qwen-chat-export-2.json")
    for provider in ("claude", "deepseek", "qwen"):
        path = D.export_of(spark, base, provider)
        rows = D.claude_folder(spark, path)[0] if provider == "claude" else E.messages(spark, provider, path)
        out.append(rows.agg(F.count("*").alias("messages"), F.sum(F.length("text")).alias("chars")).select(F.lit(provider).alias("provider"), F.lit(path.rsplit("/", 1)[-1]).alias("found"), "messages", "chars"))
    return reduce(DataFrame.unionByName, out)


@query("op_src_19_table_scan", "SELECT count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE lang = 'en'")
def src_19(spark, sf_dir):
    """A named view, asked in SQL."""
    return spark.sql("SELECT count(*) AS n, sum(n_chars) AS chars FROM {docs} WHERE lang = 'en'", docs=table(spark, sf_dir, "documents"))


@query("op_src_21_sampled_schema", "SELECT '$.k' AS path, 'int' AS types FROM events LIMIT 1")
def src_21(spark, sf_dir):
    """Schema of the first 5000 records; the limit is the feature of this sampling reader."""
    first = table(spark, sf_dir, "events").orderBy("event_id").limit(5000)
    return S.inferred(S.path_types(first, "props")).where("path = '$.k'").select("path", "types")


@query("op_tok_02_pluggable_backend")
def tok_02(spark, sf_dir):
    """Any function from a text Column to a count is a backend; here the piece model of the public files."""
    import pandas as pd
    import public_tokenizers as tok

    path, cache = tok.path("piece_bpe_32k.model"), []

    def counted(values: pd.Series) -> pd.Series:
        if not cache:
            import sentencepiece

            cache.append(sentencepiece.SentencePieceProcessor(model_file=path))
        return pd.Series([len(x) for x in cache[0].encode(values.fillna("").tolist(), num_threads=1)])

    backend = F.pandas_udf(counted, "long", F.PandasUDFType.SCALAR) if hasattr(F, "PandasUDFType") else F.pandas_udf(counted, "long")
    rows = P.samples(spark, sf_dir).select("doc_id", "t")
    return K.with_token_counts(rows, "t", backend, "n_tokens").select("doc_id", "n_tokens")


@query("op_tok_09_whole_file", "SELECT 1 AS files, CAST(1 AS BIGINT) AS at_least FROM region LIMIT 1")
def tok_09(spark, sf_dir):
    """Tokens of a whole export as one text, whose parts in the order of their names are the array of all conversations."""
    import public_tokenizers as tok

    path = folder(spark)
    W.to_text_array(written(T.raw_exports(spark, sf_dir, "chatgpt"), "raw"), path)
    n = K.whole_text_tokens(spark, path, tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)
    return n.agg(F.count("*").cast("int").alias("files"), F.min(F.least(F.col("n"), F.lit(1))).alias("at_least"))


@query("op_tok_10_exact_or_fail", f"{_MSGS} SELECT CAST(sum(greatest(1, char_count // 4)) AS BIGINT) AS tokens, 'PASS' AS verdict FROM msgs")
def tok_10(spark, sf_dir):
    """Content tokens; a corpus without any fails."""
    row = clean(spark, sf_dir).agg(F.sum(F.greatest(F.lit(1), F.floor(F.col("char_count") / 4))).alias("tokens"))
    return row.select("tokens", F.when(F.col("tokens") > 0, "PASS").otherwise(F.raise_error(F.lit("no content tokens")).cast("string")).alias("verdict"))


@query("op_mrg_03_snapshot", f"{T._MERGE} SELECT count(*) AS n, 1 AS version FROM m")
def mrg_03(spark, sf_dir):
    """The main table as a version of its own before a merge."""
    path = M.write_version(T.main_table(spark, sf_dir), folder(spark))
    return spark.read.parquet(path).agg(F.count("*").alias("n")).withColumn("version", F.lit(int(path.rsplit("=", 1)[1])))


_GIVEN = "['chatgpt', ' Claude ', 'DeepSeek', 'qwen', '', NULL][CAST(conv_id % 6 AS INT) + 1]"


@query("op_mrg_06_provider_guard", f"WITH g AS (SELECT DISTINCT conv_id, lower(trim({_GIVEN})) AS name, conv_id % 5 = 0 AS promote FROM conversations) SELECT conv_id, CASE WHEN coalesce(name, '') = '' OR (name IN ('deepseek', 'qwen') AND NOT promote) THEN 'refused' ELSE name END AS result FROM g")
def mrg_06(spark, sf_dir):
    """Filler providers are refused unless they are promoted; one name and flag for each conversation."""
    rows = T.table(spark, sf_dir, "conversations").select("conv_id").distinct()
    given = F.get(F.array(*map(F.lit, ("chatgpt", " Claude ", "DeepSeek", "qwen", "", None))), (F.col("conv_id") % 6).cast("int"))
    return rows.select("conv_id", F.coalesce(D.guarded(given, F.col("conv_id") % 5 == 0), F.lit("refused")).alias("result"))


@query("op_mrg_10_ledgers", f"{_MSGS} SELECT provider, 'r1' AS run, CAST(sum(char_count) AS BIGINT) AS chars FROM msgs GROUP BY 1")
def mrg_10(spark, sf_dir):
    """Ledgers of all runs, written as JSON and read as one table."""
    base = folder(spark)
    clean(spark, sf_dir).groupBy("provider").agg(F.sum("char_count").alias("chars")).withColumn("run", F.lit("r1")).write.partitionBy("run").json(base)
    return spark.read.schema("provider string, chars long, run string").json(base)


@query("op_sch_05_template")
def sch_05(spark, sf_dir):
    """The inferred schema as a Markdown table, line by line."""
    rows = S.inferred(S.path_types(T.raw_exports(spark, sf_dir, "qwen"), "raw"))
    shape = rows.select(F.regexp_replace("path", r"messages\.[^.\[]+", "messages.*").alias("path"), "types", "optional").groupBy("path").agg(F.max("types").alias("types"), F.bool_or("optional").alias("optional"))
    text = S.rendered([(r.path, r.types, r.optional) for r in shape.collect()])  # paths of a schema are few
    return spark.createDataFrame(list(enumerate(text.split("\n"))), "line int, text string")


@query("op_sch_06_rollup_document", f"{P._QUALITY_SQL} SELECT to_json({{'documents': count(*), 'chars': (SELECT CAST(sum(n_chars) AS BIGINT) FROM documents), 'sources': (SELECT count(DISTINCT source) FROM documents), 'mean_quality': round(avg(quality), 6)}}) AS document FROM q")
def sch_06(spark, sf_dir):
    """Counts, quality and schema of the corpus as one JSON document."""
    docs = table(spark, sf_dir, "documents").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"), F.count_distinct("source").alias("sources"))
    quality = P.message_quality(P.samples(spark, sf_dir)).agg(F.round(F.avg("quality"), 6).alias("mean_quality"))
    both = docs.withColumn("k", F.lit(1)).join(quality.withColumn("k", F.lit(1)), "k").drop("k")  # one row each
    return both.select(F.to_json(F.struct("*")).alias("document"))


@query("op_val_09_release_checks", "SELECT 'counts' AS gate, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM documents UNION ALL SELECT 'unique_ids', CASE WHEN count(*) = count(DISTINCT doc_id) THEN 'PASS' ELSE 'FAIL' END FROM documents UNION ALL SELECT 'visuals', 'SKIP'")
def val_09(spark, sf_dir):
    row = table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))
    return V.gates(row, {"counts": F.col("n") > 0, "unique_ids": F.col("n") == F.col("ids"), "visuals": F.lit(None).cast("boolean")})
