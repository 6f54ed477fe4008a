"""Writers of tables, artifacts and training files; reports rendered from few aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import preference


def to_parquet(rows: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """zstd files, in folders by the columns given; gives the table read back."""
    writer = rows.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def to_csv(rows: DataFrame, path: str) -> DataFrame:
    """One file with a header, for small report tables."""
    rows.coalesce(1).write.option("header", True).csv(path)
    return rows.sparkSession.read.schema(rows.schema).option("header", True).csv(path)


def to_json_lines(rows: DataFrame, path: str) -> DataFrame:
    rows.write.json(path)
    return rows.sparkSession.read.schema(rows.schema).json(path)


def to_json_arrays(texts: DataFrame, path: str, most: int = 4 << 20) -> None:
    """One column of JSON texts as files that hold one array each, of about `most` bytes or one longer text: any task writes and later reads no more at once."""
    name = texts.columns[0]

    def run(batches):
        import pyarrow as pa

        def array(parts):
            return pa.RecordBatch.from_arrays([pa.array(["[" + ",\n".join(parts) + "]"])], names=["value"])

        held, size = [], 0
        for batch in batches:
            for t in batch.column(name):
                text = t.as_py()
                if held and size + len(text) > most:
                    yield array(held)
                    held, size = [], 0
                held.append(text)
                size += len(text)
        if held:
            yield array(held)

    texts.where(F.col(name).isNotNull()).mapInArrow(run, "value string").write.option("maxRecordsPerFile", 1).text(path)


def to_text_array(texts: DataFrame, path: str) -> None:
    """One column of JSON texts, all different, as one array whose text goes over part files in the order of their names; the table is read twice."""
    value = F.col(texts.columns[0])
    low, high = texts.agg(F.min(value), F.max(value)).first()
    if low is None:
        return texts.sparkSession.range(1).select(F.lit("[]")).write.text(path)
    line = F.concat(F.when(value == low, "[").otherwise(""), value, F.when(value == high, "]").otherwise(","))
    return texts.where(value.isNotNull()).orderBy(value).select(line).write.text(path)


def artifact(row: DataFrame) -> str:
    """A one-row result as a JSON text."""
    return row.toJSON().first()


def markdown(title: str, tables: dict[str, DataFrame], most: int = 50) -> str:
    """A report of aggregated tables; of each at most the first rows are shown, which is a feature of the report."""
    out = [f"# {title}"]
    for name, df in tables.items():
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        out += ["| " + " | ".join(str(v) for v in r) + " |" for r in df.limit(most).collect()]
    return "\n".join(out)


def sft_records(messages: DataFrame) -> DataFrame:
    """conversation_id and messages(role, content) in order, for supervised tuning."""
    turns = F.array_sort(F.collect_list(F.struct("position", "role", F.col("text").alias("content"))))
    return messages.groupBy("conversation_id").agg(turns.alias("t")).select("conversation_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def dpo_records(messages: DataFrame) -> DataFrame:
    """prompt, rejected, chosen, correction_type and confidence of the preference pairs."""
    return preference.pairs(messages).select("conversation_id", "position", "prompt", "rejected", "chosen", "correction_type", "confidence")
