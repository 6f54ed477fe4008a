"""Idempotent merge of a source into a main table, with provenance, dry run and checks.

Plain files know no MERGE: the merged table is worked out anew from both sides and written
as a version of its own; a pointer file names the current one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROVENANCE = ("provider", "provider_run_id", "source_file_sha256", "source_path", "ingested_at")


def with_provenance(rows: DataFrame, values: dict[str, str], key: list[str]) -> DataFrame:
    """Fills missing provenance and makes record_uid = provider:run:key."""
    filled = rows
    for name in PROVENANCE:
        given = F.lit(values.get(name)).cast("string")
        filled = filled.withColumn(name, F.coalesce(F.col(name), given) if name in rows.columns else given)
    return filled.withColumn("record_uid", F.concat_ws(":", "provider", "provider_run_id", *(F.col(k).cast("string") for k in key)))


def drifted(columns: list[str], main: str = "m", source: str = "s") -> Column:
    return reduce(lambda a, b: a | b, (~F.col(f"{main}.{c}").eqNullSafe(F.col(f"{source}.{c}")) for c in columns))


def classified(main: DataFrame, source: DataFrame, uid: str, key: str, columns: list[str]) -> DataFrame:
    """source with status: inserted, updated, skipped, or pk_collision (its key is there under another uid).

    Both unique keys count: a row is new only if neither its uid nor its key is in main; of
    source rows with one key the smallest uid comes first.
    """
    first = source.groupBy(key).agg(F.min(uid).alias("_first"))
    own = source.join(first, key).alias("s")
    by_uid = main.select(uid, *columns).alias("m")
    keys = main.select(F.col(key).alias("_key")).distinct()
    joined = own.join(by_uid, F.col(f"s.{uid}") == F.col(f"m.{uid}"), "left")
    known = F.col(f"m.{uid}").isNotNull()
    status = joined.select("s.*", known.alias("_known"), F.when(known, drifted(columns)).otherwise(F.lit(False)).alias("_drift"))
    marked = status.join(keys, F.col(key) == F.col("_key"), "left")
    kind = F.when(F.col("_known"), F.when(F.col("_drift"), "updated").otherwise("skipped")).when(F.col("_key").isNotNull() | (F.col(uid) != F.col("_first")), "pk_collision").otherwise("inserted")
    return marked.withColumn("status", kind).drop("_known", "_drift", "_key", "_first")


def counters(status: DataFrame) -> DataFrame:
    """One row of counts; collisions are skipped too."""
    return status.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("inserted", "updated", "pk_collision")), F.count_if(F.col("status").isin("skipped", "pk_collision")).alias("skipped"))


def merged(main: DataFrame, source: DataFrame, uid: str, key: str, columns: list[str]) -> DataFrame:
    """main with drifted columns overwritten and new rows added."""
    status = classified(main, source, uid, key, columns)
    changes = status.where("status = 'updated'").select(F.col(uid).alias("_uid"), *(F.col(c).alias(f"_{c}") for c in columns))
    kept = main.join(changes, F.col(uid) == F.col("_uid"), "left")
    updated = kept.select(*(F.when(F.col("_uid").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in main.columns))
    return updated.unionByName(status.where("status = 'inserted'").select(*[c for c in main.columns if c in status.columns]), allowMissingColumns=True)


def dry_run(main: DataFrame, source: DataFrame, uid: str, key: str, columns: list[str]) -> DataFrame:
    """What a merge would do; nothing is written."""
    return counters(classified(main, source, uid, key, columns))


def write_version(rows: DataFrame, base: str) -> str:
    """Writes a new version under base and then names it in base/_current; readers of the old one are not disturbed."""
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = 1 + max((int(s.getPath().getName()[2:]) for s in (fs.listStatus(path) if fs.exists(path) else []) if s.getPath().getName().startswith("v=")), default=0)
    target = f"{base}/v={n}"
    rows.write.parquet(target)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{base}/_current.tmp"), True)
    out.write(bytearray(str(n).encode()))
    out.close()
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/_current"), False)
    fs.rename(jvm.org.apache.hadoop.fs.Path(f"{base}/_current.tmp"), jvm.org.apache.hadoop.fs.Path(f"{base}/_current"))
    return target
