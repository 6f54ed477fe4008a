"""A corpus pipeline: quality rules, toxicity, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each stage's
result to the shared folder and rereads it as the next stage's docs. All stages but the last
return the columns of documents. Stages filter rows where they stand: no text is shuffled for
a decision of the row itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import decontam, minhash, packing, quality, toxicity
from lexiloom.llm.common import discard, scratch, table, written
from lexiloom.llm.queries import toxicity_labels

#: Documents of at least this score are rejected.
TOXIC = 0.7
#: Ids of dropped documents up to this number (8 bytes each) are broadcast; beyond it they are joined by shuffle.
MAX_BROADCAST = 2_000_000


def shielded(docs: DataFrame) -> tuple[DataFrame, list]:
    """(docs with other columns under names that no operator uses, the columns that give docs back)."""
    known = {"doc_id", "text", "lang", "source"}
    named = {c: c if c in known else f"_column_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in named.items())), [F.col(n).alias(c) for c, n in named.items()]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and is no outlier of its language and source."""
    docs, back = shielded(docs)
    measured = written(quality.measured(docs), "quality")  # with the texts, so that each is measured once
    estimates, n_groups = quality.fit(measured)
    return quality.judged(measured, estimates, n_groups).where("kept").select(*back)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic."""
    docs, back = shielded(docs)
    model = toxicity.train(docs, toxicity_labels(table(spark, sf_dir, "labels")))
    return toxicity.scored(docs, model, "_toxic").where(F.col("_toxic") < TOXIC).select(*back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that of the smallest id; sets are of five words, J is 0.8 or more."""
    dropped = written(minhash.near_duplicates(docs, minhash.Near(words=5)).where("NOT kept").select("doc_id").distinct(), "dropped")
    return docs.join(F.broadcast(dropped) if dropped.count() <= MAX_BROADCAST else dropped, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    docs, back = shielded(docs)
    found = decontam.find(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("spans") == 0).select(*back)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; one row for each piece of a document."""
    how = packing.default_packing()
    return packing.pack(packing.pieces(docs, how), how)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: No stage but the base rules can be put in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages; what a stage wrote on its way, and its input, go once its result stands."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:
            out = keep(written(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        discard(docs)
        docs = out
    return docs
