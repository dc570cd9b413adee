"""A corpus made ready for training, stage by stage.

Toxic documents go, then near copies but one, then repeated lines, then documents
with benchmark passages; what remains is packed into sequences.  Each stage takes
all rows its predecessor kept, is written, and is read again by the next one.  All
but the last return the columns of documents, whatever they are.

Rows are rejected by what the stage found in their texts, so equal texts fare
alike and rows without id are treated like others; only near duplicates are told
apart by id, and there a row without id stays.  Null texts become empty ones where
lines are removed, and ``n_chars`` is counted anew.  Empty tables pass through all
stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import (
    common,
    decontamination,
    line_dedup,
    near_dedup,
    packing,
    token_counts,
    toxicity,
)


def _without_texts(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose text is not among the rejected ones, given by text_hash."""
    hashed = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    gone = rejected.select(F.col("text_hash").alias("rejected_text")).distinct()
    return docs.join(gone, hashed == gone["rejected_text"], "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold."""
    labels = common.read(spark, sf_dir, "labels").filter(toxicity.fold("doc_id", 3) != 1)
    scored = toxicity.score_toxicity(docs, labels)
    return _without_texts(docs, scored.filter(F.col("score") >= toxicity.THRESHOLD))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies, and all others."""
    copies = near_dedup.near_duplicates(docs).filter("not kept")
    gone = copies.select(F.col("doc_id").alias("rejected_doc")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["rejected_doc"], "left_anti")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand earlier in the corpus."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = line_dedup.remove_repeated_lines(docs, carry=others)
    columns = {c: F.col(f"carried.`{c}`") for c in others}
    columns |= {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage was found."""
    benchmark = common.read(spark, sf_dir, "benchmark")
    return _without_texts(docs, decontamination.find_contamination(docs, benchmark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, token_counts.vocabulary())


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_copies),
    ("repeated lines", without_repeated_lines),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

# Learned scores, alignments and packing have no form in SQL; tests hold the
# stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus; each stage's result is a Parquet table that the next one reads."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
