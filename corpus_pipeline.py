"""A corpus pipeline over documents: stages that each apply one operator, written and read again between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import labelled, near_dedup, quality, spread_lines, toxicity
from tidewire.llm.arrow import bounded_batches
from tidewire.llm.queries import pack_50k, table
from tidewire.plans.binding import bind
from tidewire.session import new_run_folder

KEEP_QUALITY = 0.7
REJECT_TOXICITY = 0.5


def _scored(docs: DataFrame, scorer) -> DataFrame:
    """``_doc`` (all columns) and ``_score``, computed once per row."""
    whole = docs.select(F.struct(*docs.columns).alias("_doc"))
    return bind(whole, "_score", scorer(F.col("_doc.text"))["score"])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels")
    model = quality.learn_quality(docs, labels, labelled.crc_fold("doc_id", 4) != 2)
    return _scored(docs, quality.quality_scorer(model)).where(F.col("_score") >= KEEP_QUALITY).select("_doc.*")


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity tagger does not reject."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.learn_toxicity(docs, labels, labelled.crc_fold("doc_id", 5) != 0)
    return _scored(docs, toxicity.toxicity_scorer(model)).where(F.col("_score") < REJECT_TOXICITY).select("_doc.*")


def drop_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated occurrences of lines that many sources share.

    A document of which nothing is left (all of it stands elsewhere) goes; one that had no text before stays.
    """
    out = spread_lines.remove_spread_lines(docs, removed="_removed")
    emptied = (F.col("_removed") > 0) & ~F.col("text").rlike(r"\S")
    changed = out.where(~emptied).withColumn("n_chars", F.when(
        F.col("_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return changed.select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    found = near_dedup.near_duplicates(docs)
    return docs.join(found.where(~F.col("kept")).select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return pack_50k(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("toxicity", keep_harmless),
    ("line dedup", drop_spread_lines),
    ("MinHash near-dedup", keep_one_of_each),
    ("best-fit packing", pack_sequences),
]

# The classifiers and packing have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written below the shared folder and read by the next."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    folder = new_run_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
