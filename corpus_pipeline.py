"""From raw documents to packed training sequences: rules, line dedup, near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliogrid.llm import jaccard, lines, mixing, packing, quality
from heliogrid.queries.base import table
from heliogrid.session import stage_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy rejects go. A column named ledger may not occur in ``docs``."""
    return quality.with_ledger(docs).filter(quality.passes(quality.STANDARD)).drop("ledger")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, up to an edit in five code points and two in all, go; documents stay, if need be with an empty text."""
    return _sized(lines.dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one_each(docs, jaccard.Similarity(words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is cut or repeated to its target; a document repeated by the mix has a row for each epoch."""
    return _sized(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, placed in sequences of 2048. Workers serve other stages too, so they remember fewer words."""
    return packing.pack(docs, with_ids=True, known_words=300_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Edit distance, similarity of all pairs and the tokenizer are not within reach of SQL.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where the table has it; null texts keep what they had."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each but the last is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
