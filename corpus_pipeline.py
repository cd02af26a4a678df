"""A corpus from raw documents to token ids, in stages over Parquet.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the
columns of documents, and extra ones with them, whatever their names. ``run`` writes each stage's result to the shared folder and
reads it back for the next one, so a lost executor costs part of one stage. An empty table goes through all stages and stays empty.
Rows without an id are judged like others, but never count as copies of one another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import compression_bands, group_matrix, mixing, pii, sentencepieces
from ledgerloom.llm.common import read
from ledgerloom.session import stage_table


def with_length(df: DataFrame) -> DataFrame:
    """``n_chars`` as it is after a change of the text."""
    return df.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in df.columns else df


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside the compression bands go; so do NULL and empty texts, which have too few words.

    Repeated rows get the same verdict each.
    """
    return compression_bands.keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest id: sets of five-word shingles that share at least 0.8.

    Rows that agree in id and text are one. NULL and empty texts and rows without an id all stay.
    """
    return group_matrix.one_of_each(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked, disclosing terms generalised or removed. NULL and empty texts stay as they are, and no row goes.

    Rows that agree in id and text are changed alike.
    """
    return with_length(pii.sanitised(docs, "doc_id"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Texts without words, NULL ones among them, weigh nothing; a NULL source is one of its own.

    Ties go by id and text, so reruns agree.
    """
    return mixing.mix_rows(docs, "doc_id", "source", "text")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's text, and whether they decode to it; NULL and empty texts have none. One row comes out for each that goes in."""
    return sentencepieces.round_trips(docs).select("doc_id", "source", "lang", "ids", "n_pieces", "round_trip")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Compression ratios, group matrices and piece tries have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
