"""A training-data pipeline of five stages over the documents table.

Toxic documents go, repeated passages of lines are removed, one document of each group of
near duplicates stays, sources are mixed to target weights, and what is left is packed into
sequences of token ids. Each stage's rows are written as Parquet and read again as the next
one's documents; all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import toxicity
from rowloom.llm.common import read_table, staged
from rowloom.llm.jaccard import one_of_each
from rowloom.llm.linededup import deduplicate_lines
from rowloom.llm.mixing import mixed_texts
from rowloom.llm.packing import pack, piece_digest
from rowloom.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among them, doesn't reject."""
    return toxicity.reject(docs, read_table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of windows of three lines."""
    return deduplicate_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents so that sources have their target weights."""
    return mixed_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, with a checksum of each piece's ids."""
    return piece_digest(pack(docs, tokenizer_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fitted models and token ids are beyond SQL; tests/llm/test_pipeline.py holds the stages and their
# chain against plain Python on a small table: the mix by its spans, sums and plan, since it is drawn.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, "stage")
    return docs
