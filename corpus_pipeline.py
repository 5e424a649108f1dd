"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and returns documents with the columns of ``documents``;
the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm.bayes_join import one_of_each
from ledgerflow.llm.common import table
from ledgerflow.llm.mixing import mix_documents
from ledgerflow.llm.packing import pack
from ledgerflow.llm.queries import vocabulary
from ledgerflow.llm.recompression import without_repeats
from ledgerflow.llm.toxicity import without_toxic
from ledgerflow.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that five-word shingles link, the smallest doc_id stays."""
    return one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a smaller doc_id has, too, are cut out."""
    return without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; one without words is not taken."""
    return mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), keeps_space=True, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("similar_documents", drop_similar),
    ("repeated_passages", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL can train the first stage's classifier; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
