"""The queries of this folder: each operator over its whole table, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import (
    bayes_join,
    cap_dedup,
    log_bilinear,
    merge_codec,
    mixing,
    ranked_search,
    recompression,
    toxicity,
    vector_topk,
    warc,
    whitening,
)
from ledgerflow.llm.common import table
from ledgerflow.llm.packing import pack
from ledgerflow.llm.token_files import read_token_files, token_file_folder, write_token_files
from ledgerflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file on each machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, vocabulary("byte_bpe_50k.json"), keeps_space=True, end_id=0)


@register
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    written = write_token_files(
        docs, token_file_folder(docs), vocabulary("word_bpe_49k.json"), keeps_space=False, end_id=1,
        max_units=800_000,
    )
    return read_token_files(written, keep_ids=False)


@register
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@register
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.archive_report(spark, folder)


ORACLES |= {"op6_mixing": mixing.ORACLE, "op9_warc": warc.ORACLE}


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@register
def op1_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.top_scores(table(spark, sf_dir, "embeddings"), k=20, step=20)


ORACLES["op1_vector_topk"] = vector_topk.ORACLE


@register
def op4_cap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op4_cap_dedup"] = cap_dedup.ORACLE


@register
def op2_bayes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_join.similar_documents(table(spark, sf_dir, "documents"))


@register
def op10_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.repeats_report(table(spark, sf_dir, "documents"))


ORACLES["op10_recompression"] = recompression.ORACLE


@register
def op5_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score_documents(table(spark, sf_dir, "documents"))


@register
def op13_merge_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


ORACLES["op11_ranked_search"] = ranked_search.ORACLE
