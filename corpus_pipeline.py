"""Corpus pipeline: quality rules, exact dedup, near duplicates, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodeframe.llm.common import cut
from lodeframe.llm.exact_dedup import keep_one
from lodeframe.llm.jaccard_join import keep_first
from lodeframe.llm.mixing import mixed_docs
from lodeframe.llm.packing import VOCABULARY, pack
from lodeframe.llm.quality import keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside their compression bands, judged row by row.

    Rows with a null, empty or blank text go, and so do those under 50 words; very long texts are judged whole;
    repeated rows and rows that share a doc_id are judged each; there are no ties. An empty table stays
    empty; all columns are kept, whatever their names.
    """
    return keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact copies, the longest, then the one with the smallest doc_id.

    Null, empty and blank texts would be one group. Rows go by themselves, so other texts of a doc_id, or
    of rows without one, stay; of tied rows one stays; very long texts are compared whole. An empty table
    stays empty; all columns are kept, whatever their names.
    """
    return keep_one(docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, 80 %), the one with the smallest doc_id, null last.

    Null, empty and blank texts link with nothing. Rows go by themselves, so other texts of a doc_id stay;
    ties go by the text's hash; very long texts are compared whole. An empty table stays empty; all columns
    are kept, whatever their names.
    """
    return keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut with its first words.

    A null source is one of its own; null, empty and blank texts have no words and go. Rows are taken by
    themselves, whatever their doc_id; ties in the random key go by doc_id, size and row; very long texts are
    taken or cut like others. An empty table stays empty; all columns are kept, whatever their names.
    """
    return mixed_docs(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts would give the end id alone; very long texts are cut into pieces; repeated rows, as the
    mix makes them, are packed each; tied pieces are alike. An empty table gives no pieces; further columns
    are left out.
    """
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [("quality", good), ("exact_dedup", distinct), ("near_duplicates", apart), ("mixing", mixed), ("packing", packed)]

#: Compression ratios, tokens and packing have no SQL; the pipeline is tested against its parts by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over a folder's documents, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
