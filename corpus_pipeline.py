"""A corpus from raw documents: language, exact and near copies, packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return rows of documents with all their columns, whatever further ones there are. An empty table
gives an empty result in every stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnfold.llm.common import checkpoint_folder, table
from tarnfold.llm.exact_dedup import keep_first, without
from tarnfold.llm.language_id import fit, held_out, keep_identified
from tarnfold.llm.near_dedup import near_groups
from tarnfold.llm.packing import pack
from tarnfold.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, by classifiers learned from those with a label.

    Texts that are null or have no letter go, and ambiguous ones; repeated rows are judged alike.
    """
    return keep_identified(docs, fit(docs.filter(~held_out())))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest doc_id.

    A null text counts as an empty one; of repeated rows one stays; null ids come last.
    """
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, a similarity of 0.8 or more).

    The one with the smallest doc_id stays; texts without words and rows without doc_id all stay;
    an id stays or goes with all its rows.
    """
    groups = near_groups(docs, words=5, share=80, of=100)
    return without(docs, groups.filter("not kept").select("doc_id").distinct())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 ids.

    A null or empty text is the single id 0; repeated rows are packed each for itself.
    """
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("packing", packed),
]

#: The tokenizer's ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. Stages between are written to the shared folder, so none runs twice."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for at, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
    return STAGES[-1][1](spark, docs, sf_dir)
