"""A corpus, from raw documents to packed sequences: five stages over the table ``documents``.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formloom.llm import langid, mixing, packing, simhash, toxicity
from formloom.llm.common import CUTS, cut, drop_cuts, table


#: Above the scores of nearly all texts of random letters (2 of 500 pass), below those of nearly all held-out documents told right.
MIN_MARGIN = 0.03


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay; und, narrow margins and documents whose halves differ go."""
    return langid.keep_identified(docs, langid.fit(docs), min_score=MIN_MARGIN, whole=True)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold stay."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id: five-word shingles, Jaccard of 0.8 and more."""
    return simhash.keep_distinct(docs, words=5, similarity=0.8)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document: its bin and place there."""
    rows = cut(packing.items(docs), "items")
    return packing.pack(rows, rows.count())


STAGES = [
    ("language ID", language),
    ("toxicity", clean),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is a table of its own in the shared folder, as long as it is read."""
    docs, since = table(spark, sf_dir, "documents"), len(CUTS)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = cut(stage(spark, docs, sf_dir), f"stage{i}")
        drop_cuts(spark, since, docs)  # the stage's own tables, and the one that it has read
    return STAGES[-1][1](spark, docs, sf_dir)


#: The models of the first two stages have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None
