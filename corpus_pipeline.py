"""Document pipeline: stages over documents, each written as Parquet and read again by the next.

Every stage takes nulls in any column, extra columns, repeated rows, very long texts and empty tables; all but the last
return the rows that they keep with their columns as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import common, langid, minhash, packing, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (8), of a quality of 0.5 or more.

    A null or empty text has the evidence of its statistics, zeros; a null source is the host ''. Without labels of both kinds the
    evidence is the smoothed rate of those there are. Rows that repeat are judged alike, and all stay or go.
    """
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text fits the learned languages (7), by models fitted on the labelled ones among those that came so far.

    A null, empty or letterless text is rejected, and every text where no language was learned. Mixes of learned languages stay.
    """
    return langid.keep_known(docs, langid.fit(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (4) at a similarity of 0.8: the one of the least id; of rows alike in id and text one.

    Null and empty texts are like nothing and stay, once an id; rows with a null id stay.
    """
    return minhash.keep_one(docs, 80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids (9). A null or empty text is the end id alone; rows with equal or null ids are documents of their own."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage), ("packing", packing_stage)]

#: Fitted models and byte-level tokens are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.settled(lambda: stage(spark, docs, sf_dir), name)  # a stage's own tables go when its rows are written
    return STAGES[-1][1](spark, docs, sf_dir)
