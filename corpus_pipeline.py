"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that its
predecessor kept. The first four return the columns of ``documents``; the last
one returns the packed pieces. Rows with the same doc_id share their decisions;
null texts are read as empty; extra columns pass through the filters.

``ORACLE_SQL`` is None: the classifiers' fits and the tokenizer have no SQL form;
the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cierre.llm import packing, quality, repeats, simhash, toxicity
from cierre.session import cut_lineage

ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return toxicity.accepted(docs, model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    model = quality.fit(docs, _labels(spark, sf_dir))
    return quality.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each near-duplicate class."""
    return simhash.representatives(docs, shingle=3, distance=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that an earlier document holds."""
    return repeats.trimmed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, release=True)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_copies", drop_near_copies),
          ("repeats", cut_repeats), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``. Each stage's rows are kept
    in the checkpoint folder for the next, which may read them more than once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = cut_lineage(docs)
    return docs
