"""From raw documents to token ids: filter, deduplicate, decontaminate, encode.

Each stage works on all that the one before kept, written as Parquet in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import decontamination, jaccard_join, line_dedup, sentencepiece_codec, toxicity
from starmill.llm.queries import PIECE_MODEL
from starmill.llm.rows import identified
from starmill.sources.staging import stage


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects (0.7 or more) go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def repeated_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are taken out of the text; a document left without
    any text stays as an empty one. Other columns, ``n_chars`` among them, stay as they were read."""
    return line_dedup.drop_repeated_lines(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard_join.keep_one_of_each(docs)


def contaminated_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``round_trip`` of every document that is left."""
    coded = sentencepiece_codec.encode(identified(docs), PIECE_MODEL)
    return coded.selectExpr("doc_id", "cast(size(ids) AS long) AS n_tokens", "ids", "round_trip")


STAGES = [
    ("toxicity", toxic_documents_out),
    ("line_dedup", repeated_lines_out),
    ("jaccard_join", one_of_near_duplicates),
    ("decontamination", contaminated_out),
    ("sentencepiece", encoded),
]

#: The learnt score and the model's pieces are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
