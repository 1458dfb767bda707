"""Queries of the llm operators, and the corpus pipeline built from them.

The pipeline: documents that the quality ranker rejects go, then those without a clear
language; of each group of near duplicates one stays; passages that an earlier document
holds are cut out; what is left is packed into training sequences. Each stage reads what
its predecessor wrote and, but for the last, returns the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession

from docflow.llm import jaccard_join, language, oracles, packing, quality_classifier, substrings
from docflow.llm.frames import documents, forget, saved, tidy
from docflow.llm.queries import QUERIES as OPERATORS


# What holds for every stage: rows with one doc_id, or none, are rows of their own unless the
# stage says otherwise; equal texts are judged alike; texts are read whole, however long; extra
# columns pass, whatever their names; no rows give no rows.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by a ranker fitted on all labelled ones among them.

    A null text is scored as an empty one. Without labels of both kinds nothing is learned,
    and every document has the same score.
    """
    tidy(spark)
    return quality_classifier.accept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents most of whose words are in one language.

    Null and empty texts, and those without a letter, have no language and go. Rows with a
    null `lang` are not learned from, but judged.
    """
    tidy(spark)
    return language.accept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by similarity: the least doc_id.

    Null and empty texts are linked with nothing and stay, as do rows with a null doc_id. Of
    repeated rows of the id that stays one is kept.
    """
    tidy(spark)
    return jaccard_join.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones hold.

    Null and empty texts stay as they are. Rows with a null doc_id neither lose words nor make
    others lose any; rows of one doc_id count as one document. A document that loses all its
    words goes.
    """
    tidy(spark)
    return substrings.remove(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences.

    A null or empty text is one piece with the end mark only.
    """
    tidy(spark)
    return packing.pack_documents(docs, packing.tokenizer_path())


STAGES = [
    ("quality", quality),
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        before, docs = docs, saved(stage(spark, docs, sf_dir), name)
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # trained models and a tokenizer are beyond SQL; tests hold a plain version against run()

QUERIES = OPERATORS | {"pipeline": run}
SQL = oracles.SQL
