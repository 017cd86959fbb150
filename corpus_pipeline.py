"""A training-data pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; what it decides takes
effect: rejected documents, copies and documents with test items go, personal data is masked in the texts,
and the last stage packs what is left into token sequences. Between stages the rows are written as Parquet
and read again, so a lost executor repeats part of one stage.

Odd rows: a null text is empty, so the first stage rejects it (fewer than 50 words); repeated rows are rejected or kept
alike there, and of rows with one id and one shingle set the second stage keeps one; unlike texts under one id, and rows
without an id, are judged by their own text in every stage; texts of any length are read whole; extra columns come
through the first four stages, whatever their names; empty tables give empty tables, and without usable labels only
the base test of the first stage rejects, and an empty ``benchmark`` rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import decontaminate, ngram_join, packing, pii, quality_rules
from tillsight.llm.common import read, written
from tillsight.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and match no learned rule."""
    rules = quality_rules.learn_rules(docs, read(spark, sf_dir, "labels"))
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))  # extra columns may have any name
    return quality_rules.judge(whole, rules, keep=["_row"]).where("kept").select("_row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every class of near copies."""
    return ngram_join.one_of_each(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked."""
    return pii.redact(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), "blanks", end_id=1)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontamination),
          ("PII", personal_data), ("packing", pack)]

#: Learned rules, MinHash classes and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-").lower())
    return docs


def registry() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
