"""Corpus pipeline: quality rules, near-duplicate removal, source mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``documents``, whatever else the table holds. Between
stages the rows are written as Parquet to shared storage and read again.

Defined results: a text without words fails the quality rules; of rows that repeat a
doc_id one stays, and rows without doc_id all stay; the mix repeats a row up to twice
and leaves rows out so that each source comes near its target; an empty table passes
through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.llm import bpe, mixing, near_duplicates, quality
from workwindow.llm.common import ship_code, table, tokenizer
from workwindow.session import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the line labeller keep."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest doc_id (null last)."""
    ship_code(spark)
    return near_duplicates.keep_one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; of equal rows each as often as the one that is
    taken least."""
    mix = mixing.mix_sources(docs)
    copies = mix.groupBy(
        F.col("doc_id").alias("id"), F.col("source").alias("src"), F.col("text_key").alias("key")
    ).agg(F.min(F.size("shards")).alias("copies"))
    rows = docs.select(F.struct("*").alias("row"))
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("id"))
        & F.col("row.source").eqNullSafe(F.col("src"))
        & (mixing.text_key(F.col("row.text")) == F.col("key"))
    )
    rows = rows.join(copies.filter("copies > 0"), same)
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row."""
    ship_code(spark)
    encoded = bpe.encode_documents(docs, tokenizer("word_bpe_49k.json"), decode=False)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_documents),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed_sources),
    ("bpe", token_ids),
]

#: Neither the line labeller nor BPE can be said in SQL; tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
