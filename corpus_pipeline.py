"""A pipeline over the documents table: rules, line dedup, near-dedup, mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on everything that its predecessor kept; its result is written as
Parquet and read again as the next one's docs. All stages but the last return the columns of documents.

No SQL states the whole: the quality weights and near-dup keys need XXH64, the last stage the piece merges. The tests hold
run() against a plain Python version of all five stages. Nulls, ties, repeated rows, empty tables and further columns are
treated as each operator's docstring says: null texts fail the rules, repeated rows are one document, an empty table stays
empty, further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import line_dedup, mixing, quality, sentence_pieces, simhash
from keelson.llm.common import fresh_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, equal or (from 20 characters on) within two edits, leave the texts; n_chars follows. All documents stay."""
    out = line_dedup.line_dedup(docs, short_lines=True)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts (five-word shingles, similarity of 0.8 or more) stays: that with the smallest id. SimHash's trie join and MinHash give the candidates."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: a row for each copy that the mix draws. The columns are those of documents; mixing.mix() itself can add the position."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    return sentence_pieces.encode_texts(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
