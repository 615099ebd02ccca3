"""From raw documents to packed sequences: four stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.jaccard_join import firsts_of_classes
from tablewright.llm.packing import packed
from tablewright.llm.suffix_tree import cleaned_documents
from tablewright.llm.toxicity import harmless
from tablewright.sources.staging import drop_staged, new_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; null and empty texts are scored as texts without words.

    Without labels, or with labels of one kind, nothing is known to be toxic and nothing goes
    unless all labels say so. Repeated rows are scored alike. An empty table stays empty.
    """
    return harmless(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles one stays: the smallest id.

    Null and blank texts have no shingles and all stay, a null text as the empty one. Null ids
    come last, so a copy with an id is kept before one without. Repeated rows are copies.
    """
    return firsts_of_classes(docs, k=5, num=4, den=5)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur elsewhere leave the texts; no row goes.

    A text that loses words is the kept ones joined by one space, and ``n_chars`` follows; other
    texts stay as they are, a null text as the empty one. A text may lose all its words.
    """
    return cleaned_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 1024 tokens.

    Every row is packed: an empty text is its end token alone, rows with equal or null ids are
    separate documents. An empty table has no pieces.
    """
    return packed(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, capacity=1024
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("packing", pack_sequences),
]

# A fitted classifier and a tokenizer are no SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over all documents; what lies between the stages is dropped."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            drop_staged(spark, before)
        before = path
    return docs
