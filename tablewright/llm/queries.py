"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.bpe import round_trip
from tablewright.llm.collision_projections import near_vectors
from tablewright.llm.collocations import collocations
from tablewright.llm.fingerprints import edit_pairs
from tablewright.llm.html_text import extract
from tablewright.llm.jaccard_join import shingle_classes
from tablewright.llm.packing import packed
from tablewright.llm.sharding import shard_rows
from tablewright.llm.suffix_array import duplicate_spans
from tablewright.llm.suffix_tree import without_repeats
from tablewright.llm.toxicity import scored
from tablewright.llm.url_filter import ALLOW, BLOCK, Rule, url_verdicts
from tablewright.llm.whitening import whitened


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = shingle_classes(read(spark, sf_dir, "documents"), k=3, num=9, den=10)
    return classes.select("doc_id", "n_shingles", "component_id", "n_links")


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_spans(read(spark, sf_dir, "documents")).drop("span_starts", "span_ends")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("segments")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(read(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_pairs(read(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op10_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"))


URL_RULES = (
    Rule(ALLOW, "com/"),
    Rule(BLOCK, "example.com/en/"),
    Rule(ALLOW, "www.example.com/en/"),
    Rule(BLOCK, "net/es/"),
    Rule(BLOCK, "net/fr/"),
)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_verdicts(read(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read(spark, sf_dir, "embeddings"), most=32)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"), least=100, share=100, top=2000)


QUERIES = {
    "op1_projections": op1_projections,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_suffix_array": op3_suffix_array,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_bpe": op6_bpe,
    "op7_sharding": op7_sharding,
    "op8_fingerprints": op8_fingerprints,
    "op9_html": op9_html,
    "op10_suffix_trees": op10_suffix_trees,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}
