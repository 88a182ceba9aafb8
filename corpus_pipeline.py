"""The documents table through five stages, each written as Parquet and read again.

Every stage takes the columns doc_id, text, lang, source and n_chars by their exact
names and passes all others through, whatever they are called, but for the last,
which returns doc_id, source and what it makes.  Defined results: nulls in any
column and empty texts fail the quality rules, so later stages see them only if
they are called by themselves (see the operators); repeated rows are judged alike
and are one document to near_dedup, which keeps both; ties go to the least doc_id
in near_dedup and the largest in line_dedup; long texts are processed whole; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.blocks import closed, opened, saved
from palaver.llm.bpe import encode
from palaver.llm.line_dedup import dedup_lines
from palaver.llm.mixing import mixed_documents
from palaver.llm.near_dup import drop_near_duplicates
from palaver.llm.quality_rules import quality_filter
from palaver.llm.registry import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more of them share; ``n_chars`` follows the text."""
    cut, names = opened(dedup_lines(docs), "text", "n_chars")
    kind = cut.schema["n_chars"].dataType
    return closed(cut.withColumn("n_chars", F.char_length("text").cast(kind)), names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian uint32) of every document, with what they decode to as a digest."""
    both = encode(opened(docs, "doc_id", "source", "text")[0].select("doc_id", "source", "text"), *vocabulary(), decoded="decoded")
    n = F.floor(F.octet_length("ids") / 4).cast("long")
    return both.select("doc_id", "source", n.alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", mixing),
    ("byte_bpe", tokenization),
]

#: SQL cannot express perplexity bands, order MinHash or byte-pair merges; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
