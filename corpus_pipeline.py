"""From raw documents to packed sequences: classify, clean, drop near copies, cut repeated passages, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import materialise
from tidemark.llm.packing import pack
from tidemark.llm.quality import fit_quality
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.rules import quality_rules
from tidemark.llm.shingles import ngram_jaccard


def _with_text(df: DataFrame, text: F.Column, columns: list[str]) -> DataFrame:
    return df.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.3 or more stay; learned from the rows of ``labels`` that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return fit_quality(docs, labels).score(docs).where("predicted = 1").select(docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do documents that fail the base rules or lose too much text with their lines."""
    return _with_text(quality_rules(docs).where("kept"), F.col("cleaned"), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies one row stays, that with the smallest id (a null id comes last).

    Rows are told apart by a 64-bit hash of all that they hold, not by id: repeated ids with different texts are judged
    apart, rows without an id like all others, and of equal rows one stays. Rows without words have no copies.
    """
    held = [x for i, c in enumerate(docs.columns) for x in (F.lit(i), F.col(f"`{c}`").cast("string"))]
    rows = docs.withColumn("_row", F.xxhash64(*held))
    groups = ngram_jaccard(rows.select("_row", "text"), "_row").where("n_shingles > 0")
    ids = rows.groupBy("_row").agg(F.min("doc_id").alias("doc_id"))
    groups = groups.groupBy("_row").agg(F.min("component_id").alias("component_id")).join(ids, "_row")
    groups = materialise(groups, "row-groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = groups.groupBy("component_id").agg(F.min_by("_row", order).alias("_row"))
    gone = groups.join(first, "_row", "left_anti").select("_row")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Asking for the first row lets Spark cut every group of equal rows before the shuffle.
    once = Window.partitionBy("_row").orderBy("doc_id")
    left = rows.where(worded).withColumn("_n", F.row_number().over(once)).where("_n = 1").join(gone, "_row", "left_anti")
    return left.select(docs.columns).union(docs.where(~worded))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that occur more than once go; characters cut in two become replacement characters."""
    left = remove_repeats(docs).withColumn("text", F.make_valid_utf8(F.col("kept").cast("string")))
    return _with_text(left, F.col("text"), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, every window of sequences in the proportions of the sources."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("packing", packing),
]

#: Training a network and merging tokens cannot be said in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
