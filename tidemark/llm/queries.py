"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archive import archive_folder, read_archive, write_archive
from .chat import format_chat
from .lexical import lexical_search
from .licences import scan_licences
from .mixing import mix_sources, taken_words
from .negatives import hard_negatives
from .packing import pack
from .pieces import encode_pieces
from .quality import fit_quality, held_out
from .repeats import remove_repeats
from .rules import quality_rules
from .shingles import ngram_jaccard
from .vectors import near_duplicate_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(documents, _table(spark, sf_dir, "labels"))
    scored = model.score(documents, keep_text=False)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chat(_table(spark, sf_dir, "conversations"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive_folder(spark)
    write_archive(_table(spark, sf_dir, "pages"), folder)
    records = read_archive(spark, folder).withColumn("record_sha256", F.sha2("record", 256))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_sha256")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(_table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids, decoded text and byte spans (all begins, then all ends), and the bytes that the spans reach."""
    pieces = encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2(F.array_join(F.concat("begins", "ends").cast("array<string>"), " "), 256).alias("spans_sha256"),
        F.array_max("ends").cast("long").alias("n_source_bytes"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text", "cleaned")


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(_table(spark, sf_dir, "documents"))
    return taken_words(mix).select("doc_id", "size", "source_size", "target", "taken")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_packing": op3_packing,
    "op4_chat_format": op4_chat_format,
    "op5_licence_scan": op5_licence_scan,
    "op6_warc": op6_warc,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality_rules": op10_quality_rules,
    "op11_source_mixing": op11_source_mixing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}
