"""Queries of the operators over whole tables, with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import bpe, chunks, decontam, divergence, embeddings, langid, linededup, middle, packing, runindex, setjoin, tokenfile, toxicity
from cytoframe.llm.shared import fold, shared_folder, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op1_line_dedup_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1_line_dedup with word edits up to a fifth of the longer line and one character edit in short lines."""
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"), whole=True)
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = toxicity.train(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    return toxicity.score(docs.withColumn("held_out", fold("doc_id", 5) == 0), field, keep=("doc_id", "held_out"))


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup_chunks(table(spark, sf_dir, "documents")).drop("kept")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    tokenfile.write_token_file(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return tokenfile.read_token_file(spark, path)


def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.drop_repeats(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs.where(fold("doc_id", 4) != 2))
    return langid.predict(docs.withColumn("held_out", fold("doc_id", 4) == 2), net, keep=("doc_id", "held_out"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return packing.packed_sequences(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(middle.restored()).alias("restored_sha256"))


NAMED = (op1_line_dedup, op1_line_dedup_whole, op2_bpe_roundtrip, op3_toxicity, op4_chunk_dedup, op5_embedding_dedup, op6_ngram_jaccard, op7_decontamination, op8_token_file, op9_repeated_substrings, op10_language_id, op11_source_divergence, op12_best_fit_packing, op13_fill_in_middle)
QUERIES = {f.__name__: f for f in NAMED}
ORACLE: dict[str, str] = {"op11_source_divergence": divergence.SQL, "op13_fill_in_middle": middle.SQL}
