"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, benchmark decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's rows as Parquet in the shared folder and
hands them to the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import bpe, decontam, langid, linededup, setjoin
from cytoframe.llm.queries import TOKENIZER
from cytoframe.llm.shared import fold, free_name, table, written

#: Documents whose language is less certain than so many times an even guess among the learned languages are rejected (0.3 of four), but
#: never at a certainty above MOST_NEEDED.
EVEN_GUESSES, MOST_NEEDED = 1.2, 0.6

#: Learned models, edit distances and merges have no SQL form; tests/llm holds stages 2 to 5 against brute force and stage 1 against its rule.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (und, null texts too) or whose predicted language is too uncertain; lang stays as it came.

    Where no row has a language to learn from, every document with a letter stays. Rows of a null or repeated id are judged each by its
    text. Extra columns stay, whatever their names.
    """
    label, score = free_name(docs, "_lang_pred"), free_name(docs, "_lang_score")
    net = langid.train(docs.where(F.coalesce(fold("doc_id", 4), F.lit(0)) != 2))
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = langid.predict(docs, net, keep=tuple(docs.columns), label=label, score=score)
    return known.where((F.col(label) != "und") & (F.col(score) >= min(EVEN_GUESSES / len(net.classes), MOST_NEEDED))).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that repeat an earlier line, one word edit (one character edit in short lines) included; no document goes. n_chars follows the text.

    Rows of a null id or text stay as they are; rows of one id count as one document.
    """
    lines, removed = free_name(docs, "_n_lines"), free_name(docs, "_n_removed")
    kept = linededup.dedup_lines(docs, short=True, n_lines=lines, n_removed=removed)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingle similarity, the one with the smallest doc_id stays; rows of a null id all stay."""
    return setjoin.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap with a benchmark item; rows of a null id or text stay."""
    leak = free_name(docs, "_leak")
    found = decontam.overlaps(docs, table(spark, sf_dir, "benchmark"), short=True).select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(found, docs["doc_id"].cast("long") == found[leak], "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text decoded from them, as counts and digests; a row for every row, null texts as empty ones."""
    return bpe.encode_decode(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole table documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
