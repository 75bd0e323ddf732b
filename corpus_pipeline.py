"""The training-data pipeline over ``documents``: its stages in order, and one run of them all.

Each stage works on every row its predecessor kept and passes the columns of ``documents`` on; the last one adds the
sampled pieces. Stages are written and read again between each other (``run`` does so in the shared folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.llm import lines, mixing, near, quality, sampling
from coursemart.llm.common import cut, fold, read
from coursemart.llm.queries import piece_model


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for bad go. It learns from the labelled documents whose fold
    of 3 is not 1. Rows without text are scored like any others; an empty table stays empty."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return quality.keep_good(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, or differ from it by one edit, go; ``n_chars`` follows the text. A document
    that had lines and has lost them all goes; one that was empty or null stays as it was."""
    out = lines.dedup_lines(docs)
    blank = lambda c: F.trim(F.translate(F.coalesce(c, F.lit("")), "\n", " ")) == ""
    cols = [F.col("clean").alias("text") if c == "text" else
            F.when(F.size("dropped") > 0, F.length("clean").cast("bigint")).otherwise(F.col("row.n_chars").cast("bigint")).alias("n_chars")
            if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns]
    return out.filter((F.size("dropped") == 0) | ~blank(F.col("clean"))).select(*cols)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8) stays: the one with
    the smallest id."""
    return near.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat at rates that give them weights by the square root of their sizes; a document comes 0, 1
    or more times. All columns as they were, rows shuffled."""
    return mixing.mix_sources(docs).select(*docs.columns)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a sampled segmentation, ``piece_ids``; every text is checked to decode losslessly."""
    return sampling.encode(docs, piece_model())


STAGES = [
    ("quality_classifier", filter_quality),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("mix_sources", mix_sources),
    ("sentencepiece", sample_pieces),
]

#: Not expressible: trained weights and sampled pieces (tests/llm compare the stages with plain versions).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
