"""The operators' registered queries: each runs one operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.llm import ann, audit, exact, lines, lm, merkle, mixing, near, quality, sampling, tokenfile, toxic, vectors
from coursemart.llm.common import fold, read


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors against all, cosine 0.9."""
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with an even crc32 of the id are the snapshot, the others the arriving batch."""
    return exact.exact_dedup(read(spark, sf_dir, "documents"), fold("doc_id", 2) == 1)


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose fold of 5 is not 1; scores all."""
    return lm.lm_score(read(spark, sf_dir, "documents"), fold("doc_id", 5) != 1, piece_model())


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat earlier ones, equal or within one edit."""
    out = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", F.col("clean").alias("text"), "n_lines", F.size("dropped").alias("n_dropped"),
                      F.concat_ws(",", F.col("dropped").cast("array<string>")).alias("dropped_lines"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits on the labelled documents whose fold of 5 is not 0; scores all."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxic.fit(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxic.score(docs, net).select("row.doc_id", (fold("row.doc_id", 5) == 0).alias("held_out"), "score",
                                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, written in id order, read back."""
    import public_tokenizers

    path = tokenfile.tokenize_to_files(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    rows = tokenfile.token_crc32(tokenfile.read_tokens(spark, path))
    return tokenfile.token_starts(spark, path, rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: every document's component and links."""
    out = near.jaccard_join(read(spark, sf_dir, "documents"))
    return (out.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .select(F.col("id").alias("doc_id"), "class_id", "n_links", (F.col("kept") & (F.col("nth") == 1)).alias("kept"),
                    F.col("n").alias("n_shingles")))


def op8_sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, decoded again: ``lossless`` says whether the text came back."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = sampling.decode(sampling.encode(docs, piece_model()), piece_model())
    return pieces.select("doc_id", "piece_ids", F.size("piece_ids").alias("n_pieces"), F.sha2("decoded", 256).alias("decoded_sha256"),
                         F.coalesce(F.col("text"), F.lit("")).eqNullSafe(F.col("decoded")).alias("lossless"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target weight of a source: the square root of its size; as many rows out as in, in expectation."""
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits on the labelled documents whose fold of 3 is not 1; scores all."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return quality.score(docs, model).select("row.doc_id", (fold("row.doc_id", 3) == 1).alias("held_out"), "score",
                                             (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms in at least 10 documents of their language; all pairs of sources, ten terms a source."""
    return audit.divergence(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document a leaf; every fifth (by crc32 of its id) is checked with its text lower-cased."""
    return merkle.manifest(read(spark, sf_dir, "documents"), tampered=merkle.tampered_rows())


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each vector whose id is divisible by 20, among all."""
    return ann.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_token_files": op6_token_files,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_sample_pieces": op8_sample_pieces,
    "op9_mix_sources": op9_mix_sources,
    "op10_quality": op10_quality,
    "op11_source_divergence": op11_source_divergence,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLE: dict[str, str] = {
    "op1_near_vectors": vectors.ORACLE,
    "op2_exact_dedup": exact.ORACLE,
    "op4_line_dedup": lines.ORACLE,
    "op9_mix_sources": mixing.ORACLE,
    "op11_source_divergence": audit.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
