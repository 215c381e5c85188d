"""Driver queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgermill
from ledgermill.llm.centroids import cluster_vectors
from ledgermill.llm.decontaminate import find_leaks
from ledgermill.llm.html_text import extract_text
from ledgermill.llm.lattice import lattice_scores
from ledgermill.llm.line_dedup import drop_repeated_lines
from ledgermill.llm.minhash import near_duplicates
from ledgermill.llm.mixing import mix_sources
from ledgermill.llm.nearest import nearest
from ledgermill.llm.phrases import collocations
from ledgermill.llm.pii import replace_personal_data
from ledgermill.llm.substrings import remove_repeats
from ledgermill.llm.token_counts import count_tokens
from ledgermill.llm.toxicity import fit, held_out, score_toxicity


ROOT = str(Path(ledgermill.__file__).resolve().parent.parent)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers look for this package where the driver found it, if it is not installed.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, top=20)


def op4_pii_surrogates(spark: SparkSession, sf_dir: str, key: bytes = b"replace with a secret key") -> DataFrame:
    found = replace_personal_data(table(spark, sf_dir, "documents"), key)
    return found.select(F.col("doc").alias("doc_id"), "text", "n_replaced", "kinds")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    shares = (F.max(c).alias(c) for c in ("lcs", "answer_lcs", "cosine"))
    return found.groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).agg(*shares)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op7_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as file:
        return count_tokens(table(spark, sf_dir, "documents"), file.read())


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return found.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_lattice(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    with open(public_tokenizers.path(model), "rb") as file:
        return lattice_scores(table(spark, sf_dir, "documents"), file.read(), kind_col="lang")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_html_text": op2_html_text,
    "op3_nearest": op3_nearest,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_decontaminate": op5_decontaminate,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_mix_sources": op9_mix_sources,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_phrases": op11_phrases,
    "op12_centroids": op12_centroids,
    "op13_lattice": op13_lattice,
}
