"""Queries over the corpus tables, one for each corpus operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, editprint, embeddings, htmltext, linededup, minhash, mixing, quality, repeats, sharding
from strandline.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = make
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return keep


@query("op4_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf_dir, "pages"))


@query("op6_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op1_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


@query("op2_edit_fingerprints")
def edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edited_likeness(table(spark, sf_dir, "documents"))


@query("edit_near_texts")
def edit_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The banding and verification of op2: classes of texts up to a share of edits apart."""
    return editprint.near_texts(table(spark, sf_dir, "documents"))


@query("op3_sharding")
def karmarkar_karp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 16)


@query("op7_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"), 200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_bpe_word_table")
def bpe_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_line_dedup", linededup.ORACLE)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


@query("op10_mixing", mixing.ORACLE)
def golden_ratio_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))

