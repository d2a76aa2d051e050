"""A corpus pipeline: each stage reads what the stage before has kept, written as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, linededup, minhash, mixing, quality
from strandline.llm.lineage import checkpoint_dir, cut, remove
from strandline.session import table

#: Characters of a block in the last stage, half of bpe's: executors still hold memory of the stages before.
BLOCK = 1 << 23

#: The stages are a classifier, a similarity search and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def _columns(spark: SparkSession, sf_dir: str) -> list[str]:
    return table(spark, sf_dir, "documents").columns


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents of which the quality classifier predicts label 0.

    Null and empty texts are scored like any other, and so is each row of a repeated id; rows with a null id are
    scored but not learnt from. Without a label 1 every document stays. An empty table stays empty.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model, name="score of the classifier")
    return scored.where(F.col("score of the classifier") >= quality.CUT).select(_columns(spark, sf_dir))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove chunks of two lines or more that occur before, and bring n_chars up to date; what has no line left goes.

    So a document that only repeats others goes here, and no other. Null and empty texts stay, null with a null
    n_chars. Rows that repeat id and text keep the same lines; of equal texts the smallest id keeps all, a null id
    being smallest. An empty table stays empty.
    """
    found = linededup.dedup_lines(docs).where("n_lines = 0 or n_removed < n_lines")
    kept = found.withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(_columns(spark, sf_dir))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, that of the smallest id.

    Rows are told apart by id and text: of rows that share an id, those whose text is in no other's group stay, and
    of rows equal in both one stays. Rows with a null id, and texts without words, are in no group and all
    stay. An empty table stays empty.
    """
    marks = cut(minhash.near_duplicates(docs).where("n_shingles > 0 and doc_id is not null").select("doc_id", "text_hash", "stays"))
    gone = _few(marks.where("not stays").select("doc_id", "text_hash").distinct())
    repeats = marks.where("stays").groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows")).where("rows > 1")
    repeats = _few(repeats.select("doc_id", "text_hash"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", _row(docs))
    on = ["doc_id", "text_hash"]
    kept = hashed.join(gone, on, "left_anti")
    twice = kept.join(repeats, on, "left_semi").dropDuplicates(["doc_id", "text"])
    return _unpacked(kept.join(repeats, on, "left_anti").unionByName(twice), _columns(spark, sf_dir))


def _row(docs: DataFrame) -> Column:
    """The row as one column, so that no name of its own can clash."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row")[c].alias(c) for c in columns])


def _few(ids: DataFrame) -> DataFrame:
    """Ids and hashes, to be broadcast if they are at most minhash.BROADCAST_IDS."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= minhash.BROADCAST_IDS else ids


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it, to the nearest whole number; 0 leaves it out.

    Documents without words are never taken. Null is a source of its own. Rows that share id, source and number
    of words are taken as often as they are on average; a null id counts as an id here. An empty table stays
    empty.
    """
    taken = mixing.mix_sources(docs).where("size > 0")
    times = taken.groupBy("doc_id", "source", "size").agg(F.avg(F.col("taken") / F.col("size")).alias("passes"))
    copies = times.select(
        F.col("doc_id").alias("id"), F.col("source").alias("from"), F.col("size").alias("words"), F.round("passes").cast("int").alias("copies")
    ).where("copies > 0")
    sized = docs.select("doc_id", "source", mixing.words_of(F.col("text")).alias("words_here"), _row(docs))
    same = (
        sized.doc_id.eqNullSafe(copies.id) & sized.source.eqNullSafe(copies["from"]) & (sized.words_here == copies.words)
    )
    joined = sized.join(copies, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return _unpacked(joined, _columns(spark, sf_dir))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed as unsigned 32-bit integers, and digests of ids and decoded text.

    A null or empty text has no ids; repeated rows repeat their result; an empty table stays empty.
    """
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_decode(docs, path, keep=("doc_id", "lang", "source"), block=BLOCK)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_near),
    ("mix_sources", mix),
    ("bpe_encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what each returns is written to the shared folder and read again.

    A stage's rows are deleted once the next has written its own; those of the last stay, as the result reads them.
    """
    checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        if before is not None:
            remove(spark, before)
        before = f"{root}/{name}"
    return docs
