"""Nearest neighbours, votes over their labels, and the index table behind them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions.columns import cosine, dot, idf_weight, norm
from strandline.operators.joins import broadcast_if_small

#: Query vectors that may be sent to all tasks (their size is checked); more are taken in turns.
QUERY_ROWS = 4096
#: Vectors that are compared each with each.
REPRESENTATIVES = 4096


def _search(ids: np.ndarray, queries: np.ndarray, k: int, metric: str, skip_self: bool):
    def score(block: np.ndarray) -> np.ndarray:
        if metric == "cosine":
            block = block / np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-9)
            return block @ (queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)).T
        if metric == "dot":
            return block @ queries.T
        return -np.sqrt(np.maximum(((block[:, None, :] - queries[None]) ** 2).sum(axis=2), 0))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        for frame in frames:
            if not frame.num_rows:
                continue
            own = frame.column(0).to_numpy(zero_copy_only=False)
            scores = score(np.stack(frame.column(1).to_numpy(zero_copy_only=False)).astype(np.float64))
            for q, qid in enumerate(ids):
                mine, found = scores[:, q], own != qid if skip_self else np.ones(len(own), bool)
                if found.sum() > k:
                    found &= mine >= -np.partition(-mine[found], k - 1)[k - 1]
                both = np.append(best[q][0], own[found]), np.append(best[q][1], mine[found])
                order = np.lexsort((both[0], -both[1]))[:k]
                best[q] = both[0][order], both[1][order]
        rows = [(qid, i, s) for qid, b in zip(ids, best) for i, s in zip(*b)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())],
            names=["query_id", "id", "score"],
        )

    return run


def knn(
    corpus: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", metric: str = "cosine", skip_self: bool = True
) -> DataFrame:
    """The k nearest corpus rows of each query: (query_id, id, score, rank).

    Exact: each task keeps the best k of each query over its rows, and a window merges them, so the
    shuffle holds k rows for each task and query. Queries travel to the tasks, QUERY_ROWS at a time.
    """
    rows = queries.select(F.col(id_col).cast("long"), vector_col).limit(QUERY_ROWS + 1).collect()
    if len(rows) > QUERY_ROWS:
        parts = -(-queries.count() // QUERY_ROWS)
        split = [queries.where(F.pmod(F.xxhash64(id_col), F.lit(parts * 2)) == p) for p in range(parts * 2)]
        out = knn(corpus, split[0], k, id_col, vector_col, metric, skip_self)
        for part in split[1:]:
            out = out.unionByName(knn(corpus, part, k, id_col, vector_col, metric, skip_self))
        return out
    source = corpus.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"))
    schema = "query_id long, id long, score double"
    if not rows:
        return corpus.sparkSession.createDataFrame([], schema + ", rank int")
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    partial = source.mapInArrow(_search(ids, vectors, k, metric, skip_self), schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_or_empty(spark: SparkSession, table: str, queries: DataFrame, k: int, **options) -> DataFrame:
    """Neighbours from a table, or none if there is no such table."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], "query_id long, id long, score double, rank int")
    return knn(spark.table(table), queries, k, **options)


def build_index(df: DataFrame, id_col: str, vector_col: str, dim: int, name: str) -> bool:
    """Write vectors of the right length with their norms; True if an index of another length was replaced."""
    spark = df.sparkSession
    stale = spark.catalog.tableExists(name) and not spark.table(name).where(F.size("vector") != dim).isEmpty()
    vectors = df.where(F.size(vector_col) == dim).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    vectors.withColumn("norm", norm(F.col("vector"))).write.mode("overwrite").saveAsTable(name)
    return stale


def label_votes(neighbours: DataFrame, labels: DataFrame, id_col: str, label: str, group: str = "query_id", frequencies: DataFrame | None = None) -> DataFrame:
    """Weight of each label among each group's neighbours, counted as often as they occur.

    With ``frequencies`` (label, n) each vote weighs 1 / log1p(n), a label without one as if n were 1.
    """
    joined = neighbours.join(labels.select(F.col(id_col).alias("id"), label), "id")
    if frequencies is None:
        return joined.groupBy(group, label).agg(F.count("*").cast("double").alias("weight"))
    known = frequencies.select(F.col(label), F.col("n").alias("__n"))
    weighed = joined.join(broadcast_if_small(known), label, "left").withColumn("w", idf_weight(F.col("__n")))
    return weighed.groupBy(group, label).agg(F.sum("w").alias("weight"))


def annotate(votes: DataFrame, label: str, group: str = "query_id") -> DataFrame:
    """Winning label of each group, its share of the votes, and the top three as text."""
    whole = F.sum("weight").over(Window.partitionBy(group))
    order = Window.partitionBy(group).orderBy(F.desc("weight"), label)
    ranked = votes.withColumn("share", F.col("weight") / whole).withColumn("rank", F.row_number().over(order)).where("rank <= 3")
    text = F.concat(F.col(label).cast("string"), F.lit(" ("), F.round(F.col("share") * 100).cast("int").cast("string"), F.lit("%)"))
    parts = F.array_sort(F.collect_list(F.struct("rank", text.alias("t"))))
    best = [F.max_by(c, F.when(F.col("rank") == 1, 1)).alias(n) for c, n in ((label, "label"), ("share", "confidence"))]
    return ranked.groupBy(group).agg(*best, F.array_join(F.transform(parts, lambda p: p["t"]), "; ").alias("top3"))


def annotate_all(groups: DataFrame, votes: DataFrame, label: str, group: str = "query_id") -> DataFrame:
    """annotate() for all groups; those without votes are Unknown with confidence 0."""
    named = annotate(votes, label, group)
    joined = groups.select(group).distinct().join(named, group, "left")
    return joined.withColumns(
        {"label": F.coalesce(F.col("label").cast("string"), F.lit("Unknown")), "confidence": F.coalesce("confidence", F.lit(0.0))}
    )


def pairwise_cosine(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Cosine of each two of a few representatives (one row for each cluster): (a, b, cosine), a < b.

    More than REPRESENTATIVES are refused, as each is paired with each.
    """
    if vectors.limit(REPRESENTATIVES + 1).count() > REPRESENTATIVES:
        raise ValueError(f"more than {REPRESENTATIVES} vectors to pair")
    left, right = vectors.select(F.col(key).alias("a"), F.col(vector).alias("x")), vectors.select(F.col(key).alias("b"), F.col(vector).alias("y"))
    return left.join(F.broadcast(right), F.col("a") < F.col("b")).select("a", "b", cosine(F.col("x"), F.col("y")).alias("cosine"))


def similarity(a: Column, b: Column, metric: str = "cosine") -> Column:
    return cosine(a, b) if metric == "cosine" else dot(a, b)
