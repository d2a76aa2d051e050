"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.components import link_buckets, numbered
from strandline.llm.lineage import cut, map_arrow
from strandline.llm.words import mix

#: Vectors of a component that one task holds at a time.
BLOCK = 1024
#: Chance that a pair at the threshold shares no bucket, and pairs and tables drawn to estimate it.
MISS = 1e-5
PAIRS, TABLES = 2000, 8
#: Vectors without relation that a vector meets in its buckets, on average, at most.
STRANGERS = 1.0
MOST_HASHES = 12
#: Cosines so near the threshold are worked out again, by exact sums.
CLOSE = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, h = x.shape[-1], 1
    x = x.copy()
    while h < n:
        pair = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x


def hash_keys(vectors: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """Buckets of each unit vector: ``tables`` x (1 + ``probes``) 64-bit keys.

    Each of the ``hashes`` values of a table is the vertex of the cross-polytope nearest to the
    vector after three rounds of random signs and a Hadamard transform. A probe replaces one value
    by the second nearest vertex, where it is nearest to the first.
    """
    n, dim = vectors.shape
    width = max(2, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    signs = np.random.default_rng([seed, dim]).choice([-1.0, 1.0], (tables, hashes, 3, width))
    rows = np.arange(n)
    out = np.zeros((n, tables, 1 + probes), np.uint64)
    for t in range(tables):
        first, second = np.zeros((hashes, n), np.uint64), np.zeros((hashes, n), np.uint64)
        loss = np.zeros((hashes, n))
        for k in range(hashes):
            y = padded
            for turn in range(3):
                y = hadamard(y * signs[t, k, turn])
            size = np.abs(y)
            two = np.argpartition(size, width - 2, axis=1)[:, -2:]
            swap = size[rows, two[:, 0]] > size[rows, two[:, 1]]
            best, next_ = np.where(swap, two[:, 0], two[:, 1]), np.where(swap, two[:, 1], two[:, 0])
            first[k] = (best * 2 + (y[rows, best] > 0)).astype(np.uint64)
            second[k] = (next_ * 2 + (y[rows, next_] > 0)).astype(np.uint64)
            loss[k] = size[rows, best] - size[rows, next_]
        order = np.argsort(loss, axis=0, kind="stable")
        for p in range(1 + probes):
            key = np.full(n, np.uint64(dim * 1000003 + t))
            for k in range(hashes):
                flipped = (order[p - 1] == k) if p else np.zeros(n, bool)
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.where(flipped, second[k], first[k]))
            out[:, t, p] = key
    return out.reshape(n, -1).view(np.int64)


@lru_cache(maxsize=64)
def tables_needed(dim: int, hashes: int, threshold: float, seed: int) -> int:
    """Tables with which a pair at the threshold is missed with probability MISS, by the collisions of random pairs."""
    rng = np.random.default_rng([seed, dim, hashes])
    x, z = rng.normal(size=(2, PAIRS, max(dim, 2)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (x * z).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * z
    own, other = (hash_keys(v, TABLES, hashes, hashes, seed + 1).reshape(PAIRS, TABLES, -1) for v in (x, y))
    share = (own[:, :, :, None] == other[:, :, None, :]).any(axis=(2, 3)).mean()
    return max(1, math.ceil(math.log(MISS) / math.log(max(1e-9, min(1 - share, 1 - 1e-9)))))


def bucket_plan(n: int, dim: int, threshold: float, seed: int) -> tuple[int, int]:
    """(tables, hashes) for ``n`` vectors: the fewest hashes with which unrelated vectors seldom meet.

    A table of k hashes has (2 * dimension)^k buckets, and a vector is in 1 + k of them. More vectors take more
    hashes, so that those met by chance stay STRANGERS for each vector at any size of the table.
    """
    width = max(2, 1 << (dim - 1).bit_length())
    for hashes in range(1, MOST_HASHES + 1):
        met = n * (1 + hashes) ** 2 / (2 * width) ** hashes
        if met <= STRANGERS and (tables := tables_needed(dim, hashes, threshold, seed)) * met <= STRANGERS:
            break
    return tables_needed(dim, hashes, threshold, seed), hashes


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Double precision vectors; None where nothing can be linked."""
    out = []
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = 0
    for valid, n in zip(column.is_valid().to_pylist(), column.value_lengths().to_pylist()):
        x = values[at : at + n] if valid else np.zeros(0)
        at += n if valid else 0
        out.append(x if len(x) and np.isfinite(x).all() and x.any() else None)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """The vector at unit length; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max()
    return x / math.sqrt(math.fsum((x * x).tolist()))


def _prepare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) -> id, key of equal vectors, and the vector at unit length."""
    for frame in frames:
        vectors = _vectors(frame.column(1))
        keys = [None if x is None else hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest() for x in vectors]
        data = [None if x is None else _unit(x).tobytes() for x in vectors]
        yield pa.RecordBatch.from_arrays(
            [frame.column(0), pa.array(keys, pa.binary()), pa.array(data, pa.binary())], names=["vec_id", "same", "data"]
        )


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y (unit vectors) have a cosine of the threshold or more.

    The one test of a link, wherever it is asked: sums whose order of addition could decide are
    worked out exactly, so that the answer does not depend on what else is in the arrays.
    """
    cosine = x @ y.T
    near = cosine >= threshold
    for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < CLOSE)):
        near[i, j] = math.fsum((x[i] * y[j]).tolist()) >= threshold
    return near


def _keys(tables: int, hashes: int, seed: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            data = [np.frombuffer(x.as_buffer()) for x in frame.column(1)]
            found: list = [None] * len(data)
            for dim in {len(x) for x in data}:
                own = [i for i, x in enumerate(data) if len(x) == dim]
                for i, row in zip(own, hash_keys(np.array([data[i] for i in own]), tables, hashes, hashes, seed)):
                    found[i] = row
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "keys"])

    return run


def _near(threshold: float):
    """Keep the pairs of vectors that are linked."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            left = [np.frombuffer(x.as_buffer()) for x in frame.column(2)]
            right = [np.frombuffer(x.as_buffer()) for x in frame.column(3)]
            near = [len(x) == len(y) and bool(linked(x[None], y[None], threshold)[0, 0]) for x, y in zip(left, right)]
            yield frame.select([0, 1]).filter(pa.array(near, pa.bool_()))

    return run


def _matrix(threshold: float):
    """Some vectors, to tell which of them are linked to another."""

    def prepare(data: list[bytes]):
        vectors = [np.frombuffer(x) for x in data]
        by_dim = {}
        for dim in {len(x) for x in vectors}:
            own = np.array([i for i, x in enumerate(vectors) if len(x) == dim])
            by_dim[dim] = own, np.array([vectors[i] for i in own])

        def near(one: bytes) -> np.ndarray:
            x, out = np.frombuffer(one), np.zeros(len(vectors), bool)
            if len(x) in by_dim:
                own, rows = by_dim[len(x)]
                out[own] = linked(x[None], rows, threshold)[0]
            return out

        return near

    return prepare


def _count(threshold: float):
    """Links within one pair of blocks of a component: (node, links to rows of the other block)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        low, high = frame["low"].iloc[0], frame["high"].iloc[0]
        for _, own in frame.groupby(frame["data"].map(len)):
            a, b = own[own["block"] == low], own[own["block"] == high]
            if not len(a) or not len(b):
                continue
            x, y = (np.array([np.frombuffer(d) for d in side["data"]]) for side in (a, b))
            near = linked(x, y, threshold)
            if low == high:
                np.fill_diagonal(near, True)
            out.append(pd.DataFrame({"node": a["node"].to_numpy(), "links": near @ b["copies"].to_numpy()}))
            if low != high:
                out.append(pd.DataFrame({"node": b["node"].to_numpy(), "links": near.T @ a["copies"].to_numpy()}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": []}).astype("int64")

    return run


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int | None = None,
    hashes: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """Link vectors whose cosine, in double precision, is at least ``threshold``.

    Returns one row for each input row: the id, ``n_links`` (other rows linked directly),
    ``component_id`` (the smallest id reachable over links, itself included) and ``kept`` (the id is
    the component_id). Candidates share a bucket of one of ``tables`` tables and are verified; tables and
    hashes follow from the number of distinct vectors (bucket_plan()), so that a pair at the threshold is missed
    with a probability of about MISS. Links are then counted over all pairs within each component, block
    by block, without making pair rows: the time, and the rows moved (one for each vector and block of its
    component), grow with the square of a component's size.

    Equal vectors are one node with copies. Vectors of different lengths are never linked; a vector
    that is null, empty, zero, or holds a null, NaN or infinite component has no link. Rows that repeat
    an id are rows of their own but share a component if their vectors are equal. A row with a null id
    is no one's link; its component_id is null and kept is true. Other columns are ignored; an empty
    table gives no rows.
    """
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = cut(map_arrow(source, _prepare, "vec_id long, same binary, data binary"))
    usable = rows.where("same is not null and vec_id is not null")
    groups = numbered(
        usable.groupBy("same").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.min("data").alias("data"))
    )
    data = groups.select("node", "data")
    if tables is None or hashes is None:
        size = data.agg(F.count("*"), F.max(F.octet_length("data"))).first()
        tables, hashes = bucket_plan(size[0], (size[1] or 8) // 8, threshold, seed)
    nodes = cut(map_arrow(data, _keys(tables, hashes, seed), "node long, keys array<long>"))

    def fetch(ids: DataFrame) -> DataFrame:
        return data.join(ids, "node", "left_semi")

    def alike(both: DataFrame) -> DataFrame:
        return map_arrow(both, _near(threshold), "a long, b long")

    labels = cut(link_buckets(nodes, fetch, alike, _matrix(threshold)))
    sizes = cut(labels.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    members = (
        groups.join(labels, "node")
        .join(sizes, "component")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("component", "low", "high", "block", "node", "copies", "data")
    )
    counted = (
        members.groupBy("component", "low", "high")
        .applyInPandas(_count(threshold), "node long, links long")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    placed = groups.select("same", "node", "id", "copies").join(labels, "node", "left")
    placed = cut(placed.withColumn("component", F.coalesce("component", "node")))
    roots = cut(placed.groupBy("component").agg(F.min("id").alias("component_id")))
    found = cut(
        placed.join(counted, "node", "left")
        .join(roots, "component")
        .select("same", (F.coalesce("links", "copies") - 1).alias("n_links"), "component_id")
    )
    linked = usable.select("vec_id", "same").join(found, "same").select("vec_id", "n_links", "component_id")
    alone = rows.where("same is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
        .withColumnRenamed("vec_id", id_col)
    )
