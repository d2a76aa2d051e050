"""Near-duplicate documents by one-permutation MinHash with optimal densification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.components import link_buckets, numbered
from strandline.llm.lineage import cut, map_arrow
from strandline.llm.words import batches_of, mix, shingles

#: Documents that take part in a comparison may be broadcast up to this many rows (two numbers and a key of 16 bytes each).
BROADCAST_IDS = 500_000


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` values for each non-empty sorted set of 64-bit hashes.

    Each hash falls into the bin of its top bits and a bin keeps its smallest hash. An empty bin
    takes the value of a random bin, chosen by hashes of (bin, attempt) alike for all sets, that is
    not empty.
    """
    shift = np.uint64(64 - bins.bit_length() + 1)
    edges = np.arange(bins, dtype=np.uint64) << shift
    out = np.zeros((len(sets), bins), np.uint64)
    full = np.zeros((len(sets), bins), bool)
    for i, s in enumerate(sets):
        at = np.searchsorted(s, edges)
        end = np.append(at[1:], len(s))
        full[i] = end > at
        out[i, full[i]] = s[at[full[i]]]
    filled, attempt = full.copy(), 0
    while not filled.all():
        attempt += 1
        donor = (mix(np.arange(bins, dtype=np.uint64) + np.uint64(attempt * bins)) % np.uint64(bins)).astype(np.int64)
        take = ~filled & full[:, donor]
        out[take] = out[:, donor][take]
        filled |= take
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit bucket for each band of ``rows`` neighbouring bins."""
    grouped = signature.reshape(len(signature), -1, rows)
    total = np.broadcast_to(np.arange(grouped.shape[1], dtype=np.uint64), grouped.shape[:2])
    for k in range(rows):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return total.view(np.int64)


def _key(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _sketch(words: int, bins: int, rows: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            ids, marks, texts = frame.column(0), frame.column(1), frame.column(2)
            for start, hashed in batches_of(texts):
                sets = [shingles(h, words) for h in hashed]
                some = [i for i, s in enumerate(sets) if len(s)]
                keys = [None] * len(sets)
                bands = [None] * len(sets)
                if some:
                    signature = signatures([sets[i] for i in some], bins)
                    for i, band in zip(some, band_keys(signature, rows)):
                        keys[i] = _key(sets[i].tobytes())
                        bands[i] = band
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, len(sets)),
                        marks.slice(start, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set_key", "keys"],
                )

    return run


def _sets(words: int):
    """(node, set_key, text) -> (node, data) where the text has the wanted set; a node at most once in a task."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for frame in frames:
            for start, hashed in batches_of(frame.column(2)):
                nodes, data = [], []
                for k, h in enumerate(hashed):
                    node = frame.column(0)[start + k].as_py()
                    own = shingles(h, words).tobytes()
                    if node not in seen and _key(own) == frame.column(1)[start + k].as_py():
                        seen.add(node)
                        nodes.append(node)
                        data.append(own)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(data, pa.binary())], names=["node", "data"])

    return run


def _alike(percent: int):
    """Keep the pairs of sets that are linked."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            linked = []
            for left, right in zip(frame.column(2), frame.column(3)):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                most = min(len(x), len(y))
                if most * 100 < percent * max(len(x), len(y)):
                    linked.append(False)
                    continue
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                linked.append(common * 100 >= percent * (len(x) + len(y) - common))
            yield frame.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return run


def _index(percent: int):
    """An inverted index of some sets that tells which of them are linked to another."""

    def prepare(sets: list[bytes]):
        items = [np.frombuffer(x, np.uint64) for x in sets]
        sizes = np.array([len(x) for x in items])
        flat = np.concatenate(items)
        order = np.argsort(flat, kind="stable")
        owners = np.repeat(np.arange(len(items)), sizes)[order]
        flat = flat[order]

        def linked(data: bytes) -> np.ndarray:
            own = np.frombuffer(data, np.uint64)
            low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
            n = high - low
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(low - ends + n, n)
            common = np.bincount(owners[at], minlength=len(items))
            return common * 100 >= percent * (sizes + len(own) - common)

        return linked

    return prepare


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 75,
    bins: int = 128,
    rows: int = 4,
) -> DataFrame:
    """Group documents whose word shingles have a Jaccard similarity of ``percent`` or more.

    Returns one row for each input row: the id, ``n_shingles``, ``component_id`` (the smallest id
    reachable over links, itself included) and ``kept`` (id equals component_id); then ``text_hash``
    (xxhash64 of the text) and ``stays``: true for the one (id, text hash) that stands for its group. Candidates
    share one of ``bins / rows`` bands; links are confirmed on full shingle sets, of one document for each
    distinct set. With 32 bands of 4, a pair at the threshold is missed with probability 5e-6.

    A null or empty text has no shingles, stands alone and stays. Rows that repeat an id with another text
    are documents of their own: each gets the component of its own text. Equal rows repeat their
    result. A row with a null id is in no group: its component_id is null, kept and stays are true. Other
    columns are ignored; an empty table gives no rows.
    """
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )
    fields = "doc_id long, text_hash long, n_shingles long, set_key binary, keys array<long>"
    sketches = cut(map_arrow(source, _sketch(words, bins, rows), fields))
    usable = sketches.where("set_key is not null and doc_id is not null")
    same = usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_hash", "keys")).alias("g"))
    groups = numbered(same.select("set_key", F.col("g.doc_id").alias("id"), "g.text_hash", "g.keys"))

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = cut(groups.join(ids, "node", "left_semi").select("node", "id", "set_key"))
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
        found = source.join(wanted, source.doc_id == wanted.id).select("node", "set_key", "text")
        return map_arrow(found, _sets(words), "node long, data binary")

    def alike(both: DataFrame) -> DataFrame:
        return map_arrow(both, _alike(percent), "a long, b long")

    labels = link_buckets(groups.select("node", "keys"), sets_of, alike, _index(percent))
    placed = groups.select("set_key", "node", "id", "text_hash").join(labels, "node", "left")
    placed = cut(placed.withColumn("component", F.coalesce("component", "node")))
    heads = placed.groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("head"))
    placed = cut(
        placed.join(heads, "component").select(
            "set_key", F.col("head.id").alias("component_id"), F.col("head.text_hash").alias("head_hash")
        )
    )
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("head_hash"))
    columns = ["doc_id", "n_shingles", "component_id", "text_hash"]
    named = usable.select("doc_id", "n_shingles", "set_key", "text_hash").join(placed, "set_key").select(*columns, stays.alias("stays"))
    alone = sketches.where("set_key is null or doc_id is null").withColumn("component_id", F.col("doc_id"))
    found = named.unionByName(alone.select(*columns, F.lit(True).alias("stays")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return found.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", kept, "text_hash", "stays")
