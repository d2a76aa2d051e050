"""Connected components and bucket linking, both by star-shaped edges."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.lineage import cut, map_arrow

#: Edges that are merged in one task at most.
SMALL = 500_000
#: Nodes of a bucket from which random members of its largest component are tried first.
LARGE = 16
#: Data of a bucket's nodes that one task compares at a time, about.
BLOCK_BYTES = 8 << 20


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free sums that change when the edge set does."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF)),
            F.bit_xor(F.xxhash64("v", "u")),
        ).first()
    )


def _merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of a bounded edge list: labels sink to the smallest, over edges and over labels."""
    edges = pd.concat(frames)
    nodes, ends = np.unique(edges[["u", "v"]].to_numpy(np.int64), return_inverse=True)
    u, v = ends.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        lower = label.copy()
        np.minimum.at(lower, label[u], label[v])
        np.minimum.at(lower, label[v], label[u])
        lower = lower[lower[lower]]
        if (lower == label).all():
            break
        label = lower
    yield pd.DataFrame({"node": nodes, "component": nodes[label]})


def connected_components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """Smallest reachable node for each node of an edge list.

    Takes two long columns, the ends of each edge, and returns (node, component) for the nodes
    that have an edge to another node. Up to ``small`` distinct edges (16 bytes each) are merged in
    one task. More are merged by large-star and small-star steps in turn, until the edges form stars
    around the smallest nodes. Edges with a null end are ignored; no edges, no rows. Only edge counts
    reach the driver.
    """
    a, b = edges.columns[:2]
    stars = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = _mark(stars)
    if 0 < before[0] <= small:
        return cut(stars.repartition(1).mapInPandas(_merged, "node long, component long"))
    while before[0]:
        lowest = cut(
            stars.select(F.col("u").alias("n"), F.col("v").alias("m"))
            .union(stars.select("v", "v"))
            .groupBy("n")
            .agg(F.min("m").alias("m"))
        )
        large = cut(stars.join(lowest, stars.v == lowest.n).select("u", F.col("m").alias("v")).distinct())
        lowest = cut(large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")))
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        stars = cut(
            large.join(lowest, large.u == lowest.n)
            .select(ends.alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        after = _mark(stars)
        if after == before:
            break
        before = after
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(stars.select("v", "v").distinct())


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets whose nodes lie in several components: bucket, node, part, largest, size."""
    placed = rows.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("part"))
    mixed = cut(
        placed.groupBy("bucket", "part")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.max(F.struct("n", "part")).alias("top"), F.count("*").alias("parts"), F.sum("n").alias("size"))
        .where("parts > 1")
        .select("bucket", F.col("top.part").alias("largest"), "size")
    )
    return cut(placed.join(mixed, "bucket").select("bucket", "node", "part", "largest", "size"))


def _ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _compare(prepare: Callable[[list[bytes]], Callable[[bytes], np.ndarray]]):
    """Rows (bucket, i, j, outside, node, part, data), sorted by group -> links (a, b) found in a group.

    Each node that is outside is compared with all others of its group; of those it is linked to, it
    gets one link for each other component.
    """

    def links(outside: list[tuple], inside: list[tuple]) -> list[tuple[int, int]]:
        if not outside or not inside:
            return []
        linked = prepare([x[2] for x in inside])
        nodes, parts = np.array([x[0] for x in inside]), np.array([x[1] for x in inside])
        out = []
        for node, part, data in outside:
            near = np.flatnonzero(linked(data) & (parts != part))
            for k in near[np.unique(parts[near], return_index=True)[1]]:
                out.append((min(node, int(nodes[k])), max(node, int(nodes[k]))))
        return out

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, outside, inside, found = None, [], [], []
        for frame in frames:
            for row in zip(*[frame.column(k).to_pylist() for k in range(7)]):
                if row[:3] != group:
                    found += links(outside, inside)
                    group, outside, inside = row[:3], [], []
                (outside if row[3] else inside).append(row[4:])
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
            found = []
        found = links(outside, inside)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def link_buckets(
    nodes: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    alike: Callable[[DataFrame], DataFrame],
    prepare: Callable[[list[bytes]], Callable[[bytes], np.ndarray]],
    tries: int = 2,
) -> DataFrame:
    """Components of the verified links between nodes that share a bucket.

    ``nodes`` has a long ``node`` of its own for each row and the array ``keys`` of its buckets
    (longs). ``fetch`` takes rows (node) and returns (node, data binary); it is called once, for the nodes that
    share a bucket. ``alike`` takes pairs (a, b, x, y) with the data of both and returns the (a, b) that are
    linked; ``prepare`` takes the data of some nodes and returns a function from data to whether it is
    linked to each of them.

    The pairs of a bucket are never made as rows. First each node is compared with the smallest node of
    its buckets. Then, ``tries`` times, in each bucket of LARGE nodes that is still mixed (its nodes lie in
    several components) two random nodes of the largest component are compared with the nodes outside it.
    Last, each node that is still outside is compared with all nodes of other components in its buckets,
    in blocks of at most about BLOCK_BYTES a side. So each pair of a bucket is compared, or its nodes
    are connected. Returns (node, component) for linked nodes.
    """
    buckets = nodes.select(F.explode(F.array_distinct("keys")).alias("bucket"), "node")
    shared = cut(
        buckets.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("node").alias("centre"))
        .where("n > 1")
        .select("bucket", "centre")
    )
    rows = cut(buckets.join(shared, "bucket").select("bucket", "node", "centre"))
    data = cut(fetch(rows.select("node").distinct()))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(data.toDF("b", "y"), "b").join(data.toDF("a", "x"), "a").select("a", "b", "x", "y")
        return cut(alike(both))

    first = rows.where("node != centre").groupBy(F.col("node").alias("b")).agg(F.min("centre").alias("a"))
    links = verify(first.select("a", "b"))
    labels = connected_components(links)

    for turn in range(tries):
        members = _mixed(rows, labels).where(F.col("size") >= LARGE)
        draw = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node")
        picks = cut(
            members.where("part = largest")
            .groupBy("bucket")
            .agg(F.min(draw).alias("low"), F.max(draw).alias("high"))
            .select("bucket", F.col("low.node").alias("low"), F.col("high.node").alias("high"))
        )
        outside = members.where("part != largest").select("bucket", "node").join(picks, "bucket")
        pairs = _ordered(outside.select("node", F.explode(F.array("low", "high")).alias("pick")), "node", "pick")
        found = verify(pairs)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        labels = connected_components(links)

    members = _mixed(rows, labels)
    if members.isEmpty():
        return labels
    weights = data.select("node", F.octet_length("data").alias("weight"))
    full = members.join(weights, "node").withColumn("outside", F.col("part") != F.col("largest"))
    heavy = F.ceil(F.sum("weight") / BLOCK_BYTES), F.ceil(F.sum(F.when(F.col("outside"), F.col("weight"))) / BLOCK_BYTES)
    blocks = cut(full.groupBy("bucket").agg(heavy[0].alias("inner"), heavy[1].alias("outer")))
    full = full.join(blocks, "bucket")
    numbers = {side: F.sequence(F.lit(1), F.col(side).cast("int")) for side in ("inner", "outer")}
    place = {side: (F.pmod(F.xxhash64("node"), F.col(side)) + 1).cast("int") for side in ("inner", "outer")}
    inside = full.withColumn("i", F.explode(numbers["outer"])).withColumn("j", place["inner"]).withColumn("asks", F.lit(False))
    asking = full.where("outside").withColumn("j", F.explode(numbers["inner"])).withColumn("i", place["outer"])
    asking = asking.withColumn("asks", F.lit(True))
    columns = ["bucket", "i", "j", "asks", "node", "part"]
    sides = inside.select(columns).unionByName(asking.select(columns)).join(data, "node")
    groups = sides.select(*columns, "data").repartition("bucket", "i", "j")
    ordered = groups.sortWithinPartitions("bucket", "i", "j")
    found = map_arrow(ordered, _compare(prepare), "a long, b long").distinct()
    return connected_components(links.unionByName(cut(found)))


def numbered(df: DataFrame, name: str = "node") -> DataFrame:
    """The rows with a number of their own each, fixed by writing them: unlike hashes, no two rows get one."""
    return cut(df.withColumn(name, F.monotonically_increasing_id()))
