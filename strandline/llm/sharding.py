"""Sharding indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.lineage import cut

#: Groups, or partial partitions, that one task combines.
BLOCK_GROUPS = 4096
BLOCK_PARTS = 512
#: Rows of a shard that are numbered in one task, about.
NUMBERED = 4096


def differencing(parts: list[list[tuple[int, object]]], ways: int) -> list[tuple[int, object]]:
    """Combine partial partitions into one of ``ways`` sums.

    Each part is a list of up to ``ways`` (sum, content) slots. The two parts with the largest
    spread of sums are combined, the largest sums of one with the smallest of the other, until
    one is left. Content of combined slots is a pair; see leaves(). Returns its slots, largest sum
    first.
    """
    heap = []
    for order, part in enumerate(parts):
        slots = sorted(part, key=lambda s: -s[0]) + [(0, None)] * (ways - len(part))
        heap.append((slots[-1][0] - slots[0][0], order, slots))
    heapq.heapify(heap)
    order = len(parts)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        slots = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a, reversed(b))]
        slots.sort(key=lambda s: -s[0])
        heapq.heappush(heap, (slots[-1][0] - slots[0][0], order, slots))
        order += 1
    return heap[0][2] if heap else [(0, None)] * ways


def leaves(content: object) -> list:
    """What was put into a slot."""
    out, stack = [], [content]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            stack.extend(x)
        elif x is not None:
            out.append(x)
    return out


def _place(ways: int):
    """For one block of (item, slot, weight) rows: the new slot of each row."""

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["item", "slot"], kind="stable").reset_index(drop=True)
        parts = [
            [(int(w), int(row)) for row, w in zip(own.index, own["weight"])] for _, own in frame.groupby("item", sort=True)
        ]
        placed = [0] * len(frame)
        for slot, (_, content) in enumerate(differencing(parts, ways)):
            for row in leaves(content):
                placed[row] = slot
        frame["placed"] = placed
        return frame[["block", "item", "slot", "weight", "placed"]]

    return place


def _level(items: DataFrame, ways: int) -> DataFrame:
    return cut(
        items.groupBy("block").applyInPandas(
            _place(ways), "block long, item string, slot int, weight long, placed int"
        )
    )


def balanced_shards(groups: DataFrame, ways: int) -> DataFrame:
    """Shard of each (item string, weight long) row so that the sums of weights are near equal.

    Blocks of items are partitioned by differencing in parallel; then blocks' partial partitions are
    combined by the same rule, level by level, until one is left. Returns (item, shard).
    """
    count = groups.count()
    blocks = max(1, math.ceil(count / BLOCK_GROUPS))
    items = groups.select(
        F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"), "item", F.lit(0).alias("slot"), "weight"
    )
    levels = [_level(items, ways)]
    while blocks > 1:
        parents = math.ceil(blocks / BLOCK_PARTS)
        sums = levels[-1].groupBy("block", "placed").agg(F.sum("weight").alias("weight"))
        items = sums.select(
            F.pmod("block", F.lit(parents)).alias("block"),
            F.lpad(F.col("block").cast("string"), 20, "0").alias("item"),
            F.col("placed").alias("slot"),
            "weight",
        )
        levels.append(_level(items, ways))
        blocks = parents
    final = levels.pop().select("item", "slot", F.col("placed").alias("shard"))
    while levels:
        below = levels.pop().select("item", "slot", F.lpad(F.col("block").cast("string"), 20, "0").alias("own"), "placed")
        above = final.select(F.col("item").alias("own"), F.col("slot").alias("placed"), "shard")
        final = below.join(above, ["own", "placed"]).select("item", "slot", "shard")
    return final.select("item", "shard")


def shard_documents(
    docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Put documents into shards of near-equal bytes; equal texts stay together.

    Returns the id, ``size`` (UTF-8 bytes of the text, none for null, plus 1), ``text_crc32``,
    ``law`` (always ``bytes``), ``shard``, ``slot`` (numbered from 0 within a shard, without gaps)
    and ``grown_shard`` (null: this law doesn't foresee growth). The groups are the distinct texts;
    null texts form one group with no checksum. A group heavier than a fair share makes its shard
    that heavy. Rows with a null or repeated id count as rows of their own; other columns are ignored;
    an empty table gives no rows.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat_ws("-", F.hex(F.xxhash64(text)), F.hex(F.crc32(text.cast("binary"))), F.octet_length(text)).alias("item"),
    )
    rows = cut(rows)
    groups = cut(rows.groupBy("item").agg(F.sum("size").alias("weight")))
    placed = cut(rows.join(balanced_shards(groups, n_shards), "item"))
    bins = max(1, math.ceil(placed.count() / n_shards / NUMBERED))
    placed = placed.withColumn("bin", F.pmod(F.xxhash64("doc_id", "item"), F.lit(bins)))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "bin")
        .agg(F.count("*").alias("n"))
        .select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "bin").orderBy("doc_id", "item")
    numbered = placed.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["shard", "bin"])
    return numbered.select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.col("rank")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
