"""Local alignment and the search funnel built on it."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.stats import superposed_rmsd
from strandline.operators import vectors

# The BLOSUM62 matrix, rows and columns in this order of residues.
RESIDUES = "ARNDCQEGHILKMFPSTWYV"
BLOSUM62 = """
4 -1 -2 -2 0 -1 -1 0 -2 -1 -1 -1 -1 -2 -1 1 0 -3 -2 0
-1 5 0 -2 -3 1 0 -2 0 -3 -2 2 -1 -3 -2 -1 -1 -3 -2 -3
-2 0 6 1 -3 0 0 0 1 -3 -3 0 -2 -3 -2 1 0 -4 -2 -3
-2 -2 1 6 -3 0 2 -1 -1 -3 -4 -1 -3 -3 -1 0 -1 -4 -3 -3
0 -3 -3 -3 9 -3 -4 -3 -3 -1 -1 -3 -1 -2 -3 -1 -1 -2 -2 -1
-1 1 0 0 -3 5 2 -2 0 -3 -2 1 0 -3 -1 0 -1 -2 -1 -2
-1 0 0 2 -4 2 5 -2 0 -3 -3 1 -2 -3 -1 0 -1 -3 -2 -2
0 -2 0 -1 -3 -2 -2 6 -2 -4 -4 -2 -3 -3 -2 0 -2 -2 -3 -3
-2 0 1 -1 -3 0 0 -2 8 -3 -3 -1 -2 -1 -2 -1 -2 -2 2 -3
-1 -3 -3 -3 -1 -3 -3 -4 -3 4 2 -3 1 0 -3 -2 -1 -3 -1 3
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4 -2 2 0 -3 -2 -1 -2 -1 1
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5 -1 -3 -1 0 -1 -3 -2 -2
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5 0 -2 -1 -1 -1 -1 1
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6 -4 -2 -2 1 3 -1
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7 -1 -1 -4 -3 -2
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4 1 -3 -2 -2
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5 -2 -2 0
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11 2 -3
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7 -1
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4
"""
_SCORES = np.full((128, 128), -4, np.int64)
_GRID = np.array(BLOSUM62.split(), np.int64).reshape(20, 20)
for _i, _a in enumerate(RESIDUES):
    for _j, _b in enumerate(RESIDUES):
        _SCORES[ord(_a), ord(_b)] = _GRID[_i, _j]


_SCORES[0, :] = _SCORES[:, 0] = -(10**6)  # what shorter sequences are filled up with

#: Cells of the matrices that are worked on at a time (three numbers of four bytes each).
CELLS = 1 << 22


def _letters(sequences: list[str]) -> np.ndarray:
    """One row of letters for each sequence, filled up with zeros."""
    rows = [np.frombuffer(x.upper().encode("ascii", "replace"), np.uint8) & 127 for x in sequences]
    out = np.zeros((len(rows), max(map(len, rows))), np.uint8)
    for row, letters in zip(out, rows):
        row[: len(letters)] = letters
    return out


def _align(queries: list[str], targets: list[str], gap_open: int, gap_extend: int) -> list[tuple[int, str, str]]:
    """Local alignments of several pairs at once: all matrices grow row by row, and all paths go back step by step."""
    a, b = _letters(queries), _letters(targets)
    count, n, m = len(a), a.shape[1], b.shape[1]
    none = np.int32(-(10**8))
    best = np.zeros((count, n + 1, m + 1), np.int32)
    down, across = np.full_like(best, none), np.full_like(best, none)
    ramp = np.arange(m + 1, dtype=np.int32) * np.int32(gap_extend)
    for i in range(1, n + 1):
        down[:, i] = np.maximum(best[:, i - 1] - gap_open, down[:, i - 1] - gap_extend)
        straight = np.maximum(0, best[:, i - 1, :-1] + _SCORES[a[:, i - 1, None], b])
        row = np.zeros((count, m + 1), np.int32)
        row[:, 1:] = np.maximum(straight, down[:, i, 1:])
        across[:, i, 1:] = np.maximum.accumulate(row + ramp, axis=1)[:, :-1] - gap_open - ramp[:-1]
        best[:, i] = np.maximum(row, across[:, i])
    every = np.arange(count)
    ends = best.reshape(count, -1).argmax(axis=1)
    i, j = ends // (m + 1), ends % (m + 1)
    scores = best[every, i, j]
    state, steps = np.zeros(count, np.int8), []  # 0: ends in a pair, 1: in a gap of the target, 2: of the query
    going = (best[every, i, j] > 0) & (i > 0) & (j > 0)
    while going.any():
        up, left = np.maximum(i - 1, 0), np.maximum(j - 1, 0)
        here = best[every, i, j]
        pair = here == best[every, up, left] + _SCORES[a[every, up], b[every, left]]
        gap = np.where(here == down[every, i, j], 1, 2)
        kind = np.where(state > 0, state, np.where(pair, 0, gap))
        over = np.where(kind == 1, down[every, i, j] == best[every, up, j] - gap_open, across[every, i, j] == best[every, i, left] - gap_open)
        steps.append((np.where(going & (kind != 2), up, -1), np.where(going & (kind != 1), left, -1)))
        state = np.where((kind > 0) & ~over, kind, 0).astype(np.int8)
        i, j = np.where(going & (kind != 2), up, i), np.where(going & (kind != 1), left, j)
        going &= (i > 0) & (j > 0) & ((state > 0) | (best[every, i, j] > 0))
    out = []
    for k, (query, target) in enumerate(zip(queries, targets)):
        path = [(q[k], t[k]) for q, t in reversed(steps) if q[k] >= 0 or t[k] >= 0]
        texts = ("".join(x[p[side]] if p[side] >= 0 else "-" for p in path) for side, x in enumerate((query, target)))
        out.append((int(scores[k]), *texts))
    return out


def local_alignments(queries: list[str], targets: list[str], gap_open: int = 11, gap_extend: int = 1) -> list[tuple[int, str, str]]:
    """Of each pair the best score with affine gaps, and the two aligned strings with '-' for gaps.

    Pairs of like size are aligned together, CELLS at a time; a pair's own matrices are held whole.
    """
    sizes = [(len(q) + 1) * (len(t) + 1) if q and t else 0 for q, t in zip(queries, targets)]
    out: list[tuple[int, str, str]] = [(0, "", "")] * len(sizes)
    batch: list[int] = []
    widest = [0, 0]

    def work() -> None:
        if batch:
            for k, found in zip(batch, _align([queries[k] for k in batch], [targets[k] for k in batch], gap_open, gap_extend)):
                out[k] = found
        batch.clear()

    for k in sorted((k for k, size in enumerate(sizes) if size), key=lambda k: (len(queries[k]), len(targets[k]))):
        wide = max(widest[0], len(queries[k]) + 1), max(widest[1], len(targets[k]) + 1)
        if batch and (len(batch) + 1) * wide[0] * wide[1] > CELLS:
            work()
            wide = len(queries[k]) + 1, len(targets[k]) + 1
        widest[:] = wide
        batch.append(k)
    work()
    return out


def local_alignment(query: str, target: str, gap_open: int = 11, gap_extend: int = 1) -> tuple[int, str, str]:
    """local_alignments() of one pair."""
    return local_alignments([query], [target], gap_open, gap_extend)[0]


def aligned(pairs: DataFrame, query: str, target: str, gap_open: int = 11, gap_extend: int = 1) -> DataFrame:
    """Adds score, both aligned strings, identity, coverage and similarity (percent) to pairs of sequences."""

    @F.pandas_udf("score int, aligned_query string, aligned_target string")
    def align(q: pd.Series, t: pd.Series) -> pd.DataFrame:
        found = local_alignments(q.fillna("").tolist(), t.fillna("").tolist(), gap_open, gap_extend)
        return pd.DataFrame(found, columns=["score", "aligned_query", "aligned_target"])

    found = pairs.withColumn("__al", align(query, target)).select(*pairs.columns, "__al.*")
    letters = F.arrays_zip(F.split("aligned_query", "").alias("q"), F.split("aligned_target", "").alias("t"))
    matches = F.size(F.filter(letters, lambda x: (x["q"] == x["t"]) & (x["q"] != "")))
    length = F.length("aligned_query")
    covered = F.length(F.regexp_replace("aligned_query", "-", ""))
    identity = F.when(length > 0, matches * 100.0 / length).otherwise(0.0)
    coverage = F.when(F.length(query) > 0, F.least(covered * 1.0 / F.length(query), F.lit(1.0)) * 100).otherwise(0.0)
    return found.withColumn("identity", identity).withColumn("coverage", coverage).withColumn(
        "similarity", F.round(F.col("identity") * F.col("coverage") / 100, 2)
    )


def search(query: DataFrame, corpus_vectors: DataFrame, records: DataFrame, top_k: int = 50, min_coverage: float = 0.0, id_col: str = "vec_id") -> DataFrame:
    """Vector neighbours of each query, at most ten times as many as wanted, aligned; the top_k of each query.

    Hits without a record are dropped; order within a query is by similarity to two decimals, then by score.
    """
    near = vectors.knn(corpus_vectors, query, min(10 * top_k, 1000), id_col=id_col).select("query_id", "id")
    hits = near.join(records, near.id == records.seq_id).withColumnRenamed("sequence", "__target")
    asked = query.select(F.col(id_col).alias("query_id"), F.col("sequence").alias("__query"))
    pairs = hits.join(asked, "query_id")
    scored = aligned(pairs, "__query", "__target").where(F.col("coverage") >= min_coverage)
    order = [F.desc("similarity"), F.desc("score"), F.asc("seq_id")]
    placed = scored.withColumn("__place", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    best = placed.where(F.col("__place") <= top_k).orderBy("query_id", "__place")
    return best.select("query_id", "seq_id", "score", "identity", "coverage", "similarity")


def common_places(a: str, b: str) -> list[tuple[int, int]]:
    """Places of a longest common subsequence: each match counts 1, mismatches and gaps nothing."""
    x, y = np.frombuffer(a.encode("utf-32-le"), np.uint32), np.frombuffer(b.encode("utf-32-le"), np.uint32)
    best = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for i in range(len(x)):
        best[i + 1, 1:] = np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + (y == x[i])))
    i, j, found = len(x), len(y), []
    while i and j:
        if best[i, j] == best[i - 1, j]:
            i -= 1
        elif best[i, j] == best[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((i, j))
    return found[::-1]


def best_chain(wanted: str, chains: dict[str, str]) -> tuple[str | None, list[tuple[int, int]]]:
    """The chain with the longest common subsequence, and its matching places; ties go to the first name."""
    places = {name: common_places(wanted, chains[name]) for name in sorted(chains)}
    best = max(places, key=lambda n: len(places[n]), default=None)
    return best, places.get(best, [])


def overlapping_rmsd(wanted: str, atoms: np.ndarray, chains: dict[str, tuple[str, np.ndarray]]) -> float:
    """RMSD of the backbone atoms at the matching places of the best chain; NaN without a match."""
    name, places = best_chain(wanted, {k: v[0] for k, v in chains.items()})
    if not places:
        return math.nan
    own, other = (list(side) for side in zip(*places))
    return superposed_rmsd(atoms[own], chains[name][1][other])
