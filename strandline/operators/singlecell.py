"""Cells by genes as long tables (cell_id, gene, value): quality, expression, clusters, trajectories."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import columns as C
from strandline.functions.stats import markers, z_scores
from strandline.operators.joins import broadcast_if_small
from strandline.operators.relational import top_n_per_group
from strandline.sources.trajectory import kept


def to_long(wide: DataFrame, cell: str, prefix: str = "expr_") -> DataFrame:
    """(cell, gene, value) from one column for each gene."""
    genes = [c for c in wide.columns if c.startswith(prefix)]
    long = wide.select(cell, *[F.col(g).cast("double").alias(g) for g in genes]).unpivot(cell, genes, "gene", "value")
    return long.withColumn("gene", F.substring("gene", len(prefix) + 1, 1000))


def quality(matrix: DataFrame) -> DataFrame:
    """Totals, genes seen and percent of mitochondrial, ribosomal and haemoglobin counts of each cell, with log1p forms."""
    flags = C.gene_flags(F.col("gene"))
    total = F.sum("value")
    parts = [F.sum(F.when(f, F.col("value")).otherwise(0.0)).alias(f"total_{n}") for n, f in flags.items()]
    stats = matrix.groupBy("cell_id").agg(total.alias("total_counts"), F.count_if(F.col("value") > 0).alias("n_genes_by_counts"), *parts)
    pct = {f"pct_counts_{n}": F.coalesce(F.col(f"total_{n}") / F.nullif("total_counts", F.lit(0.0)) * 100, F.lit(0.0)) for n in flags}
    logs = {f"log1p_{c}": F.log1p(F.col(c).cast("double")) for c in ("total_counts", "n_genes_by_counts")}
    return stats.withColumns(pct | logs)


def filtered(matrix: DataFrame, min_genes: int = 200, min_cells: int = 3, max_genes: int | None = None, max_pct_mt: float | None = None) -> DataFrame:
    """Cells with enough genes, then genes in enough cells, then limits on the quality columns of the full matrix."""
    before = quality(matrix).select("cell_id", F.col("n_genes_by_counts").alias("__g"), F.col("pct_counts_mt").alias("__mt"))
    cells = before.where(F.col("__g") >= min_genes)
    rows = matrix.join(cells, "cell_id")
    genes = rows.groupBy("gene").agg(F.count_if(F.col("value") > 0).alias("__n")).where(F.col("__n") >= min_cells)
    rows = rows.join(genes.select("gene"), "gene", "left_semi")
    if max_genes is not None:
        rows = rows.where(F.col("__g") < max_genes)
    if max_pct_mt is not None:
        rows = rows.where(F.col("__mt") < max_pct_mt)
    return rows.select(matrix.columns)


def log_normalised(matrix: DataFrame, target: float = 1e4) -> DataFrame:
    total = matrix.groupBy("cell_id").agg(F.sum("value").alias("__t"))
    return matrix.join(total, "cell_id").withColumn("value", C.normalised(F.col("value"), F.col("__t"), target)).drop("__t")


def aligned_to_genes(matrix: DataFrame, genes: DataFrame) -> DataFrame:
    """One row for each cell and wanted gene (a bounded list), absent values as 0."""
    wanted = broadcast_if_small(genes.select("gene"))
    cells = matrix.select("cell_id").distinct().join(wanted)
    return cells.join(matrix, ["cell_id", "gene"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def variable_genes(matrix: DataFrame, n_top: int, n_cells: int | None = None, bins: int = 20, flavour: str = "default") -> DataFrame:
    """Genes of the highest dispersion, normalised among genes of like mean; absent values are 0.

    The ``cell_ranger`` flavour takes variance over mean less its median in the bin, over the median distance from it;
    the default its logarithm less the mean, over the standard deviation.
    """
    n = n_cells if n_cells is not None else matrix.select("cell_id").distinct().count()
    sums = matrix.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    mean = F.col("s") / n
    moments = sums.select("gene", mean.alias("mean"), ((F.col("ss") - F.col("s") * mean) / max(1, n - 1)).alias("var")).where("mean > 0")
    ratio = F.col("var") / F.col("mean")
    spread = moments.withColumn("dispersion", ratio if flavour == "cell_ranger" else F.log(ratio + 1e-12))
    binned = spread.withColumn("bin", F.ntile(bins).over(Window.orderBy("mean", "gene")))
    own = Window.partitionBy("bin")
    if flavour == "cell_ranger":
        middle = binned.withColumn("centre", F.median("dispersion").over(own))
        away = middle.withColumn("away", F.median(F.abs(F.col("dispersion") - F.col("centre"))).over(own))
        ranked = away.withColumn("score", (F.col("dispersion") - F.col("centre")) / F.nullif("away", F.lit(0.0)))
        return ranked.drop("centre", "away").orderBy(F.desc_nulls_last("score"), "gene").limit(n_top)
    sd = F.coalesce(F.nullif(F.stddev_samp("dispersion").over(own), F.lit(0.0)), F.lit(1.0))
    scored = binned.withColumn("score", (F.col("dispersion") - F.avg("dispersion").over(own)) / sd)
    return scored.orderBy(F.desc("score"), "gene").limit(n_top)


def principal_components(matrix: DataFrame, genes: Sequence[str], k: int) -> DataFrame:
    """Coordinates of each cell on k components of the given genes, as an array."""
    place = F.create_map(*[F.lit(x) for i, g in enumerate(genes) for x in (g, i)])
    pairs = matrix.where(F.col("gene").isin(list(genes))).select("cell_id", place[F.col("gene")].alias("i"), "value")
    filled = pairs.groupBy("cell_id").agg(F.map_from_entries(F.collect_list(F.struct("i", "value"))).alias("m"))
    vector = F.transform(F.sequence(F.lit(0), F.lit(len(genes) - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    vectors = filled.select("cell_id", array_to_vector(vector).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(vectors)
    return model.transform(vectors).select("cell_id", vector_to_array("pc").alias("pc"))


def cluster_means(matrix: DataFrame, clusters: DataFrame) -> DataFrame:
    """Mean of each gene in each cluster, NaN left out."""
    joined = matrix.join(clusters.select("cell_id", "cluster"), "cell_id").where(~F.isnan("value"))
    return joined.groupBy("cluster", "gene").agg(F.avg("value").alias("mean"))


def cluster_markers(matrix: DataFrame, clusters: DataFrame, n: int | None = None) -> DataFrame:
    """Rank test of each cluster against the rest; the n best genes of each if asked."""
    tested = markers(matrix.join(clusters.select("cell_id", "cluster"), "cell_id"), "cluster", "gene", "value")
    scored = tested.withColumn("score", F.signum("log2fc") * C.capped_log10(F.col("p")))
    return scored if n is None else top_n_per_group(scored, "cluster", "score", "gene", n)


def enrichment_genes(markers_: DataFrame | None, means: DataFrame, cluster: str, top_n: int = 50) -> DataFrame:
    """Genes to test for a cluster: its top markers, or those of the highest mean if there are none."""
    if markers_ is not None:
        own = markers_.where(F.col("cluster") == cluster).orderBy(F.desc("score"), "gene").limit(top_n)
        if not own.isEmpty():
            return own.select("gene")
    return means.where(F.col("cluster") == cluster).orderBy(F.desc("mean"), "gene").limit(top_n).select("gene")


def dot_plot(means: DataFrame, genes: Sequence[str], scale: bool = True) -> DataFrame:
    """Value and dot size of each cluster and gene: z-scores over clusters, or means; no row for values that are not finite."""
    chosen = means.where(F.col("gene").isin(list(genes)))
    valued = z_scores(chosen, "gene", "mean").withColumnRenamed("z", "v") if scale else chosen.withColumn("v", F.col("mean"))
    size = F.abs("v") if scale else F.greatest("v", F.lit(0.0))
    return valued.where(C.is_finite(F.col("v"))).select("cluster", "gene", F.col("v").alias("value"), size.alias("size"))


def centroids(cells: DataFrame) -> DataFrame:
    """Mean position and pseudotime of each cluster's cells that have both coordinates."""
    placed = cells.where(C.is_finite(F.col("UMAP_0")) & C.is_finite(F.col("UMAP_1")))
    time = F.avg(F.when(C.is_finite(F.col("dpt_pseudotime")), F.col("dpt_pseudotime")))
    return placed.groupBy("cluster").agg(F.avg("UMAP_0").alias("x"), F.avg("UMAP_1").alias("y"), time.alias("pseudotime"), F.count("*").alias("n"))


def trajectory(centres: DataFrame) -> DataFrame:
    """Minimum spanning tree over cluster centroids, each edge from lower to higher pseudotime.

    There is one row for each cluster, so the tree is grown in one task, from the first cluster in
    name order; ties go to the lower index.
    """

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cluster").reset_index(drop=True)
        xy, time = frame[["x", "y"]].to_numpy(float), frame["pseudotime"].to_numpy(float)
        far = np.hypot(xy[:, None, 0] - xy[None, :, 0], xy[:, None, 1] - xy[None, :, 1])
        inside, rows = [0], []
        while len(inside) < len(frame):
            best = min(((far[i, j], i, j) for i in inside for j in range(len(frame)) if j not in inside), key=lambda e: e)
            _, i, j = best
            inside.append(j)
            a, b = (j, i) if time[j] < time[i] else (i, j)
            rows.append((frame["cluster"][a], frame["cluster"][b], float(best[0])))
        return pd.DataFrame(rows, columns=["source", "target", "distance"])

    kind = dict(centres.dtypes)["cluster"]
    return centres.groupBy().applyInPandas(grow, f"source {kind}, target {kind}, distance double")


def neighbour_graph(neighbours: DataFrame) -> DataFrame:
    """Undirected weighted edges (a, b, w) from (query_id, id) rows; edges found from both sides weigh 2."""
    pairs = neighbours.select(F.least("query_id", "id").alias("a"), F.greatest("query_id", "id").alias("b")).where("a != b")
    return pairs.groupBy("a", "b").agg(F.count("*").cast("double").alias("w"))


def communities(edges: DataFrame, resolution: float = 1.0, rounds: int = 10, seed: int = 0) -> DataFrame:
    """Louvain-style labels of a weighted graph: nodes move to the neighbouring label of the greatest gain.

    Each round moves the half of the nodes that a seeded hash picks, all at once, and is checkpointed.
    """
    both = kept(edges.select("a", "b", "w").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")))
    degree = kept(both.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k")))
    whole = degree.agg(F.sum("k")).first()[0] or 1.0
    labels = kept(degree.select("node", F.col("node").alias("label"), "k"))
    for turn in range(rounds):
        sizes = labels.groupBy("label").agg(F.sum("k").alias("total"))
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a", "label").agg(F.sum("w").alias("links"))
        own = labels.select(F.col("node").alias("a"), F.col("label").alias("mine"), "k")
        options = near.join(sizes, "label").join(own, "a")
        rest = F.col("total") - F.when(F.col("label") == F.col("mine"), F.col("k")).otherwise(0.0)
        gain = F.col("links") - F.lit(resolution / whole) * F.col("k") * rest
        best = options.groupBy("a").agg(F.max(F.struct(gain.alias("gain"), (-F.col("label")).alias("tie"), "label")).alias("best"))
        picked = F.pmod(F.xxhash64("node", F.lit(seed + turn)), F.lit(2)) == 0
        moved = labels.join(best.select(F.col("a").alias("node"), F.col("best.label").alias("to")), "node", "left")
        after = kept(moved.select("node", F.when(picked, F.coalesce("to", "label")).otherwise(F.col("label")).alias("label"), "k"))
        changed = after.join(labels.select("node", F.col("label").alias("old")), "node").where("label != old").limit(1).count()
        labels = after
        if not changed and turn:
            break
    return labels.select("node", "label")


def cell_totals(cells: DataFrame, obs_cols: Sequence[str] = ("cell_type", "disease", "tissue")) -> DataFrame:
    """Distinct values of several annotations in one pass."""
    return cells.agg(F.count("*").alias("n_cells"), *[F.countDistinct(c).alias(f"n_{c}") for c in obs_cols])
