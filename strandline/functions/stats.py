"""Statistics that Spark lacks, as windows and aggregates; numpy only inside grouped Arrow functions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.relational import sums_before, with_row_number


def p_adjusted(df: DataFrame, p: str, tie: str, group: str | None = None) -> DataFrame:
    """p * n / rank, at most 1, ranks by p within a group; there is no monotone step.

    Without a group all rows are ranked by range partitions, and their number is one broadcast row.
    """
    if group is None:
        ranked = with_row_number(df, p, tie, name="__rank").join(F.broadcast(df.agg(F.count("*").alias("__n"))))
        adjusted = F.least(F.lit(1.0), F.col(p) * F.col("__n") / (F.col("__rank") + 1))
        return ranked.withColumn("p_adj", adjusted).drop("__rank", "__n")
    own = Window.partitionBy(group)
    rank = F.row_number().over(own.orderBy(p, tie))
    return df.withColumn("p_adj", F.least(F.lit(1.0), F.col(p) * F.count("*").over(own) / rank))


def z_scores(df: DataFrame, group: str, value: str) -> DataFrame:
    """(x - mean) / standard deviation of a sample, within each group."""
    own = Window.partitionBy(group)
    return df.withColumn("z", (F.col(value) - F.avg(value).over(own)) / F.nullif(F.stddev_samp(value).over(own), F.lit(0.0)))


def average_rank(order: Column, *groups: str) -> Column:
    """Rank of a value among its group's, ties at their mean."""
    own = Window.partitionBy(*groups)
    tied = Window.partitionBy(*groups, order)
    return F.rank().over(own.orderBy(order)) + (F.count("*").over(tied) - 1) / 2


def normal_tail(z: Column) -> Column:
    """Two-sided tail of the standard normal, by a rational form of erfc (relative error below 1.2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    # Coefficients of the published Chebyshev fit.
    poly = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + c
    return F.least(F.lit(1.0), t * F.exp(-x * x + poly))


def _rank_sums(df: DataFrame, gene: str, value: str, group: Column) -> tuple[DataFrame, DataFrame]:
    """Rank sum, count and sum of each (gene, group), and count, ties and sum of each gene.

    Equal values are counted before they are ranked, so windows and joins see distinct values only.
    """
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counts = clean.groupBy(F.col(gene).alias("__gene"), F.col(value).alias("__value"), group.alias("__group")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("__gene", "__value").agg(F.sum("n").alias("t"))
    before = Window.partitionBy("__gene").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = totals.withColumn("rank", F.coalesce(F.sum("t").over(before), F.lit(0)) + (F.col("t") + 1) / 2)
    own = counts.join(ranked, ["__gene", "__value"]).groupBy("__gene", "__group").agg(
        F.sum(F.col("n") * F.col("rank")).alias("rank_sum_a"), F.sum("n").alias("n_a"), F.sum(F.col("n") * F.col("__value")).alias("sum_a")
    )
    t = F.col("t").cast("double")
    whole = totals.groupBy("__gene").agg(F.sum("t").alias("n"), F.sum(t * (t * t - 1)).alias("ties"), F.sum(F.col("t") * F.col("__value")).alias("total"))
    return own, whole


def _tested(joined: DataFrame) -> DataFrame:
    """Adds n_b, u, means, log2fc and p to rows of rank_sum_a, n_a, sum_a, n, ties and total."""
    filled = joined.withColumns({"n_a": F.coalesce("n_a", F.lit(0)), "sum_a": F.coalesce(F.col("sum_a").cast("double"), F.lit(0.0))})
    filled = filled.withColumn("n_b", F.col("n") - F.col("n_a"))
    na, nb, n = F.col("n_a").cast("double"), F.col("n_b").cast("double"), F.col("n").cast("double")
    u = F.col("rank_sum_a") - na * (na + 1) / 2
    spread = F.sqrt(na * nb / 12 * ((n + 1) - F.col("ties") / F.greatest(n * (n - 1), F.lit(1.0))))
    z = F.greatest(F.abs(u - na * nb / 2) - 0.5, F.lit(0.0)) / F.nullif(spread, F.lit(0.0))
    empty = (F.col("n_a") == 0) | (F.col("n_b") == 0)
    means = {"mean_a": F.col("sum_a") / F.nullif(na, F.lit(0.0)), "mean_b": (F.col("total") - F.col("sum_a")) / F.nullif(nb, F.lit(0.0))}
    fold = F.log2((F.coalesce(means["mean_a"], F.lit(0.0)) + 1e-9) / (F.coalesce(means["mean_b"], F.lit(0.0)) + 1e-9))
    p = F.when(empty, 1.0).otherwise(F.coalesce(normal_tail(z), F.lit(1.0)))
    return filled.withColumns(means | {"u": u, "log2fc": F.when(empty, 0.0).otherwise(fold), "p": p})


def mann_whitney(df: DataFrame, gene: str, value: str, in_a: Column) -> DataFrame:
    """Rank test of each gene between rows in and out of a group, NaN and null dropped.

    Returns means, log2 fold change (pseudo-count 1e-9), rank sum and U of the first side, and the
    two-sided p of the tie-corrected normal approximation with continuity; an empty side gives a
    fold change of 0 and p 1, and so does p if all values tie.
    """
    own, whole = _rank_sums(df, gene, value, F.coalesce(in_a, F.lit(False)))
    joined = _tested(whole.join(own.where("__group").drop("__group"), "__gene", "left"))
    columns = ["rank_sum_a", "n_a", "n_b", "u", "mean_a", "mean_b", "log2fc", "p"]
    return joined.select(F.col("__gene").alias(gene), *columns)


def differential_expression(df: DataFrame, gene: str, value: str, in_a: Column) -> DataFrame:
    """mann_whitney() with adjusted p and whether p_adj < 0.05 and |log2fc| > 1."""
    tested = p_adjusted(mann_whitney(df, gene, value, in_a), "p", gene)
    return tested.withColumn("significant", (F.col("p_adj") < 0.05) & (F.abs("log2fc") > 1))


def markers(df: DataFrame, cluster: str, gene: str, value: str) -> DataFrame:
    """Each cluster against the rest; ranks over all rows serve every cluster, so rows are not repeated."""
    own, whole = _rank_sums(df, gene, value, F.col(cluster))
    tested = _tested(own.join(whole, "__gene"))
    named = tested.select(F.col("__group").alias(cluster), F.col("__gene").alias(gene), "log2fc", "p", "u")
    return named.orderBy(cluster, "p", F.desc("log2fc"), gene)


def fisher_greater(df: DataFrame) -> DataFrame:
    """One-sided Fisher exact test of columns a, b, c, d as p."""

    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        out = []
        for x, y, z, w in zip(a, b, c, d):
            row, column, n = x + y, x + z, x + y + z + w
            lg = math.lgamma
            total = lg(n + 1) - lg(column + 1) - lg(n - column + 1)
            terms = [
                lg(row + 1) - lg(k + 1) - lg(row - k + 1) + lg(n - row + 1) - lg(column - k + 1) - lg(n - row - column + k + 1) - total
                for k in range(int(x), int(min(row, column)) + 1)
                if n - row - column + k >= 0
            ]
            out.append(min(1.0, math.fsum(math.exp(t) for t in terms)))
        return pd.Series(out)

    return df.withColumn("p", tail("a", "b", "c", "d"))


def enrichment(tables: DataFrame, group: str | None = None) -> DataFrame:
    """Fisher p of each term's 2x2 table, adjusted within each library, sorted by it."""
    return p_adjusted(fisher_greater(tables), "p", "term", group).orderBy("p_adj", "term")


def _hwe_exact(hom_ref: int, het: int, hom_alt: int) -> float:
    """Two-sided exact test: total chance of outcomes at most as likely as the one seen."""
    rare = 2 * min(hom_ref, hom_alt) + het
    n = hom_ref + het + hom_alt
    if n == 0 or rare == 0:
        return 1.0
    logs = {}
    for h in range(rare % 2, rare + 1, 2):
        r, c = (rare - h) // 2, n - h - (rare - h) // 2
        if c >= 0:
            logs[h] = h * math.log(2) - math.lgamma(h + 1) - math.lgamma(r + 1) - math.lgamma(c + 1)
    top = max(logs.values())
    weights = {h: math.exp(v - top) for h, v in logs.items()}
    return min(1.0, sum(w for w in weights.values() if w <= weights[het] * (1 + 1e-9)) / sum(weights.values()))


def hardy_weinberg(df: DataFrame, hom_ref: str, het: str, hom_alt: str) -> DataFrame:
    """Columns hetFreqHwe, pValueHwe (exact) and chi2Hwe from genotype counts."""

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([_hwe_exact(int(x), int(y), int(z)) for x, y, z in zip(a, b, c)])

    n = (F.col(hom_ref) + F.col(het) + F.col(hom_alt)).cast("double")
    p = (2 * F.col(hom_ref) + F.col(het)) / F.nullif(2 * n, F.lit(0.0))
    expected = [n * p * p, 2 * n * p * (1 - p), n * (1 - p) * (1 - p)]
    seen = [F.col(hom_ref), F.col(het), F.col(hom_alt)]
    chi = sum((F.when(e > 0, (s - e) * (s - e) / e).otherwise(0.0) for s, e in zip(seen, expected)), F.lit(0.0))
    return df.withColumns({"hetFreqHwe": 2 * p * (1 - p), "pValueHwe": exact(hom_ref, het, hom_alt), "chi2Hwe": chi})


def hwe_filter(df: DataFrame, cutoff: float = 0.01) -> DataFrame:
    """Keeps pValueHwe below the cutoff: variants that deviate from equilibrium."""
    return df.where(F.col("pValueHwe") < cutoff)


def logistic_test(x: np.ndarray, y: np.ndarray, covariates: np.ndarray | None = None, firth_below: float | None = 0.05) -> tuple[float, float]:
    """Effect and p of one variant: score test, and Firth's penalised fit where that p is below a bound."""
    base = np.ones((len(y), 1)) if covariates is None else np.column_stack([np.ones(len(y)), covariates])
    beta = _irls(base, y)
    mu = 1 / (1 + np.exp(-base @ beta))
    w = mu * (1 - mu)
    adjusted = x - base @ np.linalg.solve((base * w[:, None]).T @ base + 1e-12 * np.eye(base.shape[1]), (base * w[:, None]).T @ x)
    info = (adjusted * adjusted * w).sum()
    if info <= 1e-12:
        return float("nan"), float("nan")
    score = (adjusted * (y - mu)).sum()
    p = math.erfc(math.sqrt(score * score / info / 2))
    effect = score / info
    if firth_below is not None and p < firth_below:
        full = np.column_stack([base, x])
        try:
            b, likelihood = _firth(full, y)
            null = _firth(base, y, penalty=full)[1]
            effect, p = b[-1], math.erfc(math.sqrt(max(0.0, likelihood - null)))
        except np.linalg.LinAlgError:
            pass
    return float(effect), float(p)


def _irls(x: np.ndarray, y: np.ndarray, steps: int = 25) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        mu = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        move = np.linalg.solve((x * (mu * (1 - mu))[:, None]).T @ x + 1e-9 * np.eye(x.shape[1]), x.T @ (y - mu))
        beta = beta + move
        if np.abs(move).max() < 1e-8:
            break
    return beta


def _firth(x: np.ndarray, y: np.ndarray, penalty: np.ndarray | None = None, steps: int = 50) -> tuple[np.ndarray, float]:
    """Penalised fit and its log likelihood; under the null the penalty is that of the full model."""
    full = x if penalty is None else penalty
    beta, k = np.zeros(x.shape[1]), x.shape[1]
    for _ in range(steps):
        mu = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = mu * (1 - mu)
        root = full * np.sqrt(w)[:, None]
        hat = np.einsum("ij,ij->i", root @ np.linalg.inv(root.T @ root), root)
        info = (x * w[:, None]).T @ x
        move = np.linalg.solve(info, x.T @ (y - mu + hat * (0.5 - mu)))
        beta = beta + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-7:
            break
    mu = np.clip(1 / (1 + np.exp(-np.clip(x @ beta, -30, 30))), 1e-12, 1 - 1e-12)
    w = mu * (1 - mu)
    sign, logdet = np.linalg.slogdet((full * w[:, None]).T @ full)
    assert k
    return beta, float((y * np.log(mu) + (1 - y) * np.log(1 - mu)).sum() + 0.5 * logdet)


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """Root mean square error, mean absolute error and R2."""
    error = F.col(y) - F.col(p)
    sums = df.agg(F.sum(error * error).alias("sse"), F.avg(F.abs(error)).alias("mae"), F.count("*").alias("n"), F.var_pop(y).alias("v"))
    return sums.select(F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), "mae", (1 - F.col("sse") / (F.col("v") * F.col("n"))).alias("r2"))


def classification_metrics(df: DataFrame, y: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, recall, specificity, area under the ROC curve (by rank sums) and average precision.

    Scores are counted first, so ranks run over distinct scores, in range partitions.
    """
    positive = F.sum(F.when(F.col(y) == 1, 1).otherwise(0))
    counts = df.groupBy(F.col(score).alias("s")).agg(positive.alias("pos"), F.count("*").alias("n"))
    whole = F.broadcast(counts.agg(F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos")))
    ranked = sums_before(counts, "s", "n", "pos").join(whole)
    seen, hit = F.col("all_n") - F.col("before_n"), F.col("all_pos") - F.col("before_pos")
    table = ranked.select(
        "s", "pos", "n", (F.col("before_n") + (F.col("n") + 1) / 2).alias("rank"), (F.col("pos") * hit / seen).alias("part")
    )
    called = F.col("s") >= threshold
    neg = F.col("n") - F.col("pos")
    sums = table.agg(
        F.sum("pos").alias("p"), F.sum(neg).alias("q"), F.sum(F.when(called, F.col("pos"))).alias("tp"),
        F.sum(F.when(~called, neg)).alias("tn"), F.sum(F.col("pos") * F.col("rank")).alias("r"), F.sum("part").alias("ap"),
    )
    p, q, tp, tn = F.col("p"), F.col("q"), F.coalesce("tp", F.lit(0)), F.coalesce("tn", F.lit(0))
    return sums.select(
        ((tp + tn) / (p + q)).alias("accuracy"), (tp / F.nullif(p, F.lit(0))).alias("recall"), (tn / F.nullif(q, F.lit(0))).alias("specificity"),
        ((F.col("r") - p * (p + 1) / 2) / F.nullif(p * q, F.lit(0))).alias("auc"), (F.col("ap") / F.nullif(p, F.lit(0))).alias("average_precision"),
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of average ranks of the rows that have both values; ranks run over distinct values, in range partitions."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))
    for side in ("x", "y"):
        counts = sums_before(pairs.groupBy(side).agg(F.count("*").alias("n")), side, "n")
        pairs = pairs.join(counts.select(side, (F.col("before_n") + (F.col("n") + 1) / 2).alias(f"rank_{side}")), side)
    return pairs.agg(F.corr("rank_x", "rank_y").alias("spearman"))


def scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns less their mean over their population deviation; NaN is left out, no mean counts as 0, no or zero deviation as 1."""
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in columns}
    moments = df.agg(*[F.avg(v).alias(f"__m_{c}") for c, v in clean.items()], *[F.stddev_pop(v).alias(f"__s_{c}") for c, v in clean.items()])
    joined = df.join(F.broadcast(moments))
    out = {c: (F.col(c) - F.coalesce(f"__m_{c}", F.lit(0.0))) / F.coalesce(F.nullif(f"__s_{c}", F.lit(0.0)), F.lit(1.0)) for c in columns}
    return joined.withColumns(out).select(df.columns)


def lowess(df: DataFrame, group: str, x: str, y: str, span: float = 0.3) -> DataFrame:
    """Local linear fit of each group's points: k nearest in x, tricube weights."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(x)
        xs, ys = frame[x].to_numpy(float), frame[y].to_numpy(float)
        k = max(2, int(math.ceil(span * len(xs))))
        out = []
        for at in xs:
            near = np.argsort(np.abs(xs - at), kind="stable")[:k]
            reach = np.abs(xs[near] - at).max() or 1.0
            w = (1 - np.minimum(1, np.abs(xs[near] - at) / reach) ** 3) ** 3 + 1e-12
            mx, my = np.average(xs[near], weights=w), np.average(ys[near], weights=w)
            spread = (w * (xs[near] - mx) ** 2).sum()
            slope = (w * (xs[near] - mx) * (ys[near] - my)).sum() / spread if spread > 1e-12 else 0.0
            out.append(my + slope * (at - mx))
        return pd.DataFrame({group: frame[group].to_numpy(), x: xs, "fitted": out})

    kind = dict(df.dtypes)[group]
    return df.select(group, F.col(x).cast("double"), F.col(y).cast("double")).groupBy(group).applyInPandas(fit, f"`{group}` {kind}, `{x}` double, fitted double")


def superposed_rmsd(a: np.ndarray, b: np.ndarray) -> float:
    """RMSD of two equally long atom lists after the best rotation; NaN if the counts differ."""
    if a.shape != b.shape or not len(a):
        return float("nan")
    x, y = a - a.mean(axis=0), b - b.mean(axis=0)
    u, s, vt = np.linalg.svd(x.T @ y)
    s[-1] *= np.sign(np.linalg.det(u @ vt)) or 1.0
    return float(math.sqrt(max(0.0, ((x * x).sum() + (y * y).sum() - 2 * s.sum()) / len(x))))
