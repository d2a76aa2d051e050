"""Rewards, constraints and stop rules of iterative candidate search."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.relational import best_per_key, feasible_or_all, top_and_rest


@dataclass(frozen=True)
class Axis:
    """One score of a candidate: its column, its weight, and how to read it."""

    name: str
    weight: float = 1.0
    lower_is_better: bool = False
    pre_normalized: bool = False


def axis_score(axis: Axis, group: str) -> Column:
    """Score from 0 to 1 within a batch; missing values count as the worst, a constant axis as 0."""
    own = Window.partitionBy(group)
    value = F.when(~F.isnan(F.col(axis.name).cast("double")), F.col(axis.name).cast("double"))
    if axis.pre_normalized:
        return F.coalesce(value, F.lit(0.0))
    low, high = F.min(value).over(own), F.max(value).over(own)
    filled = F.coalesce(value, high if axis.lower_is_better else low)
    share = (filled - low) / (high - low)
    return F.when(high > low, 1 - share if axis.lower_is_better else share).otherwise(0.0)


def with_reward(df: DataFrame, axes: Sequence[Axis], group: str = "iteration") -> DataFrame:
    """Weighted mean of the axes whose weight is not 0."""
    used = [a for a in axes if a.weight]
    total = sum(a.weight for a in used)
    if not used:
        return df.withColumn("reward", F.lit(0.0))
    scored = df.withColumns({f"__axis_{k}": axis_score(a, group) for k, a in enumerate(used)})
    reward = sum((F.col(f"__axis_{k}") * a.weight for k, a in enumerate(used)), F.lit(0.0)) / total
    return scored.withColumn("reward", reward).drop(*[f"__axis_{k}" for k in range(len(used))])


def feasible(qed: Column, tox: Column, qed_min: float, tox_max: float) -> Column:
    """Both limits met; unknown toxicity does not meet them."""
    return F.coalesce((qed >= qed_min) & (tox <= tox_max), F.lit(False))


def history_rules(history: DataFrame, iteration: str, best: str, good: str, window: int, threshold: float) -> DataFrame:
    """Running best, running count of good candidates, and whether the best grew less than ``threshold`` over ``window`` iterations."""
    order = Window.orderBy(iteration)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    running = history.select(iteration, F.max(best).over(upto).alias("best"), F.sum(good).over(upto).alias("n_good"))
    grown = F.col("best") - F.lag("best", window).over(order)
    return running.withColumn("converged", F.coalesce(grown < threshold, F.lit(False)))


def stop_reason(rules: DataFrame, iteration: str, target: float | None, enough: int | None, ceiling: int) -> DataFrame:
    """First rule that holds at each iteration: target reward, enough candidates, convergence, ceiling."""
    reason = F.lit(None).cast("string")
    rule = F.when(F.col("best") >= target, "target_reward") if target is not None else F.when(F.lit(False), "")
    if enough is not None:
        rule = rule.when(F.col("n_good") >= enough, "best_k")
    rule = rule.when(F.col("converged"), "converged").when(F.col(iteration) >= ceiling, "max_iterations")
    return rules.withColumn("stop_reason", F.coalesce(rule, reason))


def iteration_summary(scored: DataFrame, ok: Column, iteration: str = "iteration") -> DataFrame:
    return scored.groupBy(iteration).agg(
        F.max("reward").alias("max_reward"), F.avg("reward").alias("mean_reward"), F.count_if(ok).alias("survivors"), F.count("*").alias("n")
    )


def next_parents(scored: DataFrame, ok: Column, n: int, key: str, scaffold: str | None = None, violation: Column | None = None) -> DataFrame:
    """The n candidates to go on from; see optimise()."""
    if violation is not None and scored.where(F.coalesce(ok, F.lit(False))).isEmpty():
        least = scored.withColumn("__less", -violation)
        if scaffold is not None:
            least = best_per_key(least, scaffold, "__less", key)
        return least.orderBy(F.desc_nulls_last("__less"), F.desc("reward"), key).limit(n).drop("__less")
    if scaffold is not None:
        some = not scored.where(F.coalesce(ok, F.lit(False))).isEmpty()
        scored = best_per_key(scored.where(ok) if some else scored, scaffold, "reward", key)
    return feasible_or_all(scored, ok, "reward", key, n)


def optimise(
    seeds: DataFrame, propose: Callable[[DataFrame, int], DataFrame], axes: Sequence[Axis], ok: Column, iterations: int,
    select_top: int = 5, k: int = 5, target: float | None = None, key: str = "candidate", scaffold: str | None = None,
    violation: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Propose, score, filter and reseed; returns the best k, other explored candidates, and the trajectory.

    ``propose`` makes candidates (key, axis columns) from parents. Parents are the best feasible
    candidates; if none is feasible, those of the least ``violation``, or without one the best of all. With a
    ``scaffold`` column they are the best of as many scaffolds. Each iteration is checkpointed, so lineage stays short.
    """
    from strandline.sources.trajectory import kept

    parents, trajectory = seeds, None
    for i in range(iterations):
        batch = propose(parents, i).withColumn("iteration", F.lit(i))
        scored = kept(with_reward(batch, axes))
        trajectory = scored if trajectory is None else trajectory.unionByName(scored)
        parents = next_parents(scored, ok, select_top, key, scaffold, violation)
        if target is not None and scored.agg(F.max("reward")).first()[0] >= target:
            break
    best = trajectory.groupBy(key).agg(F.max_by(F.struct("iteration", "reward"), "reward").alias("b")).select(key, "b.*")
    top, rest = top_and_rest(best, key, "reward", k)
    return top, rest, trajectory
