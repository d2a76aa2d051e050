"""Samples and splits that do not depend on partitioning: rows are drawn by a hash of their id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.joins import broadcast_if_small
from strandline.operators.relational import with_row_number


def draw_key(id_col: str, seed: int) -> Column:
    """A reproducible random order."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def uniform(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly n rows, or all."""
    return df.orderBy(draw_key(id_col, seed), id_col).limit(n)


def stratified_cap(df: DataFrame, strata: Sequence[str], cap: int, target: int, id_col: str, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows of each stratum (null counts as "unknown"), then at most ``target`` of all."""
    named = df.select("*", *[F.coalesce(F.col(s).cast("string"), F.lit("unknown")).alias(f"__{i}") for i, s in enumerate(strata)])
    own = Window.partitionBy(*[f"__{i}" for i in range(len(strata))]).orderBy(draw_key(id_col, seed), id_col)
    capped = named.withColumn("__rank", F.row_number().over(own)).where(F.col("__rank") <= cap)
    return capped.orderBy(draw_key(id_col, seed), id_col).limit(target).select(df.columns)


def proportional(df: DataFrame, stratum: str, total: int, id_col: str, seed: int = 42) -> DataFrame:
    """``total`` rows shared by the strata's sizes, rounded half to even; the remainder goes to the largest."""
    sizes = df.groupBy(stratum).agg(F.count("*").alias("__n"))
    whole = Window.partitionBy()
    share = F.bround(F.col("__n") * float(total) / F.sum("__n").over(whole)).cast("long")
    quotas = sizes.withColumn("__quota", share)
    largest = F.row_number().over(Window.orderBy(F.desc("__n"), stratum)) == 1
    rest = F.lit(total) - F.sum("__quota").over(whole)
    quotas = quotas.withColumn("__quota", F.col("__quota") + F.when(largest, rest).otherwise(0))
    own = Window.partitionBy(stratum).orderBy(draw_key(id_col, seed), id_col)
    ranked = df.withColumn("__rank", F.row_number().over(own)).join(broadcast_if_small(quotas.select(stratum, "__quota")), stratum)
    return ranked.where(F.col("__rank") <= F.col("__quota")).select(df.columns)


def with_floor(df: DataFrame, stratum: str, kept: Sequence[str], target: int, floor: int, id_col: str, seed: int = 42) -> DataFrame:
    """All rows of the kept strata; of the others a proportional share, but ``floor`` rows where there are so many."""
    sizes = df.groupBy(stratum).agg(F.count("*").alias("__n"))
    whole = sizes.agg(F.sum("__n").alias("__all"))
    share = F.floor(F.col("__n") * float(target) / F.col("__all"))
    quota = F.greatest(F.least("__n", share), F.least(F.col("__n"), F.lit(floor)))
    quotas = sizes.join(F.broadcast(whole)).withColumn("__quota", F.when(F.col(stratum).isin(list(kept)), F.col("__n")).otherwise(quota))
    own = Window.partitionBy(stratum).orderBy(draw_key(id_col, seed), id_col)
    ranked = df.withColumn("__rank", F.row_number().over(own)).join(broadcast_if_small(quotas.select(stratum, "__quota")), stratum)
    return ranked.where(F.col("__rank") <= F.col("__quota")).select(df.columns)


def hash_split(df: DataFrame, id_col: str, parts: Sequence[tuple[str, int]] = (("train", 80), ("val", 10), ("test", 10)), seed: int = 0) -> DataFrame:
    """A split name for each row from the first hex digits of its hash; row by row, no shuffle."""
    total = sum(n for _, n in parts)
    point = F.conv(F.substring(draw_key(id_col, seed), 1, 8), 16, 10).cast("long") % total
    column, upto = None, 0
    for name, n in parts:
        upto += n
        column = F.when(point < upto, name) if column is None else column.when(point < upto, name)
    return df.withColumn("split", column)


def scaffold_split(df: DataFrame, scaffold: str, sizes: tuple[float, float, float] = (0.8, 0.1, 0.1), balanced: bool = False) -> DataFrame:
    """Split names such that no scaffold is in two splits: largest scaffolds first, filled in turn.

    In the balanced variant, scaffolds larger than half the validation or test split come first.
    The running totals need one row for each scaffold in one task, not the data.
    """
    counts = df.groupBy(scaffold).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"))
    counts = counts.join(F.broadcast(total))
    big = F.col("__n") > F.least(F.lit(sizes[1]), F.lit(sizes[2])) * F.col("__all") / 2
    order = [F.desc(big), F.desc("__n"), F.asc(scaffold)] if balanced else [F.desc("__n"), F.asc(scaffold)]

    def fill(frame):
        train, val = sizes[0] * frame["__all"].iloc[0], sizes[1] * frame["__all"].iloc[0]
        used, names = {"train": 0, "val": 0}, []
        for n in frame["__n"]:
            name = "train" if used["train"] + n <= train else "val" if used["val"] + n <= val else "test"
            used[name] = used.get(name, 0) + n
            names.append(name)
        frame["split"] = names
        return frame[[scaffold, "split"]]

    kind = dict(df.dtypes)[scaffold]
    ranked = counts.withColumn("__k", F.row_number().over(Window.orderBy(*order)))
    filled = ranked.groupBy().applyInPandas(lambda p: fill(p.sort_values("__k")), f"`{scaffold}` {kind}, split string")
    return df.join(filled, scaffold)


def folds(df: DataFrame, order: str, per_file: int) -> DataFrame:
    """Number of the file of each row when files hold ``per_file`` rows in order.

    Ranks are local to range partitions and shifted by the counts before, so no task sorts all rows.
    """
    return with_row_number(df, order).withColumn("fold", F.floor(F.col("row_no") / per_file)).drop("row_no")
