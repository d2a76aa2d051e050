"""Aggregates, windows, orderings, set operations and partitionings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.sources.trajectory import kept


def group_counts(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    """Rows of each combination of keys."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def filtered_counts(df: DataFrame, **predicates: Column) -> DataFrame:
    """Total and the count of each predicate, in one pass."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(p).alias(n) for n, p in predicates.items()])


def scaffold_summary(df: DataFrame, group: str, score: str, example: str, limit: int) -> DataFrame:
    """Largest groups: size, best score, smallest example."""
    stats = df.groupBy(group).agg(F.count("*").alias("n"), F.max(score).alias("best"), F.min(example).alias("example"))
    return stats.orderBy(F.desc("n"), F.desc("best"), group).limit(limit)


def column_stats(df: DataFrame, ids: Sequence[str], array_col: str) -> DataFrame:
    """Rows, distinct values of each id column, and least and greatest array size, in one row."""
    size = F.size(array_col)
    distinct = [F.countDistinct(c).alias(f"n_{c}") for c in ids]
    return df.agg(F.count("*").alias("n_rows"), *distinct, F.min(size).alias("min_size"), F.max(size).alias("max_size"))


def daily_trend(df: DataFrame, ts: str, key: str, value: str) -> DataFrame:
    """Distinct keys and sum of values by day."""
    day = F.date_trunc("day", ts).cast("date").alias("day")
    return df.groupBy(day).agg(F.countDistinct(key).alias("n_keys"), F.sum(value).alias("total"))


def five_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum of each group; quartiles are exact and interpolated."""
    marks = {"min": F.min(value), "q1": F.percentile(value, 0.25), "median": F.percentile(value, 0.5)}
    marks |= {"q3": F.percentile(value, 0.75), "max": F.max(value)}
    return df.groupBy(group).agg(*[v.alias(k) for k, v in marks.items()])


def above_percentile(df: DataFrame, value: str, share: float = 0.95) -> DataFrame:
    """The percentile and how many values are strictly above it."""
    mark = df.agg(F.percentile(value, share).alias("mark"))
    return df.join(F.broadcast(mark)).groupBy("mark").agg(F.count_if(F.col(value) > F.col("mark")).alias("n_above"))


def shares(df: DataFrame, group: str, label: str) -> DataFrame:
    """Count of each label in its group, and its share of the group in percent."""
    counts = df.groupBy(group, label).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("pct", F.col("n") * 100.0 / whole)


def top_summary(df: DataFrame, group: str, label: str, k: int = 3) -> DataFrame:
    """Text "label (37%); ..." of the k most frequent labels of each group, ties in label order."""
    order = Window.partitionBy(group).orderBy(F.desc("n"), label)
    ranked = shares(df, group, label).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    text = F.concat(F.col(label), F.lit(" ("), F.round("pct").cast("int").cast("string"), F.lit("%)"))
    listed = F.array_sort(F.collect_list(F.struct("rank", text.alias("text"))))
    return ranked.groupBy(group).agg(F.array_join(F.transform(listed, lambda x: x["text"]), "; ").alias("summary"))


def pivot_top_groups(df: DataFrame, group: str, column: str, values: Sequence[str], top: int = 15) -> DataFrame:
    """Counts of the largest groups by the given values of a column."""
    largest = df.groupBy(group).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), group).limit(top)
    kept = df.join(F.broadcast(largest.select(group)), group, "left_semi")
    return kept.groupBy(group).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])


def best_per_key(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The row with the greatest score of each key; ties go to the smallest ``tie``."""
    order = Window.partitionBy(key).orderBy(F.desc(score), tie)
    return df.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def first_per_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The first row of each key by an explicit order."""
    order = Window.partitionBy(key).orderBy(ordinal)
    return df.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def latest_per_key(df: DataFrame, key: str, ts: str, *ties: str) -> DataFrame:
    """The newest row of each key; ties go to the greatest of further columns."""
    order = Window.partitionBy(key).orderBy(F.desc(ts), *[F.desc(t) for t in ties])
    return df.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def top_n_per_group(df: DataFrame, group: str, score: str, tie: str, n: int) -> DataFrame:
    """The n greatest scores of each group, with their rank."""
    order = Window.partitionBy(group).orderBy(F.desc_nulls_last(score), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def class_shares(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Share of 0 and 1 of each 0/1 target, nulls left out."""
    return df.agg(
        *[F.avg(F.lit(1.0) - F.col(t)).alias(f"{t}_p0") for t in targets], *[F.avg(t).alias(f"{t}_p1") for t in targets]
    )


def early_late_mean(df: DataFrame, group: str, order: str, tie: str, value: str) -> DataFrame:
    """Mean of the first and the last half by order; the middle of an odd count is in neither, a single row in both."""
    window = Window.partitionBy(group)
    ranked = df.withColumn("k", F.row_number().over(window.orderBy(order, tie))).withColumn("n", F.count("*").over(window))
    half = F.floor(F.col("n") / 2)
    early = (F.col("k") <= half) | (F.col("n") == 1)
    late = (F.col("k") > F.col("n") - half) | (F.col("n") == 1)
    return ranked.groupBy(group).agg(
        F.avg(F.when(early, F.col(value))).alias("early"), F.avg(F.when(late, F.col(value))).alias("late")
    )


def vocabulary(df: DataFrame, token: str, min_freq: int = 1, max_size: int | None = None, specials: int = 2) -> DataFrame:
    """Tokens by falling frequency, then name, with an index after the special ones."""
    counts = df.groupBy(token).agg(F.count("*").alias("freq")).where(F.col("freq") >= min_freq)
    if max_size is not None:
        counts = counts.orderBy(F.desc("freq"), token).limit(max(0, max_size - specials))
    numbered = with_row_number(counts, F.desc("freq"), F.col(token), name="index")
    return numbered.withColumn("index", (F.col("index") + specials).cast("int"))


def label_proportions(df: DataFrame, label: str, excluded: Column | None = None, least_pct: float = 0.01) -> DataFrame:
    """Labels in percent of all, without excluded rows and shares of ``least_pct`` or less."""
    kept = df if excluded is None else df.where(~excluded)
    counts = kept.groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("whole"))
    pct = counts.join(F.broadcast(whole)).withColumn("pct", F.col("n") * 100.0 / F.col("whole"))
    return pct.where(F.col("pct") > least_pct).select(label, "n", "pct")


def group_mean_counts(df: DataFrame, group: str, targets: Sequence[str], limit: int = 10) -> DataFrame:
    """Mean and non-null count of each target, NaN taken as null, of the first groups by name."""
    clean = df.select(group, *[F.when(~F.isnan(t), F.col(t)).alias(t) for t in targets])
    stats = [f(t).alias(f"{n}_{t}") for t in targets for n, f in (("avg", F.avg), ("count", F.count))]
    return clean.groupBy(group).agg(*stats).orderBy(group).limit(limit)


def select_top_k(df: DataFrame, by: str | None, k: int = 5, ordinal: str = "ord", descending: bool = True) -> DataFrame:
    """The first k by a field, missing values as 0, ties in the given order; without a field, the first k."""
    if by is None:
        return df.orderBy(ordinal).limit(k)
    key = F.coalesce(F.col(by), F.lit(0))
    return df.orderBy(F.desc(key) if descending else F.asc(key), ordinal).limit(k)


def top_and_rest(df: DataFrame, key: str, score: str, k: int, rest: int = 25) -> tuple[DataFrame, DataFrame]:
    """The k best rows, and the best of those that are not among them."""
    top = df.orderBy(F.desc(score), key).limit(k)
    return top, df.join(F.broadcast(top.select(key)), key, "left_anti").orderBy(F.desc(score), key).limit(rest)


def feasible_or_all(df: DataFrame, feasible: Column, score: str, tie: str, n: int) -> DataFrame:
    """The n best feasible rows, or of all rows if none is feasible."""
    flagged = df.withColumn("__ok", F.coalesce(feasible, F.lit(False)))
    some = flagged.agg(F.max("__ok").alias("__any"))
    pool = flagged.join(F.broadcast(some)).where("__ok or not __any")
    return pool.orderBy(F.desc(score), tie).limit(n).drop("__ok", "__any")


def numeric_aware(column: str) -> list[Column]:
    """Sort keys that put whole numbers first, by value, then other names."""
    return [F.expr(f"try_cast(`{column}` as bigint)").asc_nulls_last(), F.col(column).asc()]


def rank_encoding(df: DataFrame, cell: str, gene: str, value: str, k: int) -> DataFrame:
    """The k highest genes of each cell with values evenly from 1 down to -1."""
    ranked = top_n_per_group(df, cell, value, gene, k)
    step = F.lit(0.0) if k == 1 else (F.col("rank") - 1) * 2.0 / (k - 1)
    return ranked.select(cell, gene, "rank", (F.lit(1.0) - step).alias("encoded"))


def argmax_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """Most frequent label of each key and its share; ties go to the smallest label."""
    order = Window.partitionBy(key).orderBy(F.desc("pct"), label)
    ranked = shares(df, key, label).withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return ranked.select(key, label, (F.col("pct") / 100).alias("confidence"))


def page_of(df: DataFrame, order: Sequence[Column | str], page: int, size: int = 20) -> DataFrame:
    """One page of rows, each with whether more pages follow."""
    rows = df.orderBy(*order).offset(page * size).limit(size + 1)
    numbered = rows.withColumn("__k", F.row_number().over(Window.orderBy(*order)))
    return numbered.withColumn("has_more", F.max("__k").over(Window.partitionBy()) > size).where(F.col("__k") <= size).drop("__k")


def range_partitions(df: DataFrame, key: str, rows: int | None = None, per_task: int = 50_000) -> DataFrame:
    """Range partitions of about ``per_task`` rows, eight at least."""
    n = df.count() if rows is None else rows
    return df.repartitionByRange(max(8, -(-n // per_task)), key)


def hash_shards(df: DataFrame, key: str, n: int) -> DataFrame:
    """A shard number for each row from its key."""
    return df.withColumn("shard", F.pmod(F.hash(key), F.lit(n)))


def _ranged(df: DataFrame, *order: str | Column) -> DataFrame:
    """Range partitions by the order, numbered and written once: planned twice, they would be cut at other places."""
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    return kept(df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))


def with_row_number(df: DataFrame, *order: str | Column, name: str = "row_no") -> DataFrame:
    """Row numbers from 0 in order: local ranks of range partitions, shifted by the counts before.

    No task sorts all rows; the counts are one row for each partition. The partitions are checkpointed.
    """
    ranged = _ranged(df, *order)
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    local = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    joined = ranged.withColumn("__k", local).join(F.broadcast(shifts), "__part")
    return joined.withColumn(name, (F.col("__k") + F.col("__shift")).cast("long")).drop("__part", "__k", "__shift")


def sums_before(df: DataFrame, key: str, *values: str) -> DataFrame:
    """Adds ``before_<value>``: the sum of each value over the rows of smaller key (keys are distinct).

    Like with_row_number(), by range partitions and the sums of those before.
    """
    ranged = _ranged(df, key)
    sizes = ranged.groupBy("__part").agg(*[F.sum(v).alias(f"__s_{v}") for v in values])
    parts = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", *[F.coalesce(F.sum(f"__s_{v}").over(parts), F.lit(0)).alias(f"__s_{v}") for v in values])
    own = Window.partitionBy("__part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = {f"before_{v}": F.coalesce(F.sum(v).over(own), F.lit(0)) for v in values}
    joined = ranged.withColumns(local).join(F.broadcast(shifts), "__part")
    return joined.withColumns({f"before_{v}": F.col(f"before_{v}") + F.col(f"__s_{v}") for v in values}).drop("__part", *[f"__s_{v}" for v in values])
