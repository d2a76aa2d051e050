"""Usage dashboards: the fact query and its widgets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.relational import daily_trend, five_numbers, group_counts, latest_per_key


def usage_fact(usage: DataFrame, timeline: DataFrame, application: str) -> DataFrame:
    """One row for each usage record of an application, with the newest run of its job and its seconds.

    Only the newest row of each (workspace, job, run) is joined, so a job of many rows does not multiply the records.
    """
    u = usage.where(F.try_element_at("custom_tags", F.lit("application")) == application)
    newest = F.max(F.struct("period_start_time", "termination_code")).alias("newest")
    t = timeline.groupBy("workspace_id", "job_id", "run_id").agg(newest).select("workspace_id", "job_id", "run_id", "newest.*")
    on = (
        (u.workspace_id == t.workspace_id)
        & (u["usage_metadata.job_id"] == t.job_id)
        & (u["usage_metadata.job_run_id"] == t.run_id)
    )
    tag = lambda k: F.try_element_at("custom_tags", F.lit(k)).alias(k)
    joined = u.join(t, on, "left").select(
        "record_id", u.workspace_id, "usage_date", "usage_quantity", "billing_origin_product", tag("module"), tag("user"),
        F.timestamp_diff("SECOND", "usage_start_time", "usage_end_time").alias("seconds"),
        "period_start_time", "termination_code",
    )
    return latest_per_key(joined, "record_id", "period_start_time", "termination_code")


def widgets(fact: DataFrame) -> dict[str, DataFrame]:
    """Counters, trend by day, product shares, module by user, and quantity by module."""
    return {
        "counters": fact.agg(F.countDistinct("user").alias("users"), F.countDistinct("module").alias("modules"), F.sum("usage_quantity").alias("quantity")),
        "trend": daily_trend(fact.withColumn("ts", F.col("usage_date").cast("timestamp")), "ts", "user", "usage_quantity"),
        "products": fact.groupBy("billing_origin_product").agg(F.sum("usage_quantity").alias("quantity")),
        "heatmap": group_counts(fact, "module", "user"),
        "boxes": five_numbers(fact, "module", "usage_quantity"),
    }
