"""Registry tables without an ACID format: each mutation is a new frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], kept: Sequence[str] = (), when: Column | None = None) -> DataFrame:
    """MERGE: matched rows take the source's values but for ``kept`` columns; others are inserted.

    With ``when``, only target rows that meet it can match; the others pass through.
    """
    active = target if when is None else target.where(when)
    passed = None if when is None else target.where(~F.coalesce(when, F.lit(False)))
    t = active.select(F.lit(True).alias("__t"), *[F.col(c).alias(f"__t_{c}") for c in target.columns])
    s = source.select(F.lit(True).alias("__s"), *[F.col(c).alias(f"__s_{c}") for c in source.columns])
    on = None
    for k in key:
        same = F.col(f"__t_{k}") == F.col(f"__s_{k}")
        on = same if on is None else on & same
    joined = t.join(s, on, "full_outer")
    columns = []
    for c in target.columns:
        old, new = F.col(f"__t_{c}"), F.col(f"__s_{c}") if c in source.columns else F.lit(None)
        take_new = F.col("__s").isNotNull() & (F.col("__t").isNull() if c in kept or c not in source.columns else F.lit(True))
        columns.append(F.when(take_new, new).otherwise(old).alias(c))
    merged = joined.select(columns)
    return merged if passed is None else merged.unionByName(passed)


def soft_delete(target: DataFrame, where: Column, flag: str = "is_active", stamp: str | None = None, at: Column | None = None) -> DataFrame:
    """Clear a flag, given as a boolean or as text 'true' and 'false', where a condition holds."""
    off = F.lit(False) if dict(target.dtypes)[flag] == "boolean" else F.lit("false")
    hit = F.coalesce(where, F.lit(False))
    out = target.withColumn(flag, F.when(hit, off).otherwise(F.col(flag)))
    if stamp is not None:
        out = out.withColumn(stamp, F.when(hit, at if at is not None else F.current_timestamp()).otherwise(F.col(stamp)))
    return out


def replace_rows(target: DataFrame, where: Column, rows: DataFrame) -> DataFrame:
    """Delete what a condition matches, then insert rows."""
    return target.where(~F.coalesce(where, F.lit(False))).unionByName(rows, allowMissingColumns=True)


def publish(catalog: DataFrame, rows: DataFrame, source: str) -> DataFrame:
    """Replace the rows of one source."""
    return replace_rows(catalog, F.col("source") == source, rows.withColumn("source", F.lit(source)))


def latest_active(deployments: DataFrame, models: DataFrame, name: Column) -> DataFrame:
    """The newest active deployment whose model matches."""
    joined = deployments.where("is_active").join(models.where(name), "model_id")
    return joined.orderBy(F.desc("deployment_id")).limit(1)


def remove_from_list(csv: Column, item: Column | str) -> Column:
    """Comma list without an item."""
    wanted = F.lit(item).cast("string") if isinstance(item, str) else item
    return F.array_join(F.array_remove(F.split(csv, ","), wanted), ",")


def has_access(permissions: DataFrame, module: str, submodule: str | None, level: str, groups: Sequence[str]) -> DataFrame:
    """One row: whether an active permission of any group grants the level; full access grants view too."""
    levels = ["view", "full"] if level == "view" else ["full"]
    sub = F.col("submodule_name").eqNullSafe(F.lit(submodule)) | F.col("submodule_name").isNull()
    granted = (
        F.col("is_active")
        & (F.col("module_name") == module)
        & sub
        & F.col("access_level").isin(levels)
        & F.arrays_overlap("groups", F.array(*[F.lit(g) for g in groups]).cast("array<string>"))
    )
    return permissions.agg(F.coalesce(F.max(granted), F.lit(False)).alias("granted"))


def settings_map(settings: DataFrame, user: str) -> DataFrame:
    """A user's settings as one map."""
    mine = settings.where(F.col("user_email") == user)
    return mine.agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("settings"))


def lookup_value(settings: DataFrame, key: str) -> DataFrame:
    """Value of one key, or no row."""
    return settings.where(F.col("key") == key).select("value").limit(1)


def search_runs(runs: DataFrame, tags: dict[str, str], text: str | None = None, limit: int = 100) -> DataFrame:
    """Runs with all given tags and a name that holds a text, newest first."""
    found = runs
    for key, value in tags.items():
        found = found.where(F.try_element_at("tags", F.lit(key)) == value)
    if text:
        found = found.where(F.contains(F.lower("run_name"), F.lit(text.lower())))
    return found.orderBy(F.desc(F.coalesce("start_time", F.lit(0))), "run_id").limit(limit)


def metric_history(metrics: DataFrame, run_id: str, name: str) -> DataFrame:
    return metrics.where((F.col("run_id") == run_id) & (F.col("name") == name)).select("step", "value").orderBy("step")


def reconciled_status(lifecycle: Column, tag: Column) -> Column:
    """A failed or killed lifecycle overrides a status that is not final."""
    final = F.upper(tag).isin("COMPLETE", "COMPLETED", "FAILED", "SUCCESS")
    return F.when(F.upper(lifecycle).isin("FAILED", "KILLED") & ~F.coalesce(final, F.lit(False)), F.lit("failed")).otherwise(tag)


def catalog_nodes(catalog: DataFrame, legacy: DataFrame, schema: str) -> DataFrame:
    """Active nodes read from their JSON, bad rows skipped; the legacy table if there are none."""

    def read(df: DataFrame) -> DataFrame:
        parsed = df.where("is_active").select("type", F.from_json("node_json", schema, {"mode": "PERMISSIVE"}).alias("node"))
        return parsed.where("node.type is not null").select("node.*")

    nodes = read(catalog)
    return read(legacy) if nodes.isEmpty() else nodes


def available_models(models: DataFrame, category: str) -> DataFrame:
    """Active models of a category, newest first."""
    columns = ["model_id", "model_name", "model_display_name", "model_source_version", "model_uc_name", "model_uc_version"]
    return models.where(F.col("is_active") & (F.col("model_category") == category)).select(columns).orderBy(F.desc("model_id"))


def deployed_models(deployments: DataFrame, models: DataFrame, category: str) -> DataFrame:
    """Active deployments of the models of a category, active or not, newest first, with the model's full name."""
    chosen = models.where(F.col("model_category") == category).select(
        "model_id", "model_display_name", "model_source_version", F.concat_ws("/", "model_uc_name", "model_uc_version").alias("uc_name")
    )
    joined = deployments.where("is_active").join(chosen, "model_id")
    columns = ["model_id", "deployment_id", "deployment_name", "deployment_description", "model_display_name", "model_source_version"]
    return joined.select(*columns, "uc_name", "model_endpoint_name").orderBy(F.desc("deployment_id"))


def batch_models(models: DataFrame, category: str | None = None) -> DataFrame:
    """Active batch models by name; without a category, those of all by module and name."""
    active = models.where("is_active")
    if category is not None:
        active = active.where(F.col("model_category") == category)
        return active.select("model_display_name", "model_description", "job_name", "cluster_type").orderBy("model_display_name")
    columns = ["model_display_name", "model_category", "module", "cluster_type", "job_name", "job_id"]
    return active.select(columns).orderBy("module", "model_display_name")


def settings_list(settings: DataFrame) -> DataFrame:
    return settings.select("key", "value", "module").orderBy("module", "key")


def remove_group(permissions: DataFrame, module: str, submodule: str | None, group: str, by: str, at: Column | None = None) -> DataFrame:
    """Take a group out of the active permissions of a module and submodule (none: those for the whole module)."""
    here = F.col("is_active") & (F.col("module_name") == module) & F.col("submodule_name").eqNullSafe(F.lit(submodule))
    hit = F.coalesce(here, F.lit(False))
    new = {"groups": F.array_remove("groups", group), "updated_at": F.current_timestamp() if at is None else at, "updated_by": F.lit(by)}
    return permissions.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()})


def active_fine_tunes(weights: DataFrame) -> DataFrame:
    """Active fine-tuned weights, newest first, their ids as text."""
    shown = weights.where("is_active").orderBy(F.desc("created_datetime"), F.desc("ft_id"))
    return shown.select(F.col("ft_id").cast("string").alias("ft_id"), "ft_label", "dataset_type", "task_names", "run_id", "created_datetime")


def fine_tune(weights: DataFrame, ft_id: int | None = None) -> DataFrame:
    """Where the weights of an active fine-tune are; without an id, of the one of the greatest id."""
    active = weights.where("is_active")
    found = active.orderBy(F.desc("ft_id")).limit(1) if ft_id is None else active.where(F.col("ft_id") == ft_id)
    return found.select("ft_id", "ft_label", "dataset_type", "task_names", "weights_volume_location")
