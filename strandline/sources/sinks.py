"""Tables and files as targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import safe_name


def run_table(base: str, run_name: str, run_id: str) -> str:
    """A table of its own for each run, as INFO columns differ between runs."""
    return f"{base}__{safe_name(run_name)}_{run_id[:8]}"


def write_table(df: DataFrame, name: str) -> None:
    """Replace a table and its schema."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def insert(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append rows by column name."""
    rows.select(spark.table(name).columns).write.mode("append").insertInto(name)


def create_as(spark: SparkSession, name: str, query: str) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT for formats that cannot replace."""
    spark.sql(query).write.mode("overwrite").saveAsTable(name)


def parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files of a folder, by SQL."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def stage_shards(df: DataFrame, key: str, n: int, path: str) -> None:
    """Parquet folders by hash of the key, one file each."""
    sharded = df.withColumn("shard", F.pmod(F.hash(key), F.lit(n)))
    sharded.repartition(n, "shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def populated(spark: SparkSession, name: str, least: int = 100, array_col: str | None = None, dim: int | None = None) -> bool:
    """Whether a table exists with more than ``least`` rows, and arrays of the wanted length."""
    if not spark.catalog.tableExists(name):
        return False
    df = spark.table(name)
    if df.limit(least + 1).count() <= least:
        return False
    return array_col is None or df.where(F.size(array_col) != dim).isEmpty()


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a change feed would hold between two snapshots: rows with _change 'delete' or 'insert'."""
    gone, new = before.exceptAll(after), after.exceptAll(before)
    return gone.withColumn("_change", F.lit("delete")).unionByName(new.withColumn("_change", F.lit("insert")))


def save(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """A run's artifact."""
    writer = df.write.mode("overwrite")
    writer.csv(path, header=True) if kind == "csv" else writer.format(kind).save(path)
