"""The same window plans on a stream and on a table."""

from pyspark.sql import functions as F

from strandline.streaming import events as E


def test_stream_equals_table(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "in"))
    want = E.windowed_counts(source, "ts", "event_type", "value", "1 day")
    stream = E.windowed_counts(E.event_stream(spark, str(tmp_path / "in")), "ts", "event_type", "value", "1 day", late="400 days")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    pick = ["start", "event_type", "n"]
    assert sorted(map(tuple, spark.table("windows").select(pick).collect())) == sorted(map(tuple, want.select(pick).collect()))


def test_sessions(spark):
    rows = spark.sql("select 'u' k, timestamp(t) ts from values ('2024-01-01 00:00:00'), ('2024-01-01 00:05:00'), ('2024-01-01 02:00:00') as v(t)")
    assert sorted(r.n for r in E.sessions(rows, "ts", "k", "10 minutes").collect()) == [1, 2]


def test_upserts_go_on_where_they_ended(spark, tmp_path):
    for turn, value in enumerate((1, 2)):
        spark.range(3).select("id", F.lit(value).alias("v")).where(f"id >= {turn}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        apply = E.parquet_upsert(str(tmp_path / "out"), ["id"], "v")
        E.sync_upserts(E.event_stream(spark, str(tmp_path / "in")), apply, str(tmp_path / "cp")).awaitTermination()
    assert {r.id: r.v for r in spark.read.parquet(str(tmp_path / "out/v1")).collect()} == {0: 1, 1: 2, 2: 2}
