import pytest
from conftest import rows

from locusframe.streaming import tasks


def test_ingest_counts_attempts_once(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [(1, 1, "g", "COMPLETED", "2024-01-01 00:05:00"), (1, 1, "g", "COMPLETED", "2024-01-01 00:06:00"), (1, 2, "g", "FAILED", "2024-01-01 00:07:00"), (2, 1, "h", "COMPLETED", "2024-01-01 01:05:00")]
    schema = "task_id long, attempt int, `group` string, status string, complete timestamp"
    spark.createDataFrame(data, "task_id long, attempt int, `group` string, status string, complete string").selectExpr(
        "task_id", "attempt", "`group`", "status", "cast(complete as timestamp) complete").coalesce(1).write.parquet(source)
    stream = tasks.ingest(spark.readStream.schema(schema).parquet(source))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("ingested").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("ingested"), "group", "status", "n") == [("g", "COMPLETED", 1), ("g", "FAILED", 1), ("h", "COMPLETED", 1)]


def test_replay_of_unordered_files_loses_no_row(spark, tmp_path):
    days = ["2024-03-01", "2024-01-01", "2024-02-01"]
    for i, day in enumerate(days):
        spark.createDataFrame([(i, f"{day} 00:00:00", 1, "VIEW")], "event_id long, ts string, user_id long, event_type string").selectExpr(
            "event_id", "cast(ts as timestamp_ntz) ts", "user_id", "event_type").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    got = tasks.replay_status_counts(spark, f"{tmp_path}/in/*", files_per_trigger=1)
    assert rows(got, "group", "status", "n") == [("VIEW", "COMPLETED", 1)] * 3


def test_supervisor_alerts_once_per_missed_deadline(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source = str(tmp_path / "in")
    batches = [
        [("a", "RESERVED", "2024-01-01 00:10:00", "2024-01-01 00:00:00"), ("b", "RESERVED", "2024-01-01 00:10:00", "2024-01-01 00:00:00")],
        [("b", "COMPLETED", None, "2024-01-01 00:05:00")],
        [("z", "COMPLETED", None, "2024-01-01 02:00:00")],
        [("y", "COMPLETED", None, "2024-01-01 02:01:00")],
    ]
    schema = "run_id string, status string, deadline timestamp, event_time timestamp"
    stream = tasks.supervise(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source + "/*"))
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, "run_id string, status string, deadline string, event_time string").selectExpr(
            "run_id", "status", "cast(deadline as timestamp) deadline", "cast(event_time as timestamp) event_time").coalesce(1).write.parquet(f"{source}/{i}")
    q = stream.writeStream.outputMode("append").format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("alerts"), "run_id", "kind") == [("a", "deadline_passed")]
