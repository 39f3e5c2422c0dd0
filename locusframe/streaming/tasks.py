"""Append-only task-observation ingest and deadline supervision."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..session import shared_folder

TERMINAL = ("COMPLETED", "FAILED", "CANCELLED")
ALERT = "run_id string, kind string, at timestamp"


def ingest(observations: DataFrame, lateness: str | None = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Status counts per group and window over a stream of ``task_id, attempt, group, status, complete``.

    An attempt seen again within the lateness bound counts once; rows later than the bound are
    dropped by the watermark. State per window is one row per group and status. Without a bound
    (an archive read in any order) no row is late, and the state holds the identity of every attempt.
    """
    keys = ["task_id", "attempt"]
    if lateness is None:
        once = observations.dropDuplicates(keys)
    else:
        once = observations.withWatermark("complete", lateness).dropDuplicatesWithinWatermark(keys)
    return (
        once.groupBy(F.window("complete", window), "group", "status")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "group", "status", "n")
    )


def replay_status_counts(spark: SparkSession, path: str, window: str = "1 hour", files_per_trigger: int = 64) -> DataFrame:
    """Run the ingest once over files that hold ``events`` and return the final counts.

    The stream reads everything available, so many files a trigger, then stops; each trigger replaces
    the small count table in the shared folder. Files come in any order, so no row counts as late.
    """
    root = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).schema("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string").parquet(path)
    observed = raw.select(
        F.col("event_id").alias("task_id"), F.lit(1).alias("attempt"), F.col("event_type").alias("group"),
        F.when(F.col("user_id") % 5 == 0, "CACHED").otherwise("COMPLETED").alias("status"),
        F.col("ts").cast("timestamp").alias("complete"),
    )

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/counts")

    stream = (
        ingest(observed, lateness=None, window=window).writeStream.outputMode("complete").foreachBatch(replace)
        .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{root}/counts")


class Supervisor(StatefulProcessor):
    """One run's life: reserved, running, terminal; alerts when its deadline passes first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState(
            "run", StructType([StructField("status", StringType()), StructField("deadline", TimestampType())])
        )

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        status, deadline = self.run.get() if self.run.exists() else (None, None)
        out = []
        for batch in rows:
            for row in batch.sort_values("event_time").itertuples(index=False):
                if status in TERMINAL:
                    out.append((key[0], "after_terminal", row.event_time))
                    continue
                status = row.status
                if not pd.isna(row.deadline):
                    deadline = row.deadline
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if status not in TERMINAL and deadline is not None:
            self.handle.registerTimer(int(pd.Timestamp(deadline).timestamp() * 1000))
        self.run.update((status, deadline))
        yield pd.DataFrame(out, columns=["run_id", "kind", "at"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        status, deadline = self.run.get()
        late = [] if status in TERMINAL else [(key[0], "deadline_passed", pd.Timestamp(deadline))]
        yield pd.DataFrame(late, columns=["run_id", "kind", "at"])

    def close(self) -> None:
        pass


def supervise(events: DataFrame, lateness: str = "1 minute") -> DataFrame:
    """Alerts over a stream of ``run_id, status, deadline, event_time``, timed by event time."""
    return (
        events.withWatermark("event_time", lateness)
        .groupBy("run_id")
        .transformWithStateInPandas(Supervisor(), outputStructType=ALERT, outputMode="Append", timeMode="EventTime")
    )
