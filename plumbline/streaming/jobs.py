"""Streams: tasks and statuses, claims, windows, sessions, watchdog, idempotent upload. Each works on a batch frame too where it has no state of its own."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TASK = "task_id string, task_type string, company_data map<string,string>, user_id string, created_at timestamp, priority int"
STATUS = "task_id string, status string, message string, progress double, timestamp timestamp"


def kafka(spark: SparkSession, servers: str, topics: str, schema: str) -> DataFrame:
    """JSON messages of Kafka topics, from the earliest; offsets are the checkpoint's. Needs Spark's Kafka package."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).option("startingOffsets", "earliest").load()
    return messages(raw.select(F.col("value").cast("string").alias("value"), "topic", "offset"), schema)


def messages(raw: DataFrame, schema: str) -> DataFrame:
    """Fields of JSON in column value; messages that don't parse are left out."""
    keep = [c for c in raw.columns if c != "value"]
    return raw.select(*keep, F.from_json("value", schema).alias("m")).where("m is not null").select(*keep, "m.*")


def urgent_first(batch: DataFrame) -> DataFrame:
    """A micro-batch of tasks in the order to run them."""
    return batch.orderBy(F.when(F.col("task_type") == "urgent", 0).otherwise(1), F.desc_nulls_last("priority"), "created_at")


def windowed_rate(events: DataFrame, ts: str = "ts", length: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes", by: list[str] | None = None, value: str | None = None) -> DataFrame:
    """Events in sliding windows: start, n, and the mean of value. Late events count until the watermark passes."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("__ts", late)
    aggs = [F.count("*").alias("n")] + ([F.avg(value).alias("mean")] if value else [])
    return timed.groupBy(F.window("__ts", length, slide).alias("w"), *(by or [])).agg(*aggs).select(F.col("w.start").alias("start"), *(by or []), "n", *(["mean"] if value else []))


def sessions(events: DataFrame, key: str, ts: str = "ts", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a key that a silence of the gap ends: start, end, n."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("__ts", late)
    return timed.groupBy(key, F.session_window("__ts", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def claimed_once(pages: DataFrame, key: str = "normalized_url", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each key once: the first page that claims it within the watermark."""
    if not pages.isStreaming:
        return pages.groupBy(key).agg(F.min_by(F.struct(*[c for c in pages.columns if c != key]), ts).alias("__r")).select(key, "__r.*")
    return pages.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def task_outcome(statuses: DataFrame, timeout_ms: int = 14_400_000) -> DataFrame:
    """task_id, outcome, n: the terminal status of each task, or 'timeout' when none came in time since its first. Stateful."""
    terminal = ("completed", "failed", "cancelled")

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, = state.get if state.exists else (0,)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"task_id": [key[0]], "outcome": ["timeout"], "n": [n]})
            return
        done = None
        for pdf in batches:
            n += len(pdf)
            hit = pdf[pdf["status"].isin(terminal)].sort_values("timestamp")
            done = done or (hit["status"].iloc[0] if len(hit) else None)
        if done:
            if state.exists:
                state.remove()
            yield pd.DataFrame({"task_id": [key[0]], "outcome": [done], "n": [n]})
        else:
            state.update((n,))
            state.setTimeoutDuration(timeout_ms)

    return statuses.groupBy("task_id").applyInPandasWithState(run, "task_id string, outcome string, n long", "n long", "append", GroupStateTimeout.ProcessingTimeTimeout)


def pipeline_state(beats: DataFrame, key: str, ts: str, now, idle_s: int = 1800) -> DataFrame:
    """key, last, state: running, or stalled after a silence of idle_s. `now` is a timestamp Column."""
    last = beats.groupBy(key).agg(F.max(ts).alias("last"))
    return last.withColumn("state", F.when(F.unix_seconds(now) - F.unix_seconds(F.col("last").cast("timestamp")) >= idle_s, "stalled").otherwise("running"))


def upload_chunks(path: str):
    """For foreachBatch: appends chunks (company_id, data_type, chunk_num, payload) to a table, each key once however often a batch is run again; the version row comes last."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        keys = ["company_id", "data_type", "chunk_num"]
        fresh = batch.dropDuplicates(keys)
        try:
            known = spark.read.parquet(path).select(*keys)
        except Exception as e:  # noqa: BLE001 - the table isn't there yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = None
        if known is not None:
            fresh = fresh.join(known, keys, "left_anti")
        fresh.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(path)

    return write


def chunk_states(chunks: DataFrame) -> DataFrame:
    """company_id, pending, failed, done, publishable: what an upload still needs before its version may be published."""
    c = lambda s: F.count_if(F.col("status") == s)
    return chunks.groupBy("company_id").agg(c("pending").alias("pending"), c("failed").alias("failed"), c("success").alias("done")).withColumn("publishable", (F.col("pending") == 0) & (F.col("failed") == 0))


def run_available(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there now and returns its rows; for tests and backfills of bounded results."""
    spark = df.sparkSession
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)
