"""Streams over files give what the batch gives."""

import json
import time

from pyspark.sql import functions as F

from plumbline.streaming import jobs


def events(spark, tmp_path, rows, schema, name="in"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).selectExpr("*").write.parquet(path)
    return spark.read.parquet(path), spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def test_windows_and_sessions(spark, tmp_path):
    rows = [(u, f"2024-01-01 {h:02d}:{m:02d}:00") for u in (1, 2) for h in range(3) for m in (0, 4, 50)]
    batch, stream = events(spark, tmp_path, rows, "user_id int, t string")
    batch, stream = (d.withColumn("ts", F.to_timestamp("t")) for d in (batch, stream))
    want = sorted(map(tuple, jobs.windowed_rate(batch).collect()))
    assert sorted(map(tuple, jobs.run_available(jobs.windowed_rate(stream), "w", "complete").collect())) == want
    want = sorted(map(tuple, jobs.sessions(batch, "user_id").collect()))
    assert len(want) == 8 and sorted(map(tuple, jobs.run_available(jobs.sessions(stream, "user_id"), "s", "complete").collect())) == want


def test_claims_and_messages(spark, tmp_path):
    batch, stream = events(spark, tmp_path, [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:01:00", 2), ("b", "2024-01-01 00:00:00", 3)], "normalized_url string, t string, n int")
    stream = stream.withColumn("ts", F.to_timestamp("t"))
    assert sorted(r.normalized_url for r in jobs.run_available(jobs.claimed_once(stream), "c").collect()) == ["a", "b"]
    assert sorted(r.n for r in jobs.claimed_once(batch.withColumn("ts", F.to_timestamp("t"))).collect()) == [1, 3]
    raw = spark.createDataFrame([(json.dumps({"task_id": "1", "task_type": t, "priority": p}), o) for o, (t, p) in enumerate([("regular", 9), ("urgent", 1)])] + [("torn {", 9)], "value string, offset int")
    got = jobs.urgent_first(jobs.messages(raw, jobs.TASK).where("task_id is not null")).collect()
    assert [r.task_type for r in got] == ["urgent", "regular"]


def test_outcomes(spark, tmp_path):
    _, stream = events(spark, tmp_path, [("a", "running", "2024-01-01 00:00:00"), ("a", "completed", "2024-01-01 00:01:00"), ("b", "running", "2024-01-01 00:00:00")], "task_id string, status string, timestamp string")
    q = jobs.task_outcome(stream).writeStream.format("memory").queryName("o").outputMode("append").start()  # with timeouts a stream has no end
    try:
        for _ in range(120):
            got = [tuple(r) for r in spark.table("o").collect()]
            if got:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert got == [("a", "completed", 2)]


def test_uploads_are_idempotent(spark, tmp_path):
    write = jobs.upload_chunks(str(tmp_path / "table"))
    batch = spark.createDataFrame([(1, "p", 0, "x"), (1, "p", 0, "x"), (1, "p", 1, "y")], "company_id int, data_type string, chunk_num int, payload string")
    write(batch, 0)
    write(batch, 0)
    write(batch.unionAll(spark.createDataFrame([(2, "p", 0, "z")], batch.schema)), 1)
    assert sorted((r.company_id, r.chunk_num) for r in spark.read.parquet(str(tmp_path / "table")).collect()) == [(1, 0), (1, 1), (2, 0)]
