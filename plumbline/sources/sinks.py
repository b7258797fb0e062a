"""Sinks: reports, run records, checkpoints, queues and archives as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fill colours of statuses in reports.
FILLS = {"NEW_COMPANY": "C6EFCE", "EDITING": "FFEB9C", "DATA_NOT_FOUND": "FFC7CE", "NO_CHANGES": "FFFFFF", "ALREADY_REPORTED": "D9D9D9"}


def styled(report: DataFrame) -> DataFrame:
    """The report with the fill of each row's status."""
    return report.withColumn("style", F.coalesce(F.element_at(F.create_map(*[x for k, v in FILLS.items() for x in (F.lit(k), F.lit(v))]), F.col("status")), F.lit("FFFFFF")))


def with_total(df: DataFrame, label: str, sums: list[str]) -> DataFrame:
    """Rows and a TOTAL row: text in `label`, sums in the others, null elsewhere."""
    total = df.agg(*[F.sum(c).alias(c) for c in sums])
    rows = [F.lit("TOTAL").alias(c) if c == label else F.col(c) if c in sums else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    return df.withColumn(label, F.col(label).cast("string")).unionByName(total.select(*rows))


def append_records(df: DataFrame, path: str, run_id: str) -> None:
    """Company records of a run as JSON lines, one folder for each run."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").json(path)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Writes the partitions that df holds anew and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merged(table: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The table after an upsert: rows of changes replace those of their key."""
    return table.join(changes.select(*key).distinct(), key, "left_anti").unionByName(changes)


def transition(items: DataFrame, moves: DataFrame, order: str | None = None) -> DataFrame:
    """Items (item_id, state) after moves (item_id, to), in the order of a column: only reserved to sending, sending to delivered or failed, failed to reserved are made, others are passed over.

    Without order, an item may have one move.
    """
    allowed = F.create_map(F.lit("reserved"), F.array(F.lit("sending")), F.lit("sending"), F.array(F.lit("delivered"), F.lit("failed")), F.lit("failed"), F.array(F.lit("reserved")))
    # A group here is one item's moves.
    queue = moves.groupBy("item_id").agg(F.transform(F.sort_array(F.collect_list(F.struct((F.col(order) if order else F.lit(0)).alias("at"), "to"))), lambda m: m["to"]).alias("moves"))
    step = lambda state, to: F.when(F.coalesce(F.array_contains(F.try_element_at(allowed, state), to), F.lit(False)), to).otherwise(state)
    j = items.join(queue, "item_id", "left")
    return j.withColumn("state", F.when(F.col("moves").isNull(), F.col("state")).otherwise(F.aggregate("moves", F.col("state"), step))).drop("moves")


def kept_checkpoints(saves: DataFrame, key: str, ts: str, most: int = 10) -> DataFrame:
    """The newest saves of each key."""
    from pyspark.sql import Window as W

    return saves.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(F.desc(ts)))).where(F.col("rn") <= most).drop("rn")


def archive_reasons(report: DataFrame, folders: DataFrame) -> DataFrame:
    """reason, n: what becomes of each company of a report: no_changes, no_folder, empty or processed."""
    j = report.join(folders, "company_id", "left")
    reason = F.when(~F.col("has_changes"), "no_changes").when(F.col("n_files").isNull(), "no_folder").when(F.col("n_files") == 0, "empty").otherwise("processed")
    return j.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
