"""Snapshot diff: full outer joins of versions, parents and children, and the statuses that follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import parsed_date

# Status codes and the labels of reports.
NEW, REPORTED, COMPARE, EDITED, SAME, GONE, NEW_DATA = "NEW_COMPANY", "ALREADY_REPORTED", "NEEDS_COMPARISON", "EDITING", "NO_CHANGES", "DATA_NOT_FOUND", "NEW_DATA"
LABELS = {NEW: "Новая компания", REPORTED: "Уже в отчёте", EDITED: "Редактирование", SAME: "Изменений нет", GONE: "Данные не найдены", NEW_DATA: "Новые данные"}


def company_status(report_date: Column, update_date: Column, report_version: Column, data_version: Column) -> Column:
    """What a company needs: never reported, reported already, or to be compared. Versions decide where both are there, else dates."""
    reported, updated = parsed_date(report_date), parsed_date(update_date)
    versions = (F.coalesce(report_version, F.lit("")) != "") & (F.coalesce(data_version, F.lit("")) != "")
    return F.when(reported.isNull(), NEW).when(versions, F.when(report_version == data_version, REPORTED).otherwise(COMPARE)).when(updated > reported, COMPARE).otherwise(REPORTED)


def _last(df: DataFrame, key: list[str], order: str | None) -> DataFrame:
    """The last row of each key by order; a null key is a key."""
    if order is None:
        return df
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__r"))
    return best.select(*key, *[F.col("__r")[c].alias(c) for c in rest])


def diff_rows(old: DataFrame, new: DataFrame, key: list[str], fields: list[str], order: str | None = None) -> DataFrame:
    """Key, status (NEW_DATA, DATA_NOT_FOUND, EDITING, NO_CHANGES) and changed: array of struct<field, old, new>.

    One full outer join on the key, null-safe; of repeated keys the last by order counts. Strings are compared trimmed, nulls equal nulls.
    """
    a, b = _last(old, key, order), _last(new, key, order)
    a = a.select(*[F.col(k).alias(f"__o_{k}") for k in key], F.struct(*[F.col(f) for f in fields]).alias("__old"))
    b = b.select(*[F.col(k).alias(f"__n_{k}") for k in key], F.struct(*[F.col(f) for f in fields]).alias("__new"))
    on = None
    for k in key:
        c = F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}"))
        on = c if on is None else on & c
    j = a.join(b, on, "full_outer")
    value = lambda side, f: F.trim(F.col(side)[f].cast("string"))
    changed = F.array(*[F.when(~value("__old", f).eqNullSafe(value("__new", f)), F.struct(F.lit(f).alias("field"), value("__old", f).alias("old"), value("__new", f).alias("new"))) for f in fields])
    j = j.withColumn("changed", F.when(F.col("__old").isNotNull() & F.col("__new").isNotNull(), F.array_compact(changed)).otherwise(F.array_compact(changed)))
    status = F.when(F.col("__old").isNull(), NEW_DATA).when(F.col("__new").isNull(), GONE).when(F.size("changed") > 0, EDITED).otherwise(SAME)
    return j.select(*[F.coalesce(f"__n_{k}", f"__o_{k}").alias(k) for k in key], status.alias("status"), "changed")


def escalated(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents (key, status) with NO_CHANGES raised to EDITING where any child (key, status) changed; children of new parents count as new."""
    any_change = children.groupBy(key).agg(F.bool_or(F.col("status") != SAME).alias("__any"))
    out = parents.join(any_change, key, "left")
    status = F.when((F.col("status") == SAME) & F.coalesce("__any", F.lit(False)), EDITED).otherwise(F.col("status"))
    return out.select(*[status.alias(c) if c == "status" else F.col(c) for c in parents.columns])


def overridden(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children of new companies are new data whatever they compare to."""
    fresh = parents.where(F.col("status") == NEW).select(F.col(key).alias("__k")).distinct()
    out = children.join(fresh, children[key] == F.col("__k"), "left")
    status = F.when(F.col("__k").isNotNull(), NEW_DATA).otherwise(F.col("status"))
    return out.select(*[status.alias(c) if c == "status" else children[c] for c in children.columns])


def file_changed(old_hash: Column, new_hash: Column, old_date: Column, new_date: Column, same_rest: Column) -> Column:
    """Whether a file changed: by the rest of its fields, and by its date only where a digest lacks."""
    both = (F.coalesce(old_hash, F.lit("")) != "") & (F.coalesce(new_hash, F.lit("")) != "")
    return ~(same_rest & old_hash.eqNullSafe(new_hash) & (both | old_date.eqNullSafe(new_date)))


def label(status: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in LABELS.items() for x in (F.lit(k), F.lit(v))]), status)


def as_of(history: DataFrame, day: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """The versions valid on a day."""
    return history.where((F.col(start) <= day) & (F.col(end).isNull() | (F.col(end) > day)))


def was_became(changes: DataFrame) -> DataFrame:
    """One row for each changed field: was and became."""
    rest = [c for c in changes.columns if c != "changed"]
    return changes.select(*rest, F.explode("changed").alias("c")).select(*rest, F.col("c.field").alias("field"), F.coalesce("c.old", F.lit("")).alias("was"), F.coalesce("c.new", F.lit("")).alias("became"))
