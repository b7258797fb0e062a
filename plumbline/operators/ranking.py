"""Ranks, quotas and runs: the report queue, round robin of maps, product quota with reserve, log records, streaks, chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def report_queue(companies: DataFrame, limit: int = 0) -> DataFrame:
    """Never reported companies by upload, then the others by update; null dates last, then by id as text; the first `limit` if it is over 0."""
    never = F.col("report_date").isNull()
    out = companies.withColumn("queue", F.when(never, 0).otherwise(1)).withColumn("__d", F.when(never, F.col("upload_date")).otherwise(F.col("update_date")))
    out = out.orderBy("queue", F.col("__d").asc_nulls_last(), F.col("company_id").cast("string")).drop("__d")
    return out.limit(limit) if limit > 0 else out


def round_robin(df: DataFrame, group: str, order: list[str], key: str) -> DataFrame:
    """Rows with place n of their group; of a key only the row of the smallest (n, group) stays. Order by (n, group) is the merged order."""
    placed = df.withColumn("n", F.row_number().over(W.partitionBy(group).orderBy(*order)))
    rest = [c for c in placed.columns if c != key]
    return placed.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("n", group)).alias("__r")).select(key, "__r.*")


def quota_with_reserve(df: DataFrame, group: str, order: str, card: str, quota: int, reserve: float = 0.3) -> DataFrame:
    """df with admitted: rows are taken in order up to a quota for each group; its last share is for cards alone.

    A row is admitted while fewer than quota * (1 - reserve) are; after that only cards are, up to the quota. Running sums say
    this without state: others stop when rows before them fill the open part; cards stop when the quota is full.
    """
    open_part = int(quota * (1 - reserve))
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = df.withColumn("__n", F.row_number().over(W.partitionBy(group).orderBy(order))).withColumn("__late", F.sum((F.col(card) & (F.col("__n") > open_part)).cast("int")).over(w))
    ok = (F.col("__n") <= open_part) | (F.col(card) & (F.col("__late") <= quota - open_part))
    return seen.withColumn("admitted", ok).drop("__n", "__late")


def admitted_with_release(df: DataFrame, group: str, order: str, event: str, quota: int) -> DataFrame:
    """Slots that are taken ('take') and given back ('release') in order, for each group: admitted says whether a take got one. Truly sequential, so one group is one pandas frame."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", admitted boolean"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, used, out = pdf.sort_values(order, kind="stable"), 0, []
        for e in pdf[event]:
            if e == "release":
                used = max(0, used - 1)
                out.append(None)
            else:
                out.append(used < quota)
                used += used < quota
        return pdf.assign(admitted=pd.array(out, dtype="boolean"))

    return df.groupBy(group).applyInPandas(run, schema)


def interleaved(df: DataFrame, kind: str, order: list[Column | str]) -> DataFrame:
    """Rows of two kinds in turn: place of a row in its kind, then the kind."""
    return df.withColumn("turn", F.row_number().over(W.partitionBy(kind).orderBy(*order)))


def log_records(lines: DataFrame, source: str, order: str, text: str, start: str = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d") -> DataFrame:
    """Log lines as records: a line that starts with a time begins one, others go with the record before; lines before the first are left out."""
    w = W.partitionBy(source).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    told = lines.withColumn("record", F.sum(F.col(text).rlike(start).cast("int")).over(w)).where("record > 0")
    got = told.groupBy(source, "record").agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("l"))
    return got.select(source, "record", F.regexp_extract(F.col("l")[0][text], "(" + start.lstrip("^") + ")", 1).alias("ts"), F.size("l").alias("n_lines"), F.array_join(F.transform("l", lambda x: x[text]), "\n").alias("message"))


def streaks(df: DataFrame, group: str, order: str, hit: Column) -> DataFrame:
    """Longest run of hits of each group."""
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    told = df.select(group, order, hit.cast("int").alias("__h")).withColumn("__island", F.sum(1 - F.col("__h")).over(w))
    return told.groupBy(group, "__island").agg(F.sum("__h").alias("n")).groupBy(group).agg(F.max("n").alias("longest"))


def trailing_count(df: DataFrame, group: str, ts: str, seconds: int) -> DataFrame:
    """How many events of the group lie in the seconds up to each event, itself included."""
    w = W.partitionBy(group).orderBy(F.unix_micros(F.col(ts).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("n_trailing", F.count("*").over(w))


def too_fast(df: DataFrame, group: list[str], ts: str, least_ms: int) -> DataFrame:
    """Events that follow the one before in their group too soon."""
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(W.partitionBy(*group).orderBy(ts)).cast("timestamp"))
    return df.withColumn("gap_ms", gap / 1000).where(F.col("gap_ms") < least_ms)


def chunks(df: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Rows of a group in chunks of a size: group, chunk, n, items in order."""
    told = df.withColumn("chunk", F.floor((F.row_number().over(W.partitionBy(group).orderBy(order)) - 1) / size).cast("int"))
    return told.groupBy(group, "chunk").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(order)).alias("items"))


def first_mode(df: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of a group; of equals the one seen first."""
    return df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"), F.min(order).alias("__first")).groupBy(*group).agg(F.min_by(F.struct(value, "n"), F.struct((-F.col("n")).alias("a"), F.col("__first").alias("b"))).alias("m")).select(*group, F.col(f"m.{value}").alias(value), F.col("m.n").alias("n"))


def first_n(df: DataFrame, group: list[str], order: list[Column | str], n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("rn") <= n)


# Parts of names of sitemaps that come first, and last.
GOOD_SITEMAPS = ["product", "catalog", "katalog", "shop", "iblock", "tovar"]
LATE_SITEMAPS = ["attachment", "media", "news", "blog", "author", "tag", "feed"]


def sitemap_source_rank(url: str, own_host: Column) -> list[Column]:
    """Sort keys of sitemaps: those of the own host first, those of products first, those of news and media last, then by address."""
    from plumbline.functions.urls import Url

    path = F.lower(Url(F.col(url)).path)
    return [F.when(own_host, 0).otherwise(1), F.when(path.rlike("|".join(GOOD_SITEMAPS)), 0).otherwise(1), F.when(path.rlike("|".join(LATE_SITEMAPS)), 1).otherwise(0), F.col(url)]


def sitemap_rank() -> list[Column]:
    """Sort keys of sitemap rows: priority, information pages and slugs without digits last, depth, url."""
    from plumbline.functions.urls import Url, url_depth

    u = Url(F.col("url"))
    last = F.coalesce(F.try_element_at(u.segments, F.lit(-1)), F.lit(""))
    return [-F.col("priority"), F.lower(u.path).rlike("info|about|news|blog").cast("int"), (~last.rlike(r"\d")).cast("int"), url_depth(u), F.col("url")]
