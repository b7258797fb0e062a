"""Joins beyond plain equality: as-of, interval, longest prefix, suffix, and the anti and semi joins of the work queue. None plans as a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def as_of_last(left: DataFrame, right: DataFrame, key: list[str], left_ts: str, right_ts: str, value: str, within: Column | None = None) -> DataFrame:
    """left with the value of the last right row of its key at or before its time; null if there is none.

    Both sides are stacked and one window carries the last value forward: one shuffle by key, no pairs. Of right rows of one
    time that with the greatest value counts. `within` may drop a carried value, given the columns left_ts and __at.
    """
    cols = left.columns
    right = right.groupBy(*key, right_ts).agg(F.max(value).alias(value))
    a = left.select(*key, F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"), F.struct(*cols).alias("__l"), F.lit(None).cast(right.schema[value].dataType).alias("__v"), F.lit(None).cast(right.schema[right_ts].dataType).alias("__at"))
    b = right.select(*key, F.col(right_ts).alias("__ts"), F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__l"].dataType).alias("__l"), F.col(value).alias("__v"), F.col(right_ts).alias("__at"))
    w = W.partitionBy(*key).orderBy("__ts", "__side").rowsBetween(W.unboundedPreceding, W.currentRow)
    both = a.unionByName(b).withColumn("__p", F.last(F.when(F.col("__side") == 0, F.struct("__v", "__at")), ignorenulls=True).over(w)).where("__side = 1")
    got = both.select("__l.*", F.col("__p.__v").alias(value), F.col("__p.__at").alias("__at"))
    if within is not None:
        got = got.withColumn(value, F.when(within, F.col(value)))
    return got.drop("__at")


def in_intervals(points: DataFrame, spans: DataFrame, ts: str, start: str, end: str, width_s: int, point_key: list[str] | None = None) -> DataFrame:
    """points joined to spans with start <= ts <= end (times): both are dealt by time buckets of width_s, then joined by equality."""
    bucket = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / width_s)
    a = points.withColumn("__b", bucket(ts))
    b = spans.where(F.col(start) <= F.col(end)).withColumn("__b", F.explode(F.sequence(bucket(start), bucket(end))))
    return a.join(b, "__b").where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))).drop("__b")


def longest_prefix(df: DataFrame, prefixes: DataFrame, path: str, prefix: str, value: str) -> DataFrame:
    """df with the value of the longest prefix that is its path or ends at one of its slashes; null if none.

    The prefixes of different paths are listed and joined by equality; a path has as many as it has segments.
    """
    paths = df.select(path).distinct().where(F.col(path).isNotNull())
    parts = F.split(F.regexp_replace(path, "/+$", ""), "/")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    told = paths.withColumn("__head", F.explode(heads))
    rules = prefixes.select(F.regexp_replace(prefix, "/+$", "").alias("__head"), F.col(value).alias("__value"))
    best = told.join(rules, "__head").groupBy(path).agg(F.max_by("__value", F.struct(F.length("__head"), "__value")).alias(value))
    return df.join(best, path, "left")


def profiles_of(hosts: DataFrame, profiles: DataFrame, host: str = "host") -> DataFrame:
    """hosts with the profile of their domain: exact, else alias, else the longest suffix, else 'default'.

    profiles: kind (domain, alias, suffix), key, profile. Suffixes are found by listing those of each different host.
    """
    different = hosts.select(host).distinct().where(F.col(host).isNotNull())
    labels = F.split(host, r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    told = different.select(host, F.posexplode(tails).alias("k", "key")).join(profiles, "key")
    told = told.where((F.col("kind") == "suffix") | (F.col("k") == 0))
    rank = F.struct(F.when(F.col("kind") == "domain", 0).when(F.col("kind") == "alias", 1).otherwise(2).alias("r"), "k", "profile")
    best = told.groupBy(host).agg(F.min_by("profile", rank).alias("profile"))
    return hosts.join(best, host, "left").withColumn("profile", F.coalesce("profile", F.lit("default")))


def last_delivered(requests: DataFrame, items: DataFrame) -> DataFrame:
    """The snapshot that each company got last: delivered requests joined to their items, the later row wins."""
    return requests.where("state = 'delivered'").join(items, "request_id").groupBy("company_id").agg(F.max_by("snapshot", "row_no").alias("snapshot"))


def unsynced(requests: DataFrame, items: DataFrame) -> DataFrame:
    """request_id, report_date, company_id, version of delivered requests that are not synced, with row_no, their order."""
    open_ones = requests.where((F.col("state") == "delivered") & ~F.col("synced")).select("request_id", "report_date", "row_no")
    return open_ones.join(items.select("request_id", "company_id", "version"), "request_id").select("request_id", "report_date", "company_id", "version", "row_no")


def reservable(companies: DataFrame, busy: DataFrame, delivered: DataFrame) -> DataFrame:
    """Companies that are not busy and whose version differs from the one delivered last."""
    free = companies.join(busy.select("company_id").distinct(), "company_id", "left_anti")
    seen = delivered.select("company_id", F.col("snapshot").alias("__seen"))
    return free.join(seen, "company_id", "left").where(~F.col("version").eqNullSafe(F.col("__seen"))).drop("__seen")


def listed(companies: DataFrame, wanted: DataFrame, key: str = "company_id") -> tuple[DataFrame, DataFrame]:
    """Companies of a list, and ids of the list that no company has."""
    ids = wanted.select(key).distinct()
    return companies.join(ids, key, "left_semi"), ids.join(companies.select(key).distinct(), key, "left_anti")


def last_result(results: DataFrame, key: str = "company_id", run: str = "run_id", order: str = "ord") -> DataFrame:
    """The last record of the newest run of each company."""
    rest = [c for c in results.columns if c != key]
    return results.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(run, order)).alias("__r")).select(key, "__r.*")


def cards(sites: DataFrame, results: DataFrame) -> DataFrame:
    """Site list and last results, full outer on company_id; name and website of the list first."""
    a, b = sites.alias("a"), last_result(results).alias("b")
    both = a.join(b, F.col("a.company_id") == F.col("b.company_id"), "full_outer")
    extra = [c for c in results.columns if c not in ("company_id", "name", "website")]
    return both.select(F.coalesce("a.company_id", "b.company_id").alias("company_id"), F.coalesce("a.name", "b.name").alias("name"), F.coalesce("a.website", "b.website").alias("website"), *[F.col(f"b.{c}") for c in extra])


def equivalent_hosts(a: Column, b: Column) -> Column:
    from plumbline.functions.urls import desktop_host

    return (desktop_host(a) == desktop_host(b)) & (desktop_host(a) != "")


def mismatches(reported: DataFrame, actual: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Counters that differ from what is there: key, counter, reported, actual."""
    j = reported.select(key, *[F.col(c).alias(f"__r_{c}") for c in columns]).join(actual.select(key, *[F.col(c).alias(f"__a_{c}") for c in columns]), key)
    rows = F.array(*[F.struct(F.lit(c).alias("counter"), F.col(f"__r_{c}").cast("long").alias("reported"), F.col(f"__a_{c}").cast("long").alias("actual")) for c in columns])
    return j.select(key, F.explode(rows).alias("x")).select(key, "x.*").where("not (reported <=> actual)")
