"""Dedupe and entity resolution: first of a key, fullest record of an address, merges, families, harvests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.ids import dealer_id
from plumbline.functions.text import address_key


def first_by(df: DataFrame, key: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key by order; a partial aggregate, so a hot key meets no sort."""
    names = [f"__k{i}" for i in range(len(key))]
    keyed = df.select(*[F.col(k).alias(n) if isinstance(k, str) else k.alias(n) for k, n in zip(key, names, strict=True)], F.struct(*order).alias("__o"), F.struct(*df.columns).alias("__r"))
    return keyed.groupBy(*names).agg(F.min_by("__r", "__o").alias("__r")).select("__r.*")


def filled(columns: list[str]) -> Column:
    """How many of the columns hold something: not null, not ''."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c).cast("string") != "", F.lit(False)).cast("int")
    return total


def dealers_by_address(df: DataFrame, columns: list[str], address: str = "address", order: str = "ord") -> DataFrame:
    """Of dealers with one address the one with most fields filled, the first of equals, at the place of the first; those without address all stay."""
    keyed = df.withColumn("__a", F.when(F.coalesce(address, F.lit("")) != "", address_key(F.col(address)))).withColumn("__f", filled(columns))
    some = keyed.where(F.col("__a").isNotNull())
    best = some.groupBy("__a").agg(F.min_by(F.struct(*df.columns), F.struct(-F.col("__f"), F.col(order))).alias("__r"), F.min(order).alias("__at"))
    best = best.select(*[F.col("__r")[c].alias(c) if c != order else F.col("__at").alias(order) for c in df.columns])
    return best.unionByName(keyed.where(F.col("__a").isNull()).select(df.columns))


def dealers_by_name(df: DataFrame, fields: list[str], name: str = "name", address: str = "address", order: str = "ord") -> DataFrame:
    """Dealers of one name merged: the record of the longest address is the base (first of equals), blanks filled by the others in order."""
    full = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    rank = F.struct(-F.length(F.coalesce(F.col(address), F.lit(""))), F.col(order))
    # A blank of the base takes the first value by order among the others: the base's own value sorts before all.
    base = df.groupBy(F.lower(F.trim(name)).alias("__n")).agg(F.min_by(F.struct(*df.columns), rank).alias("__b"), *[F.min_by(full(c), F.when(full(c).isNotNull(), F.col(order))).alias(f"__f_{c}") for c in fields], F.min(order).alias("__at"))
    pick = lambda c: F.coalesce(F.when(F.coalesce(F.col("__b")[c], F.lit("")) != "", F.col("__b")[c]), F.col(f"__f_{c}"))
    return base.select(*[(pick(c) if c in fields else F.col("__at") if c == order else F.col("__b")[c]).alias(c) for c in df.columns])


def new_dealers(df: DataFrame, known: DataFrame, order: str = "ord") -> DataFrame:
    """Dealers with an id of name and address, each id once, without those that are known (supplier_id)."""
    named = df.withColumn("supplier_id", dealer_id(F.col("name"), F.col("address")))
    return first_by(named, ["supplier_id"], [order]).join(known.select("supplier_id").distinct(), "supplier_id", "left_anti")


def products_once(df: DataFrame, order: str = "ord") -> DataFrame:
    """Products once by product_id, then once by slug; the earliest stays. Rows without slug are not compared by it."""
    ids = first_by(df, ["product_id"], [order])
    slugs = first_by(ids.where("slug is not null"), ["slug"], [order])
    return slugs.unionByName(ids.where("slug is null"))


def case_twins(df: DataFrame, column: str) -> DataFrame:
    """Values that differ in case alone: key, n spellings, the spellings."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias("v")).distinct().groupBy(F.lower("v").alias("key")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("v")).alias("spellings")).where("n > 1")


def best_links(df: DataFrame, key: str, priority: str, order: str) -> DataFrame:
    """The row of the highest priority of each key, the first of equals."""
    return first_by(df, [key], [(-F.col(priority)).alias("p"), F.col(order)])


def size_variants(df: DataFrame, family: str = "dir", name: str = "slug", general: str = "is_general") -> DataFrame:
    """Cards of one family collapse: the general card if there is one, else the one named like the family, else all."""
    hit = F.col(name) == F.substring_index(F.regexp_replace(family, "/+$", ""), "/", -1)
    told = df.groupBy(family).agg(F.bool_or(general).alias("__g"), F.bool_or(hit).alias("__h"), F.count("*").alias("__n"))
    out = df.join(told, family)
    keep = F.when(F.col("__n") == 1, True).when(F.col("__g"), F.col(general)).when(F.col("__h"), hit).otherwise(True)
    return out.withColumn("kept", keep).select(*df.columns, "kept")


def unseen(pending: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return pending.join(done.select(key).distinct(), key, "left_anti")


def repeated_bodies(df: DataFrame, body: str, url: str, least: int = 10) -> DataFrame:
    """Digests of bodies that stand at many different URLs: soft errors."""
    return df.groupBy(F.md5(F.col(body).cast("binary")).alias("digest")).agg(F.countDistinct(url).alias("urls")).where(F.col("urls") >= least)
