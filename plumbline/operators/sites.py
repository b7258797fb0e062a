"""Sites and corpora: perimeter, host groups, canonical addresses, sitemap admission, page corpora, adapters, manifests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.functions import html as H
from plumbline.functions import urls as U


def in_scope(urls: DataFrame, base_host: str, domains: DataFrame | None = None, suffixes: list[str] | None = None, url: str = "url") -> DataFrame:
    """urls with in_scope: an http(s) address of the base host (with or without www, or its mobile mirror), of a domain of the profile, or under one of its suffixes. domains: host."""
    u = U.Url(F.col(url))
    host, base = U.desktop_host(u.host), U.desktop_host(F.lit(base_host))
    ok = host == base
    for s in suffixes or []:
        ok = ok | (host == s) | host.endswith("." + s)
    out = urls.withColumn("__h", host)
    if domains is not None:
        known = domains.select(U.desktop_host(F.col("host")).alias("__h"), F.lit(True).alias("__d")).distinct()
        out = out.join(known, "__h", "left")
        ok = ok | F.coalesce(F.col("__d"), F.lit(False))
    valid = u.scheme.isin("http", "https") & ~u.netloc.contains("@") & (u.host != "") & ~u.host.rlike(r"\s")
    return out.withColumn("in_scope", F.coalesce(valid & ok, F.lit(False))).select(*urls.columns, "in_scope")


def subdomain(host: Column, base: Column) -> Column:
    h, b = U.strip_www(host), U.strip_www(base)
    return (h != b) & h.endswith(F.concat(F.lit("."), b))


def equivalent_sites(sites: DataFrame, groups: DataFrame, host: str = "host") -> DataFrame:
    """sites with canonical: the first host by name of the group (group_id, host) that its desktop host is in, else the desktop host."""
    told = sites.withColumn("__h", U.desktop_host(F.col(host)))
    named = groups.select("group_id", U.desktop_host(F.col("host")).alias("__h"))
    first = named.groupBy("group_id").agg(F.min("__h").alias("canonical"))
    lookup = named.join(first, "group_id").groupBy("__h").agg(F.min("canonical").alias("canonical"))
    return told.join(lookup, "__h", "left").withColumn("canonical", F.coalesce("canonical", "__h")).drop("__h")


def canonical_urls(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, canonical, source: the canonical link, else the OpenGraph address, if it is of the same site, else the page's own."""
    f = pages.select(id_col, F.col(url_col).alias("__u"), H.page_features(F.col(html_col)).alias("f"))
    f = f.select(id_col, "__u", H.absolute_url(F.col("__u"), F.col("f.canonical")).alias("a"), H.absolute_url(F.col("__u"), F.col("f.og_url")).alias("b"))
    same = lambda c: F.when(U.desktop_host(U.Url(F.col(c)).host) == U.desktop_host(U.Url(F.col("__u")).host), F.col(c))
    return f.select(id_col, F.coalesce(same("a"), same("b"), F.col("__u")).alias("canonical"), F.when(same("a").isNotNull(), "link").when(same("b").isNotNull(), "og").otherwise("self").alias("source"))


def eligible_sitemap_rows(rows: DataFrame, base_locale: str | None = None) -> DataFrame:
    """Sitemap rows (url, category) that may be offered to the queue."""
    u = U.Url(F.col("url"))
    return rows.where(u.scheme.isin("http", "https") & ~F.col("category").startswith("excluded") & ~U.foreign_language(u, base_locale) & ~F.coalesce(U.page_over_limit(u), F.lit(False)))


def merged_sitemaps(rows: DataFrame) -> DataFrame:
    """Rows of several maps (map_id, pos, url, normalized_url, priority): of each address the row of the highest priority, the first of equals."""
    rest = [c for c in rows.columns if c != "normalized_url"]
    return rows.groupBy("normalized_url").agg(F.min_by(F.struct(*rest), F.struct(-F.col("priority"), "map_id", "pos")).alias("__r")).select("normalized_url", "__r.*")


def sitemap_admission(rows: DataFrame, quota: int, reserve: float = 0.3) -> DataFrame:
    """Offered rows of sites (site, url, priority, …) in rank order, each address once whatever its scheme, with admitted by the quota and its reserve for cards; the others are deferred."""
    from plumbline.operators.dedupe import first_by
    from plumbline.operators.ranking import quota_with_reserve, sitemap_rank

    keyed = rows.withColumn("__key", U.scheme_free(U.normalized(U.Url(F.col("url")))))
    once = first_by(keyed, ["site", "__key"], [*[c.alias(f"r{i}") for i, c in enumerate(sitemap_rank())]])
    ranked = once.withColumn("rank", F.row_number().over(W.partitionBy("site").orderBy(*sitemap_rank()))).withColumn("card", U.product_card(U.Url(F.col("url"))))
    return quota_with_reserve(ranked, "site", "rank", "card", quota, reserve).drop("__key")


def page_corpus(spark, pattern: str, sidecar: str, per_folder: int | None = None) -> DataFrame:
    """folder, file, html, url of saved pages and their sidecar JSON of the same name, the first per_folder by name."""
    name = lambda c, ext: F.regexp_extract(c, rf"([^/]+)\.{ext}$", 1)
    folder = lambda c: F.regexp_extract(c, r"([^/]+)/[^/]+$", 1)
    pages = spark.read.format("binaryFile").load(pattern).select(folder(F.col("path")).alias("folder"), name(F.col("path"), "html").alias("file"), F.decode("content", "utf-8").alias("html"))
    side = spark.read.json(sidecar, multiLine=True, schema="url string").select(folder(F.input_file_name()).alias("folder"), name(F.input_file_name(), "json").alias("file"), "url")
    out = pages.join(side, ["folder", "file"], "left")
    return out if per_folder is None else out.withColumn("__n", F.row_number().over(W.partitionBy("folder").orderBy("file"))).where(F.col("__n") <= per_folder).drop("__n")


def missing_paths(rows: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Report rows whose file is not in the manifest."""
    return rows.where(F.coalesce(path, F.lit("")) != "").join(manifest.select(path).distinct(), path, "left_anti")


def purge_plan(manifest: DataFrame, busy: DataFrame, root: str) -> DataFrame:
    """source, files, bytes, allowed: what a purge would remove; not of busy companies nor outside of the root. Nothing is removed."""
    told = manifest.join(busy.select("company_id", F.lit(True).alias("__b")).distinct(), "company_id", "left")
    ok = F.coalesce(~F.col("__b"), F.lit(True)) & F.col("path").startswith(root.rstrip("/") + "/")
    return told.groupBy("source").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.bool_and(ok).alias("allowed"))


#: Adapters of sites: domain to a function from HTML Column to Markdown Column.
ADAPTERS: dict[str, Callable[[Column], Column]] = {}


def adapter(domain: str):
    """Registers a site's own extraction under its domain."""

    def wrap(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
        ADAPTERS[domain] = f
        return f

    return wrap


def site_markdown(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """pages with markdown and how: by the adapter of the host if there is one and it gives something, else the general way."""
    general = H.page_markdown(F.col(html))
    out = pages.withColumn("__g", general)
    own, who = F.lit(None).cast("string"), F.lit(None).cast("string")
    for domain, f in sorted(ADAPTERS.items()):
        mine = U.desktop_host(F.col(host)) == domain
        own, who = F.when(mine, f(F.col(html))).otherwise(own), F.when(mine, F.lit(domain)).otherwise(who)
    out = out.withColumn("__o", F.nullif(F.trim(own), F.lit(""))).withColumn("__w", who)
    how = F.when(F.col("__o").isNotNull(), F.concat(F.lit("adapter:"), "__w")).when(F.col("__w").isNotNull(), F.concat(F.lit("fallback:"), "__g.how")).otherwise(F.col("__g.how"))
    return out.withColumn("markdown", F.coalesce("__o", "__g.markdown")).withColumn("how", how).drop("__g", "__o", "__w")
