"""Aggregates: run summaries, page and company quality, histograms, thresholds, totals, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.functions.text import error_module


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    """a / b rounded half even; null where b is 0 or null."""
    return F.bround(F.when(b != 0, a / b), digits)


def run_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Of records (status, products, seconds, name, ord): done, zero, zero_percent, failed, products, median_seconds, zero_names (first 50 by ord)."""
    zero = F.coalesce("products", F.lit(0)) == 0
    keys = by or []
    df = df.withColumn("__all", F.lit(1))
    base = df.groupBy("__all", *keys).agg(
        F.count("*").alias("done"), F.count_if(zero).alias("zero"), F.bround(F.count_if(zero) * 100.0 / F.count("*"), 1).alias("zero_percent"), F.count_if(F.col("status") != "success").alias("failed"),
        F.coalesce(F.sum("products"), F.lit(0)).alias("products"), F.bround(F.percentile("seconds", 0.5), 1).alias("median_seconds"),
    )
    # At most 50 rows of a group leave any task.
    firsts = df.where(zero).withColumn("__rn", F.row_number().over(W.partitionBy("__all", *keys).orderBy("ord", "name"))).where(F.col("__rn") <= 50)
    names = firsts.groupBy("__all", *keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("__rn", "name"))), lambda x: x["name"]).alias("zero_names"))
    same = [base[k].eqNullSafe(names[k]) for k in ("__all", *keys)]
    return base.join(names, same, "left").select(*[base[k] for k in keys], "done", "zero", "zero_percent", "failed", "products", "median_seconds", F.coalesce("zero_names", F.array().cast("array<string>")).alias("zero_names"))


def errors_by_module(df: DataFrame, message: str, modules: list[str], samples: int = 3) -> DataFrame:
    """module, n, samples (first by text, 200 characters at most), for every module of the list, none too."""
    told = df.where(F.col(message).isNotNull()).select(error_module(F.col(message)).alias("module"), F.substring(message, 1, 200).alias("m"))
    counts = told.groupBy("module").agg(F.count("*").alias("n"))
    firsts = told.distinct().withColumn("rn", F.row_number().over(W.partitionBy("module").orderBy("m"))).where(F.col("rn") <= samples).groupBy("module").agg(F.array_sort(F.collect_list("m")).alias("samples"))
    names = df.sparkSession.createDataFrame([(m,) for m in modules], "module string")
    return names.join(counts, "module", "left").join(firsts, "module", "left").select("module", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def boilerplate_share(df: DataFrame, site: str, page: str, text: str, threshold: float = 0.8, least_pages: int = 3) -> DataFrame:
    """site, n_pages, share: the share of line occurrences whose line stands on at least threshold of the site's pages; null with fewer than least_pages pages with lines.

    Lines are trimmed, their blanks single, those under three characters left out. Counts are two-level: (site, line, page), then (site, line).
    """
    lines = df.select(F.col(site).alias("site"), F.col(page).alias("page"), F.explode(F.split(F.col(text), "\n")).alias("l"))
    lines = lines.select("site", "page", F.trim(F.regexp_replace("l", r"\s+", " ")).alias("l")).where(F.length("l") >= 3)
    per_page = lines.groupBy("site", "l", "page").agg(F.count("*").alias("k"))
    per_line = per_page.groupBy("site", "l").agg(F.count("*").alias("pages"), F.sum("k").alias("k"))
    pages = per_page.groupBy("site").agg(F.countDistinct("page").alias("n_pages"))
    j = per_line.join(pages, "site")
    out = j.groupBy("site", "n_pages").agg(F.sum(F.when(F.col("pages") >= threshold * F.col("n_pages"), F.col("k")).otherwise(0)).alias("a"), F.sum("k").alias("b"))
    return out.select("site", "n_pages", F.when(F.col("n_pages") >= least_pages, ratio(F.col("a").cast("double"), F.col("b"))).alias("share"))


def exclusive_quantile(values: Column, parts: int, k: int) -> Column:
    """The k-th of parts-1 cut points of a sorted array, exclusive method: null under two values."""
    n = F.size(values)
    m = n + 1
    j = F.floor(F.lit(k) * m / parts).cast("int")
    j = F.when(j < 1, 1).when(j > n - 1, n - 1).otherwise(j)
    delta = F.lit(k) * m - j * parts
    return F.when(n >= 2, (F.element_at(values, j) * (parts - delta) + F.element_at(values, j + 1) * delta) / parts)


def corpus_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, n, median, p10, p90 (exclusive, from ten values on). By ranks, so that no group is gathered."""
    told = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.percentile(value, 0.5).alias("median"))
    cuts = quantiles_by_rank(df.withColumn(value, F.col(value).cast("double")), by, value).where(F.col("k").isin(1, 9)).groupBy(*by).agg(*[F.max(F.when(F.col("k") == k, F.col("q"))).alias(name) for k, name in ((1, "p10"), (9, "p90"))])
    return told.join(cuts, by, "left").select(*by, "n", "median", *[F.when(F.col("n") > 9, F.col(c)).alias(c) for c in ("p10", "p90")])


def quantiles_by_rank(df: DataFrame, by: list[str], value: str, parts: int = 10) -> DataFrame:
    """by, k, q: exclusive cut points by ranks alone, so that no group is gathered."""
    told = df.where(F.col(value).isNotNull())
    n = told.groupBy(*by).agg(F.count("*").alias("__n"))
    ranked = told.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(value)))
    cuts = n.where("__n >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(parts - 1))))
    j = F.greatest(F.least(F.floor(F.col("k") * (F.col("__n") + 1) / parts), F.col("__n") - 1), F.lit(1))
    cuts = cuts.withColumn("__j", j).withColumn("__d", F.col("k") * (F.col("__n") + 1) - F.col("__j") * parts)
    both = cuts.withColumn("__r", F.explode(F.array("__j", F.col("__j") + 1)))
    got = both.join(ranked.select(*by, "__r", F.col(value).cast("double").alias("__v")), [*by, "__r"])
    weight = F.when(F.col("__r") == F.col("__j"), parts - F.col("__d")).otherwise(F.col("__d"))
    return got.groupBy(*by, "k").agg((F.sum(F.col("__v") * weight) / parts).alias("q"))


def alerts(rules: list[tuple[Column, str]]) -> Column:
    """Messages of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in rules]))


def module_times(df: DataFrame, company: str, module: str, seconds: str, retry: str) -> DataFrame:
    """company (null: all), module, n, total, median, retry_total: by company and module, and by module."""
    sets = df.groupingSets([[company, module], [module]], company, module)
    ok = F.when(~F.col(retry), F.col(seconds))
    return sets.agg(F.count(ok).alias("n"), F.sum(ok).alias("total"), F.percentile(ok, 0.5).alias("median"), F.sum(F.when(F.col(retry), F.col(seconds)).otherwise(0)).alias("retry_total"), F.grouping(company).alias("is_total"))


def module_pivot(df: DataFrame, company: str, module: str, seconds: str, modules: list[str]) -> DataFrame:
    """One row for each company and a TOTAL: n and total of every module of the list."""
    aggs = [a for m in modules for a in (F.count_if(F.col(module) == m).alias(f"{m}_n"), F.sum(F.when(F.col(module) == m, F.col(seconds)).otherwise(0)).alias(f"{m}_total"))]
    return df.withColumn("__c", F.col(company).cast("string")).rollup("__c").agg(F.grouping("__c").alias("__t"), *aggs).select(F.when(F.col("__t") == 1, "TOTAL").otherwise(F.col("__c")).alias("company"), *[c for m in modules for c in (f"{m}_n", f"{m}_total")])


def top_prefixes(paths: DataFrame, segments: Column, by: list[str], least: int, most: int) -> DataFrame:
    """by, prefix, n: the most frequent first segments."""
    told = paths.select(*by, F.concat(F.lit("/"), F.try_element_at(segments, F.lit(1)), F.lit("/")).alias("prefix")).where(F.col("prefix").isNotNull())
    counts = told.groupBy(*by, "prefix").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return counts.withColumn("rn", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("n"), "prefix"))).where(F.col("rn") <= most).drop("rn")


def top_templates(paths: DataFrame, path: Column, by: list[str], least: int = 3, most: int = 3) -> DataFrame:
    """by, template, n: /first/…/*.ext templates of paths with two segments or more, the most frequent."""
    low = F.regexp_replace(path, "/+$", "")
    segs = F.filter(F.split(low, "/"), lambda s: s != "")
    ext = F.regexp_extract(low, r"(\.[a-z0-9]+)$", 1)
    template = F.concat(F.lit("/"), segs[0], F.lit("/"), F.array_join(F.transform(F.sequence(F.lit(2), F.greatest(F.size(segs), F.lit(2))), lambda _: F.lit("[^/]+")), "/"), ext)
    told = paths.select(*by, F.when(F.size(segs) >= 2, template).alias("template")).where("template is not null")
    counts = told.groupBy(*by, "template").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return counts.withColumn("rn", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("n"), "template"))).where(F.col("rn") <= most).drop("rn")


def token_cost(tokens: Column, price: float) -> Column:
    return F.bround(tokens / 1e6 * price, 2)


def confidence(found: Column, extracted: Column, valid: Column) -> Column:
    return F.bround(found * 0.3 + extracted * 0.4 + valid * 0.3, 3)


def check_scores(df: DataFrame, checks: list[tuple[str, str, Column]], key: str) -> DataFrame:
    """check_name, criterion, total, passed, score, examples (first five failing keys): all checks in one pass over df."""
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(criterion).alias("criterion"), F.coalesce(ok, F.lit(False)).alias("ok")) for name, criterion, ok in checks])
    told = df.select(F.col(key).alias("__key"), F.explode(rows).alias("c")).select("__key", "c.*")
    score = told.groupBy("check_name", "criterion").agg(F.count("*").alias("total"), F.count_if("ok").alias("passed"))
    bad = told.where("not ok").withColumn("rn", F.row_number().over(W.partitionBy("check_name").orderBy("__key"))).where("rn <= 5").groupBy("check_name").agg(F.array_sort(F.collect_list("__key")).alias("examples"))
    return score.join(bad, "check_name", "left").select("check_name", "criterion", "total", "passed", ratio(F.col("passed").cast("double"), F.col("total")).alias("score"), F.coalesce("examples", F.array().cast("array<bigint>")).alias("examples"))


def verdict(scores: DataFrame, block: float = 0.5, warn: float = 0.9, weight: float = 0.2) -> DataFrame:
    """criterion, mean, weighted, verdict of a criterion: BLOCK below block, WARN below warn, else PASS."""
    m = scores.groupBy("criterion").agg(F.avg("score").alias("mean"), F.min("score").alias("least"))
    return m.select("criterion", F.bround("mean", 4).alias("mean"), F.bround(F.col("mean") * weight, 4).alias("weighted"), F.when(F.col("least") < block, "BLOCK").when(F.col("least") < warn, "WARN").otherwise("PASS").alias("verdict"))


def histogram(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def line_metrics(text: Column) -> dict[str, Column]:
    """Of a Markdown text: lines, table lines, separators, tables (blocks of table lines), headings, glued cells, footnotes."""
    lines = F.split(text, "\n")
    is_row = lambda x: F.trim(x).startswith("|")
    count = lambda f: F.size(F.filter(lines, f))
    starts = F.size(F.filter(F.transform(lines, lambda x, k: is_row(x) & ((k == 0) | ~is_row(F.get(lines, k - 1)))), lambda b: b))
    return {
        "n_lines": F.size(lines), "table_lines": count(is_row), "separators": count(lambda x: x.rlike(r"^\s*\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)*\|?\s*$")), "tables": starts, "headings": count(lambda x: x.rlike(r"^#{1,6} ")),
        "glued": F.size(F.regexp_extract_all(text, F.lit(r"\p{Ll}\p{Lu}|\p{Ll}\d{3,}"), F.lit(0))), "footnotes": F.size(F.regexp_extract_all(text, F.lit(r"\[\^?\d+\]|\*{1,2}\)"), F.lit(0))),
    }


def graph_summary(objects: DataFrame, by: str = "company_id") -> DataFrame:
    """by, objects, products, distributors, files, last_upload of a company's objects in the graph: sums of list sizes, and the last date of any of four fields, as text.

    Suppliers count as distributors; a list that is null counts as empty, an empty date as none.
    """
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    size = lambda c: F.when(F.col(c).isNull(), F.lit(0).cast("long")).otherwise(n(c))
    dates = F.greatest(*[F.nullif(F.col(c), F.lit("")) for c in ("verification_date", "report_date", "valid_on_date", "date")])
    return objects.groupBy(by).agg(F.count("*").alias("objects"), F.sum(size("products")).alias("products"), F.sum(size("suppliers") + size("distributors")).alias("distributors"), F.sum(size("files")).alias("files"), F.max(dates).alias("last_upload"))
