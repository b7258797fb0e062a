"""Quality of crawls, pages and companies: thresholds M1-M8, run metrics and alerts, census, filter release, page needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.metrics import alerts, ratio

# Green and red limits of the eight measures; a measure is better high (+) or low (-).
LIMITS = {"M1": ("+", 0.35, 0.15), "M2": ("+", 8, 2), "M3": ("+", 0.95, 0.7), "M4": ("-", 0.05, 0.3), "M5": ("+", 0.9, 0.5), "M6": ("-", 0.02, 0.1), "M7": ("+", 0.9, 0.5), "M8": ("-", 0.15, 0.4)}
#: Error codes of failing checks.
CODES = {"C3.1": "E1", "C2.1": "E5", "C2.2": "E5", "C1.1": "E5", "C4.1": "E3", "C5.3": "E3", "C3.3": "E7", "C3.12": "E7", "C5.6": "E8", "C2.9": "E8", "C2.7": "E6"}


def company_measures(pages: DataFrame, by: str = "company") -> DataFrame:
    """M1 to M7 of page records: medians of shares and lines, and ratios of sums (null where the lower sum is 0)."""
    n = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False))).cast("double")
    s = lambda c: F.sum(c).cast("double")
    return pages.groupBy(by).agg(
        F.bround(F.percentile("container_share", 0.5), 4).alias("M1"), F.percentile("spec_lines", 0.5).alias("M2"), ratio(F.count_if(F.col("has_table_html") & F.col("has_table_md")).cast("double"), n("has_table_html")).alias("M3"), ratio(n("short_md"), F.count("*")).alias("M4"),
        ratio(s("tab_panels_covered"), s("tab_panels")).alias("M5"), ratio(s("cells_glued"), s("cells_total")).alias("M6"), ratio(s("tables_footnoted"), s("tables_marked")).alias("M7"),
    )


def light(name: str, value: Column) -> Column:
    """ok, warn or red by the limits of a measure; null for null."""
    sign, good, bad = LIMITS[name]
    if sign == "+":
        poor = value <= bad if name == "M2" else value < bad  # M2 counts lines: two are too few
        return F.when(value.isNull(), None).when(value >= good, "ok").when(poor, "red").otherwise("warn")
    return F.when(value.isNull(), None).when(value <= good, "ok").when(value > bad, "red").otherwise("warn")


def share_slices(pages: DataFrame) -> DataFrame:
    """slice, pages, below_0_3, below_0_1: of all pages with a share, and of those with 1000 characters or more."""
    known = pages.where("container_share is not null")
    told = known.withColumn("slice", F.explode(F.array_compact(F.array(F.lit("all_pages"), F.when(F.col("body_text_len") >= 1000, "body_text_ge_1000")))))
    return told.groupBy("slice").agg(F.count("*").alias("pages"), ratio(F.count_if(F.col("container_share") < 0.3).cast("double"), F.count("*")).alias("below_0_3"), ratio(F.count_if(F.col("container_share") < 0.1).cast("double"), F.count("*")).alias("below_0_1"))


def run_metrics(fetches: DataFrame) -> DataFrame:
    """Counters and rates of a run by domain and run: fetches, failures, challenges, empty texts, cards, counts by category and method."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    rate = lambda c: ratio(n(c).cast("double"), F.count("*"))
    base = fetches.groupBy("domain", "run").agg(F.count("*").alias("pages"), n(F.col("ok")).alias("pages_ok"), rate(~F.col("ok")).alias("fetch_fail_rate"), rate(F.col("challenge")).alias("challenge_rate"), rate(F.col("md_len") == 0).alias("empty_markdown_rate"), n(F.col("is_card")).alias("product_cards"))
    maps = base
    for c in ("category", "method"):
        counts = fetches.where(F.col(c).isNotNull()).groupBy("domain", "run", c).agg(F.count("*").alias("n")).groupBy("domain", "run").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(f"by_{c}"))
        maps = maps.join(counts, ["domain", "run"], "left")
    return maps


def run_alerts(m: DataFrame) -> DataFrame:
    """domain, run, alert: one row for each threshold that a run breaks. Thresholds on columns that m lacks are passed over; baseline_ columns are null where a site has no baseline."""
    c = F.col
    worse = lambda now, base: (c(base) > 0) & (c(now) < c(base) * 0.6)
    none = lambda k: F.coalesce(F.try_element_at("by_category", F.lit(k)), F.lit(0)) == 0
    rules = [
        (["product_cards", "baseline_cards"], lambda: worse("product_cards", "baseline_cards"), "product_cards below baseline"),
        (["pages", "baseline_pages"], lambda: worse("pages", "baseline_pages"), "pages below baseline"),
        (["sitemap_urls", "baseline_sitemap"], lambda: (c("baseline_sitemap") > 0) & (F.abs(c("sitemap_urls") - c("baseline_sitemap")) / c("baseline_sitemap") > 0.3), "sitemap differs from baseline"),
        (["challenge_rate"], lambda: (c("challenge_rate") > 0.2) & (F.coalesce(c("baseline_challenge") if "baseline_challenge" in m.columns else F.lit(0), F.lit(0)) == 0), "challenge_rate > 0.2"),
        (["fetch_fail_rate"], lambda: c("fetch_fail_rate") > 0.15, "fetch_fail_rate > 0.15"),
        (["empty_markdown_rate"], lambda: c("empty_markdown_rate") > 0.3, "empty_markdown_rate > 0.3"),
        (["gate3_pass_rate"], lambda: c("gate3_pass_rate") < 0.5, "gate3_pass_rate < 0.5"),
        (["card_yield", "product_pages"], lambda: (c("product_pages") > 0) & (c("card_yield") < 0.35), "card_yield < 0.35"),
        (["avg_specs"], lambda: c("avg_specs") < 5, "avg_specs_per_card < 5"),
        (["structure_hash", "baseline_structure"], lambda: (c("baseline_structure") != "") & (c("structure_hash") != "") & (c("structure_hash") != c("baseline_structure")), "structure_hash changed"),
        (["by_category"], lambda: none("contacts"), "no contacts pages"),
        (["by_category"], lambda: none("distributor"), "no distributor pages"),
        (["links_found", "links_outside"], lambda: (c("links_found") > 0) & (c("links_outside") / c("links_found") > 0.8), "perimeter dropped over 80 % of links"),
        (["sitemap_filtered", "sitemap_queued"], lambda: (c("sitemap_filtered") > 0) & (F.coalesce(c("sitemap_queued"), F.lit(0)) == 0), "nothing queued from sitemap"),
        (["sitemap_offered", "sitemap_dup_rate"], lambda: (c("sitemap_offered") > 0) & (c("sitemap_dup_rate") > 0.8), "sitemap_dup_skip_rate > 0.8"),
        (["sitemap_offered", "sitemap_empty_rate"], lambda: (c("sitemap_offered") > 0) & (c("sitemap_empty_rate") > 0.8), "sitemap_no_content_rate > 0.8"),
    ]
    found = alerts([(rule(), name) for needs, rule, name in rules if set(needs) <= set(m.columns)])
    return m.select("domain", "run", F.explode(found).alias("alert"))


def render_mode(methods: Column) -> Column:
    """browser if most fetches were made by one, html if not, null without any. methods: map of method to count."""
    total = lambda names: sum((F.coalesce(F.try_element_at(methods, F.lit(n)), F.lit(0)) for n in names), F.lit(0))
    http, browser = total(["http_first", "aiohttp"]), total(["playwright", "dynamic", "ajax_tabs"])
    return F.when(http + browser == 0, None).when(browser > http, "browser").otherwise("html")


def antibot(challenge_rate: Column, pages: Column, warmed: Column) -> Column:
    r = F.coalesce(challenge_rate, F.lit(0.0))
    return F.when((r > 0.5) & (F.coalesce(pages, F.lit(0)) == 0), "blocked").when(F.coalesce(warmed, F.lit(False)), "warmup").when(r > 0.05, "impersonate").otherwise("none")


def census(pages: Column, cards: Column, found: Column, fail_rate: Column, challenge_rate: Column, render: Column, antibot: Column, alerts: Column) -> Column:
    """struct<status, group, can_deliver, problems, fixes> of a site by its last run: what became of it, who has to mend it, and how."""
    n = lambda c: F.coalesce(c, F.lit(0))
    pages, cards, found, fail_rate, challenge_rate = map(n, (pages, cards, found, fail_rate, challenge_rate))
    guarded = F.coalesce(~antibot.isin("none", ""), F.lit(False))
    noisy = (cards > 0) & (found > cards * 3)
    say = F.format_string
    rules = [
        (guarded | (challenge_rate > 0.2), F.concat(F.lit("антибот-защита (challenge_rate="), challenge_rate.cast("string"), F.lit(")")), F.lit("профиль: antibot=impersonate/warmup (обход curl_cffi+прогрев)")),
        (pages <= 3, F.concat(F.lit("краулер собрал "), pages.cast("string"), F.lit(" стр. (SPA/JS-рендер или блокировка)")), F.lit("профиль: render=browser (принудительный Playwright)")),
        ((pages > 3) & F.coalesce(render == "browser", F.lit(False)) & (fail_rate > 0.3), F.concat(F.lit("высокая доля сбоев фетча ("), fail_rate.cast("string"), F.lit(")")), F.lit("профиль: render=browser + пер-хостовые задержки (load.page_delay_ms)")),
        ((found > 0) & (cards == 0), F.concat(found.cast("string"), F.lit(" товарных стр. найдено, 0 карточек (LLM классифицирует как не-товар / нет ТХ)")), F.lit("REVIEW: проверить product_url_antipatterns и полноту markdown (возможно ТХ в AJAX-вкладках -> ajax_tabs)")),
        (noisy, say("категоризация URL шумит: %s «товарных» стр. -> %s карточек", found.cast("string"), cards.cast("string")), F.lit("профиль: product_url_antipatterns по census_evidence.top_urls")),
    ]
    sections = F.filter(F.coalesce(alerts, F.array().cast("array<string>")), lambda a: a.contains("секция"))
    advice = F.lit("профиль: заполнить contacts_urls/distributor_urls (страница есть, но не распознана) либо подтвердить отсутствие раздела")
    problems = F.concat(F.array_compact(F.array(*[F.when(c, p) for c, p, _ in rules])), sections)
    fixes = F.array_distinct(F.concat(F.array_compact(F.array(*[F.when(c, f) for c, _, f in rules])), F.transform(sections, lambda _: advice)))
    status = F.when(pages == 0, "Сайт недоступен").when(cards == 0, "Обработан, карточки НЕ получены").otherwise("Обработан, карточки получены")
    group = (
        F.when(pages == 0, "Краулер/доступность").when((cards == 0) & (pages <= 3), "SPA/JS").when((cards == 0) & guarded, "Антибот").when(cards == 0, "Извлечение")
        .when(noisy, "Категоризация URL").when(guarded, "Антибот").otherwise("—")
    )
    deliver = F.when(cards == 0, "Нет").when(F.size(problems) == 0, "Да").otherwise("Да, с оговорками")
    shown = lambda a: F.when(F.size(a) == 0, "—").otherwise(F.array_join(a, "; "))
    return F.struct(status.alias("status"), group.alias("group"), deliver.alias("can_deliver"), shown(problems).alias("problems"), shown(fixes).alias("fixes"))


def released_filters(urls: DataFrame, site: str, category: str, least: int = 20, share: float = 0.8, most: int = 500) -> DataFrame:
    """site, release, kind, urls: sites whose language or word filter drops at least share of least URLs or more, with the first `most` dropped URLs by ord."""
    n = urls.groupBy(site).agg(F.count("*").alias("__n"), F.count_if(F.col(category) == "excluded").alias("language"), F.count_if(F.col(category) == "excluded2").alias("words"))
    hit = n.where(F.col("__n") >= least).select(site, F.explode(F.array_compact(F.array(*[F.when(F.col(k) / F.col("__n") >= share, F.struct(F.lit(k).alias("kind"), F.lit(c).alias("c"))) for k, c in (("language", "excluded"), ("words", "excluded2"))]))).alias("r")).select(site, "r.*")
    from pyspark.sql import Window as W

    dropped = urls.withColumn("c", F.col(category)).join(hit, [site, "c"])
    return dropped.withColumn("__k", F.row_number().over(W.partitionBy(site, "kind").orderBy("ord"))).where(F.col("__k") <= most).drop("__k", "c")


def filter_shares(urls: DataFrame, site: str, category: str) -> DataFrame:
    share = lambda c: ratio(F.count_if(F.col(category) == c).cast("double"), F.count("*"), 3)
    return urls.groupBy(site).agg(F.count("*").alias("urls"), share("excluded2").alias("word_share"), share("excluded").alias("language_share"))


def crawl_status(left: DataFrame) -> DataFrame:
    """site, status, reasons: failed without usable pages, partial with a reason to stop, else complete. left: usable, total, max_pages, queue, pending_products, pending_map, depth_limited, fetch_failures (counts)."""
    pending = (F.col("queue") > 0) | (F.col("pending_map") > 0) | (F.col("pending_products") > 0)
    reasons = alerts([((F.col("total") >= F.col("max_pages")) & pending, "page_limit"), (F.col("pending_products") > 0, "product_limit"), (F.col("pending_map") > 0, "sitemap_limit"), (F.col("depth_limited") > 0, "depth_limit"), (F.col("fetch_failures") > 0, "fetch_failures"), (F.col("usable") == 0, "no_content")])
    reasons = F.when((F.size(reasons) == 0) & (F.col("queue") > 0), F.array(F.lit("remaining_queue"))).otherwise(reasons)
    return left.select("site", F.when(F.col("usable") == 0, "failed").when(F.size(reasons) > 0, "partial").otherwise("complete").alias("status"), reasons.alias("reasons"))


def needs_browser(text_len: Column, has_island: Column, spa_root_len: Column, bundles: Column) -> Column:
    """Whether a page is drawn by scripts: hardly any text, or little with an empty application root or bundles; not if its data is there."""
    empty_root = spa_root_len.isNotNull() & (spa_root_len < 50)
    return F.when(F.coalesce(has_island, F.lit(False)), False).otherwise((text_len < 50) | ((text_len < 300) & (empty_root | (bundles >= 1))))


def is_shell(text_len: Column, has_island: Column) -> Column:
    return ~F.coalesce(has_island, F.lit(False)) & (text_len < 1000)


def code_hits(checks: DataFrame) -> DataFrame:
    """code, hits: failing checks (check_name, passed, examples) by error code, each as often as it has examples, once at least."""
    code = F.try_element_at(F.create_map(*[x for k, v in CODES.items() for x in (F.lit(k), F.lit(v))]), F.col("check_name"))
    return checks.where(~F.col("passed")).select(code.alias("code"), F.greatest(F.lit(1), F.size("examples")).alias("n")).where("code is not null").groupBy("code").agg(F.sum("n").alias("hits"))


def llm_stats(requests: DataFrame, at: Column, seconds: int = 300) -> DataFrame:
    """Requests of the last seconds before a time: n, success_rate, mean_seconds, tokens_per_minute."""
    last = requests.where((F.unix_seconds(at) - F.unix_seconds(F.col("ended").cast("timestamp")) < seconds) & (F.col("ended").cast("timestamp") <= at))
    return last.agg(F.count("*").alias("n"), F.avg(F.col("success").cast("int")).alias("success_rate"), F.avg("seconds").alias("mean_seconds"), (F.coalesce(F.sum("tokens"), F.lit(0)) / (seconds / 60)).alias("tokens_per_minute"))


def advice(stats: DataFrame) -> DataFrame:
    return stats.select(F.explode(alerts([(F.col("mean_seconds") > 10, "raise timeouts"), (F.col("success_rate") < 0.95, "check the connection"), (F.col("tokens_per_minute") > 50000, "quota may run out")])).alias("advice"))


def recent_errors(records: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Errors and failed records of the last hours; records without a time don't count."""
    own = records.where(F.unix_seconds(now) - F.unix_seconds(F.col("ts").cast("timestamp")) <= hours * 3600)
    return own.agg(F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("errors"), F.count_if(F.col("status") != "success").alias("failed"))


def category_counts(pages: DataFrame, site: str, category: str) -> DataFrame:
    names = ["product", "category", "price_list", "main_page", "contacts", "distributor", "other"]
    return pages.groupBy(site).agg(*[F.count_if(F.col(category) == n).alias(n) for n in names])


def documents_by_group(files: DataFrame, groups: list[str]) -> DataFrame:
    """group, n: files by group, groups without files too."""
    return files.sparkSession.createDataFrame([(g,) for g in groups], "`group` string").join(files.groupBy("group").agg(F.count("*").alias("n")), "group", "left").select("group", F.coalesce("n", F.lit(0)).alias("n"))


def archive_stats(manifest: DataFrame) -> DataFrame:
    """kind, company, files, bytes of payload files named kind_company_…: by both, by kind, and in all."""
    parts = F.split("name", "_")
    told = manifest.select(parts[0].alias("kind"), F.get(parts, 1).alias("company"), "size")
    return told.rollup("kind", "company").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.grouping_id().alias("level"))
