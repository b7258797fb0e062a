"""Queries on quality measures, product gates and reports, over records derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import catalog, dedupe, metrics, quality, ranking
from plumbline.plans.registry import query

_PAGES = """SELECT source AS company, doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE (n_chars % 100) / 100.0 END AS container_share, n_chars % 20 AS spec_lines, doc_id % 3 = 0 AS has_table_html, doc_id % 6 = 0 AS has_table_md, n_chars < 500 AS short_md,
 doc_id % 4 AS tab_panels, doc_id % 2 AS tab_panels_covered, n_chars % 50 AS cells_total, n_chars % 5 AS cells_glued, doc_id % 7 AS tables_marked, doc_id % 3 AS tables_footnoted, n_chars AS body_text_len FROM documents"""


def _records(t):
    return t("documents").selectExpr(
        "source as company", "doc_id", "case when doc_id % 10 <> 0 then (n_chars % 100) / 100.0D end as container_share", "n_chars % 20 as spec_lines", "doc_id % 3 = 0 as has_table_html", "doc_id % 6 = 0 as has_table_md", "n_chars < 500 as short_md",
        "doc_id % 4 as tab_panels", "doc_id % 2 as tab_panels_covered", "n_chars % 50 as cells_total", "n_chars % 5 as cells_glued", "doc_id % 7 as tables_marked", "doc_id % 3 as tables_footnoted", "n_chars as body_text_len",
    )


def _r(a, b):
    return f"round_even(CASE WHEN {b} <> 0 THEN ({a})::DOUBLE / {b} END, 4)"


_MEASURES = f"""SELECT company, round_even(quantile_cont(container_share::DOUBLE, 0.5), 4) AS "M1", quantile_cont(spec_lines::DOUBLE, 0.5) AS "M2", {_r('count(*) FILTER (has_table_html AND has_table_md)', 'count(*) FILTER (has_table_html)')} AS "M3", {_r('count(*) FILTER (short_md)', 'count(*)')} AS "M4",
 {_r('sum(tab_panels_covered)', 'sum(tab_panels)')} AS "M5", {_r('sum(cells_glued)', 'sum(cells_total)')} AS "M6", {_r('sum(tables_footnoted)', 'sum(tables_marked)')} AS "M7" FROM ({_PAGES}) GROUP BY company"""


@query(_MEASURES)
def company_measures(t):
    return quality.company_measures(_records(t))


#: What is good and what is red, by hand from the definition of the measures.
_LIGHTS = {"M1": (">= 0.35", "< 0.15"), "M2": (">= 8", "<= 2"), "M3": (">= 0.95", "< 0.7"), "M4": ("<= 0.05", "> 0.3"), "M5": (">= 0.9", "< 0.5"), "M6": ("<= 0.02", "> 0.1"), "M7": (">= 0.9", "< 0.5")}


@query("SELECT company, " + ", ".join(f"""CASE WHEN "{m}" IS NULL THEN NULL WHEN "{m}" {good} THEN 'ok' WHEN "{m}" {bad} THEN 'red' ELSE 'warn' END AS l{m[1]}""" for m, (good, bad) in _LIGHTS.items()) + f" FROM ({_MEASURES})")
def measure_lights(t):
    m = quality.company_measures(_records(t))
    return m.select("company", *[quality.light(k, F.col(k)).alias(f"l{k[1]}") for k in _LIGHTS])


@query(f"""WITH p AS (SELECT * FROM ({_PAGES}) WHERE container_share IS NOT NULL), s AS (SELECT 'all_pages' AS slice, * FROM p UNION ALL SELECT 'body_text_ge_1000', * FROM p WHERE body_text_len >= 1000)
SELECT slice, count(*) AS pages, {_r('count(*) FILTER (container_share < 0.3)', 'count(*)')} AS below_0_3, {_r('count(*) FILTER (container_share < 0.1)', 'count(*)')} AS below_0_1 FROM s GROUP BY 1""")
def share_slices(t):
    return quality.share_slices(_records(t))


_FETCH = "SELECT user_id % 20 AS domain, event_id % 2 AS run, event_type <> 'error' AS ok, event_type = 'error' AND event_id % 3 = 0 AS challenge, event_id % 5 AS md_len, event_type = 'purchase' AS is_card, CASE event_type WHEN 'purchase' THEN 'product' WHEN 'signup' THEN 'contacts' WHEN 'view' THEN 'other' END AS category, CASE WHEN event_id % 4 = 0 THEN 'playwright' ELSE 'aiohttp' END AS method FROM events"


def _fetches(t):
    return t("events").selectExpr("user_id % 20 as domain", "event_id % 2 as run", "event_type <> 'error' as ok", "event_type = 'error' and event_id % 3 = 0 as challenge", "event_id % 5 as md_len", "event_type = 'purchase' as is_card", "case event_type when 'purchase' then 'product' when 'signup' then 'contacts' when 'view' then 'other' end as category", "case when event_id % 4 = 0 then 'playwright' else 'aiohttp' end as method")


@query(f"""SELECT domain, run, count(*) AS pages, count(*) FILTER (ok) AS pages_ok, {_r('count(*) FILTER (NOT ok)', 'count(*)')} AS fetch_fail_rate, {_r('count(*) FILTER (challenge)', 'count(*)')} AS challenge_rate, {_r('count(*) FILTER (md_len = 0)', 'count(*)')} AS empty_markdown_rate, count(*) FILTER (is_card) AS product_cards,
 count(*) FILTER (category = 'contacts') AS contacts, count(*) FILTER (method = 'playwright') AS playwright FROM ({_FETCH}) GROUP BY 1, 2""")
def run_metrics(t):
    m = quality.run_metrics(_fetches(t))
    n = lambda c, k: F.coalesce(F.try_element_at(f"by_{c}", F.lit(k)), F.lit(0)).alias(k)
    return m.drop("by_category", "by_method").select("*").join(m.select("domain", "run", n("category", "contacts"), n("method", "playwright")), ["domain", "run"])


@query(f"""WITH m AS (SELECT domain, run, count(*) AS pages, {_r('count(*) FILTER (NOT ok)', 'count(*)')} AS f, {_r('count(*) FILTER (challenge)', 'count(*)')} AS c, {_r('count(*) FILTER (md_len = 0)', 'count(*)')} AS e, count(*) FILTER (is_card) AS cards, count(*) FILTER (category = 'contacts') AS contacts FROM ({_FETCH}) GROUP BY 1, 2)
SELECT domain, run, a AS alert FROM (SELECT domain, run, unnest(list_filter([CASE WHEN cards < 150 * 0.6 THEN 'product_cards below baseline' END, CASE WHEN pages < 400 * 0.6 THEN 'pages below baseline' END, CASE WHEN c > 0.2 THEN 'challenge_rate > 0.2' END, CASE WHEN f > 0.15 THEN 'fetch_fail_rate > 0.15' END,
 CASE WHEN e > 0.3 THEN 'empty_markdown_rate > 0.3' END, CASE WHEN contacts = 0 THEN 'no contacts pages' END, 'no distributor pages'], lambda x: x IS NOT NULL)) AS a FROM m)""")
def run_alerts(t):
    m = quality.run_metrics(_fetches(t)).withColumn("baseline_cards", F.lit(150)).withColumn("baseline_pages", F.lit(400))
    return quality.run_alerts(m)


_URLS = "SELECT user_id % 30 AS site, event_id AS ord, CASE WHEN user_id % 30 < 5 AND event_id % 10 <> 0 THEN 'excluded2' WHEN user_id % 30 = 7 AND event_id % 10 <> 1 THEN 'excluded' ELSE 'product' END AS category FROM events"


def _urls(t):
    return t("events").selectExpr("user_id % 30 as site", "event_id as ord", "case when user_id % 30 < 5 and event_id % 10 <> 0 then 'excluded2' when user_id % 30 = 7 and event_id % 10 <> 1 then 'excluded' else 'product' end as category")


@query(f"""WITH u AS ({_URLS}), n AS (SELECT site, count(*) AS n, count(*) FILTER (category = 'excluded') AS l, count(*) FILTER (category = 'excluded2') AS w FROM u GROUP BY 1), h AS (SELECT site, 'language' AS kind, 'excluded' AS c FROM n WHERE n >= 20 AND l / n >= 0.8 UNION ALL SELECT site, 'words', 'excluded2' FROM n WHERE n >= 20 AND w / n >= 0.8)
SELECT site, kind, ord FROM (SELECT u.site, kind, ord, row_number() OVER (PARTITION BY u.site, kind ORDER BY ord) AS k FROM u JOIN h ON u.site = h.site AND u.category = h.c) WHERE k <= 500""")
def released_filters(t):
    return quality.released_filters(_urls(t), "site", "category").select("site", "kind", "ord")


@query(f"SELECT site, count(*) AS urls, round_even(count(*) FILTER (category = 'excluded2')::DOUBLE / count(*), 3) AS word_share, round_even(count(*) FILTER (category = 'excluded')::DOUBLE / count(*), 3) AS language_share FROM ({_URLS}) GROUP BY 1")
def filter_shares(t):
    return quality.filter_shares(_urls(t), "site", "category")


@query("""WITH l AS (SELECT o_orderkey AS site, o_orderkey % 5 AS usable, o_orderkey % 50 AS total, 40 AS max_pages, o_orderkey % 3 AS queue, o_orderkey % 2 AS pending_products, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS pending_map FROM orders),
r AS (SELECT *, list_filter([CASE WHEN total >= max_pages AND (queue > 0 OR pending_map > 0 OR pending_products > 0) THEN 'page_limit' END, CASE WHEN pending_products > 0 THEN 'product_limit' END, CASE WHEN pending_map > 0 THEN 'sitemap_limit' END, CASE WHEN usable = 0 THEN 'no_content' END], lambda x: x IS NOT NULL) AS a FROM l),
b AS (SELECT *, CASE WHEN len(a) = 0 AND queue > 0 THEN ['remaining_queue'] ELSE a END AS reasons FROM r) SELECT site, CASE WHEN usable = 0 THEN 'failed' WHEN len(reasons) > 0 THEN 'partial' ELSE 'complete' END AS status, reasons FROM b""")
def crawl_status(t):
    left = t("orders").selectExpr("o_orderkey as site", "o_orderkey % 5 as usable", "o_orderkey % 50 as total", "40 as max_pages", "o_orderkey % 3 as queue", "o_orderkey % 2 as pending_products", "case when o_orderkey % 7 = 0 then 1 else 0 end as pending_map", "0 as depth_limited", "0 as fetch_failures")
    return quality.crawl_status(left)


@query("""SELECT kind, company, count(*) AS files, sum(size)::BIGINT AS bytes, grouping(kind, company)::INT AS level FROM (SELECT event_type AS kind, (user_id % 10)::VARCHAR AS company, event_id AS size FROM events) GROUP BY ROLLUP (kind, company)""")
def archive_stats(t):
    m = t("events").select(F.concat_ws("_", "event_type", (F.col("user_id") % 10).cast("string"), F.lit("x.json")).alias("name"), F.col("event_id").alias("size"))
    return quality.archive_stats(m).withColumn("level", F.col("level").cast("int"))


@query("""SELECT count(*) AS n, avg((event_type <> 'error')::INT) AS success_rate, avg(value) AS mean_seconds, coalesce(sum(event_id % 1000), 0) / 5.0 AS tokens_per_minute FROM events WHERE epoch(TIMESTAMP '2024-01-15 12:00:00') - floor(epoch(ts)) < 300 AND ts <= TIMESTAMP '2024-01-15 12:00:00'""")
def llm_window_stats(t):
    r = t("events").select(F.col("ts").alias("ended"), (F.col("event_type") != "error").alias("success"), F.col("value").alias("seconds"), (F.col("event_id") % 1000).alias("tokens"))
    return quality.llm_stats(r, F.lit("2024-01-15 12:00:00").cast("timestamp"))


@query("SELECT user_id % 10 AS site, " + ", ".join(f"count(*) FILTER (event_type = '{a}') AS {b}" for a, b in [("purchase", "product"), ("click", "category"), ("view", "price_list"), ("-", "main_page"), ("signup", "contacts"), ("-", "distributor"), ("error", "other")]) + " FROM events GROUP BY 1")
def category_counts(t):
    names = F.create_map(*[F.lit(x) for p in [("purchase", "product"), ("click", "category"), ("view", "price_list"), ("signup", "contacts"), ("error", "other")] for x in p])
    return quality.category_counts(t("events").select((F.col("user_id") % 10).alias("site"), F.element_at(names, F.col("event_type")).alias("category")), "site", "category")


def _stub(markdown):
    """An offline extractor: a page's heading as name, its numbers as specifications."""
    name = F.regexp_extract(markdown, r"(?m)^# (.*)$", 1)
    numbers = F.slice(F.regexp_extract_all(markdown, F.lit(r"\d+"), F.lit(0)), 1, 9)
    specs = F.to_json(F.map_from_entries(F.transform(numbers, lambda x, k: F.struct(F.concat(F.lit("n"), k.cast("string")), x))))
    return F.when(name == "", '{"error": "Trash_418#"}').otherwise(F.concat(F.lit('```json\n{"name": "'), F.regexp_replace(name, r'["\\]', ""), F.lit('", "specifications": '), specs, F.lit(",}\n```")))


def _product_pages(t):
    return t("documents").select(F.col("doc_id").alias("page_id"), F.col("source").alias("company"), F.lit("").alias("url"), F.concat(F.lit("# "), F.element_at(F.split("text", "\n"), 1), F.lit("\n"), "text").alias("markdown"), F.lit("other").alias("category"))


@query()
def product_gates(t):
    cards = catalog.product_cards(_product_pages(t), _stub, ["the"])
    return metrics.histogram(cards, F.coalesce("drop_reason", F.lit("kept")), "outcome")


@query()
def second_pass_pages(t):
    pages = _product_pages(t)
    return catalog.second_pass(pages, catalog.product_cards(pages, _stub, [])).select("company", "page_id")


@query("""SELECT p_brand AS brand, CASE WHEN min(p_retailprice) = max(p_retailprice) THEN regexp_replace(printf('%.2f', min(p_retailprice)), '\\.?0+$', '') ELSE 'от ' || regexp_replace(printf('%.2f', min(p_retailprice)), '\\.?0+$', '') || ' до ' || regexp_replace(printf('%.2f', max(p_retailprice)), '\\.?0+$', '') END AS text FROM part GROUP BY 1""")
def price_ranges(t):
    return catalog.price_range(t("part").withColumnRenamed("p_brand", "brand"), "brand", "p_retailprice")


@query("""WITH f AS (SELECT l_orderkey AS folder, 'f' || l_linenumber AS stem, CASE l_returnflag WHEN 'R' THEN '.pdf' WHEN 'A' THEN '.docx' ELSE '.tmp' END AS ext FROM lineitem), p AS (SELECT DISTINCT folder, stem FROM f WHERE ext = '.pdf')
SELECT folder, stem || ext AS name FROM f WHERE ext = '.pdf' UNION ALL SELECT f.folder, f.stem || ext FROM f LEFT JOIN p ON f.folder = p.folder AND f.stem = p.stem WHERE ext = '.docx' AND p.stem IS NULL""")
def files_to_ship(t):
    f = t("lineitem").select(F.col("l_orderkey").alias("folder"), F.concat(F.lit("f"), "l_linenumber", F.expr("case l_returnflag when 'R' then '.pdf' when 'A' then '.docx' else '.tmp' end")).alias("name"))
    return catalog.files_to_ship(f, [".pdf"], [".docx", ".rtf"], ["secret"])


@query("""SELECT n_name AS company, w AS website, s_name AS product FROM (SELECT n_nationkey, n_name, unnest(CASE WHEN n_nationkey % 2 = 0 THEN ['a', 'b'] ELSE ['a'] END) AS w FROM nation) LEFT JOIN supplier ON s_nationkey = n_nationkey""")
def summary_rows(t):
    s = t("supplier").groupBy("s_nationkey").agg(F.collect_list("s_name").alias("products"))
    c = t("nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(F.col("n_name").alias("company"), F.expr("case when n_nationkey % 2 = 0 then array('a', 'b') else array('a') end").alias("websites"), "products")
    return catalog.summary_rows(c)


@query("""SELECT l_orderkey AS t, l_linenumber AS col, string_agg(DISTINCT l_returnflag, ' / ' ORDER BY l_returnflag) AS header FROM lineitem GROUP BY 1, 2""")
def header_paths(t):
    cells = t("lineitem").select(F.col("l_orderkey").alias("t"), F.col("l_linenumber").alias("col"), F.col("l_returnflag").alias("text"), F.ascii("l_returnflag").alias("row"), F.lit(True).alias("header"))
    return catalog.header_paths(cells, ["t"])


@query("""SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey::VARCHAR) AS n, o_custkey AS company_id, o_orderkey::VARCHAR AS child_id FROM orders WHERE o_orderstatus <> 'O'""")
def detailed_report(t):
    ch = t("orders").select(F.col("o_custkey").alias("company_id"), F.lit("c").alias("company"), F.lit("product").alias("kind"), F.col("o_orderkey").cast("string").alias("child_id"), F.lit("x").alias("child"), F.lit("").alias("was"), F.lit("").alias("became"), F.when(F.col("o_orderstatus") != "O", "EDITING").otherwise("NO_CHANGES").alias("status"), F.lit("").alias("source"), F.lit("").alias("path"))
    r = catalog.detailed_report(ch)
    return r.select(F.col(f"`{catalog.DETAILED[0]}`").alias("n"), F.col(f"`{catalog.DETAILED[1]}`").alias("company_id"), F.col(f"`{catalog.DETAILED[5]}`").alias("child_id"))


@query("""WITH f AS (SELECT s_nationkey AS family, s_suppkey, s_suppkey % 9 = 0 AS g FROM supplier), n AS (SELECT family, bool_or(g) AS any_g, count(*) AS k FROM f GROUP BY 1) SELECT s_suppkey, CASE WHEN k = 1 THEN true WHEN any_g THEN g ELSE true END AS kept FROM f JOIN n USING (family)""")
def size_variants(t):
    s = t("supplier").select("s_suppkey", F.concat(F.lit("/d/"), "s_nationkey").alias("dir"), F.col("s_name").alias("slug"), (F.col("s_suppkey") % 9 == 0).alias("is_general"))
    return dedupe.size_variants(s).select("s_suppkey", "kept")


@query("""SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey)::INT AS turn FROM orders""")
def interleaved_queue(t):
    return ranking.interleaved(t("orders"), "o_orderstatus", ["o_orderkey"]).select("o_custkey", "o_orderkey", "turn")


_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1))"


@query(f"SELECT page_id, regexp_replace(regexp_replace({_HOST}, '^www\\.', ''), '^(m|mobile|touch)\\.', '') = 'tionsh.example.net' OR regexp_matches({_HOST}, '(^|\\.)example\\.org$') AS in_scope FROM pages")
def url_scope(t):
    from plumbline.operators import sites

    return sites.in_scope(t("pages").select("page_id", "url"), "www.tionsh.example.net", suffixes=["example.org"]).select("page_id", "in_scope")


@query()
def canonical_urls(t):
    from plumbline.operators import sites

    return sites.canonical_urls(t("pages"), "page_id", "url", "html")


@query()
def sitemap_admission(t):
    from plumbline.functions import urls as U
    from plumbline.operators import sites

    p = t("pages").select("page_id", "url", U.registrable_domain(U.Url(F.col("url")).host).alias("site"), F.lit(9).alias("priority"))
    return sites.sitemap_admission(p, 20).select("page_id", "site", "rank", "admitted")


@query(f"""WITH p AS (SELECT page_id, page_id % 3 AS map_id, page_id AS pos, page_id % 7 AS priority, {_HOST} AS h FROM pages) SELECT h AS normalized_url, arg_min(page_id, (-priority, map_id, pos)) AS page_id FROM p GROUP BY 1""")
def merged_sitemaps(t):
    from plumbline.functions import urls as U
    from plumbline.operators import sites

    p = t("pages").select("page_id", (F.col("page_id") % 3).alias("map_id"), F.col("page_id").alias("pos"), "url", U.Url(F.col("url")).host.alias("normalized_url"), (F.col("page_id") % 7).alias("priority"))
    return sites.merged_sitemaps(p).select("normalized_url", "page_id")


@query("SELECT event_type AS source, count(*) AS files, sum(event_id)::BIGINT AS bytes, bool_and(user_id <> 3) AS allowed FROM events GROUP BY 1")
def purge_plan(t):
    from plumbline.operators import sites

    e = t("events").select(F.col("user_id").alias("company_id"), F.col("event_type").alias("source"), F.col("event_id").alias("size"), F.lit("/data/x").alias("path"))
    return sites.purge_plan(e, e.sparkSession.createDataFrame([(3,)], "company_id long"), "/data")


@query("""SELECT o_orderkey AS request_id, o_orderdate AS report_date, l_suppkey AS company_id, l_partkey AS version, o_orderkey AS row_no FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0""")
def unsynced_requests(t):
    from plumbline.operators import joins

    r = t("orders").select(F.col("o_orderkey").alias("request_id"), F.col("o_orderdate").alias("report_date"), F.expr("case when o_orderstatus = 'F' then 'delivered' else 'sending' end").alias("state"), (F.col("o_orderkey") % 3 == 0).alias("synced"), F.col("o_orderkey").alias("row_no"))
    return joins.unsynced(r, t("lineitem").select(F.col("l_orderkey").alias("request_id"), F.col("l_suppkey").alias("company_id"), F.col("l_partkey").alias("version")))


@query("""SELECT o_custkey AS company_id, count(*) AS objects, sum(o_orderkey % 4)::BIGINT AS products, sum(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 2 END + o_orderkey % 3)::BIGINT AS distributors, 0::BIGINT AS files, greatest('2000-01-01', strftime(max(o_orderdate), '%Y-%m-%d')) AS last_upload FROM orders GROUP BY 1""")
def graph_summaries(t):
    items = lambda n: F.expr(f"case when {n} = 0 then array() else transform(sequence(1, cast({n} as int)), x -> 'i') end").cast("array<string>")
    o = t("orders").select(
        F.col("o_custkey").alias("company_id"), items("o_orderkey % 4").alias("products"), F.expr("case when o_orderkey % 5 <> 0 then array('a', 'b') end").alias("suppliers"), items("o_orderkey % 3").alias("distributors"), F.lit(None).cast("array<string>").alias("files"),
        F.lit("").alias("verification_date"), F.lit(None).cast("string").alias("report_date"), F.lit("2000-01-01").alias("valid_on_date"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    return metrics.graph_summary(o)


@query("""WITH m AS (SELECT c_custkey AS domain, c_custkey % 50 AS k FROM customer) SELECT domain, 1 AS run, unnest(list_filter([CASE WHEN k < 10 THEN 'product_cards below baseline' END, CASE WHEN k < 35 OR k > 65 THEN 'sitemap differs from baseline' END, CASE WHEN k < 25 THEN 'gate3_pass_rate < 0.5' END,
 CASE WHEN k % 4 <> 0 AND k * 2 < 35 THEN 'card_yield < 0.35' END, CASE WHEN k % 9 < 5 THEN 'avg_specs_per_card < 5' END, CASE WHEN k % 2 = 1 THEN 'structure_hash changed' END, CASE WHEN k > 40 THEN 'perimeter dropped over 80 % of links' END, CASE WHEN k % 6 > 0 AND k % 5 = 0 THEN 'nothing queued from sitemap' END,
 CASE WHEN k % 3 > 0 AND k > 40 THEN 'sitemap_dup_skip_rate > 0.8' END, CASE WHEN k % 3 > 0 AND k > 45 THEN 'sitemap_no_content_rate > 0.8' END], lambda x: x IS NOT NULL)) AS alert FROM m""")
def profile_alerts(t):
    k = "c_custkey % 50"
    m = t("customer").selectExpr(
        "c_custkey as domain", "1 as run", f"{k} * 3 as product_cards", "50 as baseline_cards", f"{k} as sitemap_urls", "50 as baseline_sitemap", f"({k}) / 50D as gate3_pass_rate", f"({k}) * 2 / 100D as card_yield", f"{k} % 4 as product_pages", f"{k} % 9 as avg_specs",
        f"case when {k} % 2 = 1 then 'b' else 'a' end as structure_hash", "'a' as baseline_structure", "50 as links_found", f"{k} as links_outside", f"{k} % 6 as sitemap_filtered", f"nullif({k} % 5, 0) as sitemap_queued", f"{k} % 3 as sitemap_offered", f"({k}) / 50D as sitemap_dup_rate",
        f"case when {k} > 45 then 0.9D else 0.1D end as sitemap_empty_rate",
    )
    return quality.run_alerts(m)


@query("""WITH p AS (SELECT page_id, url, CASE WHEN page_id % 7 <> 0 THEN md5(html) END AS digest FROM pages), s AS (SELECT url, digest, min('/old/' || page_id) AS path FROM (SELECT page_id, url, CASE WHEN page_id % 14 = 0 THEN NULL WHEN page_id % 3 = 0 THEN 'x' ELSE md5(html) END AS digest FROM pages WHERE page_id % 2 = 0) GROUP BY 1, 2)
SELECT page_id, s.path IS NULL AS is_new, coalesce(s.path, '/new/' || sha256(p.url || chr(10) || coalesce(p.digest, '')) || '.html') AS path FROM p LEFT JOIN s ON p.url = s.url AND p.digest IS NOT DISTINCT FROM s.digest""")
def page_versions(t):
    pages = t("pages").selectExpr("page_id", "url", "case when page_id % 7 <> 0 then md5(html) end as digest")
    stored = t("pages").where("page_id % 2 = 0").selectExpr("url", "case when page_id % 14 = 0 then null when page_id % 3 = 0 then 'x' else md5(html) end as digest", "concat('/old/', page_id) as path")
    return catalog.page_versions(pages, stored, "/new/").select("page_id", "is_new", "path")
