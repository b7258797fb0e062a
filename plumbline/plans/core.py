"""Queries on snapshots, dedupe, ranks, metrics and joins over the star schema and the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import ids, text
from plumbline.operators import dedupe, diff, joins, metrics, ranking
from plumbline.plans.registry import query
from plumbline.sources import readers, sinks
from plumbline.streaming import jobs


@query("""WITH l AS (SELECT source AS site, doc_id AS page, trim(regexp_replace(unnest(string_split(text, chr(10))), '\\s+', ' ', 'g')) AS l FROM documents), k AS (SELECT site, l, page, count(*) AS k FROM l WHERE length(l) >= 3 GROUP BY 1, 2, 3),
n AS (SELECT site, count(DISTINCT page) AS n_pages FROM k GROUP BY 1), p AS (SELECT site, l, count(*) AS pages, sum(k) AS k FROM k GROUP BY 1, 2)
SELECT site, n_pages, CASE WHEN n_pages >= 3 THEN round_even(sum(CASE WHEN pages >= 0.2 * n_pages THEN p.k ELSE 0 END)::DOUBLE / sum(p.k), 4) END AS share FROM p JOIN n USING (site) GROUP BY site, n_pages""")
def boilerplate_share(t):
    return metrics.boilerplate_share(t("documents"), "source", "doc_id", "text", 0.2)


_BAG = "array_to_string(list_sort(list_filter(list_transform(regexp_split_to_array(trim(translate(lower(p_name), 'ё×x', 'ехх')), '\\s+'), lambda w: trim(w, '«»\"“”’''()[]{},.;:!?—–-')), lambda w: w <> '')), ' ')"


@query(f"SELECT p_partkey, 'pr_' || substr(sha256({_BAG} || '|' || trim(regexp_replace(lower(p_brand), '\\s+', ' ', 'g'))), 1, 28) AS product_id FROM part")
def product_id_bag(t):
    return t("part").select("p_partkey", ids.product_id(F.col("p_name"), F.col("p_brand")).alias("product_id"))


@query("""SELECT s_suppkey, 'd_' || substr(sha256('{"name": "' || trim(regexp_replace(lower(s_name), '\\s+', ' ', 'g')) || '", "region": "' || n_nationkey || '"}'), 1, 28) AS dealer_id FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def dealer_ids(t):
    s = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("s_suppkey", ids.dealer_id(F.col("s_name"), F.col("n_nationkey").cast("string")).alias("dealer_id"))


@query("SELECT lower(v) AS key, count(*) AS n, list_sort(list(v)) AS spellings FROM (SELECT DISTINCT p_type AS v FROM part UNION SELECT DISTINCT lower(p_type) FROM part) GROUP BY 1 HAVING count(*) > 1")
def name_casefold_dupes(t):
    p = t("part").select("p_type")
    return dedupe.case_twins(p.unionAll(p.select(F.lower("p_type"))), "p_type")


_OLD = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal, c_mktsegment AS seg FROM customer WHERE c_custkey % 11 <> 0"
_NEW = "SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN c_name || ' ' WHEN c_custkey % 7 = 0 THEN c_name || 'x' ELSE c_name END AS name, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS bal, c_mktsegment AS seg FROM customer WHERE c_custkey % 17 <> 0"


@query(f"""SELECT coalesce(n.id, o.id) AS id, CASE WHEN o.id IS NULL THEN 'NEW_DATA' WHEN n.id IS NULL THEN 'DATA_NOT_FOUND' WHEN trim(o.name) IS DISTINCT FROM trim(n.name) OR o.bal IS DISTINCT FROM n.bal OR o.seg IS DISTINCT FROM n.seg THEN 'EDITING' ELSE 'NO_CHANGES' END AS status,
 (trim(o.name) IS DISTINCT FROM trim(n.name))::INT + (o.bal IS DISTINCT FROM n.bal)::INT + (o.seg IS DISTINCT FROM n.seg)::INT AS n_changed FROM ({_OLD}) o FULL JOIN ({_NEW}) n ON o.id = n.id""")
def snapshot_diff_customers(t):
    c = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    new = c.where("id % 17 <> 0").withColumn("name", F.expr("case when id % 5 = 0 then name || ' ' when id % 7 = 0 then name || 'x' else name end")).withColumn("bal", F.expr("case when id % 13 <> 0 then bal end"))
    return diff.diff_rows(c.where("id % 11 <> 0"), new, ["id"], ["name", "bal", "seg"]).select("id", "status", F.size("changed").alias("n_changed"))


_LOLD = "SELECT l_orderkey AS o, l_linenumber AS l, l_quantity AS q FROM lineitem WHERE l_linenumber <> 3"
_LNEW = "SELECT l_orderkey AS o, l_linenumber AS l, CASE WHEN l_orderkey % 9 = 0 THEN l_quantity + 1 ELSE l_quantity END AS q FROM lineitem WHERE l_linenumber <> 4"
_LDIFF = f"SELECT coalesce(n.o, p.o) AS o, coalesce(n.l, p.l) AS l, CASE WHEN p.o IS NULL THEN 'NEW_DATA' WHEN n.o IS NULL THEN 'DATA_NOT_FOUND' WHEN p.q IS DISTINCT FROM n.q THEN 'EDITING' ELSE 'NO_CHANGES' END AS status FROM (SELECT o, l, max(q) AS q FROM ({_LOLD}) GROUP BY 1, 2) p FULL JOIN (SELECT o, l, max(q) AS q FROM ({_LNEW}) GROUP BY 1, 2) n ON p.o = n.o AND p.l = n.l"


def _lines(t):
    li = t("lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), F.col("l_quantity").alias("q"))
    new = li.where("l <> 4").withColumn("q", F.expr("case when o % 9 = 0 then q + 1 else q end"))
    one = lambda d: d.groupBy("o", "l").agg(F.max("q").alias("q"))
    return diff.diff_rows(one(li.where("l <> 3")), one(new), ["o", "l"], ["q"])


@query(f"SELECT status, count(*) AS n FROM ({_LDIFF}) GROUP BY 1")
def nested_child_diff(t):
    return metrics.histogram(_lines(t), F.col("status"), "status")


@query(f"SELECT o AS o_orderkey, CASE WHEN bool_or(status <> 'NO_CHANGES') THEN 'EDITING' ELSE 'NO_CHANGES' END AS status FROM orders LEFT JOIN ({_LDIFF}) ON o_orderkey = o WHERE o IS NOT NULL GROUP BY 1 UNION ALL SELECT o_orderkey, 'NO_CHANGES' FROM orders WHERE o_orderkey NOT IN (SELECT o FROM ({_LDIFF}))")
def status_escalation(t):
    parents = t("orders").select("o_orderkey", F.lit("NO_CHANGES").alias("status"))
    return diff.escalated(parents, _lines(t).select(F.col("o").alias("o_orderkey"), "status"), "o_orderkey")


@query(f"SELECT id, f AS field, coalesce(CASE f WHEN 'name' THEN trim(a) ELSE a END, '') AS was, coalesce(CASE f WHEN 'name' THEN trim(b) ELSE b END, '') AS became FROM (SELECT o.id, unnest(['name', 'seg']) AS f, unnest([o.name, o.seg]) AS a, unnest([n.name, n.seg]) AS b FROM ({_OLD}) o JOIN ({_NEW}) n ON o.id = n.id) WHERE trim(a) IS DISTINCT FROM trim(b)")
def was_became_rows(t):
    c = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    new = c.where("id % 17 <> 0").withColumn("name", F.expr("case when id % 5 = 0 then name || ' ' when id % 7 = 0 then name || 'x' else name end"))
    d = diff.diff_rows(c.where("id % 11 <> 0"), new, ["id"], ["name", "seg"]).where("status = 'EDITING'")
    return diff.was_became(d.select("id", "changed"))


_DATES = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS report_date, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE strftime(o_orderdate + INTERVAL (o_orderkey % 5 - 2) DAY, '%d.%m.%Y %H:%M:%S') END AS update_date"


def _dated(t):
    o = t("orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    upd = F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.col("o_orderkey") % 5 - 2), "dd.MM.yyyy HH:mm:ss")
    return o.select(F.col("o_orderkey").alias("company_id"), F.when(F.col("o_orderkey") % 3 != 0, day).alias("report_date"), F.when(F.col("o_orderkey") % 4 != 0, upd).alias("update_date"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("report_version"), F.col("o_orderpriority").alias("data_version"), F.col("o_orderdate"), F.col("o_totalprice"))


@query(f"""SELECT company_id, CASE WHEN report_date IS NULL THEN 'NEW_COMPANY' WHEN company_id % 2 = 0 THEN 'ALREADY_REPORTED' WHEN strptime(update_date, '%d.%m.%Y %H:%M:%S') > strptime(report_date, '%Y-%m-%d') THEN 'NEEDS_COMPARISON' ELSE 'ALREADY_REPORTED' END AS status FROM (SELECT o_orderkey AS company_id, {_DATES} FROM orders)""")
def company_status(t):
    d = _dated(t)
    return d.select("company_id", diff.company_status(*[F.col(c) for c in ("report_date", "update_date", "report_version", "data_version")]).alias("status"))


@query("""SELECT company_id, queue FROM (SELECT o_orderkey AS company_id, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS queue, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate WHEN o_orderkey % 4 <> 0 THEN o_orderdate END AS d FROM orders) ORDER BY queue, d NULLS LAST, company_id::VARCHAR LIMIT 100""")
def rank_queue_topn(t):
    d = _dated(t).select("company_id", "report_date", F.col("o_orderdate").alias("upload_date"), F.when(F.col("company_id") % 4 != 0, F.col("o_orderdate")).alias("update_date"))
    return ranking.report_queue(d, 100).select("company_id", "queue")


@query("""WITH r AS (SELECT p_partkey, p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS n FROM part) SELECT p_type, min(n) AS n, arg_min(p_brand, (n, p_brand)) AS p_brand FROM r GROUP BY 1""")
def round_robin_merge(t):
    return ranking.round_robin(t("part").select("p_partkey", "p_brand", "p_type", "p_retailprice"), "p_brand", ["p_retailprice", "p_partkey"], "p_type").select("p_type", "n", "p_brand")


@query("""WITH r AS (SELECT p_partkey, p_brand, p_size % 2 = 0 AS card, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part), s AS (SELECT *, sum((card AND n > 14)::INT) OVER (PARTITION BY p_brand ORDER BY n ROWS UNBOUNDED PRECEDING) AS late FROM r)
SELECT p_partkey, n <= 14 OR (card AND late <= 6) AS admitted FROM s""")
def quota_reserve(t):
    p = t("part").select("p_partkey", "p_brand", (F.col("p_size") % 2 == 0).alias("card"))
    return ranking.quota_with_reserve(p, "p_brand", "p_partkey", "card", 20).select("p_partkey", "admitted")


@query()
def quota_with_release(t):
    e = t("events").select("event_id", "user_id", F.when(F.col("event_type") == "error", "release").otherwise("take").alias("event"))
    return ranking.admitted_with_release(e, "user_id", "event_id", "event", 3).select("event_id", "admitted")


_E = "(SELECT user_id, ts, event_type FROM events WHERE event_type IN ('click', 'view'))"


@query(f"""SELECT e.event_id, r.event_type AS last_type FROM events e LEFT JOIN LATERAL (SELECT max(event_type) AS event_type FROM {_E} x WHERE x.user_id = e.user_id AND x.ts = (SELECT max(ts) FROM {_E} y WHERE y.user_id = e.user_id AND y.ts <= e.ts)) r ON true WHERE e.event_type = 'purchase'""")
def asof_last_event(t):
    e = t("events").select("event_id", "user_id", "ts", "event_type")
    right = e.where("event_type in ('click', 'view')").select("user_id", F.col("ts").alias("at"), F.col("event_type").alias("last_type"))
    return joins.as_of_last(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), right, ["user_id"], "ts", "at", "last_type").select("event_id", "last_type")


@query("""WITH s AS (SELECT event_id AS run_id, ts AS a, ts + INTERVAL 10 MINUTE AS b FROM events WHERE event_type = 'signup') SELECT run_id, event_id FROM s JOIN events e ON e.ts BETWEEN a AND b WHERE e.event_type = 'error'""")
def interval_join_window(t):
    e = t("events")
    spans = e.where("event_type = 'signup'").select(F.col("event_id").alias("run_id"), F.col("ts").alias("a"), (F.col("ts") + F.expr("interval 10 minutes")).alias("b"))
    return joins.in_intervals(e.where("event_type = 'error'").select("event_id", "ts"), spans, "ts", "a", "b", 1800).select("run_id", "event_id")


_RUN = "SELECT user_id % 7 AS run_id, event_type AS name, event_id AS ord, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, CASE WHEN event_type IN ('view', 'error') THEN 0 ELSE 1 + event_id % 4 END AS products, value AS seconds FROM events"


def _run(t):
    return t("events").selectExpr("user_id % 7 as run_id", "event_type as name", "event_id as ord", "case when event_type = 'error' then 'failed' else 'success' end as status", "case when event_type in ('view', 'error') then 0 else 1 + event_id % 4 end as products", "value as seconds")


@query(f"""SELECT run_id, count(*) AS done, count(*) FILTER (products = 0) AS zero, round_even(count(*) FILTER (products = 0) * 100.0 / count(*), 1)::DOUBLE AS zero_percent, count(*) FILTER (status <> 'success') AS failed, sum(products)::BIGINT AS products, round_even(quantile_cont(seconds, 0.5), 1) AS median_seconds,
 list_slice(list(name ORDER BY ord) FILTER (products = 0), 1, 50) AS zero_names FROM ({_RUN}) GROUP BY 1""")
def run_summary(t):
    return metrics.run_summary(_run(t), ["run_id"]).withColumn("zero_percent", F.col("zero_percent").cast("double"))


@query(f"SELECT run_id, round_even(count(*) FILTER (products = 0)::DOUBLE / count(*), 4) AS zero_rate FROM ({_RUN}) GROUP BY 1")
def zero_rate(t):
    return _run(t).groupBy("run_id").agg(metrics.ratio(F.count_if(F.col("products") == 0).cast("double"), F.count("*")).alias("zero_rate"))




_SAID = "CASE event_id % 9 WHEN 0 THEN 'PDF: soffice failed' WHEN 1 THEN 'Graph timeout' WHEN 2 THEN 'download of file' WHEN 3 THEN 'docx card' WHEN 4 THEN 'LLM timeout' WHEN 5 THEN 'markdown of page' WHEN 6 THEN 'Timeout' WHEN 7 THEN 'таймаут сайта' ELSE 'unknown' END"
_MODULE = "CASE event_id % 9 WHEN 0 THEN 'pdf' WHEN 1 THEN 'graph' WHEN 2 THEN 'files' WHEN 3 THEN 'cards' WHEN 4 THEN 'ai' WHEN 5 THEN 'text' WHEN 6 THEN 'crawler' WHEN 7 THEN 'crawler' ELSE 'other' END"


@query(f"""SELECT x.module, coalesce(n, 0) AS n, coalesce(s, []) AS samples FROM (VALUES ('pdf'), ('graph'), ('files'), ('cards'), ('ai'), ('text'), ('crawler'), ('other')) x(module)
LEFT JOIN (SELECT module, count(*) AS n, list_slice(list_sort(list(DISTINCT m)), 1, 3) AS s FROM (SELECT event_type || ' ' || {_SAID} AS m, {_MODULE} AS module FROM events) GROUP BY 1) USING (module)""")
def errors_by_module(t):
    m = F.concat("event_type", F.lit(" "), F.expr(_SAID))
    return metrics.errors_by_module(t("events").select(m.alias("m")), "m", ["pdf", "graph", "files", "cards", "ai", "text", "crawler", "other"])


@query("""SELECT CASE WHEN grouping(user_id) = 0 THEN user_id END AS company, event_type AS module, count(value) FILTER (event_id % 10 <> 0) AS n, round_even(sum(value) FILTER (event_id % 10 <> 0), 4) AS total, round_even(quantile_cont(value, 0.5) FILTER (event_id % 10 <> 0), 4) AS median, round_even(sum(CASE WHEN event_id % 10 = 0 THEN value ELSE 0 END), 4) AS retry_total, grouping(user_id)::INT AS is_total FROM events GROUP BY GROUPING SETS ((user_id, event_type), (event_type))""")
def module_time_grouping_sets(t):
    e = t("events").select(F.col("user_id").alias("company"), F.col("event_type").alias("module"), F.col("value").alias("seconds"), (F.col("event_id") % 10 == 0).alias("retry"))
    out = metrics.module_times(e, "company", "module", "seconds", "retry")
    return out.select("company", "module", "n", *[F.bround(c, 4).alias(c) for c in ("total", "median", "retry_total")], F.col("is_total").cast("int").alias("is_total"))


_MODS = ["click", "purchase", "error"]


@query("SELECT CASE WHEN grouping(user_id::VARCHAR) = 1 THEN 'TOTAL' ELSE user_id::VARCHAR END AS company, " + ", ".join(f"count(*) FILTER (event_type = '{m}') AS {m}_n, round_even(sum(CASE WHEN event_type = '{m}' THEN value ELSE 0 END), 3) AS {m}_total" for m in _MODS) + " FROM events GROUP BY ROLLUP (user_id::VARCHAR)")
def module_time_pivot(t):
    out = metrics.module_pivot(t("events"), "user_id", "event_type", "value", _MODS)
    return out.select("company", *[c for m in _MODS for c in (F.col(f"{m}_n"), F.bround(f"{m}_total", 3).alias(f"{m}_total"))])


@query("""SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS rn FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2)) WHERE rn = 1""")
def mode_first_seen(t):
    return ranking.first_mode(t("events"), ["user_id"], "event_type", "event_id")


_V = "WITH s AS (SELECT l_returnflag AS g, list_sort(list(l_extendedprice)) AS v, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT g, n, v, unnest(range(1, 10)) AS k FROM s), j AS (SELECT *, greatest(least((k * (n + 1)) // 10, n - 1), 1) AS j FROM c)"


@query(f"{_V} SELECT g AS l_returnflag, k::INT AS k, round_even((v[j] * (10 - (k * (n + 1) - j * 10)) + v[j + 1] * (k * (n + 1) - j * 10)) / 10, 4) AS q FROM j")
def exclusive_deciles(t):
    return metrics.quantiles_by_rank(t("lineitem"), ["l_returnflag"], "l_extendedprice").select("l_returnflag", "k", F.bround("q", 4).alias("q"))


@query("""SELECT event_type, count(*) AS n, round_even(quantile_cont(value, 0.5), 6) AS median FROM events GROUP BY 1""")
def corpus_medians(t):
    return metrics.corpus_summary(t("events"), ["event_type"], "value").select("event_type", "n", F.bround("median", 6).alias("median"))


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 300 SECOND PRECEDING AND CURRENT ROW) AS n_trailing FROM events")
def trailing_rate_window(t):
    return ranking.trailing_count(t("events"), "event_type", "ts", 300).select("event_id", "n_trailing")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS n FROM i GROUP BY user_id, k""")
def session_gap(t):
    return jobs.sessions(t("events"), "user_id").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("ended"), "n")


@query("""WITH h AS (SELECT user_id, event_id, (event_type IN ('error', 'view'))::INT AS h FROM events), i AS (SELECT *, sum(1 - h) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS k FROM h) SELECT user_id, max(n)::BIGINT AS longest FROM (SELECT user_id, k, sum(h) AS n FROM i GROUP BY 1, 2) GROUP BY 1""")
def failure_streaks(t):
    return ranking.streaks(t("events"), "user_id", "event_id", F.col("event_type").isin("error", "view"))


@query("""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def tumbling_rate(t):
    return jobs.windowed_rate(t("events"), length="5 minutes", slide="5 minutes", by=["event_type"]).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT event_id, gap_ms FROM (SELECT event_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1000.0 AS gap_ms FROM events) WHERE gap_ms < 600000")
def throttle_violations(t):
    return ranking.too_fast(t("events"), ["user_id"], "ts", 600_000).select("event_id", F.col("gap_ms").cast("double").alias("gap_ms"))


@query("SELECT user_id, c::INT AS chunk, count(*) AS n, list(event_id ORDER BY event_id) AS items FROM (SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 AS c FROM events) GROUP BY 1, 2")
def upload_chunks(t):
    return ranking.chunks(t("events"), "user_id", "event_id", 5)


@query("SELECT event_type, event_id, rn::INT AS rn FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 3")
def first_samples(t):
    return ranking.first_n(t("events"), ["event_type"], [F.desc("value"), "event_id"], 3).select("event_type", "event_id", "rn")


@query("""WITH d AS (SELECT s_suppkey AS ord, s_nationkey::VARCHAR AS address, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'x' END AS phone FROM supplier), f AS (SELECT *, (name <> '')::INT + (phone IS NOT NULL)::INT + 1 AS k FROM d)
SELECT min(ord) AS ord, address, arg_min(name, (-k, ord)) AS name, arg_min(coalesce(phone, ''), (-k, ord)) AS phone FROM f GROUP BY address""")
def dealers_by_address(t):
    s = t("supplier").selectExpr("s_suppkey as ord", "cast(s_nationkey as string) as address", "case when s_suppkey % 3 = 0 then '' else s_name end as name", "case when s_suppkey % 2 = 0 then 'x' end as phone")
    return dedupe.dealers_by_address(s, ["address", "name", "phone"]).select("ord", "address", "name", F.coalesce("phone", F.lit("")).alias("phone"))


@query("""WITH p AS (SELECT min(p_partkey) AS p_partkey, p_name AS product_id FROM part GROUP BY p_name), s AS (SELECT a.p_partkey, a.p_brand || a.p_size AS slug FROM part a JOIN p USING (p_partkey)) SELECT min(p_partkey) AS p_partkey, slug FROM s GROUP BY slug""")
def products_once(t):
    p = t("part").select("p_partkey", F.col("p_name").alias("product_id"), F.concat("p_brand", F.col("p_size").cast("string")).alias("slug"))
    return dedupe.products_once(p, "p_partkey").select("p_partkey", "slug")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def crawl_unseen(t):
    done = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedupe.unseen(t("orders").select("o_orderkey"), done, "o_orderkey")


@query("""SELECT o_custkey AS company_id, arg_max(o_orderkey, o_orderkey) AS snapshot FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def last_delivered_snapshot(t):
    req = t("orders").select(F.col("o_orderkey").alias("request_id"), F.when(F.col("o_orderstatus") == "F", "delivered").otherwise("failed").alias("state"))
    items = t("orders").select(F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("company_id"), F.col("o_orderkey").alias("snapshot"), F.col("o_orderkey").alias("row_no"))
    return joins.last_delivered(req, items)


@query("""SELECT c_custkey AS company_id, 'n' || c_nationkey AS name, r.o_orderkey FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1) r ON o_custkey = c_custkey UNION ALL SELECT o_custkey, NULL, max(o_orderkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1""")
def site_cards(t):
    sites = t("customer").select(F.col("c_custkey").alias("company_id"), F.concat(F.lit("n"), "c_nationkey").alias("name"), F.lit(None).cast("string").alias("website"))
    res = t("orders").select(F.col("o_custkey").alias("company_id"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("website"), "o_orderkey", F.lit(1).alias("run_id"), F.col("o_orderkey").alias("ord"))
    return joins.cards(sites, res).select("company_id", "name", "o_orderkey")


@query("""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 8 AS lines FROM orders), a AS (SELECT l_orderkey AS k, count(*) AS lines FROM lineitem GROUP BY 1) SELECT k, 'lines' AS counter, r.lines AS reported, a.lines AS actual FROM r JOIN a USING (k) WHERE r.lines <> a.lines""")
def counter_mismatches(t):
    rep = t("orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 8).alias("lines"))
    act = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("lines"))
    return joins.mismatches(rep, act, "k", ["lines"])


_CHECKS = [("price", "c1", "p_retailprice > 1000"), ("size", "c1", "p_size >= 10"), ("brand", "c2", "p_brand <> 'Brand#11'")]


@query(" UNION ALL ".join(f"SELECT '{n}' AS check_name, '{c}' AS criterion, count(*) AS total, count(*) FILTER ({ok}) AS passed, round_even(count(*) FILTER ({ok})::DOUBLE / count(*), 4) AS score, coalesce(list_slice(list(p_partkey ORDER BY p_partkey) FILTER (NOT ({ok})), 1, 5), []) AS examples FROM part" for n, c, ok in _CHECKS))
def qa_check_scores(t):
    return metrics.check_scores(t("part"), [(n, c, F.expr(ok)) for n, c, ok in _CHECKS], "p_partkey")


@query("SELECT criterion, round_even(avg(s), 4) AS mean, round_even(avg(s) * 0.2, 4) AS weighted, CASE WHEN min(s) < 0.5 THEN 'BLOCK' WHEN min(s) < 0.9 THEN 'WARN' ELSE 'PASS' END AS verdict FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS criterion, round_even(count(*) FILTER ({ok})::DOUBLE / count(*), 4) AS s FROM part" for _, c, ok in _CHECKS) + ") GROUP BY 1")
def qa_verdict(t):
    return metrics.verdict(qa_check_scores(t))


@query("SELECT p_brand, sum(p_size)::BIGINT AS size, count(*) AS n FROM part GROUP BY 1 UNION ALL SELECT 'TOTAL', sum(p_size), count(*) FROM part")
def report_with_total(t):
    g = t("part").groupBy("p_brand").agg(F.sum("p_size").alias("size"), F.count("*").alias("n"))
    return sinks.with_total(g, "p_brand", ["size", "n"])


@query("""SELECT event_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'ч ' || (s % 3600 // 60) || 'м ' || (s % 60) || 'с' WHEN s >= 60 THEN (s // 60) || 'м ' || (s % 60) || 'с' ELSE s || 'с' END AS took FROM (SELECT event_id, (floor(abs(value)) * 61)::BIGINT AS s FROM events)""")
def durations(t):
    return t("events").select("event_id", text.duration(F.floor(F.abs("value")) * 61).alias("took"))


@query("""WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS e FROM documents)
SELECT doc_id, list_filter(e, lambda x, i: list_position(list_transform(e, lambda y: lower(y)), lower(x)) = i) AS emails FROM d WHERE len(e) > 0""")
def contact_emails(t):
    return t("documents").select("doc_id", text.emails(F.col("text")).alias("emails")).where(F.size("emails") > 0)


@query("SELECT doc_id, greatest(1, length(text) // 4)::INT AS tokens FROM documents")
def approximate_tokens(t):
    return t("documents").select("doc_id", text.approximate_tokens(F.col("text")).alias("tokens"))


@query("""SELECT doc_id, len(string_split(text, chr(10)))::INT AS n_lines, len(list_filter(string_split(text, chr(10)), lambda x: starts_with(trim(x, ' '), '|')))::INT AS table_lines, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^#{1,6} ')))::INT AS headings FROM documents""")
def markdown_line_metrics(t):
    m = metrics.line_metrics(F.col("text"))
    return t("documents").select("doc_id", *[m[k].alias(k) for k in ("n_lines", "table_lines", "headings")])


@query("SELECT event_id, least(pow(2, event_id % 6 + 1), 30) AS wait FROM events")
def retry_backoff(t):
    return t("events").select("event_id", text.backoff(F.col("event_id") % 6, F.lit(None).cast("double")).alias("wait"))


@query("SELECT o_orderstatus AS state, count(*) AS n FROM orders GROUP BY 1")
def change_histogram(t):
    return metrics.histogram(t("orders"), F.col("o_orderstatus"), "state")


@query("""WITH r AS (SELECT c_custkey AS company_id, c_custkey % 3 <> 0 AS has_changes FROM customer), f AS (SELECT o_custkey AS company_id, count(*) FILTER (o_orderstatus = 'F') AS n_files FROM orders GROUP BY 1)
SELECT CASE WHEN NOT has_changes THEN 'no_changes' WHEN n_files IS NULL THEN 'no_folder' WHEN n_files = 0 THEN 'empty' ELSE 'processed' END AS reason, count(*) AS n FROM r LEFT JOIN f USING (company_id) GROUP BY 1""")
def archive_reasons(t):
    rep = t("customer").select(F.col("c_custkey").alias("company_id"), (F.col("c_custkey") % 3 != 0).alias("has_changes"))
    fol = t("orders").groupBy(F.col("o_custkey").alias("company_id")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("n_files"))
    return sinks.archive_reasons(rep, fol)


@query("""SELECT user_id, max(ts) AS last, CASE WHEN epoch(TIMESTAMP '2024-01-30 00:00:00') - floor(epoch(max(ts))) >= 1800 THEN 'stalled' ELSE 'running' END AS state FROM events GROUP BY 1""")
def watchdog_state(t):
    return jobs.pipeline_state(t("events"), "user_id", "ts", F.lit("2024-01-30 00:00:00").cast("timestamp")).select("user_id", "last", "state")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def latest_by_key(t):
    return readers.latest_by(t("events").select("user_id", "event_type", "event_id"), "user_id", "event_id")


@query("SELECT o_orderkey, round_even(o_totalprice / 1e6 * 2.5, 2) AS cost FROM orders")
def token_costs(t):
    return t("orders").select("o_orderkey", metrics.token_cost(F.col("o_totalprice"), 2.5).alias("cost"))


@query("""SELECT event_id, (props::JSON ->> 'k')::INT AS k FROM events""")
def json_field(t):
    from plumbline.functions.jsonx import coalesced_keys

    return t("events").select("event_id", coalesced_keys(F.col("props"), ["missing", "k"]).cast("int").alias("k"))


@query()
def json_flat(t):
    from plumbline.functions.jsonx import canonical_json, flat_specs

    return t("events").select("event_id", F.to_json(flat_specs()(F.col("props"))).alias("flat"), canonical_json(F.col("props")).alias("canonical"))


@query()
def streaming_rate(t):
    """The windowed rate as a stream over the event files, run to the end of what is there."""
    import uuid

    batch = t("events")
    spark, path = batch.sparkSession, batch.inputFiles()[0]
    stream = spark.readStream.schema(batch.schema).parquet(path.rpartition("/")[0] + "/events.parquet*") if path.endswith("events.parquet") else spark.readStream.schema(batch.schema).parquet(path.rpartition("/")[0])
    return jobs.run_available(jobs.windowed_rate(stream, length="1 hour", slide="1 hour", by=["event_type"]), f"rate_{uuid.uuid4().hex}", "complete")
