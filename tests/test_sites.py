from pyspark.sql import functions as F

from plumbline.operators import sites
from plumbline.plans import views


def test_hosts_and_scope(spark):
    u = spark.createDataFrame([("https://www.a.ru/x",), ("http://m.a.ru/",), ("http://shop.b.ru/",), ("ftp://a.ru/",), ("http://u@a.ru/",), (None,)], "url string")
    got = {r.url: r.in_scope for r in sites.in_scope(u, "a.ru", spark.createDataFrame([("www.shop.b.ru",)], "host string")).collect()}
    assert got == {"https://www.a.ru/x": True, "http://m.a.ru/": True, "http://shop.b.ru/": True, "ftp://a.ru/": False, "http://u@a.ru/": False, None: False}
    g = spark.createDataFrame([(1, "b.ru"), (1, "www.c.ru")], "group_id int, host string")
    s = spark.createDataFrame([("m.c.ru",), ("d.ru",)], "host string")
    assert sorted(tuple(r) for r in sites.equivalent_sites(s, g).collect()) == [("d.ru", "d.ru"), ("m.c.ru", "b.ru")]
    assert spark.range(1).select(sites.subdomain(F.lit("x.a.ru"), F.lit("www.a.ru")), sites.subdomain(F.lit("xa.ru"), F.lit("a.ru"))).first() == (True, False)


def test_canonical_and_adapters(spark):
    rows = [(1, "http://a.ru/p?x", '<link rel="canonical" href="/p"><p>t</p>'), (2, "http://a.ru/q", '<link rel=canonical href="http://b.ru/q"><meta property="og:url" content="http://www.a.ru/q2">'), (3, "http://c.ru/", "")]
    p = spark.createDataFrame(rows, "id int, url string, html string")
    assert [tuple(r)[1:] for r in sites.canonical_urls(p, "id", "url", "html").orderBy("id").collect()] == [("http://a.ru/p", "link"), ("http://www.a.ru/q2", "og"), ("http://c.ru/", "self")]

    @sites.adapter("a.ru")
    def own(html):
        return F.regexp_extract(html, "<p>(.*?)</p>", 1)

    try:
        got = sites.site_markdown(p.withColumn("host", F.regexp_extract("url", "//([^/]+)", 1))).orderBy("id").collect()
        assert [r.how.split(":")[0] for r in got][:2] == ["adapter", "fallback"] and got[0].markdown == "t"
    finally:
        sites.ADAPTERS.clear()


def test_corpus_and_views(spark, tmp_path):
    for k in range(3):
        d = tmp_path / "co" / "Product_pages"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"p{k}.html").write_text(f"<p>{k}</p>")
        (d / f"p{k}.json").write_text(f'{{"url": "http://a.ru/{k}"}}')
    got = sites.page_corpus(spark, f"{tmp_path}/co/*/*.html", f"{tmp_path}/co/*/*.json", 2).orderBy("file").collect()
    assert [(r.folder, r.file, r.html, r.url) for r in got] == [("Product_pages", "p0", "<p>0</p>", "http://a.ru/0"), ("Product_pages", "p1", "<p>1</p>", "http://a.ru/1")]
    rec = spark.createDataFrame([("r", 1, "n", "success", 0, 1.0, 1)], "run_id string, company_id int, name string, status string, products int, seconds double, ord int")
    times = spark.createDataFrame([("c", "m", 1.0, False)], "company string, module string, seconds double, retry boolean")
    fetches = spark.createDataFrame([("d", 1, True, False, 5, True, "product", "aiohttp")], "domain string, run int, ok boolean, challenge boolean, md_len int, is_card boolean, category string, method string")
    assert all(spark.table(v).count() for v in views.register(rec, times, fetches))
    assert spark.table("v_run_summary").first().zero == 1
