"""Scalar functions on rows worked out by hand."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions import html, ids, jsonx, text
from plumbline.functions import urls as U


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalized_urls(spark):
    cases = {
        " https://www.Site.ru/a/b/?utm_source=x&b=2&a=1#top ": "https://site.ru/a/b?a=1&b=2",
        "http://site.ru": "http://site.ru/",
        "http://site.ru:8080/x?page=3": "http://site.ru:8080/x?page=3",
        "HTTPS://Site.ru/A?GCLID=1&q=": "https://site.ru/A?q=",
    }
    got = column(spark, list(cases), lambda c: U.normalized(U.Url(c)))
    assert got == list(cases.values())
    assert column(spark, got, lambda c: U.normalized(U.Url(c))) == got  # a key is its own key
    assert column(spark, ["https://a/x", "http://a/x"], U.scheme_free) == ["a/x", "a/x"]


def test_hosts(spark):
    assert column(spark, ["www.m.site.ru", "touch.shop.site.ru", "nowww.ru", "ru"], lambda c: F.array(U.strip_www(c), U.desktop_host(c), U.registrable_domain(c))) == [["m.site.ru", "site.ru", "site.ru"], ["touch.shop.site.ru", "shop.site.ru", "site.ru"], ["nowww.ru", "nowww.ru", "nowww.ru"], ["ru", "ru", "ru"]]
    assert column(spark, ["site.ru", "http://a.b/", "no dots", "two words.ru", ""], U.site_url) == ["https://site.ru", "http://a.b/", None, None, None]
    assert column(spark, [" /x ", "http://a.ru/http://b.ru/y"], U.clean_href) == ["/x", "http://b.ru/y"]


def test_url_predicates(spark):
    def flags(url):
        u = U.Url(url)
        return F.array(U.page_over_limit(u), U.foreign_language(u, "ru"), U.listing(u), U.product_card(u), U.strong_product_path(u), U.downloadable(u), U.image(u), U.print_version(u))

    cases = {
        "https://s.ru/catalog/?page=51": [True, False, True, False, False, False, False, False],
        "https://s.ru/catalog/?page=50": [False, False, True, False, False, False, False, False],
        "https://en.s.ru/": [False, True, False, False, False, False, False, False],
        "https://s.ru/ru/x-1": [False, False, False, True, False, False, False, False],
        "https://s.ru/catalog/en/thing": [False, True, True, False, False, False, False, False],
        "https://s.ru/price/product/235255": [False, False, False, True, True, False, False, False],
        "https://s.ru/x?lang=de_DE": [False, True, True, False, False, False, False, False],
        "https://s.ru/docs/list.pdf": [False, False, False, False, False, True, False, False],
        "https://s.ru/a.jpg?w=1": [False, False, False, False, False, False, True, False],
        "https://s.ru/item/print/?print=Y": [False, False, True, False, True, False, False, True],
    }
    got = column(spark, list(cases), flags)
    for url, row in zip(cases, got, strict=True):
        assert [bool(x) for x in row] == cases[url], url


def test_url_categories(spark):
    cases = {
        "https://s.ru/": ("main_page", 7), "https://s.ru/en/product/1": ("excluded", 0), "https://s.ru/kontakty/": ("contacts", 7), "https://s.ru/gde-kupit/": ("distributor", 7), "https://s.ru/about/gde-kupit": ("distributor", 7),
        "https://s.ru/news/1": ("excluded2", 0), "https://s.ru/news/catalog/kirpich-12": ("product", 7), "https://s.ru/price/": ("price_list", 6), "https://s.ru/product/kirpich-120": ("product", 9), "https://s.ru/series/": ("category", 8), "https://s.ru/x.png": ("excluded1", 0), "https://s.ru/abc": ("other", 1),
    }
    got = column(spark, list(cases), lambda c: U.categorized(U.Url(c), F.lit("")))
    assert {u: (r.category, r.priority) for u, r in zip(cases, got, strict=True)} == cases
    assert [r.category for r in column(spark, ["https://s.ru/abc"], lambda c: U.categorized(U.Url(c), F.lit("Контакты")))] == ["contacts"]


def test_ids(spark):
    a, b, none = column(spark, ["Кирпич «Ёлка» 10x20", "10×20 (кирпич) елка!", "«»"], lambda c: ids.product_id(c, F.lit(" ООО  Завод ")))
    bag = " ".join(sorted(["кирпич", "елка", "10х20"]))
    assert a == b == "pr_" + hashlib.sha256(f"{bag}|ооо завод".encode()).hexdigest()[:28] and none is None
    want = json.dumps({"name": 'a "b"', "region": "x"}, sort_keys=True, ensure_ascii=False)
    assert column(spark, [' A  "B" '], lambda c: ids.dealer_id(c, F.lit("X"))) == ["d_" + hashlib.sha256(want.encode()).hexdigest()[:28]]
    assert column(spark, [a, "pr_1", None], lambda c: ids.valid_id(c, "pr")) == [True, False, False]
    data = {"content_hash": hashlib.sha256(b"abc").hexdigest(), "file_name": "f.pdf", "file_size": 3}
    assert column(spark, ["abc"], lambda c: ids.file_id(c.cast("binary"), F.lit("f.pdf"), F.lit(3), F.lit(""))) == ["f_" + hashlib.sha256(json.dumps(data, sort_keys=True).encode()).hexdigest()[:28]]


def test_dates_and_durations(spark):
    assert [str(x) for x in column(spark, ["2024-03-05 10:00:00", " '2024-03-05' ", "05.03.2024 01:02:03", "5 March", "2024-13-01", None], text.parsed_date)] == ["2024-03-05 10:00:00", "2024-03-05 00:00:00", "2024-03-05 01:02:03", "None", "None", "None"]
    assert column(spark, ["", "05.03.2024 01:02:03", "soon enough"], lambda c: text.verification_date(c, F.lit("2024-01-01"), F.lit("2025-01-01"))) == ["2024-01-01", "2024-03-05", "soon"]
    assert column(spark, [5.0, 61.9, 3725.0], text.duration, "double") == ["5с", "1м 1с", "1ч 2м 5с"]
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert column(spark, ["120", "Mon, 01 Jan 2024 00:01:00 GMT", "Sun, 31 Dec 2023 00:00:00 GMT"], lambda c: text.retry_after(c, now)) == [120.0, 60.0, 0.0]


def test_contacts(spark):
    assert column(spark, ["отдел: 8 (800) 1-1, +7 2, завод: 8-800-1-1"], lambda c: text.best_phones(c, {"завод": 1, "отдел": 2})) == [["8-800-1-1", "+7 2"]]
    assert column(spark, ["8 800 555", "+7 800 1", "+7 495 1"], text.toll_free) == [True, True, False]
    assert column(spark, ["A@b.ru, a@B.ru c@d.com"], text.emails) == [["A@b.ru", "c@d.com"]]
    assert column(spark, ["+7 (495) 123-45-67 or 8 495 1234567"], text.phones) == [["+7 (495) 123-45-67"]]
    assert column(spark, ["123456, ул. Мира, д. 5", "пр-т. Ленина", None], text.address_key) == ["улица мира дом 5", "проспект ленина", ""]
    assert column(spark, ["г. Тула, ул. Мира", "Тульская область, Тула", "Москва", None], text.region) == ["Тула", "Тульская область", "Москва", None]
    assert column(spark, [["склад", "Головной офис: Мира 1"], ["", "  x "], []], text.head_office, "array<string>") == ["Мира 1", "  x ", None]


def test_texts(spark):
    assert column(spark, ["a:b / c?", "..", "x" * 300], text.file_name) == ["ab_-_c", "unnamed", "x" * 255]
    assert column(spark, ["10 x 20 * 30 m^2 ____________"], text.card_text) == ["10×20×30 m^2 ___"]
    assert column(spark, ["m^{2}, 10^3"], text.superscripts) == ["m², 10³"]
    assert column(spark, ["a, b (c, d), 1,5"], text.separated) == ["a; b (c, d); 1,5"]
    assert column(spark, ["12.0", "12.50"], text.price) == ["12", "12.50"]
    assert column(spark, ["HTTP 404 at", "status_code=503", "none"], text.http_status) == [404, 503, None]
    assert column(spark, ["HTTP timeout", "LLM timeout", "odd"], text.error_module) == ["crawler", "ai", "other"]


@pytest.mark.parametrize(
    ("reply", "value", "error"),
    [
        ('<think>{"a":0}</think>```json\n{"a": 1,}\n```', '{"a": 1}', None), ('so: {"a": "}"} end', '{"a": "}"}', None), ('{"p": "C:\\x"}', '{"p": "C:\\\\x"}', None), ('{"a": 1, "a": 2}', None, "duplicate key: 'a'"), ('{"a": 1, "a": 1}', '{"a": 1}', None), ("", None, "empty"), ("words", None, "no JSON"),
    ],
)
def test_replies(reply, value, error):
    got, why = jsonx.extract(reply)
    assert (None if got is None else jsonx.canonical(got)) == value and (why == error or (error or "").startswith("duplicate") and why.startswith("duplicate"))


def test_nested_json(spark):
    specs = json.dumps({"a": {"b": 1, "цена": 5}, "c": [1, "x"], "d": {}, "ГОСТ": "123"}, ensure_ascii=False)
    assert column(spark, [specs, None, "bad"], jsonx.flat_specs()) == [{"a > b": "1", "a > цена": "5", "c": "1; x", "d": "", "ГОСТ": "123"}, {}, {}]
    assert json.loads(column(spark, [specs], jsonx.without_prices)[0]) == {"a": {"b": 1}, "c": [1, "x"], "d": {}, "ГОСТ": "123"}
    assert json.loads(column(spark, ['{"x": 1, "y": {"x": 2, "z": 3}}'], jsonx.renamed({"x": "z"}))[0]) == {"z": 1, "y": {"x": 2, "z": 3}}
    assert column(spark, [specs, "", None, "bad"], jsonx.numeric_characteristics) == [2, 0, 0, 0]
    cases = {"Размер": ("390×90x188 мм", 3), "Масса": ("12×3", 1), "Плотность (ГОСТ 1)": ("5", 1), "Цена": ("5", 0), "Ширина": ("RAL 9003", 0), "Вес": ("5 руб", 0), "Длина": (["1", "2×3"], 2), "Упаковка": ({"Высота": "5"}, 0), "Материал": ("Ст3", 0), "Слои": ([{"a": "1"}, {"b": "2"}], 2)}
    given = [json.dumps({k: v}, ensure_ascii=False) for k, (v, _) in cases.items()]
    assert column(spark, given, jsonx.numeric_characteristics) == [want for _, want in cases.values()]
    chunks = column(spark, ["p\n\n" * 60_000], jsonx.chunked)[0]
    assert "".join(chunks) == "p\n\n" * 60_000 and max(map(len, chunks)) <= 160_000 and len(chunks) == 2


PAGE = """<html lang="ru"><head><title> A &amp; B </title><base href="/c/"><link rel="canonical" href="/x"><script type="application/ld+json">{"@graph":[{"@type":"Product","name":"N","offers":[{"price":12.0,"priceCurrency":"RUB"}],"brand":{"name":"Br"}}]}</script></head>
<body><nav><a href="#top">t</a></nav><div class="banner">buy</div><div id="main"><h1>Head</h1><p>Some <b>bold</b> text<br>x</p><a href="d?x=1">D</a><a href="mailto:x">m</a><span onclick="location.href='/go'">g</span>
<table><tr><th rowspan=2>k</th><th colspan=2>v</th></tr><tr><th>1</th><th>2</th></tr><tr><td colspan=3>all</td></tr><tr><td>a</td><td>b</td><td>c|d</td></tr></table></div><script>x</script></body></html>"""


def test_page_features(spark):
    f = column(spark, [PAGE, None], html.page_features)
    assert (f[0].title, f[0].h1, f[0].lang, f[0].canonical, f[0].base) == ("A & B", "Head", "ru", "/x", "/c/")
    assert (f[0].n_links, f[0].n_tables, f[0].n_scripts) == (3, 1, 2) and [x.href for x in f[0].links] == ["#top", "d?x=1", "mailto:x"] and f[0].onclick == ["/go"]
    assert f[1].title is None and f[1].n_links == 0
    assert html.features(PAGE)["comparison"] == html.features(PAGE.replace("<script>x", "<script>y").replace('id="main"', 'id="m2"'))["comparison"] != html.features(PAGE.replace("Some", "Any"))["comparison"]
    p = column(spark, [PAGE, "<p>x</p>"], html.product_data)
    assert (p[0].name, p[0].price, p[0].currency, p[0].brand, p[0].source) == ("N", "12", "RUB", "Br", "json_ld") and p[1].source is None


def test_tables_and_markdown(spark):
    table = next(n for n in html.parse(PAGE).walk() if n.tag == "table")
    assert html.grid(table) == [["k", "v", "v"], ["k", "1", "2"], ["all", "", ""], ["a", "b", "c|d"]]
    with pytest.raises(ValueError):
        html.grid(next(n for n in html.parse("<table><tr><td>a<td rowspan=2>b</tr><tr><td colspan=2>c</tr></table>").walk() if n.tag == "table"))
    m = column(spark, [PAGE, ""], html.page_markdown)
    assert m[0].markdown.startswith("# Head\n\nSome **bold** text x") and "| a | b | c\\|d |" in m[0].markdown and "buy" not in m[0].markdown and m[1].markdown is None
    df = spark.createDataFrame([(1, "http://s.ru/p", PAGE)], "id int, url string, html string")
    assert [(r.url, r.text) for r in html.links_of(df, "id", "url", "html").collect()] == [("http://s.ru/c/d?x=1", "D")]
    cells = html.table_cells(df, "id", "html").collect()
    assert len(cells) == 12 and sum(r.header for r in cells) == 6


def test_sitemaps(spark):
    xml = '<?xml version="1.0"?><s:urlset xmlns:s="x"><s:url><s:loc> http://a.ru/?a=1&amp;b=2 </s:loc></s:url><url><loc><![CDATA[http://a.ru/c]]></loc></url></s:urlset>'
    assert column(spark, [xml], html.sitemap_urls) == [["http://a.ru/?a=1&b=2", "http://a.ru/c"]]
    assert column(spark, [xml, "<sitemapindex/>", "<!DOCTYPE html><html>", "http://a.ru/\n# c\nhttp://b.ru/x", "words"], html.sitemap_kind) == ["urlset", "index", "html", "text", None]
