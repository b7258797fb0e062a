"""Queries on scalar functions: each event is given one of a few cases, and the SQL knows the result of each case, worked out by hand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import html as H
from plumbline.functions import ids, jsonx, records, text
from plumbline.functions import urls as U
from plumbline.operators import quality
from plumbline.plans.registry import QUERIES, SQL, table

_SQL_TYPES = {"string": "VARCHAR", "int": "INT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _literal(value, kind: str) -> str:
    shown = "NULL" if value is None else "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)
    return f"{shown}::{_SQL_TYPES[kind]}"


def by_hand(name: str, given: str, out: dict[str, tuple[Callable[..., Column], str]], rows: list[tuple[tuple, tuple]], before: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Registers a query. given: the schema of the cases' inputs; out: columns, by functions of the inputs, and their types; rows: inputs and what they give; before: what is done to the table first."""

    def run(spark, sf_dir):
        known = spark.createDataFrame([(k, *given_row) for k, (given_row, _) in enumerate(rows)], f"k long, {given}")
        names = [c for c in known.columns if c != "k"]
        told = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % len(rows)).alias("k")).join(F.broadcast(known), "k")
        return before(told).select("event_id", *[f(*[F.col(c) for c in names]).cast(kind).alias(c) for c, (f, kind) in out.items()])

    kinds = [kind for _, kind in out.values()]
    values = ", ".join(f"({k}, " + ", ".join(_literal(v, t) for v, t in zip(want, kinds, strict=True)) + ")" for k, (_, want) in enumerate(rows))
    QUERIES[name] = run
    SQL[name] = f"SELECT event_id, {', '.join(f'v."{c}"' for c in out)} FROM events JOIN (VALUES {values}) v(k, {', '.join(f'"{c}"' for c in out)}) ON event_id % {len(rows)} = k"


def one(name: str, f: Callable[[Column], Column], cases: dict, kind: str = "string", given: str = "string") -> None:
    by_hand(name, f"v {given}", {"result": (f, kind)}, [((k,), (w,)) for k, w in cases.items()])


def listed(f: Callable[..., Column]) -> Callable[..., Column]:
    return lambda *c: F.array_join(f(*c), "|", "-")


# Dates, contacts, names and texts.
one("dates_parsed", lambda c: F.date_format(text.parsed_date(c), "yyyy-MM-dd HH:mm:ss"), {"2024-03-05 10:00:00": "2024-03-05 10:00:00", " '2024-03-05' ": "2024-03-05 00:00:00", "05.03.2024 01:02:03": "2024-03-05 01:02:03", "5 March": None, "2024-13-01": None, "": None})
one("verification_dates", lambda c: text.verification_date(c, F.lit("2024-01-01"), F.lit("2025-01-01")), {"": "2024-01-01", "05.03.2024 01:02:03": "2024-03-05", "soon enough": "soon"})
one("lists_cleaned", listed(lambda c: text.cleaned_list(F.split(c, ","))), {"a, b ,a,": "a|b", "x": "x", " , ": ""})
one("phones_found", listed(text.phones), {"+7 (495) 123-45-67 or 8 495 1234567": "+7 (495) 123-45-67", "none": ""})
one("phones_toll_free", text.toll_free, {"8 800 555": True, "+7 800 1": True, "+7 495 1": False}, "boolean")
one("phones_best", listed(lambda c: text.best_phones(c, {"завод": 1, "отдел": 2})), {"отдел: 8 (800) 1-1, +7 2, завод: 8-800-1-1": "8-800-1-1|+7 2", "+7 1, +7 2, +7 3, +7 4, +7 5": "+7 1|+7 2|+7 3|+7 4"})
one("emails_found", listed(text.emails), {"A@b.ru, a@B.ru c@d.com": "A@b.ru|c@d.com", "no mail": ""})
one("head_offices", lambda c: text.head_office(F.split(c, ";")), {"склад;Головной офис: Мира 1": "Мира 1", ";  x ": "  x ", "Head office - 5th Av;y": "5th Av", "a;b": "a"})
one("address_keys", text.address_key, {"123456, ул. Мира, д. 5": "улица мира дом 5", "пр-т. Ленина": "проспект ленина", None: ""})
one("regions", text.region, {"г. Тула, ул. Мира": "Тула", "Тульская область, Тула": "Тульская область", "Москва": "Москва", "nowhere": None})
one("card_texts", text.card_text, {"10 x 20 * 30 m^2 ____________": "10×20×30 m^2 ___"})
one("superscripts", text.superscripts, {"m^{2}, 10^3": "m², 10³"})
one("values_separated", text.separated, {"a, b (c, d), 1,5": "a; b (c, d); 1,5"})
one("prices_as_text", text.price, {"12.0": "12", "12.50": "12.50", " 7 ": "7"})
one("retry_after", lambda c: text.retry_after(c, F.lit("2024-01-01 00:00:00").cast("timestamp")), {"120": 120.0, "Mon, 01 Jan 2024 00:01:00 GMT": 60.0, "Sun, 31 Dec 2023 00:00:00 GMT": 0.0}, "double")
one("http_statuses", text.http_status, {"HTTP 404 at": 404, "status_code=503": 503, "none": None}, "int")
one("symbols_plain", text.plain_symbols, {"10×20 ≥ 5": "10x20 >= 5", "«a» – b…": '"a" - b...'})
by_hand("subitem_values", "field string, value string", {"result": (text.subitems, "string")}, [
    (("Время, с: — для главных; — для малых", "3 1"), ("3; 1",)), (("Время: — a – b", "10  20 30"), ("10; 20; 30",)), (("Масса", "10 000"), ("10 000",)), (("Дата: a", "07 11"), ("07 11",)),
])
by_hand("spec_lines", "value string, field string", {"result": (lambda v, f: F.array_join(text.spec_lines(v, f), "|"), "string")}, [
    (("10см\nи 5,5кг", "x"), ("10 см|и 5,5 кг",)), (("Р2Р3Р5", None), ("Р2; Р3; Р5",)), (("KTA50G3", "Модель"), ("KTA50G3",)), (("12х20мм А1Б2", "x"), ("12х20 мм А1Б2",)), (("10^33м", "x"), ("10^33м",)), (("", "x"), ("",)), (("5 смен", "x"), ("5 смен",)),
])

# Errors and outcomes of fetches.
one("error_modules", text.error_module, {"PDF: LLM failed": "pdf", "Граф недоступен": "graph", "ошибка скачивания": "files", "docx": "cards", "компании нет": "ai", "Markdown пуст": "text", "сайт завис": "crawler", "Playwright timeout": "crawler", "odd": "other"})
by_hand("fetch_outcomes", "status int, raised string", {"reason": (lambda s, e: text.fetch_outcome(s, e)["reason"], "string"), "retryable": (lambda s, e: text.fetch_outcome(s, e)["retryable"], "boolean")}, [
    ((200, None), ("ok", False)), ((404, None), ("not_found", False)), ((410, None), ("gone", False)), ((408, None), ("timeout", True)), ((429, None), ("rate_limited", True)), ((503, None), ("unavailable", True)), ((401, None), ("blocked", True)),
    ((403, None), ("blocked", True)), ((400, None), ("http_error", False)), ((301, None), ("http_error", False)), ((0, None), ("empty", True)), ((None, None), ("empty", True)), ((None, "asyncio.TimeoutError"), ("timeout", True)),
    ((None, "aiohttp.ClientPayloadError"), ("network_error", True)), ((None, "builtins.ValueError"), ("internal_error", False)),
])
_PAGES = [
    (("<title>404 Not Found</title>",), ("error_page", True, "soft_not_found")), (("<title>Насос 404 мм</title><h1>Модель 404</h1>",), (None, False, "ok")), (("<h1>Ошибка 503</h1>",), ("error_page", False, "unavailable")),
    (("<title>Just a moment...</title>",), ("challenge", False, "blocked")), (("<title>x</title><form id='challenge-form'></form>",), ("challenge", False, "blocked")), (("<p>Service Unavailable</p>",), ("error_page", False, "unavailable")),
    (("<p>page not found " + "words " * 40 + "</p>",), (None, False, "ok")), (("<title>Shop</title><h1>Страница не найдена!</h1>",), ("error_page", True, "soft_not_found")), ((" ",), ("empty", False, "empty")), ((None,), ("empty", False, "empty")),
    (("<title>Доступ запрещён</title>",), ("error_page", False, "unavailable")), (("<title>Статья: not found в логах</title>",), (None, False, "ok")), (("<title>Проверяем браузер…</title>",), ("challenge", False, "blocked")),
]


def _told(pages: DataFrame) -> DataFrame:
    """Pages with what they hold, parsed once for each question."""
    pages = pages.withColumn("s", H.page_signs(F.col("html"))).withColumn("product", H.island_product(F.col("html"))["found"])
    pages = pages.withColumn("problem", text.page_problem(F.col("html"), F.col("s.headings"), F.col("s.visible"), F.col("s.challenge_form")))
    return pages.withColumn("gone", text.soft_not_found(F.col("s.headings"), F.col("product")))


by_hand("page_problems", "html string", {
    "problem": (lambda h: F.col("problem"), "string"), "gone": (lambda h: F.col("gone"), "boolean"),
    "outcome": (lambda h: text.fetch_outcome(F.lit(200), F.lit(None).cast("string"), F.col("problem"), F.col("gone"))["reason"], "string"),
}, _PAGES, _told)
by_hand("challenges", "status int, header string, html string", {"challenge": (lambda s, h, x: text.challenged(s, F.when(h.isNull(), F.create_map().cast("map<string,string>")).otherwise(F.create_map(h, F.lit("1"))), x), "boolean")}, [
    ((200, None, "<p>captcha here</p>"), (False,)), ((200, None, "Checking Your Browser"), (True,)), ((200, None, "Проверяем браузер"), (True,)), ((403, None, ""), (True,)), ((403, None, None), (False,)), ((500, "cf-ray", "x"), (True,)), ((200, "cf-ray", "x"), (False,)),
    ((200, None, "a" * 4000 + "just a moment"), (False,)),
])


def _scored(pages: DataFrame) -> DataFrame:
    pages = pages.withColumn("s", H.page_signs(F.col("html")))
    return pages.withColumn("score", text.content_score(F.col("s.strings"), F.col("s.product_class"), F.col("s.product_type"), F.col("s.product_json")))


by_hand("product_content", "html string", {"score": (lambda h: F.col("score"), "double"), "product": (lambda h: F.col("score") >= 3, "boolean")}, [
    # Any string has a price word, since one of them is the end of a text.
    (("<p>hello</p>",), (2.0, False)), (("<p>Купить</p>",), (4.0, True)), (("<p class='goods'>x</p>",), (3.0, True)), (("<p>Артикул 5</p>",), (3.5, True)), (("<div itemtype='http://schema.org/Product'>x</div>",), (5.0, True)),
    (("<script type='application/ld+json'>{\"@type\": \"Product\"}</script>",), (4.0, True)), (("<div></div>",), (0.0, False)),
], _scored)

# URLs.
_CATALOG = "https://a.ru/%D0%BA%D0%B0%D1%82%D0%B0%D0%BB%D0%BE%D0%B3/"
by_hand("url_roles", "url string, said string", {"category": (lambda u, t: F.col("category"), "string")}, [
    ((_CATALOG, ""), ("product",)), (("https://a.ru/каталог/", ""), ("product",)), (("https://a.ru/", ""), ("main_page",)), (("https://a.ru/contacts", ""), ("contacts",)), (("https://a.ru/%D0%BA%D0%BE%D0%BD%D1%82%D0%B0%D0%BA%D1%82%D1%8B", ""), ("other",)),
    (("https://a.ru/en/x", ""), ("excluded",)), (("https://a.ru/pic.jpg", ""), ("excluded1",)), (("https://a.ru/blog/x", ""), ("excluded2",)), (("https://a.ru/about/dealer", ""), ("distributor",)), (("https://a.ru/buy/x", ""), ("distributor",)),
    (("https://a.ru/price.htm", ""), ("price_list",)), (("https://a.ru/%D0%BF%D1%80%D0%BE%D0%B4%D1%83%D0%BA%D1%86%D0%B8%D1%8F/x/", ""), ("product",)), (("https://a.ru/x", "Прайс"), ("price_list",)),
], lambda df: U.with_category(df, "url", "said")[0])
one("urls_site", U.site_url, {"a.ru": "https://a.ru", "http://b.ru/x": "http://b.ru/x", "no dots": None, "word": None})
one("hrefs_clean", U.clean_href, {" /x ": "/x", "http://a.ru/http://b.ru/y": "http://b.ru/y", "/a": "/a"})
by_hand("urls_absolute", "base string, href string", {"result": (H.absolute_url, "string")}, [(("http://a.ru/b/c", "d"), ("http://a.ru/b/d",)), (("http://a.ru/b", "/x"), ("http://a.ru/x",)), (("http://a.ru/b", "https://c.ru/"), ("https://c.ru/",))])
one("sitemap_kinds", H.sitemap_kind, {"<urlset></urlset>": "urlset", "<sitemapindex/>": "index", "<!DOCTYPE html><html>": "html", "http://a.ru/\n# c\nhttp://b.ru/x": "text", "words": None})
one("redirect_targets", records.redirect_target, {'<meta http-equiv="refresh" content="0; url=/x">': "/x", '<script>window.location.href="/y";</script>': "/y", "<p>": None})

# Ids, records and JSON.
by_hand("ids_valid", "id string", {"result": (lambda c: ids.valid_id(c, "pr"), "boolean")}, [(("pr_" + "0a" * 14,), (True,)), (("pr_1",), (False,)), (("d_" + "0a" * 14,), (False,)), ((None,), (False,))])
one("contacts_grouped", records.grouped_contacts, {"склад: 1, 2, офис: 3, склад: 4": "склад: 1, 4\n2\nофис: 3"})
by_hand("label_signatures", "label string", {"meaning": (lambda c: records.signatures(c)["meaning"], "string"), "unit": (lambda c: records.signatures(c)["unit"], "string")}, [
    (("Масса, кг",), ("масса", "кг")), (("Прочность (МПа)",), ("прочность", "МПа")), (("Цвет",), ("цвет", "")), ((None,), ("", "")),
])
one("fact_keys", records.fact_key, {"• Масса  ＫＧ": "масса kg", None: None})
one("json_pretty", records.pretty, {'{"a": {"b": [1, {"c": 2}]}, "d": null}': "a:\n\tb:\n\t\t- 1\n\t\tc: 2\nd: ", "bad": None})
one("json_renamed", jsonx.renamed({"x": "z"}), {'{"x": 1}': '{"z": 1}', '{"x": 2, "z": 3}': '{"x": 2, "z": 3}', "bad": None})
one("json_priceless", jsonx.without_prices, {'{"a": {"b": 1, "цена": 5}}': '{"a": {"b": 1}}', "[]": "[]", "bad": None})
by_hand("replies_read", "reply string", {"value": (lambda c: jsonx.reply_json(c)["value"], "string")}, [
    (('<think>{"a":0}</think>```json\n{"a": 1,}\n```',), ('{"a": 1}',)), (('so: {"a": "}"} end',), ('{"a": "}"}',)), (('{"a": 1, "a": 2}',), (None,)), (('{"a": 1, "a": 1}',), ('{"a": 1}',)), (("words",), (None,)),
])
one("numeric_features", jsonx.numeric_characteristics, {
    '{"Размер": "390×90x188 мм"}': 3, '{"Масса": "12×3"}': 1, '{"Плотность (ГОСТ 1)": "5"}': 1, '{"Цена": "5"}': 0, '{"Ширина": "RAL 9003"}': 0, '{"Вес": "5 руб"}': 0, '{"Длина": ["1", "2×3"]}': 2, '{"Упаковка": {"Высота": "5"}}': 0, '{"Материал": "Ст3"}': 0,
    '{"Слои": [{"a": "1"}, {"b": "2"}]}': 2, '{"Нити в основе": "Е12×3"}': 0, '{"a": {"b": {"c": 1.5, "d": null}}, "e": []}': 1, '{"ТУ 12": 3, "Туман": 4}': 1, "bad": 0,
}, "int")

one("file_names", text.file_name, {"a/b\\c": "a-b-c", "Ёлка 10×20, м.": "Елка_10х20_м", "5^2 ^x": "5^2_x", "__--": "unnamed", "«Цех»: \"1\"": "Цех_1", "я" * 200: "я" * 127, "a" * 254 + "я": "a" * 254})
one("company_folders", text.company_folder, {"ООО «Ёж» / Ко.": "ООО_Еж_Ко", "": "Неизвестная компания", None: "Неизвестная компания"})
one("model_delays", lambda c: text.model_delay(c, 2.0, F.lit(0.5)), {0: 2.5, 3: 16.5, 5: 60.0}, "double", "int")
_CENSUS = "pages int, cards int, found int, fail double, challenge double, render string, antibot string, alert string"
by_hand("census_verdicts", _CENSUS, {k: (lambda p, c, f, x, h, r, a, al, k=k: quality.census(p, c, f, x, h, r, a, F.array_compact(F.array(al)))[k], "string") for k in ("status", "group", "can_deliver", "problems")}, [
    ((0, 0, 0, 0.0, 0.0, None, None, None), ("Сайт недоступен", "Краулер/доступность", "Нет", "краулер собрал 0 стр. (SPA/JS-рендер или блокировка)")),
    ((2, 0, 0, 0.0, 0.0, None, "none", None), ("Обработан, карточки НЕ получены", "SPA/JS", "Нет", "краулер собрал 2 стр. (SPA/JS-рендер или блокировка)")),
    ((50, 0, 7, 0.0, 0.25, None, "warmup", None), ("Обработан, карточки НЕ получены", "Антибот", "Нет", "антибот-защита (challenge_rate=0.25); 7 товарных стр. найдено, 0 карточек (LLM классифицирует как не-товар / нет ТХ)")),
    ((50, 0, 0, 0.4, 0.0, "browser", None, None), ("Обработан, карточки НЕ получены", "Извлечение", "Нет", "высокая доля сбоев фетча (0.4)")),
    ((50, 10, 40, 0.0, 0.0, None, None, "секция contacts: 0 страниц"), ("Обработан, карточки получены", "Категоризация URL", "Да, с оговорками", "категоризация URL шумит: 40 «товарных» стр. -> 10 карточек; секция contacts: 0 страниц")),
    ((50, 10, 20, 0.0, 0.0, None, None, "other"), ("Обработан, карточки получены", "—", "Да", "—")), ((None, None, None, None, None, None, None, None), ("Сайт недоступен", "Краулер/доступность", "Нет", "краулер собрал 0 стр. (SPA/JS-рендер или блокировка)")),
])

_FIELDS = ("found", "name", "price", "sku", "source")
by_hand("data_islands", "html string", {f"island_{k}": (lambda h, k=k: F.col(f"p.{k}"), "boolean" if k == "found" else "string") for k in _FIELDS} | {"sources": (lambda h: F.array_join("p.sources", "|"), "string")}, [
    (("<script type='application/ld+json'>{\"@type\": \"Product\", \"name\": \"N\", \"offers\": [{\"price\": 5}], \"mpn\": \"m\",}</script>",), (True, "N", "5", "m", "json_ld", "json_ld")),
    (("<script type='application/ld+json'>{\"@graph\": [{\"@type\": \"Organization\", \"name\": \"O\"}, {\"@type\": [\"Offer\"], \"name\": \"P\"}]}</script>",), (False, "P", None, None, "json_ld", "json_ld")),
    (("<script id='__NEXT_DATA__' type='application/json'>{\"a\": [{\"title\": \"T\", \"price\": 7.5}]}</script>",), (True, "T", "7.5", None, "next_data", "next_data|inline_json")),
    (("<script>window.__NUXT__ = {\"d\": {\"name\": \"X}\", \"sku\": \"s1\", \"description\": \"d\"}}; var b = {};</script>",), (True, "X}", None, "s1", "nuxt", "nuxt")),
    (("<script>window.__PRELOADED_STATE__={\"name\": \"Y\", \"params\": 1,}</script>",), (False, "Y", None, None, "initial_state", "initial_state")),
    (("<script type='application/json'>[{\"name\": \"no sign\"}, {\"Name\": \"Z\", \"Price\": 1}]</script>",), (False, None, None, None, "inline_json", "inline_json")),
    (("<script>var a = 1;</script><p>name price</p>",), (False, None, None, None, None, "")), ((None,), (False, None, None, None, None, "")),
], lambda df: df.withColumn("p", H.island_product(F.col("html"))))
