"""Scalar functions on dates, phones, addresses, file names and card texts as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats, abbreviations in the order in which they apply, replacement characters, words, patterns and units.
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd.MM.yyyy HH:mm:ss"]
ADDRESS_WORDS = [(r"ул\.", "улица"), (r"пр\.", "проспект"), (r"пр-т\.", "проспект"), (r"пер\.", "переулок"), (r"д\.", "дом"), (r"корп\.", "корпус"), (r"стр\.", "строение"), (r"лит\.", "литера"), (",", " "), (r"\.", " "), (r"\s+", " ")]
SYMBOLS = [("×", "x"), ("≥", ">="), ("≤", "<="), ("≠", "!="), ("±", "+/-"), ("°", " град."), ("²", "2"), ("³", "3"), ("–", "-"), ("—", "-"), ("…", "..."), ("«", '"'), ("»", '"'), ("“", '"'), ("”", '"'), ("’", "'"), ("•", "-"), ("\u00a0", " ")]
#: Modules of error texts, the special ones first, by parts of words.
ERROR_MODULES = [
    ("pdf", ["pdf", "конверт", "libreoffice", "soffice"]),
    ("graph", ["граф", "graph"]),
    ("files", ["файл", "скачив", "download"]),
    ("cards", ["карточ", "docx"]),
    ("ai", ["sgr", "llm", "ии", "токен", "aitunnel", "ollama", "litellm", "модел"]),
    ("text", ["markdown", "текст"]),
    ("crawler", ["краул", "crawl", "страниц", "браузер", "playwright", "сайт", "таймаут", "timeout", "завис"]),
]
CHALLENGE_MARKS = ["checking your browser", "cf-browser-verification", "__cf_chl", "just a moment", "attention required", "проверяем браузер", "ddos-guard", "access denied"]
CHALLENGE_HEADING = r"^(?:just a moment|attention required|checking your browser|verify you are human|проверяем браузер|проверка браузера|подтвердите, что вы человек)(?:[.!…]|\s|$)"
ERROR_HEADING = (
    r"^(?:error|ошибка)\s*[: -]?\s*(?:40[0348]|410|429|50[0-4])\s*[.!]?$|"
    r"^(?:(?:error|ошибка)\s*[: -]?\s*)?(?:40[0348]|410|429|50[0-4])\s*[-:–—]?\s*(?:not found|gone|forbidden|bad request|too many requests|internal server error|bad gateway|service unavailable|gateway time.?out|страница не найдена|доступ запрещ[её]н)(?:\b|$)|"
    r"^(?:page not found|not found|access denied|forbidden|service unavailable|bad gateway|internal server error|gateway time.?out|too many requests|страница не найдена|страница удалена|доступ запрещ[её]н|сайт временно недоступен|сайт на техническом обслуживании|технические работы)(?:\s*[.!:|–—-].*)?$"
)
GONE_HEADING = r"^(?:ошибка|error)\s*[: -]?\s*(?:404|410)\s*[.!]?$|^(?:404|410)\s*[-:–—]?\s*(?:not found|gone|страница не найдена|страница удалена)(?:\b|$)|^(?:page not found|not found|gone|страница не найдена|страница удалена)(?:[.!]|$)"
PRICE_TEXT, BUY_TEXT, ATTRIBUTE_TEXT = r"₽|$|€|руб|цена|price|cost|стоимость|сумма", "купить|в корзину|buy|add to cart|cart|корзина", "артикул|sku|art|модель|model|характеристики|specifications|код товара"
NETWORK_ERRORS = r"aiohttp|curl_cffi|playwright|OSError|ConnectionError|ConnectionResetError|ConnectionRefusedError|ConnectionAbortedError|BrokenPipeError|gaierror|SSLError"
NO_RETRY = ["ok", "not_found", "gone", "soft_not_found", "out_of_scope", "internal_error", "http_error"]
UNITS = ["мм", "см", "м", "км", "дм", "мкм", "кг", "г", "т", "л", "мл", "с", "сек", "мин", "ч", "сут", "МПа", "бар", "Вт", "вт", "С", "°С", "м2", "м3", "м²", "м³", "слой", "тн", "г/м2", "г/м²"]
NAME_MARKS = "°º˚∘̊®™«»<>:\"|?*\n\r"


def parsed_date(s: Column) -> Column:
    """A timestamp without zone by the first of three formats that fits, without quotes around it; else null."""
    t = F.trim(F.regexp_replace(F.trim(s), "^[\"']+|[\"']+$", ""))
    tries = [(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$", DATE_FORMATS[0]), (r"^\d{4}-\d\d-\d\d$", DATE_FORMATS[1]), (r"^\d\d\.\d\d\.\d{4} \d\d:\d\d:\d\d$", DATE_FORMATS[2])]
    return F.coalesce(*[F.try_to_timestamp(F.when(t.rlike(p), t), F.lit(f)) for p, f in tries])


def verification_date(update: Column, upload: Column, today: Column) -> Column:
    """The day of the update, else the upload, else today; of a text that is no date its first word."""
    raw = F.coalesce(F.when(F.trim(update) != "", update), F.when(F.trim(upload) != "", upload), today)
    return F.coalesce(F.date_format(parsed_date(raw), "yyyy-MM-dd"), F.substring_index(F.trim(raw), " ", 1))


def cleaned_list(items: Column) -> Column:
    """Without nulls and blanks, trimmed, each once in order."""
    return F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def phone_digits(s: Column) -> Column:
    return F.regexp_replace(s, r"[^\d+]", "")


def toll_free(s: Column) -> Column:
    p = phone_digits(s)
    return p.startswith("8800") | p.startswith("+7800") | F.coalesce(s.rlike(r"8[\s(-]*800"), F.lit(False))


def phone_entries(s: Column) -> Column:
    """array<struct<label, number>> of "label: number, number"."""
    parts = F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")
    entry = lambda x: F.when(x.contains(":"), F.struct(F.trim(F.substring_index(x, ":", 1)).alias("label"), F.trim(F.substr(x, F.locate(":", x) + 1)).alias("number"))).otherwise(F.struct(F.lit("").alias("label"), x.alias("number")))
    return F.transform(parts, entry)


def best_phones(s: Column, ranks: dict[str, int], most: int = 4) -> Column:
    """The numbers of a phone list, best labels first and in order within, each once by its digits, at most four."""
    rank = F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))]) if ranks else F.create_map().cast("map<string,int>")
    ranked = F.transform(phone_entries(s), lambda e, k: F.struct(F.coalesce(F.try_element_at(rank, F.lower(e["label"])), F.lit(99)).alias("r"), k.alias("k"), e["number"].alias("number")))
    ordered = F.array_sort(ranked)
    digits = F.transform(ordered, lambda e: phone_digits(e["number"]))
    firsts = F.filter(ordered, lambda e, k: F.array_position(digits, phone_digits(e["number"])) == k + 1)
    return F.slice(F.transform(firsts, lambda e: e["number"]), 1, most)


def emails(s: Column) -> Column:
    """Addresses in a text, each once by its lower-case form; the first form wins."""
    found = F.regexp_extract_all(s, F.lit(r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"), F.lit(1))
    low = F.transform(found, lambda x: F.lower(x))
    return F.filter(found, lambda x, k: F.array_position(low, F.lower(x)) == k + 1)


def phones(s: Column) -> Column:
    """Numbers in a text, each once by its last ten digits; the first form wins."""
    found = F.transform(F.regexp_extract_all(s, F.lit(r"(\+?\d[\d\s().-]{8,}\d)"), F.lit(1)), lambda x: F.trim(x))
    key = lambda x: F.substring(F.regexp_replace(x, r"\D", ""), -10, 10)
    keys = F.transform(found, key)
    return F.filter(found, lambda x, k: F.array_position(keys, key(x)) == k + 1)


def address_key(s: Column) -> Column:
    """An address for comparison: lower case, no postal index, abbreviations written out in order, single blanks."""
    out = F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"^\d{6}\s*,?\s*", "")
    for pattern, word in ADDRESS_WORDS:
        out = F.regexp_replace(out, pattern, word)
    return F.trim(out)


def region(address: Column) -> Column:
    """The federal subject named in an address, else its city."""
    tries = [(r"((?:Республика|республика)\s+[А-ЯЁ][\p{L}-]+)", 1), (r"([А-ЯЁ][\p{L}-]+\s+(?:область|край|автономный округ|АО))", 1), (r"(?:^|[\s,])г\.\s*([А-ЯЁ][\p{L}-]+)", 1), (r"(?:^|[\s,])(Москва|Санкт-Петербург|Севастополь)(?:$|[\s,])", 1)]
    return F.coalesce(*[F.nullif(F.regexp_extract(F.coalesce(address, F.lit("")), p, n), F.lit("")) for p, n in tries])


def _bytes_cut(s: Column, most: int) -> Column:
    """The longest beginning of at most so many bytes in UTF-8 that cuts no character."""
    cut = F.substring(F.encode(s, "UTF-8"), 1, most)
    whole = F.try_validate_utf8(cut.cast("string"))
    tries = [F.try_validate_utf8(F.substring(F.encode(s, "UTF-8"), 1, most - k).cast("string")) for k in range(1, 4)]
    return F.when(F.octet_length(s) <= most, s).otherwise(F.coalesce(whole, *tries))


def file_name(s: Column, most: int = 255) -> Column:
    """A name for a file: slashes as -, blanks, points and commas as _, signs that names may not hold dropped; runs of _ and - as one, at most so many bytes; unnamed if nothing is left."""
    t = F.translate(s, "\\/ёЁ×", "--еЕх")
    t = F.translate(F.regexp_replace(t, r"\^(?!\d)", ""), NAME_MARKS, "")
    t = F.regexp_replace(F.regexp_replace(F.translate(t, " .,", "___"), "_{2,}", "_"), "-{2,}", "-")
    t = F.regexp_replace(F.regexp_replace(t, "^_+|_+$", ""), "^-+|-+$", "")
    return F.when(t == "", "unnamed").otherwise(_bytes_cut(t, most))


def company_folder(s: Column) -> Column:
    """A company's name as that of a folder."""
    t = F.translate(F.translate(s, "ёЁ", "еЕ"), NAME_MARKS.replace("\n\r", "") + "/\\^", "")
    return F.when(F.coalesce(s, F.lit("")) == "", "Неизвестная компания").otherwise(F.regexp_replace(F.regexp_replace(F.translate(t, " .,", "___"), "_{2,}", "_"), "^_+|_+$", ""))


def plain_symbols(s: Column) -> Column:
    """Symbols that old code pages lack, written in plain characters."""
    out = s
    for a, b in SYMBOLS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def superscripts(s: Column) -> Column:
    """^2, ^{2} and the like as superscript digits."""
    marks = F.regexp_replace(s, r"\^\{?(\d)\}?", "^$1")
    out = marks
    for d, up in zip("0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹", strict=True):
        out = F.replace(out, F.lit("^" + d), F.lit(up))
    return out


def card_text(s: Column) -> Column:
    """Text of a card: dimensions with ×, dots of products, degrees, no data URIs, no long runs of underscores."""
    out = F.regexp_replace(s, r"data:[\w/+.-]+;base64,[A-Za-z0-9+/=]+", "")
    out = F.regexp_replace(out, r"(?<=\d)\s*[xXхХ*]\s*(?=\d)", "×")
    out = F.regexp_replace(out, r"(?<=\d)\s*(?:гр\.|град\.?)\s*[CС]", "°C")
    return F.regexp_replace(out, r"_{4,}", "___")


def separated(s: Column) -> Column:
    """Commas between values as '; ', but not in numbers, brackets or quotes."""
    return F.regexp_replace(s, r"(?<!\d),\s*(?![^()\[\]]*[)\]])|(?<=\d),\s+(?![^()\[\]]*[)\]])", "; ")


def duration(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    return F.when(s >= 3600, F.format_string("%dч %dм %dс", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)).when(s >= 60, F.format_string("%dм %dс", F.floor(s / 60).cast("long"), s % 60)).otherwise(F.format_string("%dс", s))


def error_module(message: Column) -> Column:
    """The module of an error text: the first whose words it holds, else other."""
    low = F.lower(message)
    holds = [(name, [low.contains(w) for w in words]) for name, words in ERROR_MODULES]
    return F.coalesce(*[F.when(reduce(lambda a, b: a | b, tests), name) for name, tests in holds], F.lit("other"))


def http_status(message: Column) -> Column:
    """The HTTP status named in an error text, or null."""
    tries = [r"(?iu)\bHTTP[/ ]?(?:\d\.\d\s+)?([1-5]\d\d)\b", r"(?iu)\bstatus(?:[ _]code)?[ :=]+([1-5]\d\d)\b", r"(?iu)\berror[ :]+([1-5]\d\d)\b"]
    return F.coalesce(*[F.nullif(F.regexp_extract(F.coalesce(message, F.lit("")), p, 1), F.lit("")) for p in tries]).cast("int")


def retry_after(value: Column, now: Column) -> Column:
    """Seconds to wait by a Retry-After header: a number, or the time to an HTTP date; never negative, null if neither."""
    when = F.try_to_timestamp(F.when(value.rlike(r"GMT$"), F.regexp_replace(value, r"^\w{3}, | GMT$", "")), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.greatest(F.coalesce(F.when(F.trim(value).rlike(r"^\d{1,9}(?:\.\d+)?$"), F.trim(value).cast("double")), F.unix_timestamp(when).cast("double") - F.unix_timestamp(now)), F.lit(0.0))


def backoff(attempt: Column, after: Column) -> Column:
    """Seconds before a retry: 2^(attempt+1), 30 at most, or the server's wait if that is longer."""
    return F.greatest(F.least(F.pow(F.lit(2.0), attempt + 1), F.lit(30.0)), F.coalesce(after, F.lit(0.0)))


def model_delay(attempt: Column, base: float = 1.0, chance: Column | None = None) -> Column:
    """Seconds before a model is asked again: base * 2^attempt and a chance part below one, 60 at most."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt) + (F.rand() if chance is None else chance), F.lit(60.0))


def approximate_tokens(s: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(s) / 4).cast("int"))


def price(s: Column) -> Column:
    """A price as text: whole numbers without .0."""
    return F.regexp_replace(F.trim(s), r"^(\d+)\.0+$", "$1")


def fetch_outcome(status: Column, exception: Column, page: Column | None = None, gone: Column | None = None) -> Column:
    """struct<reason, retryable> of a fetch. exception: module and class of what was raised, null if nothing was.

    page: what page_problem says of an answer with status 200; gone: whether it is soft_not_found.
    """
    page, gone = F.lit(None).cast("string") if page is None else page, F.lit(False) if gone is None else gone
    raised = F.when(F.lower(exception).contains("timeout"), "timeout").when(exception.rlike(NETWORK_ERRORS), "network_error").when(exception.isNotNull(), "internal_error")
    seen = F.when(gone, "soft_not_found").when(page == "challenge", "blocked").when(page == "empty", "empty").when(page.isNotNull(), "unavailable").otherwise("ok")
    by_status = (
        F.when(status == 404, "not_found").when(status == 410, "gone").when(status == 408, "timeout").when(status.isNull() | (status == 0), "empty").when(status == 429, "rate_limited")
        .when(status >= 500, "unavailable").when(status.isin(401, 403), "blocked").when(status == 200, seen).otherwise("http_error")
    )
    reason = F.coalesce(raised, by_status)
    return F.struct(reason.alias("reason"), (~reason.isin(NO_RETRY)).alias("retryable"))


def challenged(status: Column, headers: Column, html: Column) -> Column:
    """Whether an answer is an anti-bot challenge; without html it is none."""
    marked = F.lower(F.substring(html, 1, 4000)).rlike("|".join(CHALLENGE_MARKS))
    return F.coalesce(html.isNotNull() & (status.isin(403, 429, 503) | (F.map_contains_key(headers, "cf-ray") & (status != 200)) | marked), F.lit(False))


def page_problem(html: Column, headings: Column, visible: Column, challenge_form: Column) -> Column:
    """challenge, error_page or empty for a page with status 200 that has no content, else null.

    headings: texts of its titles and first headings. Without any, a text of at most 160 characters counts as one. Errors are looked for
    at the beginning of headings alone, so that model numbers are none.
    """
    said = F.when(F.size(headings) > 0, headings).when(F.length(visible) <= 160, F.array(visible)).otherwise(F.array().cast("array<string>"))
    told = F.transform(said, lambda h: F.when(h.rlike("(?iuU)" + CHALLENGE_HEADING), "challenge").when(h.rlike("(?iuU)" + ERROR_HEADING), "error_page"))
    return F.when(F.coalesce(F.trim(html), F.lit("")) == "", "empty").when(challenge_form, "challenge").otherwise(F.try_element_at(F.array_compact(told), F.lit(1)))


def soft_not_found(headings: Column, product: Column) -> Column:
    """Whether a heading says that the page is gone, and the page holds no product data."""
    return ~F.coalesce(product, F.lit(False)) & F.exists(headings, lambda h: h.rlike("(?iuU)" + GONE_HEADING))


def content_score(texts: Column, product_class: Column, product_type: Column, product_json: Column) -> Column:
    """Points of a page's content for being a product's: words of price and of buying (2 each), of attributes (1.5), classes of products (1), microdata and JSON-LD (2 each). It is one from 3 on."""
    point = lambda c, w: F.when(F.coalesce(c, F.lit(False)), w).otherwise(0.0)
    word = lambda p: F.exists(texts, lambda t: t.rlike("(?iu)" + p))
    return point(word(PRICE_TEXT), 2.0) + point(word(BUY_TEXT), 2.0) + point(word(ATTRIBUTE_TEXT), 1.5) + point(product_class, 1.0) + point(product_type, 2.0) + point(product_json, 2.0)


def subitems(field: Column, value: Column) -> Column:
    """A value with blanks between numbers as ; where its field lists several items after a colon."""
    tail = F.when(field.contains(":"), F.substr(field, F.locate(":", field) + 1))
    listed = tail.contains(";") | (F.size(F.regexp_extract_all(tail, F.lit("[—–]"), F.lit(0))) >= 2)
    return F.when(F.coalesce(listed, F.lit(False)), F.regexp_replace(value, r"(?<=\d)[ \t]+(?=\d)", "; ")).otherwise(value)


def spec_lines(value: Column, field: Column) -> Column:
    """The lines of a value as shown in a table: a blank before a unit, joined groups of letter and digits parted by ;, but not in sizes, models and powers."""
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    spaced = F.regexp_replace(value, rf"(?iu)(?<!\^[0-9-]{{0,9}})(\d+(?:[.,]\d+)?)({units})(?![а-яА-Яa-zA-Z0-9])", "$1 $2")
    parted = F.regexp_replace(spaced, r"(?<=[A-Za-zА-Яа-я]\d{1,9})(?=[A-Za-zА-Яа-я]\d)", "; ")
    keep = F.coalesce(field, F.lit("")).rlike("(?iu)модел") | spaced.rlike("[хХxX×]")
    lines = F.filter(F.transform(F.split(F.when(keep, spaced).otherwise(parted), r"\r\n|[\n\r]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(lines) > 0, lines).otherwise(F.array(F.lit("")))


def region_prefix_free(s: Column) -> Column:
    return F.regexp_replace(s, r"^(?iu)(?:центральный офис|головной офис|head office)\s*[:–-]\s*", "")


def head_office(items: Column) -> Column:
    """The contact of the head office, else the first that is not empty."""
    full = F.filter(items, lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    return region_prefix_free(F.coalesce(F.try_element_at(F.filter(full, lambda x: F.lower(x).rlike("центральный офис|головной офис|head office")), F.lit(1)), F.try_element_at(full, F.lit(1))))
