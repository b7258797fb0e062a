"""URL algebra as Columns: parts, hosts, dedupe keys, predicates and the category of a URL. No Python on executors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word lists, patterns and limits that decide a URL's category.
TRACKING_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "fbclid", "gclid", "dclid", "msclkid", "yclid", "_openstat"]
PAGE_LIMITS = {"page": 50, "paging": 50, "offset": 100, "start": 100}
MOBILE_PREFIXES = ["m.", "mobile.", "touch."]
LANGUAGES = ["en", "tr", "de", "fr", "es", "it", "zh", "ja", "ko", "en-us", "en_us", "en_uk", "en-uk", "en_gb", "en-gb", "eng", "trk", "deu", "fra", "esp", "ita", "zho", "jpn", "kor", "uk", "ua", "be", "kk", "az", "ro", "pl", "cs", "sk", "bg", "hu", "fi", "sv", "no", "da", "nl", "pt", "ar", "he", "hi", "th", "vi", "id", "ms", "fil"]
LANGUAGE_SEGMENTS = [x for x in LANGUAGES if x not in ("id", "no")]
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".svg", ".ico", ".tiff", ".tif", ".eps", ".raw"]
IMAGE_PATHS = ["/img_", "/image", "/images/", "/picture", "/pictures/", "/photo", "/photos/", "/gallery", "/thumb", "/thumbnail"]
FILE_PARTS = ["/download/", "/file/", "/attachment/", "/documents/", "pdf"]
PRINT_PATHS = ["/print/", "/print-version/", "/print_page/", "/printview/", "/printable/"]
PRINT_PARAMS, PRINT_VALUES = ["print", "view", "mode", "format", "action"], ["y", "1", "on", "yes", "true", "print"]
CONTACT_WORDS = ["contact", "contacts", "контакты", "company", "requisites", "rekv", "kontaktyi", "ru/kontaktyi", "kontakty"]
DEALER_WORDS = ["distributor", "dealer", "where-to-buy", "где-купить", "дистрибьютор", "дилер", "наши партнеры", "partners", "представительство", "партнеры", "where_to_buy", "predstavitel", "gde-kupit", "gde_kupit", "kupit-v", "tochki-prodazh", "points-of-sale", "salespoints", "partnery", "diler", "представительств", "где купить", "точки продаж"]
PRICE_WORDS = ["price", "прайс", "цены", "ценник", "стоимость", "расценки", "tariff", "тариф", "tseny", "ceny", "pricing", "коммерческое предложение", "commercial offer"]
#: "kabelsku" is one word: the list that decides has no comma there.
PRODUCT_WORDS = ["product", "item", "tovar", "goods", "produkt", "ware", "kabelsku", "model", "modell", "variant", "version", "edition", "kauf", "acquista", "mah", "shop", "sale", "materials", "catalog", "katalog", "magazin", "магазин", "каталог", "production"]
CATEGORY_WORDS = ["category", "catalog", "catalogue", "collection", "kategoriya", "katalog", "series", "серия", "products", "production", "productions", "категория", "каталог", "sale", "produkcija", "produktsiya", "plates", "systems", "dopolnitelnoe-oborudovanie"]
CATALOG_STEMS = ["catalog", "katalog", "product", "produkt", "produkc", "produkts", "tovar", "izdeli", "assortiment", "каталог", "продукц", "товар", "издели", "ассортимент"]
PRODUCT_STEMS = ["продукц", "издели", "товар", "ассортимент", "produkciya", "produkcia", "produkcziya", "produkcija", "produktsiya", "izdeliya", "izdelija", "tovar", "sizes", "razmer", "tiporazmer"]
CATEGORY_STEMS = ["катал", "категор"]
STRONG_PRODUCT = ["product", "products", "tovar", "tovary", "item", "items", "produkt", "produkty", "goods"]
MAIN_PAGES = ["", "index", "main", "home", "главная"]
EXCLUDED = ["service", "services", "news", "article", "articles", "blog", "about", "policy", "delivery", "blogs", "post", "posts", "novosti", "stati", "blogi", "press", "forum", "akcioneram", "objects", "media", "info", "information", "support", "help", "faq", "howto", "guide", "tutorial", "application", "discussion", "comment", "review", "rating", "tag", "otzyv", "files", "applying", "search", "result", "user", "profile", "account", "login", "register", "portfolio", "cart", "checkout", "wishlist", "compare", "admin", "dashboard", "соглашение", "webinar", "reference", "logout", "password", "reset", "subscription", "newsletter", "soglashenie", "uslovija", "reference_materials", "author", "writer", "publication", "publish", "zakaz", "test", "project", "projects", "ne-razobrannoe", "usloviya", "pressa"]
EXACT_ONLY = ["profile", "application", "objects", "files", "media", "test", "reference", "project", "projects"]
ROUTE_KEYS = ["option", "view", "task", "layout", "tmpl", "route", "r", "do", "p", "id"]
SERVICE_SEGMENTS = ["cart", "basket", "korzina", "order", "checkout", "oformlenie", "personal", "auth", "login", "register", "compare", "sravnenie", "eshop_app", "search", "poisk", "sitemap", "sitemaps", "shoppingcart", "shopping-cart", "wishlist"]
FLAT_STOP = [*SERVICE_SEGMENTS, "index", "main", "home", "about", "contacts", "contact", "news", "map", "gb", "price", "faq", "forum", "blog", "info", "help", "glavnaya", "главная", "novosti", "kontakty", "o-nas", "karta-sayta"]
ANCHOR_MARKERS = ["подробнее о товаре", "подробнее о продукте", "подробнее о продукции", "подробнее о материале", "описание товара", "карточка товара", "технические характеристики", "характеристики", "смотреть товар", "перейти к товару"]
PRIORITY = {"product": 9, "category": 8, "main_page": 7, "contacts": 7, "distributor": 7, "price_list": 6, "other": 1}
PRODUCT_QUERY = r"(?:^|[?&])(?:p|product|tovar|item|goods|prod)_?id=\d+"
LISTING_QUERY = r"(?:^|[?&])(?:pt_id|c_id|cpath|categoryid|category_id|cat_id|section_id|sectionid|group_id|grp)="
PAGE_QUERY = r"(?:^|&)(?:page|pagen(?:_\d+)?|paging|pg|start|offset)=\d+"
PAGE_PATH = r"/(?:page|pagen|stranica)[-_/]?\d+$"
PRODUCT_URL = [
    r"/(?:product|item|tovar|goods|produkt|sku|art|article|model|purchase|productinfo|productdetail|product-detail|ware|shop|catalog|katalog|magazin|production)/",
    r"/p/\d+", r"/\d+\.html$", r"/\d+$", r"/[a-z0-9-]+-\d+", r"_[a-z0-9]{6,}", r"/[a-z]{2,}\d{3,}", r"/\?product=", r"/buy/[a-z0-9-]+", r"/\w+/\d+-\w+", r"/\w+/\w+-\d+", r"/[a-z0-9-]+/[a-z0-9-]+$", r"/produktsiya/[^/]+/[^/]+/?$",
]


def _group(url: Column, pattern: str, n: int = 1) -> Column:
    return F.regexp_extract(url, pattern, n)


_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"


@dataclass
class Url:
    """The parts of a URL column, each a Column: lazily written into the plan, evaluated in the JVM."""

    url: Column
    scheme: Column = field(init=False)
    netloc: Column = field(init=False)
    path: Column = field(init=False)
    query: Column = field(init=False)
    fragment: Column = field(init=False)

    def __post_init__(self):
        self.url = F.trim(self.url)
        self.scheme = F.lower(_group(self.url, _PARTS, 1))
        self.netloc = _group(self.url, _PARTS, 2)
        self.path, self.query, self.fragment = (_group(self.url, _PARTS, k) for k in (3, 4, 5))

    @property
    def host(self) -> Column:
        """Lower case, without user, port and a final dot."""
        return F.regexp_replace(F.lower(F.regexp_replace(self.netloc, r"^.*@|:\d*$", "")), r"\.$", "")

    @property
    def segments(self) -> Column:
        return F.filter(F.split(F.lower(self.path), "/"), lambda s: s != "")

    @property
    def decoded(self) -> Column:
        """The path without percent signs, in lower case, without final slashes; / for the root. One that can't be decoded stays as written."""
        plain = F.coalesce(F.try_url_decode(F.replace(self.path, F.lit("+"), F.lit("%2B"))), self.path)
        path = F.regexp_replace(F.lower(plain), "/+$", "")
        return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))

    @property
    def names(self) -> Column:
        """The segments of the decoded path."""
        return F.filter(F.split(self.decoded, "/"), lambda s: s != "")

    @property
    def params(self) -> Column:
        """Non-empty parts of the query in order."""
        return F.filter(F.split(self.query, "&"), lambda p: p != "")


_KEPT = ["url", "scheme", "netloc", "path", "query", "fragment"]
_DERIVED = ["host", "segments", "decoded", "names", "params"]


class KeptUrl(Url):
    """The parts of a URL that parsed() has put into a column."""

    host = segments = decoded = names = params = None

    def __init__(self, name: str):
        for part in (*_KEPT, *_DERIVED):
            setattr(self, part, F.col(f"`{name}`.{part}"))


def parsed(df: DataFrame, url: str = "url", name: str = "__url") -> tuple[DataFrame, Url]:
    """df with the parts of a URL column in one more column, taken once a row, and what stands for them in the functions of this module."""
    u = Url(F.col(url))
    df = df.withColumn(f"{name}_raw", F.struct(*[getattr(u, part).alias(part) for part in _KEPT]))
    raw = Url.__new__(Url)
    for part in _KEPT:
        setattr(raw, part, F.col(f"`{name}_raw`.{part}"))
    df = df.withColumn(name, F.struct(*[getattr(raw, part).alias(part) for part in (*_KEPT, *_DERIVED)])).drop(f"{name}_raw")
    return df, KeptUrl(name)


def strip_www(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def desktop_host(host: Column) -> Column:
    return F.regexp_replace(strip_www(host), r"^(?:m|mobile|touch)\.", "")


def registrable_domain(host: Column) -> Column:
    return F.array_join(F.slice(F.reverse(F.slice(F.reverse(F.filter(F.split(strip_www(host), r"\."), lambda p: p != "")), 1, 2)), 1, 2), ".")


def url_depth(u: Url) -> Column:
    return F.size(u.segments)


def param_key(p: Column) -> Column:
    return F.lower(F.substring_index(p, "=", 1))


def normalized(u: Url) -> Column:
    """The dedupe key: host without www, no tracking parameters, the others sorted, no final slash, no fragment. Percent signs stay as written."""
    port = _group(u.netloc, r"(:\d+)$")
    path = F.regexp_replace(u.path, "/+$", "")
    kept = F.filter(u.params, lambda p: ~param_key(p).isin(TRACKING_PARAMS))
    ordered = F.array_join(F.array_sort(kept), "&")
    return F.concat(
        F.when(u.scheme != "", F.concat(u.scheme, F.lit("://"))).otherwise(""), strip_www(u.host), port, F.when(path == "", "/").otherwise(path), F.when(ordered != "", F.concat(F.lit("?"), ordered)).otherwise("")
    )


def scheme_free(key: Column) -> Column:
    return F.regexp_replace(key, r"^(?iu)https?://", "")


def page_over_limit(u: Url) -> Column:
    """Whether a paging parameter names a page beyond its limit."""
    limits = F.create_map(*[x for k, v in PAGE_LIMITS.items() for x in (F.lit(k), F.lit(v))])
    return F.exists(u.params, lambda p: F.when(F.substring_index(p, "=", -1).rlike(r"^\d{1,18}$"), F.substring_index(p, "=", -1).cast("long")) > F.try_element_at(limits, param_key(p)))


def _locale_base(s: Column) -> Column:
    return F.substring_index(F.replace(s, F.lit("_"), F.lit("-")), "-", 1)


def locale_prefix(u: Url) -> Column:
    """The first segment if it looks like a language, else null."""
    first = F.try_element_at(u.segments, F.lit(1))
    return F.when(first.isin(LANGUAGES) | _locale_base(first).isin(LANGUAGES), first)


def foreign_language(u: Url, base_locale: str | None = None) -> Column:
    """Whether the URL is of another language version: sub-domain, first segment, any segment, or language parameter."""
    base = (base_locale or "").replace("_", "-").split("-")[0]
    own = lambda s: (_locale_base(s) == base) if base else F.lit(False)
    labels = F.split(F.substring_index(F.lower(u.netloc), ":", 1), r"\.")
    parts = F.split(F.lower(F.regexp_replace(u.path, "^/+|/+$", "")), "/")
    first = parts[0]
    by_first = (first.isin(LANGUAGES) | (first.contains("-") & F.substring_index(first, "-", 1).isin(LANGUAGES)) | (first.contains("_") & F.substring_index(first, "_", 1).isin(LANGUAGES))) & ~own(first)
    by_rest = F.exists(F.slice(parts, 2, F.size(parts)), lambda s: s.isin(LANGUAGE_SEGMENTS) & ~own(s))
    by_query = F.exists(u.params, lambda p: F.substring_index(p, "=", 1).isin("lang", "language", "locale") & _locale_base(F.lower(F.substring_index(p, "=", -1))).isin(LANGUAGES))
    return F.coalesce(((F.size(labels) >= 3) & labels[0].isin(LANGUAGE_SEGMENTS)) | by_first | by_rest | by_query, F.lit(False))


def _any_in(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def downloadable(u: Url) -> Column:
    """Whether the URL is a file. The extension test of the rules can't fire but for a double dot, so substrings decide."""
    return _any_in(F.lower(u.url), FILE_PARTS) | F.lower(u.path).rlike(r".\.\.(?:pdf|docx?|xlsx?|rtf)$")


def image(u: Url) -> Column:
    low = F.lower(u.url)
    return low.rlike("(?:" + "|".join(e.replace(".", r"\.") for e in IMAGE_EXTENSIONS) + r")(?:$|[?&])") | _any_in(low, IMAGE_PATHS)


def print_version(u: Url) -> Column:
    """Whether the URL is a print version, by path or by a parameter's value."""
    hit = lambda p: F.substring_index(p, "=", 1).isin(PRINT_PARAMS) & F.lower(F.substring_index(p, "=", -1)).isin(PRINT_VALUES)
    return _any_in(F.lower(u.path), PRINT_PATHS) | F.exists(u.params, lambda p: p.contains("=") & hit(p))


def product_query(u: Url) -> Column:
    return F.lower(u.query).rlike(PRODUCT_QUERY)


def listing(u: Url) -> Column:
    """Whether the URL has the form of a listing: paging, a listing parameter, or a last segment without hyphen, digit or extension."""
    query, path, last = F.lower(u.query), F.regexp_replace(F.lower(u.path), "/+$", ""), F.try_element_at(u.segments, F.lit(-1))
    paged = query.rlike(PAGE_QUERY) | path.rlike(PAGE_PATH) | query.rlike(LISTING_QUERY)
    return ~product_query(u) & (paged | F.coalesce(~last.rlike(r"[-.\d]"), F.lit(False)))


def product_card(u: Url, flat_site: Column | None = None) -> Column:
    """Whether the URL has the form of a product card."""
    last = F.try_element_at(u.segments, F.lit(-1))
    base = F.regexp_replace(last, r"\.[^.]*$", "")
    leaf = last.rlike(r"\.(?:htm|html|shtml)$") | (flat_site if flat_site is not None else F.lit(False))
    by_path = F.when(F.size(u.segments) == 1, leaf).when(F.size(u.segments) > 1, base.rlike(r"[-\d]")).otherwise(False)
    return product_query(u) | (~listing(u) & (F.lower(u.query).rlike(r"(?:^|&)[a-z_]*id=\d+") | by_path))


def strong_product_path(u: Url) -> Column:
    """Whether a product segment is followed by another segment."""
    s = u.names
    return F.exists(F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), lambda x: x.isin(STRONG_PRODUCT))


def flat_candidate(u: Url) -> Column:
    """A single slug, or a single .htm, .html or .shtml leaf, that is no service page."""
    s = F.try_element_at(u.names, F.lit(1))
    name = F.regexp_replace(s, r"\.(?:htm|html|shtml)$", "")
    return (F.size(u.names) == 1) & (name != "") & ~name.contains(".") & ~name.isin(FLAT_STOP)


def _hits_excluded(token: Column) -> Column:
    parts = F.split(token, "-")
    return token.isin(EXCLUDED) | ((F.size(parts) > 1) & F.exists(parts, lambda p: p.isin([w for w in EXCLUDED if w not in EXACT_ONLY])))


def excluded_by_words(u: Url) -> Column:
    """Whether a segment, or a parameter's value, is or holds (between hyphens) an excluded word. The host never counts, the last segment counts without extension, values of route keys are skipped."""
    s = u.names
    by_path = F.exists(F.transform(s, lambda x, k: F.when(k == F.size(s) - 1, F.regexp_replace(x, r"\.[^.]*$", "")).otherwise(x)), _hits_excluded)
    by_query = F.exists(F.split(F.lower(u.query), "&"), lambda p: p.contains("=") & ~F.trim(F.substring_index(p, "=", 1)).isin(ROUTE_KEYS) & _hits_excluded(F.substr(p, F.locate("=", p) + 1)))
    return by_path | by_query


def catalog_signal(u: Url, text: Column) -> Column:
    stems = r"(?<![\p{L}\d])(?:" + "|".join(CATALOG_STEMS) + ")"
    return u.decoded.rlike(stems) | F.lower(text).rlike(stems)


def product_score(u: Url, text: Column, flat_site: Column | None = None) -> Column:
    """Points for signs of a product, of the decoded path; 0 where a service segment, a contact word or an excluded word without catalogue signal vetoes."""
    path = u.decoded
    low = F.concat(u.scheme, F.lit("://"), F.lower(u.netloc), path, F.when(u.query != "", F.concat(F.lit("?"), F.lower(u.query))).otherwise(""))
    last = F.try_element_at(u.names, F.lit(-1))
    veto = _any_in(path, CONTACT_WORDS) | F.exists(u.names, lambda s: s.isin(SERVICE_SEGMENTS)) | F.coalesce(F.regexp_replace(last, r"\.[^.]*$", "").isin(SERVICE_SEGMENTS), F.lit(False))
    veto = veto | path.rlike(r"^/(?:index/\d+-\d+|gb|register)(?:/|$)") | F.lower(u.path).rlike(r"(?:list\.php|\.js|\.css|\.json|\.xml)$") | (excluded_by_words(u) & ~catalog_signal(u, text))
    pattern = low.rlike("|".join(PRODUCT_URL)) | path.rlike(r"/\d+-[a-z0-9-]+")
    word = path.rlike(r"(?<![\p{L}\d])(?:" + "|".join(PRODUCT_WORDS) + ")") | F.exists(u.names, lambda s: s.rlike("^(?:" + "|".join(PRODUCT_STEMS) + ")"))
    param = low.rlike("(?:product|item|goods)=") | product_query(u)
    flat = (flat_site if flat_site is not None else F.lit(False)) & flat_candidate(u)
    point = lambda c, w: F.coalesce(c, F.lit(False)).cast("int") * F.lit(float(w))
    total = point(pattern, 2) + point(word, 1.5) + point(low.rlike(r"\d{2,}"), 1) + point(low.rlike(r"/[a-z0-9-]+-\d+[a-z]*/?$"), 1.5) + point(param, 2) + point(_any_in(F.lower(text), ANCHOR_MARKERS), 1.5) + point(flat, 1.5)
    return F.when(F.coalesce(veto, F.lit(False)), 0.0).otherwise(total)


def _role_tests(u: Url, text: Column, base_locale: str | None, language_filter: bool, word_filter: bool) -> dict[str, Column]:
    """What the rules of roles ask more than once, or that is long."""
    where = F.concat(F.lower(u.path), F.when(u.query != "", F.concat(F.lit("?"), F.lower(u.query))).otherwise(""))
    known = lambda c: F.coalesce(c, F.lit(False))
    last = F.coalesce(F.try_element_at(u.names, F.lit(-1)), F.lit(""))
    words = r"(?<![\p{L}\d])(?:" + "|".join(CATEGORY_WORDS) + ")"
    category = where.rlike(words) | text.rlike(words) | F.exists(u.names, lambda s: s.rlike("^(?:" + "|".join(CATEGORY_STEMS) + ")") | (s == "cat")) | F.lower(u.query).rlike(LISTING_QUERY)
    return {
        "language": known(foreign_language(u, base_locale)) if language_filter else F.lit(False),
        "file": known(downloadable(u)),
        "image": known(image(u)),
        "words": known(excluded_by_words(u)),
        "signal": known(catalog_signal(u, text)),
        "main": F.regexp_replace(u.path, "^/+|/+$", "").isin(MAIN_PAGES),
        "contact": _any_in(where, CONTACT_WORDS),
        "dealer": _any_in(where, DEALER_WORDS),
        "price": _any_in(where, PRICE_WORDS) & ~known(strong_product_path(u)),
        "price_last": _any_in(last, PRICE_WORDS),
        "buy": F.array_contains(u.names, "buy"),
        "said_contact": _any_in(text, CONTACT_WORDS),
        "said_dealer": _any_in(text, DEALER_WORDS),
        "said_price": _any_in(text, PRICE_WORDS),
        "category": known(category | F.lower(u.url).rlike("/(?:catalog|category|collection|series|каталог|серия|katalog|products)/")),
    }


def _role(x: dict[str, Column], score: Column, word_filter: bool) -> Column:
    words = x["words"] if word_filter else F.lit(False)
    less = F.when(words, 2).otherwise(0)
    out = lambda name, p=None: F.struct(F.lit(name).alias("category"), (F.lit(PRIORITY.get(name, 0)) if p is None else p).cast("int").alias("priority"))
    lowered = lambda name, by: F.greatest(F.lit(PRIORITY[name]) - by, F.lit(1))
    rules = [
        (x["language"] | x["file"], out("excluded")),
        (x["image"], out("excluded1")),
        (words & (x["dealer"] | x["said_dealer"]), out("distributor")),
        (words & ~x["signal"], out("excluded2")),
        (x["main"], out("main_page")),
        (x["contact"], out("contacts")),
        (x["dealer"] | x["buy"], out("distributor")),
        (x["price"] & x["price_last"], out("price_list")),
        (score >= 1.5, out("product", lowered("product", less))),
        (x["said_contact"], out("contacts")),
        (x["said_dealer"], out("distributor")),
        (x["said_price"], out("price_list")),
        (x["category"], out("category", lowered("category", less))),
        (x["price"], out("price_list", lowered("price_list", F.lit(1)))),
    ]
    chain = F.when(rules[0][0], rules[0][1])
    for when, then in rules[1:]:
        chain = chain.when(when, then)
    return chain.otherwise(out("other"))


def categorized(u: Url, text: Column, *, base_locale: str | None = None, language_filter: bool = True, word_filter: bool = True, flat_site: Column | None = None) -> Column:
    """struct<category, priority>: the first rule that holds decides. The text is that of the link, '' if none.

    Words of contacts, dealers and prices are looked for in the path as written; segments, excluded words, stems and the signs of a product in the
    decoded path. One large expression; over a table, with_category() is faster.
    """
    text = F.lower(F.coalesce(text, F.lit("")))
    x = _role_tests(u, text, base_locale, language_filter, word_filter)
    return _role(x, product_score(u, text, flat_site), word_filter)


def with_category(df: DataFrame, url: str = "url", text: str | None = None, *, base_locale: str | None = None, language_filter: bool = True, word_filter: bool = True, flat_site: Column | None = None) -> tuple[DataFrame, Url]:
    """df with columns category and priority as categorized() tells them, and __url, the URL's parts; each test is made once a row."""
    df, u = parsed(df, url)
    said = F.lower(F.coalesce(F.col(text), F.lit(""))) if text else F.lit("")
    tests = _role_tests(u, said, base_locale, language_filter, word_filter)
    df = df.withColumn("__tests", F.struct(*[c.alias(k) for k, c in tests.items()], product_score(u, said, flat_site).alias("score")))
    x = {k: F.col(f"__tests.{k}") for k in tests}
    role = _role(x, F.col("__tests.score"), word_filter)
    df = df.withColumn("__role", role).withColumns({"category": F.col("__role.category"), "priority": F.col("__role.priority")}).drop("__tests", "__role")
    return df, u


def rejection(u: Url, category: Column, depth_limit: int = 6, base_host: Column | None = None, base_locale: str | None = None) -> Column:
    """Why a URL may not enter the queue: the first reason that holds, null if none."""
    scope = (F.lit(True) if base_host is None else (desktop_host(u.host) == desktop_host(base_host)))
    reasons = [("scope", ~scope), ("depth", url_depth(u) > depth_limit), ("excluded", category.startswith("excluded")), ("language", foreign_language(u, base_locale)), ("pagination", page_over_limit(u)), ("print", print_version(u) & (category == "product")), ("file", downloadable(u))]
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in reasons])


def site_url(text: Column) -> Column:
    """A site's address with https:// where no scheme is written; null without a dot or with blanks."""
    t = F.trim(text)
    full = F.when(t.rlike(r"^(?iu)https?://"), t).otherwise(F.concat(F.lit("https://"), t))
    return F.when((t != "") & ~t.rlike(r"\s") & Url(full).host.contains("."), full)


def clean_href(href: Column) -> Column:
    """A link's target without blanks around it; of two addresses glued together the last."""
    t = F.trim(href)
    return F.when(t.rlike(r"^.+https?://"), F.regexp_extract(t, r"(https?://(?:(?!https?://).)*)$", 1)).otherwise(t)
