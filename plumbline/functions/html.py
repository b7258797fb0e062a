"""HTML to rows by the standard library's parser, in Arrow batches: one parse of a page gives all features that operators ask for."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.arrow import vectorized

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIPPED = {"script", "style", "noscript", "template"}
BLOCKS = {"p", "div", "li", "tr", "section", "article", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "br", "nav", "header", "footer", "main", "dl", "dt", "dd", "pre", "blockquote"}
NOISE = re.compile(r"(?iu)(?:^|[\s_-])(?:ad|ads|advert|banner|cookie|popup|breadcrumbs?|share|social|related|comments?)(?:$|[\s_-])")
VOLATILE_ATTRS = {"nonce", "integrity", "style", "id"}
#: Unicode's space separators (Zs); tabs and line ends are none.
SPACES = "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
FEATURES = """title string, h1 string, lang string, canonical string, og_url string, description string, base string,
 links array<struct<href:string,text:string,pos:int>>, n_links int, n_images int, n_tables int, n_forms int, n_scripts int, n_styles int,
 text string, skeleton string, comparison string, json_ld array<string>, meta map<string,string>, onclick array<string>"""


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.kids, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [k for k in reversed(n.kids) if isinstance(k, Node)]

    def text(self, skip=SKIPPED) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in skip:
                if n.tag in BLOCKS:
                    out.append("\n")
                stack += reversed(n.kids)
        lines = (" ".join(x.split()) for x in "".join(out).split("\n"))
        return "\n".join(x for x in lines if x)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        closes = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}}.get(tag, set())
        while self.at.tag in closes:
            self.at = self.at.parent
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(n)
        if tag not in VOID:
            self.at = n

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.kids.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def skeleton(root: Node, depth: int = 3) -> str:
    """SHA-1 of the tags and classes of the body's upper levels."""
    body = next((n for n in root.walk() if n.tag == "body"), root)
    out, stack = [], [(body, 0)]
    while stack:
        n, d = stack.pop()
        if d:
            out.append(f"{d}:{n.tag}" + "".join("." + c for c in sorted(n.attrs.get("class", "").split())))
        if d < depth:
            stack += [(k, d + 1) for k in reversed(n.kids) if isinstance(k, Node)]
    return hashlib.sha1("|".join(out).encode()).hexdigest()


def comparison_hash(root: Node) -> str:
    """SHA-256 of structure and text without scripts, volatile attributes and tokens."""
    out, stack = [], list(reversed(root.kids))
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            t = " ".join(re.sub(r"\b[0-9a-f]{16,}\b", "#", n).split())
            if t:
                out.append(t)
        elif n.tag not in SKIPPED:
            attrs = sorted((k, " ".join(v.split())) for k, v in n.attrs.items() if k not in VOLATILE_ATTRS and not k.startswith(("data-", "on")))
            out.append(f"<{n.tag} {attrs}>")
            stack += reversed(n.kids)
    return hashlib.sha256("\n".join(out).encode("utf-8", "surrogatepass")).hexdigest()


def features(html: str | None) -> dict:
    root = parse(html)
    out = {"title": None, "h1": None, "lang": None, "canonical": None, "og_url": None, "description": None, "base": None, "links": [], "json_ld": [], "meta": {}, "onclick": []}
    counts = dict.fromkeys(("a", "img", "table", "form", "script", "style"), 0)
    for n in root.walk():
        if n.tag in counts:
            counts[n.tag] += 1
        if n.tag in ("title", "h1") and out[n.tag] is None:
            out[n.tag] = " ".join(n.text(set()).split())
        elif n.tag == "html":
            out["lang"] = n.attrs.get("lang")
        elif n.tag == "base" and out["base"] is None:
            out["base"] = n.attrs.get("href")
        elif n.tag == "link" and "canonical" in n.attrs.get("rel", "").lower().split() and out["canonical"] is None:
            out["canonical"] = n.attrs.get("href")
        elif n.tag == "meta" and (name := n.attrs.get("property") or n.attrs.get("name")):
            out["meta"].setdefault(name.lower(), n.attrs.get("content", ""))
        elif n.tag == "a" and n.attrs.get("href"):
            out["links"].append({"href": n.attrs["href"].strip(), "text": " ".join(n.text().split()), "pos": len(out["links"])})
        elif n.tag == "script" and n.attrs.get("type", "").lower() == "application/ld+json":
            out["json_ld"].append("".join(k for k in n.kids if isinstance(k, str)))
        for name in ("onclick", "data-href", "data-url"):
            v = n.attrs.get(name)
            m = re.search(r"""(?:location(?:\.href)?\s*=\s*|window\.open\()\s*['"]([^'"]+)""", v) if v and name == "onclick" else None
            url = m[1] if m else v if v and name != "onclick" else None
            if url and not re.search(r"(?iu)add.?to.?cart|basket|korzina", url):
                out["onclick"].append(url)
    out["og_url"], out["description"] = out["meta"].get("og:url"), out["meta"].get("description")
    out |= {"n_links": counts["a"], "n_images": counts["img"], "n_tables": counts["table"], "n_forms": counts["form"], "n_scripts": counts["script"], "n_styles": counts["style"]}
    body = next((n for n in root.walk() if n.tag == "body"), root)
    return out | {"text": body.text(), "skeleton": skeleton(root), "comparison": comparison_hash(root)}


def signs(html: str | None) -> dict:
    root = parse(html)
    headings = [" ".join(n.text(set()).split()) for n in root.walk() if n.tag in ("title", "h1")]
    form = classes = kind = data = False
    strings = []
    for n in root.walk():
        a = n.attrs
        strings += [k for k in n.kids if isinstance(k, str)]
        form = form or bool(re.fullmatch(r"(?i)challenge-form|cf-challenge|cf-error-details", a.get("id") or ""))
        kind = kind or "Product" in (a.get("itemtype") or "")
        name = a.get("class") or ""
        classes = classes or "product" in name or "item" in name or bool({"goods", "goods-info"} & set(name.split())) or "data-product" in a
        if n.tag == "script" and a.get("type") == "application/ld+json":
            data = data or any(x in "".join(k for k in n.kids if isinstance(k, str)) for x in ('"Product"', '"product"'))
    return {"headings": headings, "challenge_form": form, "visible": " ".join(root.text().split()), "strings": strings, "product_class": classes or kind, "product_type": kind, "product_json": data}


@vectorized("headings array<string>, challenge_form boolean, visible string, strings array<string>, product_class boolean, product_type boolean, product_json boolean")
def page_signs(html: pd.Series) -> pd.DataFrame:
    """What tells errors, challenges and product pages: titles and first headings, ids of challenges, the text that is seen, all strings, and marks of products."""
    return pd.DataFrame([signs(h) for h in html], columns=["headings", "challenge_form", "visible", "strings", "product_class", "product_type", "product_json"])


@vectorized(FEATURES)
def page_features(html: pd.Series) -> pd.DataFrame:
    """All features of a page as one struct; null counts as empty."""
    return pd.DataFrame([features(h) for h in html], columns=[c.split()[0] for c in re.split(r",\s*(?![^<]*>)", FEATURES.replace("\n", " "))])


def plain_element(html: Column, tag: str) -> Column:
    """The text of the first element written as `<tag>text</tag>`, with neither attributes nor inner tags: spaces at its ends go, other white space stays, and of character references only &lt; &gt; &amp; are read, each once. Empty if there is none, null for a null page. `page_features` reads headings as a browser does."""
    text = F.btrim(F.regexp_extract(html, f"<{tag}>([^<]*)</{tag}>", 1), F.lit(SPACES))
    for reference, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text


def grid(table: Node) -> list[list[str]]:
    """The cells of a table with spans written out; a cell over the whole width of the table is not repeated. Raises ValueError where spans overlap."""
    rows = [n for n in table.walk() if n.tag == "tr" and _owner(n, "table") is table]
    cells: dict[tuple[int, int], str] = {}
    width = 0
    for r, row in enumerate(rows):
        c = 0
        for k in row.kids:
            if not isinstance(k, Node) or k.tag not in ("td", "th"):
                continue
            while (r, c) in cells:
                c += 1
            across, down = (min(max(int(x) if (x := k.attrs.get(a, "1").strip()).isdigit() else 1, 1), 1000) for a in ("colspan", "rowspan"))
            text = " ".join(k.text().split())
            for i in range(r, min(r + down, len(rows))):
                for j in range(c, c + across):
                    if (i, j) in cells:
                        raise ValueError(f"spans overlap at row {i}, column {j}")
                    cells[i, j] = text
            c += across
            width = max(width, c)
    out = [[cells.get((r, c), "") for c in range(width)] for r in range(len(rows))]
    return [row[:1] + [""] * (width - 1) if width > 1 and row[0] and len(set(row)) == 1 and _single(rows[k]) else row for k, row in enumerate(out)]


def _single(row: Node) -> bool:
    return sum(isinstance(k, Node) and k.tag in ("td", "th") for k in row.kids) == 1


def _owner(n: Node, tag: str) -> Node | None:
    n = n.parent
    while n is not None and n.tag != tag:
        n = n.parent
    return n


def table_cells(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, table, row, col, text, header, error: one row for each cell of each table; a table whose spans overlap gives one row with its error."""

    def run(batches):
        for pdf in batches:
            rows = []
            for i, html in zip(pdf[id_col], pdf[html_col], strict=True):
                if not html or "<table" not in html.lower():
                    continue
                for t, n in enumerate(x for x in parse(html).walk() if x.tag == "table"):
                    try:
                        g = grid(n)
                    except ValueError as e:
                        rows.append((i, t, None, None, None, None, str(e)))
                        continue
                    heads = sum(all(isinstance(k, str) or k.tag == "th" for k in r.kids) for r in n.walk() if r.tag == "tr" and _owner(r, "table") is n)
                    rows += [(i, t, r, c, x, r < heads, None) for r, row in enumerate(g) for c, x in enumerate(row)]
            yield pd.DataFrame(rows, columns=[id_col, "table", "row", "col", "text", "header", "error"]).astype({"table": "Int32", "row": "Int32", "col": "Int32", "header": "boolean"})

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInPandas(run, f"`{id_col}` {kind}, table int, row int, col int, text string, header boolean, error string")


def content_score(n: Node) -> int:
    """How much a block looks like content: its text, tables and headings, less its links."""
    tables = heads = links = 0
    for x in n.walk():
        tables += x.tag == "table"
        heads += x.tag in ("h1", "h2", "h3")
        links += x.tag == "a"
    return len(n.text()) + 200 * tables + 50 * heads - 2 * links


def without_noise(root: Node) -> Node:
    """The tree without scripts, navigation, hidden and advertising blocks; changes the tree."""
    for n in list(root.walk()):
        n.kids = [k for k in n.kids if isinstance(k, str) or not (k.tag in SKIPPED | {"nav", "footer", "aside", "form", "iframe"} or NOISE.search(k.attrs.get("class", "")) or re.search(r"display\s*:\s*none", k.attrs.get("style", "")) or "hidden" in k.attrs)]
    return root


def container(root: Node) -> Node:
    """The block of the highest score among main, article, section and div; the body if none has one."""
    found = [n for n in root.walk() if n.tag in ("main", "article", "section", "div")]
    return max(found, key=content_score, default=next((n for n in root.walk() if n.tag == "body"), root))


def to_markdown(n: Node) -> str:
    out: list[str] = []

    def inline(x) -> str:
        if isinstance(x, str):
            return x
        if x.tag in SKIPPED:
            return ""
        inner = "".join(map(inline, x.kids))
        if x.tag in ("b", "strong") and inner.strip():
            return f"**{inner.strip()}**"
        if x.tag == "sup" and inner.strip():
            return f"^{inner.strip()}"
        return inner if x.tag not in BLOCKS else f" {inner} "

    def line(prefix: str, x: Node | str) -> None:
        t = " ".join((inline(x) if isinstance(x, str) else "".join(map(inline, x.kids))).split())
        if t:
            out.append(prefix + t)

    def block(x: Node) -> None:
        if x.tag in SKIPPED:
            return
        if re.fullmatch("h[1-6]", x.tag):
            line("#" * int(x.tag[1]) + " ", x)
        elif x.tag == "li":
            line("- ", x)
        elif x.tag == "table":
            try:
                g = grid(x)
            except ValueError:
                g = []
            for k, row in enumerate(g):
                out.append("| " + " | ".join(c.replace("|", "\\|") for c in row) + " |")
                if k == 0:
                    out.append("|" + " --- |" * len(row))
        elif any(isinstance(k, Node) and (k.tag in BLOCKS - {"br"}) for k in x.kids):
            for k in x.kids:
                block(k) if isinstance(k, Node) else line("", k)
        else:
            line("", x)

    block(n)
    return "\n\n".join(out).replace("|\n\n|", "|\n|")


@vectorized("markdown string, how string, title_added boolean, md_len int")
def page_markdown(html: pd.Series) -> pd.DataFrame:
    """A page's content as Markdown, how it was found, and whether the title had to be put above it; null for an empty page."""
    rows = []
    for h in html:
        if not h or not h.strip():
            rows.append((None, "empty", False, 0))
            continue
        title = features(h)
        root = container(without_noise(parse(h)))
        md, head = to_markdown(root), title["h1"] or title["title"] or ""
        added = bool(head) and not re.search(r"(?m)^# ", md)
        md = f"# {head}\n\n{md}" if added else md
        rows.append((md, root.tag, added, len(md)))
    return pd.DataFrame(rows, columns=["markdown", "how", "title_added", "md_len"])


@vectorized("string")
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """A link's target against its page."""

    def join(b, h):
        try:
            return urljoin(b or "", h) if h is not None else None
        except ValueError:
            return None

    return pd.Series([join(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


@vectorized("name string, description string, price string, currency string, brand string, sku string, source string")
def product_data(html: pd.Series) -> pd.DataFrame:
    """A page's structured product: JSON-LD, else microdata, else OpenGraph; nulls if there is none."""

    def of_json(texts):
        for t in texts:
            try:
                stack = [json.loads(t)]
            except ValueError:
                continue
            while stack:  # depth first, in order
                x = stack.pop()
                if isinstance(x, list):
                    stack += reversed(x)
                elif isinstance(x, dict):
                    if "Product" in (x.get("@type") if isinstance(x.get("@type"), list) else [x.get("@type")]):
                        offer = x.get("offers") or {}
                        offer = offer[0] if isinstance(offer, list) and offer else offer
                        offer = offer if isinstance(offer, dict) else {}
                        brand = x.get("brand")
                        brand = brand.get("name") if isinstance(brand, dict) else brand
                        return [x.get("name"), x.get("description"), offer.get("price"), offer.get("priceCurrency"), brand, x.get("sku"), "json_ld"]
                    stack += reversed(x.values())
        return None

    def one(h):
        f = features(h)
        got = of_json(f["json_ld"])
        if not got:
            props = {}
            root = parse(h)
            if any("schema.org/Product" in n.attrs.get("itemtype", "") for n in root.walk()):
                for n in root.walk():
                    if n.attrs.get("itemprop"):
                        props.setdefault(n.attrs["itemprop"], n.attrs.get("content") or " ".join(n.text().split()))
                got = [*(props.get(k) for k in ("name", "description", "price", "priceCurrency", "brand", "sku")), "microdata"]
        m = f["meta"]
        if not got and m.get("og:type", "").startswith("product"):
            got = [m.get("og:title"), m.get("og:description"), m.get("product:price:amount"), m.get("product:price:currency"), m.get("product:brand"), None, "opengraph"]
        return [None if v is None else re.sub(r"^(\d+)\.0+$", r"\1", str(v)) for v in got] if got else [None] * 7

    return pd.DataFrame([one(h) for h in html], columns=["name", "description", "price", "currency", "brand", "sku", "source"], dtype=object)


# Types of products in JSON-LD, and keys of objects that describe one.
PRODUCT_TYPES = ["product", "offer", "aggregateoffer", "itemlist", "individualproduct"]
NAME_KEYS = ["name", "title", "наименование", "название"]
PRODUCT_KEYS = ["sku", "price", "offers", "characteristics", "specifications", "specs", "артикул", "цена", "характеристики", "properties", "params"]
#: Sources of data in scripts, in the order in which they count, and how their places begin.
STATES = [("nuxt", [r"window\.__NUXT__\s*="]), ("initial_state", [r"window\.__INITIAL_STATE__\s*=", r"window\.__PRELOADED_STATE__\s*="])]


def loose_json(text: str):
    """The JSON value at the beginning of a text, with commas before closing brackets allowed; None if there is none."""
    for t in (text, re.sub(r",\s*([}\]])", r"\1", text)):
        try:
            return json.JSONDecoder().raw_decode(t.lstrip())[0]
        except ValueError:
            pass
    return None


def islands(html: str | None) -> dict[str, list]:
    """Data in a page's scripts, by source: JSON-LD objects of products, the state of page builders, and other JSON."""
    out: dict[str, list] = {k: [] for k in ("json_ld", "next_data", "nuxt", "initial_state", "inline_json")}
    for n in parse(html).walk():
        kind, body = (n.attrs.get("type") or "").lower(), "".join(k for k in n.kids if isinstance(k, str))
        if n.tag != "script":
            continue
        value = loose_json(body) if "json" in kind or n.attrs.get("id") == "__NEXT_DATA__" else None
        if "ld+json" in kind:
            tops = value if isinstance(value, list) else value.get("@graph", [value]) if isinstance(value, dict) else []
            for x in tops if isinstance(tops, list) else []:
                own = x.get("@type") or "" if isinstance(x, dict) else ""
                if {str(t).lower() for t in (own if isinstance(own, list) else [own])} & set(PRODUCT_TYPES):
                    out["json_ld"].append(x)
        elif n.attrs.get("id") == "__NEXT_DATA__" and isinstance(value, dict) and not out["next_data"]:
            out["next_data"].append(value)
        if kind == "application/json" and isinstance(value, (dict, list)):
            out["inline_json"].append(value)
    for name, places in STATES:
        for p in places:
            m = re.search(p + r"[^{]*", html or "")
            value = loose_json(html[m.end() :]) if m else None
            if value and not out[name]:
                out[name].append(value)
    return out


def described_product(value, most_depth: int = 12) -> dict | None:
    """The first object, from the outside in, that has a name and another key of a product."""
    stack = [(value, 0)]
    while stack:
        x, depth = stack.pop()
        if depth > most_depth:
            continue
        if isinstance(x, dict):
            keys = {str(k).lower() for k in x}
            if keys & set(NAME_KEYS) and keys & set(PRODUCT_KEYS):
                return x
        inner = list(x.values()) if isinstance(x, dict) else x if isinstance(x, list) else []
        stack += [(v, depth + 1) for v in reversed(inner)]
    return None


@vectorized("found boolean, name string, price string, currency string, brand string, sku string, description string, specs string, source string, sources array<string>")
def island_product(html: pd.Series) -> pd.DataFrame:
    """The product that a page's scripts describe: of JSON-LD the first, else the first fitting object of the other sources in order. found: it has a name, and a price, features or a description."""

    def one(h):
        data = islands(h)
        sources, got = [k for k, v in data.items() if v], None
        if data["json_ld"]:
            x = data["json_ld"][0]
            offer = x.get("offers") or {}
            offer = (offer[0] if offer else {}) if isinstance(offer, list) else offer
            offer = offer if isinstance(offer, dict) else {}
            brand = x["brand"].get("name") if isinstance(x.get("brand"), dict) else x.get("brand")
            specs = {str(p["name"]): p.get("value", "") for p in x.get("additionalProperty") or [] if isinstance(p, dict) and p.get("name")}
            got = (x.get("name"), offer.get("price"), offer.get("priceCurrency"), brand, x.get("sku") or x.get("mpn"), x.get("description"), specs, "json_ld")
        else:
            for source in ("next_data", "nuxt", "initial_state", "inline_json"):
                x = next((p for p in map(described_product, data[source]) if p), None)
                if x:
                    got = (x.get("name") or x.get("title"), x.get("price"), None, None, x.get("sku") or x.get("article") or x.get("артикул"), x.get("description"), x.get("characteristics") or x.get("properties") or {}, source)
                    break
        if not got:
            return [False, *[None] * 8, sources]
        name, price, currency, brand, sku, description, specs, source = got
        text = [None if v is None else str(v) for v in (name, price, currency, brand, sku, description)]
        return [bool(name and (price is not None or specs or description)), *text, json.dumps(specs, ensure_ascii=False, sort_keys=True), source, sources]

    return pd.DataFrame([one(h) for h in html], columns=["found", "name", "price", "currency", "brand", "sku", "description", "specs", "source", "sources"], dtype=object)


def links_of(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, pos, href, url (absolute), text: one row for each link, without page-internal, script and mail links."""
    f = pages.select(id_col, url_col, page_features(F.col(html_col)).alias("f")).select(id_col, absolute_url(F.col(url_col), F.coalesce("f.base", F.col(url_col))).alias("__b"), F.explode("f.links").alias("l"))
    kept = f.where(~F.col("l.href").rlike(r"^(?iu)(?:#|javascript:|mailto:|tel:)"))
    return kept.select(id_col, F.col("l.pos").alias("pos"), F.col("l.href").alias("href"), absolute_url(F.col("__b"), F.col("l.href")).alias("url"), F.col("l.text").alias("text"))


def sitemap_urls(xml: Column) -> Column:
    """The addresses of a urlset or sitemapindex, whatever its namespace."""
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?is)<(?:\w+:)?loc[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:\w+:)?loc>"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def sitemap_kind(body: Column) -> Column:
    """What a sitemap's body is: xml index, xml urlset, html, text of addresses, or null."""
    head = F.lower(F.substring(F.ltrim(body), 1, 2000))
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))
    return F.when(head.rlike(r"<(?:\w+:)?sitemapindex"), "index").when(head.rlike(r"<(?:\w+:)?urlset"), "urlset").when(head.rlike(r"^(?:<!doctype html|<html)"), "html").when((F.size(lines) > 0) & F.forall(lines, lambda x: x.rlike(r"^https?://\S+$")), "text")
