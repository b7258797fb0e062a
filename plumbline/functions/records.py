"""Fields of loose records: variants of a key, values as text, grouped contacts, fact keys, nested text, redirects, page fields."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.arrow import vectorized
from plumbline.functions.text import cleaned_list, phone_entries

#: The record of a product.
PRODUCT = T.StructType([T.StructField(n, T.StringType()) for n in ("product_id", "name", "manufacturer", "brand", "article", "category", "description", "application", "advantages", "packaging", "dimensions", "weight", "colors", "warranty", "price", "currency", "url", "source_url")] + [T.StructField("specifications", T.MapType(T.StringType(), T.StringType())), T.StructField("variants", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])


def any_case(m: Column, key: str) -> Column:
    """The value of a map under a key in lower case, with a capital, or in capitals."""
    return F.coalesce(*[F.try_element_at(m, F.lit(k)) for k in (key.lower(), key[:1].upper() + key[1:].lower(), key.upper())])


def first_text(items: Column) -> Column:
    """The first item of a list as text, '' if there is none."""
    return F.coalesce(F.trim(F.try_element_at(items, F.lit(1))), F.lit(""))


def joined(items: Column) -> Column:
    """A list's different values as text: one alone, several by '; '."""
    return F.array_join(cleaned_list(items), "; ")


def map_text(m: Column) -> Column:
    """A map as 'key: value; …' in the order of keys."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "; ")


def grouped_contacts(s: Column) -> Column:
    """'label: a, b' lines of a contact list: numbers by label, labels and numbers in the order of their first place."""
    entries = phone_entries(s)
    labels = F.array_distinct(F.transform(entries, lambda e: e["label"]))

    def line(label: Column) -> Column:
        numbers = F.array_join(F.array_distinct(F.transform(F.filter(entries, lambda e: e["label"] == label), lambda e: e["number"])), ", ")
        return F.when(label == "", numbers).otherwise(F.concat(label, F.lit(": "), numbers))

    return F.array_join(F.transform(labels, line), "\n")


def sections(parts: dict[str, Column]) -> Column:
    """Titled sections with a blank line between them; empty ones are left out."""
    return F.concat_ws("\n\n", *[F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.concat(F.lit(f"{title}:\n"), F.trim(c))) for title, c in parts.items()])


_UNIT = re.compile(r"(?:[\s,]+\(?|\()\s*((?:мм|см|м|кг|г|т|л|мл|шт|МПа|кПа|Па|Вт|кВт|В|А|°[CС]|%)(?:[²³23]|/[\w²³]+)?)\s*\)?\s*$")


def property_signature(label: str | None) -> tuple[str, str]:
    """(meaning, unit) of a property's label."""
    t = unicodedata.normalize("NFKC", label or "").strip()
    m = _UNIT.search(t)
    name = t[: m.start()] if m else t
    return " ".join(re.sub(r"[^\w%]+", " ", name.casefold()).split()), m[1] if m else ""


@vectorized("meaning string, unit string")
def signatures(label: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([property_signature(x) for x in label], columns=["meaning", "unit"])


@vectorized("string")
def fact_key(line: pd.Series) -> pd.Series:
    """A line of facts for comparison: compatible forms, no case, no bullet, single blanks."""
    return pd.Series([None if x is None else " ".join(re.sub(r"^\s*[-–—•*·]\s*", "", unicodedata.normalize("NFKC", x)).casefold().split()) for x in line], dtype=object)


def outline(value, depth: int = 0, most: int = 5) -> str:
    """Nested values as lines, one tab a level; what lies deeper is JSON."""
    pad = "\t" * depth
    if depth >= most and isinstance(value, (dict, list)):
        return pad + json.dumps(value, ensure_ascii=False, sort_keys=True)
    if isinstance(value, dict):
        return "\n".join(f"{pad}{k}:\n{outline(v, depth + 1, most)}" if isinstance(v, (dict, list)) and v else f"{pad}{k}: {'' if v in (None, {}, []) else v}" for k, v in value.items())
    if isinstance(value, list):
        return "\n".join(outline(v, depth, most) if isinstance(v, (dict, list)) else f"{pad}- {v}" for v in value)
    return f"{pad}{value}"


@vectorized("string")
def pretty(text: pd.Series) -> pd.Series:
    def one(t):
        try:
            return outline(json.loads(t)) if t else None
        except ValueError:
            return None

    return pd.Series([one(t) for t in text], dtype=object)


def redirect_target(html: Column) -> Column:
    """Where a page without content sends its reader: a refresh, or a script that only sets the location; else null."""
    refresh = F.regexp_extract(html, r"""(?is)<meta[^>]+http-equiv\s*=\s*["']?refresh["']?[^>]+content\s*=\s*["']?\s*\d+\s*;\s*url\s*=\s*['"]?([^"'>\s]+)""", 1)
    script = F.regexp_extract(html, r"""(?is)<script[^>]*>\s*(?:window\.|document\.|top\.)?location(?:\.href)?\s*=\s*["']([^"']+)["'];?\s*</script>""", 1)
    return F.coalesce(F.nullif(refresh, F.lit("")), F.nullif(script, F.lit("")))


def page_fields(selectors: dict[str, list[str]]):
    """A struct of fields by simple selectors (tag, .class, #id, tag.class, tag[attr=value]): the text of the first element that the first fitting selector finds."""
    from plumbline.functions.html import parse

    def fits(n, selector: str) -> bool:
        m = re.fullmatch(r"([\w-]+)?(?:#([\w-]+))?((?:\.[\w-]+)*)(?:\[([\w-]+)(?:=['\"]?([^'\"\]]*)['\"]?)?\])?", selector)
        if not m:
            raise ValueError(f"not a simple selector: {selector}")
        tag, ident, classes, attr, value = m.groups()
        own = n.attrs.get("class", "").split()
        return (not tag or n.tag == tag) and (not ident or n.attrs.get("id") == ident) and all(c in own for c in classes.split(".") if c) and (not attr or attr in n.attrs and (value is None or n.attrs[attr] == value))

    @vectorized(", ".join(f"`{k}` string" for k in selectors))
    def run(html: pd.Series) -> pd.DataFrame:
        rows = []
        for h in html:
            nodes = list(parse(h).walk())
            rows.append([next((" ".join(n.text().split()) for s in own for n in nodes if n.parent is not None and fits(n, s)), None) for own in selectors.values()])
        return pd.DataFrame(rows, columns=list(selectors), dtype=object)

    return run


def revision(site: Column, stamps: dict[str, str], default: str = "0") -> Column:
    """The extraction revision of a site; what was cached under another one is void."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in stamps.items() for x in p]), site), F.lit(default)) if stamps else F.lit(default)


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """A stand-in for an embedding service, offline and deterministic: signed counts of hashed words."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    at = lambda w: F.pmod(F.xxhash64(w), F.lit(dims))
    sign = lambda w: F.when(F.pmod(F.xxhash64(w, F.lit(1)), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: F.aggregate(words, F.lit(0.0), lambda acc, w: acc + F.when(at(w) == k, sign(w)).otherwise(0.0)).cast("float"))


def exit_code(verdicts) -> int:
    """0 if all criteria pass, 1 with warnings, 2 if one blocks: for a gate on the command line. verdicts: a frame of a few criteria."""
    found = {r[0] for r in verdicts.select("verdict").distinct().collect()}
    return 2 if "BLOCK" in found else 1 if "WARN" in found else 0
