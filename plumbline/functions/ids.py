"""Stable ids of products, dealers and files as Columns; the hashed strings equal those of canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: punctuation cut from the ends of a name's words.
EDGE = "«»\"“”’'()[]{},.;:!?—–-"
_EDGE_CLASS = "[" + "".join("\\" + c if c in "[]-\\^" else c for c in EDGE) + "]"


def squeezed(s: Column) -> Column:
    """Lower case, single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"\s+", " "))


def name_bag(name: Column) -> Column:
    """The words of a name sorted: lower case, ё as е, × and x as х, edge punctuation cut."""
    plain = F.translate(F.lower(name), "ё×x", "ехх")
    words = F.transform(F.split(F.trim(plain), r"\s+"), lambda w: F.regexp_replace(w, rf"^{_EDGE_CLASS}+|{_EDGE_CLASS}+$", ""))
    return F.array_join(F.array_sort(F.filter(words, lambda w: w != "")), " ")


def _id(prefix: str, text: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, 28))


def json_string(s: Column) -> Column:
    """A JSON string with non-ASCII letters as they are."""
    out = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(name))
    return F.concat(F.lit('"'), out, F.lit('"'))


def product_id(name: Column, manufacturer: Column) -> Column:
    """From the bag of a name's words and the manufacturer; null for a name without words or «Неизвестный товар»."""
    bag = name_bag(name)
    return F.when((bag != "") & (name != "Неизвестный товар"), _id("pr_", F.concat(bag, F.lit("|"), squeezed(manufacturer))))


def product_id_from_url(url: Column, manufacturer: Column) -> Column:
    """From the URL without scheme and final slashes."""
    low = F.regexp_replace(F.trim(F.lower(url)), r"^.*?://", "")
    return _id("pr_", F.concat(F.lit('{"manufacturer": '), json_string(squeezed(manufacturer)), F.lit(', "url": '), json_string(F.regexp_replace(low, "/+$", "")), F.lit("}")))


def dealer_id(name: Column, region: Column) -> Column:
    return _id("d_", F.concat(F.lit('{"name": '), json_string(squeezed(name)), F.lit(', "region": '), json_string(squeezed(region)), F.lit("}")))


def file_id(content: Column, name: Column, size: Column, product: Column) -> Column:
    """From the digest of the first 64 KiB, the name, the size and, if there is one, the product. Names should be ASCII."""
    digest = F.sha2(F.substring(content, 1, 65536), 256)
    owner = F.when(F.coalesce(product, F.lit("")) != "", F.concat(F.lit(', "product_id": '), json_string(product))).otherwise("")
    return _id("f_", F.concat(F.lit('{"content_hash": "'), digest, F.lit('", "file_name": '), json_string(name), F.lit(', "file_size": '), size.cast("string"), owner, F.lit("}")))


def valid_id(s: Column, prefix: str, fallback: bool = True) -> Column:
    return F.coalesce(s.rlike(rf"^{prefix}_(?:[a-f0-9]{{28}}" + (r"|fallback_[a-f0-9]{20}" if fallback else "") + ")$"), F.lit(False))


def variant_id(product: Column, variant_json: Column) -> Column:
    """An id for a variant that has none."""
    return F.concat(F.lit("var_"), F.substring(F.sha2(F.concat(product, F.lit("\n"), variant_json), 256), 1, 24))
