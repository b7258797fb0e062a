"""JSON that models return, and nested values: repair, rename, strip, flatten. What SQL can't walk is done in Arrow batches."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.arrow import vectorized

#: Fixed value: what a model answers for a page that is no product.
TRASH = "Trash_418#"
PRICE_KEY = re.compile(r"(?iu)цен[аыу]|стоимост|прайс|руб|price|cost")


class _Twice(ValueError):
    pass


def _once(pairs):
    out = {}
    for k, v in pairs:
        if k in out and out[k] != v:
            raise _Twice(k)
        out[k] = v
    return out


def _balanced(text: str) -> list[str]:
    """The outermost {...} of a text, longest first; brackets in strings don't count."""
    found, depth, start, quoted, k = [], 0, 0, False, 0
    while k < len(text):
        c = text[k]
        if quoted:
            k += c == "\\"
            quoted = c != '"'
        elif c == '"' and depth:
            quoted = True
        elif c == "{":
            start = k if not depth else start
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if not depth:
                found.append(text[start : k + 1])
        k += 1
    return sorted(found, key=len, reverse=True)


def extract(reply: str | None):
    """(value, None) of the JSON object in a model's reply, or (None, reason). Thoughts and fences are cut, final commas and lone backslashes mended; a key given twice with different values is a failure."""
    text = re.sub(r"(?s)<think>.*?</think>", "", reply or "").strip()
    text = re.sub(r"^```\w*\s*|\s*```$", "", text)
    if not text:
        return None, "empty"
    for candidate in (text, *_balanced(text)):
        mended = re.sub(r",(\s*[}\]])", r"\1", candidate)
        for t in (candidate, mended, re.sub(r'\\(?!["\\/bfnrtu])', r"\\\\", mended)):
            try:
                return json.loads(t, object_pairs_hook=_once), None
            except _Twice as e:
                return None, f"duplicate key: {e}"
            except ValueError:
                continue
    return None, "no JSON"


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False)


@vectorized("value string, error string, trash boolean")
def reply_json(reply: pd.Series) -> pd.DataFrame:
    """The JSON of replies in canonical form, why there is none, and whether it says that the page is no product."""
    rows = []
    for r in reply:
        v, why = extract(r)
        rows.append((None if v is None else canonical(v), why, isinstance(v, dict) and v.get("error") == TRASH))
    return pd.DataFrame(rows, columns=["value", "error", "trash"])


def flatten(value, sep: str = " > ", path: str = "") -> dict[str, str]:
    """Nested objects as one map; lists joined by '; '."""
    if isinstance(value, dict) and value:
        out = {}
        for k, v in value.items():
            out |= flatten(v, sep, f"{path}{sep}{k}" if path else str(k))
        return out
    if isinstance(value, list):
        return {path: "; ".join(canonical(v) if isinstance(v, (dict, list)) else str(v) for v in value)}
    return {path: "" if value is None or value == {} else str(value)}


def flat_specs(sep: str = " > "):
    @vectorized("map<string,string>")
    def run(text: pd.Series) -> pd.Series:
        out = []
        for t in text:
            try:
                v = json.loads(t) if t else {}
            except ValueError:
                v = {}
            out.append(flatten(v, sep) if isinstance(v, dict) and v else {})
        return pd.Series(out, dtype=object)

    return run


def _walk(value, on_key):
    if isinstance(value, dict):
        out = {}
        for k, v in value.items():
            name = on_key(k)
            if name is not None:
                name = k if name in out or (name != k and name in value) else name
                out[name] = _walk(v, on_key)
        return out
    return [_walk(v, on_key) for v in value] if isinstance(value, list) else value


def _on_json(on_key):
    @vectorized("string")
    def run(text: pd.Series) -> pd.Series:
        out = []
        for t in text:
            try:
                out.append(None if t is None else canonical(_walk(json.loads(t), on_key)))
            except ValueError:
                out.append(None)
        return pd.Series(out, dtype=object)

    return run


def renamed(names: dict[str, str]):
    """Keys renamed at every depth; a name that is taken keeps the key."""
    return _on_json(lambda k: names.get(k, k))


#: Keys that name a price dropped at every depth.
without_prices = _on_json(lambda k: None if PRICE_KEY.search(k) else k)


def canonical_json(text: Column) -> Column:
    return _on_json(lambda k: k)(text)


# Names of fields that describe no measurable feature, of packaging, of fields with axes, codes and money.
NO_FEATURE = (
    r"\bгост\b|(?:^|\W)ту(?:\W|$)|стандарт|норматив|артикул|модель|код|маркир|марка\s+(?:стали|материала|изделия|полотна|нити)|цвет|ral|гарант|срок\s+(?:хранения|годности|службы|эксплуатации)|хранени|упаков|палл[её]т|фасов|\bтара\b|"
    r"цен[аы]|стоимост|заказ|достав|телефон|адрес|инструкц|услови[яй]|окружающ|наименован|производител|сертификат|единиц[аы] измер"
)
NO_FEATURE_HEAT = r"температур.*(?:монтаж|окружающ|хранени)"
NO_FEATURE_WHOLE = r"металл|материал|покрытие|замасливатель|состав стекла|нд|нтд|примечани[ея]|конструкция|устройство|принцип работы|состав и свойства материала|(?:строка|столбец)\s+\d+"
PACKAGING = r"упаков|палл[её]т|фасов|\bтара\b"
AXES = r"габарит|размер|длин|ширин|высот|dimensions"
STANDARD_NOTE = r"\s*\((?:по\s+)?(?:ГОСТ|ТУ|СТБ|ISO)\b[^)]*\)"
THREAD_FIELD, THREAD_CODE = r"нити\s+в\s+(?:основе|утке)", r"[А-ЯA-Z]+[\d\w(),./×х*+-]+"
MONEY = r"₽|\b(?:руб(?:ль|ля|лей)?|RUB|USD|EUR)\b"
CLASS_CODE = r"\b(?:RAL|Zn|AlZn|RR)\s*\d+\b"
TIMES = r"\s*[×xхXХ*]\s*"


@vectorized("array<struct<inside:array<string>,field:string,values:array<string>>>")
def fields(text: pd.Series) -> pd.Series:
    """The fields of nested JSON in order: the keys of the objects around each, its own key, and its values, several for a list of plain values. None if it isn't JSON."""

    def rows(value) -> list[dict]:
        out, stack = [], [([], "", value)]
        while stack:
            inside, key, v = stack.pop()
            if isinstance(v, dict):
                stack += [([*inside, key], str(k), x) for k, x in reversed(v.items())]
            elif isinstance(v, list) and any(isinstance(x, (dict, list)) for x in v):
                stack += [(inside, key, x) for x in reversed(v)]
            else:
                out.append({"inside": inside, "field": key, "values": [None if x is None else str(x) for x in (v if isinstance(v, list) else [v])]})
        return out

    def one(t):
        try:
            return rows(json.loads(t)) if t else []
        except ValueError:
            return []

    return pd.Series([one(t) for t in text], dtype=object)


def numeric_features(field: Column, value: Column) -> Column:
    """How many numeric features a value of a field gives: the first rule that holds."""
    i = "(?iuU)"
    name = F.trim(F.regexp_replace(field, i + STANDARD_NOTE, ""))
    plain = F.regexp_replace(value, i + CLASS_CODE, "")
    axes = F.size(F.filter(F.split(plain, TIMES), lambda x: x.rlike(r"\d")))
    return (
        F.when(value.isNull() | name.rlike(f"{i}^(?:{NO_FEATURE_WHOLE})$") | name.rlike(i + NO_FEATURE) | name.rlike(i + NO_FEATURE_HEAT), 0)
        .when(name.rlike(f"{i}^(?:{THREAD_FIELD})$") & F.trim(value).rlike(f"{i}^(?:{THREAD_CODE})$"), 0)
        .when(F.concat(name, F.lit(" "), value).rlike(i + MONEY) | ~plain.rlike(r"\d"), 0)
        .when(name.rlike(i + AXES), F.greatest(axes, F.lit(1)))
        .otherwise(1)
    )


def numeric_characteristics(text: Column) -> Column:
    """How many numeric features the JSON of specifications holds; 0 if it isn't JSON. A list of plain values is one feature, packaging is none."""

    def of_field(x: Column) -> Column:
        most = F.array_max(F.transform(x["values"], lambda v: numeric_features(x["field"], v)))
        return F.when(F.exists(x["inside"], lambda k: k.rlike("(?iuU)" + PACKAGING)), 0).otherwise(F.coalesce(most, F.lit(0)))

    return F.aggregate(fields(text), F.lit(0), lambda n, x: n + of_field(x))


def coalesced_keys(text: Column, names: list[str]) -> Column:
    """The first of some keys that a JSON object holds."""
    return F.coalesce(*[F.get_json_object(text, f"$['{n}']") for n in names])


def key_groups(df, map_col: str):
    """keys (sorted), n: maps grouped by their set of keys."""
    return df.groupBy(F.array_sort(F.map_keys(map_col)).alias("keys")).agg(F.count("*").alias("n"))


@vectorized("array<string>")
def chunked(text: pd.Series) -> pd.Series:
    """A text in chunks of at most 40 000 approximate tokens, cut at paragraphs, then at sentences, then hard."""
    most = 160_000

    def one(t):
        out, now = [], ""
        for para in re.split(r"(?<=\n\n)", t or ""):
            for part in [para] if len(para) <= most else re.split(r"(?<=[.!?])\s", para):
                while len(part) > most:
                    out += [now] if now else []
                    now = ""
                    out.append(part[:most])
                    part = part[most:]
                if len(now) + len(part) > most:
                    out.append(now)
                    now = ""
                now += part
        return out + ([now] if now else [])

    return pd.Series([one(t) for t in text], dtype=object)
