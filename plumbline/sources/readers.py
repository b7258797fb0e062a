"""Scans: site lists, snapshots, logs, page corpora, workbooks, RTF and DOCX texts, profiles; nothing here needs the network."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.arrow import vectorized
from plumbline.functions.text import company_folder
from plumbline.functions.urls import Url, site_url

# Names under which a site list may give its columns; the record of a run.
ALIASES = {"company_id": ["company_id", "manufacturer_id", "id"], "name": ["name", "company_name", "title"], "website": ["website", "url", "site"]}
UPLOAD_ALIASES = {"company_id": ["ID производителя", "id"], "name": ["Наименование", "name"], "website": ["Website", "Сайт", "website"]}
RUN_RECORD = "ts timestamp_ntz, company_id string, name string, website string, kind string, status string, duration_seconds double, statistics struct<products:long,pages:long>, modules map<string,struct<count:long,total:double,median:double,retry:double>>, errors array<string>"


def by_alias(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Logical columns by the first alias that the table has, whatever its case, as strings; null where none is."""
    have = {c.lower(): c for c in reversed(df.columns)}
    pick = lambda names: next((have[n.lower()] for n in names if n.lower() in have), None)
    return df.select(*[(F.col(f"`{c}`").cast("string") if (c := pick(names)) else F.lit(None).cast("string")).alias(k) for k, names in aliases.items()])


def site_list_jdbc(spark: SparkSession, url: str, table: str, company_id: str | None = None, **options: str) -> DataFrame:
    """The site list of a database; an id is pushed down as an equality."""
    df = by_alias(spark.read.format("jdbc").options(url=url, dbtable=table, **options).load(), ALIASES)
    return df.where(F.col("company_id") == company_id) if company_id else df.orderBy("company_id")


def companies(sites: DataFrame, order: str | None = None) -> DataFrame:
    """company_id, name, safe_name, website of rows with a host; a missing id becomes company_<place among rows kept>."""
    kept = sites.withColumn("website", site_url(F.col("website"))).where("website is not null").where(Url(F.col("website")).host != "")
    if order:
        from pyspark.sql import Window as W

        kept = kept.withColumn("__n", F.row_number().over(W.orderBy(order)) - 1)
        kept = kept.withColumn("company_id", F.coalesce(F.nullif(F.trim("company_id"), F.lit("")), F.concat(F.lit("company_"), "__n")))
    return kept.select("company_id", "name", company_folder(F.col("name")).alias("safe_name"), "website")


def workbook(path: str, aliases: dict[str, list[str]] | None = None) -> pd.DataFrame:
    """The first sheet of an .xlsx file as strings, without any library: shared and inline strings, cells by their A1 place. For files that a driver may hold."""
    with zipfile.ZipFile(path) as z:
        rows = sheet_rows(z)
    if not rows:
        return pd.DataFrame()
    head = rows[0]
    out = pd.DataFrame([{h: r.get(c, "") for c, h in head.items()} for r in rows[1:]], columns=list(head.values()), dtype=object)
    if aliases:
        have = {c.lower(): c for c in out.columns}
        out = pd.DataFrame({k: out[c] if (c := next((have[n.lower()] for n in names if n.lower() in have), None)) else None for k, names in aliases.items()})
    return out


def column_number(cell: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", cell)[0]:
        n = n * 26 + ord(c) - 64
    return n


def sheet_rows(z: zipfile.ZipFile) -> list[dict[int, str]]:
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    names = z.namelist()
    shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
    sheet = ET.fromstring(z.read(sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]))
    out = []
    for row in sheet.iter(f"{ns}row"):
        cells = {}
        for c in row.iter(f"{ns}c"):
            v, kind = c.find(f"{ns}v"), c.get("t")
            text = "".join(t.text or "" for t in c.iter(f"{ns}t")) if kind == "inlineStr" else (v.text or "") if v is not None else ""
            cells[column_number(c.get("r"))] = shared[int(text)] if kind == "s" and text else text
        out.append(cells)
    return out


def workbooks(files: DataFrame) -> DataFrame:
    """path, row, cells (map of header to text) of binaryFile rows that are workbooks."""

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    sheet = sheet_rows(z)
                head = sheet[0] if sheet else {}
                rows += [(path, k, {h: r.get(c, "") for c, h in head.items()}) for k, r in enumerate(sheet[1:])]
            yield pd.DataFrame(rows, columns=["path", "row", "cells"])

    return files.select("path", "content").mapInPandas(run, "path string, row int, cells map<string,string>")


def rtf_text(raw: bytes) -> str:
    """The text of an RTF file: cp1251 escapes, \\uN, paragraphs, cells and rows; service groups are skipped."""
    s, out, stack, skip, k, uc = raw.decode("latin-1"), [], [], False, 0, 1
    service = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "themedata", "header", "footer", "generator"}
    token = re.compile(r"\\([a-z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\(.)|([{}])|([^\\{}]+)", re.S)
    drop = 0
    while k < len(s):
        m = token.match(s, k)
        if not m:
            break
        k = m.end()
        word, arg, hexa, symbol, brace, text = m.groups()
        if brace == "{":
            stack.append((skip, uc))
        elif brace == "}":
            skip, uc = stack.pop() if stack else (False, 1)
        elif word in service or symbol == "*":
            skip = True
        elif skip:
            continue
        elif word in ("par", "line", "row"):
            out.append("\n")
        elif word in ("cell", "tab"):
            out.append("\t")
        elif word == "uc":
            uc = int(arg or 1)
        elif word == "u":
            out.append(chr(int(arg) % 65536))
            drop = uc
        elif hexa:
            if drop:
                drop -= 1
            else:
                out.append(bytes([int(hexa, 16)]).decode("cp1251", "replace"))
        elif symbol in ("\\", "{", "}"):
            out.append(symbol)
        elif symbol == "~":
            out.append(" ")
        elif text:
            text = text.replace("\r", "").replace("\n", "")
            out.append(text[drop:])
            drop = max(0, drop - len(text))
    return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def docx_lines(content: bytes) -> str:
    """Paragraphs and table rows of a .docx file, one a line; cells between bars."""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    text = lambda x: "".join(t.text or "" for t in x.iter(f"{ns}t"))
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(f"{ns}body")
    out = []
    for x in body:
        if x.tag == f"{ns}p" and text(x).strip():
            out.append(text(x).strip())
        elif x.tag == f"{ns}tbl":
            out += ["| " + " | ".join(text(c).strip() for c in r.iter(f"{ns}tc")) + " |" for r in x.iter(f"{ns}tr")]
    return "\n".join(out)


@vectorized("string")
def document_text(path: pd.Series, content: pd.Series) -> pd.Series:
    """The text of binaryFile rows by their extension; null for other files."""
    kinds = {".rtf": rtf_text, ".docx": docx_lines}
    return pd.Series([f(c) if (f := kinds.get(Path(p).suffix.lower())) and c is not None else None for p, c in zip(path, content, strict=True)], dtype=object)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """Company records of runs in JSON lines; blank and torn lines are left out."""
    schema = T.StructType([*T._parse_datatype_string(RUN_RECORD).fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).json(path, mode="PERMISSIVE").withColumn("__f", F.input_file_name()).where("_corrupt_record is null").drop("_corrupt_record", "__f")


def latest_run(df: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows of the last run by name."""
    return df.join(F.broadcast(df.agg(F.max(run).alias(run))), run, "left_semi")  # one row


def journal(df: DataFrame, action: str | None = None, company: str | None = None, limit: int = 200) -> DataFrame:
    """The newest entries of an append-only journal, 1 to 2000 of them."""
    if action is not None:
        df = df.where(F.col("action") == action)
    if company is not None:
        df = df.where(F.col("company_id") == company)
    return df.orderBy(F.desc("ts"), F.desc("ord")).limit(min(max(limit, 1), 2000))


def corpus_index(pages: DataFrame) -> DataFrame:
    """domain, folders: the domain of each folder is that of its first page by category, then by file."""
    rank = F.struct(F.when(F.col("category") == "Product", 0).when(F.col("category") == "Category", 1).otherwise(2).alias("c"), "file")
    first = pages.groupBy("folder").agg(F.min_by("url", rank).alias("url"))
    return first.groupBy(Url(F.col("url")).host.alias("domain")).agg(F.array_sort(F.collect_list("folder")).alias("folders"))


def latest_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of the lexicographically last file of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(key, "__r.*")


def upload_errors(rows: DataFrame) -> DataFrame:
    """row, error of an uploaded list: empty required fields, repeated ids, addresses without scheme (the first five)."""
    n = rows.groupBy("company_id").agg(F.count("*").alias("n")).where("n > 1 and company_id is not null")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    empty = rows.select("row", F.explode(F.array_compact(F.array(*[F.when(blank(c), F.lit(f"{c} is empty")) for c in ("company_id", "name", "website")]))).alias("error"))
    twice = rows.join(n, "company_id").select("row", F.concat(F.lit("company_id repeats: "), "company_id").alias("error"))
    bad = rows.where(~blank("website") & ~F.lower(F.trim("website")).rlike("^https?://")).orderBy("row").limit(5).select("row", F.lit("website has no http").alias("error"))
    return empty.unionAll(twice).unionAll(bad)


def profile_table(folder: str, known: dict[str, type]) -> tuple[list[dict], list[tuple[str, str]]]:
    """Profiles of YAML files, and (file, message) for those that break the schema: unknown keys and wrong types. Files that start with _ are not profiles."""
    import yaml

    good, errors = [], []
    for path in sorted(Path(folder).glob("*.yaml")):
        if path.name.startswith("_"):
            continue
        try:
            data = yaml.safe_load(path.read_text(encoding="utf-8"))
        except yaml.YAMLError as e:
            errors.append((path.name, f"YAML: {e}"))
            continue
        found = [f"{k}: unknown key" for k in data if k not in known] + [f"{k}: {known[k].__name__} expected" for k, v in data.items() if k in known and not isinstance(v, known[k])] if isinstance(data, dict) else ["not a mapping"]
        if found:
            errors += [(path.name, m) for m in found]
        else:
            good.append(data)
    return good, errors


def text_urls(text: Column) -> Column:
    """Addresses of a text sitemap: one a line, without comments."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))


def robots_sitemaps(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1))
