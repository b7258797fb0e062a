"""Products and reports: the gates from page to card, specification tables, document rules, change report rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.functions import ids, jsonx, text

# Headers of the two reports.
GENERAL = ["Дата проверки сайта", "Наличие изменений на сайте компании производителя", "ID компании производителя", "Наименование компании производителя", "Адрес компании производителя", "Телефоны компании производителя", "Сайт компании производителя", "E-mail компании производителя", "Регион производства", "Информация о компании производителе", "Количество поставщиков", "Количество товаров", "Количество файлов производителя"]
DETAILED = ["п/п изм.", "ID производителя", "Название компании производителя", "ID компании поставщика", "Наименование компании поставщика", "ID товара", "Наименование товара", "ID доп.материала", "Наименование доп. материала", "Было (в нашей БД)", "Стало (на сайте)", "Тип изменения", "Ссылка на источник", "Путь в архиве к файлу"]
NO_OFFICE = "Представительство на территории РФ отсутствует"


def excluded_name(name: Column, words: list[str]) -> Column:
    """Whether a name holds one of some words whole, whatever its case."""
    import re

    kept = [re.escape(w.strip()) for w in words if w.strip()]
    return F.coalesce(name.rlike(r"(?iu)(?<![\p{L}\p{N}_])(?:" + "|".join(kept) + r")(?![\p{L}\p{N}_])"), F.lit(False)) if kept else F.lit(False)


def product_cards(pages: DataFrame, extract: Callable[[Column], Column], excluded: list[str], known: DataFrame | None = None, least_numbers: int = 3) -> DataFrame:
    """Pages (page_id, company, url, markdown) with the card that an extractor gives, and drop_reason, the first that holds; null for cards that stay.

    extract: markdown Column to a Column of JSON replies; any model, or a rule offline. Replies are mended, then pass the gates: no
    reply, not a product, no specifications, too few numbers, excluded name, no id, known id, id seen on an earlier page.
    """
    told = pages.withColumn("r", jsonx.reply_json(extract(F.col("markdown"))))
    json = F.col("r.value")
    told = told.withColumn("name", F.get_json_object(json, "$.name")).withColumn("specifications", F.get_json_object(json, "$.specifications"))
    told = told.withColumn("n_numbers", jsonx.numeric_characteristics(F.col("specifications"))).withColumn("product_id", ids.product_id(F.col("name"), F.col("company")))
    seen = F.lit(False)
    if known is not None:
        told = told.join(known.select(F.col("product_id").alias("__k")).distinct(), F.col("product_id") == F.col("__k"), "left")
        seen = F.col("__k").isNotNull()
    empty = F.coalesce(F.col("specifications").isin("", "{}", "[]"), F.lit(True))
    gates = [("no_reply", json.isNull()), ("not_a_product", F.col("r.trash")), ("no_specifications", empty), ("few_numbers", F.col("n_numbers") < least_numbers), ("excluded_name", excluded_name(F.col("name"), excluded)), ("no_id", F.col("product_id").isNull()), ("known", seen)]
    told = told.withColumn("__why", F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in gates]))
    # The first page of an id by page_id, by a partial aggregate and a join, so that a hot id meets no sort.
    first = told.where("__why is null").groupBy("product_id").agg(F.min("page_id").alias("__first"))
    told = told.join(first, "product_id", "left")
    why = F.coalesce(F.col("__why"), F.when(F.col("page_id") != F.col("__first"), "seen"))
    return told.select("page_id", "company", "url", "name", "product_id", "specifications", "n_numbers", why.alias("drop_reason"))


def second_pass(pages: DataFrame, cards: DataFrame, most: int = 15) -> DataFrame:
    """Pages to try as products in companies without a card: category, price list and other pages, the first of each company."""
    done = cards.where("drop_reason is null").select("company").distinct()
    left = pages.where(F.col("category").isin("category", "price_list", "other")).join(done, "company", "left_anti")
    return left.withColumn("rn", F.row_number().over(W.partitionBy("company").orderBy("page_id"))).where(F.col("rn") <= most).drop("rn")


def variants_with_ids(df: DataFrame, product: str = "product_id", variants: str = "variants") -> DataFrame:
    """Variants (array of maps) with an id where they lack one."""
    entries = lambda v: F.to_json(F.map_from_entries(F.array_sort(F.map_entries(v))))
    filled = F.transform(variants, lambda v: F.when(F.coalesce(F.try_element_at(v, F.lit("id")), F.lit("")) != "", v).otherwise(F.map_concat(F.map_filter(v, lambda k, _: k != "id"), F.create_map(F.lit("id"), ids.variant_id(F.col(product), entries(v))))))
    return df.withColumn(variants, filled)


def spec_layout(df: DataFrame, columns: Column, rows: Column) -> DataFrame:
    """How a specification table is laid out: two columns for one record, horizontal up to seven rows, vertical up to six columns, else in chunks of four."""
    return df.withColumn("layout", F.when(rows == 1, "pairs").when(rows <= 7, "horizontal").when(columns <= 6, "vertical").otherwise("chunks")).withColumn("n_chunks", F.when(F.col("layout") == "chunks", F.ceil(columns / 4)).otherwise(1).cast("int"))


def transposed(cells: DataFrame, key: str = "table") -> DataFrame:
    """Table cells (key, row, col, text) with rows and columns changed."""
    return cells.withColumnsRenamed({"row": "__r", "col": "row"}).withColumnRenamed("__r", "col").select(cells.columns)


def header_paths(cells: DataFrame, by: list[str]) -> DataFrame:
    """by, col, header: the different texts of a column's header rows from the top, joined by ' / '. cells: row, col, text, header."""
    told = cells.where("header").groupBy(*by, "col").agg(F.array_sort(F.collect_list(F.struct("row", "text"))).alias("h"))
    return told.select(*by, "col", F.array_join(F.array_distinct(F.filter(F.transform("h", lambda x: x["text"]), lambda t: t != "")), " / ").alias("header"))


def described(cells: DataFrame, by: list[str]) -> DataFrame:
    """by, row, record: each body row as a map of header to text."""
    heads = header_paths(cells, by)
    body = cells.where("not header and text <> ''").join(heads.withColumnRenamed("header", "h"), [*by, "col"])
    return body.groupBy(*by, "row", "h").agg(F.min_by("text", "col").alias("text")).groupBy(*by, "row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("h", "text")))).alias("record"))


def compact_tables(cells: DataFrame, by: list[str], most_rows: int = 20, least_cols: int = 3) -> DataFrame:
    """Cells without the body rows after the first of long wide tables."""
    size = cells.groupBy(*by).agg(F.countDistinct("row").alias("__rows"), F.countDistinct("col").alias("__cols"), F.min(F.when(~F.col("header"), F.col("row"))).alias("__first"))
    j = cells.join(size, by)
    keep = F.col("header") | (F.col("row") == F.col("__first")) | ~((F.col("__rows") > most_rows) & (F.col("__cols") >= least_cols))
    return j.where(keep).select(cells.columns)


def column_kinds(headers: Column) -> Column:
    """What a column of a source table holds: price, standard, note or value."""
    return F.when(headers.rlike(r"(?iu)цена|стоимость|руб|price|€|\$"), "price").when(headers.rlike(r"(?iu)гост|ту |стандарт|норматив|standard"), "standard").when(headers.rlike(r"(?iu)примечан|комментар|note"), "note").otherwise("value")


def without_document_titles(lines: DataFrame, titles: DataFrame, by: str, line: str = "line", title: str = "title") -> DataFrame:
    """Lines without those that are the title of a linked document, whatever case and blanks."""
    key = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[\s\p{Punct}]+", " "))
    t = titles.select(by, key(F.col(title)).alias("__t")).distinct()
    return lines.withColumn("__t", key(F.col(line))).join(t, [by, "__t"], "left_anti").drop("__t")


def routed_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Labelled lines with the product field that they belong to."""
    field = F.when(F.col(line).rlike(r"(?iu)^\s*(?:применение|область применения)\s*:"), "application").when(F.col(line).rlike(r"(?iu)^\s*(?:упаковка|фасовка|на палл?ете)\s*:"), "packaging").when(F.col(line).rlike(r"(?iu)^\s*(?:цвет[а]?|палитра)\s*:"), "colors").when(F.col(line).rlike(r"(?iu)^\s*(?:гарантия)\s*:"), "warranty").otherwise("description")
    return df.withColumn("field", field).withColumn("value", F.when(F.col("field") != "description", F.trim(F.regexp_replace(line, r"^[^:]*:\s*", ""))).otherwise(F.trim(line)))


def offer_labels(offers: DataFrame, facets: DataFrame) -> DataFrame:
    """Offers' facet codes (map) with the labels of a dictionary (facet, code, label); booleans as да and нет; unknown codes stay."""
    told = offers.select("offer_id", F.explode("codes").alias("facet", "code"))
    named = told.join(facets, ["facet", "code"], "left")
    label = F.coalesce("label", F.when(F.lower("code") == "true", "да").when(F.lower("code") == "false", "нет").otherwise(F.col("code")))
    return named.select("offer_id", "facet", label.alias("label"))


def price_range(df: DataFrame, by: str, price: str) -> DataFrame:
    """by, text: one price, or 'от … до …'."""
    g = df.where(F.col(price).isNotNull()).groupBy(by).agg(F.min(price).alias("a"), F.max(price).alias("b"))
    show = lambda c: F.regexp_replace(F.format_string("%.2f", F.col(c).cast("double")), r"\.?0+$", "")
    return g.select(by, F.when(F.col("a") == F.col("b"), show("a")).otherwise(F.concat(F.lit("от "), show("a"), F.lit(" до "), show("b"))).alias("text"))


def files_to_ship(files: DataFrame, allowed: list[str], convertible: list[str], blocked: list[str]) -> DataFrame:
    """Files (folder, name) that go into an archive: allowed kinds, and originals without a PDF of their name."""
    low = F.lower("name")
    told = files.withColumn("ext", F.regexp_extract(low, r"(\.[^.]+)$", 1)).withColumn("stem", F.regexp_replace(low, r"\.[^.]+$", ""))
    for b in blocked:
        told = told.where(~low.contains(b))
    pdfs = told.where("ext = '.pdf'").select("folder", "stem").distinct()
    plain = told.where(F.col("ext").isin(allowed))
    originals = told.where(F.col("ext").isin([c for c in convertible if c not in allowed])).join(pdfs, ["folder", "stem"], "left_anti")
    return plain.select("folder", "name").unionByName(originals.select("folder", "name"))


def folders_by_id(folders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(company_id, folder) by the number that a folder's name starts with, and ids that several folders have."""
    told = folders.withColumn("company_id", F.nullif(F.regexp_extract("folder", r"^(\d+)_", 1), F.lit(""))).where("company_id is not null")
    n = told.groupBy("company_id").agg(F.count("*").alias("n"))
    return told.join(n.where("n = 1").select("company_id"), "company_id", "left_semi"), n.where("n > 1")


def general_report(c: DataFrame) -> DataFrame:
    """Thirteen columns of companies (id, name, website, address and phones arrays, emails, info, status, update_date, upload_date, represented, n_suppliers, n_products, n_files); rows without id are left out."""
    here = F.coalesce("represented", F.lit(True))
    s = lambda x: F.coalesce(x, F.lit(""))
    only = lambda x: F.when(here, s(x)).otherwise("")
    n = lambda x: F.when(here, F.coalesce(x, F.lit(0))).otherwise(0)
    address = F.regexp_replace(s(text.head_office(F.col("address"))), r"[ .]+$", "")
    cols = [
        text.verification_date(F.col("update_date"), F.col("upload_date"), F.lit("")), F.col("status"), F.col("id"), s(F.col("name")), F.when(here, address).otherwise(NO_OFFICE), only(F.array_join(text.best_phones(F.col("phones"), {}), ", ")), s(F.col("website")),
        only(F.try_element_at(text.emails(F.col("emails")), F.lit(1))), only(text.region(F.array_join("address", ", "))), only(F.col("info")), n(F.col("n_suppliers")), n(F.col("n_products")), n(F.col("n_files")),
    ]
    return c.where(F.coalesce("id", F.lit("")) != "").select(*[x.alias(h) for x, h in zip(cols, GENERAL, strict=True)])


def detailed_report(changes: DataFrame) -> DataFrame:
    """Fourteen columns of changes (company_id, company, kind company/file/supplier/product, child_id, child, was, became, status, source, path), numbered by company, kind and child."""
    place = F.when(F.col("kind") == "company", 0).when(F.col("kind") == "file", 1).when(F.col("kind") == "supplier", 2).otherwise(3)
    # One running number over the whole report: places within a company are ranks, companies' offsets a running sum over companies alone.
    told = changes.where(F.col("status").isin("NEW_COMPANY", "EDITING", "NEW_DATA")).withColumn("__in", F.row_number().over(W.partitionBy("company_id").orderBy(place, "child_id", "was", "became")))
    sizes = told.groupBy("company_id").agg(F.count("*").alias("__n"))
    offsets = sizes.withColumn("__off", F.sum("__n").over(W.orderBy("company_id").rowsBetween(W.unboundedPreceding, -1)))
    told = told.join(offsets.select("company_id", F.coalesce("__off", F.lit(0)).alias("__off")), "company_id")
    at = lambda k, c: F.when(F.col("kind") == k, F.col(c)).otherwise("")
    cols = [F.col("__off") + F.col("__in"), F.col("company_id"), F.col("company"), at("supplier", "child_id"), at("supplier", "child"), at("product", "child_id"), at("product", "child"), at("file", "child_id"), at("file", "child"), F.col("was"), F.col("became"), F.col("status"), F.coalesce("source", F.lit("")), F.coalesce("path", F.lit(""))]
    return told.select(*[x.alias(h) for x, h in zip(cols, DETAILED, strict=True)])


def summary_rows(companies: DataFrame) -> DataFrame:
    """company, website, product: of several brands every website with every product; else one row for each product; an empty row without products."""
    many = F.size("websites") > 1
    sites = F.when(many, F.col("websites")).otherwise(F.slice("websites", 1, 1))
    return companies.select("company", F.explode_outer(sites).alias("website"), "products").select("company", "website", F.explode_outer("products").alias("product"))


def payloads(company: DataFrame, suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """company_id, payload: a company with its suppliers and products as one JSON document."""
    nest = lambda df, name: df.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c != "company_id"]))).alias(name))
    j = company.join(nest(suppliers, "suppliers"), "company_id", "left").join(nest(products, "products"), "company_id", "left")
    return j.select("company_id", F.to_json(F.struct(*[c for c in j.columns])).alias("payload"))


def data_version(payload: Column, explicit: Column) -> Column:
    """The version that data names, else a digest of its canonical JSON."""
    return F.coalesce(F.nullif(explicit, F.lit("")), F.sha2(jsonx.canonical_json(payload), 256))


def page_versions(pages: DataFrame, stored: DataFrame, folder: str) -> DataFrame:
    """pages (url, digest and more) with path and is_new: a page whose url is stored with the same digest, a null one too, keeps the first path there; others get one by their digest."""
    known = stored.groupBy("url", "digest").agg(F.min("path").alias("__path")).withColumnsRenamed({"url": "__url", "digest": "__digest"})
    j = pages.join(known, (pages["url"] == known["__url"]) & pages["digest"].eqNullSafe(known["__digest"]), "left")
    own = F.concat(F.lit(folder.rstrip("/") + "/"), F.sha2(F.concat_ws("\n", "url", F.coalesce("digest", F.lit(""))), 256), F.lit(".html"))
    return j.select(*[pages[c] for c in pages.columns], F.coalesce("__path", own).alias("path"), F.col("__path").isNull().alias("is_new"))
