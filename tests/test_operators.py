"""Frame operators on rows worked out by hand."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from plumbline.operators import catalog, dedupe, diff, joins, quality, ranking
from plumbline.sources import readers, sinks


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_diff_with_null_and_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a", 1), (None, "n", 2), (3, "x", 3), (3, "y", 4), (5, None, 5)], "id int, v string, ord int")
    new = spark.createDataFrame([(1, " a ", 1), (None, "m", 2), (3, "y", 3), (4, "z", 4), (5, None, 5)], "id int, v string, ord int")
    d = diff.diff_rows(old, new, ["id"], ["v"], "ord")
    assert {r.id: (r.status, [tuple(c) for c in r.changed]) for r in d.collect()} == {1: ("NO_CHANGES", []), None: ("EDITING", [("v", "n", "m")]), 3: ("NO_CHANGES", []), 4: ("NEW_DATA", [("v", None, "z")]), 5: ("NO_CHANGES", [])}
    back = {r.id: r.status for r in diff.diff_rows(new, old, ["id"], ["v"], "ord").collect()}
    assert back[4] == "DATA_NOT_FOUND" and back[None] == "EDITING"


def test_status_and_escalation(spark):
    c = spark.createDataFrame([(1, None, None, None, None), (2, "2024-01-01", "2024-01-02", "v", "v"), (3, "2024-01-01", "2024-01-02", "v", "w"), (4, "2024-01-02", "2024-01-01", None, "w"), (5, "2024-01-01", "2024-01-02", "", "w"), (6, "bad", None, None, None)], "id int, r string, u string, rv string, dv string")
    got = dict(rows(c.select("id", diff.company_status(F.col("r"), F.col("u"), F.col("rv"), F.col("dv")))))
    assert got == {1: diff.NEW, 2: diff.REPORTED, 3: diff.COMPARE, 4: diff.REPORTED, 5: diff.COMPARE, 6: diff.NEW}
    parents = spark.createDataFrame([(1, diff.SAME), (2, diff.SAME), (3, diff.NEW)], "id int, status string")
    kids = spark.createDataFrame([(1, diff.NEW_DATA), (1, diff.SAME), (2, diff.SAME), (3, diff.SAME)], "id int, status string")
    assert dict(rows(diff.escalated(parents, kids, "id"))) == {1: diff.EDITED, 2: diff.SAME, 3: diff.NEW}
    assert rows(diff.overridden(kids, parents, "id"))[-1] == (3, diff.NEW_DATA)
    h = spark.createDataFrame([(1, "2024-01-01", "2024-02-01"), (2, "2024-02-01", None)], "v int, valid_from string, valid_to string")
    assert rows(diff.as_of(h, F.lit("2024-02-01")), "v") == [(2,)]


def test_dealers(spark):
    d = spark.createDataFrame([(1, "А", "ул. Мира, 5", None), (2, "а", "123456, улица мира 5", "7"), (3, "Б", "", "1"), (4, "Б", None, "2")], "ord int, name string, address string, phone string")
    assert rows(dedupe.dealers_by_address(d, ["name", "address", "phone"]), "ord", "name", "phone") == [(1, "а", "7"), (3, "Б", "1"), (4, "Б", "2")]
    m = spark.createDataFrame([(1, "X", "short", "", "a@x"), (2, "x ", "a longer address", None, ""), (3, "Y", "z", "9", "")], "ord int, name string, address string, phone string, email string")
    assert rows(dedupe.dealers_by_name(m, ["phone", "email"]), "ord", "address", "phone", "email") == [(1, "a longer address", None, "a@x"), (3, "z", "9", None)]
    known = dedupe.new_dealers(d.where("ord = 3"), spark.createDataFrame([], "supplier_id string"))
    assert rows(dedupe.new_dealers(d, known.select("supplier_id")), "ord") == [(1,), (2,)]


def test_joins(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("a", 5, "z"), ("c", 1, "w")], "k string, at int, v string")
    assert rows(joins.as_of_last(left, right, ["k"], "t", "at", "v")) == [("a", 1, None), ("a", 5, "z"), ("b", 9, None)]
    assert rows(joins.as_of_last(left, right, ["k"], "t", "at", "v", F.col("__at") >= F.col("t"))) == [("a", 1, None), ("a", 5, "z"), ("b", 9, None)]
    paths = spark.createDataFrame([("/contacts/branches/x",), ("/contacts",), ("/contactsx",), (None,)], "path string")
    rules = spark.createDataFrame([("/contacts/", "c"), ("/contacts/branches/", "d")], "prefix string, section string")
    assert rows(joins.longest_prefix(paths, rules, "path", "prefix", "section")) == sorted([("/contacts/branches/x", "d"), ("/contacts", "c"), ("/contactsx", None), (None, None)], key=str)
    hosts = spark.createDataFrame([("a.ru",), ("x.b.ru",), ("z.org",), ("al.ru",)], "host string")
    profiles = spark.createDataFrame([("domain", "a.ru", "A"), ("suffix", "ru", "R"), ("suffix", "b.ru", "B"), ("alias", "al.ru", "L"), ("domain", "b.ru", "no")], "kind string, key string, profile string")
    assert rows(joins.profiles_of(hosts, profiles)) == [("a.ru", "A"), ("al.ru", "L"), ("x.b.ru", "B"), ("z.org", "default")]
    c = spark.createDataFrame([(1, "v1"), (2, "v1"), (3, "v2")], "company_id int, version string")
    busy, seen = spark.createDataFrame([(3,)], "company_id int"), spark.createDataFrame([(1, "v1"), (2, "v0")], "company_id int, snapshot string")
    assert rows(joins.reservable(c, busy, seen)) == [(2, "v1")]
    a, b = joins.listed(c, spark.createDataFrame([(1,), (9,)], "company_id int"))
    assert (rows(a), rows(b)) == ([(1, "v1")], [(9,)])


def test_ranks(spark):
    log = spark.createDataFrame([("f", i, t) for i, t in enumerate(["lost", "2024-01-01 00:00:00 a", "  more", "2024-01-01 00:00:01 b"])], "src string, n int, t string")
    assert rows(ranking.log_records(log, "src", "n", "t"), "record", "ts", "n_lines") == [(1, "2024-01-01 00:00:00", 2), (2, "2024-01-01 00:00:01", 1)]
    q = spark.createDataFrame([("s", i, i % 2 == 0) for i in range(1, 13)], "g string, o int, card boolean")
    assert [r.o for r in ranking.quota_with_reserve(q, "g", "o", "card", 8, 0.25).where("admitted").orderBy("o").collect()] == [1, 2, 3, 4, 5, 6, 8, 10]
    e = spark.createDataFrame([("s", i, k) for i, k in enumerate(["take", "take", "take", "release", "take"])], "g string, o int, e string")
    assert [r.admitted for r in ranking.admitted_with_release(e, "g", "o", "e", 2).orderBy("o").collect()] == [True, True, False, None, True]


def test_card_gates(spark):
    reply = {1: {"name": "Кирпич 1", "specifications": {"a": "1", "b": "2", "c": "3"}}, 2: {"error": "Trash_418#"}, 3: {"name": "x", "specifications": {}}, 4: {"name": "x", "specifications": {"a": "1"}}, 5: {"name": "Губка 5", "specifications": {"a": "1", "b": "2", "c": "3"}}, 6: {"name": "1 кирпич", "specifications": {"a": "1", "b": "2", "c": "3"}}}
    pages = spark.createDataFrame([(i, "co", "u", json.dumps(r, ensure_ascii=False)) for i, r in reply.items()] + [(7, "co", "u", "words")], "page_id int, company string, url string, markdown string")
    cards = catalog.product_cards(pages, lambda m: m, ["губка"])
    assert dict(rows(cards, "page_id", "drop_reason")) == {1: None, 2: "not_a_product", 3: "no_specifications", 4: "few_numbers", 5: "excluded_name", 6: "seen", 7: "no_reply"}
    known = cards.where("page_id = 1").select("product_id")
    assert dict(rows(catalog.product_cards(pages, lambda m: m, [], known), "page_id", "drop_reason"))[1] == "known"


def test_specification_tables(spark):
    cells = spark.createDataFrame([(1, 0, 0, "k", True), (1, 0, 1, "v", True), (1, 1, 1, "mm", True), (1, 1, 0, "k", True), (1, 2, 0, "a", False), (1, 2, 1, "5", False)], "t int, row int, col int, text string, header boolean")
    assert rows(catalog.header_paths(cells, ["t"])) == [(1, 0, "k"), (1, 1, "v / mm")]
    assert rows(catalog.described(cells, ["t"])) == [(1, 2, {"k": "a", "v / mm": "5"})]
    assert rows(catalog.transposed(cells), "row", "col", "text")[0] == (0, 0, "k")
    v = spark.createDataFrame([("p", [{"id": "1"}, {"size": "2"}])], "product_id string, variants array<map<string,string>>")
    got = catalog.variants_with_ids(v).first().variants
    assert got[0] == {"id": "1"} and got[1]["id"].startswith("var_") and len(got[1]["id"]) == 28


def test_reports(spark):
    c = spark.createDataFrame([("1", "N", "w", ["", "Головной офис: г. Тула."], "8 1, 8 2", "a@b.ru", "i", "EDITING", "2024-01-02", None, True, 1, None, 3), ("2", "M", "w2", None, None, None, None, "NO_CHANGES", None, "2024-01-01", False, 5, 5, 5), ("", "x", "", None, None, None, None, "", None, None, True, 0, 0, 0)],
        "id string, name string, website string, address array<string>, phones string, emails string, info string, status string, update_date string, upload_date string, represented boolean, n_suppliers int, n_products int, n_files int")
    got = [tuple(r) for r in catalog.general_report(c).collect()]
    assert got == [("2024-01-02", "EDITING", "1", "N", "г. Тула", "8 1, 8 2", "w", "a@b.ru", "Тула", "i", 1, 0, 3), ("2024-01-01", "NO_CHANGES", "2", "M", catalog.NO_OFFICE, "", "w2", "", "", "", 0, 0, 0)]
    ch = spark.createDataFrame([(2, "B", "product", "p", "P", "EDITING"), (1, "A", "file", "f", "F", "NEW_DATA"), (1, "A", "company", "", "", "EDITING"), (1, "A", "product", "q", "Q", "NO_CHANGES")], "company_id int, company string, kind string, child_id string, child string, status string")
    r = catalog.detailed_report(ch.withColumns({k: F.lit("") for k in ("was", "became", "source", "path")}))
    assert [(x[0], x[1], x[5], x[7]) for x in sorted(r.collect())] == [(1, 1, "", ""), (2, 1, "", "f"), (3, 2, "p", "")]


def test_states_and_sinks(spark, tmp_path):
    items = spark.createDataFrame([(1, "reserved"), (2, "sending"), (3, "delivered")], "item_id int, state string")
    moves = spark.createDataFrame([(1, "sending"), (2, "delivered"), (3, "reserved")], "item_id int, to string")
    assert dict(rows(sinks.transition(items, moves))) == {1: "sending", 2: "delivered", 3: "delivered"}
    several = spark.createDataFrame([(1, "sending", 1), (1, "failed", 2), (1, "reserved", 3), (2, "failed", 9), (2, "delivered", 8), (3, "sending", 1)], "item_id int, to string, ord int")
    assert dict(rows(sinks.transition(items, several, "ord"))) == {1: "reserved", 2: "delivered", 3: "delivered"}
    sinks.append_records(spark.createDataFrame([("c", "success")], "company_id string, status string"), str(tmp_path / "runs"), "r1")
    (tmp_path / "runs" / "run_id=r1" / "part-torn.json").write_text('\n{"company_id": "torn')
    got = readers.run_log(spark, str(tmp_path / "runs" / "run_id=r1")).collect()
    assert [(r.company_id, r.status) for r in got] == [("c", "success")]
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(sinks.merged(t, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])) == [(1, "a"), (2, "c"), (3, "d")]
    chunks = spark.createDataFrame([(1, "success"), (1, "failed"), (2, "success")], "company_id int, status string")
    from plumbline.streaming.jobs import chunk_states

    assert rows(chunk_states(chunks), "company_id", "publishable") == [(1, False), (2, True)]


def test_workbooks_rtf_docx(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>ID</t></si><si><t>Web</t><t>site</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="AB1" t="s"><v>1</v></c></row><row><c r="A2"><v>7</v></c><c r="AB2" t="inlineStr"><is><t>a.ru</t></is></c></row></sheetData></worksheet>')
    (tmp_path / "list.xlsx").write_bytes(book.getvalue())
    assert readers.workbook(str(tmp_path / "list.xlsx"), readers.ALIASES).to_dict("records") == [{"company_id": "7", "name": None, "website": "a.ru"}]
    files = spark.read.format("binaryFile").load(str(tmp_path / "list.xlsx"))
    assert [r.cells for r in readers.workbooks(files).collect()] == [{"ID": "7", "Website": "a.ru"}]
    raw = b"{\\rtf1{\\fonttbl{\\f0 Arial;}}\\'cf\\'f0 \\" + b"u1078?\\par a\\{b\\}\\cell}"
    assert readers.rtf_text(raw) == "Пр ж\na{b}\t"
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    doc = io.BytesIO()
    with zipfile.ZipFile(doc, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>one</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc/></w:tr></w:tbl></w:body></w:document>')
    assert readers.docx_lines(doc.getvalue()) == "one\n| a |  |"


def test_site_lists(spark):
    df = readers.by_alias(spark.createDataFrame([(1, "A", "a.ru"), (None, "B", "no"), (None, "C/D", "http://c.ru")], "manufacturer_id int, title string, URL string"), readers.ALIASES)
    assert rows(readers.companies(df.withColumn("o", F.col("name")), "o")) == [("1", "A", "A", "https://a.ru"), ("company_1", "C/D", "CD", "http://c.ru")]
    up = spark.createDataFrame([(1, "x", "n", "http://a"), (2, "x", "", "a.ru")], "row int, company_id string, name string, website string")
    assert rows(readers.upload_errors(up)) == sorted([(2, "name is empty"), (1, "company_id repeats: x"), (2, "company_id repeats: x"), (2, "website has no http")], key=str)


def test_profiles(tmp_path):
    (tmp_path / "a.yaml").write_text("domain: a.ru\nlimits: 3\n")
    (tmp_path / "b.yaml").write_text("domain: 5\nodd: 1\n")
    (tmp_path / "_schema.yaml").write_text("x: 1\n")
    good, errors = readers.profile_table(str(tmp_path), {"domain": str, "limits": int})
    assert good == [{"domain": "a.ru", "limits": 3}] and errors == [("b.yaml", "odd: unknown key"), ("b.yaml", "domain: str expected")]


@pytest.mark.parametrize(("methods", "want"), [({}, None), ({"aiohttp": 2, "playwright": 1}, "html"), ({"dynamic": 2}, "browser")])
def test_render_mode(spark, methods, want):
    df = spark.createDataFrame([(methods,)], "m map<string,int>")
    assert df.select(quality.render_mode(F.col("m"))).first()[0] == want
