import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions import records as R
from tests.test_functions import column


def test_loose_fields(spark):
    assert column(spark, [{"Name": "a"}, {"NAME": "b", "x": "c"}, {}], lambda c: R.any_case(c, "name"), "map<string,string>") == ["a", "b", None]
    assert column(spark, [[" a ", "b"], [], None], R.first_text, "array<string>") == ["a", "", ""]
    assert column(spark, [["a ", "a", "", "b"]], R.joined, "array<string>") == ["a; b"]
    assert column(spark, [{"b": "2", "a": None}], R.map_text, "map<string,string>") == ["a: ; b: 2"]
    assert column(spark, ["склад: 1, 2, офис: 3, склад: 4"], R.grouped_contacts) == ["склад: 1, 4\n2\nофис: 3"]
    assert column(spark, [" x "], lambda c: R.sections({"A": c, "B": F.lit(" "), "C": c})) == ["A:\nx\n\nC:\nx"]


@pytest.mark.parametrize(("label", "want"), [("Масса, кг", ("масса", "кг")), ("Прочность (МПа)", ("прочность", "МПа")), ("Цвет", ("цвет", "")), (None, ("", ""))])
def test_signatures(label, want):
    assert R.property_signature(label) == want


def test_texts_and_pages(spark):
    assert column(spark, ["• Масса  ＫＧ", None], R.fact_key) == ["масса kg", None]
    assert column(spark, [json.dumps({"a": {"b": [1, {"c": 2}]}, "d": None}), "bad"], R.pretty) == ["a:\n\tb:\n\t\t- 1\n\t\tc: 2\nd: ", None]
    assert column(spark, ['<meta http-equiv="refresh" content="0; url=/x">', '<script>window.location.href="/y";</script>', "<p>"], R.redirect_target) == ["/x", "/y", None]
    fields = R.page_fields({"name": ["h2.title", "h1"], "price": ["[itemprop=price]", "#p"]})
    got = column(spark, ['<h1>One</h1><b id="p">5</b>', '<h1>One</h1><h2 class="a title">Two</h2><i itemprop="price">7</i>', None], fields)
    assert [tuple(r) for r in got] == [("One", "5"), ("Two", "7"), (None, None)]
    v = column(spark, ["one two", "two one", "three"], lambda c: R.hashed_embedding(c, 8))
    assert v[0] == v[1] != v[2] and len(v[0]) == 8
    assert column(spark, ["a.ru", "b.ru"], lambda c: R.revision(c, {"a.ru": "3"})) == ["3", "0"]
    verdicts = spark.createDataFrame([("PASS",), ("WARN",)], "verdict string")
    assert R.exit_code(verdicts) == 1 and R.exit_code(verdicts.limit(0)) == 0
