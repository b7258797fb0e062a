import os
import random

import pytest

import corpus_pipeline as cp
from plumbline.llm import registry
from plumbline.llm.store import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STEMS = {"aa": "ka to mi ru se na ho".split(), "bb": "strel grund schaft ung keit ver".split()}
SF = "/root/testdata/sf0.001"


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(1)
    path = str(tmp_path_factory.mktemp("sf"))
    items = [(i, prose(rng, "aa", 30) + ". " + prose(rng, "aa", 12) + ".") for i in range(20)]
    boiler, passage = prose(rng, "aa", 9), prose(rng, "aa", 70)
    docs = []
    for i in range(150):
        lang = "aa" if i % 2 else "bb"
        lines = [prose(rng, lang, 40) for _ in range(4)]
        if i % 5 == 0:
            lines.insert(2, boiler)
        if i % 10 == 1:
            lines.append(passage)
        docs.append((i, "\n".join(lines)))
    base = prose(rng, "bb", 400).split()
    for k in range(6):  # near copies on one line, with words put in here and there, so that their lines differ in length
        words = list(base)
        for _ in range(k):
            words.insert(rng.randrange(400), prose(rng, "bb", 1))
        docs.append((200 + k, " ".join(words)))
    docs += [(300, docs[4][1]), (301, "12 34"), (302, None), (303, ""), (400, prose(rng, "aa", 50) + " " + items[3][1] + " " + prose(rng, "aa", 20)), (None, prose(rng, "aa", 60)), (500, prose(rng, "bb", 30)), (500, prose(rng, "bb", 30))]
    docs.append(docs[-1])
    rows = [(i, t, "aa" if i is None or i % 2 else "bb", "s", len(t) if t is not None else None) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, boiler, passage


def test_stages(spark, folder):
    path, given, boiler, passage = folder
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, path), name)
        seen[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda name: sorted(str(r.doc_id) for r in seen[name])
    assert set(ids("language_id")) == {str(i) for i, _ in given} - {"301", "302", "303"}
    assert ids("line_dedup") == ids("language_id")
    texts = {r.doc_id: r.text for r in seen["line_dedup"]}
    assert sum(boiler in t for t in texts.values()) == sum(passage in t for t in texts.values()) == 1 and boiler in texts[0] and passage in texts[1]
    for i, t in given:  # clean documents stay as they are
        if i is not None and i < 150 and i % 5 and i % 10 != 1:
            assert texts[i] == t
    assert texts[300] == "" and all(len(r.text) == r.n_chars for r in seen["line_dedup"])
    near = ids("near_dedup")
    assert near == sorted([*(str(i) for i in range(150)), "200", "300", "400", "None", "500", "500"])
    assert ids("decontaminate") == [x for x in near if x != "400"]
    assert len(seen["bpe"]) == len(seen["decontaminate"]) and all(r.n_tokens >= 0 for r in seen["bpe"])
    whole = cp.run(spark, path).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, seen["bpe"]), key=str)


def test_empty_table(spark, folder):
    path = folder[0]
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, path), name)
        assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_gives_the_same(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({registry.oracle_sql()[name]}) q").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(str, want))
