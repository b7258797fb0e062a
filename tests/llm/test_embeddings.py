import numpy as np

from plumbline.llm.embeddings import embedding_components
from tests.llm.test_simhash import groups

SCHEMA = "vec_id long, embedding array<float>, n string, dim int"


def plain(rows, threshold):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, np.float64)).all() and any(v)]
    links = [(a, b) for x, (a, va) in enumerate(good) for b, vb in good[x + 1 :] if len(va) == len(vb) and va @ vb / np.sqrt((va @ va) * (vb @ vb)) >= threshold]
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return n, groups({i for i, _ in rows if i is not None}, links)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 24))
    rows = [(int(i), (centres[i % 20] + rng.normal(size=24) * (0.1 if i % 3 else 0.02)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] * 24), (2004, [float("inf")] * 24), (2005, [None] + [1.0] * 23), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e30] * 24), (2009, [1e-30] * 24), (2010, [-1.0] * 24)]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA).repartition(3)
    n, comp = plain(rows, 0.95)
    for block in (4096, 64, 16):
        got = embedding_components(df, block=block).collect()
        assert len(got) == len(rows)
        assert {r.vec_id: r.n_links for r in got} == n
        assert {r.vec_id: r.component_id for r in got} == comp
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty_and_null_ids(spark):
    assert embedding_components(spark.createDataFrame([], SCHEMA)).count() == 0
    got = embedding_components(spark.createDataFrame([(None, [1.0, 0.0], "", 0), (1, [1.0, 0.0], "", 0), (1, [1.0, 0.0], "", 0)], SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got if r.vec_id) == [(1, 1, 1, True)] * 2
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
