import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm.langid import Parser, held_out, identify, learn, letters, suffix_automaton

SCHEMA = "doc_id long, text string, lang string, score string"
STEMS = {"aa": "ka to mi ru se na ho".split(), "bb": "strel grund schaft ung keit ver".split(), "cc": "tion ement eau oux ique ais".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def plain_phrases(sample, x):
    """Greedy longest matches in the sample; a symbol that is not in it is a phrase."""
    n, k = 0, 0
    while k < len(x):
        size = 1
        while k + size < len(x) and x[k : k + size + 1] in sample:
            size += 1
        n, k = n + 1, k + size
    return n


def test_phrases_against_a_plain_parse():
    rng = random.Random(1)
    raw = {k: text(rng, k, 120) for k in STEMS}
    tests = [text(rng, rng.choice(list(STEMS)), rng.randint(1, 60)) + rng.choice(["", " qqq", "é"]) for _ in range(60)] + ["", "q"]
    tests += [raw["aa"] + raw["bb"][:200], raw["cc"][100:], "qq" * 300]  # phrases over several blocks
    show = lambda a: "".join(map(chr, a))
    for block in (3, 7, 50, 1024):
        p = Parser({k: letters(v) for k, v in raw.items()}, block=block)
        got = p.phrases([letters(t) for t in tests])
        for t, row in zip(tests, got.tolist(), strict=True):
            assert row == [plain_phrases(show(letters(raw[lang])), show(letters(t))) for lang in p.langs]


def test_languages_of_many_scripts():
    rng = random.Random(9)
    # Eight alphabets of 20 to 26 letters, and one language of 3000 Han characters; words of each from a stock, the tests' half unseen.
    starts = {"ar": 0x627, "be": 0x430, "el": 0x3B1, "en": 0x61, "he": 0x5D0, "hy": 0x561, "ka": 0x10D0, "hi": 0x915}
    raw, tests = {}, []
    for lang, c in starts.items():
        stock = ["".join(chr(c + rng.randrange(20)) for _ in range(rng.randint(2, 6))) for _ in range(300)]
        raw[lang] = " ".join(rng.choice(stock[:200]) for _ in range(3000))
        tests += [(lang, " ".join(rng.choice(stock[100:]) for _ in range(rng.randint(2, 30)))) for _ in range(40)]
    # Two languages of one script and alphabet, told apart by their words.
    for lang, words in (("xa", "lomi kesa tunor bavi".split()), ("xb", "imol asek ronut ivab".split())):
        raw[lang] = " ".join(rng.choice(words) + rng.choice(["", "na", "ti"]) for _ in range(3000))
        tests += [(lang, " ".join(rng.choice(words) + rng.choice(["", "sa", "ti"]) for _ in range(8))) for _ in range(40)]
    stock = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(rng.randint(1, 3))) for _ in range(6000)]
    raw["zh"] = "".join(rng.choice(stock) for _ in range(9000))
    tests += [("zh", "".join(rng.choice(stock) for _ in range(rng.randint(3, 30)))) for _ in range(40)]
    p = Parser({k: letters(v)[:30_000] for k, v in raw.items()})
    got = p.predict([t for _, t in tests])
    for lang in raw:
        own = [g == lang for (want, _), (g, _) in zip(tests, got, strict=True) if want == lang]
        assert sum(own) >= 0.95 * len(own) == 38
    # Memory by edges: no table of states times symbols.
    assert sum(x.nbytes for t in p.tables for x in t) < 2_500_000 * len(raw)


def test_ties_go_to_the_first_by_name():
    p = Parser({"b": letters("same text here"), "a": letters("same text here"), "c": letters("xyz")})
    assert p.predict(["same text", "text", "\u4e00\u4e01", "xyz", "1", ""]) == [("a", 0.0), ("a", 0.0), ("a", 0.0), ("c", 2 / 3), ("und", 0.0), ("und", 0.0)]


def test_letters():
    assert "".join(map(chr, letters("  Ab1c, ÉÄ?! "))) == "ab c éä"
    assert len(letters("12 !")) == 0


def test_automaton_knows_all_substrings():
    s = [1, 2, 1, 1, 2, 3, 1]
    edges = suffix_automaton(s)
    for i in range(len(s)):
        state = 0
        for c in s[i:]:
            state = edges[state][c]
    assert all(c in (1, 2, 3) for e in edges for c in e)


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, text(rng, lang, rng.randint(3, 80)), lang, "x") for i in range(600) for lang in [rng.choice(list(STEMS))]]
    rows += [(9000, None, "aa", "x"), (9001, "12 34!", "aa", "x"), (9002, "", None, "x"), (None, "katomi ruse", "aa", "x"), (9003, "kato " * 40000, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = identify(df.withColumn("held", held_out()), learn(df)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    for r in out:
        assert r.held == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    told = {r.doc_id: r for r in out}
    assert [told[k].lang_pred for k in (9000, 9001, 9002)] == ["und"] * 3 and told[None].lang_pred == told[9003].lang_pred == "aa"
    scored = [r for r in out if r.held and r.lang and r.doc_id is not None and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in scored) >= 0.98 * len(scored) > 100
    # neither lang, id nor place of a row is an input of its prediction
    again = identify(df.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 7).repartition(5), learn(df)).collect()
    assert sorted((r.text or "", r.lang_pred, r.score) for r in again) == sorted((r.text or "", r.lang_pred, r.score) for r in out)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(0, "words", None, "x")], SCHEMA)
    assert [r.lang_pred for r in identify(df, learn(df)).collect()] == ["und"]
    assert identify(df.limit(0), {"a": np.array([97], np.uint32)}).count() == 0


def test_languages_of_copies_are_learned(spark):
    from plumbline.llm.langid import train_samples

    rows = [("aa", f"text {'abcdefgh'[k % 5]} of few") for k in range(6000)] + [("bb", "one text")] * 9000 + [("cc", f"word {chr(97 + k % 26)}{chr(97 + k // 26)} end") for k in range(600)]
    for seed in range(4):
        df = spark.createDataFrame([(lang, text + " x" * seed) for lang, text in rows], "lang string, text string")
        got = train_samples(df, rows=300)
        assert {k: "".join(map(chr, v)).count("text") for k, v in got.items()} == {"aa": 5, "bb": 1, "cc": 0}
        assert "".join(map(chr, got["cc"])).count("word") == 300
