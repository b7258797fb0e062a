import random
from math import log

from plumbline.llm.decontam import Index, halves, leaks, without_leaks, words


def sentence(rng, n):
    return " ".join(rng.choice("the of and to in".split()) if rng.random() < 0.4 else "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n)).capitalize() + "."


def test_finds_just_the_items_that_stand_in_a_text(spark):
    rng = random.Random(1)
    items = [(i, " ".join(sentence(rng, rng.randint(5, 25)) for _ in range(rng.randint(1, 3)))) for i in range(150)] + [(900, None), (901, ""), (902, "?!")]
    docs = []
    for d in range(120):
        parts = [sentence(rng, rng.randint(5, 60)) for _ in range(rng.randint(0, 6))]
        if d % 3 == 0:
            text = rng.choice(items[:150])[1]
            parts.insert(rng.randint(0, len(parts)), rng.choice([text, text.upper(), text.replace(" ", "\n"), text.replace(".", " !")]))
        docs.append((d, " ".join(parts)))
    docs += [(500, None), (501, ""), (None, items[3][1]), (502, items[4][1]), (502, items[4][1]), (503, "filler words " * 50000 + items[5][1] + " more filler" * 1000)]
    wide = lambda t: b" " + b" ".join(words(t)) + b" "
    want = sorted(((d, i) for d, t in docs for i, x in items[:150] if t and wide(x) in wide(t)), key=str)
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in docs], "doc_id long, text string, item_id int, score string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for chars in (16 << 20, 3000):  # one shard, and several
        got = leaks(df, bench, most_chars=chars).collect()
        assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == want
        assert all(r.question_share >= 0.8 and r.answer_share >= 0.8 and 0.6 <= r.score <= 1.0001 for r in got)
        kept = without_leaks(df, bench, most_chars=chars)
        assert kept.columns == df.columns
        hit = {d for d, _ in want}
        assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(d) for d, _ in docs if d not in hit)
    assert leaks(df, bench.limit(0)).count() == 0 and leaks(df.limit(0), bench).count() == 0
    assert without_leaks(df, bench.limit(0)).count() == len(docs)


def test_an_edited_word_and_half_an_item():
    rng = random.Random(2)
    question, answer = " ".join(sentence(rng, 25) for _ in range(2)), sentence(rng, 12)
    index = Index([(1, question + " " + answer)] + [(i, sentence(rng, 40)) for i in range(2, 60)])
    edited = (question + " " + answer).split()
    edited[5] = "edited"
    assert list(index.batch([" ".join(edited)])[0]) == [1]
    assert index.batch([question, answer, sentence(rng, 60)]) == [{}, {}, {}]


def test_search_returns_all_that_a_scan_returns():
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.randint(8, 30))) for i in range(200)]
    for block in (1, 4, 50):
        index = Index(items, block=block, least_class=60, most_classes=4)
        for _, own, postings, _, _ in index.classes:
            for _ in range(40):
                terms = {t for _ in range(3) for t in rng.choice(own)[2]} | set(range(0, 30, 7))
                for threshold in (0.2, 0.6, 0.95):
                    scan = {k: sum(w for t, w in r[2].items() if t in terms) for k, r in enumerate(own)}
                    want = {k for k, s in scan.items() if s >= threshold - 1e-9}
                    assert {k for k, _ in postings.search(terms, threshold)} == want


def plain_leaks(items, texts, index):
    """What leaks by all windows and all items, scored and compared one by one; index tells the lengths of the windows."""
    rows = {i: words(t) for i, t in items if words(t)}
    mean = sum(map(len, rows.values())) / len(rows)
    idf = {w: log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w in {w for ws in rows.values() for w in ws} for n in [sum(w in ws for ws in rows.values())]}
    out = set()
    for length, own, *_ in index.classes:
        for _, i, *_ in own:
            ws, text = rows[i], dict(items)[i]
            raw = {w: idf[w] * ws.count(w) * 2.2 / (ws.count(w) + 1.2 * (0.25 + 0.75 * len(ws) / mean)) for w in ws}
            q, a = halves(text) if len(ws) >= 5 else (ws, ws)
            for d, t in texts:
                x = words(t)
                for at in range(0, len(x), length):
                    part = x[at : at + 2 * length]
                    if sum(v for w, v in raw.items() if w in part) < 0.6 * sum(raw.values()) - 1e-9:
                        continue
                    shares = []
                    for half in (q, a):
                        n = min(5, len(half))
                        want = {tuple(half[k : k + n]) for k in range(len(half) - n + 1)}
                        shares.append(len(want & {tuple(part[k : k + n]) for k in range(len(part) - n + 1)}) / len(want))
                    if min(shares) >= 0.8:
                        out.add((d, i))
    return out


def test_near_matches_short_items_and_scripts_without_blanks(spark):
    rng = random.Random(7)
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(400)) for _ in range(n))
    thai = lambda n: "".join(chr(0x0E01 + rng.randrange(46)) for _ in range(n))
    items = [(i, " ".join(sentence(rng, rng.randint(6, 20)) for _ in range(rng.randint(1, 3)))) for i in range(40)]
    items += [(100 + i, han(rng.randint(8, 40)) + "。" + han(rng.randint(3, 12)) + "？") for i in range(20)]
    items += [(200 + i, thai(rng.randint(10, 30))) for i in range(8)] + [(300, "Kimoto Lasabe"), (301, "Nofuti?"), (302, "Gadine pomaku selofa rane"), (303, "。、")]
    texts = []
    for d in range(150):
        body = dict(items)[rng.choice(items)[0]]
        part = list(body) if not body.isascii() else body.split()
        for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):  # near matches: words changed, put in or left out
            k = rng.randrange(len(part))
            part[k : k + 1] = rng.choice(([], ["x"], [part[k], "y"]))
        around = (lambda n: sentence(rng, n)) if body.isascii() else han
        before, after = around(rng.randint(1, 60)), around(rng.randint(1, 60))
        texts.append((d, (" " if body.isascii() else "").join([before, (" " if body.isascii() else "").join(part), after])))
    texts += [(900, "see kimoto, LASABE there"), (901, "kimoto is not lasabe"), (902, "nofuti"), (903, "nofutis"), (904, items[45][1].replace("。", "\n"))]
    index = Index(items)
    want = plain_leaks(items, texts, index)
    assert {(900, 300), (902, 301), (904, 105)} <= want and not {(901, 300), (903, 301)} & want and 60 < len(want) < 200
    df, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks(df, bench).collect()} == want
    # Scores are by all items, whatever the shards.
    scores = {(r.doc_id, r.item_id): r.score for r in leaks(df, bench, most_chars=800).collect()}
    one = {(r.doc_id, r.item_id): r.score for r in leaks(df, bench).collect()}
    both = scores.keys() & one.keys()
    assert len(both) >= 0.9 * len(one) and all(abs(scores[k] - one[k]) < 1e-9 or scores[k] > 0.6 for k in both)
