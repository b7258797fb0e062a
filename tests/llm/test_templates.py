import random

from plumbline.llm.templates import drop_recurring_lines

SCHEMA = "doc_id long, text string, n_lines string, pos int, leaf int"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    out = drop_recurring_lines(df, **kw)
    assert out.columns == ["doc_id", "text", "pos", "leaf", "n_lines", "n_dropped"]
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()], key=str)


def prose(rng, n):
    return " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{''.join(rng.choice('klmnrst') for _ in range(6))}" for _ in range(n))


def test_templates_with_variable_fields(spark):
    rng = random.Random(2)
    rows = []
    for i in range(12):
        name = prose(rng, 1)
        rows.append((i, "\n".join([prose(rng, 12), f"Printed by user {name} on page {i} of this long report today", prose(rng, 9), f"All rights reserved {2000 + i} by the owners of this site"])))
    got = run(spark, rows)
    for (i, text, n, dropped), (_, before) in zip(sorted(got), rows, strict=True):
        lines = before.split("\n")
        assert (n, dropped) == (4, 0 if i == 0 else 2)
        assert text == (before if i == 0 else "\n".join([lines[0], lines[2]]))


def test_clean_documents_stay(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(["The same start " + prose(rng, 8), "Yes.", "", "  " + prose(rng, 5) + "  "])) for i in range(9)]
    assert [(i, t) for i, t, _, d in sorted(run(spark, rows))] == rows


def test_rows_of_every_kind(spark):
    rng = random.Random(6)
    long = "\n".join(prose(rng, 3) for _ in range(5000))
    body = prose(rng, 60) + "\n\n" + prose(rng, 10)
    rows = [(1, body), (1, body), (2, body), (None, body), (3, None), (4, ""), (5, "\n\n"), (6, long), (7, body + "\nnew words stand here and nowhere else at all")]
    got = run(spark, rows)
    assert got == sorted([(1, body, 3, 0), (1, body, 3, 0), (2, "", 3, 2), (None, "", 3, 2), (3, None, 0, 0), (4, "", 1, 0), (5, "\n\n", 3, 0), (6, long, 5000, 0), (7, "\nnew words stand here and nowhere else at all", 4, 2)], key=str)
    assert run(spark, []) == []


def test_against_exact_counts(spark):
    rng = random.Random(8)
    stock = [prose(rng, rng.randint(1, 14)) for _ in range(60)]
    rows = [(i, "\n".join(rng.choice(stock) if rng.random() < 0.4 else prose(rng, rng.randint(1, 14)) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    docs = {}
    for i, t in rows:
        for line in t.split("\n"):
            docs.setdefault(line, set()).add(i)
    need = lambda line: 2 if len(line.split()) >= 8 else 3 if len(line.split()) >= 4 else 10
    want = [(i, "\n".join(x for x in t.split("\n") if len(docs[x]) < need(x) or min(docs[x]) == i)) for i, t in rows]
    assert [(i, t) for i, t, _, _ in sorted(run(spark, rows))] == want


def test_short_lines_go_by_a_fixed_number_of_documents(spark):
    rng = random.Random(10)
    for n in (40, 3000):  # 0.5 % of 3000 documents are 15
        rows = [(i, prose(rng, 12) + ("\nBack to top" if i < 12 else "")) for i in range(n)]
        got = {i: (t, d) for i, t, _, d in run(spark, rows)}
        assert all(got[i] == ((t, 0) if i == 0 or i >= 12 else (t.split("\n")[0], 1)) for i, t in rows)
        rows = [(i, prose(rng, 12) + ("\nRead on" if i < 9 else "")) for i in range(n)]
        assert {(i, t) for i, t, _, _ in run(spark, rows)} == set(rows)


def test_fields_in_short_lines_and_several_fields(spark):
    rng = random.Random(12)
    rows = []
    for i in range(12):
        name, place = prose(rng, 1), ("Anna", "Paul", "Mary")[i % 3]
        # One field in 6 tokens, of many values and of few; one in 5; two digit fields and a word in 10.
        drop = [f"This page was written by {name}", f"That page was checked by {place}", f"Posted here today by {name}", f"Updated on day {i} of {i + 3} in our {name} office"]
        keep = [prose(rng, 9), f"Posted by {name} {prose(rng, 1)}", f"See also our {prose(rng, 3)}"]
        rows.append((i, keep, "\n".join([keep[0], *drop, *keep[1:]])))
    got = run(spark, [(i, t) for i, _, t in rows])
    for (i, text, n, dropped), (_, keep, before) in zip(sorted(got), rows, strict=True):
        assert (text, n, dropped) == ((before, 7, 0) if i == 0 else ("\n".join(keep), 7, 4))


def test_lines_of_four_to_seven_tokens_go_from_three_documents_on(spark):
    rng = random.Random(14)
    for n, kept in ((2, True), (3, False)):
        rows = [(i, prose(rng, 9) + f"\nThis page was written by {prose(rng, 1)}") for i in range(n)]
        assert [t for _, t, _, _ in sorted(run(spark, rows))] == [t if kept or not i else t.split("\n")[0] for i, t in rows]


def test_fields_whose_values_repeat(spark):
    rng = random.Random(16)
    rows, kept = [], []
    for i in range(12):
        own = prose(rng, 9)
        city, day, year = ("Berlin", "Paris", "Rome")[i % 3], ("Monday", "Tuesday")[i // 3 % 2], 2000 + i % 4
        weather = f"Weather report issued for the city of {city} by station staff today"
        both = f"Weather report of {city} and all of its suburbs on {day} in {year} by station staff"
        kept.append(own)
        rows.append((i, "\n".join([own, weather, both])))
    assert [t for _, t, _, _ in sorted(run(spark, rows))] == [rows[0][1], *kept[1:]]


def plain_templates(rows, depth=3):
    """The texts that are left, line by line: each pair of lines of a leaf is compared."""
    def masked(line):
        return tuple("<*>" if any(c.isdigit() for c in w) else w for w in line.split())

    parsed = {i: [masked(x) for x in t.split("\n")] for i, t in rows}
    different = {x for xs in parsed.values() for x in xs if x}
    docs = {x: {i for i in parsed if x in parsed[i]} for x in different}

    def template(x):
        leaf = [y for y in different if len(y) == len(x) and y[:depth] == x[:depth]]
        if len(x) <= depth or len(leaf) < 2 or len(set.union(*(docs[y] for y in leaf))) < 2:
            return x
        k = [sum(y[p] == w for y in leaf) for p, w in enumerate(x)]
        alike = sorted(k)[len(x) // 5]
        return x if alike < 2 else tuple(w if c >= alike else None for w, c in zip(x, k, strict=True))

    made = {x: (x[:depth], template(x)) for x in different}
    held = {}
    for x, g in made.items():
        held.setdefault(g, set()).update(docs[x])
    need = lambda n: 2 if n >= 8 else 3 if n >= 4 else 10
    gone = lambda i, x: bool(x) and len(held[made[x]]) >= need(len(x)) and min(held[made[x]]) != i
    return [(i, "\n".join(line for line, x in zip(t.split("\n"), parsed[i], strict=True) if not gone(i, x))) for i, t in rows]


def test_against_pairs_of_lines(spark):
    rng = random.Random(18)
    stock = [prose(rng, 1) for _ in range(6)]
    rows = []
    for i in range(60):
        lines = [prose(rng, 8)]
        for _ in range(rng.randint(1, 8)):
            k = rng.randrange(8)
            words = [f"w{chr(97 + k)}{chr(97 + p)}" for p in range(4 + 2 * k)]
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                words[rng.randrange(len(words))] = rng.choice([*stock, f"{rng.randrange(99)}", prose(rng, 1)])
            lines.append(rng.choice([" ", "\t", "  "]).join(words))
        rows.append((i, "\n".join(lines)))
    want = plain_templates(rows)
    assert sum(len(t) for _, t in want) < 0.9 * sum(len(t) for _, t in rows)
    assert [(i, t) for i, t, _, _ in sorted(run(spark, rows))] == want
