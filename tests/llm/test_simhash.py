import random
from collections import defaultdict

import xxhash
from pyspark.sql import Row

from plumbline.llm.components import connected_components
from plumbline.llm.simhash import BKTree, block_masks, fingerprint, near_links, simhash_components


def plain_fingerprint(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hs) * 2 > len(hs))


def groups(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_fingerprint_matches_the_plain_definition():
    rng = random.Random(3)
    texts = [None, "", " \n", "One", "one two THREE", "a b c d", "É Ä x\x1cy\x85z a\x0bb\tc", "w " * 9000]
    texts += [" ".join(rng.choice("abcdefgh ÄÖ\n") * rng.randint(1, 3) for _ in range(rng.randint(1, 200))) for _ in range(100)]
    for t in texts:
        assert fingerprint(t) == plain_fingerprint(t)
        assert fingerprint(t, block=7) == plain_fingerprint(t)


def test_tree_finds_what_a_scan_finds():
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = [base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(9))) & (1 << 64) - 1 for _ in range(400)]
    tree = BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.within(q, 4)) == [k for k, v in enumerate(values) if (v ^ q).bit_count() <= 4]


def test_masks_cover_every_link():
    rng = random.Random(7)
    for agree in (1, 2, 3):
        masks = block_masks(4, agree)
        for _ in range(300):
            x, y = rng.getrandbits(64), 0
            y = x
            for k in rng.sample(range(64), 4):
                y ^= 1 << k
            assert any(x & m == y & m for m in masks)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_span_the_components(spark):
    rng = random.Random(11)
    values = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            values.add(x)
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
    values |= {0, (1 << 64) - 1}
    nodes = [signed(v) for v in values]
    want = groups(nodes, [(signed(a), signed(b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4])
    fps = spark.createDataFrame([Row(fp=n) for n in nodes])
    for crowd, agree in ((1024, 1), (4, 1), (3, 2)):
        got = [(r.a, r.b) for r in near_links(fps, crowd=crowd, agree=agree).collect()]
        assert all(((a - b) or 1) and ((a & (1 << 64) - 1) ^ (b & (1 << 64) - 1)).bit_count() <= 4 for a, b in got)
        assert groups(nodes, got) == want


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(6, 40)] + [(1, 1), (None, 3), (70, 72), (72, 71), (71, 70)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for e in links if None not in e and e[0] != e[1] for n in e}
    assert got == groups(nodes, [e for e in links if None not in e and e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_of_every_kind(spark):
    rng = random.Random(13)
    base = " ".join(f"w{rng.randrange(9999)}" for _ in range(400))
    near = base.replace(base.split()[200], "changed", 1)
    texts = [(7, base), (3, base), (9, near), (None, base), (20, None), (21, ""), (21, ""), (22, " \n"), (30, "Ab c"), (31, "aB\tC"), (40, "x " * 60000), (50, "other words stand here alone")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts], "doc_id long, text string, fp string, least int")
    got = simhash_components(docs).collect()
    assert len(got) == len(texts)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    fps = {i: plain_fingerprint(t) for i, t in texts}
    for i, rs in by.items():
        assert {r.fingerprint for r in rs} == {f"{fps[i]:016x}"}
    ids = [i for i, _ in texts if i is not None]
    want = groups(set(ids), [(a, b) for a in ids for b in ids if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {i: {r.component_id for r in rs} for i, rs in by.items() if i is not None} == {i: {c} for i, c in want.items()}
    assert by[None][0].component_id == 3 and want[20] == 20 and want[22] == 20 and want[31] == 30
    assert simhash_components(docs.limit(0)).count() == 0


def test_similar_texts_meet_and_others_stay(spark):
    from plumbline.llm.simhash import near_components

    rng = random.Random(17)
    rows, want = [], {}
    for g in range(60):
        base = [f"w{rng.randrange(99999)}" for _ in range(300)]
        for k in range(4):
            text = list(base)
            for _ in range(k):
                text[rng.randrange(300)] = "edited"  # an edit changes 5 of 296 shingles: similarity over 0.9
            rows.append((g * 10 + k, " ".join(text)))
            want[g * 10 + k] = g * 10
    rows += [(1000, "short one"), (1001, None), (1002, ""), (None, rows[0][1])]
    want |= {1000: 1000, 1001: 1001, 1002: 1001, None: 0}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for crowd in (1024, 3):
        assert {r.doc_id: r.component_id for r in near_components(df, crowd=crowd).collect()} == want
    assert near_components(df.limit(0)).count() == 0


def plain_sets(rows):
    out = {}
    for i, t in rows:
        words = t.lower().split()
        out[i] = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    return out


def edited(rng, base, similarity):
    """base with words changed here and there until its similarity falls below the given one, and the text before that."""
    before, text, own = base, list(base), plain_sets([(0, " ".join(base))])[0]
    while True:
        text[rng.randrange(len(text))] = f"x{rng.randrange(10**9)}"
        other = plain_sets([(0, " ".join(text))])[0]
        if len(own & other) / len(own | other) < similarity:
            return before, list(text)
        before = list(text)


def near_rows(rng, groups):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(99999)}" for _ in range(rng.choice((30, 120, 400)))]
        rows.append((g * 10, " ".join(base)))
        for k, s in enumerate((0.75, 0.78, 0.8, 0.82)):
            rows += [(g * 10 + 1 + 2 * k + j, " ".join(t)) for j, t in enumerate(edited(rng, base, s))]
    return rows


def test_pairs_about_the_threshold_link_as_their_jaccard_similarity_says(spark):
    from plumbline.llm.simhash import near_components

    rng = random.Random(19)
    rows = near_rows(rng, 40)
    # Exactly 0.8: 8 of 10 different shingles shared, and a repeated shingle that counts once.
    line = [f"v{k}" for k in range(13)]
    rows += [(1000, " ".join(line)), (1001, " ".join([*line[:12], "other"])), (1002, "a " * 500 + " ".join(line)), (1003, "a " * 500 + " ".join(line[::-1]))]
    sets = plain_sets(rows)
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b])]
    want = groups(set(sets), near)
    assert want[1001] == 1000 and want[1003] == 1003
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for kw in ({}, {"crowd": 2}, {"most_common": 3}):
        assert {r.doc_id: r.component_id for r in near_components(df, **kw).collect()} == want


def test_links_do_not_depend_on_the_size_of_the_table(spark):
    from plumbline.llm.simhash import near_components

    rng = random.Random(23)
    pairs = near_rows(rng, 12)
    others = [(10_000 + k, " ".join(f"z{rng.randrange(99999)}" for _ in range(12))) for k in range(6000)]
    small = {r.doc_id: r.component_id for r in near_components(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    large = {r.doc_id: r.component_id for r in near_components(spark.createDataFrame(pairs + others, "doc_id long, text string"), sample=100).collect()}
    assert small == {i: large[i] for i in small} and all(large[i] == i for i, _ in others)
