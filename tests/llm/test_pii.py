import random
import re

import pytest
import regex

from plumbline.llm.pii import replace_entities

SCHEMA = "doc_id long, text string, n_entities string, kind int, value int"


def run(spark, rows, key="k"):
    out = replace_entities(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA), key)
    assert out.columns == ["doc_id", "text", "kind", "value", "n_entities", "entity_kinds"]
    return out.collect()


def luhn(s):
    t = 0
    for k, c in enumerate(reversed(s)):
        x = int(c) * (1 + k % 2)
        t += x - 9 * (x > 9)
    return t % 10


def test_types_formats_and_coreference(spark):
    text = (
        "Write to Anna.Muster@mail7.example.com or anna.muster@MAIL7.example.com, call +1 (017) 555-7713 or +1 017 555 7713. "
        "Pay 4111111111111111, 4111-1111-1111-1111 or 1234567890123456. From 97.51.17.173. "
        'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" and F3EF4D6B2755A36D7D9C25BD72C4D5F67E061FDA. SSN 123-45-6789. '
        "Mrs Jane Miller met Ms. Jane Miller, Herr Karl-Heinz Schmidt and г-жа Анна Петрова."
    )
    r = run(spark, [(1, text), (2, "again 97.51.17.173 for Mrs Jane Miller")])
    r = {x.doc_id: x for x in r}
    new = r[1].text
    assert r[1].n_entities == 15 and r[1].entity_kinds == ["card", "email", "ip", "name", "phone", "secret", "ssn"]
    for gone in ("nna.", "555", "4111", "123456", "97.51", "f3ef", "Miller", "Karl", "Петрова"):
        assert gone not in new
    shape = r"Write to (\S+@\S+\.com) or (\S+@\S+\.com), call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3}) (\d{3}) (\d{4})\. Pay (\d{16}), (\d{4}-\d{4}-\d{4}-\d{4}) or (\d{16})\. From ([\d.]+)\. token = \"([0-9a-f]{40})\" and ([0-9A-F]{40})\. SSN (\d{3}-\d\d-\d{4})\. Mrs (\w+ \w+) met Ms\. (\w+ \w+), Herr (\w+-\w+ \w+) and г-жа ([А-я]+ [А-я]+)\."
    g = re.fullmatch(shape, new).groups()
    assert g[0] != g[1] and g[0].lower() == g[1].lower() and [c.isupper() for c in g[0]] == [c.isupper() and c.isalpha() for c in "Anna.Muster@mail7.example.com"]
    assert g[2:5] == g[5:8] and g[8] == g[9].replace("-", "") and g[8][0] == "4"
    assert luhn(g[8]) == 0 and luhn(g[10]) == luhn("1234567890123456") and g[12] == g[13].lower() and g[15] == g[16]
    assert r[2].text == f"again {g[11]} for Mrs {g[15]}"
    other = {x.doc_id: x.text for x in run(spark, [(1, text)], key="other")}[1]
    assert other != new


def test_distinct_values_stay_distinct(spark):
    ips = [f"10.{a}.{b}.7" for a in range(30) for b in range(20)]
    ssn = [f"{a:03d}-{b:02d}-0001" for a in range(1, 60) for b in range(1, 11)]
    names = [f"Mr {x}a{y}o" for x in "BCDFGHKL" for y in "bcdfghklmnprst"]
    rows = [(i, v) for i, v in enumerate(ips + ssn + names)]
    got = [r.text for r in run(spark, rows)]
    assert len(set(got)) == len(rows) and not set(got) & {v for _, v in rows}


def test_collisions_are_settled(spark):
    from pyspark.sql import functions as F

    from plumbline.llm import pii

    # All numbers of two digits are taken: surrogates grow longer.
    values = spark.range(100).select(F.lit("ssn").alias("kind"), F.lpad(F.col("id").cast("string"), 2, "0").alias("value"))
    for df in (values.where("value < '08' or value = '55'"), values):
        got = pii.assign(df, "k").collect()
        assert len({r.sur for r in got}) == len(got) == df.count() and not {r.sur for r in got} & {r.value for r in got}
    # More family names than there are of three syllables.
    names = spark.range(200_000).select(F.lit("name").alias("kind"), F.concat(F.lit("m A"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("value"))
    got = pii.assign(names, "k")
    assert got.select("sur").distinct().count() == 200_000
    assert got.where(~F.col("sur").rlike(r"^m \p{Lu}\p{Ll}+$")).isEmpty()


def test_key_is_used_as_in_hmac_and_stays_out_of_the_plan(spark):
    import hashlib
    import hmac

    from plumbline.llm import pii

    for key in ("secret-of-the-test", "long" * 40):
        df = spark.createDataFrame([("a",), ("ä",)], "v string")
        out = df.select("v", pii.keyed_hash(spark, key)(df["v"]).alias("h"))
        assert {r.v: r.h for r in out.collect()} == {v: hmac.new(key.encode(), v.encode(), hashlib.sha256).hexdigest() for v in ("a", "ä")}
        plan = out._jdf.queryExecution().toString()
        pads = [bytes(x ^ y for x in key.encode()[:16]) for y in (0, 0x36, 0x5C)]
        assert not any(p.hex() in plan.lower() or p.decode("latin-1") in plan for p in pads)


def test_long_texts_of_one_kind_of_character(spark):
    n = 1_000_000
    rows = [(1, "a@" + "b." * n + "com"), (2, "a@" + "b." * n), (3, "1." * n), (4, "-" * n), (5, "12" * n), (6, "a-" * n), (7, "A" * n), (8, "a@" * n), (9, "ab:" * n), (10, "Mr " * (n // 3)), (11, "AB12 " * (n // 5)), (12, "Mr Ab" + "-Cd" * n), (13, "1-" * n), (14, "(" * n)]
    got = {r.doc_id: (r.text, r.n_entities) for r in run(spark, rows)}
    assert got[1][1] == 1 and got[1][0] != rows[0][1] and got[1][0].endswith(".com")
    # A hyphen joins two names at most.
    assert got[12][1] == 1 and got[12][0].startswith("Mr ") and got[12][0].endswith("-Cd" * (n - 1))
    assert all(got[i] == (t, 0) for i, t in rows if i not in (1, 10, 11, 12)) and len(got[11][0]) >= n - 5 and got[10][0].startswith("Mr ")


def test_people_are_followed_through_their_text(spark):
    rows = [
        (1, "Mr John Smith came. John Smith said hello. Mr Smith left. Smith and John and Smithson, Johnny; Mary Smith stayed."),
        (2, "Smith, John Smith and Mrs Smith. Then Mr Smith."),
        (3, "Mrs Anna Weber, Mrs Eva Weber, Mr Weber and Weber: Eva Weber, Anna Weber, Frau Weber. Anna\nWeber"),
        (4, "John Smith and Smith are named without a title here."),
        (5, "г-н Иван Петров; Петров и Иван Петров."),
    ]
    got = {r.doc_id: r for r in run(spark, rows)}
    g, f = got[1].text.split()[1:3]
    assert got[1].text == f"Mr {g} {f} came. {g} {f} said hello. Mr {f} left. {f} and {g} and Smithson, Johnny; Mary {f} stayed." and got[1].n_entities == 7
    m = re.fullmatch(r"(\w+), John \1 and Mrs (\w+)\. Then Mr (\w+)\.", got[2].text)
    assert m and m[1] == m[2] != m[3] and "Smith" not in got[2].text
    m = re.fullmatch(r"Mrs (\w+) (\w+), Mrs (\w+) (\w+), Mr (\w+) and (\w+): (\w+) (\w+), (\w+) (\w+), Frau (\w+)\. (\w+)\n(\w+)", got[3].text)
    a, w, e, v, mr, alone, e2, v2, a2, w2, frau, a3, w3 = m.groups()
    assert (e, v, a, w) == (e2, v2, a2, w2) and w == frau == alone == w3 and a == a3 and len({w, v, mr}) == 3
    assert got[4].text == rows[3][1] and got[4].n_entities == 0
    m = re.fullmatch(r"г-н (\w+) (\w+); (\w+) и (\w+) (\w+)\.", got[5].text)
    assert m[2] == m[3] == m[5] and m[1] == m[4] and m[2].endswith("нов")


def test_more_formats(spark):
    def mod97(s):
        return int("".join(str(int(c, 36)) for c in s.replace(" ", "")[4:] + s[:4])) % 97

    text = "Call (212) 555-0199 or 0171 555 0199, 212-555-0199. IBAN DE89 3704 0044 0532 0130 00 or DE89370400440532013000. From 2001:DB8:0:0:8:800:200C:417A or fe80::1ff:fe23. On 01-02-2024 at 12:34:56, std::list."
    r = run(spark, [(1, text)])[0]
    m = re.fullmatch(r"Call \((\d{3})\) (\d{3})-(\d{4}) or (\d{4} \d{3} \d{4}), (\d{3})-(\d{3})-(\d{4})\. IBAN (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d) or (DE\d{20})\. From ([0-9A-F]{4}:[0-9A-F]{3}:[0-9A-F:]+) or ([0-9a-f]{4}::[0-9a-f]{3}:[0-9a-f]{4})\. On 01-02-2024 at 12:34:56, std::list\.", r.text)
    assert m and r.n_entities == 7 and r.entity_kinds == ["iban", "ip6", "phone"]
    assert m[1] + m[2] + m[3] == m[5] + m[6] + m[7] != "2125550199" and m[1][0] == "2" and m[4][0] == "0"
    assert m[8].replace(" ", "") == m[9] != "DE89370400440532013000" and mod97(m[9]) == 1


def plain_entities(text):
    """(mentions, entity of each or None, text between) by a plain scan."""
    from plumbline.llm import pii

    names = regex.search(pii.KINDS[-1][1], text)
    hits = list(regex.finditer(pii.ANY_OR_WORD if names else pii.ANY, text))
    told, full = [], {}
    for h in hits:
        m = h[0]
        kind = next((k for k, p in pii.KINDS if regex.fullmatch(p, m)), None)
        if kind == "name":
            title = max((t for t in (*pii.MALE, *pii.FEMALE) if m.startswith(t)), key=len)
            g, rest = "f" if title in pii.FEMALE else "m", m[len(title) :].lstrip(".")[1:].split(" ")
            if len(rest) == 2:
                full.setdefault((g, rest[1]), rest[0])
            told.append((kind, [g, *rest]))
        else:
            digits = "".join(c for c in m if c.isdigit())
            told.append((kind, [m.lower() if kind in ("email", "secret") else ("+" if m[0] == "+" else "") + digits if kind != "ip" else m]))
    people = []
    for kind, v in told:
        if kind == "name":
            if len(v) == 2 and (v[0], v[1]) in full:
                v.insert(1, full[v[0], v[1]])
            if v not in people:
                people.append(v)
    return hits, told, people


def test_against_a_plain_scan(spark):
    rng = random.Random(4)
    people = [(t, g, f) for t, g in (("Mr", "John"), ("Mr.", "Paul"), ("Mrs", "Jane"), ("Frau", "Eva")) for f in ("Smith", "Weber", "Karl-Jung")]
    parts = ["mail x.y@abc.example.org", "X.Y@abc.example.org", "10.1.2.3", "+49 (030) 123 4567", "+49 030 1234567", "123-45-6789", "4111 1111 1111 1111", "4111111111111111", "Nothing here", "The Smith", "the end", "page 12"]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(1, 12)):
            t, g, f = rng.choice(people)
            words.append(rng.choice([rng.choice(parts), f"{t} {g} {f}", f"{t} {f}", f"{g} {f}", f, g]))
        rows.append((i, rng.choice([", ", " ", "\n"]).join(words)))
    got = {r.doc_id: r for r in run(spark, rows)}
    sur = {}  # entity: surrogate, over all texts
    for i, text in rows:
        hits, told, people_here = plain_entities(text)
        new, n = got[i].text, 0
        assert len(told) == len(hits)
        # What stands between the mentions cuts the new text into theirs.
        gaps = [text[a:b] for a, b in zip([0, *(h.end() for h in hits)], [*(h.start() for h in hits), len(text)], strict=True)]
        m = regex.fullmatch("(?s)" + "(.+?)".join(regex.escape(x) for x in gaps), new)
        assert m, (text, new)
        new_mentions = []
        at = len(gaps[0])
        for k, h in enumerate(hits):
            old, kind, v = h[0], *told[k]
            word = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
            shape = {"name": r"\S+" + f" {word}" * old.count(" "), "ip": r"\d+(?:\.\d+){3}", None: word}.get(kind, ".{%d}" % len(old))
            size = len(regex.match(shape, new[at:])[0])
            now = new[at : at + size]
            new_mentions.append(now)
            at += size
            assert new[at : at + len(gaps[k + 1])] == gaps[k + 1]
            at += len(gaps[k + 1])
            if kind not in (None, "name"):
                n += 1
                assert now != old and sur.setdefault((kind, *v), regex.sub(r"[^0-9a-z@]", "", now.lower())) == regex.sub(r"[^0-9a-z@]", "", now.lower())
        of = {}
        for (kind, v), h, now in zip(told, hits, new_mentions, strict=True):
            if kind == "name":
                n += 1
                words = now.split(" ")[1:]
                if len(words) == 2:
                    of.setdefault(tuple(v), words)
                else:
                    of.setdefault((*v, "family"), words[0])
                    assert of[(*v, "family")] == words[0]
                    if tuple(v) in of:
                        assert of[tuple(v)][-1] == words[0]
        for v in people_here:
            if tuple(v) in of and len(v) == 3:
                assert sur.setdefault(("name", *v), of[tuple(v)]) == of[tuple(v)]
        # Words: as the rule says.
        for k, ((kind, _), h, now) in enumerate(zip(told, hits, new_mentions, strict=True)):
            if kind is None:
                before = hits[k - 1][0] if k and gaps[k] == " " else None
                after = hits[k + 1][0] if k + 1 < len(hits) and gaps[k + 1] == " " else None
                want = next((("f", v) for v in people_here if len(v) == 3 and [before, h[0]] == v[1:]), None) or next((("g", v) for v in people_here if len(v) == 3 and [h[0], after] == v[1:]), None)
                want = want or next((("f" if v[-1] == h[0] else "g", v) for v in people_here if h[0] in v[1:]), None)
                if want is None:
                    assert now == h[0]
                else:
                    n += 1
                    known = sur.get(("name", *want[1])) if len(want[1]) == 3 else [of.get((*want[1], "family"))]
                    if known and known[0]:
                        assert now == known[-1 if want[0] == "f" else 0], (text, new)
        assert got[i].n_entities == n
    assert len({str(v) for v in sur.values()}) == len(sur)


def test_other_rows_stay(spark):
    long = "plain words only. " * 20000 + "the end 1.2.3.4"
    rows = [(None, "mail a@b.example.com"), (None, "mail a@b.example.com"), (1, None), (2, ""), (3, "Version 2.0, page 12 of 300; 1,000,000 and 3.14159; call 555 now."), (4, long)]
    got = run(spark, rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[None]) == 2 and by[None][0].text == by[None][1].text != rows[0][1] and by[None][0].n_entities == 1
    assert by[1][0].text is None and by[2][0].text == "" and by[3][0].text == rows[4][1] and by[3][0].n_entities == 0
    assert by[4][0].text.startswith("plain words only. " * 20000 + "the end ") and not by[4][0].text.endswith("1.2.3.4")
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        replace_entities(spark.createDataFrame([], SCHEMA), "")
