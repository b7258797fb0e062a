import random
import re

from plumbline.llm.urlrules import RULES, Rule, judge

SCHEMA = "page_id long, url string, host int, verdict string"


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.text), r.text, r.verdict != "block"), default=None)
    return host, path, best.text if best else None, best.verdict if best else default


URLS = [None, "", "no scheme", "https://", "http://NET/", "http://a.net", "http://a.net/x?y://z", "HTTP://A.Example.NET/en/1#f", "http://example.net/en", "http://badexample.com/de/", "http://x.example.com/de/1", "http://www.ÉXAMPLE.org/fr/2", "http://org/fr/", "http://org/fr", "ftp://u@x.org:80/fr/", "x://a\nb.net/", "http://net?x", "http://.net/"]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, 1, "v") for i, u in enumerate(URLS)] + [(0, None, 1, "v"), (None, URLS[6], 1, "v")], SCHEMA)
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, None), (None, URLS[6])]
    want = sorted([(i, *plain(u, RULES)) for i, u in rows], key=str)
    for inline in (200, 0):
        got = judge(df, RULES, most_inline=inline)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
        assert judge(df.limit(0), RULES, most_inline=inline).count() == 0


def test_many_rules(spark):
    rng = random.Random(3)
    label = lambda: rng.choice(["a", "b", "c+d", "x-y"])
    rules = [Rule(".".join(label() for _ in range(rng.randint(1, 3))), rng.choice(["/", "/a/", "/a", "/a/b/", "/x"]), rng.choice(["allow", "block"])) for _ in range(40)]
    urls = [f"http://{'.'.join(label() for _ in range(rng.randint(1, 4)))}{rng.choice(['', '/', '/a/', '/ab', '/a/b/c', '/x?y', '/X'])}" for _ in range(300)]
    df = spark.createDataFrame([(i, u, 1, "v") for i, u in enumerate(urls)], SCHEMA)
    want = [(i, *plain(u, rules, "block")) for i, u in enumerate(urls)]
    for inline in (200, 0):
        assert sorted(tuple(r) for r in judge(df, rules, default="block", most_inline=inline).collect()) == want
