"""URL filters: pattern rules indexed by their rarest literal token.

A rule's literal tokens are the labels of its host and the whole segments of its path. The rule is filed under that
token which the fewest urls hold, counted over the whole table. The tokens of a url fetch its candidate rules, and only
those run their regular expression. All of it is built from DataFrame functions.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """Over host and path joined: the host or a subdomain of it, then a path that starts with the rule's."""
        return r"^(?:[^/]*\.)?" + re.sub(r"([^A-Za-z0-9_/-])", r"\\\1", self.host) + ("" if self.path else r"(?:/|$)") + re.sub(r"([^A-Za-z0-9_/-])", r"\\\1", self.path)

    @property
    def tokens(self) -> list[str]:
        """Tokens that any fitting url holds: host labels, and path segments that a slash ends."""
        return list(dict.fromkeys(t for t in [*self.host.split("."), *self.path.split("/")[:-1]] if t))


#: The rules of the query.
RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow")]


def url_host(url: Column) -> Column:
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) == 0, "").otherwise(F.translate(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), UPPER, LOWER))


def url_path(url: Column) -> Column:
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) == 0, "").otherwise(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1))


def url_tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.filter(F.concat(F.split(host, r"\."), F.split(path, "/")), lambda t: t != ""))


def rarest(rules: list[Rule], urls: DataFrame) -> dict[str, list[Rule]]:
    """Rules by their rarest token. Counts the tokens of rules over all urls: one row for each such token comes to the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    held = urls.select(F.explode("tokens").alias("token")).where(F.col("token").isin(wanted)).groupBy("token").count().collect()
    often = {r["token"]: r["count"] for r in held}
    index: dict[str, list[Rule]] = {}
    for r in rules:
        if not r.tokens:
            raise ValueError(f"a rule without a literal token: {r}")
        index.setdefault(min(r.tokens, key=lambda t: (often.get(t, 0), t)), []).append(r)
    return index


def judge(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url", default: str = "allow", most_inline: int = 200) -> DataFrame:
    """One row per page: id, host, path, rule (host and path; null if none fits), verdict (the rule's, else default).

    Up to most_inline rules, the index is a literal of the plan and nothing is shuffled but the counts of tokens. More rules
    make a table that joins the distinct urls by token; results are the same. Of equally long rules the first by text
    wins, block before allow. Null urls and those without :// have an empty host and path and get the default.
    Repeated rows and null ids come back as they are; other columns are not read. The empty table gives the empty table.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url")).withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    rows = rows.withColumn("tokens", url_tokens(F.col("host"), F.col("path")))
    index = rarest(rules, rows)
    whole = F.concat("host", "path")
    if len(rules) <= most_inline:
        item = lambda r: F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))
        # Each index entry whose token the url holds hands over its rules; only then is the pattern tried.
        fits = [F.when(F.array_contains("tokens", t), F.filter(F.array(*[F.when(whole.rlike(r.pattern), item(r)) for r in rs]), lambda x: x.isNotNull())).otherwise(F.array().cast("array<struct<text:string,verdict:string>>")) for t, rs in sorted(index.items())]
        best = rows.withColumn("best", F.try_element_at(F.array_sort(F.flatten(F.array(*fits)), _order), F.lit(1))) if fits else rows.withColumn("best", F.lit(None).cast("struct<text:string,verdict:string>"))
        return best.select(id_col, "host", "path", F.col("best.text").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    filed = spark.createDataFrame([(t, r.text, r.verdict, r.pattern) for t, rs in index.items() for r in rs], "token string, text string, verdict string, pattern string")
    found = rows.select("host", "path", "tokens").distinct().select("host", "path", F.explode("tokens").alias("token")).join(filed, "token")
    found = found.where(F.expr("concat(host, path) rlike pattern")).groupBy("host", "path").agg(F.min(F.struct((-F.length("text")).alias("k"), "text", F.when(F.col("verdict") == "block", 0).otherwise(1).alias("v"), "verdict")).alias("best"))
    out = rows.drop("tokens").join(found, ["host", "path"], "left")
    return out.select(id_col, "host", "path", F.col("best.text").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _order(a: Column, b: Column) -> Column:
    by_text = F.when(a["text"] < b["text"], -1).when(a["text"] > b["text"], 1)
    by_verdict = F.when(a["verdict"] == b["verdict"], 0).when(a["verdict"] == "block", -1).otherwise(1)
    return F.when(F.length(a["text"]) != F.length(b["text"]), F.length(b["text"]) - F.length(a["text"])).when(a["text"] != b["text"], by_text).otherwise(by_verdict)


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), RULES)


_AZ = f"translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
_CASES = ["(host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%'", "(host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%'", "(host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%'", "(host = 'net' OR host LIKE '%.net') AND path LIKE '/%'"]
ORACLE = f"""
WITH p AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN {_AZ} ELSE '' END AS host,
 CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
r AS (SELECT *, CASE WHEN {_CASES[0]} THEN 'example.net/en/' WHEN {_CASES[1]} THEN 'example.com/de/' WHEN {_CASES[2]} THEN 'org/fr/' WHEN {_CASES[3]} THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r"""
