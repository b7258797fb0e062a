"""Surrogates for personal data: detected entities get keyed replacements of their own type and format.

An entity is a type and a canonical value (digits of a number, lower case of letters), so mentions that differ in
case or separators stay one person or number. People are found by a title and then followed through their text: the name without
the title, the family name and the given name alone, and the title with the family name alone are the same person. A surrogate is
drawn from the HMAC-SHA256 of type, value and attempt. Two entities that draw the same surrogate, or one that is itself a value of the
texts, are told apart by further attempts for all but one, until all are distinct; later attempts draw from
larger spaces. Each mention is then written in its own format. All of it is built from DataFrame functions; mentions are joined
by value, so the corpus' table of entities never leaves the executors. Patterns repeat groups possessively, so that none recurs.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import discard, materialize, table

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Titles before names, by gender of the surrogate.
MALE, FEMALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин"), ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа")
_TITLE = "|".join(sorted((*MALE, *FEMALE), key=len, reverse=True))
_NAME = r"\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)?+"
_LABEL, _HEX = r"[\p{L}\p{N}-]++", "[0-9A-Fa-f]{1,4}"
#: Type and pattern; the first that a mention fits is its type.
KINDS = [
    ("email", rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}_%+-][\p{{L}}\p{{N}}._%+-]*+@(?=[\p{{L}}\p{{N}}.-]*?\.\p{{L}}{{2}}){_LABEL}(?:\.{_LABEL})++"),
    ("secret", r"(?<![0-9A-Za-z])(?=[A-Fa-f]*+\d)[0-9A-Fa-f]{32,128}(?![0-9A-Za-z])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("ip6", rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*+\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![0-9A-Za-z:])"),
    ("ip", rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"),
    # With a country code; with an area code in brackets or after a 0; three, three and four digits.
    ("phone", r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,3}(?![\d-])"),
    ("phone", r"(?<![\d+)-])(?:\(\d{3,5}\)[ -]?\d{3,4}(?:[ -]\d{2,4}){1,2}|0\d{2,4}[ /-]\d{3,4}[ -]\d{2,4}(?:[ -]\d{2,4})?|\d{3}-\d{3}-\d{4})(?![\d-])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?![\d-])"),
    ("name", rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? {_NAME}(?: {_NAME})?+"),
]
#: A capitalised word; in texts that name someone each may be a short form.
WORD = rf"(?<![\p{{L}}\p{{N}}]){_NAME}(?![\p{{L}}\p{{N}}])"
ANY = "|".join(p for _, p in KINDS)
ANY_OR_WORD = f"{ANY}|{WORD}"
#: Common given names by gender and script, and syllables of family names.
GIVEN = {
    "m": "James John Robert Michael David Thomas Daniel Paul Mark Peter Simon Martin Oscar Victor Leo Hugo Felix Adam Lucas Henry".split(),
    "f": "Mary Anna Emma Laura Sarah Julia Clara Maria Helen Alice Nora Irene Sofia Elena Martha Diana Eva Lucy Rose Carla".split(),
    "mc": "Иван Пётр Сергей Андрей Павел Олег Николай Виктор Максим Денис".split(),
    "fc": "Анна Мария Елена Ольга Ирина Наталья Вера Нина Дарья Софья".split(),
}
SYLLABLES = {"latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve wa we za".split(), "cyrillic": "ба бе бо ва ве во га го да де до за ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то".split()}


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _draw(h: Column, place: Column, size: int) -> Column:
    """A number below size from four hex digits of h at a place (wrapped), as int."""
    at = (F.pmod(place * 5, F.lit(60)) + 1).cast("int")
    return F.pmod(F.conv(F.substring(h, at, F.lit(4)), 16, 10).cast("int") + place * 7, F.lit(size)).cast("int")


def _pick(items: list[str], k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in items]), k + 1)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _similar(value: Column, h: Column, hexa: bool = False) -> Column:
    """Each ASCII letter and digit of value replaced by one of its class, other letters by a letter of their kind, the rest as it is."""

    def one(c: Column, k: Column) -> Column:
        letter = _pick(list("abcdef" if hexa else "abcdefghijklmnopqrstuvwxyz"), _draw(h, k, 6 if hexa else 26))
        cyr = _pick(list("абвгдежзиклмнопрстуфхц"), _draw(h, k, 22))
        return F.when(c.rlike("^[0-9]$"), _draw(h, k, 10).cast("string")).when(c.rlike(r"^\p{IsCyrillic}$"), cyr).when(c.rlike(r"^\p{L}$"), letter).otherwise(c)

    return F.array_join(F.transform(_chars(value), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10."""

    def step(acc: Column, c: Column) -> Column:
        d = c.cast("int") * F.when(acc["twice"], 2).otherwise(1)
        return F.struct((acc["s"] + d - F.when(d > 9, 9).otherwise(0)).cast("int").alias("s"), (~acc["twice"]).alias("twice"))

    return F.aggregate(F.reverse(_chars(digits)), F.struct(F.lit(0).alias("s"), F.lit(False).alias("twice")), step)["s"] % 10


def mention_kind(m: Column) -> Column:
    out = F.when(m.rlike(f"^(?:{KINDS[0][1]})$"), KINDS[0][0])
    for kind, p in KINDS[1:]:
        out = out.when(m.rlike(f"^(?:{p})$"), kind)
    return out


_SPLIT_NAME = rf"^({_TITLE})(\.? )(.*)$"


def canonical(kind: Column, m: Column) -> Column:
    """What mentions of one entity have in common. A name counts with the gender of its title, not with the title."""
    low = F.when(F.length(F.lower(m)) == F.length(m), F.lower(m)).otherwise(m)
    title = F.regexp_extract(m, _SPLIT_NAME, 1)
    name = F.concat(F.when(title.isin(*FEMALE), "f ").otherwise("m "), F.regexp_extract(m, _SPLIT_NAME, 3))
    code = r"^(\+\d{1,3}|\D?\d)"  # country code, or first digit
    phone = F.concat(F.regexp_replace(F.regexp_extract(m, code, 1), r"[^+\d]", ""), F.lit(" "), _digits(F.regexp_replace(m, code, "")))
    return F.when(kind.isin("email", "secret", "ip6"), low).when(kind == "ip", m).when(kind == "iban", F.replace(m, F.lit(" "), F.lit(""))).when(kind == "name", name).when(kind == "phone", phone).otherwise(_digits(m))


def _mod97(s: Column) -> Column:
    """Of digits and capital letters, which count as 10 to 35."""

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97).cast("int")

    return F.aggregate(_chars(s), F.lit(0), step)


def surrogate(kind: Column, value: Column, h: Column, attempt: Column) -> Column:
    """The surrogate's canonical value: same type, length and format; validity of check digits, country code, gender and script as in value.

    Names get a syllable more with each attempt. From the ninth attempt on, when a format is nearly full, numbers get a digit
    more with each, addresses a letter, and IP numbers are of the eight-group form: distinct beats equally long.
    """
    more = F.greatest(attempt - 7, F.lit(0))

    def tail(alphabet: str, place: int) -> Column:
        return F.when(more > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(more, F.lit(1))), lambda k: _pick(list(alphabet), _draw(h, k * 3 + place, len(alphabet)))), "")).otherwise("")

    digits = tail("0123456789", 50)
    at, dot = F.locate("@", value), F.length(F.substring_index(value, ".", -1))
    domain = F.substr(value, at + 1)
    email = F.concat(_similar(F.substr(value, F.lit(1), at - 1), h), tail("abcdefghijklmnopqrstuvwxyz", 40), F.lit("@"), _similar(F.substr(domain, F.lit(1), F.length(domain) - dot), F.reverse(h)), F.substring_index(value, ".", -1))
    groups = F.concat(F.lit("2001:db8:"), F.array_join(F.array(*[F.substring(h, 1 + 4 * k, 4) for k in range(6)]), ":"))
    ip = F.when(more > 0, groups).otherwise(F.concat_ws(".", *[(_draw(h, F.lit(3 * k), 254) + 1).cast("string") for k in range(4)]))
    ip6 = F.when(more > 0, groups).otherwise(_similar(value, h, hexa=True))
    phone = F.concat(F.substring_index(value, " ", 1), F.lit(" "), _similar(F.substring_index(value, " ", -1), h), digits)
    body = F.concat(F.substring(value, 1, 1), _similar(F.substr(value, F.lit(2), F.length(value) - 2), h), digits)
    # The last digit makes the Luhn sum that of the value: valid stays valid, and an invalid one stays as far off.
    last = F.pmod(_luhn(value) - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    card = F.concat(body, last)
    # IBAN: the country's letters stay, the account is drawn, the check number makes the remainder that of the value.
    account = F.concat(F.upper(_similar(F.substr(value, F.lit(5)), h)), digits)
    land = F.substring(value, 1, 2)
    off = _mod97(F.concat(F.substr(value, F.lit(5)), F.substring(value, 1, 4)))
    check = F.pmod(off - _mod97(F.concat(account, land, F.lit("00"))), F.lit(97))
    iban = F.concat(land, F.lpad(F.when(check < 2, check + 97).otherwise(check).cast("string"), 2, "0"), account)
    # Names: "f Anna Weber" keeps gender, script, number of words and hyphens.
    cyr, male = value.rlike(r"\p{IsCyrillic}"), F.substring(value, 1, 1) == "m"

    def family(k: Column) -> Column:
        def syllables(script: str) -> Column:
            return F.array_join(F.transform(F.sequence(F.lit(0), attempt + 2), lambda i: _pick(SYLLABLES[script], _draw(h, k * 4 + i, len(SYLLABLES[script])))), "")

        return F.initcap(F.when(cyr, F.concat(syllables("cyrillic"), F.when(male, "нов").otherwise("нова"))).otherwise(F.concat(syllables("latin"), F.lit("n"))))

    def given(names: list[str], own: Column) -> Column:
        at = _draw(h, F.lit(1), len(names))
        drawn = _pick(names, at)
        return F.when(drawn == own, _pick(names, F.pmod(at + 1, F.lit(len(names))))).otherwise(drawn)

    first = lambda w: F.when(cyr & male, given(GIVEN["mc"], w)).when(cyr, given(GIVEN["fc"], w)).when(male, given(GIVEN["m"], w)).otherwise(given(GIVEN["f"], w))
    parts = F.slice(F.split(value, " "), 2, 9)
    named = F.transform(parts, lambda w, k: F.when((F.size(parts) > 1) & (k == 0) & ~w.contains("-"), first(w)).otherwise(F.array_join(F.transform(F.split(w, "-"), lambda x, i: family(k * 2 + i + 2)), "-")))
    name = F.concat(F.substring(value, 1, 2), F.array_join(named, " "))
    out = F.when(kind == "email", email).when(kind == "secret", _similar(value, h, hexa=True)).when(kind == "iban", iban).when(kind == "ip", ip).when(kind == "ip6", ip6)
    return out.when(kind == "phone", phone).when(kind == "card", card).when(kind == "name", name).otherwise(F.concat(_similar(value, h), digits))


def written(kind: Column, m: Column, sur: Column) -> Column:
    """A surrogate in the format of one mention: its separators, title and case. A title with one word gets the family name alone."""

    def fill(sign: str):
        def step(acc: Column, c: Column) -> Column:
            own = c.rlike(sign)
            return F.struct(F.concat(acc["o"], F.when(own, F.substr(acc["s"], acc["k"], F.lit(1))).otherwise(c)).alias("o"), (acc["k"] + F.when(own, 1).otherwise(0)).alias("k"), acc["s"].alias("s"))

        return step

    def filled(s: Column, sign: str) -> Column:
        start = F.struct(F.lit("").alias("o"), F.lit(1).alias("k"), s.alias("s"))
        return F.aggregate(_chars(m), start, fill(sign), lambda acc: F.concat(acc["o"], F.substr(acc["s"], acc["k"])))

    cased = F.array_join(F.zip_with(_chars(m), _chars(sur), lambda a, b: F.when((F.upper(a) == a) & (F.lower(a) != a), F.upper(b)).otherwise(b)), "")
    rest = F.regexp_extract(m, _SPLIT_NAME, 3)
    name = F.concat(F.regexp_extract(m, _SPLIT_NAME, 1), F.regexp_extract(m, _SPLIT_NAME, 2), F.when(rest.contains(" "), F.substr(sur, F.lit(3))).otherwise(F.substring_index(sur, " ", -1)))
    out = F.when(kind.isin("email", "secret", "ip6"), cased).when(kind == "name", name).when(kind == "ip", sur)
    return out.when(kind == "iban", filled(sur, "^[0-9A-Z]$")).otherwise(filled(_digits(sur), "^[0-9]$"))


def keyed_hash(spark: SparkSession, key: str):
    """A function of a string Column: its HMAC-SHA256 as hex. The key reaches the plan as a subquery on a table of one row, so no plan or log shows it."""
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    pads = spark.createDataFrame([(bytearray(x ^ 0x36 for x in raw), bytearray(x ^ 0x5C for x in raw))], "inner binary, outer binary")
    inner, outer = (pads.select(c).scalar() for c in pads.columns)
    return lambda text: F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(text, "UTF-8")), 256))), 256)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, sur) for distinct (kind, value): all sur of a kind differ from each other and from all values.

    Of entities that draw the same surrogate that of the fewest attempts, then the smallest value, keeps it; the others, and those
    that drew a value of the texts, draw again. Spaces grow with the attempts, so this ends however many entities there are.
    """
    hashed = keyed_hash(entities.sparkSession, key)

    def draw(df: DataFrame) -> DataFrame:
        h = hashed(F.concat_ws("\x1f", "kind", "value", F.col("attempt").cast("string")))
        return df.select("kind", "value", "attempt", h.alias("h")).select("kind", "value", "attempt", surrogate(F.col("kind"), F.col("value"), F.col("h"), F.col("attempt")).alias("sur"))

    state = materialize(draw(entities.withColumn("attempt", F.lit(0))), "surrogates")
    while True:
        taken = state.groupBy("kind", "sur").agg(F.min(F.struct("attempt", "value")).alias("best"), F.count("*").alias("n")).where("n > 1").select("kind", "sur", F.col("best.value").alias("winner"))
        real = state.select("kind", F.col("value").alias("sur"), F.lit(True).alias("real"))
        told = state.join(taken, ["kind", "sur"], "left").join(real, ["kind", "sur"], "left")
        again = F.coalesce(F.col("real"), F.lit(False)) | (F.col("winner").isNotNull() & (F.col("winner") != F.col("value")))
        losers = materialize(told.where(again).select("kind", "value"), "surrogates-again")
        if losers.isEmpty():
            discard(losers)
            return state
        redrawn = draw(state.join(losers, ["kind", "value"], "left_semi").withColumn("attempt", F.col("attempt") + 1))
        nxt = materialize(state.join(losers, ["kind", "value"], "left_anti").unionByName(redrawn), "surrogates")
        discard(state)
        discard(losers)
        state = nxt


def resolved(mentions: DataFrame) -> DataFrame:
    """mentions (doc, body, pos, m, kind, value): the value of a title with a family name alone is that of the first full name of this gender and family name in the text, if there is one."""
    names = mentions.where("kind = 'name'").withColumn("words", F.split("value", " "))
    full = names.where(F.size("words") > 2).groupBy("doc", "body", F.element_at("words", 1).alias("g"), F.element_at("words", -1).alias("family")).agg(F.min_by("value", "pos").alias("person"))
    short = names.where(F.size("words") == 2).select("doc", "body", "pos", F.element_at("words", 1).alias("g"), F.element_at("words", 2).alias("family")).join(full, ["doc", "body", "g", "family"]).select("doc", "body", "pos", "person")
    return mentions.join(short, ["doc", "body", "pos"], "left").withColumn("value", F.coalesce("person", "value")).drop("person")


def short_forms(told: DataFrame, words: DataFrame) -> DataFrame:
    """(doc, body, pos, kind, said) for capitalised words (doc, body, pos, m, before, after) that are part of a person's name in their text.

    told: (doc, body, pos, kind, value, sur). A word goes with the word before or after it if both are a person's full name, else it
    is that of the first person who has it.
    """
    own, new = F.split("value", " "), F.split("sur", " ")
    people = told.where("kind = 'name'").groupBy("doc", "body", "value", "sur").agg(F.min("pos").alias("first")).select("doc", "body", "first", own.alias("o"), new.alias("s"))
    both = F.concat_ws(" ", F.get("o", F.lit(1)), F.get("o", F.lit(2)))
    entry = lambda key, k: F.struct(key.alias("key"), F.get("s", F.lit(k)).alias("said"))
    full = F.array(entry(F.concat(both, F.lit("|1")), 1), entry(F.concat(both, F.lit("|2")), 2), entry(F.get("o", F.lit(1)), 1), entry(F.get("o", F.lit(2)), 2))
    keys = people.select("doc", "body", "first", F.explode(F.when(F.size("o") > 2, full).otherwise(F.array(entry(F.get("o", F.lit(1)), 1)))).alias("e"))
    keys = keys.groupBy("doc", "body", F.col("e.key").alias("key")).agg(F.min_by("e.said", "first").alias("said"))
    tries = F.array(F.concat("before", F.lit(" "), "m", F.lit("|2")), F.concat("m", F.lit(" "), "after", F.lit("|1")), F.col("m"))
    asked = words.select("doc", "body", "pos", F.posexplode(tries).alias("rank", "key")).where("key is not null")
    return asked.join(keys, ["doc", "body", "key"]).groupBy("doc", "body", "pos").agg(F.min_by("said", "rank").alias("said")).select("doc", "body", "pos", F.lit("name").alias("kind"), "said")


def replace_entities(docs: DataFrame, key: str, *, id_col: str = "doc_id", text_col: str = "text", hot_share: int = 10_000) -> DataFrame:
    """All columns of docs with surrogates in the text, and n_entities (mentions, long) and entity_kinds (sorted array).

    key must be kept: who has it can tell which surrogate a value gets. Types are those of KINDS. Text outside of mentions stays
    byte for byte, and texts without any stay whole, however long. Null and empty texts stay. Rows of one id and text get one
    result each, null ids too. Someone who is nowhere in a text named with a title is not found. The empty table gives
    the empty table. Columns n_entities and entity_kinds of the input are replaced, others may have any name.

    A value that holds over one in hot_share of all mentions is joined by a broadcast, of hot_share rows at most; the rest by value.
    """
    if not key:
        raise ValueError("a key is needed")
    cols = [c for c in docs.columns if c not in ("n_entities", "entity_kinds")]
    text = F.col(text_col)
    # A row's identity; the id as text, so that null ids join too.
    doc, body = F.when(F.col(id_col).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(id_col).cast("string"))), F.xxhash64(text_col)
    # A cheap test first.
    likely = text.rlike(rf"@|\d[\d. ()-]|[0-9A-Fa-f]{{1,4}}:[0-9A-Fa-f:]|[0-9A-Fa-f]{{32}}|(?:{_TITLE})\.? \p{{Lu}}")
    names = text.rlike(KINDS[-1][1])
    none = F.array().cast("array<string>")
    found = F.when(likely & names, F.regexp_extract_all(text, F.lit(ANY_OR_WORD), F.lit(0))).when(likely, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)
    gaps = F.when(names, F.split(text, ANY_OR_WORD, -1)).otherwise(F.split(text, ANY, -1))
    some = docs.select(doc.alias("doc"), body.alias("body"), found.alias("found"), names.alias("names"), text.alias("text")).where(F.size("found") > 0)
    some = some.select("doc", "body", "found", F.when(F.col("names"), F.split("text", ANY_OR_WORD, -1)).alias("gaps"))
    # Each mention, and of a word the mentions that one blank parts from it.
    beside = lambda k, at: F.when(F.get("gaps", at) == " ", F.get("found", k))
    held = some.select("doc", "body", F.transform("found", lambda m, k: F.struct(k.alias("pos"), m.alias("m"), beside(k - 1, k).alias("before"), beside(k + 1, k + 1).alias("after"))).alias("found"))
    held = materialize(held.groupBy("doc", "body").agg(F.min("found").alias("found")), "mentions")
    kinds = materialize(held.select("doc", "body", F.inline("found")).withColumn("kind", mention_kind(F.col("m"))), "mention-kinds")
    mentions = kinds.where("kind is not null").select("doc", "body", "pos", "m", "kind", canonical(F.col("kind"), F.col("m")).alias("value"))
    mentions = materialize(resolved(mentions), "resolved-mentions")
    values = mentions.groupBy("kind", "value").agg(F.count("*").alias("n"))
    known = assign(values.select("kind", "value"), key).select("kind", "value", "sur")
    often = values.where(F.col("n") > mentions.count() / hot_share).select("kind", "value")
    hot = known.join(F.broadcast(often), ["kind", "value"], "left_semi")
    rare = known.join(F.broadcast(often), ["kind", "value"], "left_anti")
    first = mentions.join(F.broadcast(hot), ["kind", "value"], "left")
    told = materialize(first.where("sur is not null").unionByName(first.where("sur is null").drop("sur").join(rare, ["kind", "value"])), "told-mentions")
    said = told.select("doc", "body", "pos", "kind", written(F.col("kind"), F.col("m"), F.col("sur")).alias("said"))
    said = said.unionByName(short_forms(told, kinds.where("kind is null")))
    # Words that are no one's name stay. A group here is one text.
    said = kinds.select("doc", "body", "pos", "m").join(said, ["doc", "body", "pos"], "left").select("doc", "body", "pos", "kind", F.coalesce("said", "m").alias("said"))
    per = said.groupBy("doc", "body").agg(F.array_sort(F.collect_list(F.struct("pos", "said"))).alias("s"), F.array_sort(F.collect_set("kind")).alias("__kinds"), F.count("kind").alias("__n"))
    per = per.where("__n > 0").select(F.col("doc").alias("__doc"), F.col("body").alias("__body"), F.col("s.said").alias("__said"), "__kinds", "__n")
    keyed = docs.select(*cols).withColumn("__at", doc).withColumn("__text_hash", body)
    out = keyed.join(per, (keyed["__at"] == per["__doc"]) & (keyed["__text_hash"] == per["__body"]), "left")
    woven = F.array_join(F.flatten(F.zip_with(gaps, F.col("__said"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    new = F.when(F.col("__said").isNull(), text).otherwise(woven)
    return out.select(*[new.alias(c) if c == text_col else keyed[c] for c in cols], F.coalesce("__n", F.lit(0)).cast("long").alias("n_entities"), F.coalesce("__kinds", none).alias("entity_kinds"))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), "plumbline demonstration key")
