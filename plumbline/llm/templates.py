"""Line dedup by a log-template tree.

A line descends a tree of fixed depth: first by its number of tokens, then by its leading tokens, where tokens with
digits count as a variable field. In a leaf, the tokens of a line that fewest other lines have at their place, up to a fifth of
them, are variable fields too, if more than one line has each of the others; so lines that differ in a few fields have one
template, whether or not a field's values repeat. Templates that recur across documents are dropped from all documents but
the first. All of it is built from DataFrame functions.

A line is known by two hashes of 64 bits, of its leaf and of all its tokens; so two lines are taken for one only if the latter are equal
among the lines of one start and length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import materialize, table

FIELD = "<*>"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _parsed(docs: DataFrame, depth: int) -> DataFrame:
    """(doc, body, pos, tokens, n, leaf, t) for each line; body identifies the text, leaf and t the masked line."""
    text = F.col("text")
    # All of it once a text, white space as blanks: a split at one character needs no pattern.
    text = F.when(text.rlike(r"\d"), F.regexp_replace(text, r"(?<!\S)[^\d\s]*+\d\S*+", FIELD)).otherwise(text)
    for c in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    lines = docs.select("doc", "body", F.posexplode(_lines(text)).alias("pos", "line"))
    told = lines.select("doc", "body", "pos", F.array_remove(F.split("line", " "), "").alias("tokens")).withColumn("n", F.size("tokens"))
    return told.withColumn("leaf", F.xxhash64("n", F.slice("tokens", 1, depth))).withColumn("t", F.xxhash64("tokens", F.lit(1)))


def generalised(parsed: DataFrame, lines: DataFrame, shared: float, least_tokens: int, most_broadcast: int = 500_000) -> DataFrame:
    """(leaf, t, g): for masked lines of at least least_tokens in leaves that hold several, the template that generalises them.

    Of each token it counts how many different lines of the leaf have it at its place, of fields of digits too. The least number that
    a share of `shared` of the line's tokens reaches says how many lines are alike; tokens that fewer have are fields. A line
    for which this is one has no template but itself.
    lines: parsed without tokens, kept. Leaves with several lines are few; up to most_broadcast of them (16 bytes each) they
    go to the lines, beyond that the lines are dealt by leaf.
    """
    told = lines.where(F.col("n") >= least_tokens).select("leaf", "t", F.xxhash64("doc").alias("d"))
    leaves = told.groupBy("leaf").agg(F.min("t").alias("a"), F.max("t").alias("z"), F.min("d").alias("d"), F.max("d").alias("e")).where("a <> z and d <> e").select("leaf")
    leaves = materialize(leaves, "leaves")
    if leaves.count() <= most_broadcast:
        leaves = F.broadcast(leaves)
    # Each different line once, its tokens as hashes; copies end here.
    several = parsed.where(F.col("n") >= least_tokens).join(leaves, "leaf", "left_semi")
    several = several.select("leaf", "t", F.transform("tokens", lambda x: F.xxhash64(x)).alias("tokens"))
    own = materialize(several.groupBy("leaf", "t").agg(F.first("tokens").alias("tokens")), "leaf-lines")
    at = own.select("leaf", "t", F.posexplode("tokens").alias("p", "token"))
    common = at.groupBy("leaf", "p", "token").agg(F.count("*").alias("k")).where("k > 1")
    at = at.join(common, ["leaf", "p", "token"], "left")
    # A group here is one line.
    made = at.groupBy("leaf", "t").agg(F.sort_array(F.collect_list(F.struct("p", "token", F.coalesce("k", F.lit(1)).alias("k")))).alias("parts"))
    fields = F.floor(F.size("parts") * (1 - shared) + 1e-9).cast("int")

    def template(alike: Column) -> Column:
        return F.struct(alike.alias("alike"), F.xxhash64(F.transform("parts", lambda x: F.when(x["k"] >= alike, x["token"]).otherwise(F.lit(0).cast("long")))).alias("g"))

    # An array of one element, so that the least number is found once a line.
    told = F.inline(F.transform(F.array(F.get(F.sort_array("parts.k"), fields)), template))
    return made.select("leaf", "t", told).where("alike > 1").select("leaf", "t", "g")


def drop_recurring_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", depth: int = 3, shared: float = 0.8, long_tokens: int = 8, short_tokens: int = 4, long_docs: int = 2, mid_docs: int = 3, short_docs: int = 10
) -> DataFrame:
    """All columns of docs with the recurring lines of the text removed, and n_lines, n_dropped (longs).

    A template recurs if it stands in long_docs different documents (mid_docs below long_tokens tokens; short_docs below
    short_tokens, as such lines coincide by chance), however many documents there are. The document of the smallest id
    keeps its lines; every other drops them, repeats within it included. Lines without tokens, and all lines of documents
    that keep them, stay byte for byte. A text that loses all lines is empty. A null text stays null with no lines.
    Documents are told apart by id; rows of one id and one text get one result each, rows without id count as one document
    after all others. Texts may be of any length. The empty table gives the empty table. Columns n_lines and n_dropped of the
    input are replaced, others may have any name.
    """
    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # Nothing is the largest document: ids order first by being null.
    doc = F.struct(F.col(id_col).isNull().alias("x"), F.col(id_col).alias("id"))
    body = F.xxhash64(text_col)
    parsed = _parsed(docs.select(doc.alias("doc"), body.alias("body"), F.col(text_col).alias("text")), depth)
    lines = materialize(parsed.select("doc", "body", "pos", "n", "leaf", "t"), "lines")
    # Lines of up to depth tokens are their leaf.
    more = generalised(parsed, lines, shared, depth + 1)
    # A template's documents: first one row for each document that holds it, then their number.
    held = lines.where("n > 0").groupBy("leaf", "t", "n", "doc").agg(F.count("*").alias("k"))
    held = materialize(held.join(more, ["leaf", "t"], "left").select("leaf", "t", "n", "doc", F.coalesce("g", "t").alias("g")), "templates")
    need = F.when(F.col("n") >= long_tokens, long_docs).when(F.col("n") >= short_tokens, mid_docs).otherwise(short_docs)
    stands = held.select("leaf", "g", "n", "doc").distinct().groupBy("leaf", "g", "n").agg(F.count("*").alias("docs"), F.min("doc").alias("first")).where(F.col("docs") >= need)
    doomed = held.join(stands.select("leaf", "g", "first"), ["leaf", "g"]).where("doc <> first").select("leaf", "t", "doc")
    # The flags of a document's lines in order, so that filtering is one lookup a line however many go.
    told = lines.join(doomed.withColumn("gone", F.lit(True)), ["leaf", "t", "doc"], "left").select("doc", "body", "pos", F.coalesce("gone", F.lit(False)).alias("gone"))
    flags = told.groupBy("doc", "body").agg(F.sort_array(F.collect_set(F.struct("pos", "gone"))).alias("f"), F.max("gone").alias("some")).where("some")
    flags = flags.select(F.col("doc").alias("__doc"), F.col("body").alias("__body"), F.col("f.gone").alias("__gone"))
    keyed = docs.select(*cols).withColumn("__doc", doc).withColumn("__body", body)
    out = keyed.join(flags, ["__doc", "__body"], "left")
    all_lines = _lines(F.col(text_col))
    kept = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(F.filter(all_lines, lambda line, p: ~F.col("__gone")[p]), "\n"))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(all_lines)).cast("long")
    n_dropped = F.when(F.col("__gone").isNull(), 0).otherwise(F.size(F.filter("__gone", lambda g: g))).cast("long")
    return out.select(*[kept.alias(c) if c == text_col else F.col(c) for c in cols], n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "n_lines", "n_dropped")
