"""Benchmark decontamination: an inverted BM25 index of test items, searched by every passage of the training texts.

Weights are BM25 impacts divided by the score of the item against itself, so one threshold holds for all items. Items
are sorted by length and cut into classes; a passage of a class is a window of twice the length of its longest item, a
new one at each such length, so that every run of words as long as an item lies within some passage. For all passages
of a batch a first bound is taken at once: the largest weights of a passage's rarer words, plus the most that the
common words can give any item of the class. Passages that pass run block-max WAND over the posting lists: lists are ordered by item, the pivot is the
first item whose upper bounds reach the threshold, and blocks of items whose block maxima can't reach it are skipped.
Every item at or over the threshold is retrieved; it is a leak if the shingles of its question and of its answer both
stand in the passage. Of an item of fewer words than a shingle the whole sequence must stand there. In scripts that are
written without blanks each character is a word, so their shingles are of characters.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.store import small_batches, table

#: ASCII punctuation and white space become blanks.
_BLANKED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


#: Characters of scripts without blanks between words: Thai, Lao, Burmese, Khmer, kana, Han; and the punctuation of the last two.
_SOLID = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_WIDE_MARKS = re.compile("[\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_ENDS = re.compile(r"(?<=[.?!])\s+|(?<=[\u3002\uff01\uff1f\uff0e])|\n+")


def words(text: str | None) -> list[bytes]:
    text = (text or "").lower()
    if not text.isascii() and (_SOLID.search(text) or _WIDE_MARKS.search(text)):
        text = _SOLID.sub(r" \g<0> ", _WIDE_MARKS.sub(" ", text))
    return text.encode("utf-8", "surrogatepass").translate(_BLANKED).split()


def halves(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of an item: all sentences but the last, and the last; of one sentence, itself twice."""
    parts = [p for p in (words(s) for s in _ENDS.split(text)) if p]
    if len(parts) < 2:
        return (parts[0], parts[0]) if parts else ([], [])
    return [w for p in parts[:-1] for w in p], parts[-1]


def grams(tokens: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(tokens[k:] for k in range(n)), strict=False))


class Postings:
    """Posting lists of one length class: by term, items in order, their weights, and the maximum of each block of items."""

    def __init__(self, items: list[dict[int, float]], block: int):
        self.block = block
        lists: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for k, weights in enumerate(items):
            for t, w in weights.items():
                lists[t].append((k, w))
        self.lists, self.most, self.block_most = {}, {}, {}
        for t, own in lists.items():
            self.lists[t] = own
            self.most[t] = max(w for _, w in own)
            self.block_most[t] = top = {}
            for k, w in own:
                top[k // block] = max(w, top.get(k // block, 0.0))

    def search(self, terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """(item, score) of every item whose score reaches the threshold."""
        slack = threshold - 1e-9
        cursors = [[self.lists[t][0][0], 0, t] for t in terms if t in self.lists]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += self.most[c[2]]
                if bound >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            b = item // self.block
            if sum(self.block_most[c[2]].get(b, 0.0) for c in cursors[: pivot + 1]) < slack:
                to = (b + 1) * self.block  # nothing in this block up to the next list's item
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, item + 1)
            elif cursors[0][0] == item:
                score = sum(self.lists[c[2]][c[1]][1] for c in cursors[: pivot + 1])
                if score >= slack:
                    found.append((item, score))
                to = item + 1
            else:
                to = item
            for c in cursors[: pivot + 1]:
                own = self.lists[c[2]]
                while c[1] < len(own) and own[c[1]][0] < to:
                    c[1] += 1
                c[0] = own[c[1]][0] if c[1] < len(own) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found


def count_words(texts) -> tuple[int, int, Counter]:
    """The number of texts with words, of their words, and of the texts that hold each word."""
    n, size, df = 0, 0, Counter()
    for t in texts:
        ws = words(t)
        n, size = n + bool(ws), size + len(ws)
        df.update(set(ws))
    return n, size, df


class Index:
    """Items (id, text) with words, by length class. totals: (items, words, items by word) of all items, if these are a part of them."""

    def __init__(self, items: list[tuple[int, str]], totals: tuple[int, int, Counter] | None = None, *, threshold: float = 0.6, shingle: int = 5, block: int = 4, k1: float = 1.2, b: float = 0.75, common_share: float = 0.25, most_classes: int = 32, least_class: int = 8):
        self.threshold, self.shingle = threshold, shingle
        rows = [r for r in ((i, words(t), t) for i, t in sorted(items, key=str)) if r[1]]
        self.term: dict[bytes, int] = {}
        n_items, n_words, df = totals or count_words(t for _, _, t in rows)
        for w in sorted({w for _, ws, _ in rows for w in ws}):
            self.term[w] = len(self.term)
        mean = n_words / max(1, n_items)
        idf = {w: log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) for w in self.term}
        own = []
        for i, ws, t in rows:
            tf = Counter(ws)
            raw = {self.term[w]: idf[w] * n * (k1 + 1) / (n + k1 * (1 - b + b * len(ws) / mean)) for w, n in tf.items()}
            whole = sum(raw.values())
            q, a = halves(t) if len(ws) >= shingle else (ws, ws)
            n_q, n_a = min(shingle, len(q)), min(shingle, len(a))
            own.append((len(ws), i, {t: w / whole for t, w in raw.items()}, (n_q, grams(q, n_q)), (n_a, grams(a, n_a))))
        own.sort(key=lambda r: (r[0], str(r[1])))
        size = max(least_class, -(-len(own) // most_classes))
        classes = [own[k : k + size] for k in range(0, len(own), size)]
        self.classes = []
        often = {k: df[w] for w, k in self.term.items()}
        for own in classes:
            length = own[-1][0]
            # The most frequent terms count as common while no item gets more than common_share of its score from them.
            common, got = set(), [0.0] * len(own)
            holders = defaultdict(list)
            for k, r in enumerate(own):
                for t, w in r[2].items():
                    holders[t].append((k, w))
            for t in sorted(holders, key=lambda t: (-often[t], t)):
                if any(got[k] + w > common_share for k, w in holders[t]):
                    break
                common.add(t)
                for k, w in holders[t]:
                    got[k] += w
            rare = np.zeros(len(self.term) + 1)  # the last: words of no item
            for t, h in holders.items():
                if t not in common:
                    rare[t] = max(w for _, w in h)
            self.classes.append((length, own, Postings([r[2] for r in own], block), rare, max(got)))

    def batch(self, texts: list[str | None]) -> list[dict[int, tuple]]:
        """For each text the leaked items: {item id: (score, share of question, share of answer, first word of the passage)}."""
        split = [words(t) for t in texts]
        sizes = np.array([len(ws) for ws in split], np.int64)
        out: list[dict[int, tuple]] = [{} for _ in texts]
        if not sizes.sum() or not self.classes:
            return out
        none, get = len(self.term), self.term.get
        ids = np.concatenate([np.fromiter(map(get, ws, repeat(none)), np.int64, len(ws)) for ws in split])
        base = np.append(0, np.cumsum(sizes)[:-1])
        for length, own, postings, rare, common in self.classes:
            per = -(-sizes // length)
            doc = np.repeat(np.arange(len(texts)), per)
            inner = np.arange(len(doc)) - np.repeat(np.append(0, np.cumsum(per)[:-1]), per)
            start = base[doc] + inner * length
            part = np.add.reduceat(rare[ids], start) if len(start) else np.empty(0)
            both = part.copy()
            both[:-1] += np.where(doc[1:] == doc[:-1], part[1:], 0)
            for k in np.flatnonzero(both + common >= self.threshold - 1e-9).tolist():
                d, at = int(doc[k]), int(inner[k]) * length
                passage = split[d][at : at + 2 * length]
                s = int(start[k])
                hits = postings.search(set(ids[s : s + len(passage)].tolist()) - {none}, self.threshold)
                seen: dict[int, set] = {}
                for item, score in hits:
                    _, i, _, question, answer = own[item]
                    shares = []
                    for n, want in (question, answer):
                        if n not in seen:
                            seen[n] = grams(passage, n)
                        shares.append(sum(g in seen[n] for g in want) / len(want))
                    if min(shares) >= 0.8 and (i not in out[d] or (score, *shares) > out[d][i][:3]):
                        out[d][i] = (score, *shares, at)
        return out


def indexes(benchmark: DataFrame, *, id_col: str, text_col: str, most_chars: int, **params):
    """Indexes of bounded shards of the test items: one, unless the items have more than most_chars characters. Weights are those of all items, whatever the shards; of all items the driver keeps the counts of words."""
    rows = benchmark.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    size = rows.agg(F.sum(F.length("t")).alias("s")).first()["s"] or 0
    shards = max(1, -(-size // most_chars))
    totals = count_words(r["t"] for r in rows.select("t").toLocalIterator()) if shards > 1 else None
    for k in range(shards):
        yield Index([(r["i"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("i"), F.lit(shards)) == k).collect()], totals, **params)


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", most_chars: int = 16 << 20, **params) -> DataFrame:
    """One row for each row of docs and test item that leaked into it: id, item_id, score (0 to 1), question_share, answer_share, at (first word of the passage).

    Narrow: the index goes along with the tasks, in shards of bounded size, one pass over the texts for each. Every
    passage of every text is a query. Null and empty texts and items match nothing, nor do those without words. Items of any
    length count: one of fewer than five words leaks into each text that holds just these words in a row, so callers who
    don't want that leave such items out. Repeated rows give repeated results, null ids stay null, other columns are not read.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    small_batches(spark)
    schema = f"`{id_col}` {kind}, item_id {item_kind}, score double, question_share double, answer_share double, `at` long"
    found = None
    for index in indexes(benchmark, id_col=item_id, text_col=item_text, most_chars=most_chars, **params):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for b in batches:
                own, rows = b.column(0), []
                for k, got in enumerate(sent.value.batch(b.column(1).to_pylist())):
                    rows += [(k, i, *v) for i, v in got.items()]
                cols = [own.take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.string() if item_kind == "string" else pa.int32() if item_kind == "int" else pa.int64())]
                cols += [pa.array([r[c] for r in rows], pa.float64()) for c in (2, 3, 4)] + [pa.array([r[5] for r in rows], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=[id_col, "item_id", "score", "question_share", "answer_share", "at"])

        one = docs.select(id_col, text_col).mapInArrow(run, schema)
        found = one if found is None else found.unionAll(one)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", most_chars: int = 16 << 20, **params) -> DataFrame:
    """The rows of docs, with their columns, whose text holds no test item; items and texts as in leaks().

    Narrow: a text passes the shards of the index one after the other in one task. Null and empty texts stay, as do repeated rows and null
    ids, which are not read. Columns may have any name. Without items all rows stay; the empty table gives the empty table.
    """
    from pyspark.sql import types as T

    small_batches(docs.sparkSession)
    place, names = docs.columns.index(text_col), docs.columns
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    for index in indexes(benchmark, id_col=item_id, text_col=item_text, most_chars=most_chars, **params):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for b in batches:
                keep = [not got for got in sent.value.batch(b.column(place).to_pylist())]
                yield pa.RecordBatch.from_arrays(b.filter(pa.array(keep)).columns, names=names)

        docs = docs.mapInArrow(run, schema)
    return docs


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
