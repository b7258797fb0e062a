"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is cross-parsed against it: the longest match
from the current place is one phrase, and the next phrase begins where it ends; the fewer phrases a text needs,
the closer it is to the language. Phrase counts are normalised by the number of symbols, and the language that needs
fewest wins. Matches are found by walking the automaton from its root: a step without an edge ends the phrase.

Letters are lower-cased, runs of anything else become one blank. Every letter of the samples is a symbol, of whatever
script. Automata are kept as displaced sparse rows, so that they take memory by their edges and not by the number of symbols.

All texts of a batch are parsed in lockstep. Long texts are cut into blocks for that, which changes no count: each block is
parsed from the root first, and then again from the state in which the block before ends, up to the first place where
both parses begin a phrase; from there on they are the same.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.store import small_batches, table


@lru_cache(1)
def folded() -> np.ndarray:
    """For each code point: its lower-case letter, or 32 where it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters(text: str) -> np.ndarray:
    """The text's lower-case letters as code points, runs of other characters as one 32; none before the first letter or after the last."""
    x = folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = x == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    x = x[keep]
    first, last = (int(x[0] == 32), len(x) - int(x[-1] == 32)) if len(x) else (0, 0)
    return x[first:last]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The edges of each state of the automaton of all substrings; state 0 is the root."""
    edges: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in symbols:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return edges


def displaced(edges: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(base, cells): the edge of state s by symbol c (below width) is in cells[base[s] + c], as s << 32 | next state, if its upper half is s.

    Rows are laid over each other where their edges leave cells free: those of most edges first at random places, those of one edge into the gaps.
    """
    used, base, filled = bytearray(width), [0] * len(edges), {}
    rng = random.Random(0)
    free, top = 0, width  # no cell below free is free
    for s in sorted(range(len(edges)), key=lambda s: -len(edges[s])):
        own = sorted(edges[s])
        if not own:
            continue
        used.extend(bytes(max(0, top + 2 * width - len(used))))
        if len(own) == 1:
            free = used.find(0, free)
            shift = used.find(0, max(free, own[0])) - own[0]
        else:
            shift, room = rng.randrange(top), max(top, 3 * len(filled))
            while any(used[shift + c] for c in own):
                room += room >> 8  # more room with each try
                shift = rng.randrange(min(room, top + width))
        top = max(top, shift + own[-1] + 1)
        base[s] = shift
        for c in own:
            used[shift + c] = 1
            filled[shift + c] = s << 32 | edges[s][c]
    cells = np.full(max(base, default=0) + width, -1, np.int64)
    cells[list(filled)] = list(filled.values())
    return np.array(base, np.int32), cells


class Parser:
    """Automata of several languages as tables. samples: {language: code points of its text}. A million edges take about 8 MB."""

    def __init__(self, samples: dict[str, np.ndarray], block: int = 1024):
        self.langs, self.block = sorted(samples), block
        self.seen = np.unique(np.concatenate([samples[k] for k in self.langs])).astype(np.int64)
        self.tables = []
        for k in self.langs:
            edges = suffix_automaton(self.symbols(samples[k]).tolist())
            root = np.zeros(len(self.seen) + 1, np.int32)
            for c, to in edges[0].items():
                root[c] = to
            # At the root no phrase is open, so any symbol begins one: the root has no edges of its own.
            self.tables.append((root, *displaced([{}, *edges[1:]], len(self.seen) + 1)))

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Numbers of code points, 0 for those in no sample."""
        at = np.minimum(np.searchsorted(self.seen, points), len(self.seen) - 1)
        return np.where(self.seen[at] == points, at + 1, 0).astype(np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """The number of phrases of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            return out
        data = self.symbols(np.concatenate(texts))
        base = np.append(0, np.cumsum(sizes)[:-1])
        per = -(-sizes // self.block)
        owner = np.repeat(np.arange(len(texts)), per)
        inner = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(per)[:-1]), per)
        start = base[owner] + inner * self.block
        size = np.minimum(self.block, sizes[owner] - inner * self.block)
        for k, table in enumerate(self.tables):
            begins = np.zeros(len(data), bool)
            end = self._walk(table, data, begins, start, size, np.zeros(len(start), np.int32))
            came = np.zeros(len(start), np.int32)  # the state in which each block was entered
            while True:
                enter = np.append(np.int32(0), end[:-1])
                again = np.flatnonzero((inner > 0) & (enter != came))
                if not len(again):
                    break
                came[again] = enter[again]
                got = self._walk(table, data, begins, start[again], size[again], enter[again], meet=True)
                end[again] = np.where(got >= 0, got, end[again])
            out[:, k] = np.add.reduceat(np.append(begins, False), np.minimum(base, len(data)), dtype=np.int64)
        out[sizes == 0] = 0
        return out

    @staticmethod
    def _walk(table, data, begins, start, size, state, meet=False) -> np.ndarray:
        """Parses blocks from the states given, in lockstep, marks in begins where a phrase begins, and returns their last states.

        meet: begins holds an earlier parse; a block is left as it was from where both begin a phrase, and its last state is then -1.
        """
        root, base, cells = table
        order = np.argsort(-size, kind="stable")
        start, size, state = start[order], size[order], state[order]
        last = np.full(len(order), -1, np.int32)
        live, step = np.arange(len(order)), 0
        while True:
            n = int(np.searchsorted(-size, -step, side="left"))  # blocks longer than step
            if n < len(live):
                last[live[n:]] = state[n:]
                live, start, size, state = live[:n], start[:n], size[:n], state[:n]
            if not n:
                break
            at = start + step
            c = data[at]
            cell = cells[base[state] + c]
            new = cell >> 32 != state
            state = np.where(new, root[c], cell).astype(np.int32)
            if meet:
                on = ~(new & begins[at])
                begins[at] = new
                if not on.all():
                    live, start, size, state = live[on], start[on], size[on], state[on]
            else:
                begins[at] = new
            step += 1
        out = np.empty(len(order), np.int32)
        out[order] = last
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; ("und", 0.0) if it is null or has no letter. The score is the share by which the best language needs fewer phrases than the second; of equals the first by name wins."""
        symbols = [letters(t or "") for t in texts]
        counts = self.phrases(symbols)
        best = counts.argmin(axis=1)
        two = np.sort(counts, axis=1)
        second = two[:, 1] if two.shape[1] > 1 else two[:, 0]
        score = np.where(second > 0, (second - two[:, 0]) / np.maximum(second, 1), 0.0) if two.shape[1] > 1 else np.ones(len(texts))
        return [(self.langs[b], float(s)) if len(x) else ("und", 0.0) for b, s, x in zip(best.tolist(), score.tolist(), symbols, strict=True)]


def train_samples(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rows: int = 300, chars: int = 30_000, text_chars: int = 4000) -> dict[str, np.ndarray]:
    """Of each language the `rows` different texts (all if there are fewer) that are first by a hash, and at most `chars` symbols of them, of a text those of its first `text_chars` characters.

    Copies count once. The last hash that is taken is found by ranks, of which every task keeps `rows` a language; languages beyond 200 raise ValueError.
    """
    rows_of = labelled.where(F.col(lang_col).isNotNull() & F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    hashed = F.xxhash64(text_col, F.lit(1))
    keys = rows_of.select(F.col(lang_col).alias("lang"), F.pmod(hashed, F.lit(1 << 30)).alias("at"), hashed.alias("h")).distinct()
    counts = [r[0] for r in keys.select("lang").distinct().limit(201).collect()]
    if len(counts) > 200:
        raise ValueError("more than 200 languages")
    if not counts:
        return {}
    ranked = keys.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("at", "h"))).where(F.col("k") <= rows)
    last = {r["lang"]: r["last"] for r in ranked.groupBy("lang").agg(F.max(F.struct("at", "h")).alias("last")).collect()}
    limit = F.create_map(*[x for k, v in last.items() for x in (F.lit(k), F.struct(F.lit(v["at"]).cast("long").alias("at"), F.lit(v["h"]).cast("long").alias("h")))])
    got = rows_of.select(F.col(lang_col).alias("lang"), F.substring(text_col, 1, text_chars).alias("text"), F.pmod(hashed, F.lit(1 << 30)).alias("at"), hashed.alias("h")).where(F.struct("at", "h") <= F.element_at(limit, F.col("lang")))
    texts: dict[str, set] = {k: set() for k in counts}
    for r in got.groupBy("lang", "at", "h").agg(F.min("text").alias("text")).collect():
        texts[r["lang"]].add((r["at"], r["text"]))
    out = {}
    for k, own in texts.items():
        parts = [np.append(letters(t), np.uint32(32)) for _, t in sorted(own)[:rows]]
        if parts:
            out[k] = np.concatenate(parts)[:chars]
    return out


def identify(docs: DataFrame, samples: dict[str, np.ndarray], *, text_col: str = "text") -> DataFrame:
    """All columns of docs, and lang_pred (a language of the samples, or und for a null text or one without letters) and score (0 to 1).

    Narrow: automata are built once, and their tables, bounded by the parameters of the samples (about 2 MB a language), are sent to the
    workers. Whole texts are parsed, of any length. A text to which several languages fit equally gets the first of them by name and score 0;
    so does one whose letters are in no sample. Repeated rows get equal results each. The empty table gives the empty table. Without any
    samples every text is und. Columns of the same names are replaced.
    """
    from pyspark.sql import types as T

    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    samples = {k: v for k, v in samples.items() if len(v)}
    sent = docs.sparkSession.sparkContext.broadcast(Parser(samples) if samples else None)
    names = docs.columns
    place = names.index(text_col)

    def run(batches):
        p = sent.value
        for b in batches:
            got = p.predict(b.column(place).to_pylist()) if p else [("und", 0.0)] * b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[*names, "lang_pred", "score"])

    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in docs.schema], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1. A null id is held out too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def learn(docs: DataFrame, **bounds) -> dict[str, np.ndarray]:
    """Samples of the documents that are not held out."""
    return train_samples(docs.where(~held_out()), **bounds)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text", held_out().alias("held_out")), learn(docs))
    return out.select("doc_id", "held_out", "lang_pred", "score")
