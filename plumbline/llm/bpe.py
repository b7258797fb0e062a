"""BPE encoding and decoding by a pair occurrence index.

All pre-tokens that a batch brings new are laid out in one array of symbols. An index maps each mergeable pair to
every position at which it stands; the ranks of pairs that occur are kept in a heap and applied in ascending order,
each to all its positions from left to right; only the lists of the pairs beside a merge change. A worker keeps the
encodings of pre-tokens that it has met, up to a bound; beyond it the store is emptied, which costs time alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.bytelevel import PATTERN, Vocabulary, default_path, pieces, vocabulary
from plumbline.llm.store import small_batches, table


def encode_words(words: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """The ids of each pre-token, by the pair occurrence index over all of them."""
    table = vocab.merge_table()
    raw = np.frombuffer(b"\x00".join(words) + b"\x00", np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    gap = np.cumsum(lengths + 1) - 1
    symbol = np.asarray(vocab.byte_id, np.int64)[raw]
    symbol[gap] = -1  # between words; no pair has it
    n = len(symbol)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    where: dict[int, list[np.ndarray]] = {}  # by rank of the pair: its positions
    active: list[int] = []

    def index(left: np.ndarray, right: np.ndarray) -> None:
        """Enters the pairs at positions left, right that have a rank."""
        rank = table.rank(symbol[left], symbol[right])
        keep = np.flatnonzero(rank >= 0)
        if not len(keep):
            return
        rank, left = rank[keep], left[keep]
        order = np.argsort(rank, kind="stable")
        rank, left = rank[order], left[order]
        edge = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.append(0, edge)].tolist(), np.split(left, edge) if len(edge) else [left], strict=True):
            if r in where:
                where[r].append(part)
            else:
                where[r] = [part]
                heappush(active, r)

    index(np.arange(n - 1), np.arange(1, n))
    while active:
        r = heappop(active)
        a, b, made = table.parts[r]
        lists = where.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[symbol[at] == a]
        to = after[at]
        fits = symbol[np.minimum(to, n - 1)] == b
        at, to = at[fits], to[fits]
        if a == b and len(at) > 1:  # of overlapping places the left one counts
            taken, use = -1, []
            for k, j in zip(at.tolist(), to.tolist(), strict=True):
                use.append(k != taken)
                taken = j if use[-1] else -1
            at, to = at[use], to[use]
        if not len(at):
            continue
        symbol[at], symbol[to] = made, -2
        nxt = after[to]  # a gap ends each word, so there is one
        after[at], before[nxt] = nxt, at
        index(at, nxt)
        prev = before[at]
        inside = prev >= 0
        index(prev[inside], at[inside])
    flat = symbol[symbol != -2]
    ends = np.flatnonzero(flat == -1).tolist()
    flat, out, start = flat.tolist(), [], 0
    for e in ends:
        out.append(flat[start:e])
        start = e + 1
    return out


#: The pattern for text that is all ASCII, where the classes are short lists.
ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"


class Encoder:
    """Encodes texts; keeps the encodings of at most `kept` pre-tokens beside those of the batch at hand."""

    def __init__(self, path: str, kept: int = 200_000):
        import re

        import regex

        self.vocab, self.kept = vocabulary(path), kept
        self.find, self.find_ascii = regex.compile(PATTERN).findall, re.compile(ASCII).findall
        self.ids: dict[str, str] = {}
        self.unlike: dict[str, str] = {}

    def learn(self, words: list[str]) -> None:
        """Encodes pre-tokens, decodes their ids, and notes those that come back unlike."""
        of, name = self.vocab.bytes_of, self.vocab.names
        raw = [w.encode() for w in words]
        for w, b, ids in zip(words, raw, encode_words(raw, self.vocab), strict=True):
            self.ids[w] = ",".join([name[i] for i in ids])
            if b"".join([of[i] for i in ids]) != b:
                self.unlike[w] = b"".join([of[i] for i in ids]).decode("utf-8", "replace")

    def batch(self, texts: list[str | None]) -> Iterator[tuple[str, int, str]]:
        """For each text: its ids joined by commas, their number, and the text that the ids decode to."""
        if len(self.ids) > self.kept:
            self.ids.clear()
            self.unlike.clear()
        added, known = self.vocab.added, self.ids.get
        cut, new = [], set()
        for t in texts:
            words = []
            for piece, special in pieces(t or "", added):
                if special:
                    words.append(piece)
                    self.ids[piece] = str(added[piece])
                else:
                    words += self.find_ascii(piece) if piece.isascii() else self.find(piece)
            got = list(map(known, words))
            if None in got:
                new.update(w for w, g in zip(words, got, strict=True) if g is None)
                got = None
            cut.append((words, got))
        if new:
            self.learn(list(new))
        for words, got in cut:
            joined = ",".join(got or map(known, words))
            back = [self.unlike.get(w, w) for w in words] if self.unlike else words
            yield joined, joined.count(",") + 1 if joined else 0, "".join(back)


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    path = path or default_path()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_decode(docs: DataFrame, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array) and decoded (string).

    Narrow: no shuffle, one pass, memory of one Arrow batch and the bounded store of pre-tokens. A null text counts as
    empty: no ids, the digests of the empty string. Repeated rows give repeated results; null ids stay null; columns
    other than the two named are not read. The empty table gives the empty table. The longest text is held whole in one task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids

    def run(batches):
        enc = encoder(path)
        for b in batches:
            ids, n, sha, back, arrays, texts = b.column(0), [], [], [], [], []
            for joined, count, decoded in enc.batch(b.column(1).to_pylist()):
                n.append(count)
                sha.append(hashlib.sha256(joined.encode()).hexdigest())
                back.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    arrays.append([int(x) for x in joined.split(",")] if joined else [])
                    texts.append(decoded)
            cols = [ids, pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            if with_ids:
                cols += [pa.array(arrays, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))
