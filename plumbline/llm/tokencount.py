"""Token counts by a tokenizer compiled to a deterministic transducer over bytes.

A state stands for everything that the tokens of a text's prefix tell of what may follow: the mode of the pre-token
pattern, and for the open pre-token those positions from which a token may still reach on, each with its place in the
trie of tokens, the token that ends there, and its count relative to now. A transition carries the change of the count
of tokens of the whole prefix, which may be negative when a longer token replaces several. Sums of these along a text
are its count, and states and transitions are compiled when first met. That the last token of each prefix is
found from pairs of neighbours alone is a known property of BPE by merge ranks: a segmentation is the right one just
if each two neighbours, joined, segment into these two.

Texts are cut into chunks; the chunks of a batch run in lockstep, one table lookup for all of them at each step. A
chunk begins where a blank follows a byte that is no white space. There every open state maps to the same state, so a
chunk's state map is constant, and maps compose by adding their counts in a segmented prefix scan.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.bytelevel import SPACE, default_path, vocabulary
from plumbline.llm.store import small_batches, table



@lru_cache(1 << 16)
def kind_of(char: str) -> str:
    if char in SPACE:
        return "W"
    try:
        import regex

        return "L" if regex.match(r"\p{L}", char) else "N" if regex.match(r"\p{N}", char) else "O"
    except ImportError:
        k = unicodedata.category(char)[0]
        return k if k in "LN" else "O"


class Words:
    """The machine of one open pre-token. A state is a tuple of live positions: (trie node, what the token that ends
    there allows, count relative to now). Where few tokens lie below a node, that token counts only by which of them may
    follow it; a position that none may follow is dropped. So states merge that no later text can tell apart."""

    def __init__(self, path: str, few: int = 64):
        self.vocab = v = vocabulary(path)
        self.kids: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.below: list[list[int]] = [[]]
        for i in v.plain_ids:
            node = 0
            for b in v.bytes_of[i]:
                if b not in self.kids[node]:
                    self.kids[node][b] = len(self.kids)
                    self.kids.append({})
                    self.token.append(-1)
                    self.below.append([])
                if node and len(self.below[node]) <= few:
                    self.below[node].append(i)
                node = self.kids[node][b]
            self.token[node] = i
        self.few = few
        self.chains: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.made = {made: (rank, a, b) for (a, b), (rank, made) in sorted(v.merges.items(), key=lambda x: -x[1][0])}
        self.fits: dict[tuple[int, int], bool] = {}
        self.sets: dict[tuple[int, int], object] = {}
        self.start = ((0, -1, 0),)

    def chain(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The symbols at the right (or left) edge of a token as it is built, each with the rank of the merge that takes it up."""
        got = self.chains.get((token, right))
        if got is None:
            got, t, ends = [], token, 1 << 60
            while True:
                got.append((t, ends))
                if t not in self.made:
                    break
                ends, a, b = self.made[t]
                t = b if right else a
            self.chains[token, right] = got
        return got

    def fit(self, last: int, token: int) -> bool:
        """Whether `token` may follow `last` (-1: the start): no merge joins the edges that stand side by side while both are built."""
        got = self.fits.get((last, token))
        if got is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            if last < 0:
                got = self.vocab.encode_word(self.vocab.bytes_of[token]) == [token]
            else:
                merges, got = self.vocab.merges, True
                x, y = self.chain(last, True), self.chain(token, False)
                i, j = len(x) - 1, len(y) - 1
                while got and (i >= 0 and j >= 0):
                    (p, p_ends), (q, q_ends) = x[i], y[j]
                    m = merges.get((p, q))
                    if m is not None and m[0] < p_ends and m[0] <= q_ends:
                        got = False
                    elif i == 0 and j == 0:
                        break
                    elif p_ends <= q_ends and i:
                        i -= 1
                    else:
                        j -= 1
            self.fits[last, token] = got
        return got

    def allows(self, node: int, last: int):
        """What `last` allows below `node`: the set of tokens if few lie there, None if none may follow, else `last` itself."""
        if not node or len(self.below[node]) > self.few:
            return last
        got = self.sets.get((node, last), 0)
        if got == 0:
            if len(self.sets) > 500_000:
                self.sets.clear()
            got = self.sets[node, last] = frozenset(t for t in self.below[node] if self.fit(last, t)) or None
        return got

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The next state and the change of the count."""
        kids, token = self.kids, self.token
        live, last = [], None
        for node, prev, rel in state:
            to = kids[node].get(byte)
            if to is None:
                continue
            t = token[to]
            if last is None and t >= 0 and (t in prev if isinstance(prev, frozenset) else self.fit(prev, t)):
                last, count = t, rel + 1
            if kids[to]:
                if isinstance(prev, frozenset):
                    prev = prev.intersection(self.below[to]) or None
                else:
                    prev = self.allows(to, prev)
                if prev is not None:
                    live.append((to, prev, rel))
        out = tuple([(node, prev, rel - count) for node, prev, rel in live])
        return (*out, (0, last, 0)), count


class Transducer:
    """State table, compiled lazily. A full state is (mode, word state, extra, bytes of an unfinished character).

    Modes: F nothing open; L, N, O an open run; Q an apostrophe alone; R an apostrophe and r, v or l; W white space,
    where extra is (count of the run without its last character, minus that of the run; count of that character alone;
    whether it is a blank).
    """

    def __init__(self, path: str, most: int = 120_000):
        self.words, self.most = Words(path), most
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next = np.full(1024 * 256, -1, np.int32)
        self.delta = np.zeros(1024 * 256, np.int16)
        self.fresh = self.intern(("F", (), None, b""))

    def intern(self, state: tuple) -> int:
        k = self.number.get(state)
        if k is None:
            k = self.number[state] = len(self.states)
            self.states.append(state)
            if (k + 1) * 256 > len(self.next):
                self.next = np.concatenate([self.next, np.full(len(self.next), -1, np.int32)])
                self.delta = np.concatenate([self.delta, np.zeros(len(self.delta), np.int16)])
        return k

    def word(self, state: tuple, raw: bytes) -> tuple[tuple, int]:
        total = 0
        for b in raw:
            state, d = self.words.step(state, b)
            total += d
        return state, total

    def char(self, mode: str, word: tuple, extra, raw: bytes) -> tuple[tuple, int]:
        """The full state after one more character, and the change of the count."""
        c = raw.decode()
        kind = kind_of(c)
        new = self.words.start
        if mode == "W":
            if kind == "W":
                to, d = self.word(word, raw)
                return ("W", to, (-d, self.word(new, raw)[1], c == " "), b""), d
            without, alone, blank = extra
            if blank:
                to, d = self.word(new, b" " + raw)
                return (kind, to, None, b""), without + d
            state, d = self.char("F", (), None, raw)
            return state, without + alone + d
        if mode == "Q" and c in "stmd":
            return ("F", (), None, b""), self.word(new, b"'" + raw)[1] - 1
        if mode == "Q" and c in "rvl":
            return ("R", self.word(new, raw)[0], c, b""), self.word(new, raw)[1]
        if mode == "R" and extra + c in ("re", "ve", "ll"):
            return ("F", (), None, b""), self.word(new, b"'" + extra.encode() + raw)[1] - 1 - self.word(new, extra.encode())[1]
        run = {"Q": "O", "R": "L"}.get(mode, mode)
        if kind == run:
            to, d = self.word(word, raw)
            return (run, to, None, b""), d
        to, d = self.word(new, raw)
        if kind == "W":
            return ("W", to, (-d, d, c == " "), b""), d
        return ("Q" if c == "'" else kind, to, None, b""), d

    def resolve(self, k: int, byte: int) -> None:
        mode, word, extra, part = self.states[k]
        part += bytes([byte])
        need = 1 if part[0] < 0x80 else 2 if part[0] < 0xE0 else 3 if part[0] < 0xF0 else 4
        if len(part) < need:
            state, d = (mode, word, extra, part), 0
        else:
            state, d = self.char(mode, word, extra, part)
        to = self.intern(state)
        self.next[k * 256 + byte] = to
        self.delta[k * 256 + byte] = d

    def run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, narrow: int = 24) -> np.ndarray:
        """The counts of the chunks data[start:end], each begun in the fresh state."""
        if len(self.states) > self.most:
            self.reset()
        order = np.argsort(start - end, kind="stable")
        at, left = start[order].copy(), (end - start)[order]
        state = np.full(len(order), self.fresh, np.int64)
        count = np.zeros(len(order), np.int64)
        lengths = -left  # ascending
        step = 0
        longest = int(left[0]) if len(left) else 0
        while step < longest:
            n = int(np.searchsorted(lengths, -step, side="left"))  # chunks longer than step
            if n < narrow:
                break
            key = state[:n] * 256 + data[at[:n] + step]
            to = self.next[key]
            while to.min() < 0:
                for x in np.unique(key[to < 0]).tolist():
                    self.resolve(x >> 8, x & 255)
                to = self.next[key]
            count[:n] += self.delta[key]
            state[:n] = to
            step += 1
        else:
            n = 0
        for i in range(n):  # a few long chunks are left; one by one
            s, c = int(state[i]), 0
            for b in data[at[i] + step : at[i] + int(left[i])].tobytes():
                k = s * 256 + b
                if self.next[k] < 0:
                    self.resolve(s, b)
                s = int(self.next[k])
                c += int(self.delta[k])
            count[i] += c
        out = np.empty_like(count)
        out[order] = count
        return out


def cuts(data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of about `size` bytes: start, end and the index of the piece. Each begins a piece, or at a blank after a byte that is no white space."""
    lone = np.zeros(len(data), bool)
    if len(data) > 1:
        before = data[:-1]
        lone[1:] = (data[1:] == 32) & (before > 32) & (before < 128)
    points = np.flatnonzero(lone)
    begin, owner = [start], [np.arange(len(start))]
    big = np.flatnonzero(end - start > size)
    for i in big.tolist():
        want = np.arange(start[i] + size, end[i], size)
        near = np.searchsorted(points, want)
        got = np.unique(points[near[near < len(points)]])
        got = got[got < end[i]]
        begin.append(got)
        owner.append(np.full(len(got), i))
    b, o = np.concatenate(begin), np.concatenate(owner)
    order = np.lexsort((b, o))
    b, o = b[order], o[order]
    e = np.append(b[1:], 0)
    last = np.append(o[1:] != o[:-1], True)
    e[last] = end[o[last]]
    return b, e, o


def scan(counts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The segmented inclusive prefix scan of the chunks' maps (constant maps compose by adding counts), in log steps."""
    total, shift = counts.copy(), 1
    while shift < len(total):
        same = owner[shift:] == owner[:-shift]
        if not same.any():
            break
        total[shift:] += np.where(same, total[:-shift].copy(), 0)
        shift *= 2
    return total


_machines: dict[str, Transducer] = {}


def machine(path: str | None) -> Transducer:
    path = path or default_path()
    if path not in _machines:
        _machines[path] = Transducer(path)
    return _machines[path]


def count_batch(texts: pa.Array, m: Transducer, size: int = 512) -> np.ndarray:
    """The number of tokens of each text; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    if raw is None or not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(len(texts), np.int64)
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    start, end, owner = offsets[:-1].copy(), offsets[1:].copy(), np.arange(len(texts))
    total = np.zeros(len(texts), np.int64)
    whole = data.tobytes()
    special = [a.encode() for a in m.words.vocab.added]
    if any(a in whole for a in special):
        import re

        cut = re.compile(b"|".join(re.escape(a) for a in sorted(special, key=len, reverse=True)))
        s, e, o = [], [], []
        for i in range(len(texts)):
            at = int(start[i])
            for hit in cut.finditer(whole, at, int(end[i])):
                s.append(at), e.append(hit.start()), o.append(i)
                at = hit.end()
                total[i] += 1
            s.append(at), e.append(int(end[i])), o.append(i)
        start, end, owner = np.array(s), np.array(e), np.array(o)
    b, e, piece = cuts(data, start, end, size)
    sums = scan(m.run(data, b, e), piece)
    last = np.append(piece[1:] != piece[:-1], True)
    np.add.at(total, owner[piece[last]], sums[last])
    return total


def count_tokens(docs: DataFrame, path: str | None = None, *, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Narrow: no shuffle. A null or empty text has 0 bytes and 0 tokens. Null ids stay null, repeated rows give repeated
    results, other columns are not read, the empty table gives the empty table. Text without a blank is one chunk
    and runs in one task, in time proportional to its length.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches):
        m = machine(path)
        for b in batches:
            n = pa.array(count_batch(b.column(1), m), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], names=[id_col, "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("__n_bytes")
    out = docs.select(id_col, text_col, size).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
