"""SimHash near duplicates, found by BK-trees over shards of fingerprints.

Fingerprints that differ in at most `radius` bits agree wholly on `agree` of `radius + agree` blocks of bits. So every
fingerprint is dealt to one shard for each choice of `agree` blocks, the shard being the bits of these blocks, and
each link is found in some shard. More blocks must agree as there are more distinct fingerprints, so that a shard's
tree stays small; every choice finds the same links. A shard is a BK-tree: a node's children are keyed by their Hamming
distance to it, and a search follows only the edges within the radius. Trees are sent to their queries by the shuffle
rather than by a broadcast, as all trees together grow with the corpus. A crowded shard is dealt in blocks: a
tree for each block, and the other blocks as queries. Tasks return a spanning forest of the links that they find.

near_components links by the Jaccard similarity itself, for which a fingerprint is only an estimate. Its shards are
those of a prefix filter, which no similar pair escapes; a shard is a BK-tree of fingerprints of 256 bits, searched with a radius
over five deviations wider than the distance of the least similar pairs; and each candidate is verified on the whole
sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.components import connected_components
from plumbline.llm.store import discard, join_skewed, materialize, shuffle_partitions, small_batches, table

#: _BITS[v, k] is bit k of byte v.
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)
_PLACES = np.arange(0, 2048, 256)


def bits_of(text: str | None, width: int = 4, seed: int = 42, words: int = 1, block: int = 1 << 14) -> np.ndarray:
    """The fingerprint of a text as `words` unsigned 64-bit words, all 0 if it has no words.

    A bit is 1 if it is set in over half of the hashes of the text's shingles, repeats included. The first word is
    that of the hashes themselves; each further one is that of the hashes mixed with its number.
    """
    from xxhash import xxh64_intdigest as digest

    tokens = (text or "").encode().lower().split()  # of bytes: A-Z alone, and ASCII white space
    if not tokens:
        return np.zeros(words, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= width:
        start, end = [0], [len(joined)]
    else:
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        end = np.cumsum(length + 1) - 1
        start, end = (end - length)[: len(tokens) - width + 1].tolist(), end[width - 1 :].tolist()
    return majority((np.array([digest(joined[a:b], seed) for a, b in zip(start[k : k + block], end[k : k + block], strict=True)], np.uint64) for k in range(0, len(end), block)), len(end), words)


def majority(blocks: Iterator[np.ndarray], n: int, words: int) -> np.ndarray:
    """The bits that are set in over half of n unsigned hashes, which come in blocks; each word after the first is that of the hashes mixed with its number."""
    counts = np.zeros((words, 8, 8), np.int64)
    for h in blocks:
        for w in range(words):
            x = h
            if w:  # the finaliser of SplitMix64
                x = h + np.uint64(w * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
                x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
                x = x ^ x >> np.uint64(31)
            at = x.view(np.uint8).reshape(-1, 8).astype(np.int64) + _PLACES
            counts[w] += np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    ones = (counts.reshape(words, 64) * 2 > n).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint(text: str | None, width: int = 4, seed: int = 42, block: int = 1 << 14) -> int:
    """The unsigned 64-bit fingerprint of a text; 0 if it has no words."""
    return int(bits_of(text, width, seed, 1, block)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp), fp as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, width, seed) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


class BKTree:
    """A tree over integers; children are keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.kids: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        k = 0 if self.values else -1
        while k >= 0:
            d = (value ^ self.values[k]).bit_count()
            to = self.kids[k].get(d, -1)
            if to < 0:
                self.kids[k][d] = len(self.values)
            k = to
        self.values.append(value)
        self.kids.append({})

    def within(self, value: int, radius: int) -> Iterator[int]:
        """The indexes of the values at most `radius` away."""
        stack, values, kids = [0] if self.values else [], self.values, self.kids
        while stack:
            k = stack.pop()
            d = (value ^ values[k]).bit_count()
            if d <= radius:
                yield k
            below = kids[k]
            if below:
                low, high = d - radius, d + radius
                stack += [to for at, to in below.items() if low <= at <= high]


class Forest:
    """Union-find over integers; join() tells whether the two were apart."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def block_masks(radius: int, agree: int) -> list[int]:
    """For each choice of `agree` of `radius + agree` blocks of 64 bits, the mask of their bits."""
    n = radius + agree
    edges = [64 * k // n for k in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, agree)]


def blocks_for(n: int, radius: int, per_shard: int) -> int:
    """How many blocks must agree so that n evenly spread fingerprints make shards of at most `per_shard`."""
    agree = 1
    while agree < 5 and n / 2 ** (64 * agree / (radius + agree)) > per_shard:
        agree += 1
    return agree


def shard_links(dealt: DataFrame, radius: int, crowd: int) -> DataFrame:
    """(a, b): links that span the same components as all pairs of rows of one shard (mask, bits) whose fingerprints differ in at most radius bits.

    dealt: mask int, bits long, node long, fp array of longs; node tells fingerprints apart.
    """
    crowded = materialize(dealt.groupBy("mask", "bits").count().where(F.col("count") > crowd), "crowds")
    # Blocks of a crowded shard: a member of block s goes to the pairs (s, t) for every t.
    n = F.coalesce(F.ceil(F.col("count") / crowd), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(7)), n).cast("int")
    if crowded.isEmpty():
        dealt = dealt.withColumn("own", F.lit(0)).withColumn("pair", F.lit(0).cast("long"))
    else:
        dealt = dealt.join(crowded, ["mask", "bits"], "left").withColumn("n", n).withColumn("own", own)
        pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda t: F.least(F.col("own"), t).cast("long") * F.col("n") + F.greatest(F.col("own"), t))
        dealt = dealt.withColumn("pair", F.explode(pairs))
    parts = shuffle_partitions(dealt.sparkSession)
    keyed = dealt.select("mask", "bits", "pair", "own", "node", "fp").repartition(parts, "mask", "bits", "pair").sortWithinPartitions("mask", "bits", "pair", "own")

    def search(batches):
        forest = Forest()

        def shard(rows: list[tuple]) -> Iterator[tuple[int, int]]:
            # One block: each value is searched among those before it. Two: the second block's values among the first's.
            tree, nodes, first, two = BKTree(), [], rows[0][0], rows[0][0] != rows[-1][0]
            for own, node, value in rows:
                if not two or own != first:
                    for k in tree.within(value, radius):
                        if forest.join(node, nodes[k]):
                            yield node, nodes[k]
                if not two or own == first:
                    tree.add(value)
                    nodes.append(node)

        def out(found):
            found = list(found)
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        key, held = None, []
        for b in batches:
            words = np.asarray(b.column("fp").flatten()).view(np.uint64).reshape(b.num_rows, -1)
            if words.shape[1] == 1:
                values = words[:, 0].tolist()
            else:
                raw, size = words.tobytes(), words.shape[1] * 8
                values = [int.from_bytes(raw[k : k + size], "little") for k in range(0, len(raw), size)]
            keys = list(zip(*(b.column(c).to_pylist() for c in ("mask", "bits", "pair")), strict=True))
            found = []
            for k, own, node, value in zip(keys, b.column("own").to_pylist(), b.column("node").to_pylist(), values, strict=True):
                if k != key:
                    if len(held) > 1:
                        found += shard(held)
                    key, held = k, []
                held.append((own, node, value))
            yield out(found)
        if len(held) > 1:
            yield out(shard(held))

    return keyed.mapInArrow(search, "a long, b long")


def near_links(fps: DataFrame, radius: int = 4, per_shard: int = 128, crowd: int = 1024, agree: int | None = None) -> DataFrame:
    """(a, b): links that span the same components as all pairs of distinct values in column fp (long) within the radius."""
    agree = agree or blocks_for(fps.count(), radius, per_shard)
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius, agree)]
    keys = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits")) for k, m in enumerate(signed)])
    dealt = fps.select("fp", F.explode(keys).alias("s")).select("s.mask", "s.bits", F.col("fp").alias("node"), F.array("fp").alias("fp"))
    return shard_links(dealt, radius, crowd)


def shingles(text: str | None, width: int = 5, seed: int = 42) -> np.ndarray:
    """The sorted different 64-bit hashes of a text's shingles; a text of at most `width` words is one shingle, one without words none."""
    from xxhash import xxh64_intdigest as digest

    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, np.int64)
    joined = b" ".join(tokens)
    if len(tokens) <= width:
        found = [digest(joined, seed)]
    else:
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        end = np.cumsum(length + 1) - 1
        start, end = (end - length)[: len(tokens) - width + 1].tolist(), end[width - 1 :].tolist()
        found = [digest(joined[a:b], seed) for a, b in zip(start, end, strict=True)]
    return np.unique(np.array(found, np.uint64).view(np.int64))


def _set_columns(texts: list[str | None], width: int, seed: int) -> tuple[list[np.ndarray], list[pa.Array]]:
    """The texts' sets of shingles; and as columns 128 bits that identify each, and its size."""
    from xxhash import xxh3_128_digest

    sets = [shingles(t, width, seed) for t in texts]
    key = np.frombuffer(b"".join(xxh3_128_digest(x.tobytes()) for x in sets), np.int64).reshape(-1, 2)
    return sets, [pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array([len(x) for x in sets], pa.int64())]


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *rows])))


def common_shingles(docs: DataFrame, text_col: str, width: int, seed: int, sample: int, most: int) -> np.ndarray:
    """The shingles that stand in three texts or more of a sample, rarest first; the `most` most frequent of them. They only order shingles, so the sample changes the work and not the result."""
    share = max(1, docs.count() // sample)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([_lists([shingles(t, width, seed) for t in b.column(0).to_pylist()])], names=["h"])

    some = docs.where(F.pmod(F.xxhash64(text_col), F.lit(share)) == 0).select(text_col)
    counts = some.mapInArrow(run, "h array<long>").select(F.explode("h").alias("h")).groupBy("h").count().where("count >= 3")
    return np.array([r["h"] for r in counts.orderBy(F.desc("count"), "h").limit(most).collect()][::-1], np.int64)


def _may_reach(n, at, m, to, p: int, q: int):
    """Whether sets of n and m shingles that share those at places `at` and `to` of their order can have a similarity of p / q."""
    most = np.minimum(at, to) + 1 + np.minimum(n - at, m - to) - 1
    return (np.minimum(n, m) * q >= np.maximum(n, m) * p) & (most * (p + q) >= p * (n + m))


def _pair_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    both = np.sort(np.concatenate([np.empty((0, 2), np.int64), *found]), axis=1)
    both = np.unique(both[both[:, 0] != both[:, 1]], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _whole_runs(batches, names: list[str], key: int) -> Iterator[np.ndarray]:
    """The rows of long columns, cut only where one of the first `key` columns changes."""
    rest = np.empty((0, len(names)), np.int64)
    for b in batches:
        rows = np.concatenate([rest, np.stack([np.asarray(b.column(c)) for c in names], axis=1)])
        ends = np.flatnonzero((rows[1:, :key] != rows[:-1, :key]).any(axis=1))
        cut = int(ends[-1]) + 1 if len(ends) else 0
        rest = rows[cut:]
        yield rows[:cut]
    yield rest


#: Words of a long fingerprint, and the bits by which those of texts with a similarity of 0.8 may differ. Of all sizes of
#: two such sets, a bit differs with a chance of 0.1875 at most (sets of 4 and 5), over 20 shingles of 0.158; 80 of 256 are
#: 5.1 deviations beyond the one and 6.8 beyond the other.
LONG_WORDS, LONG_RADIUS = 4, 80
_FP = [f"f{k}" for k in range(LONG_WORDS)]


def _long_values(rows: np.ndarray) -> list[int]:
    """Long fingerprints, a row of signed words each, as integers."""
    raw, size = np.ascontiguousarray(rows).tobytes(), rows.shape[1] * 8
    return [int.from_bytes(raw[k : k + size], "little") for k in range(0, len(raw), size)]


def in_blocks(rows: DataFrame, by: str) -> DataFrame:
    """Rows of groups of `blocks` blocks, with own, the block that column `by` falls in, and once for each pair, a number of it and another block."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64(by, F.lit(7)), F.col("blocks")))
    return rows.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda t: F.least("own", t) * F.col("blocks") + F.greatest("own", t))))


def similar_sets(x: list[np.ndarray], y: list[np.ndarray], p: int, q: int, width: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets (sorted arrays) of x and of y with a Jaccard similarity of p / q or more, counted as products of 0-1 matrices of `width` columns."""
    sizes = [np.array([len(v) for v in side], np.int64) for side in (x, y)]
    flat = np.concatenate([*x, *y])
    owner = np.repeat(np.arange(len(x) + len(y)), np.concatenate(sizes))
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.append(0, flat[1:] != flat[:-1]))
    several = np.bincount(column)[column] > 1 if len(column) else np.empty(0, bool)
    column, owner = np.unique(column[several], return_inverse=True)[1], owner[several]
    shared = np.zeros((len(x), len(y)), np.float32)
    edges = np.searchsorted(column, np.arange(0, (int(column[-1]) + 1 if len(column) else 0) + width, width))
    for at, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        held = np.zeros((len(x) + len(y), width), np.float32)
        held[owner[a:b], column[a:b] - at * width] = 1
        shared += held[: len(x)] @ held[len(x) :].T
    return np.nonzero(shared * (p + q) >= np.add.outer(sizes[0], sizes[1]) * p)


def near_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, seed: int = 42, radius: int = LONG_RADIUS, crowd: int = 1024, sample: int = 20_000, most_common: int = 200_000) -> DataFrame:
    """(id, component_id) of documents, which link if the Jaccard similarity of their sets of shingles reaches the given one.

    Shards: similar sets share a shingle among the first of any one order, as many as a set's size less what it must
    have in common, plus one (prefix filter); the order goes from rare to frequent. Candidates: in each shard, first the
    next one by size, then, by a BK-tree, all those in other components, if their fingerprints of 256 bits, taken over the sets,
    differ in at most radius bits. Links: candidates that share enough shingles of the whole texts. Pairs of the second kind are
    not listed: a spanning forest of them tells which components may meet, and the members of such a family are compared
    tile by tile, so that n near copies do not make n² rows. Whether two documents link depends on these two alone, not on the size of the table. The radius
    is fit for a similarity of 0.8 or more; a similar pair lies beyond it with a chance of 3e-7 at most. Different shingles with equal
    64-bit hashes count as one. The holders of a crowded shingle are dealt in pairs of blocks.

    Null and empty texts and those without words are one class. Repeated rows come back repeated; texts with equal sets are one
    class and are compared once, however long. Rows that share an id but not the text share their component. Rows without id
    are in the component of an equal set with an id, else null. Other columns are not read. The empty table gives the empty table.
    """
    spark = docs.sparkSession
    ratio = Fraction(similarity).limit_denominator(1000)
    p, q = ratio.numerator, ratio.denominator
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(spark)
    parts = shuffle_partitions(spark)
    common = common_shingles(docs, text_col, width, seed, sample, most_common)
    rank = np.argsort(common)
    common = common[rank]

    def first(x: np.ndarray) -> np.ndarray:
        size = len(x) - -(-len(x) * p // q) + 1 if len(x) else 0
        if len(common):
            k = np.minimum(np.searchsorted(common, x), len(common) - 1)
            x = x[np.argsort(np.where(common[k] == x, rank[k] + 1, 0), kind="stable")]
        return x[:size]

    def run(batches):
        for b in batches:
            sets, columns = _set_columns(b.column(1).to_pylist(), width, seed)
            fps = np.array([majority([x.view(np.uint64)], len(x), LONG_WORDS) for x in sets], np.uint64).reshape(-1, LONG_WORDS).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, _lists([first(x) for x in sets]), *[pa.array(np.ascontiguousarray(f)) for f in fps.T]], names=[id_col, "k", "l", "n", "first", *_FP])

    longs = ", ".join(f"{f} long" for f in _FP)
    sets = materialize(docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, k long, l long, n long, first array<long>, {longs}"), "shingle-sets")
    classes = materialize(sets.groupBy("k", "l").agg(F.min(id_col).alias("node")), "shingle-classes")
    lead = sets.join(classes, ["k", "l"]).where((F.col(id_col) == F.col("node")) & (F.col("n") > 0)).withColumn("node", F.col("node").cast("long")).dropDuplicates(["k", "l"])
    held = lead.select("node", "n", F.posexplode("first").alias("at", "h")).select("h", F.col("n").cast("int").alias("n"), F.col("at").alias("at"), "node")

    def not_alone(batches):
        for rows in _whole_runs(batches, ["h", "n", "at", "node"], 1):
            same = rows[1:, 0] == rows[:-1, 0]
            keep = np.zeros(len(rows), bool)
            keep[1:] |= same
            keep[:-1] |= same
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[keep].T], names=["h", "n", "at", "node"])

    shared = materialize(held.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(not_alone, "h long, n long, at long, node long"), "shared-shingles")
    # What the candidates' tests need, of documents that share a shingle alone.
    marks = materialize(lead.select("node", "k", "l", *_FP).join(shared.select("node").distinct(), "node", "left_semi"), "marks")

    def next_ones(batches):
        for rows in _whole_runs(batches, ["h", "n", "at", "node"], 1):
            a, b = rows[:-1], rows[1:]
            ok = (a[:, 0] == b[:, 0]) & _may_reach(a[:, 1], a[:, 2], b[:, 1], b[:, 2], p, q)
            yield _pair_batch([np.stack([a[ok, 3], b[ok, 3]], axis=1)])

    def families(batches):
        """Roots whose members may be similar, as a spanning forest of them."""
        names, forest, found = ["h", "pair", "own", "n", "at", "root", *_FP], Forest(), []
        for rows in _whole_runs(batches, names, 2):
            edges = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            for r in np.split(rows, edges):
                own, n, at, root = r[:, 2:6].T
                if len(r) < 2 or len({forest.top(x) for x in set(root.tolist())}) < 2:
                    continue
                # One block: each is searched among those before it. Two: the second block's among the first's.
                values, two, tree = _long_values(r[:, 6:]), own[0] != own[-1], BKTree()
                for k, v in enumerate(values):
                    if not two or own[k] != own[0]:
                        near = np.fromiter(tree.within(v, radius), np.int64)
                        near = near[(root[near] != root[k]) & _may_reach(n[near], at[near], n[k], at[k], p, q)]
                        found += [(int(root[k]), x) for x in set(root[near].tolist()) if forest.join(int(root[k]), x)]
                    if not two or own[k] == own[0]:
                        tree.add(v)
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
            found = []

    def tiles(batches):
        """Links between members of different roots that span the components of all of them; a tile is one block of a family, or two."""
        key, held = None, {}

        def links() -> list[tuple[int, int]]:
            forest, own = Forest(), np.array(held["own"])
            first = np.flatnonzero(own == own[0])
            second = np.flatnonzero(own != own[0]) if own[0] != own[-1] else first
            node, root = np.array(held["node"]), np.array(held["root"])
            i, j = similar_sets([held["s"][k] for k in first], [held["s"][k] for k in second], p, q)
            i, j = first[i], second[j]
            apart = root[i] != root[j]
            return [(node[x], node[y]) for x, y in zip(i[apart].tolist(), j[apart].tolist(), strict=True) if forest.join(int(root[x]), int(root[y]))]

        for b in batches:
            found = []
            keys = list(zip(b.column("family").to_pylist(), b.column("pair").to_pylist(), strict=True))
            lists = b.column("s")
            ends, flat = np.asarray(lists.offsets), np.asarray(lists.values)
            rest = [b.column(c).to_pylist() for c in ("own", "node", "root")]
            for k, (own, node, root) in enumerate(zip(*rest, strict=True)):
                if keys[k] != key:
                    if held and len(held["own"]) > 1:
                        found += links()
                    key, held = keys[k], {"own": [], "node": [], "root": [], "s": []}
                for c, v in (("own", own), ("node", node), ("root", root), ("s", flat[ends[k] : ends[k + 1]].copy())):
                    held[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array([int(f[c]) for f in found], pa.int64()) for c in (0, 1)], names=["a", "b"])
        found = links() if held and len(held["own"]) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([int(f[c]) for f in found], pa.int64()) for c in (0, 1)], names=["a", "b"])

    def whole(batches):
        for b in batches:
            own, columns = _set_columns(b.column(1).to_pylist(), width, seed)
            # Only the row's own class: ids may repeat with other texts.
            mine = pa.array((np.asarray(columns[0]) == np.asarray(b.column("k"))) & (np.asarray(columns[1]) == np.asarray(b.column("l"))))
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, _lists(own)], names=["node", "k", "l", "n", "s"]).filter(mine)

    def whole_sets(nodes: DataFrame, label: str) -> DataFrame:
        """(node, n, s): the whole sets of column node."""
        wanted = marks.select("node", "k", "l").join(nodes, "node", "left_semi")
        texts = docs.select(F.col(id_col).cast("long").alias("node"), text_col).join(wanted, "node").select("node", text_col, "k", "l")
        # A row for each set: rows with equal texts end here, before they are paired.
        return materialize(texts.mapInArrow(whole, "node long, k long, l long, n long, s array<long>").groupBy("node", "k", "l", "n").agg(F.first("s").alias("s")).select("node", "n", "s"), label)

    def apart(x: str, y: str):
        return sum((F.bit_count(F.col(f"{x}.{f}").bitwiseXOR(F.col(f"{y}.{f}"))) for f in _FP), F.lit(0))

    tried = materialize(shared.repartition(parts, "h").sortWithinPartitions("h", "n", "node").mapInArrow(next_ones, "a long, b long").distinct(), "next-pairs")
    near = tried.join(marks.alias("x"), F.col("a") == F.col("x.node")).join(marks.alias("y"), F.col("b") == F.col("y.node")).where(apart("x", "y") <= radius)
    near = materialize(near.select("a", "b").distinct(), "near-pairs")
    own = whole_sets(near.select(F.col("a").alias("node")).unionAll(near.select(F.col("b").alias("node"))).distinct(), "next-sets")
    both = near.join(own.toDF("a", "n", "s"), "a").join(own.toDF("b", "m", "z"), "b")
    links = materialize(both.where(F.size(F.array_intersect("s", "z")) * (p + q) >= (F.col("n") + F.col("m")) * p).select("a", "b").distinct(), "next-links")
    discard(own)

    # All others: families of roots by BK-trees over the shards, then the members of a family in tiles.
    roots = connected_components(links)
    told = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = told.groupBy("h").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("count")).where("least <> most").select("h", F.ceil(F.col("count") / crowd).alias("blocks"))
    dealt = in_blocks(told.join(mixed, "h").join(marks.select("node", *_FP), "node"), "node")
    dealt = dealt.select("h", "pair", "own", "n", "at", "root", *_FP).repartition(parts, "h", "pair").sortWithinPartitions("h", "pair", "own")
    more = materialize(dealt.mapInArrow(families, "a long, b long").distinct(), "families")
    if not more.isEmpty():
        family = connected_components(more).toDF("root", "family")
        members = marks.select("node").distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")).join(family, "root")
        members = materialize(members, "family-members")
        own = whole_sets(members.select("node"), "family-sets").join(members, "node")
        blocks = own.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / crowd), F.ceil(F.sum("n") / (crowd * 2048))).alias("blocks"))
        tiled = in_blocks(own.join(blocks, "family"), "node").select("family", "pair", "own", "node", "root", "s").repartition(parts, "family", "pair").sortWithinPartitions("family", "pair", "own")
        links = links.unionAll(materialize(tiled.mapInArrow(tiles, "a long, b long").distinct(), "tile-links"))
        roots = connected_components(links)
    named = classes.join(roots.withColumnRenamed("node", "__node"), F.col("node").cast("long") == F.col("__node"), "left").select("k", "l", F.coalesce("root", F.col("node").cast("long")).alias("component_id"))
    out = materialize(join_skewed(sets.select(id_col, "k", "l"), named, ["k", "l"]).select(id_col, "component_id"), "near-components")
    for t in (sets, classes, shared, marks, tried, near, links, more):
        discard(t)
    return out


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42, radius: int = 4, per_shard: int = 128, crowd: int = 1024) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable by links).

    A null or empty text, or one without words, has fingerprint 0 and links like any other. Equal texts are one class
    and are searched once, so copies never make pairs. Repeated rows come back repeated. A null id is kept; it names no component
    (component_id is the smallest id that is not null, or null if there is none). The empty table gives the empty table.
    """
    fps = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, width=width, seed=seed), "fingerprints")
    classes = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    links = near_links(classes.select("fp"), radius, per_shard, crowd)
    roots = connected_components(links)
    members = classes.join(roots, classes["fp"] == roots["node"]).select("fp", "root", "least")
    names = members.groupBy("root").agg(F.min("least").alias("name"))
    named = members.join(names, "root").select("fp", "name")
    component = classes.join(named, "fp", "left").select("fp", F.coalesce("name", "least").alias("component_id"))
    out = join_skewed(fps, component, ["fp"])
    return out.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
