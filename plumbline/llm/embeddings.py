"""Near duplicates of embeddings by tiles of vectors in PCA order.

Vectors are scaled to length 1 and turned to the principal axes of all of them. They are dealt to blocks along the
axis of the largest variance; blocks that lie further apart on it than the threshold allows are never compared. A pair
of blocks is a tile. In a tile products are summed over the leading axes first; with the norms of what is left of both
vectors (Cauchy-Schwarz) this bounds the cosine, and pairs that cannot reach the threshold are dropped before the next
axes. What is left is decided by the cosine of the vectors as given, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.components import connected_components
from plumbline.llm.store import materialize, shuffle_partitions, table

#: Slack of the bounds against rounding; far over the error of sums of doubles of length-1 vectors.
SLACK = 1e-9


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix of doubles."""
    flat = column.flatten()
    return np.asarray(flat, np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def tile_hits(x: np.ndarray, y: np.ndarray, threshold: float, turn: np.ndarray, stages=(8, 16, 32), rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with cosine of x[i] and y[j] at least the threshold. x, y: of length 1; turn: the principal axes, leading first."""
    d = x.shape[1]
    xt, yt = x @ turn, y @ turn
    edges = [0, *[s for s in stages if s < d], d]
    rest_x = [np.sqrt(np.maximum((xt[:, e:] ** 2).sum(axis=1), 0)) for e in edges]
    rest_y = [np.sqrt(np.maximum((yt[:, e:] ** 2).sum(axis=1), 0)) for e in edges]
    low = threshold - SLACK
    for at in range(0, len(x), rows):
        part = slice(at, min(at + rows, len(x)))
        n = part.stop - part.start
        acc = xt[part, : edges[1]] @ yt[:, : edges[1]].T
        i, j = np.nonzero(acc + np.multiply.outer(rest_x[1][part], rest_y[1]) >= low)
        for k in range(1, len(edges) - 1):
            if not len(i):
                break
            seg = slice(edges[k], edges[k + 1])
            if len(i) * 8 > n * len(y):  # crowded: the whole part at once
                acc += xt[part, seg] @ yt[:, seg].T
                sums = acc[i, j]
            else:
                sums = acc[i, j]
                for s in range(0, len(i), 1 << 17):
                    p = slice(s, s + (1 << 17))
                    sums[p] += np.einsum("ij,ij->i", xt[part, seg][i[p]], yt[:, seg][j[p]])
                acc[i, j] = sums
            keep = sums + rest_x[k + 1][part][i] * rest_y[k + 1][j] >= low
            i, j = i[keep], j[keep]
        for s in range(0, len(i), 1 << 17):
            p, q = i[s : s + (1 << 17)] + at, j[s : s + (1 << 17)]
            keep = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
            yield p[keep], q[keep]


def sound(column: str):
    """Whether a vector can link: not null or empty, all components finite, not all zero."""
    c = F.col(column)
    good = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.coalesce((F.size(c) > 0) & F.forall(c, lambda v: F.coalesce(good(v), F.lit(False))) & F.exists(c, lambda v: v != 0), F.lit(False))


def moments(vectors: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """By number of components: how many unit vectors, their sum, and the sum of their outer products. One small row for each component leaves the executors."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d in set((sizes := np.asarray(b.column("dim"))).tolist()):
                x = unit(matrix(b.column("embedding").filter(pa.array(sizes == d))))
                got = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                total[d] = total[d] + got if d in total else got
        for d, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([v.tolist()], pa.list_(pa.float64()))], names=["dim", "v"])

    rows = vectors.select("dim", "embedding").mapInArrow(run, "dim int, v array<double>").select("dim", F.posexplode("v")).groupBy("dim", "pos").agg(F.sum("col").alias("s")).collect()
    out = {}
    for d in sorted({r["dim"] for r in rows}):
        v = np.array([r["s"] for r in sorted((r for r in rows if r["dim"] == d), key=lambda r: r["pos"])])
        out[d] = (int(v[0]), v[1 : d + 1], v[d + 1 :].reshape(d, d))
    return out


def block_rows(n: int, dim: int, tasks: int, most_numbers: int = 1 << 22, least: int = 1024) -> int:
    """Vectors a block: as few blocks as give each of `tasks` tasks a tile, as each vector is sent once for each block that its own may meet; a block holds at most most_numbers components (32 MB as doubles)."""
    blocks = int(np.ceil((np.sqrt(8 * tasks + 1) - 1) / 2))
    return max(1, min(max(least, -(-n // blocks)), max(1, most_numbers // max(1, dim))))


def link_vectors(vectors: DataFrame, *, threshold: float = 0.95, block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """For classes (node long, n long, dim int, embedding): (node, links) and (a, b), links that span the components. threshold must be positive. block: vectors a block; as block_rows says if None."""
    spark = vectors.sparkSession
    mom = moments(vectors)
    kind = vectors.schema["embedding"].dataType.simpleString()  # floats stay floats on their way, and are doubles in the tiles
    rows_of = {d: block or block_rows(n, d, spark.sparkContext.defaultParallelism) for d, (n, _, _) in mom.items()}
    turns, axes = {}, {}
    for d, (n, s, m) in mom.items():
        w, v = np.linalg.eigh(m / max(n, 1))
        order = np.argsort(-w, kind="stable")
        turns[d] = np.ascontiguousarray(v[:, order])
        axes[d] = v[:, order][:, int(np.argmax(w[order] - ((s / max(n, 1)) @ v[:, order]) ** 2))]

    def place(batches):
        for b in batches:
            sizes, c = np.asarray(b.column("dim")), np.zeros(b.num_rows)
            for d in set(sizes.tolist()):
                c[sizes == d] = unit(matrix(b.column("embedding").filter(pa.array(sizes == d)))) @ axes[d]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c)], names=[*b.schema.names, "c"])

    placed = materialize(vectors.select("node", "n", "dim", "embedding").mapInArrow(place, f"node long, n long, dim int, embedding {kind}, c double"), "placed")
    bounds = {}
    for d, (n, _, _) in mom.items():
        k = -(-n // rows_of[d])
        own = placed.where(F.col("dim") == d)
        bounds[d] = np.unique(own.stat.approxQuantile("c", [q / k for q in range(1, k)], 0.25 / k)) if k > 1 else np.empty(0)

    def deal(batches):
        for b in batches:
            sizes, c, at = np.asarray(b.column("dim")), np.asarray(b.column("c")), np.zeros(b.num_rows, np.int64)
            for d in set(sizes.tolist()):
                at[sizes == d] = np.searchsorted(bounds[d], c[sizes == d], side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=[*b.schema.names, "slab"])

    dealt = placed.mapInArrow(deal, f"node long, n long, dim int, embedding {kind}, c double, slab long")
    slabs = dealt.groupBy("dim", "slab").agg(F.count("*").alias("k"))
    # A slab where many vectors share a coordinate is split by hash; the pieces are blocks of their own.
    most = F.create_map(*[F.lit(x) for d, k in rows_of.items() for x in (d, k)]) if rows_of else F.lit(None).cast("map<int,int>")
    split = F.greatest(F.ceil(F.col("k") / (2 * F.try_element_at(most, F.col("dim")))), F.lit(1))
    dealt = dealt.join(slabs, ["dim", "slab"]).withColumn("piece", F.pmod(F.xxhash64("node"), split)).drop("k")
    blocks = dealt.groupBy("dim", "slab", "piece").agg(F.min("c").alias("low"), F.max("c").alias("high")).collect()  # one small row for each block
    gap = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    rows, base = [], 0
    for d in sorted(mom):
        own = sorted((b for b in blocks if b["dim"] == d), key=lambda b: (b["low"], b["high"], b["slab"], b["piece"]))
        low = np.array([b["low"] for b in own])
        reach = np.searchsorted(low, np.maximum.accumulate(np.array([b["high"] for b in own])) + gap, side="right") - 1 if own else []
        for i, b in enumerate(own):
            first = int(np.searchsorted(reach, i))  # the first block that reaches to i
            rows.append((d, b["slab"], b["piece"], base + i, base + min(first, i), base + max(int(reach[i]), i)))
        base += len(own)
    tiles = spark.createDataFrame(rows, "dim int, slab long, piece long, block long, first long, last long")
    sent = dealt.join(tiles, ["dim", "slab", "piece"]).select("node", "n", "dim", "embedding", "block", F.explode(F.sequence("first", "last")).alias("other"))
    sent = sent.select("node", "n", "dim", "embedding", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    n_tiles = sum(r[5] - r[3] + 1 for r in rows)
    parts = max(shuffle_partitions(spark), min(n_tiles, 4 * spark.sparkContext.defaultParallelism))

    def compare(batches):
        held: dict[str, list] = {}

        def flush():
            x = matrix(pa.concat_arrays(held["x_vec"])) if held.get("x_vec") else None
            if x is None:
                return
            dim = x.shape[1]
            alone = held["key"][0] == held["key"][1]
            x, xn, xi = unit(x), np.concatenate(held["x_n"]), np.concatenate(held["x_node"])
            if alone:
                y, yn, yi = x, xn, xi
            elif held.get("y_vec"):
                y, yn, yi = unit(matrix(pa.concat_arrays(held["y_vec"]))), np.concatenate(held["y_n"]), np.concatenate(held["y_node"])
            else:
                return
            found_x, found_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
            ids = xi if alone else np.concatenate([xi, yi])
            up = np.arange(len(ids))
            for i, j in tile_hits(x, y, threshold, turns[dim]):
                if alone:
                    i, j = i[i < j], j[i < j]
                np.add.at(found_x, i, yn[j])
                np.add.at(found_x if alone else found_y, j, xn[i])
                j = j if alone else j + len(x)
                while len(i):
                    a, b = up[i], up[j]
                    apart = a != b
                    i, j, a, b = i[apart], j[apart], a[apart], b[apart]
                    np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
                    while (up[up] != up).any():
                        up = up[up]
            found = found_x if alone else np.concatenate([found_x, found_y])
            hang = np.flatnonzero(up != np.arange(len(up)))
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[some], ids[hang]])), pa.array(np.concatenate([found[some], np.zeros(len(hang), np.int64)])), pa.array([None] * len(some) + ids[up[hang]].tolist(), pa.int64())], names=["a", "links", "b"]
            )

        for b in batches:
            key = np.stack([np.asarray(b.column("x")), np.asarray(b.column("y"))], axis=1)
            edge = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            for s, e in zip(edge, edge[1:], strict=False):
                if s == e:
                    continue
                k = (int(key[s, 0]), int(key[s, 1]))
                if held.get("key") != k:
                    if held:
                        yield from flush()
                    held = {"key": k}
                part = b.slice(s, e - s)
                mine = np.asarray(part.column("block")) == k[0]
                for side, mask in (("x", mine), ("y", ~mine)):
                    if mask.any():
                        got = part.filter(pa.array(mask))
                        held.setdefault(f"{side}_vec", []).append(got.column("embedding"))
                        held.setdefault(f"{side}_n", []).append(np.asarray(got.column("n")))
                        held.setdefault(f"{side}_node", []).append(np.asarray(got.column("node")))
        if held:
            yield from flush()

    found = materialize(sent.repartition(parts, "x", "y").sortWithinPartitions("x", "y").mapInArrow(compare, "a long, links long, b long"), "tile-links")
    return found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")), found.where("b is not null").select("a", "b")


def embedding_components(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95, block: int | None = None) -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly), component_id (smallest id reachable), kept (id = component_id).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
    different length or without an id. Equal vectors are one class, compared once; their links among themselves
    are counted, not listed. Repeated rows count as vectors of their own. A row without id has a null component and is kept.
    Rows that share an id but not the vector share their component and the sum of their links. The empty table gives the empty table.
    """
    given = vectors.schema[vec_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("__id"), F.col(id_col), F.col(vec_col).cast(given if given == "array<float>" else "array<double>").alias("embedding"))
    good = rows.where(sound("embedding") & F.col("__id").isNotNull())
    classes = materialize(good.groupBy("embedding").agg(F.min("__id").alias("least"), F.count("*").alias("n")), "vector-classes")
    classes = classes.withColumn("node", F.col("least"))
    links, edges = link_vectors(classes.select("node", "n", F.size("embedding").alias("dim"), "embedding"), threshold=threshold, block=block)
    roots = connected_components(edges)
    members = classes.join(roots, "node").select("node", "root", "least")
    named = members.join(members.groupBy("root").agg(F.min("least").alias("name")), "root").select("node", "name")
    known = classes.join(links, "node", "left").join(named, "node", "left").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("name", "least").alias("component"))
    able = rows.withColumn("key", F.when(sound("embedding") & F.col("__id").isNotNull(), F.col("embedding")))
    out = able.drop("embedding").join(known.withColumnRenamed("embedding", "key"), "key", "left")
    component = F.coalesce("component", "__id")
    return out.select(F.col(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("__id") == component, F.lit(True)).alias("kept"))


def op3_embedding_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))
