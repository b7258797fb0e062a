"""Connected components of a link table, wholly by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.store import discard, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that stands in a link; root is the smallest node reachable.

    Alternates two steps until each node but the root hangs on the root alone: every node passes its larger
    neighbours, then its smaller ones, to the smallest node that it knows. The number of rounds grows with the
    logarithm of the number of nodes. Each round is written to the shared folder, so lineage stays short and a lost
    executor costs one round at most. No group is gathered: minima are partial aggregates, and the joins have no
    aggregate above them before the next exchange, so a hub's rows can be split. Null ends and loops are left out; an empty table gives an empty one.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    e = materialize(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(hi.alias("hi"), lo.alias("lo")).distinct(), "links")
    seen = None
    for _ in range(most_rounds):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        large = up.join(least, "u").where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(small, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        nxt = materialize(moved.unionAll(small.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        now = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).alias("h")).first()
        discard(e)
        e = nxt
        if seen == (now["n"], now["h"]):
            break
        seen = (now["n"], now["h"])
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
