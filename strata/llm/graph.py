"""Connected components with DataFrame operations only.

Every round maps each node to the least of its neighbours in a random order
(twice over, so chains halve), relabels the edges with that map and drops the
loops.  Local minima absorb their neighbours, so the graph shrinks by a
constant share a round and long chains or big stars need few rounds.  The maps
are stored per round in the shared folder and chained backwards at the end.
A hot node (the centre of a star) is pre-aggregated in the minimum and lies on
the edge side of the relabelling join, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store


def _rank(c):
    """Random but fixed order of the nodes; the node itself breaks ties."""
    return F.struct(F.xxhash64(c).alias("h"), c.alias("v"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has an edge to another node.

    Nodes of one component share one root, which is some node of it.  Null
    ends and loops are ignored; repeated edges do no harm; no edges give an
    empty result.
    """
    e = store(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
              .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not e.isEmpty():
        both = e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
        near = (both.groupBy("a").agg(F.min(_rank(F.col("b"))).alias("n"))
                .select(F.col("a").alias("node"),
                        F.least(_rank(F.col("a")), F.col("n"))["v"].alias("to")))
        near = store(near, "near")
        up = near.select(F.col("node").alias("k"), F.col("to").alias("top"))
        m = store(near.join(up, near["to"] == up["k"], "left")
                  .select("node", F.coalesce("top", "to").alias("to")), "map")
        maps.append(m)
        ma, mb, before = m.toDF("a", "ra"), m.toDF("b", "rb"), e
        e = store(e.join(ma, "a").join(mb, "b").where("ra != rb")
                  .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                  "edges")
        discard(near, before)
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[-1].toDF("node", "root")
    for m in reversed(maps[:-1]):
        nxt = out.toDF("to", "next")
        out = m.join(nxt, "to", "left").select("node", F.coalesce("next", "to").alias("root"))
    return out
