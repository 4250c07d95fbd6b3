"""Operator 8: embedding near-duplicates by an epsilon grid order join.

Vectors are scaled to length one; a cosine of at least c is then a distance of
at most epsilon = sqrt(2 - 2c).  They are projected on their leading principal
directions, put in the lexicographic order of the epsilon-wide grid cells there,
and cut into blocks of that sequence.  Blocks of one label whose bounding boxes
lie further apart than epsilon are never paired.  A task joins two blocks
recursively, halving sequence intervals and skipping those that are provably
distant, down to small leaves, which are compared exactly in double precision.

Equal vectors are one row with a count.  A pair of blocks gives link counts and
a spanning forest of the links, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, store
from .graph import components
from .simhash import merge_labels

COSINE = 0.98
DIRECTIONS = 8
BLOCK_ROWS = 1024
LEAF_ROWS = 128
SLACK = 1e-6  # rounding of the projections


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)  # scaled first: no overflow in the squares
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _stack(vectors) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


def principal_directions(v: DataFrame, dim: int, k: int) -> np.ndarray:
    """``k`` leading principal directions (dim x k) of the unit vectors of
    length ``dim``, from sums over all of them; dim x dim numbers reach the driver."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((dim + 1, dim + 1)), 0
        for pdf in batches:
            x = np.hstack([_unit(_stack(pdf["embedding"])), np.ones((len(pdf), 1))])
            total += x.T @ x
            n += len(pdf)
        if n:
            yield pd.DataFrame({"at": np.arange(total.size), "x": total.ravel()})

    got = (v.where(F.size("embedding") == dim).select("embedding").mapInPandas(sums, "at int, x double")
           .groupBy("at").agg(F.sum("x").alias("x")).collect())
    m = np.zeros((dim + 1) ** 2)
    for r in got:
        m[r["at"]] = r["x"]
    m = m.reshape(dim + 1, dim + 1)
    n = max(m[-1, -1], 1.0)
    cov = m[:-1, :-1] / n - np.outer(m[-1, :-1], m[-1, :-1]) / n ** 2
    return np.ascontiguousarray(np.linalg.eigh(cov)[1][:, ::-1][:, :k])


def grid_blocks(v: DataFrame, eps: float, k: int = DIRECTIONS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of the grid order of ``v(node, label, n, embedding)``, packed."""
    modes = v.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "dim").limit(1).collect()
    dim = modes[0]["dim"] if modes else 0
    main = principal_directions(v, dim, k) if dim else None  # other lengths use their first axes

    def project(x: np.ndarray) -> np.ndarray:
        u = _unit(x)
        p = u @ main if x.shape[1] == dim else u[:, :k]
        return np.pad(p, ((0, 0), (0, k - p.shape[1])))

    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for size, part in pdf.groupby(pdf["embedding"].map(len), sort=True):
                p = project(_stack(part["embedding"]))
                out.append(part.assign(dim=size, p=list(p), cell=list(np.floor(p / eps).astype(np.int32))))
            yield pd.concat(out)

    def pack(pdf: pd.DataFrame, number: int) -> dict:
        p, x = _stack(pdf["p"]), _stack(pdf["embedding"])
        return {"block": (TaskContext.get().partitionId() << 32) + number, "label": pdf["label"].iloc[0], "dim": pdf["dim"].iloc[0],
                "lo": p.min(axis=0), "hi": p.max(axis=0), "nodes": pdf["node"].to_numpy(np.int64).tobytes(),
                "n": pdf["n"].to_numpy(np.int64).tobytes(), "p": p.tobytes(), "x": x.tobytes()}

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, number = None, 0
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            rows, at = [], 0
            key = held["label"].astype(str) + "/" + held["dim"].astype(str)
            change = np.r_[np.flatnonzero((key != key.shift()).to_numpy())[1:], len(held)]
            for end in change:
                while end - at >= block_rows or (end < len(held) and end > at):
                    rows.append(pack(held.iloc[at:min(end, at + block_rows)], number))
                    at, number = min(end, at + block_rows), number + 1
            held = held.iloc[at:]
            if rows:
                yield pd.DataFrame(rows)
        if held is not None and len(held):
            yield pd.DataFrame([pack(held, number)])

    place = v.mapInPandas(located, "node long, label long, n long, embedding array<float>, dim int, p array<double>, cell array<int>")
    order = ["label", "dim", "cell", "node"]
    place = store(place, "grid-places").repartitionByRange(*order).sortWithinPartitions(*order)
    return store(place.mapInPandas(
        blocks, "block long, label long, dim int, lo array<double>, hi array<double>, nodes binary, n binary, p binary, x binary"),
        "grid-blocks")


def interval_join(a: tuple, b: tuple | None, eps: float, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two blocks ``(nodes, n, p, x)`` (``b`` None: within one):
    per row the weighted number of links, and labels of the linked classes.

    Returns ``nodes, links, least node of the class`` of rows with a link.
    """
    own = b is None
    b = a if own else b
    na, nb = len(a[0]), len(b[0])
    nodes = a[0] if own else np.concatenate([a[0], b[0]])
    shift = 0 if own else na
    label, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
    norm_a, norm_b = (np.sqrt((x[3] * x[3]).sum(axis=1)) for x in (a, b))
    limit = (eps + SLACK) ** 2
    stack = [(0, na, 0, nb)]
    while stack:
        s, t, u, w = stack.pop()
        if own and w <= s:  # below the diagonal
            continue
        pa, pb = a[2][s:t], b[2][u:w]
        gap = np.maximum(0, np.maximum(pa.min(axis=0) - pb.max(axis=0), pb.min(axis=0) - pa.max(axis=0)))
        if (gap * gap).sum() > limit:
            continue
        if t - s <= LEAF_ROWS and w - u <= LEAF_ROWS:
            cos = (a[3][s:t] @ b[3][u:w].T) / norm_a[s:t, None] / norm_b[None, u:w]
            near = cos >= cosine
            if own:
                near &= np.arange(s, t)[:, None] < np.arange(u, w)[None, :]
            i, j = np.nonzero(near)
            if len(i):
                i, j = i + s, j + u
                np.add.at(links, i, b[1][j])
                np.add.at(links, j + shift, a[1][i])
                label = merge_labels(label, i, j + shift)
        elif own and (s, t) == (u, w):
            m = (s + t) // 2
            stack += [(s, m, s, m), (s, m, m, t), (m, t, m, t)]
        elif t - s >= w - u:
            m = (s + t) // 2
            stack += [(s, m, u, w), (m, t, u, w)]
        else:
            m = (u + w) // 2
            stack += [(s, t, u, m), (s, t, m, w)]
    hit = np.flatnonzero(links)
    return nodes[hit], links[hit], nodes[label[hit]]


def block_links(blocks: DataFrame, eps: float, cosine: float) -> DataFrame:
    """``(node, links, to)`` per pair of blocks that may hold links."""
    boxes = blocks.select("block", "label", "dim", "lo", "hi")

    def cells(reach: int):
        low, high = (F.floor(F.get(F.col(c), F.lit(0)) / eps).cast("int") for c in ("lo", "hi"))
        return F.explode(F.sequence(low - reach, high + reach)).alias("cell")

    a = boxes.select("label", "dim", F.col("block").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), cells(1))
    b = boxes.select("label", "dim", F.col("block").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), cells(0))
    gaps = F.zip_with(F.zip_with("lo_a", "hi_b", lambda x, y: x - y), F.zip_with("lo_b", "hi_a", lambda x, y: x - y),
                      lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = (a.join(b, ["label", "dim", "cell"]).where("a <= b").where(apart <= (eps + SLACK) ** 2)
             .select("a", "b").distinct())

    @F.udf("array<struct<node:long,links:long,to:long>>", useArrow=False)
    def join(dim, na, ca, pa, xa, nb, cb, pb, xb, own):
        def block(n, c, p, x):
            n = np.frombuffer(n, np.int64)
            return n, np.frombuffer(c, np.int64), np.frombuffer(p).reshape(len(n), -1), np.frombuffer(x).reshape(len(n), dim)
        got = interval_join(block(na, ca, pa, xa), None if own else block(nb, cb, pb, xb), eps, cosine)
        return list(zip(*(g.tolist() for g in got)))

    cols = ["nodes", "n", "p", "x"]
    left = blocks.select(F.col("block").alias("a"), "dim", *[F.col(c).alias(f"{c}_a") for c in cols])
    right = blocks.select(F.col("block").alias("b"), *[F.col(c).alias(f"{c}_b") for c in cols])
    # what is near is dealt by pair, so a label or cell with many blocks fills many tasks
    both = pairs.join(left, "a").join(right, "b").withColumn("own", F.col("a") == F.col("b"))
    both = both.repartition(max(8, 4 * blocks.sparkSession.sparkContext.defaultParallelism), "a", "b")
    found = both.select(F.explode(join("dim", *[f"{c}_a" for c in cols], *[f"{c}_b" for c in cols], "own")).alias("f"))
    return store(found.select("f.*"), "grid-links")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, k: int = DIRECTIONS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of
    ``vectors(vec_id, embedding, label)``.

    Only vectors of one label and one length link, at a cosine of ``cosine`` or
    more.  Null labels, null, empty or zero vectors, and those with null or
    non-finite components link with nothing and are their own component.  Rows
    with a null id link like others but give no component its name; repeated
    rows link with each other; an empty table gives no rows.
    """
    eps = math.sqrt(2 - 2 * cosine)
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       e.cast("array<float>").alias("embedding"))
    v = v.withColumn("node", F.when(F.coalesce(valid, F.lit(False)), F.xxhash64("label", "embedding")))
    ids = store(v.select("vec_id", "node"), "vector-ids")
    one = store(v.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.count("*").alias("n"), F.first("embedding").alias("embedding")), "vectors")
    found = block_links(grid_blocks(one, eps, k, block_rows), eps, cosine)
    roots = components(found.where("node <> to"), "node", "to").withColumnRenamed("node", "k")
    links = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "l")
    counts = ids.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    named = (counts.join(links, F.col("node") == F.col("l"), "left").join(roots, F.col("node") == F.col("k"), "left")
             .select("node", "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")))
    named = store(named, "vector-classes")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select(F.col("node").alias("c"), (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    out = ids.join(named, F.col("node") == F.col("c"), "left")
    comp = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"),
                      F.col("vec_id").eqNullSafe(comp).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
