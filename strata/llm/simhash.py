"""Operator 6: SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles of bounded size by population
count (and a hash within a count, so a frequent count fills several tiles).
Two tiles are compared only when their population counts differ by at most the
radius.  Inside a task the fingerprints of both tiles are ordered by the
population counts of their four 16-bit quarters, and quarter groups whose counts
differ by more than the radius in total are skipped too; what remains is
compared with numpy exclusive-or and bit counts.  Each tile pair gives a
spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, sealed, store, text_of, unsealed
from .graph import components

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE_ROWS = 16384


def fingerprint(text: str, k: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text (0 without words)."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and white space only
    n = max(len(words) - k + 1, 1 if words else 0)
    if not n:
        return 0
    total = np.zeros(64, dtype=np.int64)
    xx, joined = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, 8192):  # bounded memory for very long texts
        h = np.fromiter((xx(joined(words[i:i + k]), SEED) for i in range(at, min(n, at + 8192))), dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(texts: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``(who, fp)`` of every row of ``(who, text)``; fp is the fingerprint as a
    signed long, who is passed through."""
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in batches:
            yield pd.Series(np.fromiter((fingerprint(t, k) for t in text), dtype=np.uint64, count=len(text)).view(np.int64))
    return texts.select("who", fp("text").alias("fp"))


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union of the links i-j into ``label`` (least index of each class)."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            nxt = label[label]
            if np.array_equal(nxt, label):
                break
            label = nxt


def _groups(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by quarter counts; the order, group bounds and each group's counts."""
    quarters = np.bitwise_count(v.view(np.uint16).reshape(-1, 4)).astype(np.int64)
    key = quarters @ np.array([17 ** 3, 17 ** 2, 17, 1])
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return order, np.r_[cut, len(key)], quarters[order[cut]]


def tile_forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the fingerprints of two tiles (``b`` None: of one)."""
    v = a if b is None else np.concatenate([a, b])
    label, at = np.arange(len(v)), 0 if b is None else len(a)
    oa, ca, qa = _groups(a)
    ob, cb, qb = (oa, ca, qa) if b is None else _groups(b)
    for g in range(len(qa)):
        ia = oa[ca[g]:ca[g + 1]]
        for h in np.flatnonzero(np.abs(qb - qa[g]).sum(axis=1) <= radius):
            if b is None and h < g:
                continue
            ib = ob[cb[h]:cb[h + 1]]
            for s in range(0, len(ia), 1024):
                for t in range(0, len(ib), 1024):
                    x, y = ia[s:s + 1024], ib[t:t + 1024]
                    near = np.bitwise_count(v[x][:, None] ^ v[y + at][None, :]) <= radius
                    i, j = np.nonzero(near)
                    if len(i):
                        label = merge_labels(label, x[i], y[j] + at)
    moved = np.flatnonzero(label != np.arange(len(v)))
    return v[moved], v[label[moved]]


def link_forest(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(a, b)``: links that join all fingerprints within ``radius`` bits of
    each other, directly or through others.  ``fps`` has one row per distinct fp."""
    spark = fps.sparkSession
    f = fps.select("fp", F.bit_count("fp").cast("int").alias("pc"))
    counts = {r["pc"]: r["n"] for r in f.groupBy("pc").agg(F.count("*").alias("n")).collect()}  # 65 rows at most
    chunks = [max(1, -(-counts.get(p, 0) // tile_rows)) if p in counts else 0 for p in range(65)]
    n_chunks = F.array(*[F.lit(c) for c in chunks])
    tiles = (f.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.element_at(n_chunks, F.col("pc") + 1)).cast("int"))
             .groupBy("pc", "chunk").agg(F.collect_list("fp").alias("fps")))  # tile_rows on average, by hash
    tiles = store(tiles, "simhash-tiles")
    right = F.explode(F.sequence(F.col("pc"), F.least(F.col("pc") + radius, F.lit(64))))
    left = (tiles.withColumn("pc2", right).withColumn("n2", F.element_at(n_chunks, F.col("pc2") + 1))
            .where("n2 > 0").withColumn("chunk2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1)))
            .where("pc2 > pc OR chunk2 >= chunk"))
    pairs = left.join(tiles.select(F.col("pc").alias("pc2"), F.col("chunk").alias("chunk2"),
                                   F.col("fps").alias("fps2")), ["pc2", "chunk2"])
    pairs = pairs.select("fps", "fps2", ((F.col("pc") == F.col("pc2")) & (F.col("chunk") == F.col("chunk2"))).alias("own"))

    @F.udf("array<struct<a:long,b:long>>")
    def forest(x, y, own):  # one call per pair of tiles, so rows stay few and batches small
        x = np.array(x, dtype=np.int64).view(np.uint64)
        i, j = tile_forest(x, None if own else np.array(y, dtype=np.int64).view(np.uint64), radius)
        return list(zip(i.view(np.int64).tolist(), j.view(np.int64).tolist()))

    out = (pairs.repartition(max(8, spark.sparkContext.defaultParallelism * 4))
           .select(F.explode(forest("fps", "fps2", "own")).alias("l")).select("l.a", "l.b"))
    return out


def _classes(fps: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """``(fp, first, root)`` of distinct fingerprints; ``fps`` has (fp, who),
    first is the least ``who`` of the fingerprint, root names the class."""
    distinct = store(fps.groupBy("fp").agg(F.min("who").alias("first")), "simhash-distinct")
    roots = components(link_forest(distinct, radius, tile_rows))
    return (distinct.join(roots, distinct["fp"] == roots["node"], "left")
            .select("fp", "first", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    component_id is the least doc_id reachable over links of at most
    ``radius`` differing bits.  Null and empty texts have fingerprint 0 and
    link like any other; rows with null ids keep a null id and lend none to
    their class (a class of null ids only has a null component); repeated rows
    each come out; an empty table gives no rows; other columns are not read.
    """
    fps = store(fingerprints(docs.select(F.col("doc_id").cast("long").alias("who"), text_of().alias("text")), k),
                "simhash-fp")
    classed = _classes(fps, radius, tile_rows)
    least = classed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store(classed.join(least, "root").select("fp", "component_id"), "simhash-class")
    return fps.join(named, "fp").select(F.col("who").alias("doc_id"), "fp", "component_id")


def keep_first(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS,
               tile_rows: int = TILE_ROWS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, columns unchanged.

    The row with the least doc_id stays, null ids last; of rows with that same
    id the one with the least hash of its text, and of equal rows one.  Null and
    empty texts are one class; an empty table gives no rows; columns of any name keep their values.
    """
    id_ = F.col("doc_id").cast("long")
    marked = sealed(docs, __void=id_.isNull(), __id=F.coalesce(id_, F.lit(0)), __hash=F.xxhash64(text_of()), text=text_of())
    row = ["__void", "__id", "__hash"]
    fps = store(fingerprints(marked.select(F.struct(*row).alias("who"), text_of().alias("text")), k), "simhash-fp")
    first = _classes(fps, radius, tile_rows).groupBy("root").agg(F.min("first").alias("f")).select("f.*")
    kept = marked.join(first, row, "left_semi")
    one = Window.partitionBy(*row).orderBy(*row)
    return unsealed(kept.withColumn("__n", F.row_number().over(one)).where("__n = 1"), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
