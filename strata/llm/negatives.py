"""Operator 11: hard negatives from an inverted multi-index.

Vectors are split into two halves, each with a codebook of its own; the pair of
nearest codewords is a vector's cell.  Rows are put in the order of label and
cell and cut into shards.  For an anchor, the score of any row of a cell is at
most the sum of two bounds, one per half: the codeword's score plus its radius
(the distance of the farthest row of that codeword) times the anchor's length.
A heap walks both sorted lists of half bounds at once, so cells come in
descending order of their summed bounds; the walk ends when every window of
scores that is asked for is certified: it has its rows, and no cell to come can
hold a better one, or none to come can reach into the window.

A first search finds the positives (one window without ends), a second the
negatives (a window of scores per positive).  Both ask the most promising shard
of an anchor block first: the scores found there are floors, and shards whose
bound lies below the floors of a whole block are not searched.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources.landing import with_row_id

from .common import read_table, store

CODEWORDS = 32  # per half
SAMPLE_ROWS = 16384  # rows that the codebooks are fitted on
SHARD_ROWS = 16384
BLOCK_ROWS = 128
GROUP = 64  # shards whose bounds one task compares with the anchor blocks
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score in percent of the positive's
LEAST, MOST = -(1 << 62), 1 << 62
NO_ID = (1 << 63) - 1


def whole_numbers(vector: str, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in vectors])


def _packed(x: np.ndarray) -> tuple[str, bytes]:
    """Integers in the fewest bytes that hold them all."""
    top = int(np.abs(x).max(initial=0))
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
    return kind, x.astype(kind).tobytes()


def _scores(x: np.ndarray, a: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of rows with a vector, as integers.  Doubles are exact below 2 ** 53."""
    return np.rint(x @ a).astype(np.int64) if exact else x.astype(np.int64) @ a.astype(np.int64)


# ------------------------------------------------------------------- index
def _codebook(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means centres; the first ones are spread evenly over the sample."""
    x = x.astype(np.float64)
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        code = _nearest(x, centres)
        n = np.bincount(code, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, code, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def codebooks(rows: DataFrame, k: int = CODEWORDS, sample: int = SAMPLE_ROWS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Two codebooks per vector length, fitted on at most ``sample`` rows chosen by
    hash.  They only steer the order of the search, so results do not depend on them."""
    some = rows.select("dim", "q").orderBy(F.xxhash64("row"), "row").limit(sample).toPandas()
    out = {}
    for dim, part in some.groupby("dim"):
        x = _matrix(part["q"])
        half = int(dim) // 2
        out[int(dim)] = _codebook(x[:, :half], k), _codebook(x[:, half:], k)
    return out


def with_cells(rows: DataFrame, books: dict) -> DataFrame:
    """``rows`` with their codewords ``i`` and ``j`` (0 for lengths without codebooks)."""
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim", sort=True):
                i = j = np.zeros(len(part), np.int64)
                if dim in books:
                    x = _matrix(part["q"]).astype(np.float64)
                    i, j = (_nearest(h, c) for h, c in zip((x[:, :dim // 2], x[:, dim // 2:]), books[dim]))
                yield part.assign(i=i, j=j)

    return store(rows.mapInPandas(place, "row long, vec_id long, label string, dim int, q array<long>, i int, j int"), "negatives-cells")


def shards_of(cells: DataFrame, shard_rows: int) -> DataFrame:
    """Runs of rows of one label and length in the order of their cells, packed;
    ``centre`` and ``radius`` bound the scores of a whole shard."""
    def pack(pdf: pd.DataFrame, number: int) -> dict:
        x = _matrix(pdf["q"])
        kind, raw = _packed(x)
        centre = x.mean(axis=0)
        return {"shard": (TaskContext.get().partitionId() << 32) + number, "label": pdf["label"].iloc[0], "dim": int(pdf["dim"].iloc[0]),
                "centre": centre, "radius": float(np.sqrt(((x - centre) ** 2).sum(axis=1).max())), "rows": pdf["row"].to_numpy(np.int64).tobytes(),
                "ids": pdf["vec_id"].to_numpy(np.int64).tobytes(), "codes": pdf[["i", "j"]].to_numpy(np.int32).tobytes(), "kind": kind, "x": raw}

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, number = None, 0
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            key = list(zip(held["label"], held["dim"]))
            ends = [n for n in range(1, len(key)) if key[n] != key[n - 1]] + [len(key)]
            at = 0
            for end in ends:
                while end - at >= shard_rows or (end < len(key) and end > at):
                    yield pd.DataFrame([pack(held.iloc[at:min(end, at + shard_rows)], number)])
                    at, number = min(end, at + shard_rows), number + 1
            held = held.iloc[at:]
        if held is not None and len(held):
            yield pd.DataFrame([pack(held, number)])

    order = ["label", "dim", "i", "j", "row"]
    placed = cells.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(placed.mapInPandas(cut, "shard long, label string, dim int, centre array<double>, radius double, rows binary, ids binary, "
                                         "codes binary, kind string, x binary"), "negatives-shards")


# ------------------------------------------------------------------ search
class Cells:
    """The inverted multi-index of one shard: its rows lie in the order of their cells."""

    def __init__(self, x: np.ndarray, codes: np.ndarray, ids: np.ndarray, rows: np.ndarray, books):
        order = np.lexsort((codes[:, 1], codes[:, 0]))
        self.x, self.ids, self.rows, codes = x[order].astype(np.float64), ids[order], rows[order], codes[order]
        self.top = np.abs(self.x).max(initial=0.0)
        half = x.shape[1] // 2
        self.sides = []
        for side, (part, at) in enumerate(((slice(None, half), codes[:, 0]), (slice(half, None), codes[:, 1]))):
            own, code = np.unique(at, return_inverse=True)
            centres = books[side][own] if books else np.zeros((1, self.x[:, part].shape[1]))
            far = np.sqrt(((self.x[:, part] - centres[code]) ** 2).sum(axis=1))
            radius = np.zeros(len(own))
            np.maximum.at(radius, code, far)
            self.sides.append((part, centres, radius, code))
        i, j = self.sides[0][3], self.sides[1][3]
        cell = i * len(self.sides[1][1]) + j
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        self.lists = {(int(i[s]), int(j[s])): (int(s), int(e)) for s, e in zip(starts, np.r_[starts[1:], len(cell)])}

    def walk(self, a: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """``(bound, start, end)`` of the cells by descending bound."""
        lists = []
        for part, centres, radius, _ in self.sides:
            bound = centres @ a[part] + radius * np.sqrt((a[part] ** 2).sum())
            order = np.argsort(-bound, kind="stable")
            lists.append((order.tolist(), bound[order].tolist()))
        (first, u), (second, v) = lists
        heap, seen_column = [(-(u[0] + v[0]), 0, 0)], {0}
        while heap:
            neg, p, q = heapq.heappop(heap)
            if (where := self.lists.get((first[p], second[q]))) is not None:
                yield -neg, *where
            if q + 1 < len(v):  # a row's next cell
                heapq.heappush(heap, (-(u[p] + v[q + 1]), p, q + 1))
            if q == 0 and p + 1 < len(u) and p + 1 not in seen_column:  # the next row begins
                seen_column.add(p + 1)
                heapq.heappush(heap, (-(u[p + 1] + v[0]), p + 1, 0))

    def search(self, a: np.ndarray, own: int, windows: list[tuple[int, int, int]], k: int, batch: int = 512) -> list[tuple[int, int, int, int]]:
        """Per window ``(low, high, floor)`` the best ``k`` rows with low <= score <= high and
        score >= floor: ``(window, id, row, score)``.  ``own`` is the anchor's row, left out."""
        af = a.astype(np.float64)
        exact = self.top * np.abs(af).max(initial=0.0) * len(a) < 2 ** 52
        slack = 1e-9 * self.top * np.abs(af).sum() + 1e-6
        least = [max(low, floor) for low, _, floor in windows]
        open_ = [w for w in range(len(windows)) if least[w] <= windows[w][1]]
        got: list[list] = [[np.zeros(0, np.int64)] * 2 for _ in windows]  # per window: places, scores
        wait: list[np.ndarray] = []
        size = 0

        def score() -> None:
            at = np.concatenate(wait)
            s = _scores(self.x[at], af if exact else a, exact)
            other = self.rows[at] != own
            for w in open_:
                fit = other & (s >= least[w]) & (s <= windows[w][1])
                if fit.any():
                    places, scores = np.concatenate([got[w][0], at[fit]]), np.concatenate([got[w][1], s[fit]])
                    if len(scores) > k:
                        best = np.lexsort((self.rows[places], self.ids[places], -scores))[:k]
                        places, scores = places[best], scores[best]
                    got[w] = [places, scores]

        def needed(w: int, limit: float) -> bool:
            """Whether a row of at most this score can still enter the window and be better than its worst."""
            return limit >= least[w] and not (len(got[w][1]) >= k and got[w][1].min() > limit)

        for bound, s, e in self.walk(af):
            limit = bound + slack
            if size and (size >= batch or not all(needed(w, limit) for w in open_)):  # rows that wait come before a window closes
                score()
                wait, size = [], 0
            open_ = [w for w in open_ if needed(w, limit)]
            if not open_:
                break
            wait.append(np.arange(s, e))
            size += e - s
        if size and open_:
            score()
        return [(w, int(self.ids[p]), int(self.rows[p]), int(s)) for w in range(len(windows)) for p, s in zip(*got[w])]


def _blocks(anchors: DataFrame) -> DataFrame:
    """Anchors ``(block, label, dim, row, q, windows)`` packed per block, with what bounds
    their scores: ``need`` is the least score that any of them asks for."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(pdf["q"])
        kind, raw = _packed(x)
        centre = x.mean(axis=0)
        windows = [[(int(w["low"]), int(w["high"]), int(w["floor"])) for w in ws] for ws in pdf["windows"]]
        need = min((max(low, floor) for ws in windows for low, high, floor in ws if max(low, floor) <= high), default=MOST)
        flat = np.array([v for ws in windows for w in ws for v in w], np.int64)
        return pd.DataFrame([{
            "block": pdf["block"].iloc[0], "label": pdf["label"].iloc[0], "dim": int(pdf["dim"].iloc[0]), "b_centre": centre,
            "b_radius": float(np.sqrt(((x - centre) ** 2).sum(axis=1).max())), "need": need, "anchors": pdf["row"].to_numpy(np.int64).tobytes(),
            "b_kind": kind, "a": raw, "sizes": np.array([len(ws) for ws in windows], np.int32).tobytes(), "windows": flat.tobytes()}])

    return anchors.select("block", "label", "dim", "row", "q", "windows").groupBy("block").applyInPandas(
        pack, "block string, label string, dim int, b_centre array<double>, b_radius double, need long, anchors binary, b_kind string, a binary, "
              "sizes binary, windows binary")


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _pairs(blocks: DataFrame, shards: DataFrame, same_label: bool, n_shards: int) -> DataFrame:
    """``(block, shard, bound)`` of the blocks and shards that may meet: anchor blocks against
    all shards, by their summaries only, dealt out in groups of shards."""
    groups = -(-n_shards // GROUP)
    b = blocks.select("block", F.col("label").alias("b_label"), "dim", "b_centre", "b_radius", "need",
                      F.explode(F.sequence(F.lit(0), F.lit(max(groups, 1) - 1))).alias("group"))
    s = shards.select("shard", "label", F.col("dim").alias("s_dim"), "centre", "radius",
                      F.pmod(F.xxhash64("shard"), F.lit(max(groups, 1))).cast("int").alias("s_group"))
    label = F.col("label") == F.col("b_label") if same_label else F.col("label") != F.col("b_label")
    length = lambda c: F.sqrt(_dot(c, c))
    bound = (_dot("b_centre", "centre") + length("b_centre") * F.col("radius") + F.col("b_radius") * length("centre")
             + F.col("b_radius") * F.col("radius"))
    both = b.join(s, (F.col("group") == F.col("s_group")) & (F.col("dim") == F.col("s_dim")) & label)
    return both.select("block", "shard", "need", (bound + 1e-6 + F.abs(bound) * 1e-9).alias("bound")).where("bound >= need")


def _searched(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, n_blocks: int, n_shards: int, books: dict, k: int) -> DataFrame:
    """``(row, w, other_id, other_row, score)`` found in the given pairs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, cells = None, None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.shard != last:
                    ids, rows = np.frombuffer(r.ids, np.int64), np.frombuffer(r.rows, np.int64)
                    x = np.frombuffer(r.x, r.kind).reshape(len(ids), r.dim).astype(np.int64)
                    last, cells = r.shard, Cells(x, np.frombuffer(r.codes, np.int32).reshape(-1, 2), ids, rows, books.get(r.dim))
                anchors, sizes = np.frombuffer(r.anchors, np.int64), np.frombuffer(r.sizes, np.int32)
                vectors = np.frombuffer(r.a, r.b_kind).reshape(len(anchors), r.dim).astype(np.int64)
                windows = [tuple(w) for w in np.frombuffer(r.windows, np.int64).reshape(-1, 3).tolist()]
                ends = np.cumsum(sizes)
                out = [(int(anchors[n]), *hit) for n in range(len(anchors))
                       for hit in cells.search(vectors[n], int(anchors[n]), windows[ends[n] - sizes[n]:ends[n]], k)]
                if out:
                    yield pd.DataFrame(out, columns=["row", "w", "other_id", "other_row", "score"])

    # a shard goes to as many tasks as its blocks, or idle cores, ask for
    spark = shards.sparkSession
    copies = max(1, -(-n_blocks // GROUP), min(n_blocks, -(-4 * spark.sparkContext.defaultParallelism // max(n_shards, 1))))
    part = F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int")
    asked = pairs.select("block", "shard").join(blocks.drop("label", "dim", "b_centre", "b_radius", "need"), "block").withColumn("part", part)
    kept = shards.select(F.col("shard").alias("s"), "dim", "rows", "ids", "codes", "kind", "x",
                         F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("p"))
    both = asked.join(kept, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p"))).drop("s", "p", "part", "block")
    return store(both.mapInPandas(run, "row long, w int, other_id long, other_row long, score long"), "negatives-found")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "w").orderBy(F.desc("score"), "other_id", "other_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_in_windows(anchors: DataFrame, shards: DataFrame, books: dict, k: int, same_label: bool) -> DataFrame:
    """The best ``k`` rows per anchor and window, in two rounds (see above)."""
    n_shards = shards.count()
    blocks = store(_blocks(anchors), "negatives-blocks")
    n_blocks = blocks.count()
    pairs = store(_pairs(blocks, shards, same_label, n_shards), "negatives-pairs")
    one = store(pairs.groupBy("block").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard")), "negatives-first")
    found = _searched(one, blocks, shards, n_blocks, n_shards, books, k)
    floors = (_best(found, k).groupBy("row", "w").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
              .groupBy(F.col("row").alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("w", "floor"))).alias("floors")))
    raised = F.transform("windows", lambda x, w: F.struct(x["low"].alias("low"), x["high"].alias("high"),
                                                          F.coalesce(F.try_element_at("floors", w), x["floor"]).alias("floor")))
    blocks = store(_blocks(anchors.join(floors, F.col("row") == F.col("of"), "left").withColumn("windows", raised)), "negatives-blocks")
    need = blocks.select("block", F.col("need").alias("now"))
    rest = pairs.join(one, ["block", "shard"], "left_anti").join(need, "block").where("bound >= now").select("block", "shard")
    return _best(found.union(_searched(store(rest, "negatives-rest"), blocks, shards, n_blocks, n_shards, books, k)), k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   codewords: int = CODEWORDS, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` has ``vec_id``, ``label`` and ``vector`` (whole numbers); ``is_anchor``
    tells its anchors.  An anchor's positives are its best ``positives`` other rows of
    its label; per positive, its negatives are the best ``negatives`` rows of other
    labels with ``low`` to ``high`` percent of the positive's score, both included.
    Scores are inner products; ties go to the smaller id.

    Rows with a null label, a null or empty vector or a null component take no
    part, and vectors of different length are not compared.  Rows with a null id
    take part, last among ties.  Repeated rows are rows of their own: each anchor row
    has its own result, and its copies are among its positives.  An empty table, an
    anchor without positives and a window without rows give no rows.  Other
    columns do not matter.  Scores must fit in a long.
    """
    q = F.col("vector")
    valid = F.col("label").isNotNull() & q.isNotNull() & (F.size(q) > 0) & F.forall(q, lambda x: x.isNotNull())
    rows = store(vectors.where(valid).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.size(q).alias("dim"), q.alias("q"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")), "negatives-rows")
    books = codebooks(rows, codewords, sample_rows)
    cells = with_cells(rows.drop("is_anchor"), books)
    shards = shards_of(cells, shard_rows)
    chosen = cells.join(rows.where("is_anchor").select("row"), "row")
    chosen = with_row_id(chosen, ["label", "dim", "i", "j", "row"], name="place", start=0)
    block = F.concat_ws("/", F.floor(F.col("place") / block_rows), "dim", "label")

    def window(low_: Column, high_: Column) -> Column:
        return F.struct(low_.cast("long").alias("low"), high_.cast("long").alias("high"), F.lit(LEAST).alias("floor"))

    anchors = store(chosen.select("row", "vec_id", "label", "dim", "q", block.alias("block"),
                                  F.array(window(F.lit(LEAST), F.lit(MOST))).alias("windows")), "negatives-anchors")
    good = store(top_in_windows(anchors, shards, books, positives, True)
                 .select("row", F.col("other_id").alias("positive"), "rank", F.col("score").alias("p_score")), "negatives-positives")
    # ceil and floor of the bounds, in whole numbers
    bounds = window(F.expr(f"-floor(CAST(p_score AS DECIMAL(20, 0)) * -{low} / 100)"), F.expr(f"floor(CAST(p_score AS DECIMAL(20, 0)) * {high} / 100)"))
    windows = good.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", bounds.alias("window")))), lambda x: x["window"]).alias("windows"))
    bad = top_in_windows(store(anchors.drop("windows").join(windows, "row"), "negatives-windows"), shards, books, negatives, False)
    named = anchors.select("row", F.col("vec_id").alias("anchor"))
    out = bad.join(good.select("row", (F.col("rank") - 1).alias("w"), "positive", "p_score"), ["row", "w"]).join(named, "row")

    def known(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(NO_ID))

    return out.select(known("anchor").alias("anchor_id"), known("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("other_id").alias("negative_id"),
                      F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    e = e.where(finite).select("vec_id", label.alias("label"), whole_numbers("embedding").alias("vector"))
    return hard_negatives(e, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_dot_product(a.q, e.q) AS BIGINT) AS score
  FROM e AS a JOIN e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
g AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM g WHERE rank <= 10
"""
