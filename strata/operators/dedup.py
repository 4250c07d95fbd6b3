"""Latest row per key (``ROW_NUMBER() … = 1``).

Planned by Spark as a hash exchange on the keys followed by a sort and a
``WindowGroupLimit``; the same limit also runs *before* the exchange, so each
map task ships at most one row per key.  A hot key that holds a third of the
input therefore reaches its reducer as one row per map task, not as a third
of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import HOT_SHARE, frequent_keys

_UNSORTABLE = ("map",)


def _order_col(c) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def total_tiebreak(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """Every other column (ascending, NULLs first) as a final tiebreak.

    Equal order keys then pick the same survivor on every run and on every
    partitioning; rows that are equal in every column are interchangeable.
    """
    out = []
    for f in df.schema.fields:
        if f.name in exclude or f.dataType.typeName() in _UNSORTABLE:
            continue
        out.append(F.col(f.name).asc_nulls_first())
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                   tiebreak: Sequence | str | None = "all",
                   rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (strings = DESC NULLS LAST).

    ``tiebreak="all"`` appends every remaining column, so the result is
    deterministic even when the order keys tie (copies loaded together).
    """
    order = [_order_col(c) for c in order_by]
    if tiebreak == "all":
        named = set(keys) | {c for c in order_by if isinstance(c, str)}
        order += total_tiebreak(df, exclude=tuple(named))
    elif tiebreak:
        order += [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in tiebreak]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


#: Buckets of key hashes told apart by ``latest_split``: its broadcast set holds at most so many numbers.
BUCKETS = 1 << 20


def latest_split(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                 tiebreak: Sequence | str | None = "all", buckets: int = BUCKETS) -> DataFrame:
    """``latest_per_key`` for wide rows most of whose keys occur once.

    Hashes of the keys alone are counted first.  Rows in whose bucket of hashes no
    hash occurs twice are alone with their key: they stay where they are, neither
    shuffled nor sorted.  Only the others are ranked.  The buckets that repeat are a
    broadcast set of bounded size, and equal keys share a bucket, so the result is
    that of ``latest_per_key`` whatever the data; where every key repeats all rows are ranked.
    ``df`` is read three times, so it should be a cheap plan over stored tables.
    """
    key = F.xxhash64(*[F.col(k) for k in keys])
    # never null, so no side adds a filter to what the rows are joined from and both read one shuffle of it
    bucket = lambda h: F.coalesce(F.pmod(h, F.lit(buckets)), F.lit(0))
    again = (df.select(key.alias("__h")).groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
             .select(bucket(F.col("__h")).alias("__again")).distinct())
    marked = df.withColumn("__b", bucket(key))
    once = marked.join(F.broadcast(again), F.col("__b") == F.col("__again"), "left_anti").drop("__b")
    more = marked.join(F.broadcast(again), F.col("__b") == F.col("__again"), "left_semi").drop("__b")
    return once.unionAll(latest_per_key(more, keys, order_by, tiebreak))


def latest_sliced(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                  tiebreak: Sequence | str | None = "all") -> DataFrame:
    """``latest_per_key`` for wide rows most of whose keys repeat: all have to be shuffled.

    Large tables are stored first, apart by a hash of the keys, and ranked slice by
    slice, so that disk holds one slice's shuffle at a time.  Equal keys share a slice.
    """
    from .staged import Stage, slice_of, slices_for
    n = slices_for(df)
    if n == 1:
        return latest_per_key(df, keys, order_by, tiebreak)
    return Stage(df.sparkSession, "ranked").run(df, [(slice_of(keys, n), lambda part, _: latest_per_key(part, keys, order_by, tiebreak))], n)


def latest_spread(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                  tiebreak: Sequence | str | None = "all", share: float = HOT_SHARE) -> DataFrame:
    """``latest_per_key`` for wide rows with few rows a key.

    There the limit before the shuffle drops next to nothing, but sorts, and at size
    spills, all rows.  So they are shuffled as they come and sorted once, in partitions
    of the shuffle's size, a hash of the keys first: its 8 bytes tell nearly all keys apart.
    Keys that hold ``share`` of the rows or more, found by a sketch over the keys
    alone (a broadcast set of bounded size), go through ``latest_per_key``.  What the
    sketch finds decides how a row is ranked, not the result.  ``df`` is read three times.
    """
    mark = F.xxhash64(*[F.col(k) for k in keys])
    hot = F.broadcast(frequent_keys(df.select(mark.alias("h")), ["h"], share))
    on = F.xxhash64(mark) == F.col("hot")
    rest = df.join(hot, on, "left_anti").repartition(*[F.col(k) for k in keys]).withColumn("__h", mark)
    return (latest_per_key(rest, ["__h", *keys], order_by, tiebreak).drop("__h")
            .unionAll(latest_per_key(df.join(hot, on, "left_semi"), keys, order_by, tiebreak)))
