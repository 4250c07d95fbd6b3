"""Dimension lookups and orphan detection.

``lookup`` is the fact -> dimension join of a star schema: ``required=True``
is the INNER join that drops orphans, ``required=False`` the LEFT join that
keeps a NULL foreign key.  No join carries a hint: Catalyst broadcasts a
dimension from its size estimate, AQE from the measured size
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), and beyond that the join
is a sort-merge join whose skewed partitions AQE splits.  Building a lookup
runs no job and caches nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Reducers over which a LEFT lookup spreads rows without a key.
NULL_SPREAD = 64


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    out = []
    for x in on:
        out.append((x, x) if isinstance(x, str) else tuple(x))
    return out


def _own_key(fact: DataFrame, on: Sequence[str]) -> list[str]:
    return [c for c in fact.columns if c not in on][:1] or list(fact.columns[:1])


def lookup(fact: DataFrame, dim: DataFrame, on, take, required: bool = True,
           salt: int = 1, salt_by: Sequence[str] | None = None) -> DataFrame:
    """Join ``dim`` to ``fact`` on ``on`` and append the ``take`` columns.

    ``on``: name, list of names, or ``{fact_col: dim_col}``; ``take``: list of
    dim columns or ``{dim_col: alias}``.

    In a LEFT join the rows with a NULL key (anonymous customers) match
    nothing; a second join key spreads them over ``NULL_SPREAD`` reducers
    instead of sending them all to one.  It is a hash of ``salt_by``, by default of
    the fact's first column (its own key) alone, so that no other column has to be read.

    ``salt=n`` (for a shuffle join whose key is hot, when AQE skew splitting
    is not available): every dimension row is copied ``n`` times with salts
    ``0..n-1`` and each fact row carries ``xxhash64(salt_by) mod n`` (a
    deterministic value, by default of the fact's first column), so one hot key is
    spread over ``n`` reducers.  Each fact row still meets exactly the
    dimension rows of its key, so the result is the same.
    """
    pairs = _pairs(on)
    take_map = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    sel = [F.col(d).alias(f"__k{i}") for i, (_, d) in enumerate(pairs)]
    sel += [F.col(src).alias(dst) for src, dst in take_map.items()]
    right = dim.select(*sel)
    if salt > 1:
        cols = list(salt_by) if salt_by else _own_key(fact, [f for f, _ in pairs])
        fact = fact.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt)))
        right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                F.lit(salt - 1).cast("long"))))
    if not required:
        void = F.lit(False)
        for f, _ in pairs:
            void = void | F.col(f).isNull()
        own = list(salt_by) if salt_by else _own_key(fact, [f for f, _ in pairs])
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in own]), F.lit(NULL_SPREAD))
        fact = fact.withColumn("__spread", F.when(void, spread).otherwise(F.lit(0).cast("long")))
        # always 0, but not a literal: that would be folded out of the join keys
        zero = F.pmod(F.xxhash64(*[F.col(f"__k{i}") for i in range(len(pairs))]), F.lit(1))
        right = right.withColumn("__zero", zero)
    cond = None
    for i, (f, _) in enumerate(pairs):
        e = fact[f] == right[f"__k{i}"]
        cond = e if cond is None else (cond & e)
    if salt > 1:
        cond = cond & (fact["__salt"] == right["__salt"])
    if not required:
        cond = cond & (fact["__spread"] == right["__zero"])
    out = fact.join(right, cond, "inner" if required else "left")
    drop = [f"__k{i}" for i in range(len(pairs))]
    if salt > 1:
        out = out.drop(fact["__salt"]).drop(right["__salt"])
    return out.drop(*drop, "__spread", "__zero")


#: Keys that count as frequent hold this share of the rows; at most so many are told apart.
HOT_SHARE, HOT_KEYS, HOT_TRACKED = 0.005, 256, 8192


def _key_hash(df: DataFrame, names: Sequence[str]):
    """Hash of the join keys; whole numbers of any width hash alike, null for a null key."""
    cols, void = [], F.lit(False)
    for n in names:
        t = df.schema[n].dataType
        cols.append(F.col(n).cast("long") if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)) else F.col(n))
        void = void | F.col(n).isNull()
    return F.when(~void, F.xxhash64(*cols))


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, most: int = HOT_KEYS,
                  tracked: int = HOT_TRACKED) -> DataFrame:
    """``(hot)``: hashes of the keys that hold ``share`` of the rows or more.

    One pass of a frequent-items sketch (``tracked`` counters per task, merged by
    Spark), so at most ``most`` rows, whatever the data.  A hash that is wrongly in
    or missing only changes how a row is joined.
    """
    top = df.select(_key_hash(df, keys).alias("h")).where("h IS NOT NULL").agg(
        F.expr(f"approx_top_k(h, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n"))
    return (top.select(F.explode("top").alias("t"), "n").where(F.col("t.count") >= share * F.col("n"))
            .select(F.col("t.item").alias("hot")))


def lookup_split(fact: DataFrame, dim: DataFrame, on, take, required: bool = True, share: float = HOT_SHARE,
                 most: int = HOT_KEYS) -> DataFrame:
    """``lookup`` with the fact's frequent keys joined apart.

    A sketch of the fact's keys finds the few that hold ``share`` of its rows or
    more.  Their rows meet the dimension rows of those keys in a broadcast join
    (at most ``most`` keys, each one row of the dimension), which moves none of
    them; all other rows, where no key is hot any more, go through the usual
    join, and so do rows without a key.  The keys of ``dim`` must be unique, as a
    dimension's are.  The result is that of ``lookup``.
    """
    pairs = _pairs(on)
    for f, d in pairs:
        a, b = fact.schema[f].dataType, dim.schema[d].dataType
        if a != b and not (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)):
            raise ValueError(f"{f} and {d} differ in type: {a.simpleString()}, {b.simpleString()}")
    fkeys, dkeys = [f for f, _ in pairs], [d for _, d in pairs]
    hot = frequent_keys(fact, fkeys, share, most)
    marked = (fact.withColumn("__h", _key_hash(fact, fkeys))
              .join(F.broadcast(hot.select("hot", F.lit(True).alias("__is_hot"))), F.col("__h") == F.col("hot"), "left").drop("hot", "__h"))
    few = (dim.withColumn("__h", _key_hash(dim, dkeys)).join(F.broadcast(hot), F.col("__h") == F.col("hot"), "left_semi").drop("__h"))
    often = lookup_plain(marked.where("__is_hot").drop("__is_hot"), F.broadcast(few), pairs, take, required)
    rest = lookup(marked.where("__is_hot IS NULL").drop("__is_hot"), dim, pairs, take, required)
    return often.unionByName(rest)


def lookup_plain(fact: DataFrame, dim: DataFrame, on, take, required: bool = True) -> DataFrame:
    """The join of ``lookup`` without its provisions for rows without a key."""
    pairs = _pairs(on)
    take_map = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    right = dim.select(*[F.col(d).alias(f"__k{i}") for i, (_, d) in enumerate(pairs)], *[F.col(s).alias(t) for s, t in take_map.items()])
    cond = F.lit(True)
    for i, (f, _) in enumerate(pairs):
        cond = cond & (F.col(f) == F.col(f"__k{i}"))
    return fact.join(right, cond, "inner" if required else "left").drop(*[f"__k{i}" for i in range(len(pairs))])


def orphans(child: DataFrame, parent: DataFrame, fk: str | Sequence[str],
            pk: str | Sequence[str] | None = None, nullable: bool = False,
            null_texts: Sequence[str] = ()) -> DataFrame:
    """Child rows whose foreign key has no parent (``LEFT ANTI`` join).

    ``nullable=True`` skips NULL keys (and keys equal to ``null_texts``);
    otherwise a NULL key is an orphan, since it matches no parent.
    """
    fks = [fk] if isinstance(fk, str) else list(fk)
    pks = fks if pk is None else ([pk] if isinstance(pk, str) else list(pk))
    c = child
    if nullable:
        for k in fks:
            c = c.filter(F.col(k).isNotNull())
            if null_texts:
                c = c.filter(~F.col(k).isin(list(null_texts)))
    keys = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(pks)])
    cond = None
    for i, k in enumerate(fks):
        e = c[k] == keys[f"__p{i}"]
        cond = e if cond is None else (cond & e)
    return c.join(keys, cond, "left_anti")
