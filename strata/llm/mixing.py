"""Operator 5: mix sources to target weights.

Hash-random keys put the documents of a source in a fixed random order; the
key range is divided into buckets (more of them for a larger source), bucket
totals are summed first, and a running sum inside each bucket completes the
distributed prefix sum, so a source with a third of all rows is dealt over
many tasks.  Whole epochs come first, and the last pass is cut at the exact
budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, read_table, sealed, store, text_of, unsealed

#: Weights of the contract, by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
ROWS_PER_BUCKET = 4096
KEY_MAX = 16 ** 15


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def random_key(doc_id: Column, seed: int, text: Column | None = None) -> Column:
    """60 random bits of a document, the same in every run.  Documents without an id
    are told apart by their texts, so they do not all share one key."""
    unnamed = F.lit("null") if text is None else F.concat(F.lit("null"), F.md5(text.cast("binary")))
    named = F.concat(F.coalesce(doc_id.cast("string"), unnamed), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(source, source_size, ...)`` with ``weight`` and ``target`` added.

    Sources rank by code point, null last.  A target is the source's weight
    times one common level, or ``max_epochs`` times its size if that is less;
    the level at which the targets add up to all sizes is what repeated
    resharing of the excess ends at.  One row per source, so the ordered
    windows run over the source dimension, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    s = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                (rank % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("cap", max_epochs * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left.cast("double") / weight_left)
    s = s.withColumn("free", F.col("cap") > F.col("level") * F.col("weight"))
    # the first source in ratio order that stays below its cap sets the level of all such
    first = F.min_by("level", F.when(F.col("free"), F.col("cap") / F.col("weight"))).over(whole)
    s = s.withColumn("first", first)
    return s.withColumn("target", F.when(F.col("free"), F.col("first") * F.col("weight"))
                        .otherwise(F.col("cap").cast("double"))).drop("cap", "level", "free", "first")


def mix(docs: DataFrame, size: Column, seed: int = 17, weights: tuple = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, rows_per_bucket: int = ROWS_PER_BUCKET, text: Column | None = None) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__taken`` added.

    ``__taken`` counts the size units the mix takes of the row, repeats
    included: whole epochs of the source, then rows in key order until the
    source's budget (its target, rounded down) is reached, the last one in
    part.  A source's rows add up to exactly that budget.

    Null or empty texts have size 0 and give nothing; a null source is a
    source of its own, ranked last; rows with null or repeated ids are ranked
    by (id, size) and equal rows are interchangeable; ``text`` gives rows with a null id
    keys of their own; an empty table gives no rows; columns of ``docs`` keep their names
    and values (one of the four names above among them is an error).
    """
    x = _taken(docs, size, seed, weights, max_epochs, rows_per_bucket, text)
    return unsealed(x, docs, __size=F.col("__size"), __source_size=F.col("__s_source_size"), __target=F.col("__s_target"), __taken=F.col("__taken"))


def _taken(docs: DataFrame, size: Column, seed: int, weights: tuple, max_epochs: int, rows_per_bucket: int, text: Column | None) -> DataFrame:
    d = sealed(docs, __size=size, __source=F.col("source"), __doc=F.col("doc_id"), __key=random_key(F.col("doc_id"), seed, text))
    narrow = store(d.select(F.col("__source").alias("source"), "__key", "__size"), "mix-sizes")
    per_source = narrow.groupBy("source").agg(F.sum("__size").alias("source_size"), F.count("*").alias("rows"))
    src = source_targets(per_source, weights, max_epochs)
    budget = F.floor("target").cast("long")
    src = store(src.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
        F.greatest(F.lit(1), F.ceil(F.col("rows") / rows_per_bucket)).cast("long").alias("buckets"),
        budget.alias("budget")), "mix-sources")
    src = src.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    src = src.select(*[F.col(c).alias(f"__s_{c}") for c in src.columns])

    def bucketed(x: DataFrame, source: str) -> DataFrame:
        x = x.join(src, F.col(source).eqNullSafe(F.col("__s_source")))
        return x.withColumn("__bucket", F.floor(F.col("__key") / F.lit(float(KEY_MAX)) * F.col("__s_buckets")).cast("long"))

    sums = (bucketed(narrow, "source").groupBy("__s_source", "__bucket").agg(F.sum("__size").alias("__sum")))
    base = Window.partitionBy("__s_source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__s_source").alias("__b_source"), F.col("__bucket").alias("__b_bucket"),
                       F.coalesce(F.sum("__sum").over(base), F.lit(0)).alias("__base"))
    x = bucketed(d, "__source").join(
        sums, F.col("__source").eqNullSafe(F.col("__b_source")) & (F.col("__bucket") == F.col("__b_bucket")))
    inside = (Window.partitionBy("__source", "__bucket").orderBy("__key", "__doc", "__size")
              .rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.col("__base") + F.coalesce(F.sum("__size").over(inside), F.lit(0))
    last = F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__s_rest") - ahead))
    return x.withColumn("__taken", (F.col("__s_epochs") * F.col("__size") + last).cast("long"))


def mix_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself: each row as often as it is taken, columns unchanged.

    A row whose last copy is cut by the budget is kept whole, so a source
    passes its budget by less than one document.  Null and empty texts are never
    taken; repeated rows, null ids and null sources are as in ``mix``; an empty table
    gives no rows; columns of any name keep their values.
    """
    m = _taken(docs, word_count(text_of()), seed, WEIGHTS, MAX_EPOCHS, ROWS_PER_BUCKET, text_of())
    times = F.when(F.col("__size") > 0, F.ceil(F.col("__taken") / F.col("__size"))).otherwise(0).cast("int")
    m = m.withColumn("__copies", times).where("__copies > 0")
    return unsealed(m.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    m = mix(docs, word_count(text_of()), text=text_of())
    return m.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                    F.col("__target").alias("target"), F.col("__taken").alias("taken"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null' || md5(coalesce(text, ''))) || ':17'), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, (SELECT sum(source_size) FROM s)
            - coalesce(sum(3 * source_size) OVER before, 0) AS remaining,
         (SELECT sum(w) FROM s) - coalesce(sum(w) OVER before, 0) AS w_left
  FROM s WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, CAST(remaining AS DOUBLE) / CAST(w_left AS DOUBLE) AS lvl FROM r),
t AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size > lvl * w
              THEN (SELECT arg_min(lvl, CAST(3 * source_size AS DOUBLE) / w) FROM f WHERE 3 * source_size > lvl * w) * w
              ELSE CAST(3 * source_size AS DOUBLE) END AS target
  FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
         CAST(floor(e.target) AS BIGINT) - e.epochs * e.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - ahead)) AS BIGINT) AS taken
FROM p
"""
