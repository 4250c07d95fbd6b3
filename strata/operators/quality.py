"""Data-quality checks.  Each returns the failing rows (empty = pass).

Checks on one table are folded into one aggregate pass by ``run_suite``;
uniqueness and foreign keys need their own shuffle (group-by / anti join).
NULL rules follow the usual warehouse test conventions: ``unique``,
``accepted_values``, ``accepted_range``, ``expression_is_true`` and
``relationships`` let NULL pass; ``unique_combination_of_columns`` groups
NULLs like values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import ratio_pct
from .lookup import orphans


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- column checks

def check_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Key values held by more than one row, with ``n_records``.

    One column: NULL is ignored.  Several columns: NULL groups like a value.
    The count is a partial + final aggregate, so a hot key is pre-counted on
    each map task before the shuffle.
    """
    src = df.filter(F.col(cols[0]).isNotNull()) if len(cols) == 1 else df
    return (src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
               .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values outside ``values`` with their counts (NULL passes)."""
    return (df.filter(~F.col(col).isin(list(values)))
              .groupBy(F.col(col).alias("value_field"))
              .agg(F.count(F.lit(1)).alias("n_records")))


def check_range(df: DataFrame, col: str, min_value=None, max_value=None,
                inclusive: bool = True) -> DataFrame:
    """Rows outside ``[min, max]`` (either bound optional; NULL passes)."""
    return df.filter(~_range_ok(F.col(col), min_value, max_value, inclusive))


def _range_ok(x: Column, lo, hi, inclusive: bool) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((x >= lo) if inclusive else (x > lo))
    if hi is not None:
        cond = cond & ((x <= hi) if inclusive else (x < hi))
    return cond


def check_expr(df: DataFrame, expr: str | Column) -> DataFrame:
    """Rows where the SQL expression is FALSE (NULL passes)."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return df.filter(~e)


def check_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows with a non-NULL key that has no parent."""
    return orphans(child, parent, fk, pk, nullable=True)


def check_at_least_one(df: DataFrame, col: str) -> DataFrame:
    """One row (``n_values = 0``) when the column has no non-NULL value."""
    return (df.agg(F.count(F.col(col)).alias("n_values"))
              .filter(F.col("n_values") == 0))


def check_count(df: DataFrame, expected: int) -> DataFrame:
    """One row (``failing_row = 1``) when the row count differs from ``expected``."""
    return (df.agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") != expected)
              .select(F.lit(1).alias("failing_row")))


# ------------------------------------------------------------- singular checks

@dataclass
class ReconcilePair:
    name: str
    gold: DataFrame
    silver: DataFrame
    silver_filter: Column | None = None


def reconcile(pairs: Sequence[ReconcilePair], min_ratio: float = 0.95,
              failing_only: bool = True) -> DataFrame:
    """Gold vs silver row counts; fails when gold < CAST(silver * ratio AS BIGINT).

    ``retention_pct = ROUND(gold * 100 / NULLIF(silver, 0), 2)``.  Each side
    is one count (a partial + final aggregate); only one row per side meets in
    the union.
    """
    rows = None
    for p in pairs:
        s = p.silver if p.silver_filter is None else p.silver.filter(p.silver_filter)
        g = p.gold.agg(F.count(F.lit(1)).alias("gold_count"))
        sc = s.agg(F.count(F.lit(1)).alias("silver_count"))
        one = g.crossJoin(sc).select(F.lit(p.name).alias("fact_table"), "gold_count",
                                     "silver_count")
        rows = one if rows is None else rows.unionByName(one)
    return _judged(rows, min_ratio, failing_only)


def reconcile_counts(spark, counts: Sequence[tuple[str, int, int]], min_ratio: float = 0.95, failing_only: bool = True) -> DataFrame:
    """``reconcile`` from counts ``(name, gold, silver)`` that are known already, such
    as those observed while the layers were written: no table is read again."""
    rows = spark.createDataFrame([tuple(c) for c in counts], "fact_table string, gold_count long, silver_count long")
    return _judged(rows, min_ratio, failing_only)


def _judged(rows: DataFrame, min_ratio: float, failing_only: bool) -> DataFrame:
    out = rows.select(
        "fact_table", "gold_count", "silver_count",
        ratio_pct("gold_count", "silver_count").alias("retention_pct"),
        # decimal arithmetic, truncated like CAST(silver_count * 0.95 AS BIGINT)
        (F.col("gold_count") < F.expr(f"CAST(silver_count * {min_ratio!r} AS BIGINT)"))
        .alias("failed"))
    if failing_only:
        out = out.filter("failed").drop("failed")
    return out


def inactive_dim_rows(facts: Sequence[tuple[str, DataFrame, str, str]], dim: DataFrame,
                      dim_key: str, flag: str = "is_active",
                      carry: Sequence[str] = ("source_employee_id", "staff_status")) -> DataFrame:
    """Fact rows that point at a dimension row whose ``flag`` is FALSE.

    ``facts``: (label, fact, fact_key_col, fk_col).  NULL flags are not FALSE
    and are not reported.  The dimension is filtered before the join, so only
    inactive rows take part.
    """
    bad = dim.filter(F.col(flag) == F.lit(False)).select(
        F.col(dim_key).alias("__dk"), *[F.col(c) for c in carry])
    out = None
    for label, fact, key_col, fk in facts:
        j = (fact.select(F.col(key_col).alias("fact_key"), F.col(fk))
                 .join(bad, F.col(fk) == F.col("__dk"), "inner")
                 .select(F.lit(label).alias("fact_table"), "fact_key",
                         F.col(fk).alias(dim_key), *carry))
        out = j if out is None else out.unionByName(j)
    return out


# Fixed value: separator between table and check in the violation label.
LABEL_SEP = " — "


def null_fk_report(facts: Mapping[str, tuple[DataFrame, Sequence[str]]],
                   failing_only: bool = True) -> DataFrame:
    """``'<fact> — NULL <col>'`` with its violation count, one scan per fact."""
    out = None
    for name, (df, cols) in facts.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stacked = agg.select(F.explode(F.array(*[
            F.struct(F.lit(f"{name}{LABEL_SEP}NULL {c}").alias("validation"),
                     F.col(c).cast("long").alias("violation_count")) for c in cols
        ])).alias("r")).select("r.validation", "r.violation_count")
        out = stacked if out is None else out.unionByName(stacked)
    if failing_only:
        out = out.filter(F.col("violation_count") > 0)
    return out


@dataclass
class Relation:
    label: str
    child: DataFrame
    fk: str
    parent: DataFrame
    pk: str
    nullable: bool = False


# Text spelling of a missing key skipped by nullable relations.
RI_NULL_TEXTS = ("None",)


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One row ``(total, orphans)`` for the child key column.

    The child keys are first counted per distinct value (partial + final
    aggregate), so the anti join and its shuffle see each key value once,
    however many rows hold it.
    """
    per_key = child.groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    keys = parent.select(F.col(pk).alias("__pk"))
    missing = per_key.join(keys, per_key["__fk"] == keys["__pk"], "left_anti")
    total = per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("total"))
    orph = missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("orphans"))
    return total.crossJoin(orph)


def _ri_group(rels: Sequence[tuple[int, Relation]]) -> DataFrame:
    """RI rows for relations that share one child table, with one scan of it.

    Each child row emits ``(relation, key)`` per relation (nullable relations
    skip NULL and ``'None'`` keys; mandatory ones keep NULL, which then finds
    no parent).  Entries are counted per distinct pair before the anti join
    against the tagged union of the parents' keys.
    """
    child_df = rels[0][1].child
    entries = []
    for i, r in rels:
        e = F.struct(F.lit(i).alias("rid"), F.col(r.fk).cast("string").alias("key"))
        if r.nullable:
            e = F.when(F.col(r.fk).isNotNull() & ~F.col(r.fk).isin(list(RI_NULL_TEXTS)), e)
        entries.append(e)
    per_key = (child_df.select(F.explode(F.array(*entries)).alias("u"))
                       .filter(F.col("u").isNotNull())
                       .groupBy(F.col("u.rid").alias("rid"), F.col("u.key").alias("key"))
                       .agg(F.count(F.lit(1)).alias("n")))
    parents = None
    for i, r in rels:
        p = r.parent.select(F.lit(i).alias("rid"), F.col(r.pk).cast("string").alias("key"))
        parents = p if parents is None else parents.unionByName(p)
    # a NULL key (mandatory relation) never equals a parent key: an orphan
    missing = per_key.join(parents, (per_key["rid"] == parents["rid"])
                           & (per_key["key"] == parents["key"]), "left_anti")
    totals = per_key.groupBy("rid").agg(F.sum("n").alias("total"))
    orphans_ = missing.groupBy("rid").agg(F.sum("n").alias("orphans"))
    spark = child_df.sparkSession
    labels = spark.createDataFrame([(i, r.label, r.nullable) for i, r in rels],
                                   "rid int, label string, nullable boolean")
    return (labels.join(totals, "rid", "left").join(orphans_, "rid", "left")
                  .select("rid", "label",
                          F.coalesce(F.col("total"), F.lit(0)).cast("long").alias("total"),
                          F.coalesce(F.col("orphans"), F.lit(0)).cast("long").alias("orphans"),
                          "nullable"))


def ri_report(relations: Sequence[Relation]) -> DataFrame:
    """Per relation: label, total, orphans, orphan %, nullable, PASS/FAIL.

    A nullable relation skips NULL (and ``'None'``) keys; a mandatory one
    counts a NULL key as an orphan.  ``pct = orphans / max(total, 1) * 100``.
    Relations on the same child DataFrame share one scan of it.
    """
    groups: dict[int, list[tuple[int, Relation]]] = {}
    for i, r in enumerate(relations):
        groups.setdefault(id(r.child), []).append((i, r))
    out = None
    for rels in groups.values():
        g = _ri_group(rels)
        out = g if out is None else out.unionByName(g)
    return out.select(
        "label", "total", "orphans",
        (F.col("orphans") / F.greatest(F.col("total"), F.lit(1)) * 100.0).alias("orphan_pct"),
        "nullable",
        F.when(F.col("orphans") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


# ------------------------------------------------------------------- test suite

@dataclass
class Check:
    """A declared test: kind in not_null, unique, unique_combination,
    accepted_values, accepted_range, expression_is_true, relationships,
    at_least_one, row_count."""
    kind: str
    column: str | None = None
    columns: Sequence[str] = ()
    values: Sequence = ()
    min_value: object = None
    max_value: object = None
    inclusive: bool = True
    expression: str | None = None
    parent: str | None = None
    parent_column: str | None = None
    expected: int | None = None
    severity: str = "error"
    name: str = field(default="")

    def label(self) -> str:
        if self.name:
            return self.name
        what = self.column or ",".join(self.columns) or (self.expression or "")
        return f"{self.kind}({what})"


_FOLDABLE = {"not_null", "accepted_values", "accepted_range", "expression_is_true",
             "at_least_one", "row_count"}


def _failure_count(df: DataFrame, chk: Check) -> Column:
    x = F.col(chk.column) if chk.column else None
    if chk.kind == "not_null":
        return F.count_if(x.isNull())
    if chk.kind == "accepted_values":
        return F.count_if(~x.isin(list(chk.values)))
    if chk.kind == "accepted_range":
        return F.count_if(~_range_ok(x, chk.min_value, chk.max_value, chk.inclusive))
    if chk.kind == "expression_is_true":
        return F.count_if(~F.expr(chk.expression))
    if chk.kind == "at_least_one":
        return F.when(F.count(x) == 0, F.lit(1)).otherwise(F.lit(0))
    if chk.kind == "row_count":
        return F.when(F.count(F.lit(1)) != chk.expected, F.lit(1)).otherwise(F.lit(0))
    raise ValueError(chk.kind)


def _key_hash(*cols: Column) -> Column:
    """64-bit hash of a key's texts."""
    return F.xxhash64(*[c.cast("string") for c in cols])


def _labels(df: DataFrame, model: str, checks: Sequence[Check], failures: DataFrame) -> DataFrame:
    labels = df.sparkSession.createDataFrame(
        [(i, model, c.label(), c.severity) for i, c in enumerate(checks)],
        "cid int, model string, test string, severity string")
    return (labels.join(failures, "cid", "left")
                  .select("model", "test", F.coalesce(F.col("f"), F.lit(0)).cast("long").alias("failures"),
                          "severity"))


def _unique_failures(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """All uniqueness checks of one table: hashed counts first, exact keys where a hash repeats.

    Each row emits one ``(check, hash of the key)`` per check (single-column
    checks skip NULL keys), and only these numbers are counted and shuffled.
    Keys whose hash is held once are unique.  The rows of the other hashes
    are counted by their keys themselves (as arrays of texts), so keys that merely share
    a hash are told apart.
    """
    def entries(*more: str) -> DataFrame:
        out = []
        for i, c in enumerate(checks):
            cols = [F.col(c.column)] if c.kind == "unique" else [F.col(x) for x in c.columns]
            own = {"key": F.array(*[x.cast("string") for x in cols])}
            e = F.struct(F.lit(i).alias("cid"), _key_hash(*cols).alias("h"), *[own[m].alias(m) for m in more])
            out.append(F.when(F.col(c.column).isNotNull(), e) if c.kind == "unique" else e)
        return (df.select(F.explode(F.array(*out)).alias("u")).filter(F.col("u").isNotNull())
                  .select("u.cid", "u.h", *[f"u.{m}" for m in more]))

    again = entries().groupBy("cid", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("cid", "h")
    dup = (entries("key").join(again, ["cid", "h"], "left_semi").groupBy("cid", "key").agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1).groupBy("cid").agg(F.count(F.lit(1)).alias("f")))
    return _labels(df, model, checks, dup)


def _fk_failures(df: DataFrame, model: str, checks: Sequence[Check],
                 tables: Mapping[str, DataFrame]) -> DataFrame:
    """All foreign-key checks of one table with one scan of it, on hashed keys.

    The child emits ``(check, hash, second hash)`` per non-NULL foreign key and
    is counted per distinct key (partial + final aggregate, so a hot key is
    one row per map task); the parents' keys are hashed alike and unioned.  One
    anti join leaves the keys without a parent.  Keys of one hash are told apart by
    the second, independent one (a 32-bit hash and the length), so that no text is shuffled.
    """
    def numbers(c: Column) -> list[Column]:
        t = c.cast("string")
        other = F.shiftleft(F.length(t).cast("long"), 32).bitwiseOR(F.hash(t, F.lit(1)).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        return [_key_hash(c).alias("h"), other.alias("h2")]

    entries = [F.when(F.col(c.column).isNotNull(), F.struct(F.lit(i).alias("cid"), *numbers(F.col(c.column))))
               for i, c in enumerate(checks)]
    child = (df.select(F.explode(F.array(*entries)).alias("u")).filter(F.col("u").isNotNull())
               .groupBy(F.col("u.cid").alias("cid"), F.col("u.h").alias("h"), F.col("u.h2").alias("h2"))
               .agg(F.count(F.lit(1)).alias("n")))
    parents = None
    for i, c in enumerate(checks):
        p = tables[c.parent].where(F.col(c.parent_column).isNotNull()).select(F.lit(i).alias("cid"), *numbers(F.col(c.parent_column)))
        parents = p if parents is None else parents.unionByName(p)
    missing = (child.join(parents, ["cid", "h", "h2"], "left_anti")
                    .groupBy("cid").agg(F.sum("n").alias("f")))
    return _labels(df, model, checks, missing)


def run_suite(tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence[Check]]) -> DataFrame:
    """Run declared checks; one row per check: model, test, failures, severity, status.

    Per table (one scan each): all row-level checks share ONE aggregate pass,
    all uniqueness checks share one grouped count, and all ``relationships``
    checks share one anti join over the distinct (check, key) pairs.
    """
    out = []
    for model, checks in suite.items():
        df = tables[model]
        fold = [c for c in checks if c.kind in _FOLDABLE]
        if fold:
            agg = df.agg(*[_failure_count(df, c).cast("long").alias(f"c{i}")
                           for i, c in enumerate(fold)])
            out.append(agg.select(F.explode(F.array(*[
                F.struct(F.lit(model).alias("model"), F.lit(c.label()).alias("test"),
                         F.col(f"c{i}").alias("failures"), F.lit(c.severity).alias("severity"))
                for i, c in enumerate(fold)])).alias("r")).select("r.*"))
        uniq = [c for c in checks if c.kind in ("unique", "unique_combination")]
        if uniq:
            out.append(_unique_failures(df, model, uniq))
        fks = [c for c in checks if c.kind == "relationships"]
        if fks:
            out.append(_fk_failures(df, model, fks, tables))
        unknown = [c.kind for c in checks if c.kind not in _FOLDABLE
                   and c.kind not in ("unique", "unique_combination", "relationships")]
        if unknown:
            raise ValueError(unknown)
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res.withColumn(
        "status",
        F.when(F.col("failures") == 0, F.lit("PASS"))
         .when(F.col("severity") == "warn", F.lit("WARN")).otherwise(F.lit("FAIL")))


def with_severity(failing: DataFrame, severity: str) -> DataFrame:
    """Tag a check result with its severity (``warn`` or ``error``)."""
    return failing.withColumn("severity", F.lit(severity))


__all__ = ["check_unique", "check_not_null", "check_accepted", "check_range", "check_expr",
           "check_fk", "check_at_least_one", "check_count", "ReconcilePair", "reconcile", "reconcile_counts",
           "inactive_dim_rows", "null_fk_report", "Relation", "ri_report", "Check",
           "run_suite", "with_severity", "orphan_count"]
