"""Operator 10: learned decision lists of quality rules, in DataFrame operations.

Text statistics are built-in expressions.  The list is learned from labelled
rows by sequential covering: a rule grows by the threshold condition of the
best information gain over counts per (statistic, bin), is pruned on held-out
rows, and what it covers is set aside; the result is one ordered ``CASE WHEN``
expression over the statistics.

Only counts per statistic and bin reach the driver.  Learning may use a
bounded sample: at most about ``SAMPLE_ROWS`` labelled rows, by a hash of the
id; the statistics and the verdicts cover every row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, sealed, store, text_of, unsealed

WINDOW = 8
SAMPLE_ROWS = 200_000
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_PRECISION = 0.95
MIN_COVER = 10
QUANTILES = [0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995]

#: Ratios that rules may test, over the counts of ``with_counts``.
RATIOS = {
    "mean_word": "word_chars / n_words",
    "symbol_share": "n_symbols / n_words",
    "mark_share": "n_marks / n_words",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct / n_words",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
          "n_upper", "n_digits", "n_marks"]


def with_counts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with a struct column ``__q`` of the counts of each text.

    Arrays that later steps read more than once are columns of their own, so
    they are computed once a row.  Windows are compared by 64-bit hashes.
    """
    t, w, h, win, s, p = (F.col(f"__{c}") for c in ("t", "w", "h", "win", "s", "p"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.withColumn("__t", text_of())
    d = d.withColumns({"__w": F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), ""), "__l": lines})
    d = d.withColumns({"__n": F.size(w), "__h": F.transform(w, lambda x: F.xxhash64(x)),
                       "__chars": F.length(F.array_join(w, ""))})
    d = d.withColumns({"__win": F.when(F.col("__n") >= window, h), "__distinct": F.size(F.array_distinct(h))})
    # hashes of 2, 4, ... words from those of half as many; the last step may overlap
    size = 1
    while size < window:
        by = min(size, window - size)
        k = F.size(win) - by
        d = d.withColumn("__win", F.zip_with(F.slice(win, 1, k), F.slice(win, 1 + by, k), lambda a, b: F.xxhash64(a, b)))
        size += by
    pairs = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    d = d.withColumn("__s", F.when(F.size(F.array_distinct(win)) < F.size(win), pairs))
    # equal neighbours in hash order, either side; then their places in text order
    m = F.size(s)
    same = F.zip_with(F.slice(s, 1, m - 1), F.slice(s, 2, m - 1), lambda a, b: a["x"] == b["x"])
    d = d.withColumn("__p", F.when(s.isNotNull(), same))
    no = F.array(F.lit(False))
    either = F.zip_with(F.concat(p, no), F.concat(no, p), lambda a, b: a | b)
    at = F.zip_with(s, either, lambda a, b: F.when(b, a["i"]))
    d = d.withColumn("__p", F.sort_array(F.array_compact(at)))
    k = F.size(p)
    gaps = F.zip_with(F.slice(p, 1, k - 1), F.slice(p, 2, k - 1), lambda a, b: F.least(b - a, F.lit(window)))
    covered = F.when(p.isNotNull() & (k > 0), F.aggregate(gaps, F.lit(window), lambda a, b: a + b)).otherwise(0)
    ln = F.col("__l")
    counts = {"n_words": F.col("__n"), "word_chars": F.col("__chars"),
              "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")),
              "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)), "n_repeat_words": covered,
              "n_lines": F.size(ln), "n_distinct": F.col("__distinct"),
              "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")), "n_digits": F.regexp_count(t, F.lit("[0-9]")),
              "n_marks": F.regexp_count(t, F.lit("[.,;:!?]"))}
    # a generator of one row: filters on the counts stay above it, else they would
    # be pushed below and compute every array again
    return d.select(*[F.col(f"`{c}`") for c in docs.columns],
                    F.explode(F.array(F.struct(*[v.cast("long").alias(c) for c, v in counts.items()]))).alias("__q"))


def base_failed(q: str = "") -> Column:
    """The fixed rules, over the counts under the prefix ``q``."""
    n, rep = F.col(q + "n_words"), F.col(q + "n_repeat_words")
    return (n < 20) | (100 * rep > 30 * n)


def ratio(name: str, q: str = "") -> Column:
    """A ratio of two counts; 0 where the lower one is 0."""
    a, b = RATIOS[name].split(" / ")
    return F.when(F.col(q + b) > 0, F.col(q + a).cast("double") / F.col(q + b)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    limit: float

    def column(self, q: str = "") -> Column:
        v = ratio(self.name, q)
        return v > self.limit if self.above else v <= self.limit

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.limit:.6g}"


def verdict(rules: list[list[Condition]], q: str = "") -> Column:
    """The decision list as one ordered conditional expression: true to keep.
    The fixed rules come first."""
    out = F.when(base_failed(q), F.lit(False))
    for rule in rules:
        hit = rule[0].column(q)
        for c in rule[1:]:
            hit = hit & c.column(q)
        out = out.when(hit, F.lit(False))
    return out.otherwise(F.lit(True))


def learn(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_rules: int = MAX_RULES,
          min_precision: float = MIN_PRECISION) -> list[list[Condition]]:
    """The rules, in order, that tell rows of quality 0.

    ``stats`` has doc_id and the counts; ``labels`` doc_id and quality.  Rows
    without a known label or that fail the fixed rules are not learned from;
    of several labels of one id the least counts.  Without rows of both classes
    there are no rules.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = store(stats.where(~base_failed()).join(known, "doc_id").select(
        "doc_id", (F.col("quality") == 0).cast("int").alias("bad"), *[ratio(r).alias(r) for r in RATIOS]), "quality-labelled")
    total = rows.count()
    if total > sample_rows:
        share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1_000_000)) < int(1e6 * sample_rows / total)
        rows = rows.where(share)
    names = list(RATIOS)
    both = rows.groupBy("bad").agg(F.count("*").alias("n"), *[F.percentile(r, F.array(*map(F.lit, QUANTILES))).alias(r) for r in names])
    seen = {r["bad"]: r for r in both.collect()}  # two rows
    if len(seen) < 2:
        return []
    limits = {r: sorted({round(float(x), 9) for c in seen.values() for x in c[r]}) for r in names}
    # bin k of a statistic: above its first k limits
    def bin_of(r: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, limits[r])), lambda x: F.col(r) > x)).alias(r)

    binned = rows.select("bad", (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0).alias("held"), *map(bin_of, names))
    # equal rows count once, with a weight
    binned = store(binned.groupBy("bad", "held", *names).agg(F.count("*").alias("n")), "quality-binned")

    def met(c: Condition) -> Column:
        k = limits[c.name].index(c.limit)
        return F.col(c.name) > k if c.above else F.col(c.name) <= k

    def met_all(rule: list[Condition]) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & met(c)
        return out

    def tally(df: DataFrame) -> dict[str, list[tuple[int, int]]]:
        """Bad and good rows per statistic and bin."""
        each = df.select("bad", "n", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.col(r).alias("k")) for r in names])).alias("e"))
        got = each.groupBy("e.r", "e.k").agg(F.sum(F.col("bad") * F.col("n")).alias("p"), F.sum("n").alias("n")).collect()
        out = {r: [(0, 0)] * (len(limits[r]) + 1) for r in names}
        for g in got:
            out[g["r"]][g["k"]] = (g["p"], g["n"] - g["p"])
        return out

    def best(counts: dict, p0: int, n0: int) -> tuple[float, Condition, int, int] | None:
        top = None
        for r in names:
            bins, p, n = counts[r], 0, 0
            for k, limit in enumerate(limits[r]):
                p, n = p + bins[k][0], n + bins[k][1]
                for above, a, b in ((True, p0 - p, n0 - n), (False, p, n)):
                    if a >= MIN_COVER and b < n0:
                        gain = a * (math.log2(a / (a + b)) - math.log2(p0 / (p0 + n0)))
                        if top is None or gain > top[0] + 1e-9:
                            top = (gain, Condition(r, above, limit), a, b)
        return top

    rules: list[list[Condition]] = []
    left = binned
    while len(rules) < max_rules:
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            counts = tally(left.where(~F.col("held")).where(met_all(rule)))
            p0, n0 = (sum(x[i] for x in counts[names[0]]) for i in (0, 1))
            top = best(counts, p0, n0) if p0 >= MIN_COVER and n0 else None
            if top is None or top[0] <= 0:
                break
            rule.append(top[1])
            if top[3] == 0:
                break
        if not rule:
            break
        # the beginning of the rule that does best on the held-out rows
        def hits(i: int, cls: int) -> Column:
            return F.sum(F.when(met_all(rule[:i]) & (F.col("bad") == cls), F.col("n")).otherwise(0))
        sums = left.where("held").agg(*[hits(i, c).alias(f"h{i}{c}") for i in range(1, len(rule) + 1) for c in (0, 1)]).first()
        worth = []
        for i in range(1, len(rule) + 1):
            p, n = sums[f"h{i}1"] or 0, sums[f"h{i}0"] or 0
            precision = (p + 1) / (p + n + 2) if p + n else 0
            worth.append(((p - n) / (p + n) if p + n else -1, precision if p + n >= 20 else (p / (p + n) if p + n else 0), -i))
        top_at = max(range(len(worth)), key=lambda i: (worth[i][0], worth[i][2]))
        if worth[top_at][1] < min_precision:
            break
        rule = rule[:top_at + 1]
        rules.append(rule)
        left = left.where(~met_all(rule))
    return rules


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, counts..., base_failed, kept)`` of every row of ``docs``.

    Null and empty texts have no words and fail the fixed rules; null and
    repeated ids each give their row; an empty table gives none; other columns
    are not read.
    """
    q = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    stats = store(q.select("doc_id", "__q.*"), "quality-stats")
    rules = learn(stats, labels, sample_rows)
    return stats.withColumns({"base_failed": base_failed(), "kept": verdict(rules)})


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the learned list keeps, columns unchanged.

    Null and empty texts fail the fixed rules and go; repeated rows share their verdict;
    an empty table gives no rows; without labels only the fixed rules hold; columns of
    any name keep their values.
    """
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("__id")).distinct()
    labelled = (docs.select("doc_id", text_of().alias("text"))
                .join(known, F.col("doc_id") == F.col("__id"), "left_semi"))
    rules = learn(with_counts(labelled).select("doc_id", "__q.*"), labels, sample_rows)
    counted = with_counts(sealed(docs, text=text_of())).where(verdict(rules, "__q."))
    return unsealed(counted, docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
