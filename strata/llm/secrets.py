"""Operator 4: secret scans through a trigram inverted index.

Each rule's regular expression is parsed and turned into a Boolean query over
case-folded trigrams that every match must satisfy (what a string set before,
after or across a concatenation makes mandatory).  Texts are indexed in blocks
(one Arrow batch, so no shuffle and bounded memory): postings of the trigrams
that occur in some query are intersected and united per rule, and only the
candidates are verified with the expression itself.  Rules that lack mandatory
trigrams scan every text of the block.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser as P

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_of


@dataclass(frozen=True)
class Rule:
    """``least``: fewest code points of ``group`` (0: the match); other matches drop."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ["password", "passwd", "secret", "token"])) + "|" + \
    _either_case("api") + "_?" + _either_case("key")

#: Fixed values of the contract: kinds, expressions, least lengths.
BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Kinds that the scan adds to the base.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)

# ---------------------------------------------------------------- queries
ALL = ("all",)
MOST_STRINGS = 64


def _and(*qs):
    qs = [q for q in qs if q != ALL]
    flat = [p for q in qs for p in (q[1] if q[0] == "and" else [q])]
    flat = list(dict.fromkeys(flat))
    return ALL if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _or(*qs):
    qs = list(dict.fromkeys(qs))
    return ALL if not qs or ALL in qs else qs[0] if len(qs) == 1 else ("or", tuple(qs))


def _needs(strings: Iterable[str]):
    """The query that one of the strings puts on a text that holds it."""
    return _or(*[_and(*[("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in sorted(strings)])


@dataclass(frozen=True)
class _Info:
    """What is known of an expression's matches: the strings themselves if few,
    else sets of possible beginnings and ends, and a query for what is inside."""

    exact: frozenset | None
    begin: frozenset
    end: frozenset
    query: tuple = ALL


_EMPTY = frozenset([""])
_ANY = _Info(None, _EMPTY, _EMPTY)


def _tidy(x: _Info) -> _Info:
    """Gives up strings that are too many, keeping what they make mandatory."""
    query, exact, begin, end = x.query, x.exact, x.begin, x.end
    if exact is not None and len(exact) > MOST_STRINGS:
        query, begin, end, exact = _and(query, _needs(exact)), exact, exact, None
    if exact is None:
        if len(begin) > MOST_STRINGS or max(map(len, begin)) > 3:
            query, begin = _and(query, _needs(begin)), frozenset(s[:3] for s in begin)
        if len(end) > MOST_STRINGS or max(map(len, end)) > 3:
            query, end = _and(query, _needs(end)), frozenset(s[-3:] for s in end)
        begin = begin if len(begin) <= MOST_STRINGS else _EMPTY
        end = end if len(end) <= MOST_STRINGS else _EMPTY
    return _Info(exact, begin, end, query)


def _cross(a: frozenset, b: frozenset) -> frozenset:
    return frozenset(x + y for x in a for y in b)


def _then(a: _Info, b: _Info) -> _Info:
    query = _and(a.query, b.query)
    if a.exact is not None and b.exact is not None:
        return _tidy(_Info(_cross(a.exact, b.exact), _EMPTY, _EMPTY, query))
    a_end = a.exact if a.exact is not None else a.end
    b_begin = b.exact if b.exact is not None else b.begin
    middle = _cross(a_end, b_begin) if len(a_end) * len(b_begin) <= MOST_STRINGS ** 2 else _EMPTY
    begin = _cross(a.exact, b.begin) if a.exact is not None else a.begin
    end = _cross(a.end, b.exact) if b.exact is not None else b.end
    return _tidy(_Info(None, begin, end, _and(query, _needs(middle))))


def _either(a: _Info, b: _Info) -> _Info:
    if a.exact is not None and b.exact is not None and a.query == b.query:
        return _tidy(_Info(a.exact | b.exact, _EMPTY, _EMPTY, a.query))
    full = [_Info(None, x.exact, x.exact, _and(x.query, _needs(x.exact))) if x.exact is not None else x for x in (a, b)]
    return _tidy(_Info(None, full[0].begin | full[1].begin, full[0].end | full[1].end,
                       _or(full[0].query, full[1].query)))


def _class(items) -> frozenset | None:
    chars: set[int] = set()
    for op, arg in items:
        if op is C.LITERAL:
            chars.add(arg)
        elif op is C.RANGE and arg[1] - arg[0] < MOST_STRINGS:
            chars |= set(range(arg[0], arg[1] + 1))
        else:
            return None
    folded = frozenset(fold(chr(c)) for c in chars)
    return folded if len(folded) <= 8 else None


def _info(tree) -> _Info:
    out = _Info(_EMPTY, _EMPTY, _EMPTY)
    for op, arg in tree:
        if op is C.LITERAL:
            x = _Info(frozenset([fold(chr(arg))]), _EMPTY, _EMPTY)
        elif op is C.IN:
            chars = _class(arg)
            x = _Info(chars, _EMPTY, _EMPTY) if chars else _ANY
        elif op is C.SUBPATTERN:
            x = _info(arg[3])
        elif op is C.BRANCH:
            x = _info(arg[1][0])
            for branch in arg[1][1:]:
                x = _either(x, _info(branch))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, inner = arg
            one = _info(inner)
            if low == 0:
                x = _either(one, _Info(_EMPTY, _EMPTY, _EMPTY)) if high == 1 and one.exact is not None else _ANY
            elif low == high == 1:
                x = one
            else:  # once at least, on both ends
                ends = one.exact if one.exact is not None else None
                x = _tidy(_Info(None, ends if ends is not None else one.begin, ends if ends is not None else one.end, one.query))
        elif op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            x = _Info(_EMPTY, _EMPTY, _EMPTY)
        else:
            x = _ANY
        out = _then(out, x)
    return out


_FOLD = {i: i + 32 for i in range(65, 91)}


def fold(s: str) -> str:
    """ASCII letters in lower case; every other character, and all offsets, stay."""
    return s.lower() if s.isascii() else s.translate(_FOLD)


def trigram_query(pattern: str) -> tuple:
    """The Boolean query over folded trigrams that every text with a match
    satisfies; ``("all",)`` where the expression has no mandatory trigram."""
    x = _info(P.parse(pattern))
    ends = _needs(x.exact) if x.exact is not None else _and(_needs(x.begin), _needs(x.end))
    return _and(x.query, ends)


def trigrams_of(query: tuple) -> set[str]:
    if query[0] == "tri":
        return {query[1]}
    return set().union(*[trigrams_of(q) for q in query[1]]) if query != ALL else set()


class TrigramIndex:
    """Postings (ascending positions) of the given trigrams over a block of texts."""

    def __init__(self, texts: list[str], trigrams: Iterable[str]):
        self.n = len(texts)
        hits: dict[str, list[int]] = {t: [] for t in trigrams}
        for i, text in enumerate(texts):
            folded = fold(text)
            for t, posting in hits.items():
                if t in folded:
                    posting.append(i)
        self.postings = {t: np.array(p, dtype=np.int64) for t, p in hits.items()}

    def candidates(self, query: tuple) -> np.ndarray:
        kind = query[0]
        if kind == "all":
            return np.arange(self.n)
        if kind == "tri":
            return self.postings[query[1]]
        parts = sorted((self.candidates(q) for q in query[1]), key=len)
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if kind == "and" else np.union1d(out, p)
        return out


# ------------------------------------------------------------------- scan
class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.trigrams = set().union(*map(trigrams_of, self.queries))
        self.checks = [re.compile(self._bounded(r)) for r in rules]

    @staticmethod
    def _bounded(r: Rule) -> str:
        """A single greedy run of one class is as long as it can be, so its
        least length may stand in the expression itself."""
        tree = list(P.parse(r.pattern))
        if r.group == 0 and r.least and len(tree) == 1 and tree[0][0] is C.MAX_REPEAT and r.pattern.endswith("]+") \
                and tree[0][1][2][0][0] is C.IN:
            return r.pattern[:-1] + "{%d,}" % r.least
        return r.pattern

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text the spans ``(start, rule number, end)``, in that order."""
        index = TrigramIndex(texts, self.trigrams)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, query, check) in enumerate(zip(self.rules, self.queries, self.checks)):
            for i in index.candidates(query):
                for m in check.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), k, m.end()))
        for spans in out:
            spans.sort()
        return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, n_base: int = len(BASE_RULES)) -> DataFrame:
    """``(doc_id, spans, base)``: per row the secrets found, as an array of
    ``(kind, start, end)`` ordered by start, then rule; base counts the spans
    of each of the first ``n_base`` rules.

    Offsets are code points, end exclusive; matches of one rule do not overlap,
    those of different rules may.  Null and empty texts have no spans; null and
    repeated ids each give their row; an empty table gives none; other columns
    are not read.
    """
    kinds = [r.name for r in rules]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(rules)
        for pdf in batches:
            found = scanner.spans(pdf["text"].tolist())
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"),
                "spans": [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in s] for s in found],
                "base": [[sum(k == j for _, k, _ in s) for j in range(n_base)] for s in found]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>, base array<long>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    base_kinds = [r.name for r in BASE_RULES]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(base_kinds))
    return found.select("doc_id", *[F.col("base")[i].alias(f"n_{k}") for i, k in enumerate(base_kinds)],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
