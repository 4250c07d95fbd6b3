"""Operator 9: removal of repeated byte strings by merged Burrows-Wheeler transforms.

A string of ``length`` bytes is removed from a document if it also starts in a
document of smaller id.  Equal strings have equal minimizers (the least hash of
their ``KMER``-byte substrings), so a run of strings with one minimizer is dealt
by it, and runs whose minimizer occurs in one document only are set aside.

What is left meets by minimizer.  Equal runs are one string there.  Where runs
differ, they are dealt into shards, each shard's suffixes are sorted and its
Burrows-Wheeler transform is taken, and the transforms are merged by iterative
interleave refinement (Holt and McMillan): every round moves the interleave of
the shards one symbol further, by one stable counting sort, and splits the
intervals of equal prefixes.  After ``length`` rounds the intervals are the
repeated strings, without sorting the suffixes of all shards together; the
least document of each interval decides.

All exchanges carry packed arrays in blocks of bounded size.  A minimizer that
occurs twice in one block is known to repeat, so its runs do not travel to be
counted: a frequent passage sends one record per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, store, text_of

LENGTH = 50
KMER = 20
MAX_RUN = 256
PIECE = 1 << 20
GROUP_BYTES = 8 << 20
SHARD_BYTES = 1 << 15
MERGE_BYTES = 1 << 18
NO_ID = np.iinfo(np.int64).max
MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------- minimizers
def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_BYTE_HASH = _mix(np.arange(1, 257, dtype=np.uint64) * MIX)


def _spread(h: np.ndarray, size: int, join) -> np.ndarray:
    """``join`` over every ``size`` neighbours, by doubling."""
    parts, done, out = h, 1, None
    at = 0
    while True:
        if size & done:
            out = parts if out is None else join(out[:len(out) - done], parts[at:at + len(out) - done], done)
            at += done
            if at == size:
                return out
        parts = join(parts[:-done], parts[done:], done)
        done *= 2


def minimizers(data: np.ndarray, length: int, kmer: int) -> np.ndarray:
    """Per string of ``length`` bytes the least hash of its substrings of ``kmer``."""
    def chain(a, b, n):
        return a * (MIX ** np.uint64(n) | np.uint64(1)) + b
    with np.errstate(over="ignore"):
        h = _mix(_spread(_BYTE_HASH[data], kmer, chain))
        m = _spread(h, length - kmer + 1, lambda a, b, n: np.minimum(a, b))
        return _mix(m * MIX)


def runs_of(text: bytes, length: int, kmer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(minimizer, start, strings)``: runs of neighbouring strings of one minimizer."""
    data, out = np.frombuffer(text, np.uint8), []
    for at in range(0, len(data) - length + 1, PIECE):  # bounded memory for very long texts
        m = minimizers(data[at:at + PIECE + length - 1], length, kmer)
        i = np.arange(len(m))
        new = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        since = i - np.repeat(new, np.diff(np.r_[new, len(m)]))
        cut = np.flatnonzero(since % MAX_RUN == 0)
        out.append((m[cut], cut + at, np.diff(np.r_[cut, len(m)])))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


# ---------------------------------------------------------------- packing
def _pack(*arrays: np.ndarray) -> bytes:
    raw = np.array([len(arrays[0])], "<u8").tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 8, []
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _delta(x: np.ndarray) -> np.ndarray:
    """Differences, for compression; wraps around, as does ``_sum``."""
    with np.errstate(over="ignore"):
        return np.diff(x, prepend=np.int64(0)) if len(x) else x


def _sum(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(x, dtype=np.int64)


def group_of(row: np.ndarray, groups: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(row.view(np.uint64) * MIX) % np.uint64(groups)).astype(np.int32)


def _split(key: np.ndarray, *arrays: np.ndarray):
    """``(key, arrays)`` of each value of ``key``, order kept."""
    order = np.argsort(key, kind="stable")
    key, arrays = key[order], [a[order] for a in arrays]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else []
    for a, b in zip(cut, [*cut[1:], len(key)]):
        yield int(key[a]), [x[a:b] for x in arrays]


def _spans(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether the rows of equal (sorted) keys differ, per entry."""
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    differ = np.maximum.reduceat(row, cut) != np.minimum.reduceat(row, cut)
    return np.repeat(differ, np.diff(np.r_[cut, len(key)]))


# ------------------------------------------------- transforms and merging
FIRST = 7  # symbols ranked at once


def suffix_order(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and for its rows the first ``FIRST``
    symbols as a number and whether a string ends in them; ``data`` has bytes as 1 to 256 and 0 at
    the end of every string (at ``ends``), which differs from every other end."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(FIRST, data.dtype)])
    key = np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    for k in range(FIRST):  # nothing behind a string's end counts
        symbol = padded[k:k + n]
        key = key * 512 + np.where(open_, symbol, 0)
        open_ &= symbol > 0
    # suffixes that reach their end are told apart by the string's number
    reach = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n)
    first, ends_in = key, reach < FIRST
    order = np.argsort(key, kind="stable")  # strings stand by their number
    short = ends_in[order]
    new = np.r_[False, (key[order][1:] != key[order][:-1]) | short[1:]]
    rank = np.empty(n, np.int64)
    rank[order] = new.cumsum()
    step = FIRST
    while rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)  # equal ones get one rank in any order
        sorted_ = key[order]
        rank[order] = np.r_[False, sorted_[1:] != sorted_[:-1]].cumsum()
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, first[order], ends_in[order]


class Shard:
    """Strings, their suffix order and transform; 0 in the transform stands for
    a string's beginning, bytes are 1 to 255 (255 itself is no byte of UTF-8)."""

    def __init__(self, strings: list[bytes], first: int):
        sizes = np.array([len(s) + 1 for s in strings])
        ends = np.cumsum(sizes) - 1
        data = np.frombuffer(b"\xff".join([*strings, b""]), np.uint8) + np.uint8(1)  # 0 at the ends
        order, self.first, self.ends_in = suffix_order(data, ends)
        self.bwt = data[order - 1]  # 0 before a string's beginning
        self.ends = len(strings)
        # where a row goes when the symbol before it is put in front; 0: nowhere
        sorted_ = np.argsort(self.bwt, kind="stable")[self.ends:]
        self.front = np.zeros(len(data), np.int32)
        self.front[sorted_] = np.arange(self.ends, len(data))
        owner = np.repeat(np.arange(len(strings), dtype=np.int32), sizes)[order]
        self.string = owner + first
        self.offset = (order - (ends - sizes + 1)[owner]).astype(np.int32)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave refinement of all shards to ``depth`` symbols: the merged rows
    whose first ``depth`` symbols occur more than once, as string, offset and
    the number of their interval of equal prefixes.

    A round puts the symbol before each row in front of it: one stable sort by
    that symbol is the next interleave, and two rows stay in one interval if
    their symbols and their intervals were equal.  A row alone in its interval
    stays alone whatever is put in front, so it leaves the rounds.  One with too
    few symbols before it to come to ``depth`` takes no part in them.
    """
    sizes = np.array([len(s.bwt) for s in shards])
    base = np.cumsum(sizes) - sizes
    bwt = np.concatenate([s.bwt for s in shards])
    front = np.concatenate([s.front + b for s, b in zip(shards, base)])
    rows = np.arange(len(bwt))  # at first the shards stand one behind the other
    new, known = np.arange(len(bwt)) == 0, 0
    if depth >= FIRST:  # the first symbols of the shards' sorted rows merge at once
        rows = np.flatnonzero(np.concatenate([~s.ends_in & (s.offset >= depth - FIRST) for s in shards]))
        key = np.concatenate([s.first for s in shards])[rows]
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]][:len(rows)]
        known = FIRST
    for step in range(known, depth + 1):
        alone = new & np.r_[new[1:], True]
        interval = np.cumsum(new)[~alone]
        rows = rows[~alone]
        if step == depth or not len(rows):
            break
        symbol = np.take(bwt, rows)
        order = np.argsort(symbol, kind="stable")[np.count_nonzero(symbol == 0):]
        was, symbol = np.take(interval, order), np.take(symbol, order)
        new = np.ones(len(order), bool)
        np.logical_or(symbol[1:] != symbol[:-1], was[1:] != was[:-1], out=new[1:])
        rows = np.take(front, np.take(rows, order))  # a shard's rows keep their order
        if not len(rows):
            interval = np.zeros(0, np.int64)
            break
    string = np.concatenate([s.string for s in shards])[rows]
    offset = np.concatenate([s.offset for s in shards])[rows]
    return string, offset, interval


def least_documents(strings: list[bytes], least: np.ndarray, length: int, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """Per string and offset the least document (``least`` per string) of the
    ``length`` bytes there, over all strings."""
    shards, held, size, first = [], [], 0, 0
    for i, s in enumerate(strings):
        held.append(s)
        size += len(s)
        if size >= shard_bytes or i + 1 == len(strings):
            shards.append(Shard(held, first))
            held, size, first = [], 0, i + 1
    string, offset, interval = merge(shards, length)
    sizes = np.array([len(s) for s in strings])
    flat, begin = np.repeat(least, sizes), np.cumsum(sizes) - sizes  # what occurs once has its own
    if len(interval):
        cut = np.flatnonzero(np.r_[True, interval[1:] != interval[:-1]])
        low = np.minimum.reduceat(least[string], cut)
        flat[begin[string] + offset] = np.repeat(low, np.diff(np.r_[cut, len(interval)]))
    return [flat[b:b + max(0, n - length + 1)] for b, n in zip(begin, sizes)]


def batches_of(groups: list[list], size: int) -> Iterator[list]:
    """Whole groups of strings together, about ``size`` bytes at a time (a
    merge of that size stays in the processor's cache)."""
    held, n = [], 0
    for group in groups:
        held += group
        n += sum(len(s) for _, s in group)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


# ------------------------------------------------------------------ stages
def _documents(docs: DataFrame) -> DataFrame:
    id_ = F.col("doc_id").cast("long")
    return docs.select(id_.alias("doc_id"), F.coalesce(id_, F.xxhash64(text_of())).alias("row"), text_of().alias("text"))


def _first_runs(d: DataFrame, groups: int, length: int, kmer: int) -> DataFrame:
    """Per block and bucket: runs to be counted (kind 0), and runs known to
    repeat within the block (kind 1, by document group)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(runs_of(t.encode("utf-8", "replace"), length, kmer), r) for t, r in zip(pdf["text"], pdf["row"])]
            m = np.concatenate([g[0] for g, _ in got])
            if not len(m):
                continue
            start, size = (np.concatenate([g[i] for g, _ in got]).astype(np.int64) for i in (1, 2))
            row = np.repeat(pdf["row"].to_numpy(np.int64), [len(g[0]) for g, _ in got])
            order = np.argsort(m, kind="stable")
            known = np.empty(len(m), bool)
            known[order] = _spans(m[order], row[order])
            first = np.zeros(len(m), bool)
            first[order[np.flatnonzero(np.r_[True, m[order][1:] != m[order][:-1]])]] = True
            bucket = ((m >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)
            low = (m & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            out = []
            sent = ~known | first
            for b, (h, r, s, n, k) in _split(bucket[sent], low[sent], row[sent], start[sent], size[sent], known[sent]):
                out.append((b, 0, _pack(h, _delta(r), s.astype(np.uint32), n.astype(np.uint16), k)))
            for g, (h, b, r, s, n) in _split(group_of(row[known], groups), low[known], bucket[known], row[known], start[known], size[known]):
                out.append((g, 1, _pack(h, b.astype(np.uint32), _delta(r), s.astype(np.uint32), n.astype(np.uint16))))
            yield pd.DataFrame(out, columns=["group", "kind", "data"])
    return d.select("row", "text").mapInPandas(run, "group int, kind int, data binary")


RUN_TYPES = ("<u4", "<u4", "<i8", "<u4", "<u2")


def _repeating(first: DataFrame, groups: int) -> DataFrame:
    """Runs whose minimizer occurs in several documents, by document group."""
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(g, x) for g, k, x in zip(pdf["group"], pdf["kind"], pdf["data"]) if k == 1]
        parts = [_unpack(x, "<u4", "<i8", "<u4", "<u2", "?") for k, x in zip(pdf["kind"], pdf["data"]) if k == 0]
        if parts:
            bucket = int(pdf["group"].iloc[0])
            h = np.concatenate([p[0] for p in parts])
            row = np.concatenate([_sum(p[1]) for p in parts])
            start, size, known = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
            order = np.argsort(h, kind="stable")
            h, row, start, size, known = (x[order] for x in (h, row, start, size, known))
            cut = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            some = np.repeat(np.maximum.reduceat(known.astype(np.int8), cut) > 0, np.diff(np.r_[cut, len(h)]))
            hit = (_spans(h, row) | some) & ~known
            for g, (r, s, n, x) in _split(group_of(row[hit], groups), row[hit], start[hit], size[hit], h[hit]):
                by = np.lexsort((s, r))  # text order: overlapping runs compress well
                out.append((g, _pack(x[by], np.full(len(by), bucket, np.uint32), _delta(r[by]), s[by], n[by])))
        return pd.DataFrame(out, columns=["group", "data"])
    return first.groupBy("group").applyInPandas(count, "group int, data binary")


def _occurrences(docs: pd.DataFrame, blobs: list[bytes], length: int):
    """``(minimizer, bucket, document number, start, string)`` of the runs."""
    if not len(blobs) or not len(docs):
        return
    parts = [_unpack(b, *RUN_TYPES) for b in blobs]
    h, bucket = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    row = np.concatenate([_sum(p[2]) for p in parts])
    start, size = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (3, 4))
    order = np.lexsort((start, row))
    rows = row[order]
    for at, (text, key) in enumerate(zip(docs["bytes"], docs["row"])):
        for i in order[np.searchsorted(rows, key, "left"):np.searchsorted(rows, key, "right")]:
            a, n = int(start[i]), int(size[i])
            s = text[a:a + n + length - 1]
            if len(s) >= length:
                yield int(h[i]), int(bucket[i]), at, a, s


def _ids(docs: pd.DataFrame) -> np.ndarray:
    return docs["doc_id"].astype("Int64").fillna(NO_ID).to_numpy(np.int64)


def _strings(d: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Per document group and bucket the different strings of its runs, with
    the least and greatest document that has them."""
    def gather(docs: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        docs = docs.assign(bytes=[t.encode("utf-8", "replace") for t in docs["text"]])
        ids, held = _ids(docs), {}
        for h, b, at, _, s in _occurrences(docs, got["data"].tolist(), length):
            one = held.setdefault(b, {})
            low, high = one.get((h, s), (NO_ID, -NO_ID))
            one[h, s] = min(low, ids[at]), max(high, ids[at])
        out = []
        group = int(got["group"].iloc[0]) if len(got) else -1
        for b, one in held.items():
            out.append((b, group, _pack(np.array([k[0] for k in one], "<u4"), np.array([len(k[1]) for k in one], "<u4"),
                                        np.array([v[0] for v in one.values()], "<i8"), np.array([v[1] for v in one.values()], "<i8")),
                        zstandard.ZstdCompressor(level=1).compress(b"".join(k[1] for k in one))))
        return pd.DataFrame(out, columns=["bucket", "group", "data", "text"])
    return d.groupBy("group").cogroup(runs.groupBy("group")).applyInPandas(
        gather, "bucket int, group int, data binary, text binary")


def _key(s: bytes) -> bytes:
    return xxhash.xxh3_128_digest(s)


def _cuts(owner: np.ndarray, per: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """``(owner, from, to, value)`` of the stretches of one value of the arrays ``per`` (none of them empty)."""
    flat, sizes = np.concatenate(per), np.array([len(x) for x in per])
    begin = np.cumsum(sizes) - sizes
    new = np.r_[True, flat[1:] != flat[:-1]]
    new[begin] = True
    at = np.flatnonzero(new)
    which = np.searchsorted(begin, at, "right") - 1
    return owner[which], at - begin[which], np.r_[at[1:], len(flat)] - begin[which], flat[at]


def _verdicts(strings: DataFrame, length: int) -> DataFrame:
    """Per document group: strings that lose something there, as (key, from,
    to, least document) of the offsets with one least document."""
    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        number: dict[tuple[int, bytes], int] = {}
        users = []
        for g, blob, text in zip(pdf["group"], pdf["data"], pdf["text"]):
            h, size, low, high = _unpack(blob, "<u4", "<u4", "<i8", "<i8")
            text, ends = zstandard.ZstdDecompressor().decompress(text), np.cumsum(size).tolist()
            which = [number.setdefault((x, text[a:b]), len(number)) for x, a, b in zip(h.tolist(), [0, *ends], ends)]
            users.append((np.array(which, np.int64), np.full(len(which), g, np.int32), low, high))
        which, group, low, high = (np.concatenate(x) for x in zip(*users))
        strings = list(number)
        least = np.full(len(strings), NO_ID)
        np.minimum.at(least, which, low)
        same: dict[int, list[int]] = {}
        for i, (h, _) in enumerate(strings):
            same.setdefault(h, []).append(i)
        # the only string of its minimizer has one least document throughout
        only = np.array([ii[0] for ii in same.values() if len(ii) == 1], np.int64)
        cuts = [(only, np.zeros(len(only), np.int64), np.array([len(strings[i][1]) - length + 1 for i in only.tolist()], np.int64), least[only])]
        # strings of different minimizers share nothing: they need not meet
        for some in batches_of([[(i, strings[i][1]) for i in ii] for ii in same.values() if len(ii) > 1], MERGE_BYTES):
            at = np.array([i for i, _ in some], np.int64)
            cuts.append(_cuts(at, least_documents([s for _, s in some], least[at], length)))
        owner, start, end, lows = (np.concatenate(x) for x in zip(*cuts))
        order = np.argsort(owner, kind="stable")
        start, end, lows = start[order], end[order], lows[order]
        n = np.bincount(owner, minlength=len(strings))  # a string's cuts stand together
        first = np.cumsum(n) - n
        floor = np.minimum.reduceat(lows, first) if len(lows) else lows
        hit = np.flatnonzero(floor[which] < high)
        each = n[which[hit]]
        by = np.repeat(hit, each)
        cut = np.repeat(first[which[hit]] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        some = lows[cut] < high[by]
        by, cut = by[some], cut[some]
        key: dict[int, bytes] = {i: _key(strings[i][1]) for i in np.unique(which[by]).tolist()}
        keys = np.array([key[i] for i in which[by].tolist()], "V16")
        rows = [(g, _pack(*x)) for g, x in _split(group[by], keys, start[cut].astype(np.uint32), end[cut].astype(np.uint32), lows[cut])]
        return pd.DataFrame(rows, columns=["group", "data"])
    return strings.groupBy("bucket").applyInPandas(judge, "group int, data binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, kmer: int = KMER, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` per row: the removed byte ranges
    (from, to; maximal) and the remaining bytes.

    Null and empty texts keep no bytes.  Null ids come after all others and
    rows of one id, or without any, take nothing from each other.  An empty
    table gives no rows; other columns are not read.
    """
    d = _documents(docs)
    total = d.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    groups = max(1, math.ceil(total / group_bytes))  # grows with the corpus; results do not depend on it

    @F.pandas_udf("int")
    def group(row: pd.Series) -> pd.Series:
        return pd.Series(group_of(row.to_numpy(np.int64), groups))

    grouped = d.withColumn("group", group("row"))
    runs = store(_repeating(_first_runs(d, groups, length, kmer), groups), "repeat-runs")
    # in one plan with the cut below, so both use one exchange of the texts
    lost = _verdicts(_strings(grouped, runs, length), length)

    def cut(docs: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        docs = docs.assign(bytes=[t.encode("utf-8", "replace") for t in docs["text"]])
        ids, rule = _ids(docs), {}
        for blob in got["data"][got["kind"] == 1]:
            key, a, b, low = _unpack(blob, "V16", "<u4", "<u4", "<i8")
            for k, *x in zip(key.tolist(), a.tolist(), b.tolist(), low.tolist()):
                rule.setdefault(bytes(k), []).append(x)
        gone: dict[int, list] = {}
        if rule:
            for _, _, at, start, s in _occurrences(docs, got["data"][got["kind"] == 0].tolist(), length):
                for a, b, low in rule.get(_key(s), ()):
                    if low < ids[at]:
                        gone.setdefault(at, []).append((start + a, start + b + length - 1))
        spans, kept = [], []
        for at, text in enumerate(docs["bytes"]):
            own, rest, end = [], [], 0
            for a, b in sorted(gone.get(at, ())):
                if own and a <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], b)
                else:
                    own.append([a, b])
            for a, b in own:
                rest.append(text[end:a])
                end = b
            spans.append([{"from": a, "to": b} for a, b in own])
            kept.append(b"".join([*rest, text[end:]]))
        return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "n_bytes": [len(t) for t in docs["bytes"]], "spans": spans, "kept": kept})

    side = runs.withColumn("kind", F.lit(0)).union(lost.withColumn("kind", F.lit(1)))
    return grouped.groupBy("group").cogroup(side.groupBy("group")).applyInPandas(
        cut, "doc_id long, n_bytes long, spans array<struct<from:long,to:long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
