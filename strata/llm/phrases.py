"""Operator 13: phrase collocations from counting quotient filters.

Texts are cut once into chunks of about a million words, held as numbers of the
chunk's own words; the chunks' words, dealt by hash, get their counts in all, the frequent
ones get numbers, and the chunks are rewritten in these.  Phrases are then
counted length by length:

* A phrase is packed as the numbers of its words.  An invertible permutation
  scrambles the packed key; its leading bits are the quotient, all others the
  remainder, which a filter stores in full.  So a filter holds counts without
  loss, in the order of the permuted keys, and a key can be turned back.
* Each chunk counts its phrases into one filter per bucket (leading bits of the
  quotient).  Filters of one bucket are sorted and are merged across chunks,
  in rounds of bounded fan-in where there are many; counts below the least
  count go after the last merge.  Permuted keys spread evenly, so no bucket is hot,
  and a phrase of every document is one entry per chunk.
* A phrase can only be frequent if the two shorter ones inside it are.  These
  are known from the length before by a bit map of fixed size: a wrong hit
  only counts a phrase that the least count then drops.

Scores, and which phrases are part of longer ones, follow by joins.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, store

LEAST = 100
LONGEST = 5
TOP = 2000
CHUNK_WORDS = 1 << 20
SLICE_BYTES = 1 << 20
SLICE = 1 << 16
PACKED_WAYS = 1 << 18
BUCKET_ROWS = 1 << 20  # occurrences per bucket: more than the entries that a merge holds
FAN_BITS = 6  # buckets that a filter is cut into at once, and filters that are merged at once
MAP_BITS = 25
ROUNDS = 3
U = np.uint64

SEPARATOR, NOTHING = 0, 1
#: Lower case for A-Z, pieces end at line feeds, words at spaces.
BYTES = bytes(10 if chr(i) in ".,;:!?\n\x0b\x0c\r" else 32 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))


# ------------------------------------------------------------------- chunks
def _slices(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split(b" ")
        at = end + 1


class Chunk:
    """Texts as numbers of the chunk's own words, in order of appearance."""

    def __init__(self):
        self.number = itertools.count(2)
        self.words: dict[str, defaultdict] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        known = self.words.get(lang)
        if known is None:
            known = self.words[lang] = defaultdict(self.number.__next__, {b"\n": SEPARATOR, b"": NOTHING})
        for words in _slices(b"\n".join(texts).translate(BYTES).replace(b"\n", b" \n ")):
            x = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
            x = x[x != NOTHING]
            self.parts.append(x)
            self.size += len(x)
        self.parts.append(np.zeros(1, np.int32))

    def batches(self, chunk: int) -> Iterator[pa.RecordBatch]:
        x = _without_runs(np.concatenate(self.parts), SEPARATOR)
        counts = np.bincount(x, minlength=2)
        yield _batch([chunk], [None], [None], [None], [None], [_zipped(x)])
        for lang, known in self.words.items():
            words = [w for w in known if w not in (b"\n", b"")]
            at = np.array([known[w] for w in words], np.int32)
            for i in range(0, len(words), 1 << 16):
                some = slice(i, i + (1 << 16))
                m = len(words[some])
                yield _batch([chunk] * m, [lang] * m, words[some], at[some], counts[at[some]], [None] * m)


def _batch(chunk, lang, word, local, n, ids) -> pa.RecordBatch:
    cols = [pa.array(chunk, pa.int64()), pa.array(lang, pa.string()), pa.array(word, pa.binary()).cast(pa.string()),
            pa.array(local, pa.int32()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["chunk", "lang", "word", "local", "n", "ids"])


def _zipped(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unzipped(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _without_runs(x: np.ndarray, mark: int) -> np.ndarray:
    """``x`` with runs of ``mark`` as one."""
    if not len(x):
        return x
    again = np.r_[False, (x[1:] == mark) & (x[:-1] == mark)]
    return x[~again]


def chunks_of(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Per chunk one row with its ``ids`` (of its own words), and one row
    ``(lang, word, local, n)`` per word of it."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = Chunk(), 0
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            of: dict[str, list[int]] = defaultdict(list)
            for i, lang in enumerate(langs):
                of[lang].append(i)
            for lang, at in of.items():
                for s in range(0, len(at), 256):
                    held.add(lang, [t for t in texts.take(pa.array(at[s:s + 256])).to_pylist() if t])
                    if held.size >= chunk_words:
                        yield from held.batches(base + number)
                        held, number = Chunk(), number + 1
        if held.size:
            yield from held.batches(base + number)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(text.alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return store(d.mapInArrow(cut, "chunk long, lang string, word string, local int, n long, ids binary"), "phrase-chunks")


def vocabulary_of(chunks: DataFrame, least: int) -> tuple[DataFrame, dict[int, int], int]:
    """Words that occur ``least`` times or more in a language, and where chunks have them.

    Words are dealt by hash and sorted, so all rows of a word lie side by side: one
    shuffle gives counts, numbers and their way back to the chunks.  Two kinds of rows:
    ``(part, seq, lang, word, f)`` for word number ``seq`` of partition ``part``, and
    ``(part, chunk, data)``, the chunk's own and the new numbers of the words of that
    partition, packed.  Also the number before each partition's first word
    (one small row per partition reaches the driver), and how many words there are.
    """
    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held = TaskContext.get().partitionId(), 0, None
        ways: list[np.ndarray] = []  # (chunk, local, seq) of frequent words
        for pdf in itertools.chain(batches, [None]):  # None ends the last word
            if pdf is not None and held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            last = pdf is None
            pdf = held if last else pdf
            if pdf is None or not len(pdf):
                continue
            lang, word, n = (pdf[c].to_numpy() for c in ("lang", "word", "n"))
            starts = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (lang[1:] != lang[:-1])])
            upto = len(pdf) if last else starts[-1]  # the last word may go on in the next batch
            held = None if last else pdf.iloc[upto:]
            starts = starts[starts < upto]
            if not upto:
                continue
            total = np.add.reduceat(n[:upto], starts)
            often = total >= least
            number = np.where(often, np.cumsum(often) - 1 + seq, -1)
            seq += int(often.sum())
            of = np.repeat(number, np.diff(np.r_[starts, upto]))
            some = pdf.iloc[:upto][of >= 0]
            if len(some):
                ways.append(np.stack([some["chunk"].to_numpy(np.int64), some["local"].to_numpy(np.int64), of[of >= 0]]))
                first = starts[often]
                yield pd.DataFrame({"part": part, "seq": number[often], "lang": lang[first], "word": word[first], "f": total[often],
                                    "chunk": pd.array([None] * len(first), "Int64"), "data": None})
            if sum(w.shape[1] for w in ways) >= PACKED_WAYS:
                yield packed(ways, part)
                ways = []
        if ways:
            yield packed(ways, part)

    def packed(ways: list[np.ndarray], part: int) -> pd.DataFrame:
        chunk, local, seq = np.concatenate(ways, axis=1)
        order = np.argsort(chunk, kind="stable")
        chunk, local, seq = chunk[order], local[order], seq[order]
        starts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
        data = [_zipped(np.concatenate([local[s:e], seq[s:e]])) for s, e in zip(starts, np.r_[starts[1:], len(chunk)])]
        none = pd.array([None] * len(starts), "Int64")
        return pd.DataFrame({"part": part, "seq": none, "lang": None, "word": None, "f": none, "chunk": chunk[starts], "data": data})

    rows = chunks.where("word IS NOT NULL").select("chunk", "local", "lang", "word", "n")
    rows = rows.repartition("lang", "word").sortWithinPartitions("lang", "word")
    rows = store(rows.mapInPandas(pick, "part int, seq long, lang string, word string, f long, chunk long, data binary"), "phrase-words")
    sizes = rows.where("f IS NOT NULL").groupBy("part").count().orderBy("part").collect()
    before, size = {}, 0
    for r in sizes:
        before[r["part"]], size = size, size + r["count"]
    return rows, before, size


def numbered(chunks: DataFrame, words: DataFrame, before: dict[int, int], wide: bool) -> DataFrame:
    """``(chunk, ids)``: the chunks in numbers of the vocabulary; -1 ends a run of its words."""
    kind = np.int64 if wide else np.int32

    def rewrite(key: tuple, body: pd.DataFrame, ways: pd.DataFrame) -> pd.DataFrame:
        out = []
        for raw in body["ids"]:
            x = _unzipped(raw, np.int32)
            to = np.full(int(x.max(initial=0)) + 1, -1, kind)
            for part, data in zip(ways["part"], ways["data"]):
                local, seq = _unzipped(data, np.int64).reshape(2, -1)
                to[local] = seq + before[part]
            out.append((key[0], _zipped(_without_runs(to[x], -1))))
        return pd.DataFrame(out, columns=["chunk", "ids"])

    bodies = chunks.where("ids IS NOT NULL").select("chunk", "ids")
    found = words.where("data IS NOT NULL").select(F.col("chunk").alias("within"), "part", "data")
    return store(bodies.groupBy("chunk").cogroup(found.groupBy("within")).applyInPandas(rewrite, "chunk long, ids binary"), "phrase-ids")


# ------------------------------------------------------ permutation and filters
def _mix(lanes: list[np.ndarray], skip: int, turn: int, bits: int) -> np.ndarray:
    acc = np.full(len(lanes[0]), 0x9E3779B97F4A7C15 * (turn + 1) & (2 ** 64 - 1), U)
    for j, lane in enumerate(lanes):
        if j != skip:
            acc = (acc ^ lane) * U(0xBF58476D1CE4E5B9)
            acc ^= acc >> U(29)
    acc *= U(0x94D049BB133111EB)
    return acc >> U(64 - bits)


def permute(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Scramble keys of some lanes of ``bits`` bits: every lane in turn is
    changed by what the others say, so the steps can be undone."""
    lanes = [x.astype(U) for x in lanes]
    for turn in range(ROUNDS):
        for i in range(len(lanes)):
            lanes[i] = lanes[i] ^ _mix(lanes, i, turn, bits)
    return lanes


def restore(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    lanes = [x.astype(U) for x in lanes]
    for turn in reversed(range(ROUNDS)):
        for i in reversed(range(len(lanes))):
            lanes[i] = lanes[i] ^ _mix(lanes, i, turn, bits)
    return lanes


def pack(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Lanes side by side, as many as fit, in 64-bit limbs: the order of the limbs is that of the lanes."""
    each = 64 // bits
    out = []
    for s in range(0, len(lanes), each):
        limb = np.zeros(len(lanes[0]), U)
        for lane in lanes[s:s + each]:
            limb = (limb << U(bits)) | lane if bits < 64 else lane
        out.append(limb)
    return out


def unpack(limbs: list[np.ndarray], n: int, bits: int) -> list[np.ndarray]:
    each, lanes = 64 // bits, []
    mask = U(2 ** bits - 1)
    for k, limb in enumerate(limbs):
        m = min(each, n - k * each)
        lanes += [(limb >> U(bits * (m - 1 - j))) & mask for j in range(m)]
    return lanes


def summed(limbs: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(counts):
        return limbs, counts
    order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
    limbs = [x[order] for x in limbs]
    new = np.zeros(len(order), bool)
    new[0] = True
    for x in limbs:
        new[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(new)
    return [x[at] for x in limbs], np.add.reduceat(counts[order], at)


class Filter:
    """A counting quotient filter of one bucket, as bytes.

    ``width`` bits of the first limb are known from the bucket's place on; the
    leading ``q`` of them are the quotient.  Stored are, per quotient, how many
    remainders it has (in unary), the remainders and the other limbs in full,
    and counters of one byte, longer ones apart.
    """

    @staticmethod
    def dump(limbs: list[np.ndarray], counts: np.ndarray, width: int, other: list[int]) -> bytes:
        n = len(counts)
        q = min(width, max(n - 1, 0).bit_length())
        first = limbs[0] & U(2 ** width - 1) if width < 64 else limbs[0]
        quotient = (first >> U(width - q)).astype(np.int64) if q else np.zeros(n, np.int64)
        marks = np.zeros(n + (1 << q), np.uint8)
        marks[quotient + np.arange(n)] = 1  # one per remainder, a zero ends each quotient's run
        parts = [np.packbits(marks).tobytes(), _narrow(first, width - q)]
        parts += [_narrow(x, w) for x, w in zip(limbs[1:], other)]
        small = np.minimum(counts, 255).astype(np.uint8)
        parts += [small.tobytes(), counts[counts >= 255].astype("<i8").tobytes()]
        return np.array([n, q, width], "<i8").tobytes() + b"".join(parts)

    @staticmethod
    def load(raw: bytes, place: int, other: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
        n, q, width = (int(v) for v in np.frombuffer(raw, "<i8", 3))
        at = 24
        size = (n + (1 << q) + 7) // 8
        marks = np.unpackbits(np.frombuffer(raw, np.uint8, size, at))[:n + (1 << q)]
        quotient = (np.flatnonzero(marks) - np.arange(n)).astype(U)
        at += size
        limbs = []
        for w in [width - q, *other]:
            size = n * ((w + 7) // 8)
            limbs.append(_widened(raw[at:at + size], n, w))
            at += size
        if q:
            limbs[0] |= quotient << U(width - q)
        if place:
            limbs[0] |= U(place << width)
        small = np.frombuffer(raw, np.uint8, n, at)
        counts = small.astype(np.int64)
        counts[small == 255] = np.frombuffer(raw, "<i8", offset=at + n)
        return limbs, counts


def _narrow(x: np.ndarray, bits: int) -> bytes:
    size = (bits + 7) // 8
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _widened(raw: bytes, n: int, bits: int) -> np.ndarray:
    size = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(n, size)
    return out.view("<u8").ravel().astype(U)


class Shape:
    """How keys of ``length`` words of ``bits`` bits lie in limbs."""

    def __init__(self, length: int, bits: int):
        self.length, self.bits = length, bits
        each = 64 // bits
        self.widths = [bits * min(each, length - s) for s in range(0, length, each)]

    def split(self, limbs: list[np.ndarray], counts: np.ndarray, known: int, more: int) -> Iterator[tuple[int, bytes]]:
        """Sorted keys of which ``known`` leading bits are alike, cut by the next ``more``: ``(bucket, filter)``."""
        width = self.widths[0] - known - more
        bucket = limbs[0] >> U(width) if width < 64 else np.zeros(len(counts), U)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(counts) else []
        for s, e in zip(starts, [*starts[1:], len(counts)]):
            yield int(bucket[s]), Filter.dump([x[s:e] for x in limbs], counts[s:e], width, self.widths[1:])

    def merged(self, bucket: int, raws) -> tuple[list[np.ndarray], np.ndarray]:
        """The filters of a bucket as one."""
        parts = [Filter.load(raw, bucket, self.widths[1:]) for raw in raws]
        limbs = [np.concatenate([p[0][k] for p in parts]) for k in range(len(self.widths))]
        return summed(limbs, np.concatenate([p[1] for p in parts]))


def _position(limbs: list[np.ndarray], map_bits: int) -> np.ndarray:
    h = np.zeros(len(limbs[0]), U)
    for x in limbs:
        h = (h ^ x) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(32)
    return (h * U(0xD6E8FEB86659FD93)) >> U(64 - map_bits)


# ----------------------------------------------------------- counting phrases
def _keys(x: np.ndarray, at: np.ndarray, length: int, bits: int) -> list[np.ndarray]:
    """Permuted keys of the phrases that begin ``at`` some places, in slices that keep the scratch arrays small."""
    parts = [pack(permute([x[at[s:s + SLICE] + j] for j in range(length)], bits), bits) for s in range(0, max(len(at), 1), SLICE)]
    return [np.concatenate(limb) for limb in zip(*parts)]


def _starts(x: np.ndarray, length: int, bits: int, maps: dict, map_bits: int) -> np.ndarray:
    """Where phrases of ``length`` words begin whose shorter phrases may all be frequent."""
    ok = x >= 0
    for m in range(2, length + 1):
        ok = ok[:-1] & ok[1:] if len(ok) else ok
        if m < length:
            at = np.flatnonzero(ok)
            pos = _position(_keys(x, at, m, bits), map_bits).astype(np.int64)
            ok[at] = (maps[m][pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1
    return np.flatnonzero(ok)


def frequent(ids: DataFrame, length: int, bits: int, wide: bool, maps, occurrences: int, chunks: int, least: int,
             bucket_rows: int = BUCKET_ROWS, fan_bits: int = FAN_BITS, map_bits: int = MAP_BITS) -> DataFrame:
    """``(ids, f, pos)`` of the phrases of ``length`` words that occur ``least`` times or more.

    ``occurrences`` bounds how many there are in all; ``pos`` is a phrase's place in the bit map.
    """
    shape = Shape(length, bits)
    kind = np.int64 if wide else np.int32
    need = min(shape.widths[0], max(0, -(-occurrences // bucket_rows) - 1).bit_length())
    known = min(need, fan_bits + 2)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = maps.value
        for pdf in batches:
            for chunk, raw in zip(pdf["chunk"], pdf["ids"]):
                x = _unzipped(raw, kind)
                at = _starts(x, length, bits, held, map_bits)
                limbs, counts = summed(_keys(x, at, length, bits), np.ones(len(at), np.int64))
                rows = list(shape.split(limbs, counts, 0, known))
                if rows:
                    yield pd.DataFrame({"bucket": [r[0] for r in rows], "chunk": chunk, "filter": [r[1] for r in rows]})

    filters = ids.mapInPandas(count, "bucket long, chunk long, filter binary")
    filters = filters.select("bucket", F.pmod(F.xxhash64("chunk"), F.lit(max(chunks, 1))).alias("shard"), "filter")
    def merging(known: int, more: int):
        def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            limbs, counts = shape.merged(int(key[0]), pdf["filter"])
            rows = list(shape.split(limbs, counts, known, more))
            return pd.DataFrame({"bucket": [r[0] for r in rows], "shard": key[1], "filter": [r[1] for r in rows]})

        return merge

    while known < need:
        more = min(fan_bits, need - known)
        filters = store(filters, "phrase-filters")
        filters = (filters.withColumn("shard", F.shiftright("shard", fan_bits)).groupBy("bucket", "shard")
                   .applyInPandas(merging(known, more), "bucket long, shard long, filter binary"))
        known += more

    def last(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        limbs, counts = shape.merged(int(key[0]), pdf["filter"])
        keep = counts >= least
        limbs = [x[keep] for x in limbs]
        words = np.stack(restore(unpack(limbs, length, bits), bits), axis=1).astype(np.int64) if keep.any() else np.zeros((0, length), np.int64)
        return pd.DataFrame({"ids": pd.Series(list(words), dtype=object), "f": counts[keep], "pos": _position(limbs, map_bits).astype(np.int64)})

    return store(filters.groupBy("bucket").applyInPandas(last, "ids array<long>, f long, pos long"), f"phrases-{length}")


def bit_map(phrases: DataFrame, map_bits: int = MAP_BITS) -> np.ndarray:
    """Bit map of 2 ** ``map_bits`` bits (4 MB) with the places of ``phrases`` set."""
    segment = max(map_bits - 6, 3)

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << segment, np.uint8)
        bits[pdf["pos"].to_numpy() & ((1 << segment) - 1)] = 1
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    out = np.zeros(1 << (map_bits - 3), np.uint8)
    rows = phrases.select("pos", F.shiftright("pos", segment).alias("segment")).groupBy("segment").applyInPandas(fill, "segment long, bits binary")
    for r in rows.collect():  # 64 rows at most
        at = r["segment"] << (segment - 3)
        out[at:at + (1 << (segment - 3))] = np.frombuffer(r["bits"], np.uint8)
    return out


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP, cover_percent: int = 100,
                 chunk_words: int = CHUNK_WORDS, bucket_rows: int = BUCKET_ROWS, fan_bits: int = FAN_BITS,
                 map_bits: int = MAP_BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of 2 to ``longest`` words per language.

    ``docs`` needs ``text`` and ``lang``; other columns do not matter.  Null
    texts are empty, a null language is ``und``; repeated rows count each time;
    an empty table, and a language without frequent phrases, give no rows.
    ``top`` None gives all phrases.
    """
    spark = docs.sparkSession
    chunks = chunks_of(docs, chunk_words)
    totals = chunks.where("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    words, before, size = vocabulary_of(chunks, least)
    bits = max(1, max(size - 1, 0).bit_length())
    wide = size >= 1 << 31
    ids = numbered(chunks, words, before, wide)
    first = F.element_at(F.create_map(*[F.lit(v) for kv in before.items() for v in kv]), F.col("part")) if before else F.lit(0)
    vocabulary = store(words.where("f IS NOT NULL").select((F.col("seq") + first).cast("long").alias("id"), "lang", "word", "f"), "phrase-vocabulary")
    occurrences = vocabulary.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    number = ids.count()
    counted = [vocabulary.select(F.array("id").alias("ids"), "f")]
    maps: dict[int, np.ndarray] = {}
    for length in range(2, longest + 1):
        if not occurrences:
            break
        held = spark.sparkContext.broadcast(maps)
        found = frequent(ids, length, bits, wide, held, occurrences, number, least, bucket_rows, fan_bits, map_bits)
        occurrences = found.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
        counted.append(found.select("ids", "f"))
        maps = maps | {length: bit_map(found, map_bits)}
    known = counted[0]
    for part in counted[1:]:
        known = known.union(part)
    return _scored(known, vocabulary, totals, top, cover_percent)


def _scored(known: DataFrame, vocabulary: DataFrame, totals: DataFrame, top: int | None, cover_percent: int) -> DataFrame:
    """Scores of the frequent phrases ``known(ids, f)``, whose parts are among them."""
    size = F.size("ids")
    cand = known.where(size >= 2).select("ids", F.col("f").alias("a"))
    # phrases inside a longer one that is as frequent
    inner = cand.where(size >= 3).select("a", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda s: F.slice("ids", s, m))))).alias("part"))
    inner = inner.groupBy("part").agg(F.max("a").alias("outer_a"))
    cand = (cand.join(inner, F.col("ids") == F.col("part"), "left")
            .where(F.col("outer_a").isNull() | (100 * F.col("outer_a") < cover_percent * F.col("a"))).select("ids", "a"))
    cuts = cand.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.expr("slice(ids, 1, k)").alias("left"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("right"))
    cuts = (cuts.join(known.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
            .join(known.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right"))
    cuts = cuts.join(vocabulary.select(F.col("id").alias("first"), "lang"), F.get("ids", F.lit(0)) == F.col("first")).join(totals, "lang")
    score = F.expr("(CAST(1000 * a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spelt = (best.select("lang", "ids", "a", "n", "cut", F.posexplode("ids").alias("at", "id"))
             .join(vocabulary.select("id", "word"), "id").groupBy("lang", "ids", "a", "n", "cut")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    out = spelt.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("rank", F.row_number().over(w))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS pos
        FROM split, (VALUES (1), (2), (3), (4), (5)) AS sizes(size) WHERE len(w) >= size)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2),
inner_parts AS (
  SELECT lang, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS phrase, max(a) AS outer_a
  FROM (SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS pos FROM cand, (VALUES (2), (3), (4)) AS ms(m) WHERE m < size)
  GROUP BY 1, 2),
kept AS (SELECT c.* FROM cand c LEFT JOIN inner_parts i USING (lang, phrase) WHERE i.outer_a IS NULL OR 100 * i.outer_a < 100 * c.a),
cuts AS (SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS lp, array_to_string(list_slice(w, k + 1, size), ' ') AS rp
         FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.lp JOIN counts y ON y.lang = c.lang AND y.phrase = c.rp
  JOIN total t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
