"""Operator 13: phrases against counting by brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import phrases


def brute(rows, least, top, longest=5):
    upper = {i: i + 32 for i in range(65, 91)}
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            gone |= {(lang, p[i:i + m]) for i in range(len(p) - m + 1) if 100 * a >= 100 * f[lang, p[i:i + m]]}
    out = []
    for lang in n:
        rank = []
        for (g, p), a in cand.items():
            if g == lang and (g, p) not in gone:
                score, k = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p)))
                rank.append((-score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rank)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(seed=3, docs=300):
    rng = random.Random(seed)
    words = "the of And river STONE over light été 日本 x\x01y a\xa0b winter paper".split(" ")
    fixed = ["new york city hall", "over the river and", "stone. light", "winter paper winter paper winter"]
    out = []
    for _ in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        out.append((rng.choice([" ", " ", "\t", " , ", "\n"]).join(parts), rng.choice(["en", "en", "en", "de", None, "und"])))
    out += [(None, "en"), (None, None), ("", "fr"), (" \t\n", "fr"), ("!!!", "xx"), ("Same same " * 3000, "en"), out[0], out[0]]
    return out


@pytest.mark.parametrize("least, top, options", [
    (5, 2000, {}), (2, 15, dict(chunk_words=200, bucket_rows=64, fan_bits=2, map_bits=8)), (100, 2000, dict(chunk_words=1000, bucket_rows=500, fan_bits=3))])
def test_phrases_against_brute_force(spark, least, top, options):
    rows = corpus()
    docs = spark.createDataFrame([(i, *r, "f", "n") for i, r in enumerate(rows)], "doc_id long, text string, lang string, f string, `a.b` string").repartition(5)
    got = sorted(map(tuple, phrases.collocations(docs, least=least, top=top, **options).collect()))
    want = brute(rows, least, top)
    assert got == want and want


def test_empty_and_without_phrases(spark):
    schema = "text string, lang string"
    assert phrases.collocations(spark.createDataFrame([], schema)).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a b c", "en"), (None, None)], schema)).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a " * 500, "en")], schema)).count() > 0


@pytest.mark.parametrize("length", [2, 3, 4, 5])
@pytest.mark.parametrize("bits", [1, 7, 15, 21, 31, 33, 40])
def test_filters_lose_nothing(length, bits):
    rng = np.random.default_rng(length * 100 + bits)
    lanes = [rng.integers(0, 2 ** bits, 5000).astype(np.uint64) for _ in range(length)]
    limbs = phrases.pack(phrases.permute(lanes, bits), bits)
    back = phrases.restore(phrases.unpack(limbs, length, bits), bits)
    assert all((a == b).all() for a, b in zip(lanes, back))
    shape = phrases.Shape(length, bits)
    counts = rng.integers(1, 1000, 5000)
    keys, sums = phrases.summed(limbs, counts)
    want = Counter()
    for k, c in zip(zip(*[x.tolist() for x in lanes]), counts.tolist()):
        want[k] += c
    found = Counter()
    known = min(3, shape.widths[0])
    for bucket, raw in shape.split(keys, sums, 0, known):
        some, c = shape.merged(bucket, [raw, raw])
        words = phrases.restore(phrases.unpack(some, length, bits), bits)
        assert (np.asarray(some[0][1:]) >= some[0][:-1]).all()
        for k, v in zip(zip(*[x.tolist() for x in words]), c.tolist()):
            found[k] += v
    assert found == Counter({k: 2 * v for k, v in want.items()})


def test_pieces_longer_than_a_slice(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 7)
    chunk = phrases.Chunk()
    chunk.add("en", ["one two, three four five".encode(), b"ONE\ttwo"])
    x = np.concatenate(chunk.parts).tolist()
    names = {v: k.decode() for k, v in chunk.words["en"].items()}
    assert [names[i] for i in x] == ["one", "two", "\n", "three", "four", "five", "\n", "one", "two", "\n"]
