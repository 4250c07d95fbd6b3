"""Operators 3, 6, 8 and 9 against brute force."""

import math

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strata.llm import embedding_dedup, graph, line_dedup, repeats, simhash

from . import cases


# --------------------------------------------------------------- components
def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(501, 560)] + [(700, 700), (None, 3), (801, 800), (800, 801)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for n, r in got.items():
        groups.setdefault(r, set()).add(n)
    assert sorted(map(len, groups.values())) == [2, 60, 61]
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ simhash
def brute_fingerprint(text):
    w = [x.encode() for x in cases.words((text or ""))]
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in w]
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_classes(spark):
    rows = cases.rows()
    fps = [brute_fingerprint(r[1]) for r in rows]
    label = cases.classes(len(rows), cases.near(fps, 3))
    least = {}
    for c, r in zip(label, rows):
        if r[0] is not None:
            least[c] = min(least.get(c, 10 ** 9), r[0])
    want = sorted((r[0] or -1, f, least.get(c) or -1) for r, f, c in zip(rows, fps, label))
    got = simhash.near_duplicates(cases.documents(spark), tile_rows=8).collect()
    assert sorted((r["doc_id"] or -1, r["fp"] & (1 << 64) - 1, r["component_id"] or -1) for r in got) == want
    kept = simhash.keep_first(cases.documents(spark), tile_rows=8)
    assert kept.columns == cases.documents(spark).columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(least.get(c, -1) for c in set(label))
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0
    assert simhash.keep_first(cases.empty(spark)).count() == 0


def test_tiles_skip_nothing_near():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 6)).astype(np.uint64)
    v = np.unique(np.concatenate([base, *[base ^ np.bitwise_xor.reduce(flips[:, :k], axis=1) for k in range(1, 7)]]))
    a, b = v[::2].copy(), v[1::2].copy()
    label = np.arange(len(v))
    pos = {int(x): i for i, x in enumerate(v)}
    for x, y in (simhash.tile_forest(a, None, 3), simhash.tile_forest(b, None, 3), simhash.tile_forest(a, b, 3)):
        label = simhash.merge_labels(label, np.array([pos[int(i)] for i in x], int), np.array([pos[int(i)] for i in y], int))
    assert label.tolist() == cases.classes(len(v), cases.near(v, 3))


# -------------------------------------------------------------------- lines
def edit(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def within(a, b, most):
    """Whether at most ``most`` edits lead from one text to the other (a band of the table)."""
    if abs(len(a) - len(b)) > most:
        return False
    big = most + 1
    prev = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        cur = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            cur[j] = min(prev.get(j, big) + 1, cur.get(j - 1, big) + 1, prev.get(j - 1, big) + (x != b[j - 1]) if j else i)
        if min(cur.values()) > most:
            return False
        prev = cur
    return prev[len(b)] <= most


def brute_lines(rows):
    """Texts without repeated lines, by edit similarity alone: every pair of lines is compared."""
    import regex
    fold = str.maketrans("123456789", "000000000")
    norm = lambda l: " ".join(regex.findall(r"[\p{L}\p{N}\p{M}]+", l.lower().translate(fold)))
    order = sorted({(r[0] is None, r[0] or 0, xxhash.xxh64_intdigest(r[1] or "", 42) - (1 << 64) * (xxhash.xxh64_intdigest(r[1] or "", 42) >> 63), r[1] or "") for r in rows})
    occ = [((v, i, h), k, norm(l)) for v, i, h, t in order for k, l in enumerate(t.split("\n"))]
    occ = [o for o in occ if o[2]]
    texts = list(dict.fromkeys(o[2] for o in occ))
    long = [len(t.split(" ")) >= 5 or len(t) >= 20 for t in texts]

    def linked(i, j):
        a, b = texts[i], texts[j]
        return long[i] and long[j] and within(a, b, math.floor(0.2 * max(len(a), len(b)) + 1e-9))
    label = dict(zip(texts, cases.classes(len(texts), linked)))
    seen, gone = set(), {}
    for key, k, t in occ:
        if label[t] in seen:
            gone.setdefault(key, set()).add(k)
        seen.add(label[t])
    return {(v, i, t): "\n".join(l for k, l in enumerate(t.split("\n")) if k not in gone.get((v, i, h), ())) for v, i, h, t in order}


def test_lines_against_brute_force(spark):
    rng = __import__("random").Random(9)
    rows = [r for r in cases.rows() if len(r[1] or "") < 3000]
    for i in range(12):  # lines with one letter or word changed
        base = rows[i][1].split("\n")[0]
        rows.append((2000 + i, base[:-1] + "z\n" + base.replace("the", "tha", 1) + "\n" + cases.sentence(rng, 9), "en", "a", 1, "", "", "", "", "", ""))
    docs = spark.createDataFrame(rows, cases.DOCS)
    want = brute_lines(rows)
    got = line_dedup.dedup_lines(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["__kept"] == want[r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""]
    assert sum(r["__removed"] for r in got) > 12
    out = line_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) or r["text"] in {x[1] for x in rows} for r in out.collect())
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0


# --------------------------------------------------------------- embeddings
def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8)).astype(np.float32)
    v = np.vstack([base, base[:20] + rng.normal(scale=0.03, size=(20, 8)).astype(np.float32), base[:10], 3 * base[10:15]])
    rows = [(i, x.tolist(), int(i % 3) if i < 60 else int((i - 60) % 20 % 3)) for i, x in enumerate(v)]
    rows += [(200, None, 0), (201, [0.0] * 8, 0), (202, [1.0, None] + [0.0] * 6, 0), (203, [float("nan")] * 8, 0), (204, base[0].tolist(), None),
             (205, [1.0, 2.0], 0), (206, [1.0, 2.01], 0), (207, [], 0), (None, base[0].tolist(), 0), (3, base[3].tolist(), 0)]
    ok = [r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]

    def linked(i, j):
        if not (ok[i] and ok[j]) or rows[i][2] != rows[j][2] or len(rows[i][1]) != len(rows[j][1]):
            return False
        a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
        return a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.98
    label = cases.classes(len(rows), linked)
    least = {}
    for c, r in zip(label, rows):
        if r[0] is not None:
            least[c] = min(least.get(c, 10 ** 9), r[0])
    n = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    want = sorted((-1 if r[0] is None else r[0], k, least[c]) for r, k, c in zip(rows, n, label))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit("x")).withColumn("node", F.lit(1))
    got = embedding_dedup.near_vectors(df, block_rows=7).collect()
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


# ------------------------------------------------------------------ repeats
def brute_repeats(rows, length=50):
    best = {}
    data = [((1 << 62) if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for i, t in data:
        for k in range(len(t) - length + 1):
            best[t[k:k + length]] = min(best.get(t[k:k + length], 1 << 63), i)
    out = []
    for (i, t), r in zip(data, rows):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if best[t[k:k + length]] < i:
                gone[k:k + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(t) else 0
        out.append((r[0] or -1, len(t), spans if not gone[0] else int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()), kept))
    return sorted(out)


def test_repeats_against_brute_force(spark):
    rows = cases.rows()
    got = repeats.remove_repeats(cases.documents(spark), group_bytes=20_000).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in got) == brute_repeats(rows)
    assert repeats.remove_repeats(cases.empty(spark)).count() == 0


def test_merged_transforms_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        strings = [bytes(rng.choice(list(b"ab"), rng.integers(5, 40))) for _ in range(rng.integers(1, 12))]
        low = rng.integers(0, 99, len(strings))
        best = {}
        for s, l in zip(strings, low):
            for i in range(len(s) - 4):
                best[s[i:i + 5]] = min(best.get(s[i:i + 5], 99), l)
        got = repeats.least_documents(strings, low, 5, shard_bytes=int(rng.choice([10, 50, 1000])))
        assert [g.tolist() for g in got] == [[best[s[i:i + 5]] for i in range(len(s) - 4)] for s in strings]


def test_merge_moves_only_rows_that_reach_the_depth(monkeypatch):
    # the other rows of a string leave the rounds at its beginning, so they need not enter them
    rng = np.random.default_rng(3)
    strings = [bytes(rng.integers(97, 99, 6, dtype=np.uint8)) + b"the middle of all of these strings is one and the same" + bytes(rng.integers(97, 99, 6, dtype=np.uint8))
               for _ in range(40)]
    shards, moved, argsort = [repeats.Shard(strings[:25], 0), repeats.Shard(strings[25:], 25)], [], np.argsort
    monkeypatch.setattr(repeats.np, "argsort", lambda x, **how: (moved.append(len(x)) if x.dtype == np.uint8 else None, argsort(x, **how))[1])
    string, offset, interval = repeats.merge(shards, 50)
    assert moved and max(moved) <= sum(len(s) - 49 for s in strings)
    by = {}
    for i, s in enumerate(strings):
        for o in range(len(s) - 49):
            by.setdefault(s[o:o + 50], []).append((i, o))
    want = sorted(sorted(x) for x in by.values() if len(x) > 1)
    got = {}
    for i, o, k in zip(string.tolist(), offset.tolist(), interval.tolist()):
        got.setdefault(k, []).append((i, o))
    assert sorted(sorted(x) for x in got.values()) == want


def test_cuts_are_the_stretches_of_one_value():
    got = repeats._cuts(np.array([7, 3, 5]), [np.array([1, 1, 2]), np.array([2]), np.array([2, 2, 1, 1])])
    assert [x.tolist() for x in got] == [[7, 7, 3, 5, 5], [0, 2, 0, 0, 2], [2, 3, 1, 2, 4], [1, 2, 2, 2, 1]]
