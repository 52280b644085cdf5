"""Centroid clusters, SimHash components and periodic runs against plain Python."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash

from scriptorium.llm import centroids, periodic_runs, queries, simhash_dedup

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\v\f\r"


def split(text):
    return "".join(" " if c in SPACES else c for c in text or "").split(" ") if text else []


def plain_words(text):
    return [w for w in split(text) if w]


# --- clusters


def plain_clusters(rows, width, scale, k, rounds):
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    c = [v for _, v in first]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, y)) for y in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (b, _) in zip(kept, found) if b == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = assign()
    long = lambda v: v if v < 1 << 63 else None
    sums = [sum(d for b, d in found if b == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return [(i, b, long(d), long(sums[b]), long(sum(sums)), sha[b]) for (i, _), (b, d) in zip(kept, found)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@pytest.mark.parametrize("huge", [1.0, 3e6, 3e10, 1e30, 1.7e308])
def test_clusters_of_any_magnitude(spark, huge):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)] + [(7, [0.5] * 4), (7, [0.25] * 4), (None, [1.0, 2.0, 3.0, 4.0]), (80, [0.5] * 4)]
    rows += [(100 + i, [rng.uniform(-1, 1) * huge for _ in range(4)]) for i in range(9)]
    rows += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0, None, 1.0, 1.0]), (204, [1.0, math.nan, 0.0, 0.0]), (205, [math.inf, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "a") for i, v in rows], "vec_id long, embedding array<double>, cluster string").repartition(3)
    got = centroids.cluster_vectors(df, width=4, k=5)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert order(map(tuple, got.collect())) == order(plain_clusters(rows, 4, 64, 5, 3))


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster_vectors(spark.createDataFrame([], schema), width=2).count() == 0
    got = centroids.cluster_vectors(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [9.0, 9.0])], schema), width=2).collect()
    of = {r["vec_id"]: r["cluster"] for r in got}
    assert [r["distance"] for r in got] == [0, 0, 0] and of[1] == of[2] != of[3]


def test_clusters_sql(spark):
    got = queries.op11_centroid_clusters(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(queries.ORACLES["op11_centroid_clusters"])
    assert [d[0] for d in want.description] == got.columns
    assert order(map(tuple, got.collect())) == order(want.fetchall())


# --- fingerprints


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_print(text, width):
    w = plain_words(fold(text or ""))
    if not w:
        return 0
    width = min(width, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + width]).encode(), 42) for i in range(len(w) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, threshold):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= threshold:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash(spark):
    rng = random.Random(4)
    base = [rng.choice("ab cd ef gh ij kl mn op qr st".split()) + str(rng.randrange(40)) for _ in range(400)]
    rows = [(1, None), (2, ""), (3, " \n"), (None, " ".join(base)), (4, "One"), (5, "one two  three"), (6, "Ä É ß und"), (7, "x y z\x1cq r s"), (7, "another text of one identifier"), (8, "a " * 70_000)]
    for k in range(10, 90):
        near = list(base)
        for _ in range(k % 9):
            near[rng.randrange(len(near))] = f"y{k}"
        rows.append((k, (" " if k % 2 else "\t").join(near).upper()))
    rows += [(200 + k, " ".join(rng.choices(base, k=50))) for k in range(40)] + [(10, " ".join(base)), (None, None)]
    df = spark.createDataFrame([(i, t, "f") for i, t in rows], "doc_id long, text string, fingerprint string").repartition(5)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in simhash_dedup.simhash_duplicates(df, shingle_words=4).collect())
    prints = [plain_print(t, 4) for _, t in rows]
    part = plain_components(prints, 4)
    least = {}
    for (i, _), c in zip(rows, part):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted((i is None, i or 0, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, prints, part))
    assert got == want
    assert len({c for *_, c in want}) > 3 and sum(c == 10 for *_, c in want) > 10
    assert simhash_dedup.simhash_duplicates(df.limit(0)).count() == 0


def test_code():
    rows = simhash_dedup.code_rows(20)
    assert len(rows) == 20
    code = simhash_dedup.anchors(10)
    weight = np.bitwise_count(code)
    assert len(set(code.tolist())) == 1024 and sorted(set(weight.tolist())) == [0, 28, 32, 36, 64]  # the [64, 10, 28] code
    assert sorted(set(np.bitwise_count(simhash_dedup.anchors(7)).tolist())) == [0, 32, 64]


@pytest.mark.parametrize("threshold", [0, 4, 7])
def test_hamming_links_in_blocks(spark, monkeypatch, threshold):
    """A dense ball of fingerprints, split over many blocks, beside scattered ones and pairs exactly at the threshold."""
    monkeypatch.setattr(simhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(simhash_dedup, "LIST", 4)
    rng = random.Random(5)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    centre = rng.getrandbits(64)
    prints = {centre, *(flip(centre, rng.randrange(1, 9)) for _ in range(150)), *(rng.getrandbits(64) for _ in range(150)), 0, (1 << 64) - 1}
    prints |= {flip(x, threshold) for x in list(prints)[:60]} | {flip(x, threshold + 1) for x in list(prints)[:60]}
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    links = simhash_dedup.hamming_links(spark.createDataFrame([(x,) for x in signed], "print long").repartition(3), threshold).collect()
    at = {x: k for k, x in enumerate(signed)}
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        parent[find(at[r["a"]])] = find(at[r["b"]])
    same = lambda parts: {frozenset(k for k, c in enumerate(parts) if c == d) for d in set(parts)}
    assert same([find(k) for k in range(len(prints))]) == same(plain_components(prints, threshold))


@pytest.mark.parametrize("threshold", [0, 1, 4])
@pytest.mark.parametrize("spread", [6, 64])
def test_components_of_a_block(threshold, spread):
    rng = random.Random(threshold + spread)
    bits = [rng.randrange(64) for _ in range(spread)]
    every = sorted({sum(1 << b for b in rng.sample(bits, rng.randrange(len(bits) // 2))) for _ in range(300)} | {1 << b for b in range(64)})
    label = simhash_dedup.components(np.arange(len(every)), np.array(every, np.uint64), threshold)
    want = plain_components(every, threshold)
    assert len(set(zip(label.tolist(), want))) == len(set(want)) == len(set(label.tolist()))


# --- runs


def plain_runs(w, least=24, times=3):
    n, found = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    w = []
    while len(w) < 160:
        unit = [rng.randrange(3) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 9, 13, 20]))]
        w += (unit * rng.randrange(1, 9))[: rng.randrange(1, 80)]
    assert periodic_runs.runs_of(w) == plain_runs(w)
    assert periodic_runs.runs_of(w, 6, 2) == plain_runs(w, 6, 2)


def test_runs_of_words_of_two_letters():
    for k in range(400):
        w = [int(c) for c in f"{k * 7919:020b}"] * 2
        assert periodic_runs.runs_of(w, 4, 2) == plain_runs(w, 4, 2), w


def expected_runs(doc_id, text):
    w = plain_words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_texts(spark, tmp_path):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)] + ["é", "Ab", "ab", "\x1c", "x y"]
    rows = [(None, None), (1, None), (2, ""), (3, " \n"), (None, "a b " * 30), (4, "word " * 23), (4, "word " * 24), (5, "ab Ab " * 12)]
    for k in range(10, 160):
        body = rng.choices(words, k=rng.randrange(1, 250))
        for _ in range(rng.randrange(3)):
            unit = rng.choices(words, k=rng.randrange(1, 12))
            at = rng.randrange(len(body) + 1)
            body[at:at] = unit * rng.randrange(2, 9)
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(body)))
    rows += [(k, "one two three") for k in range(300, 330)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_runs int").repartition(4)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert order(map(tuple, got.collect())) == order(expected_runs(i, t) for i, t in rows)
    assert sum(bool(expected_runs(i, t)[1]) for i, t in rows) > 30
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_long_text(spark):
    """Some 400,000 words in one text: a long simple run, a run of long periods, and words that never repeat."""
    unit = [f"u{k}" for k in range(5000)]
    text = "\n".join(["a"] * 100_000 + unit * 4 + [f"v{k}" for k in range(280_000)])
    r = periodic_runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert [tuple(x) for x in r["runs"]] == [(0, 100_000, 1), (100_000, 20_000, 5000)]
    assert r["n_words"] == 400_000 and len(r["collapsed"].split()) == 285_001
