"""The training-data operators against plain Python, on fixtures with every edge case."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import decontaminate, exact_dedup, html_extract, license_rules, license_scan, lm_score, minhash_dedup, packing, routed, substring_dedup, suffix_dedup, toxicity
from scriptorium.llm.components import connected_components
from scriptorium.llm.queries import tokenizer_path

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SCHEMA = "doc_id long, text string, kept boolean, id string, g int, n long, rep string"


def words(rng, n):
    return " ".join(rng.choice("ka ta ma na ra la sa va ya ha Pa ga da ba ja".split()) + rng.choice("rim lun tos ver dal pon".split()) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = words(rng, 300)
    passage = words(rng, 80)
    out = [(1, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, " \n\t"), (7, "one"), (8, "two words"), (None, base), (None, None)]
    for k in range(10, 30):
        near = base.split()
        for _ in range(k % 7):
            near[rng.randrange(len(near))] = f"x{k}"
        out.append((k, " ".join(near)))
    for k in range(40, 60):
        out.append((k, words(rng, rng.randrange(1, 120)) + "\n" + passage + " " + words(rng, rng.randrange(0, 60))))
    out += [(70, words(rng, 20_000)), (71, "a" * 900), (72, "ab" * 400), (73, "é ü " * 80), (74, "\x00" * 250), (75, "word " * 400), (40, out[-20][1])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", 7, 8, "y") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is None, x) for x in row)


def test_exact_dedup(docs, rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().translate(FOLD)].append(i)
    for keep, best in (("first", min), ("last", max)):
        want = []
        for text, ids in groups.items():
            some = [i for i in ids if i is not None]
            owner = best(some) if some else None
            want += [(i, owner, len(ids), i == owner, hashlib.sha256(text).hexdigest()) for i in ids]
        got = [tuple(r) for r in exact_dedup.exact_dedup(docs, keep=keep).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_exact_dedup_spills(docs):
    plain = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs).collect()), key=key)
    assert plain == sorted((tuple(r) for r in exact_dedup.exact_dedup(docs, trie_bytes=4096).collect()), key=key)


def test_radix_trie():
    rng = random.Random(1)
    trie, seen = exact_dedup.RadixTrie(), {}
    for i in range(3000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9)))
        trie.insert(text, -i)
        seen.setdefault(text, []).append(-i)
    for text, ids in seen.items():
        node = trie.insert(text, 1, 0)
        assert (node.owner, node.count) == (min(ids), len(ids))


def expected_windows(rows, width):
    texts = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[k : k + width]) for w in texts for k in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if count[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("width", [1, 5, 35])
def test_substring_dedup(docs, rows, width):
    got = [tuple(r) for r in substring_dedup.substring_dedup(docs, window=width).collect()]
    assert sorted(got, key=key) == sorted(expected_windows(rows, width), key=key)


def expected_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, bytes(x for x, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("length", [8, 40, 200])
def test_suffix_dedup(docs, rows, length):
    got = [(r[0], r[1], r[2], len(r[3]) // 2, bytes(r[4])) for r in suffix_dedup.suffix_dedup(docs, length=length).collect()]
    assert sorted(got, key=key) == sorted(expected_bytes(rows, length), key=key)


@pytest.mark.parametrize("length", [40, 200])
@pytest.mark.parametrize("hot", [2, 5])
def test_suffix_dedup_with_hot_minimizers(monkeypatch, docs, rows, length, hot):
    """Many groups, and minimizers that some or all of them share: the same result."""
    monkeypatch.setattr(routed, "GROUP_BYTES", 5_000)
    got = [(r[0], r[1], r[2], len(r[3]) // 2, bytes(r[4])) for r in suffix_dedup.suffix_dedup(docs, length=length, hot=hot).collect()]
    assert sorted(got, key=key) == sorted(expected_bytes(rows, length), key=key)


def test_a_common_line_fills_no_shard(monkeypatch):
    """Of documents around one line, with hot minimizers apart no shard gets more than its share."""
    rng = random.Random(8)
    line = words(rng, 60).encode()
    groups = [pa.table({"text": [b" ".join([words(rng, 40).encode(), line, words(rng, 40).encode()]) for _ in range(4)]}) for _ in range(60)]
    sketch = [m for g, t in enumerate(groups) for m in suffix_dedup._sketch(200, 1)((pa.scalar(g),), t).to_pylist()]
    sizes = {}
    for hot in (routed.SATURATED, 30):
        replies = []
        for kind in (0, 1):
            replies += routed.merge_cells(1, hot)((pa.scalar(kind), pa.scalar(0)), routed.table_of([tuple(m.values()) for m in sketch if m["kind"] == kind], routed.MESSAGE)).to_pylist()
        of_shard = {}
        for g, t in enumerate(groups):
            mine = routed.table_of([tuple(r.values()) for r in replies if r["g"] == g], routed.REPLY)
            for m in suffix_dedup._send(200, 1, 50, 50)((pa.scalar(g),), t, mine).to_pylist():
                of_shard[m["kind"], m["block"]] = of_shard.get((m["kind"], m["block"]), 0) + len(m["keys"])
        sizes[hot] = of_shard
    shards = lambda s: [n for (kind, _), n in s.items() if kind == 2]
    assert max(shards(sizes[routed.SATURATED])) > 20_000 and not any(kind == 3 for kind, _ in sizes[routed.SATURATED])
    exact = [n for (kind, _), n in sizes[30].items() if kind == 3]
    assert max(shards(sizes[30]), default=0) < 5_000 and max(exact) < 3 * sum(exact) / len(exact)


@pytest.mark.parametrize("large", [0, 1, 64])
def test_suffix_arrays(monkeypatch, large):
    monkeypatch.setattr(suffix_dedup, "LARGE_BUCKET", large)
    rng = random.Random(2)
    for _ in range(150):
        n, k = rng.randrange(1, 200), rng.choice([1, 2, 4, 250])
        raw = [rng.randrange(2, 2 + k) for _ in range(n)]
        raw = (raw[: max(1, n // 3)] * 4)[:n] if rng.random() < 0.5 else raw
        t = np.array([*raw, 0], np.int16)
        text = t.tolist()
        want = sorted(range(len(text)), key=lambda i: text[i:])
        sa = suffix_dedup.suffix_array(t, 258)
        assert sa.tolist() == want
        lcp, before = suffix_dedup.permuted_lcp(t, sa)
        for a, b in zip(want, want[1:]):
            c = 0
            while max(a, b) + c < len(text) and text[a + c] == text[b + c]:
                c += 1
            assert (lcp[b], before[b]) == (c, a)


def expected_components(rows, width, least):
    """By brute force: equal identifiers and similar sets join rows."""
    sets = []
    for i, t in rows:
        w = (t or "").encode().translate(FOLD).split()
        sets.append((i, frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, (o, b) in enumerate(sets[:k]):
            common = len(a & b)
            if a and b and ((i is not None and i == o) or least.denominator * common >= least.numerator * (len(a) + len(b) - common)):
                parent[find(k)] = find(j)
    name = {}
    for k, (i, _) in enumerate(sets):
        name[find(k)] = min((x for x in (i, name.get(find(k))) if x is not None), default=None)
    return [(i, len(s), c := i if not s else name[find(k)], i == c) for k, (i, s) in enumerate(sets)]


@pytest.mark.parametrize(("width", "threshold"), [(3, 0.85), (5, 0.8), (3, 0.855)])
def test_near_duplicates(docs, rows, width, threshold):
    got = [tuple(r) for r in minhash_dedup.near_duplicates(docs, shingle_words=width, threshold=threshold).collect()]
    assert sorted(got, key=key) == sorted(expected_components(rows, width, Fraction(str(threshold))), key=key)


def test_near_duplicates_in_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 3)
    got = [tuple(r) for r in minhash_dedup.near_duplicates(docs, shingle_words=3, threshold=0.95).collect()]
    assert sorted(got, key=key) == sorted(expected_components(rows, 3, Fraction(95, 100)), key=key)


def test_near_duplicates_of_one_identifier(spark):
    rng = random.Random(21)
    a, b = words(rng, 60), words(rng, 60)
    some = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (None, b + " end"), (None, words(rng, 9)), (5, None), (5, a + " x")]
    got = [tuple(r) for r in minhash_dedup.near_duplicates(spark.createDataFrame(some, "doc_id long, text string"), shingle_words=3, threshold=0.85).collect()]
    assert sorted(got, key=key) == sorted(expected_components(some, 3, Fraction(85, 100)), key=key)
    assert {r[2] for r in got if r[0] in (1, 2, 3)} == {1}


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_sketches_tell_long_unlike_sets_apart(threshold):
    for n in (300, 1000, 5000, 50_000):
        unlike = minhash_dedup.BITS / 2 * (1 - np.exp(-4 * min(n, minhash_dedup.BINS * (1 - np.exp(-n / minhash_dedup.BINS))) / minhash_dedup.BITS))
        assert minhash_dedup.sketch_limit(np.array([n]), np.array([n]), threshold)[0] < unlike - 5 * np.sqrt(minhash_dedup.BITS) / 2


def test_sketch_limit_loses_nothing():
    rng = np.random.default_rng(3)

    def sketch(s):
        d = np.sort(s)
        b = d >> np.uint64(64 - minhash_dedup.BIN_BITS)
        first = np.concatenate([[True], b[1:] != b[:-1]])
        return np.bincount((minhash_dedup.K.mix(d[first]) & np.uint64(minhash_dedup.BITS - 1)).astype(int), minlength=minhash_dedup.BITS) & 1

    for n in (5, 30, 200, 1500, 9000):
        for _ in range(60):
            union = n + 2
            common = int(np.ceil(0.8 * union))
            u = rng.integers(0, 1 << 64, union, dtype=np.uint64)
            k = int(rng.integers(common, union + 1))
            a, b = u[:k], np.concatenate([u[:common], u[k:]])
            assert (sketch(a) ^ sketch(b)).sum() <= minhash_dedup.sketch_limit(np.array([len(a)]), np.array([len(b)]), 0.8)[0]


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        pieces += [(i, k // 512, k, len(ids[k : k + 512]), zlib.crc32(ids[k : k + 512].tobytes())) for k in range(0, len(ids), 512)]
    found = packing.pack_documents(docs, path, capacity=512, with_tokens=True).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found), key=key) == sorted(pieces, key=key)
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(r["tokens"]) == r["ids_crc32"]
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 512
    assert len(bins) == best_fit_bins([p[3] for p in pieces], 512)


def best_fit_bins(lengths, capacity):
    free, n = [], 0
    for x in sorted(lengths, reverse=True):
        k = bisect.bisect_left(free, x)
        left = free.pop(k) if k < len(free) else capacity
        n += left == capacity
        bisect.insort(free, left - x)
    return n


def test_best_fit_plan():
    rng = random.Random(6)
    for _ in range(100):
        capacity = rng.choice([9, 64, 500])
        lengths = [rng.randint(1, rng.choice([capacity, max(1, capacity // 5)])) for _ in range(rng.randrange(0, 400))]
        runs = packing.best_fit_plan(dict(Counter(lengths)), capacity)
        placed = Counter()
        for length, rank, n, _, _ in runs:
            assert placed[length] == rank
            placed[length] += n
        assert placed == Counter(lengths)
        assert len({f + k for _, _, n, f, _ in runs for k in range(n)}) == best_fit_bins(lengths, capacity)


def test_word_tokenizer():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    texts = ["", "  ", "İstanbul ΣΑΣ é don't 12ab <|endoftext|> 日本語。", "áb　c d", "Mixed, case! %%% a|b", "x" * 5000]
    rng = random.Random(18)
    odd = ["a", "B", "É", "ß", "×", "÷", "'", "'s", "'LL", "<", "|", "<|endoftext|>", "<|STARTOFTEXT|>", " ", "\t", "\n", "\x0b", "\x1c", "\x00", "\x85", "\xa0", "\u3000", "0", "9", "²", "e\u0301", "\u0301", "İ", "ſ", "Å", "ﬁ", "中", "。", "-", "...", "_", "ª", "Ω", "\u200b", "😀", "Ÿ", "re"]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randrange(25))) for _ in range(400)]
    small = packing.WordTokenizer(path, most=3)
    for tokenizer in (packing.WordTokenizer(path), small, small):
        ids, at = tokenizer.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def align(item, passage):
    best, row = 0, [0] * (len(passage) + 1)
    for a in item:
        new = [0]
        for k, b in enumerate(passage):
            new.append(max(0, row[k] + (2 if a == b else -1), row[k + 1] - 1, new[k] - 1))
        row = new
        best = max(best, *row)
    return best


def test_smith_waterman():
    rng = np.random.default_rng(8)
    for _ in range(60):
        item, passage = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 20))
        assert decontaminate.smith_waterman(item.astype(np.uint64), passage.astype(np.uint64))[0] == align(item.tolist(), passage.tolist())


def test_contamination(spark, nothing):
    rng = random.Random(9)
    items = [(k, words(rng, 40)) for k in range(6)]
    edited = items[1][1].split()
    edited[7] = edited[20] = "changed"
    del edited[30]
    texts = [(1, words(rng, 50) + " " + items[0][1].upper() + " " + words(rng, 5)), (2, " ".join(edited)), (3, words(rng, 300)), (4, None), (5, ""), (6, items[2][1] + " and " + items[3][1]), (7, items[0][1][: len(items[0][1]) // 5])]
    texts += [(k, items[5][1] + f" tail {k}") for k in range(100, 160)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (90, None), (91, "ab"), (0, items[0][1])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contamination(docs, bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (6, 2), (6, 3)} | {(k, 5) for k in range(100, 160)}
    assert got[1, 0] == 1.0 and got[2, 1] < 1
    by_block = {(r["doc_id"], r["item_id"]) for r in decontaminate.contamination(docs, bench, block_words=50).collect()}
    assert by_block == set(got)
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).orderBy("doc_id").collect()] == [3, 4, 5, 7]
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0


LICENCES = [
    ("Licensed under the Apache License, Version 2.0.", "apache", "apache,apache-2.0"),
    ("GNU General Public License v2 or later", "gpl", "gpl,gpl-2.0-or-later"),
    ("This work is CC-BY-SA 4.0", "cc-by", "cc-by,cc-by-sa-4.0"),
    ("CC BY; CC BY", "cc-by", "cc-by"),
    ("MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit", "mit"),
    ("BSD 3-Clause License", "", "bsd-3-clause"),
    ("SPDX-License-Identifier: LGPL-2.1-only", "", "lgpl,lgpl-2.1-only"),
    ("http://creativecommons.org/licenses/by-nc/3.0/", "", "cc-by-nc-3.0"),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "", "bsd"),
    ("the Software shall be used for Good, not Evil.", "", "json"),
    ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", "", "zlib"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS", "", "apache-2.0"),
    ("mit der commit license", "", ""),
    ("gnugeneral public license; xapache license", "", ""),
]


@pytest.mark.parametrize(("text", "base", "labels"), LICENCES)
def test_license_labels(text, base, labels):
    row = license_scan.scan_text(license_rules.Scanner(), text.encode())
    assert (row[4], row[5]) == (base, labels)
    assert 0 <= row[6] <= 1 and bool(row[6]) == bool(labels)


def test_gates_hide_no_rule():
    """With every rule tried on every text the detections are the same."""
    rng = random.Random(17)
    scanner, rules = license_rules.Scanner(), license_rules.build_rules()
    assert len({r.pattern for r in rules}) == len(rules)
    phrases = [re.sub(r"\\S\+ \)\{[0-9,]+\}\??", "some name ", re.sub(r"\(\?:([^|()]*)[^()]*\)\??", r"\1", n[1])) for n in license_rules.NOTICES] + [t for t, _, _ in LICENCES]
    plain = license_rules.Scanner(rules)
    plain.gates = [[] for _ in rules]
    plain.of_word = {b"the": list(range(len(rules)))}
    plain.keywords = frozenset([b"the"])
    hit = set()
    for k in range(300):
        text = f"the {words(rng, 4)} {rng.choice(phrases)} {words(rng, 3)} {rng.choice(phrases)}".lower().encode()
        canonical = b" " + b" ".join(text.translate(license_scan._WORD).split()) + b" "
        assert scanner.detect(canonical) == plain.detect(canonical)
        hit |= {d[2] for d in scanner.detect(canonical)}
    assert len(hit) >= 25


def test_license_scan(docs, rows, spark):
    assert len(license_rules.build_rules()) >= 300
    mixed = [(k, " ".join(t for t, _, _ in LICENCES[: k + 1]) * (k + 1)) for k in range(8)] + rows
    df = spark.createDataFrame(mixed, "doc_id long, text string")
    want = []
    for i, t in mixed:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(FOLD).decode())
        starts = [(k, label) for k in range(len(w)) for phrase, label in license_rules.BASE.items() if w[k : k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in starts]
        want.append((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in starts}))))
    got = [tuple(r)[:6] for r in license_scan.scan_licenses(df).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="no-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><!-- c --><div class="cookie-notice">We use cookies.</div>
<article><h1>Head&amp;line</h1><p><b>First &lt;paragraph&gt;   with
 text that goes on for a while and on.<br><p>Second&nbsp;paragraph, <a href=x>a link</a> in it, long enough to count.</p><p>Short.</p>
<ul><li>an item</li><li>another item</li></ul><aside>Aside text</aside><form><label>Name</label><input></form></article>
<div class="comments"><p>A reader's long comment that should never be part of the main text at all, whatever its length.</p></div>
<div class="sidebar"><p>About us</p></div><footer>&copy; Site</footer>"""


def test_main_text():
    want = "Head&line\nFirst <paragraph> with text that goes on for a while and on.\nSecond paragraph, a link in it, long enough to count.\nShort.\nan item\nanother item"
    assert html_extract.main_text(PAGE) == want
    assert html_extract.main_text(PAGE.replace("<article>", '<div id="content">').replace("</article>", "</div>")) == want
    for empty in (None, "", "<html></html>", "<script>x</script>", "<!--"):
        assert html_extract.main_text(empty) == ""
    assert html_extract.main_text("plain text") == "plain text"


def test_extract_main_text(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "t", 1), (2, None, None, "t", 1), (2, None, None, "t", 1), (None, "v", "<p>x", "t", 1)], "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in html_extract.extract_main_text(df).collect()]
    assert [r[0] for r in got] == [1, 2, 2, None] and all(r[3] == len(r[2]) for r in got)
    assert got[1][2] == "" and got[3][2] == "x"
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


def test_smoothing():
    assert html_extract.smooth([3.0]) == [3.0]
    assert all(abs(x - 2) < 1e-9 for x in html_extract.smooth([2.0] * 9))
    assert 2 < html_extract.two_means([1, 1, 2, 9, 10]) < 9
    assert html_extract.two_means([2.0]) is None and html_extract.two_means([1.0, 1.5, 2.0]) is None


def test_toxicity(spark):
    rng = random.Random(10)
    texts, labels = [], []
    for k in range(600):
        bad = k % 5 == 0
        w = words(rng, 40).split()
        for _ in range(4 if bad else 0):
            w[rng.randrange(40)] = rng.choice(["idiot", "schmurzel", "schmurzig", "moron"] if k % 2 else ["schmurzel", "schmurzig"])
        texts.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    texts += [(1000, None), (1001, ""), (None, "idiot"), (0, texts[0][1]), (1002, "x" * 100_000)]
    docs = spark.createDataFrame([(i, t, 1.0, 0, True) for i, t in texts], "doc_id long, text string, score double, toxic int, held_out boolean")
    labs = spark.createDataFrame([*labels, (3, None), (4, 7)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labs).collect()}
    assert len(got) == 604
    held = [(got[k]["predicted"], y) for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, _ in labels)
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert toxicity.score_toxicity(docs.limit(0), labs).count() == 0
    alone = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labs.limit(0)).collect()}
    assert alone[None] > alone[1000]


def test_label_model():
    rng = np.random.default_rng(11)
    truth = rng.random(4000) < 0.2
    right = np.array([0.95, 0.8, 0.7, 0.6])
    votes = np.where(rng.random((4000, 4)) < right, truth[:, None], ~truth[:, None]) * 2
    votes = np.column_stack([votes, votes[:, 3], votes[:, 3]]).astype(int)  # two copies of the worst voter
    model = toxicity.fit_label_model(votes, np.ones(4000), votes[:, 0] / 2 * 0.8 + 0.1, 0.2)
    assert model.discount[0] > model.discount[4]
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93


def test_lm_scores(docs, rows, nothing):
    got = lm_score.lm_scores(docs).collect()
    want = Counter((i, len((t or "").encode().split())) for i, t in rows)
    assert Counter((r["doc_id"], r["n_words"]) for r in got) == want
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[4]["sum_logp"] == by_id[5]["score"] == 0
    assert by_id[1]["score"] == by_id[2]["score"] > -np.log(lm_score.CLASSES)
    assert lm_score.lm_scores(nothing).count() == 0


def test_lm_network():
    p = lm_score.initial()
    rng = np.random.default_rng(12)
    around, target = rng.integers(0, lm_score.CLASSES, (40, 4)), rng.integers(0, lm_score.CLASSES, 40)

    def loss(q):
        z = lm_score.forward(lm_score.unpacked(q), around)[2]
        return -np.log(z[np.arange(40), target]).mean()

    g = lm_score.gradient(lm_score.unpacked(p), around, target)
    wide = p.astype(np.float64)
    for k in [int(around[0, 0]) * lm_score.EMBED, lm_score.SIZES[0] + 5, sum(lm_score.SIZES[:2]) + 3, sum(lm_score.SIZES[:3]) + 9, len(p) - 4]:
        step = np.zeros(len(p))
        step[k] = 1e-4
        assert abs((loss(wide + step) - loss(wide - step)) / 2e-4 - g[k]) < 1e-3
    around, target = lm_score.contexts(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]))
    assert around.tolist() == [[0, 0, 6, 7], [0, 5, 7, 0], [5, 6, 0, 0], [0, 0, 0, 0]] and target.tolist() == [5, 6, 7, 8]


@pytest.mark.parametrize(
    "run",
    [
        lambda d: exact_dedup.exact_dedup(d),
        lambda d: substring_dedup.substring_dedup(d),
        lambda d: suffix_dedup.suffix_dedup(d),
        lambda d: minhash_dedup.near_duplicates(d),
        lambda d: license_scan.scan_licenses(d),
        lambda d: packing.pack_documents(d, tokenizer_path("word_bpe_49k.json")),
    ],
)
def test_empty_table(nothing, run):
    assert run(nothing).count() == 0
