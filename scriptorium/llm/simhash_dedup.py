"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints.  A bit is set if it is set in over half the hashes of a text's word shingles, repeats included.

Anchors.  The words of a binary code are the anchors: evaluations at the 64 elements of GF(64) of 1 and of traces of
multiples of x, x^9, x^3, x^5 and x^7, as many of these as the number of fingerprints calls for (2^7 to 2^20 anchors; the first seven
rows alone leave no point farther than 28 from an anchor, and more rows only bring them nearer).  The home of a fingerprint is
its nearest anchor, at distance r.  It is sent to every anchor within r plus the threshold.  Of two fingerprints within
the threshold t, let u be the one nearer to its home: the other, v, lies within r(u) + t <= r(v) + t of u's home, so both
meet there and no link is lost.  (With the covering radius in the place of each fingerprint's own distance the same holds, with
many more copies.)  At each anchor those at home are compared with all that are there.

Comparing.  Two numbers within t bits agree in one of t + 1 parts of their bits, so at an anchor only those are compared that
share a part; where most would, all are.  A block of an anchor returns links that join what was apart within it, never all pairs.

Scale.  Equal fingerprints are one row.  The number of anchors is near the square root of the number N of distinct fingerprints, so
placing costs N^1.5 comparisons of 64 bits.  Shuffled are eight bytes for each copy, in lists by anchor that each task makes: 13 copies
of a fingerprint with 2^7 anchors, 57 with 2^12 (14 million fingerprints), 272 with 2^18.  An anchor that a large group of similar
fingerprints shares is split into blocks of its homes and its guests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .kernels import U
from .shared import dropped, written

SEED = 42
#: Shingles hashed at once, fingerprints in one side of a block of an anchor, and in one row of a list.
PIECE, BLOCK, LIST = 1 << 16, 1 << 16, 1024
#: Copies that a task gathers before it writes its lists.
GATHERED = 4_000_000
LEAST_ROWS, MOST_ROWS = 7, 20


def fingerprint(text: bytes, width: int) -> bytes:
    """The eight bytes of a text's fingerprint, most significant first; zero without words."""
    words = text.lower().split()  # of bytes: A-Z alone, and just the six separators
    if not words:
        return bytes(8)
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - width + 1
    first, last = starts[:n].tolist(), (ends[width - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(first[at : at + PIECE], last[at : at + PIECE])])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n).tobytes()


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = b"".join([fingerprint(t.as_py(), width) for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.frombuffer(prints, ">i8").astype(np.int64))], names=["id", "print"])

    return run


def _field() -> tuple[list[int], list[int]]:
    """Powers of a generator of GF(64), by x^6 = x + 1, and the trace of each element."""
    power = [1]
    for _ in range(62):
        x = power[-1] << 1
        power.append(x ^ 0b1000011 if x & 64 else x)
    log = {x: i for i, x in enumerate(power)}
    trace = [0] * 64
    for x in power:
        total = 0
        for k in range(6):
            total ^= power[log[x] * (1 << k) % 63]
        trace[x] = total  # 0 or 1
    return power, trace


def code_rows(rows: int) -> list[int]:
    """Generators of the code, each a number of 64 bits; the first ``rows`` that are independent."""
    power, trace = _field()
    log = {x: i for i, x in enumerate(power)}
    found, reduced = [], []
    candidates = [(1 << 64) - 1]
    for exponent in (1, 9, 3, 5, 7):
        for a in range(6):
            candidates.append(sum(trace[power[(a + log[x] * exponent) % 63]] << x for x in power))
    for c in candidates:
        left = c
        for r in reduced:
            left = min(left, left ^ r)
        if left and len(found) < rows:
            found.append(c)
            reduced.append(left)
            reduced.sort(reverse=True)
    return found


def anchors(rows: int) -> np.ndarray:
    """All words of the code."""
    out = np.zeros(1, U)
    for g in code_rows(rows):
        out = np.concatenate([out, out ^ U(g)])
    return out


def rows_for(n: int) -> int:
    """Rows of the code for ``n`` distinct fingerprints."""
    return min(MOST_ROWS, max(LEAST_ROWS, round(math.log2(max(1, n)) / 2)))


_PLACED_DDL = "anchor int, home boolean, n int, prints binary"


def _lists(anchor: np.ndarray, home: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    """Rows of at most LIST fingerprints of one anchor, all of them at home or all guests."""
    order = np.lexsort((prints, home, anchor))
    group = anchor[order].astype(np.int64) * 2 + home[order]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(new)
    new[(np.arange(len(group)) - np.repeat(first, np.diff(first, append=len(group)))) % LIST == 0] = True
    cuts = np.flatnonzero(new)
    offsets = pa.py_buffer(np.append(cuts, len(group)).astype(np.int32) * 8)
    lists = pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, offsets, pa.py_buffer(prints[order].tobytes())])
    sizes = np.diff(cuts, append=len(group)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array((group[cuts] // 2).astype(np.int32)), pa.array(group[cuts] % 2 == 1), pa.array(sizes), lists], names=["anchor", "home", "n", "prints"])


def _place(rows: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = anchors(rows)
        step = max(1, (1 << 20) // len(code))
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            prints = batch.column(0).to_numpy().view(U)
            for at in range(0, len(prints), step):
                some = prints[at : at + step]
                far = np.bitwise_count(some[:, None] ^ code[None, :])
                home = far.argmin(axis=1)
                least = far[np.arange(len(some)), home]
                row, anchor = np.nonzero(far <= (least + threshold)[:, None])
                kept.append((anchor.astype(np.int32), home[row] == anchor, some[row]))
                size += len(row)
                if size >= GATHERED:
                    yield _lists(*(np.concatenate(c) for c in zip(*kept)))
                    kept, size = [], 0
        if size:
            yield _lists(*(np.concatenate(c) for c in zip(*kept)))

    return run


def _joined(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Labels (the least place of each component) after the links p-q."""
    while True:
        least = np.minimum(label[p], label[q])
        if (least == label[p]).all() and (least == label[q]).all():
            return label
        np.minimum.at(label, label[p], least)
        np.minimum.at(label, label[q], least)
        while (label[label] != label).any():
            label = label[label]


def components(left: np.ndarray, every: np.ndarray, threshold: int) -> np.ndarray:
    """The least place of the component of each of ``every`` (distinct), by links from the places in ``left``."""
    label = np.arange(len(every))
    edges = [64 * k // (threshold + 1) for k in range(threshold + 2)]
    parts = []
    for low, high in zip(edges, edges[1:]):
        key = every >> U(low) & U((1 << high - low) - 1)
        order = np.argsort(key, kind="stable")
        begin, end = (np.searchsorted(key[order], key[left], side) for side in ("left", "right"))
        parts.append((order, begin, end - begin))
    if 2 * sum(int(n.sum()) for _, _, n in parts) < len(left) * len(every):
        for order, begin, n in parts:
            ends = np.cumsum(n)
            for i, j in _spans(ends, 1 << 20):
                p = np.repeat(np.arange(i, j), n[i:j])
                q = order[np.arange(len(p)) - np.repeat(ends[i:j] - n[i:j] - (ends[i - 1] if i else 0), n[i:j]) + np.repeat(begin[i:j], n[i:j])]
                near = np.bitwise_count(every[left[p]] ^ every[q]) <= threshold
                label = _joined(label, left[p[near]], q[near])
    else:
        step = max(1, (1 << 22) // max(1, len(every)))
        for at in range(0, len(left), step):
            p, q = np.nonzero(np.bitwise_count(every[left[at : at + step]][:, None] ^ every[None, :]) <= threshold)
            label = _joined(label, left[at + p], q)
    return label


def _spans(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that make about ``most`` pairs together; ``ends``: running counts of pairs."""
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        yield i, j
        i = j


def _meet(threshold: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        sides = [np.frombuffer(b"".join(table.filter(pc.equal(table["side"], s))["prints"].to_pylist()), np.int64) for s in (0, 1)]
        every = np.unique(np.concatenate(sides))
        left = np.searchsorted(every, np.unique(sides[0]))
        label = components(left, every.view(U), threshold)
        some = np.flatnonzero(label != np.arange(len(every)))
        return pa.table([pa.array(every[label[some]]), pa.array(every[some])], schema=schema)

    return run


def hamming_links(prints: DataFrame, threshold: int = 4) -> DataFrame:
    """(a, b): links that connect all pairs of distinct ``print`` (long) with at most ``threshold`` differing bits.

    Every such pair is connected by returned links, and what they connect is connected by such pairs.
    """
    placed = prints.mapInArrow(_place(rows_for(prints.count()), threshold), _PLACED_DDL)
    placed = written(placed.withColumn("row", F.monotonically_increasing_id()), "anchored")
    sizes = placed.groupBy("anchor").agg(F.sum(F.when(F.col("home"), F.col("n"))).alias("homes"), F.sum("n").alias("all")).where("homes > 0 AND all > 1")
    sizes = sizes.select("anchor", F.ceil(F.col("homes") / BLOCK).alias("i_blocks"), F.ceil(F.col("all") / BLOCK).alias("j_blocks"))
    met = placed.join(F.broadcast(sizes), "anchor")  # at most one row of twenty bytes an anchor
    at = F.xxhash64("row")
    until = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    home = met.where("home").select("anchor", F.lit(0).alias("side"), "prints", F.pmod(at, "i_blocks").alias("i"), F.explode(until(F.col("j_blocks"))).alias("j"))
    there = met.where("NOT home OR i_blocks > 1 OR j_blocks > 1")  # in a single block those at home are there already
    guest = there.select("anchor", F.lit(1).alias("side"), "prints", F.explode(until(F.col("i_blocks"))).alias("i"), F.pmod(at, "j_blocks").alias("j"))
    links = home.unionByName(guest).groupBy("anchor", "i", "j").applyInArrow(_meet(threshold), "a long, b long")
    out = written(links, "fingerprint-links")
    dropped(placed)
    return out


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, threshold: int = 4) -> DataFrame:
    """Components of documents whose fingerprints differ in at most ``threshold`` bits.

    Words are runs without space and \\t \\n \\v \\f \\r, with A-Z lower-cased; a shingle is ``shingle_words`` of them joined by
    one space, hashed by XXH64 with seed 42; a document with fewer words has its whole sequence as the one shingle.
    Returns ``id_col``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` (the smallest identifier reachable over
    links, its own included).

    Defined cases: a null, empty or blank text has the fingerprint zero, which is linked like any other; rows that
    share an identifier are documents of their own, each with its fingerprint; a row with a null identifier takes part, but never names
    a component (one of such rows alone has a null name); other columns are ignored; an empty table gives an empty result.
    """
    if not 0 <= threshold <= 16:
        raise ValueError("threshold is from 0 to 16 bits")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    signed = written(rows.mapInArrow(_fingerprints(shingle_words), "id long, print long"), "fingerprints")
    classes = written(signed.groupBy("print").agg(F.min("id").alias("least")), "fingerprint-classes")
    links = hamming_links(classes.select("print"), threshold)
    found = connected_components(links, "a", "b").withColumnRenamed("node", "print")
    dropped(links)
    of_class = classes.join(found, "print", "left").withColumn("component", F.coalesce("component", "print"))
    names = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(of_class.join(names, "component").select("print", "component_id"), "fingerprint-names")
    return signed.join(named, "print").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
