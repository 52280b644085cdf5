"""Removal of repeated byte strings with induced-sorted suffix arrays of shards.

Every string of ``length`` bytes has one minimizer: its leftmost 32-byte gram of least hash.  Equal
strings have equal minimizers, so the strings can be dealt out by minimizer to shards, and a
string whose minimizer occurs once anywhere cannot repeat.  Pass 1 counts minimizers in a sketch (see
``routed``; it only overestimates).  Pass 2 sends each shard the distinct segments that hold the
strings of repeated minimizers.  A shard builds one suffix array over its segments by induced
sorting, computes the permuted common-prefix array, and marks the starts whose common prefix with
a neighbour in suffix order reaches ``length``.  Pass 3 removes the bytes that marked strings cover.

Induced sorting recurses until all names differ.  Where buckets are large it runs on whole buckets: the suffixes of a
bucket induce their predecessors as one stable distribution, and a bucket is scanned again only for the
predecessors it induced into itself.  Where they are small (names of the recursion) it runs entry by entry.

Scale.  Texts are shuffled once.  A group sends a segment once, however often it has it, so a
passage or document that a third of all rows share is one segment for each group.  A minimizer that ``hot`` groups or more
have (250: more than 4 GB of text around it) would fill one shard with all its contexts; its strings are told apart by 128-bit keys
instead, each string by its own, in exact blocks.  The sketch decides that, so all groups decide alike.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from . import routed as R
from .kernels import U
from .shared import groups_for

GRAM = 32
#: Bases of both halves of a string's key.
_FIRST, _SECOND, _LANE = 0xA24BAED4963EE407, 0x9FB21C651E98DF25, U(0xC2B2AE3D27D4EB4F)
PIECE = 256 << 10
SHARD_BYTES = 8 << 20
#: Whole buckets induce at once where they hold so many suffixes on average.
LARGE_BUCKET = 64

# ---------------------------------------------------------------- suffix arrays


def _classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is a unique least one."""
    differs = np.flatnonzero(t[:-1] != t[1:])
    rises = t[differs] < t[differs + 1]
    small = np.empty(len(t), bool)
    small[-1] = True
    small[:-1] = np.repeat(rises, np.diff(differs, prepend=-1))
    return small


def _scatter(out: np.ndarray, at: np.ndarray, step: int, chars: np.ndarray, values: np.ndarray) -> None:
    """Append ``values`` in order to the bucket of each value's char; moves the bucket pointers."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    n = np.diff(first, append=len(c))
    which = c[first]
    inner = np.arange(len(c)) - np.repeat(first, n)
    out[np.repeat(at[which], n) + step * inner] = values[order]
    at[which] += step * n


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The order that follows for all suffixes from the given order of the leftmost-smaller ones."""
    if len(t) < LARGE_BUCKET * len(size):
        return _induce_each(t, small, lms, size)
    end = np.cumsum(size)
    begin = end - size
    sa = np.full(len(t), -1, np.int32)
    of = t[lms]
    held = np.bincount(of, minlength=len(size))
    sorted_lms = lms[np.argsort(of, kind="stable")]
    lms_end = np.cumsum(held)
    head = begin.astype(np.int64)
    for c in range(len(size)):
        seen = begin[c]
        while True:
            entries, seen = sa[seen : head[c]], head[c]
            if not len(entries):
                break
            before = entries[entries > 0] - 1
            before = before[~small[before]]
            if len(before):
                _scatter(sa, head, 1, t[before], before)
        before = sorted_lms[lms_end[c] - held[c] : lms_end[c]]
        before = before[before > 0] - 1
        before = before[~small[before]]
        if len(before):
            _scatter(sa, head, 1, t[before], before)
    tail = end.astype(np.int64) - 1
    for c in range(len(size) - 1, -1, -1):
        seen = end[c] - 1
        while True:
            entries, seen = sa[tail[c] + 1 : seen + 1][::-1], tail[c]
            if not len(entries):
                break
            before = entries[entries > 0] - 1
            before = before[small[before]]
            if len(before):
                _scatter(sa, tail, -1, t[before], before)
        before = sa[begin[c] : head[c]][::-1]
        before = before[before > 0] - 1
        before = before[small[before]]
        if len(before):
            _scatter(sa, tail, -1, t[before], before)
    sa[0] = len(t) - 1
    return sa


def _induce_each(t: np.ndarray, small: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """As ``_induce``, entry by entry, in flat arrays of 32-bit numbers."""
    ends = np.cumsum(size)
    held = np.bincount(t[lms], minlength=len(size))
    order = np.argsort(t[lms], kind="stable")
    start = np.full(len(t), -1, np.int32)
    start[np.repeat(ends - np.cumsum(held), held) + np.arange(len(lms))] = lms[order]  # each bucket's end, in order
    sa, n = array("i", start.tobytes()), len(t)
    # by suffix: its predecessor's bucket, if that is of the kind that a pass places
    before = np.concatenate([[-1], np.where(small[:-1], -1, t[:-1])]).astype(np.int32)
    into, at = array("i", before.tobytes()), array("i", (ends - size).astype(np.int32).tobytes())
    for i in sa:  # grows ahead of the scan
        if i > 0 and (c := into[i]) >= 0:
            k = at[c]
            sa[k] = i - 1
            at[c] = k + 1
    before = np.concatenate([[-1], np.where(small[:-1], t[:-1], -1)]).astype(np.int32)
    into, at = array("i", before.tobytes()), array("i", ends.astype(np.int32).tobytes())
    for x in range(n - 1, -1, -1):
        i = sa[x]
        if i > 0 and (c := into[i]) >= 0:
            k = at[c] - 1
            sa[k] = i - 1
            at[c] = k
    out = np.frombuffer(sa, np.int32).copy()
    out[0] = n - 1
    return out


def _equal_neighbours(t: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether t[a:a+n] equals t[b:b+n], for each entry."""
    same = np.ones(len(a), bool)
    live, k = np.arange(len(a)), 0
    while len(live):
        hit = t[a[live] + k] == t[b[live] + k]
        same[live[~hit]] = False
        k += 1
        live = live[hit]
        live = live[n[live] > k]
    return same


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``t`` (values below ``symbols``), whose last symbol is its unique least.

    Classify suffixes, order the leftmost-smaller substrings by induction, name them, order the string
    of names (recursively), and induce the order of all suffixes from theirs.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    small = _classify(t)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    size = np.bincount(t, minlength=symbols)
    sa = _induce(t, small, lms, size)
    order = sa[is_lms[sa]]
    until = np.zeros(n, np.int32)  # length of the substring up to and with the next leftmost-smaller suffix
    until[lms[:-1]] = np.diff(lms) + 1
    until[lms[-1]] = 1
    a, b = order[:-1], order[1:]
    same = until[a] == until[b]
    at = np.flatnonzero(same)
    same[at] = _equal_neighbours(t, a[at], b[at], until[a[at]])
    name = np.zeros(n, np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    reduced = name[lms]
    count = int(name[order[-1]]) + 1
    if count == len(lms):
        return _induce(t, small, order, size)
    return _induce(t, small, lms[suffix_array(reduced, count)], size)


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix with the predecessor in suffix order, that predecessor), in text order.

    Only irreducible entries, whose preceding symbols differ, are compared; the next
    entries follow by counting down.
    """
    n = len(t)
    phi = np.empty(n, np.int64)
    phi[sa[1:]] = sa[:-1]
    phi[sa[0]] = -1
    i = np.arange(n)
    lead = np.ones(n, bool)
    ok = (i > 0) & (phi > 0)
    lead[ok] = t[i[ok] - 1] != t[phi[ok] - 1]
    lead[phi < 0] = True
    at = np.flatnonzero(lead)
    other = phi[at]
    lcp = np.zeros(len(at), np.int64)
    live = np.flatnonzero(other >= 0)
    padded = np.concatenate([t, np.zeros(8, t.dtype)])
    wide = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n + 1, 8 * t.itemsize), (t.itemsize, 1), writeable=False)
    step = 8
    while len(live):
        x, y = at[live] + lcp[live], other[live] + lcp[live]
        equal = (wide[np.minimum(x, n)] == wide[np.minimum(y, n)]).all(axis=1) & (x + step <= n) & (y + step <= n)
        for k in live[~equal].tolist() if (~equal).sum() < 64 else []:
            p, q = at[k], other[k]
            while p + lcp[k] < n and q + lcp[k] < n and t[p + lcp[k]] == t[q + lcp[k]]:
                lcp[k] += 1
        if (~equal).sum() >= 64:
            rest = live[~equal]
            for _ in range(step):
                p, q = at[rest] + lcp[rest], other[rest] + lcp[rest]
                inside = (p < n) & (q < n)
                rest, p, q = rest[inside], p[inside], q[inside]
                rest = rest[t[p] == t[q]]
                lcp[rest] += 1
        live = live[equal]
        lcp[live] += step
    run = np.cumsum(lead) - 1
    return lcp[run] - (i - at[run]), phi


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each of some distinct segments, the starts whose ``length`` bytes start elsewhere too."""
    sizes = np.array([len(s) for s in segments], np.int64)
    raw = np.frombuffer(b"\0".join([*segments, b""]), np.uint8)
    t = np.empty(len(raw) + 1, np.int16)
    t[:-1] = raw
    t[:-1] += 2
    ends = np.cumsum(sizes + 1) - 1
    t[ends] = 1
    t[-1] = 0
    sa = suffix_array(t, 258)
    lcp, before = permuted_lcp(t, sa)
    hit = np.flatnonzero(lcp >= length)
    flag = np.zeros(len(t), bool)
    flag[hit] = True
    flag[before[hit]] = True
    return [flag[e - n : e - length + 1] for e, n in zip(ends.tolist(), sizes.tolist())]


# ---------------------------------------------------------------- minimizers and segments


class _Strings:
    """The strings of a group's documents, by minimizer."""

    def __init__(self, table: pa.Table, length: int):
        self.length, self.gram = length, min(GRAM, length)
        self.buf, self.offsets = K.buffers(table["text"])

    def runs(self):
        """For each piece of rows: (its first byte, keys, first and last start of each minimizer's strings)."""
        gram, span = self.gram, self.length - self.gram + 1
        for i, j in K.pieces(self.offsets, PIECE):
            at = self.offsets[i : j + 1]
            buf = self.buf[at[0] : at[-1]]
            n = len(buf) - self.length + 1
            if n <= 0:
                continue
            h = K.windows(K._LETTER[buf], gram, K._BASE)
            least = (h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U)
            w = 1
            while 2 * w <= span:
                least = np.minimum(least[:-w], least[w:])
                w *= 2
            if w < span:
                least = np.minimum(least[:n], least[span - w : span - w + n])
            place = (least[:n] & U(0xFFFFFFFF)).astype(np.int64)
            starts = np.flatnonzero(K.inside_rows(at - at[0], self.length, len(buf))[:n])
            if not len(starts):
                continue
            place = place[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(starts)) - 1
            yield int(at[0]), h[place[first]], starts[first], starts[last]

    def hot_starts(self, hot: R.HotKeys) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, and both halves of the keys) of all strings of hot minimizers."""
        places, his, los = [np.zeros(0, np.int64)], [np.zeros(0, U)], [np.zeros(0, U)]
        for base, keys, first, last in self.runs():
            mine = np.flatnonzero(hot(keys))
            if not len(mine):
                continue
            n = last[mine] - first[mine] + 1
            at = np.repeat(first[mine], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            low, high = int(at.min()), int(at.max()) + self.length
            letters = K._LETTER[self.buf[base + low : base + high]]
            his.append(K.windows(letters, self.length, _FIRST)[at - low])
            los.append(K.windows(K.mix(letters ^ _LANE), self.length, _SECOND)[at - low])
            places.append(base + at)
        return np.concatenate(places), np.concatenate(his), np.concatenate(los)

    def segments(self, maybe: R.CellFilter, hot: R.HotKeys, shards: int) -> dict[int, dict[bytes, tuple[int, list[int]]]]:
        """By shard, the distinct segments of repeated minimizers that are not hot: (minimizer, places in the group)."""
        found: dict[int, dict[bytes, tuple[int, list[int]]]] = {}
        raw = self.buf.tobytes()
        for base, keys, first, last in self.runs():
            hit = maybe(keys) & ~hot(keys)
            keys = keys[hit]
            shard = (keys >> U(7)) % U(shards)
            for k, s, a, b in zip(keys.tolist(), shard.tolist(), (first[hit] + base).tolist(), (last[hit] + base + self.length).tolist()):
                of_shard = found.setdefault(s, {})
                held = of_shard.get(raw[a:b])
                if held is None:
                    of_shard[raw[a:b]] = (k, [a])
                else:
                    held[1].append(a)
        return found


def _sketch(length: int, blocks: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys = [k for _, k, _, _ in _Strings(table, length).runs()]
        h = np.concatenate(keys) if keys else np.zeros(0, U)
        return R.table_of([m for kind in (0, 1) for m in R.cell_messages(h, key[0].as_py(), kind, blocks)], R.MESSAGE)

    return run


def _send(length: int, blocks: int, shards: int, exact_blocks: int):
    def run(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        strings, hot = _Strings(table, length), R.HotKeys(replies, blocks)
        _, his, los = strings.hot_starts(hot)
        hi, lo, n, _ = R.distinct_pairs(his, los)
        rows = R.pair_messages(hi, lo, n, key[0].as_py(), exact_blocks, kind=3)
        for shard, found in strings.segments(R.CellFilter(replies, blocks), hot, shards).items():
            order = sorted(found)
            lens = np.array([len(s) for s in order], "<u4")
            twice = np.array([len(found[s][1]) > 1 for s in order])
            keys = np.array([found[s][0] for s in order], U)
            rows.append((2, shard, key[0].as_py(), np.uint32(len(order)).tobytes() + lens.tobytes() + keys.tobytes() + b"".join(order), np.packbits(twice).tobytes()))
        return R.table_of(rows, R.MESSAGE)

    return run


def _open(raw: bytes) -> tuple[list[bytes], list[int]]:
    """The segments of a message and their minimizers."""
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    keys = np.frombuffer(raw, U, n, 4 + 4 * n).tolist()
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4).astype(np.int64)) + 4 + 12 * n
    return [raw[a:b] for a, b in zip([4 + 12 * n, *ends[:-1].tolist()], ends.tolist())], keys


def _shard(length: int):
    """Marks for a shard's segments.

    Two starts in one segment differ in their distance from its minimizer, so they cannot hold equal strings:
    a segment repeats as a whole, or in part in another segment of the same minimizer.  Only minimizers
    with several distinct segments, some of which stand alone, need a suffix array.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        count: list[int] = []
        of_minimizer: dict[int, list[int]] = {}
        asked = []
        for g, raw, twice in zip(table["g"].to_pylist(), table["keys"].to_pylist(), table["twice"].to_pylist()):
            segments, keys = _open(raw)
            more = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(segments)).tolist()
            mine = []
            for s, m, minimizer in zip(segments, more, keys):
                k = number.setdefault(s, len(count))
                if k == len(count):
                    count.append(0)
                    of_minimizer.setdefault(minimizer, []).append(k)
                count[k] += 1 + m
                mine.append(k)
            asked.append((g, mine))
        segments = list(number)
        marks = [np.full(len(s) - length + 1, n > 1) for s, n in zip(segments, count)]
        open_ = [k for ks in of_minimizer.values() if len(ks) > 1 and any(count[k] == 1 for k in ks) for k in ks]
        if open_:
            for k, found in zip(open_, repeated_starts([segments[k] for k in open_], length)):
                marks[k] |= found
        block = key[-1].as_py()
        return R.table_of([(g, 2, block, np.packbits(np.concatenate([marks[k] for k in mine])).tobytes()) for g, mine in asked], R.REPLY)

    return run


def _answer(length: int):
    """Marks for a shard, or for an exact block of the strings of hot minimizers."""
    shard = _shard(length)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return R.grouped_pairs(key, table, 3) if key[0].as_py() == 3 else shard(key, table)

    return run


_OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept", pa.binary())])
_OUT_DDL = "id long, n_bytes long, n_removed long, spans array<long>, kept binary"


def _remove(length: int, blocks: int, shards: int, exact_blocks: int):
    def run(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return R.table_of([], _OUT)
        strings = _Strings(table, length)
        answers = {b: raw for kind, b, raw in zip(replies["kind"].to_pylist(), replies["block"].to_pylist(), replies["payload"].to_pylist()) if kind == 2}
        total = len(strings.buf)
        d = np.zeros(total + 1, np.int32)
        hot = R.HotKeys(replies, blocks)
        places, his, los = strings.hot_starts(hot)
        if len(places):
            hi, _, _, place = R.distinct_pairs(his, los)
            again = places[R.pair_answers(hi, replies, exact_blocks, of=3)[place]]
            d[again] += 1
            d[again + length] -= 1
        for shard, found in strings.segments(R.CellFilter(replies, blocks), hot, shards).items():
            bits = np.unpackbits(np.frombuffer(answers[shard], np.uint8)).astype(bool)
            done = 0
            for s in sorted(found):
                n = len(s) - length + 1
                mark, done = bits[done : done + n], done + n
                if not mark.any():
                    continue
                edge = np.flatnonzero(np.diff(mark, prepend=False, append=False))
                for a in found[s][1]:
                    for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        d[a + x] += 1
                        d[a + y - 1 + length] -= 1
        gone = np.cumsum(d[:total]) > 0
        out = []
        for key_, a, b in zip(table["id"].to_pylist(), strings.offsets[:-1].tolist(), strings.offsets[1:].tolist()):
            mine = gone[a:b]
            edge = np.flatnonzero(np.diff(mine, prepend=False, append=False)) if b > a else np.zeros(0, np.int64)
            kept = strings.buf[a:b][~mine] if len(edge) else strings.buf[a:b]
            out.append((key_, b - a, b - a - len(kept), edge.tolist(), kept.tobytes()))
        return R.table_of(out, _OUT)

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, hot: int = R.SATURATED) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else.

    Texts are UTF-8 bytes; strings never cross documents and are judged on the input.  Returns
    ``id_col``, ``n_bytes``, ``n_removed``, ``spans`` (starts and ends of the removed runs, in turn) and
    ``kept`` (the bytes left; a cut may fall inside a character).

    Defined cases: a null text is an empty one; a text shorter than ``length`` loses nothing;
    overlapping repetition counts (a run of one character loses all of its bytes but none if it is
    just ``length`` long); repeated rows repeat all their strings; null identifiers stay null; other
    columns are ignored; an empty table gives an empty result.
    """
    if length < 8:
        raise ValueError("length counts bytes, from 8")
    if not 2 <= hot <= R.SATURATED:
        raise ValueError(f"hot is from 2 to {R.SATURATED} groups")
    rows, total = R.dealt(docs, id_col, text_col)
    blocks = groups_for(total // 20, 1 << R.CELL_BITS)  # four cells for a minimizer
    shards, exact_blocks = groups_for(total, SHARD_BYTES), groups_for(total // 4, 4 << 20)
    asked = rows.groupBy("g").applyInArrow(_sketch(length, blocks), R.MESSAGE_DDL)
    maybe = asked.groupBy("kind", "block").applyInArrow(R.merge_cells(blocks, hot), R.REPLY_DDL)
    asked = rows.groupBy("g").cogroup(maybe.groupBy("g")).applyInArrow(_send(length, blocks, shards, exact_blocks), R.MESSAGE_DDL)
    sure = asked.groupBy("kind", "block").applyInArrow(_answer(length), R.REPLY_DDL)
    out = rows.groupBy("g").cogroup(maybe.unionByName(sure).groupBy("g")).applyInArrow(_remove(length, blocks, shards, exact_blocks), _OUT_DDL)
    return out.withColumnRenamed("id", id_col)
