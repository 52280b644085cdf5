"""Periodic runs of words: a suffix automaton whose end positions are merged from small to large.

A run is a stretch of consecutive words with smallest period q and at least ``least`` words and ``times`` periods, which no
neighbouring word extends.

Where runs can be.  In a run of length L, words one period apart are equal over L - q places, at least ``span`` of
them (16 for 24 words and three periods), and the two stretches of L - q words cover it.  So every run lies
in words covered by ``span``-word windows that occur twice in their text.  Windows are found by hashes, for a whole
batch at once; equal windows have equal hashes, so no run is lost, and most texts end here.

How they are found.  Each stretch of covered words gets a suffix automaton.  Its states are visited from the longest down, and
each state's ordered set of end positions goes into that of its suffix link, the smaller set into the larger.  Two positions that
become neighbours in a state of length l are ends of equal strings of l words, their longest such; if their distance d
is at most l, the words between start a square of period d.  It is extended by whatever equals the word d before: as the
state's length reaches as far left as the words agree, only the pair of neighbours at the right end of a run tells the whole of it, and
all others are passed over.  No smaller period can be, as an end between the two would come with it.

Scale.  One map over whole texts; nothing is shuffled.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .kernels import U

PIECE = 1 << 20
_WINDOW = 0x9FB21C651E98DF25


class Automaton:
    """The suffix automaton of a sequence of whole numbers, none negative.

    A state's first transition stands in two arrays and only further ones in a dictionary, as most states have one.
    """

    def __init__(self, items: list[int]):
        length, link, end, one, to = array("q", [0]), array("q", [-1]), array("q", [-1]), array("q", [-1]), array("q", [-1])
        more: dict[int, dict[int, int]] = {}
        last = 0
        for i, c in enumerate(items):
            new = len(length)
            length.append(i + 1)
            link.append(0)
            end.append(i)
            one.append(-1)
            to.append(-1)
            p, last, q = last, new, -1
            while p >= 0:
                have = one[p]
                if have == c:
                    q = to[p]
                    break
                if have < 0:
                    one[p], to[p] = c, new
                else:
                    others = more.get(p)
                    if others is None:
                        more[p] = {c: new}
                    elif c in others:
                        q = others[c]
                        break
                    else:
                        others[c] = new
                p = link[p]
            if q < 0:
                continue
            if length[q] == length[p] + 1:
                link[new] = q
                continue
            copy = len(length)
            length.append(length[p] + 1)
            link.append(link[q])
            end.append(-1)
            one.append(one[q])
            to.append(to[q])
            if q in more:
                more[copy] = dict(more[q])
            link[q] = link[new] = copy
            while p >= 0:
                if one[p] == c:
                    if to[p] != q:
                        break
                    to[p] = copy
                else:
                    others = more.get(p)
                    if others is None or others.get(c) != q:
                        break
                    others[c] = copy
                p = link[p]
        self.length, self.link, self.end = length, link, end


def span_of(least: int, times: int) -> int:
    """The fewest places over which words one period apart are equal in a run."""
    return max(1, min(max(least, times * q) - q for q in range(1, least + 1)))


def runs_of(items: list[int], least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    a, n, floor = Automaton(items), len(items), span_of(least, times)
    length, link, end = a.length, a.link, a.end
    ends: dict[int, list[int]] = {}  # of a state, negated and ascending: mostly the last of them comes last
    out = []

    def neighbours(x: int, y: int, size: int) -> None:
        """Two end positions, the left one first."""
        d = y - x
        if d <= size and size + d >= least and size + d >= times * d and (y + 1 == n or items[y + 1] != items[x + 1]):
            out.append((x - size + 1, size + d, d))

    for v in np.argsort(-np.frombuffer(length, np.int64), kind="stable").tolist():
        size = length[v]
        if size < floor:
            break
        own = ends.pop(v, None)
        if end[v] >= 0:
            if own is None:
                own = [-end[v]]
            else:  # the state's own end stands left of all others
                neighbours(end[v], -own[-1], size)
                own.append(-end[v])
        p = link[v]
        size = length[p]
        if size < floor:
            continue
        big = ends.get(p)
        if big is None:
            ends[p] = own
            continue
        if len(big) < len(own):
            big, own = own, big
        before = None
        for k, e in enumerate(own):
            at = bisect_left(big, e)
            if at and big[at - 1] != before:
                neighbours(-e, -big[at - 1], size)
            if at < len(big) and (k + 1 == len(own) or big[at] < own[k + 1]):
                neighbours(-big[at], -e, size)
            big.insert(at, e)
            before = e
        ends[p] = big
    return sorted(out)


def repeated_cover(h: np.ndarray, first: np.ndarray, span: int) -> np.ndarray:
    """True for each word in a window of ``span`` words that occurs twice in its row; ``h``: hashes of words."""
    n = len(h)
    inside = K.inside_rows(first, span, n)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(n, bool)
    w = K.windows(h, span, _WINDOW)[at]
    row = np.repeat(np.arange(len(first) - 1, dtype=U), np.diff(first))[at]
    w ^= K.mix(row)  # a window of another row is another window
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return K.covered(at[twice], span, n)


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for each of ``n`` words that stays: all but those of a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _find(least: int, times: int):
    span = span_of(least, times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            buf, offsets = K.buffers(column)
            for i, j in K.pieces(offsets, PIECE):
                at = offsets[i : j + 1]
                part = buf[at[0] : at[-1]]
                starts, ends, first = K.words(part, at - at[0])
                h = K.word_hashes(part, starts, ends)
                cover = repeated_cover(h, first, span)
                hot = np.zeros(j - i + 1, np.int64)
                np.cumsum(np.add.reduceat(np.append(cover, False).astype(np.int64), first[:-1]) * (np.diff(first) > 0), out=hot[1:])
                found, kept = [], []
                for r in range(j - i):
                    words = part[at[r] - at[0] : at[r + 1] - at[0]].tobytes().split()
                    runs: list[tuple[int, int, int]] = []
                    if hot[r + 1] > hot[r]:
                        a, b = int(first[r]), int(first[r + 1])
                        ids: dict[bytes, int] = {}
                        codes = [ids.setdefault(w, len(ids)) for w in words]
                        inside = np.diff(cover[a:b].astype(np.int8), prepend=0, append=0)
                        for x, y in zip(np.flatnonzero(inside == 1).tolist(), np.flatnonzero(inside == -1).tolist()):
                            runs += [(x + s, n, q) for s, n, q in runs_of(codes[x:y], least, times)]
                        if runs:
                            stays = collapsed(len(words), runs)
                            words = [words[k] for k in np.flatnonzero(stays).tolist()]
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)), pa.array(found, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """Runs of at least ``least`` words and ``times`` periods in every whole text, and the text without their repeats.

    Words are what stands between space and \\t \\n \\v \\f \\r, unchanged, numbered from 0.  Returns ``id_col``, ``n_words``, ``runs``
    (array of start, length, period, by start and period) and ``collapsed`` (the words that no run contains after its first
    period, joined by one space).

    Defined cases: a null, empty or blank text has no words and no runs and collapses to an empty text; runs that overlap
    all count, and a word goes if any of them drops it; repeated rows are rows of their own with equal results; a null identifier stays null;
    very long texts are searched whole; other columns are ignored; an empty table gives an empty result.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has at least two words and two periods")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    found = rows.mapInArrow(_find(least, times), "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, compared exactly; of equal ones that of the smallest start, then period.

    Null without runs.  ``runs`` are ordered by start and period, so the first of equals is the one.
    """
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    return F.aggregate(runs, F.get(runs, F.lit(-1)), better)


def listed(runs: Column) -> Column:
    """Each run as "start,length,period" and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
