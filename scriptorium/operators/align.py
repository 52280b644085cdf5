"""Alignment of near-identical texts: opcodes, similarity, word repair, diff records.

These need sequence alignment, which column expressions cannot express; they are vectorised Python
functions, and equal texts never reach the alignment.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from difflib import Match, SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .edits import edit_counts

OPS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("op", "before", "after")] + [T.StructField("position", T.IntegerType())]))


#: Ranges with at most so many pairs of places are searched place by place.  Long common runs are listed in advance, so long that
#: their starts are at most ``PAIRS`` times the items.
SMALL, PAIRS = 4096, 16
#: Runs of 2^``HASHED`` items are found by a hash in sequences of at most ``HEAPED`` items; so few listed runs as ``FEW`` are gone through one by one.
HASHED, HEAPED, MIX, FEW = 4, 1 << 19, 0x9E3779B97F4A7C15, 64


class Matcher(SequenceMatcher):
    """``SequenceMatcher`` without junk, with the same blocks, for long sequences.

    Ranks of all runs of 2^k items, by doubling, make runs comparable as numbers.  The maximal common runs of some length are listed
    once, and the longest one within two ranges is the longest when all are cut to these; a range takes on what its parent's list
    has in it.  Where only shorter runs are left, the length is found by bisection.
    """

    def __init__(self, a, b):
        self.fullbcount, self.matching_blocks, self.opcodes = None, None, None
        self.a, self.b = a, b
        if isinstance(a, str):
            every = np.frombuffer((a + b).encode("utf-32-le", "surrogatepass"), np.int32)
        else:
            codes: dict = {}
            every = np.fromiter((codes.setdefault(x, len(codes)) for s in (a, b) for x in s), np.int32, len(a) + len(b))
        self.ranks, self.within = [every], {}
        self.least, self.runs = self._runs() if len(a) * len(b) > SMALL else (0, None)

    def _hashed_runs(self) -> np.ndarray | None:
        """(start in ``a``, start in ``b``, length) of every maximal common run of 16 items or more; none if there are very many.

        Runs of 16 items are found by a hash of 64 bits, dealt into at most 2^16 heaps by its upper ones, and then compared item by item.
        """
        n, m, least, factor = len(self.a), len(self.b), 1 << HASHED, MIX
        if min(n, m) < least or max(n, m) > HEAPED:
            return None
        every = self.ranks[0]
        h = every.astype(np.uint64) * np.uint64(MIX)
        for k in range(HASHED):
            h = h[: -(1 << k)] * np.uint64(factor) + h[1 << k :]
            factor = factor * factor & 0xFFFFFFFFFFFFFFFF
        h ^= h >> np.uint64(32)
        h *= np.uint64(MIX)
        x, y = h[: n - least + 1], h[n : n + m - least + 1]
        bits = min(16, (n + m).bit_length())
        of_x, of_y = (x >> np.uint64(64 - bits)).astype(np.uint16), (y >> np.uint64(64 - bits)).astype(np.uint16)
        heaps = np.bincount(of_y, minlength=1 << bits)
        many = heaps[of_x]
        if many.sum() > PAIRS * (n + m):
            return None
        first = (np.cumsum(heaps) - heaps)[of_x]
        i = np.repeat(np.arange(len(x)), many)
        j = np.argsort(of_y, kind="stable")[np.arange(len(i)) + np.repeat(first - np.cumsum(many) + many, many)]
        equal = x[i] == y[j]
        runs, i, j = self._joined(i[equal], j[equal], least)
        last = np.arange(1, least)[:, None]
        same = (every[i] == every[n + j]).all() and (every[runs[0] + runs[2] - last] == every[n + runs[1] + runs[2] - last]).all()
        return runs if same else None

    @staticmethod
    def _joined(i: np.ndarray, j: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of neighbouring equal places, as (start, start, length), and the places in order."""
        order = np.lexsort((i, j - i))
        i, j = i[order], j[order]
        starts = np.flatnonzero(np.append(True, (np.diff(i) != 1) | (np.diff(j) != 1))[: len(i)])
        return np.stack([i[starts], j[starts], np.diff(np.append(starts, len(i))) + least - 1]), i, j

    def _runs(self) -> tuple[int, np.ndarray]:
        """A length, and (start in ``a``, start in ``b``, length) of every maximal common run at least so long."""
        n, m = len(self.a), len(self.b)
        hashed = self._hashed_runs()
        if hashed is not None:
            return 1 << HASHED, hashed
        for k in range(4, 31, 2):
            least = 1 << k
            if least > min(n, m):
                break
            self._rank(k)
            x, y = self.ranks[k][: n - least + 1], self.ranks[k][n : n + m - least + 1]
            order = np.argsort(y, kind="stable")
            first = np.searchsorted(y, x, "left", order)
            many = np.searchsorted(y, x, "right", order) - first
            if many.sum() > PAIRS * (n + m):
                continue
            i = np.repeat(np.arange(len(x)), many)
            j = order[np.arange(len(i)) + np.repeat(first - np.cumsum(many) + many, many)]
            return least, self._joined(i, j, least)[0]
        return least, np.empty((3, 0), np.int64)

    def _rank(self, k: int) -> None:
        while len(self.ranks) <= k:
            last, step = self.ranks[-1].astype(np.int64), 1 << len(self.ranks) - 1
            pair = last[:-step] << 32 | last[step:]
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))

    def _keys(self, length: int, start: int, stop: int) -> np.ndarray:
        """A number for each run of ``length`` items from ``start`` on, equal for equal runs."""
        k = length.bit_length() - 1
        self._rank(k)
        r, n = self.ranks[k], stop - start - length + 1
        first, second = r[start : start + n].astype(np.int64), r[start + length - (1 << k) :][:n]
        return first << 32 | second

    def find_longest_match(self, alo: int = 0, ahi: int | None = None, blo: int = 0, bhi: int | None = None) -> Match:
        """The longest common run; of those the first in ``a``, of those the first in ``b``."""
        ahi, bhi = len(self.a) if ahi is None else ahi, len(self.b) if bhi is None else bhi
        if alo >= ahi or blo >= bhi:
            return Match(alo, blo, 0)
        if (ahi - alo) * (bhi - blo) <= SMALL:
            return self._small(alo, ahi, blo, bhi)
        n = len(self.a)
        low, high = 0, min(ahi - alo, bhi - blo)  # a run of ``low`` is common
        runs = self.within.pop((alo, ahi, blo, bhi), self.runs)
        if runs is not None:
            listed = self._listed(runs, alo, ahi, blo, bhi)
            if listed is not None:
                return listed
            high = min(high, self.least - 1)
        while low < high:
            mid = (low + high + 1) // 2
            x, y = self._keys(mid, alo, ahi), self._keys(mid, n + blo, n + bhi)
            low, high = (mid, high) if np.isin(x, y).any() else (low, mid - 1)
        if not low:
            return Match(alo, blo, 0)
        x, y = self._keys(low, alo, ahi), self._keys(low, n + blo, n + bhi)
        i = int(np.argmax(np.isin(x, y)))
        return Match(alo + i, blo + int(np.argmax(y == x[i])), low)

    def _one_by_one(self, runs: list[tuple[int, int, int]], alo: int, ahi: int, blo: int, bhi: int) -> Match | None:
        """As ``_listed``, of few runs."""
        best, some = None, []
        for run in runs:
            i, j, size = run
            cut = max(alo - i, blo - j, 0)
            left = min(ahi - i, bhi - j, size) - cut
            if left >= self.least:
                some.append(run)
                if best is None or (-left, i + cut, j + cut) < best:
                    best = (-left, i + cut, j + cut)
        if best is None:
            return None
        found = Match(best[1], best[2], -best[0])
        for part in ((alo, found.a, blo, found.b), (found.a + found.size, ahi, found.b + found.size, bhi)):
            self.within[part] = [r for r in some if r[0] < part[1] and r[1] < part[3] and r[0] + r[2] > part[0] and r[1] + r[2] > part[2]]
        return found

    def _listed(self, runs: np.ndarray | list, alo: int, ahi: int, blo: int, bhi: int) -> Match | None:
        """The longest of the listed runs when they are cut to the ranges; none if it becomes too short for the list."""
        if isinstance(runs, list):
            return self._one_by_one(runs, alo, ahi, blo, bhi)
        if runs.shape[1] <= FEW:
            return self._one_by_one(list(zip(*runs.tolist())), alo, ahi, blo, bhi)
        i, j, size = runs
        cut = np.maximum(np.maximum(alo - i, blo - j), 0)
        left = np.minimum(np.minimum(ahi - i, bhi - j), size) - cut
        if not left.size or left.max() < self.least:
            return None
        longest = np.flatnonzero(left == left.max())
        at = longest[np.lexsort(((j + cut)[longest], (i + cut)[longest]))[0]]
        found = Match(int(i[at] + cut[at]), int(j[at] + cut[at]), int(left[at]))
        some = runs[:, left >= self.least]
        for part in ((alo, found.a, blo, found.b), (found.a + found.size, ahi, found.b + found.size, bhi)):
            inside = (some[0] < part[1]) & (some[1] < part[3]) & (some[0] + some[2] > part[0]) & (some[1] + some[2] > part[2])
            self.within[part] = some[:, inside]
        return found

    def _small(self, alo: int, ahi: int, blo: int, bhi: int) -> Match:
        places: dict[int, list[int]] = {}
        codes, n = self.ranks[0], len(self.a)
        for j, c in enumerate(codes[n + blo : n + bhi].tolist(), blo):
            places.setdefault(c, []).append(j)
        best, runs = Match(alo, blo, 0), {}
        for i, c in enumerate(codes[alo:ahi].tolist(), alo):
            now = {}
            for j in places.get(c, ()):
                k = now[j] = runs.get(j - 1, 0) + 1
                if k > best.size:
                    best = Match(i - k + 1, j - k + 1, k)
            runs = now
        return best


def opcodes(a: str, b: str) -> list[dict]:
    """What turns ``a`` into ``b``, equal runs included; positions count from 0 in ``a``."""
    if a == b:
        return [{"op": "equal", "before": a, "after": b, "position": 0}] if a else []
    found = Matcher(a, b).get_opcodes()
    return [{"op": op, "before": a[i:j], "after": b[k:m], "position": i} for op, i, j, k, m in found]


def tidied(ops: list[dict]) -> list[dict]:
    """Opcodes for reading: equal runs no longer than the edits on both sides of them become part of the edits.

    An edit's size is the longer of what it removes and adds; the run joins its neighbours when it is not longer than
    either.  Runs that join make larger edits, which may take further runs.
    """
    out: list[dict] = []
    for op in ops:
        out.append(dict(op))
        while len(out) >= 3 and out[-1]["op"] != "equal" and out[-2]["op"] == "equal" and out[-3]["op"] != "equal":
            size = [max(len(x["before"]), len(x["after"])) for x in (out[-3], out[-1])]
            if len(out[-2]["before"]) > min(size):
                break
            last = out[-3:]
            del out[-3:]
            out.append({"op": "replace", "before": "".join(x["before"] for x in last), "after": "".join(x["after"] for x in last), "position": last[0]["position"]})
    return out


@F.pandas_udf(OPS)
def tidy_diff_ops(a: pd.Series, b: pd.Series) -> pd.Series:
    """As ``diff_ops``, tidied for reading."""
    return pd.Series([None if x is None or y is None else tidied(opcodes(x, y)) for x, y in zip(a, b)])


@F.pandas_udf(OPS)
def diff_ops(a: pd.Series, b: pd.Series) -> pd.Series:
    """Opcodes of each pair; null if a side is null."""
    return pd.Series([None if x is None or y is None else opcodes(x, y) for x, y in zip(a, b)])


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each character of ``a`` in one integer; common ends are counted apart."""
    head, tail = common_ends(a, b)
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        u = row & masks.get(ch, 0)
        row = (row + u | row - u) & full
    return head + tail + len(a) - row.bit_count()


def common_ends(a, b) -> tuple[int, int]:
    """How many first items two sequences share, and how many last ones beside these."""
    head = len(os.path.commonprefix([a, b]))
    return head, len(os.path.commonprefix([a[head:][::-1], b[head:][::-1]]))


def ratio(a: str, b: str) -> float:
    """100 times twice the common subsequence over both lengths; 100 for two empty texts."""
    if a == b:
        return 100.0
    return 100.0 * 2 * lcs_length(a, b) / (len(a) + len(b))


class Nearest:
    """The most similar text seen for each of some items; of equally similar ones the smallest identifier.

    Items of like length are packed into one integer, where ``lcs_length`` runs for all of them at once; a pack is
    passed over where the lengths alone show that no item of it can gain.
    """

    PACK = 64

    def __init__(self, items: list[tuple[int, str]]):
        items = sorted(items, key=lambda x: len(x[1]))
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        self.sizes = np.array([len(t) for t in self.texts])
        self.score, self.owner = np.full(len(items), -1.0), [None] * len(items)
        self.packs = []
        for k in range(0, len(items), self.PACK):
            masks: dict[str, int] = {}
            full, at, starts = 0, 0, []
            for t in self.texts[k : k + self.PACK]:
                starts.append(at // 8)
                for i, ch in enumerate(t):
                    masks[ch] = masks.get(ch, 0) | 1 << at + i
                full |= (1 << len(t)) - 1 << at
                at += -(-(len(t) + 1) // 8) * 8  # at least one bit takes the carry
            self.packs.append((k, min(len(items), k + self.PACK), masks, full, np.array(starts), at // 8))

    def add(self, ids: list[int], texts: list[str]) -> None:
        middle = self.sizes[len(self.sizes) // 2]
        for i, t in sorted(zip(ids, texts), key=lambda x: abs(len(x[1]) - middle)):  # good ones early
            both = np.maximum(self.sizes + len(t), 1)
            most = np.where(self.sizes + len(t) == 0, 100.0, 100.0 * 2 * np.minimum(self.sizes, len(t)) / both)
            for a, b, masks, full, starts, size in self.packs:
                if not (most[a:b] >= self.score[a:b]).any():
                    continue
                row = full
                for ch in t:
                    if u := row & masks.get(ch, 0):
                        row = (row + u | row - u) & full
                left = np.add.reduceat(np.bitwise_count(np.frombuffer(row.to_bytes(size, "little"), np.uint8)).astype(np.int64), starts)
                score = np.where(self.sizes[a:b] + len(t) == 0, 100.0, 100.0 * 2 * (self.sizes[a:b] - left) / both[a:b])
                for k in np.flatnonzero(score >= self.score[a:b]).tolist():
                    if score[k] > self.score[a + k] or i < self.owner[a + k]:
                        self.score[a + k], self.owner[a + k] = score[k], i

    def best(self) -> list[tuple[int, int, float]]:
        return [(i, j, s) for i, j, s in zip(self.ids, self.owner, self.score.tolist()) if j is not None]


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    """The normalised indel ratio, 0 to 100; equal texts are not aligned."""
    return F.when(a == b, F.lit(100.0)).otherwise(_ratio(F.when(a == b, "").otherwise(a), F.when(a == b, "").otherwise(b)))


def positioned_words(text: str, chars: str = "ऀ-ॿ", skip_header: bool = True, skip_comments: bool = True, skip_headings: bool = True) -> list[tuple[str, int, int]]:
    """(word, start, end) of the script's words that do not lie in the header, a comment or a heading."""
    skipped: list[tuple[int, int]] = []
    if skip_header and (m := re.match(r"(---|\+\+\+)\n.*?\n\1\n", text, re.S)):
        skipped.append(m.span())
    if skip_comments:
        skipped += [m.span() for m in re.finditer(r"<!--.*?-->", text, re.S)]
    if skip_headings:
        skipped += [m.span() for m in re.finditer(r"^#+\s+.*$", text, re.M)]
    skipped.sort()
    out, k = [], 0
    for m in re.finditer(f"[{chars}]+", text):
        while k < len(skipped) and skipped[k][1] <= m.start():
            k += 1
        if not any(a <= m.start() and m.end() <= b for a, b in skipped[max(0, k - 1) : k + 2]):
            out.append((m[0], *m.span()))
    return out


def word_lists(texts: pa.Array, chars: str) -> pa.Array:
    """An Arrow list of (word, start, end) for each text, null for null: flat columns, filled some texts at a time."""
    at, sizes, parts = 0, [], []
    kind = pa.struct([("word", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for first in range(0, len(texts), 64):
        found = [None if t is None else positioned_words(t, chars) for t in texts.slice(first, 64).to_pylist()]
        for words in found:
            sizes.append(None if words is None else at)
            at += len(words or ())
        flat = [w for words in found for w in words or ()]
        columns = zip(*flat) if flat else ((), (), ())
        parts.append(pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind)))
    values = pa.concat_arrays(parts) if parts else pa.array([], kind)
    return pa.ListArray.from_arrays(pa.array([*sizes, at], pa.int32()), values)


def words_with_positions(chars: str = "ऀ-ॿ"):
    """A vectorised function: text → array of (word, start, end).

    Words stay in Arrow columns, some twenty bytes each, as the words of all texts of a batch are in memory at once.
    """

    @F.arrow_udf("array<struct<word:string,start:int,end:int>>")
    def find(texts: pa.Array) -> pa.Array:
        return word_lists(texts, chars)

    return find


REPAIR = "success boolean, text string, message string, n_changes int"


def repair_words(source: str, output: str, chars: str = "ऀ-ॿ", least: float = 85.0) -> dict:
    """``output`` with its words made those of ``source``; what stands between words stays.

    Words at both ends that agree stay as they are; those between are aligned.  Refused if the words' similarity is below ``least``, or
    if the result's words are still not the source's.
    """
    want, have = positioned_words(source, chars), positioned_words(output, chars)
    a, b = [w for w, _, _ in want], [w for w, _, _ in have]
    if a == b:
        return {"success": True, "text": output, "message": "identical", "n_changes": 0}
    near = ratio(" ".join(a), " ".join(b))
    if near < least:
        return {"success": False, "text": output, "message": f"similarity {near:.1f} is below {least:g}", "n_changes": 0}
    text, changes = output, 0
    head, tail = common_ends(a, b)
    for op, *places in reversed(Matcher(b[head : len(b) - tail], a[head : len(a) - tail]).get_opcodes()):
        if op == "equal":
            continue
        i, j, k, m = (x + head for x in places)
        both = min(j - i, m - k) if op == "replace" else 0
        rest = a[k + both : m]
        for x in range(j - 1, i + both - 1, -1):  # words the source does not have
            _, start, end = have[x]
            end += text[end : end + 1] == " "
            text, changes = text[:start] + text[end:], changes + 1
        if rest:  # words the output lacks, after the last word that stays
            last = i + both - 1
            at = have[last][2] if last >= 0 else (have[0][1] if have else len(text))
            lead = " ".join(rest)
            text = text[:at] + (f" {lead}" if last >= 0 else f"{lead} ") + text[at:]
            changes += len(rest)
        for x in range(i + both - 1, i - 1, -1):
            _, start, end = have[x]
            text, changes = text[:start] + a[k + x - i] + text[end:], changes + 1
    done = [w for w, _, _ in positioned_words(text, chars)] == a
    return {"success": done, "text": text if done else output, "message": "repaired" if done else "the words still differ", "n_changes": changes if done else 0}


def word_repair(chars: str = "ऀ-ॿ", least: float = 85.0):
    """A vectorised function: (source, output) → struct of ``REPAIR``."""

    @F.pandas_udf(REPAIR)
    def repair(source: pd.Series, output: pd.Series) -> pd.DataFrame:
        rows = [{"success": False, "text": y, "message": "missing text", "n_changes": 0} if x is None or y is None else repair_words(x, y, chars, least) for x, y in zip(source, output)]
        return pd.DataFrame(rows, columns=["success", "text", "message", "n_changes"])

    return repair


def respaced(source: str, output: str, chars: str = "ऀ-ॿ") -> str:
    """``output`` with the source's white space between words, if just that differs within a line."""
    want, have = positioned_words(source, chars), positioned_words(output, chars)
    if [w for w, _, _ in want] != [w for w, _, _ in have]:
        return output
    text = output
    for k in range(len(have) - 1, 0, -1):
        gap, goal = output[have[k - 1][2] : have[k][1]], source[want[k - 1][2] : want[k][1]]
        if gap != goal and gap.isspace() and goal.isspace():
            text = text[: have[k - 1][2]] + goal + text[have[k][1] :]
    return text


def repair_if_better(pairs: DataFrame, chars: str = "ऀ-ॿ", least: float = 85.0, script: str | None = None) -> DataFrame:
    """Pairs (source_text, output_text) with ``final``: the repaired output if strictly fewer characters differ.

    ``before`` and ``after`` count the characters that a tidied difference of the words removes and adds (``edits.edit_counts``).
    """
    from ..functions.script import DEVANAGARI, script_text

    words = lambda c: script_text(c, script or DEVANAGARI)
    out = pairs.withColumn("repair", word_repair(chars, least)("source_text", "output_text"))
    out = out.withColumn("_b", edit_counts(words(F.col("source_text")), words(F.col("output_text")))).withColumn("_a", edit_counts(words(F.col("source_text")), words(F.col("repair.text"))))
    out = out.withColumn("before", F.col("_b.deleted") + F.col("_b.inserted")).withColumn("after", F.col("_a.deleted") + F.col("_a.inserted")).drop("_b", "_a")
    return out.withColumn("final", F.when(F.col("after") < F.col("before"), F.col("repair.text")).otherwise(F.col("output_text")))


RECORD = pa.struct([("seq", pa.int32()), ("op", pa.string()), ("before", pa.string()), ("after", pa.string()), ("position", pa.int32()), ("left", pa.string()), ("right", pa.string())])
RECORDS = "array<struct<seq:int,op:string,before:string,after:string,position:int,left:string,right:string>>"


def _difference_records(context: int, tidy: bool):
    """A vectorised function: (before, after) → the opcodes that are not equal, with their places among all and their neighbours' ends."""

    def rows(x: str, y: str) -> list[tuple]:
        ops = tidied(opcodes(x, y)) if tidy else opcodes(x, y)
        near = ["", *(op["before"] for op in ops), ""]
        return [(k, op["op"], op["before"], op["after"], op["position"], near[k][max(0, len(near[k]) - context) :], near[k + 2][:context]) for k, op in enumerate(ops) if op["op"] != "equal"]

    @F.arrow_udf(RECORDS)
    def find(a: pa.Array, b: pa.Array) -> pa.Array:
        at, sizes, flat = 0, [], []
        for x, y in zip(a, b):  # a pair at a time: a batch of texts is large
            x, y = x.as_py(), y.as_py()
            found = None if x is None or y is None else rows(x, y)
            sizes.append(None if found is None else at)
            at += len(found or ())
            flat += found or ()
        columns = zip(*flat) if flat else [()] * RECORD.num_fields
        values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RECORD)], fields=list(RECORD))
        return pa.ListArray.from_arrays(pa.array([*sizes, at], pa.int32()), values)

    return find


def diff_records(pairs: DataFrame, key: str, before: str, after: str, context: int = 40, tidy: bool = False) -> DataFrame:
    """(key, seq, type, whitespace_only, before, after, position, left, right) of every difference; ``tidy``: of the tidied ones.

    Positions are code points of ``before``; ``left`` and ``right`` are its neighbouring equal runs, cut to ``context``.
    """
    ops = pairs.select(key, F.explode(_difference_records(context, tidy)(before, after)).alias("d"))
    kind = F.when(F.col("d.op") == "replace", "REPLACEMENT").when(F.col("d.op") == "delete", "DELETION").otherwise("INSERTION")
    return ops.select(
        key, "d.seq", kind.alias("type"), F.concat("d.before", "d.after").rlike("(?U)^\\s*$").alias("whitespace_only"), "d.before", "d.after", "d.position", "d.left", "d.right"
    )


def _largest(bits: int, holds: Callable[[Column], Column]) -> Column:
    """The largest n from 0 to 2**bits - 1 for which ``holds``, which is true up to some n: a bit at a time."""
    powers = F.array(*[F.lit(1 << k) for k in range(bits - 1, -1, -1)])
    return F.aggregate(powers, F.lit(0), lambda n, p: F.when(holds(n + p), n + p).otherwise(n))


def first_difference(a: Column, b: Column) -> Column:
    """1-based place of the first character that differs; null for equal texts.

    The common prefix is halved in, by some thirty comparisons of prefixes.
    """
    common = _largest(30, lambda n: (n <= F.least(F.length(a), F.length(b))) & (F.left(a, n) == F.left(b, n)))
    return F.when(a != b, common + 1)


def original_index(text: Column, dropped: str, place: Column) -> Column:
    """1-based place in ``text`` of the ``place``-th character that a class of dropped ones leaves; null beyond the last."""
    kept = lambda n: F.length(F.regexp_replace(F.left(text, n), f"(?U)[{dropped}]", ""))
    before = _largest(30, lambda n: (n <= F.length(text)) & (kept(n) < place))
    return F.when((place >= 1) & (before < F.length(text)), before + 1)


def line_at(text: Column, place: Column) -> Column:
    """1-based number of the line that holds the 1-based ``place``."""
    return F.when(place.isNotNull(), F.size(F.split(F.left(text, place - 1), "\n")))


def context_at(text: Column, place: Column, around: int = 20) -> Column:
    """Up to ``around`` characters on either side of the 1-based ``place``, its own included."""
    return F.when(place.isNotNull(), F.substring(text, F.greatest(F.lit(1), place - around), F.least(place, F.lit(around + 1)) + around))
