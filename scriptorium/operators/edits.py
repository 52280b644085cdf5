"""Character differences fit for reading: a least edit script, tidied to whole words and counted.

A difference is kept as equal runs with edits between them; an edit removes a text, adds a text, or both.  The script is a longest
common subsequence found in linear space: one text is halved, bit-parallel rows of both halves tell where the other text is best cut,
and each part is done likewise.  Tidying then has four steps:

1. an equal run no longer than the edits on both of its sides (the longer of what each removes and adds) joins them;
2. what an edit removes and adds alike at its ends becomes equal, and an edit that only adds or only removes moves over an equal run
   that it repeats, so that two edits become one;
3. such an edit moves between its equal runs to where its ends cut best (``CUTS``), of equal places to the last;
4. where the end of what is removed is the beginning of what is added, or the other way round, over half of either, that becomes equal.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETE, INSERT, EQUAL = "delete", "insert", "equal"

#: How good a cut between two texts is, the best first.  Tested on the last character before and the first after it.
CUTS = (
    (6, "an end of the text"),
    (5, "a blank line"),
    (4, "a line break"),
    (3, "the end of a sentence: no letter or digit, then white space"),
    (2, "white space"),
    (1, "anything but letters and digits"),
    (0, "within a word"),
)
_BLANK_BEFORE, _BLANK_AFTER = re.compile(r"\n\r?\n$"), re.compile(r"^\r?\n\r?\n")


@dataclass
class Edit:
    """What is removed and added between two equal runs."""

    gone: str = ""
    new: str = ""

    def size(self) -> int:
        return max(len(self.gone), len(self.new))

    def joined(self, run: str, other: Edit) -> Edit:
        return Edit(self.gone + run + other.gone, self.new + run + other.new)


def _row(a: str, b: str) -> np.ndarray:
    """Length of the longest common subsequence of ``b`` and each prefix of ``a``, the empty one first."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        if u := row & places.get(ch, 0):
            row = (row + u | row - u) & full
    unset = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)] == 0
    return np.concatenate([[0], np.cumsum(unset)])


def script(a: str, b: str) -> list[tuple[str, str, str]]:
    """(equal, gone, new), one after the other: an equal run and the edit that follows it."""
    out: list[tuple[str, str, str]] = []
    work = [(a, b)]
    while work:
        a, b = work.pop()
        head = len(os.path.commonprefix([a, b]))
        same, a, b = a[:head], a[head:], b[head:]
        tail = len(os.path.commonprefix([a[::-1], b[::-1]]))
        end, a, b = a[len(a) - tail :], a[: len(a) - tail], b[: len(b) - tail]
        if end:
            work.append((end, end))
        if same:
            out.append((same, "", ""))
        if not a or not b:
            if a or b:
                out.append(("", a, b))
            continue
        swap = len(b) > len(a)  # a bit for each character of the longer, a step for each of the shorter
        long, short = (b, a) if swap else (a, b)
        half = (len(short) + 1) // 2
        gain = _row(long, short[:half]) + _row(long[::-1], short[half:][::-1])[::-1]
        cut = int(gain.argmax())
        if not gain[cut]:
            out.append(("", a, b))
            continue
        parts = [(long[:cut], short[:half]), (long[cut:], short[half:])]
        work += [(y, x) if swap else (x, y) for x, y in reversed(parts)]
    return out


class Difference:
    """``edits`` with ``runs`` between them: edit, run, edit, ..., run, edit; first and last edits may be empty."""

    def __init__(self, pieces: list[tuple[str, str, str]]):
        self.edits, self.runs = [Edit()], []
        for run, gone, new in pieces:
            self._push(run, Edit(gone, new))

    def _push(self, run: str, edit: Edit) -> None:
        """Add a run and the edit after it; runs and edits that meet become one."""
        last = self.edits[-1]
        if run and self.runs and not (last.gone or last.new):
            self.runs[-1] += run
            self.edits[-1] = edit
        elif run:
            self.runs.append(run)
            self.edits.append(edit)
        else:
            self.edits[-1] = last.joined("", edit)

    def _again(self) -> None:
        """Close up where runs or edits have become empty."""
        edits, runs = self.edits, self.runs
        self.edits, self.runs = [edits[0]], []
        for run, edit in zip(runs, edits[1:]):
            self._push(run, edit)

    def join_short_runs(self) -> None:
        edits, runs = [self.edits[0]], []
        for run, edit in zip(self.runs, self.edits[1:]):
            runs.append(run)
            edits.append(edit)
            while runs and len(runs[-1]) <= min(edits[-1].size(), edits[-2].size()):
                right, left = edits.pop(), edits.pop()
                edits.append(left.joined(runs.pop(), right))
        self.edits, self.runs = edits, runs

    def factor_ends(self) -> None:
        """What an edit removes and adds alike at either end goes to the runs around it."""
        pieces = [("", "", "")]
        for k, e in enumerate(self.edits):
            run = self.runs[k - 1] if k else ""
            head = len(os.path.commonprefix([e.gone, e.new]))
            gone, new = e.gone[head:], e.new[head:]
            tail = len(os.path.commonprefix([gone[::-1], new[::-1]]))
            pieces.append((run + e.gone[:head], gone[: len(gone) - tail], new[: len(new) - tail]))
            if tail:
                pieces.append((gone[len(gone) - tail :], "", ""))
        self.__init__(pieces)

    def _single(self, k: int) -> str | None:
        """The text of an edit that only removes or only adds and stands between two runs."""
        e = self.edits[k]
        return (e.gone or e.new) if 0 < k < len(self.runs) and bool(e.gone) != bool(e.new) else None

    def _set(self, k: int, text: str) -> None:
        self.edits[k] = Edit(text, "") if self.edits[k].gone else Edit("", text)

    def move_over_runs(self) -> None:
        moved = True
        while moved:
            moved, k = False, 1
            while k < len(self.runs):
                text = self._single(k)
                if text is not None:
                    left, right = self.runs[k - 1], self.runs[k]
                    if left and text.endswith(left):
                        self._set(k, left + text[: len(text) - len(left)])
                        self.runs[k - 1], self.runs[k], moved = "", left + right, True
                    elif right and text.startswith(right):
                        self._set(k, text[len(right) :] + right)
                        self.runs[k - 1], self.runs[k], moved = left + right, "", True
                k += 1
            if moved:
                self._again()
                self.factor_ends()

    def move_to_cuts(self) -> None:
        for k in range(1, len(self.runs)):
            text = self._single(k)
            if text is None:
                continue
            left, right = self.runs[k - 1], self.runs[k]
            back = len(os.path.commonprefix([left[::-1], text[::-1]]))
            whole = left + text + right
            start, size = len(left) - back, len(text)
            best, at = -1, start
            while True:
                value = cut_value(whole[:start], whole[start : start + size]) + cut_value(whole[start : start + size], whole[start + size :])
                if value >= best:
                    best, at = value, start
                if start + size >= len(whole) or whole[start] != whole[start + size]:
                    break
                start += 1
            self._set(k, whole[at : at + size])
            self.runs[k - 1], self.runs[k] = whole[:at], whole[at + size :]
        self._again()

    def split_overlaps(self) -> None:
        pieces = [("", "", "")]
        for k, e in enumerate(self.edits):
            run = self.runs[k - 1] if k else ""
            half = min(len(e.gone), len(e.new)) / 2
            forth, back = overlap(e.gone, e.new), overlap(e.new, e.gone)
            if e.gone and e.new and max(forth, back) >= half:
                if forth >= back:
                    pieces += [(run, e.gone[:-forth], ""), (e.new[:forth], "", e.new[forth:])]
                else:
                    pieces += [(run, "", e.new[:-back]), (e.gone[:back], e.gone[back:], "")]
            else:
                pieces.append((run, e.gone, e.new))
        self.__init__(pieces)

    def tidied(self) -> Difference:
        self.join_short_runs()
        self.factor_ends()
        self.move_over_runs()
        self.move_to_cuts()
        self.split_overlaps()
        return self

    def segments(self) -> list[tuple[str, str]]:
        """(op, text): removals before additions, equal runs between."""
        out = []
        for k, e in enumerate(self.edits):
            out += [(op, t) for op, t in ((DELETE, e.gone), (INSERT, e.new)) if t]
            if k < len(self.runs):
                out.append((EQUAL, self.runs[k]))
        return out


def cut_value(before: str, after: str) -> int:
    """How well two texts come apart between them (``CUTS``)."""
    if not before or not after:
        return 6
    x, y = before[-1], after[0]
    space_x, space_y = x.isspace(), y.isspace()
    break_x, break_y = x in "\r\n", y in "\r\n"
    if break_x and _BLANK_BEFORE.search(before[-3:]) or break_y and _BLANK_AFTER.match(after[:4]):
        return 5
    if break_x or break_y:
        return 4
    mark_x = not x.isalnum()
    if mark_x and not space_x and space_y:
        return 3
    if space_x or space_y:
        return 2
    return int(mark_x or not y.isalnum())


def overlap(a: str, b: str) -> int:
    """The length of the longest end of ``a`` that ``b`` begins with, in linear time."""
    n = min(len(a), len(b))
    if not n:
        return 0
    head, tail = b[:n], a[-n:]
    fail, k = [0] * n, 0
    for i in range(1, n):
        while k and head[i] != head[k]:
            k = fail[k - 1]
        k += head[i] == head[k]
        fail[i] = k
    k = 0
    for ch in tail:
        while k and (k == n or ch != head[k]):
            k = fail[k - 1]
        k += ch == head[k]
    return k


def difference(a: str, b: str) -> list[tuple[str, str]]:
    """(op, text) of everything that turns ``a`` into ``b``, tidied; equal runs included."""
    return Difference(script(a, b)).tidied().segments()


SEGMENTS = T.ArrayType(T.StructType().add("op", T.StringType()).add("text", T.StringType()).add("position", T.IntegerType()))
COUNTS = T.StructType().add("segments", T.IntegerType()).add("deleted", T.IntegerType()).add("inserted", T.IntegerType())


@F.pandas_udf(SEGMENTS)
def tidy_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    """The tidied difference of each pair; ``position``: code points of ``a`` before it.  Null if a side is null."""

    def rows(x: str, y: str) -> list[dict]:
        out, at = [], 0
        for op, text in difference(x, y):
            out.append({"op": op, "text": text, "position": at})
            at += 0 if op == INSERT else len(text)
        return out

    return pd.Series([None if x is None or y is None else rows(x, y) for x, y in zip(a, b)])


@F.pandas_udf(COUNTS)
def edit_counts(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """How many removals and additions the tidied difference has, and how many characters each; zero for a null side."""
    rows = []
    for x, y in zip(a, b):
        found = [] if x is None or y is None or x == y else [s for s in difference(x, y) if s[0] != EQUAL]
        rows.append((len(found), *(sum(len(t) for op, t in found if op == want) for want in (DELETE, INSERT))))
    return pd.DataFrame(rows, columns=["segments", "deleted", "inserted"])
