"""Removal of repeated word windows, with a count-min prefilter.

Pass 1 sketches: each group of documents counts its windows in a count-min sketch (two rows,
counters saturated at two) whose width grows with the corpus, and sends each block of the
sketch its non-empty cells.  Blocks merge the groups' sketches by cell and answer with the cells
that were counted twice or more; collisions only overestimate, so no repeated window is lost.
Pass 2 takes the windows whose cells all repeat and groups just these, one by one, by two 64-bit hashes of
their word sequences from different word values and bases (among n windows, two different ones share both with
a probability of about n**2 / 2**129: 1e-13 for the 1e13 windows of 100 TB).  Pass 3 removes the words that repeated windows cover.

Scale.  Texts are shuffled once (by document); the sketch costs about one compressed byte for a
window and row, the exact grouping sixteen for each distinct candidate of a group.  A window that
a third of all documents share is one entry for each group.  Nothing is broadcast or collected.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from . import routed as R
from .kernels import U
from .shared import groups_for

PIECE = 2 << 20
_B1, _B2 = 0x9E6C63D0876A9A47, 0xC2B2AE3D27D4EB4F
_LANE = U(0x165667B19E3779F9)
_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.binary())])
_OUT_DDL = "id long, n_words long, n_removed long, kept_text binary"


class _Windows:
    """The windows of a group's documents: pieces of rows, word places, window keys."""

    def __init__(self, table: pa.Table, width: int):
        self.width = width
        self.buf, self.offsets = K.buffers(table["text"])
        self.pieces = K.pieces(self.offsets, PIECE)

    def piece(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word starts, ends, first word of each row, word hashes, places at which a window starts)."""
        at = self.offsets[i : j + 1]
        buf = self.buf[at[0] : at[-1]]
        starts, ends, first = K.words(buf, at - at[0])
        h = K.word_hashes(buf, starts, ends)
        n = max(0, len(h) - self.width + 1)
        return starts, ends, first, h, np.flatnonzero(K.inside_rows(first, self.width, len(h))[:n])

    def keys(self, h: np.ndarray, places: np.ndarray) -> np.ndarray:
        return K.windows(h, self.width, _B1)[places] if len(places) else np.zeros(0, U)

    def lane(self, h: np.ndarray, places: np.ndarray) -> np.ndarray:
        return K.windows(K.mix(h ^ _LANE), self.width, _B2)[places] if len(places) else np.zeros(0, U)

    def candidates(self, maybe: R.CellFilter):
        """Each piece with its candidate places and their keys."""
        for i, j in self.pieces:
            starts, ends, first, h, places = self.piece(i, j)
            key = self.keys(h, places)
            hit = maybe(key)
            places = places[hit]
            yield i, j, starts, ends, first, places, key[hit], self.lane(h, places)


def _sketch(width: int, blocks: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        w, g = _Windows(table, width), key[0].as_py()
        found = []
        for i, j in w.pieces:
            *_, h, places = w.piece(i, j)
            found.append(w.keys(h, places))
        h = np.concatenate(found) if found else np.zeros(0, U)
        return R.table_of([m for kind in (0, 1) for m in R.cell_messages(h, g, kind, blocks)], R.MESSAGE)

    return run


def _candidates(width: int, blocks: int, exact_blocks: int):
    def run(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return R.table_of([], R.MESSAGE)
        his, los = [], []
        for *_, hi, lo in _Windows(table, width).candidates(R.CellFilter(replies, blocks)):
            his.append(hi)
            los.append(lo)
        hi, lo, n, _ = R.distinct_pairs(np.concatenate(his), np.concatenate(los))
        return R.table_of(R.pair_messages(hi, lo, n, key[0].as_py(), exact_blocks), R.MESSAGE)

    return run


def _remove(width: int, blocks: int, exact_blocks: int):
    def run(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return R.table_of([], _OUT)
        w = _Windows(table, width)
        parts = list(w.candidates(R.CellFilter(replies, blocks)))
        his, los = np.concatenate([p[6] for p in parts]), np.concatenate([p[7] for p in parts])
        hi, _, _, place = R.distinct_pairs(his, los)
        repeated = R.pair_answers(hi, replies, exact_blocks)[place]
        ids, out, done = table["id"].to_pylist(), [], 0
        for i, j, starts, ends, first, places, hit, _ in parts:
            gone = K.covered(places[repeated[done : done + len(hit)]], width, len(starts))
            done += len(hit)
            base = w.offsets[i]
            before = np.concatenate([[0], np.cumsum(gone)])
            for k in range(i, j):
                a, b = int(first[k - i]), int(first[k - i + 1])
                text = w.buf[w.offsets[k] : w.offsets[k + 1]].tobytes().split()
                n = int(before[b] - before[a])
                if n:
                    text = compress(text, (~gone[a:b]).tolist())
                out.append((ids[k], b - a, n, b" ".join(text)))
        return R.table_of(out, _OUT)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that also starts anywhere else.

    Words are maximal runs without space, tab, line feed, vertical tab, form feed or carriage
    return, compared as they are.  Returns ``id_col``, ``n_words``, ``n_removed`` and ``kept_text``:
    the words left, joined by one space.

    Defined cases: a null text is an empty one (no words, empty ``kept_text``); a document with
    fewer words than ``window`` loses none; windows that overlap their own repetition count; rows
    that repeat a text, or a whole row, repeat all its windows; null identifiers are kept as
    null; other columns are ignored; an empty table gives an empty result.
    """
    if window < 1:
        raise ValueError("window counts words, from 1")
    rows, total = R.dealt(docs, id_col, text_col)
    blocks = groups_for(total * 2 // 3, 1 << R.CELL_BITS)  # four cells for a window of six-byte words
    exact_blocks = groups_for(total // 6, 4 << 20)
    asked = rows.groupBy("g").applyInArrow(_sketch(window, blocks), R.MESSAGE_DDL)
    maybe = asked.groupBy("kind", "block").applyInArrow(R.merge_cells(blocks), R.REPLY_DDL)
    asked = rows.groupBy("g").cogroup(maybe.groupBy("g")).applyInArrow(_candidates(window, blocks, exact_blocks), R.MESSAGE_DDL)
    sure = asked.groupBy("block").applyInArrow(R.merge_pairs, R.REPLY_DDL)
    out = rows.groupBy("g").cogroup(maybe.unionByName(sure).groupBy("g")).applyInArrow(_remove(window, blocks, exact_blocks), _OUT_DDL)
    return out.selectExpr(f"id AS `{id_col}`", "n_words", "n_removed", "CAST(kept_text AS STRING) AS kept_text")
