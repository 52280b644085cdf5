"""Groups of documents that ask, in bounded messages, which of their keys also occur elsewhere.

Documents are dealt into groups of about ``GROUP_BYTES`` by a hash of identifier and
text (so that neither null nor repeated identifiers meet in one group), one shuffle that every pass over the texts reuses.  A pass tells each block of the key space which
keys its group has (each once, with a mark if the group alone has it twice); the block answers
every group with those of its keys that more than one occurrence has.  A key that a third of
all rows share is one entry for each group, never a row for each occurrence.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import U
from .shared import groups_for, text_bytes

GROUP_BYTES = 16 << 20
#: Cells of the count-min sketch in one block, as a power of two, at the least and at the most.
CELL_BITS, MOST_CELL_BITS = 22, 26
#: Counts stop here; 250 and two more still fit a byte.
SATURATED = 250
#: Bytes of text up to which groups and blocks have their least size.
SMALL = 64 << 30


def growth(total: int) -> float:
    """What messages would grow by, were groups and blocks as small as on SMALL bytes."""
    return max(1.0, total / SMALL)


def group_bytes(total: int) -> int:
    return int(GROUP_BYTES * min(4.0, growth(total) ** 0.25))


def cell_bits(blocks: int) -> int:
    """Bits of a cell's number within its block; ``blocks``: as many as there are of 2^CELL_BITS cells."""
    return min(MOST_CELL_BITS, CELL_BITS + int(math.log2(growth(blocks * 3 << CELL_BITS - 1)) / 2))

MESSAGE = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("g", pa.int32()), ("keys", pa.binary()), ("twice", pa.binary())])
MESSAGE_DDL = "kind int, block long, g int, keys binary, twice binary"
REPLY = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
REPLY_DDL = "g int, kind int, block long, payload binary"


def dealt(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(id, text as bytes, g), dealt out by group; and the bytes of all texts."""
    total = text_bytes(docs, text_col)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(groups_for(total, group_bytes(total)), min(parts, total >> 20))  # small inputs still use all cores
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.withColumn("g", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int")).repartition(max(n, parts), "g"), total


def pack(cells: np.ndarray) -> bytes:
    """Sorted distinct uint32 as byte planes of their gaps, which compress well."""
    gaps = np.diff(cells, prepend=np.uint32(0)).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def distinct(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, True where a key stands more than once) of sorted keys."""
    if not len(sorted_keys):
        return sorted_keys, np.zeros(0, bool)
    new = np.empty(len(sorted_keys), bool)
    new[0] = True
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:])
    at = np.flatnonzero(new)
    return sorted_keys[at], np.diff(at, append=len(sorted_keys)) > 1


def _cuts(blocks: np.ndarray) -> list[tuple[int, int, int]]:
    """(block, first, end) of each run of equal blocks, which are in ascending order."""
    first = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] + U(1)) if len(blocks) else blocks)
    return list(zip(blocks[first].tolist(), first.tolist(), [*first[1:].tolist(), len(blocks)]))


def cell_messages(h: np.ndarray, g: int, kind: int, blocks: int) -> list[tuple]:
    """The group's part of one row of the sketch, by block."""
    bits = U(cell_bits(blocks))
    keys, twice = distinct(np.sort(cells_of(h, kind, blocks)))
    low = (keys & (U(1) << bits) - U(1)).astype(np.uint32)
    return [(kind, b, g, pack(low[i:j]), np.packbits(twice[i:j]).tobytes()) for b, i, j in _cuts(keys >> bits)]


def cells_of(h: np.ndarray, kind: int, blocks: int) -> np.ndarray:
    """The cell of each key in row ``kind`` (0 or 1) of a sketch of ``blocks`` times 2^CELL_BITS cells."""
    h = h if kind == 0 else (h >> U(32)) | (h << U(32))
    return (h * U(0xD6E8FEB86659FD93) >> U(20)) % U(blocks << CELL_BITS)


def merge_cells(blocks: int, hot: int = SATURATED):
    """One block of the merged sketch: counts by cell, saturated at SATURATED; answers each group.

    Besides the cells that count two or more, each group hears (as kind 10 or 11) which of its cells count ``hot`` or more.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        count = np.zeros(1 << cell_bits(blocks), np.uint8)
        rows = []
        for g, raw, twice in zip(table["g"].to_pylist(), table["keys"].to_pylist(), table["twice"].to_pylist()):
            cells = unpack(raw)
            more = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(cells))
            count[cells] = np.minimum(count[cells] + 1 + more, SATURATED)
            rows.append((g, cells))
        kind, block = (x.as_py() for x in key)
        out = []
        for first, mark in ((kind, count >= 2), (kind + 10, count >= hot)):
            if mark.any():
                out += [(g, first, block, pack(hit)) for g, cells in rows if len(hit := cells[mark[cells]])]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, REPLY)], schema=REPLY)

    return run


class HotKeys:
    """Which keys are hot: a function of the whole sketch, so that every group that has a key says the same of it."""

    def __init__(self, replies: pa.Table, blocks: int):
        self.blocks = blocks
        cells: list[list[np.ndarray]] = [[], []]
        for kind, block, raw in zip(replies["kind"].to_pylist(), replies["block"].to_pylist(), replies["payload"].to_pylist()):
            if kind >= 10:
                cells[kind - 10].append(unpack(raw).astype(U) + U(block << cell_bits(blocks)))
        self.cells = [np.concatenate(c) if c else np.zeros(0, U) for c in cells]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(self.cells[0]) or not len(self.cells[1]):
            return np.zeros(len(h), bool)
        return np.isin(cells_of(h, 0, self.blocks), self.cells[0]) & np.isin(cells_of(h, 1, self.blocks), self.cells[1])


class CellFilter:
    """Which keys of a group the sketch takes for repeated: never false for one that is."""

    BITS = 25

    def __init__(self, replies: pa.Table, blocks: int):
        self.blocks = blocks
        self.masks = [np.zeros(1 << self.BITS, bool) for _ in range(2)]
        for kind, block, raw in zip(replies["kind"].to_pylist(), replies["block"].to_pylist(), replies["payload"].to_pylist()):
            if kind < 2:
                cells = unpack(raw).astype(U) + U(block << cell_bits(blocks))
                self.masks[kind][cells & U((1 << self.BITS) - 1)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        low = U((1 << self.BITS) - 1)
        hit = self.masks[0][cells_of(h, 0, self.blocks) & low]
        at = np.flatnonzero(hit)
        hit[at] = self.masks[1][cells_of(h[at], 1, self.blocks) & low]
        return hit


def pair_sort(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Order by (hi, lo)."""
    order = np.argsort(hi, kind="stable")
    a = hi[order]
    same = np.flatnonzero(a[1:] == a[:-1])
    if len(same) and (lo[order[same]] != lo[order[same + 1]]).any():
        return np.lexsort((lo, hi))
    return order


def distinct_pairs(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hi, lo) of the distinct pairs in order, their counts, and each pair's place among them."""
    order = pair_sort(hi, lo)
    a, b = hi[order], lo[order]
    new = np.ones(len(a), bool)
    if len(a):
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    return a[at], b[at], np.diff(at, append=len(a)), place


def pair_messages(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, g: int, blocks: int, kind: int = 2) -> list[tuple]:
    """The group's distinct 128-bit keys, by block; ``n``: their counts in the group."""
    return [(kind, b, g, np.concatenate([hi[i:j], lo[i:j]]).tobytes(), np.packbits(n[i:j] > 1).tobytes()) for b, i, j in pair_cuts(hi, blocks)]


def pair_cuts(hi: np.ndarray, blocks: int) -> list[tuple[int, int, int]]:
    """Blocks are even ranges of ``hi``; those that have a key."""
    return _cuts((hi >> U(32)) * U(blocks) >> U(32))


def merge_pairs(key: tuple, table: pa.Table) -> pa.Table:
    """``grouped_pairs`` of kind 2."""
    return grouped_pairs(key, table, 2)


def grouped_pairs(key: tuple, table: pa.Table, kind: int) -> pa.Table:
    """Exact grouping of a block's keys; answers each group with a bit for each of its keys.  ``key`` ends in the block."""
    his, los, twice, groups = [], [], [], table["g"].to_pylist()
    for raw, bits in zip(table["keys"].to_pylist(), table["twice"].to_pylist()):
        both = np.frombuffer(raw, U)
        n = len(both) // 2
        his.append(both[:n])
        los.append(both[n:])
        twice.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool))
    _, _, counts, place = distinct_pairs(np.concatenate(his), np.concatenate(los))
    repeated = counts > 1
    repeated[place[np.concatenate(twice)]] = True
    ends = np.cumsum([0, *map(len, his)])
    block = key[-1].as_py()
    out = [(g, kind, block, np.packbits(repeated[place[i:j]]).tobytes()) for g, i, j in zip(groups, ends[:-1], ends[1:])]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), REPLY)], schema=REPLY)


def pair_answers(hi: np.ndarray, replies: pa.Table, blocks: int, of: int = 2) -> np.ndarray:
    """True for each of the group's distinct keys (sorted as in ``distinct_pairs``) that repeats; ``of``: the replies' kind."""
    out = np.zeros(len(hi), bool)
    bits = {b: raw for kind, b, raw in zip(replies["kind"].to_pylist(), replies["block"].to_pylist(), replies["payload"].to_pylist()) if kind == of}
    for b, i, j in pair_cuts(hi, blocks):
        out[i:j] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=j - i).astype(bool)
    return out


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    """Rows as an Arrow table; also of none."""
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)
