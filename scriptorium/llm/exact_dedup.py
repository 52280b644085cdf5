"""Exact deduplication by Patricia-trie owners.

Texts are dealt out by length and content hash; every partition inserts the full byte strings
into a compressed radix trie whose terminal nodes hold the smallest identifier seen (or the
largest, kept as its negative) and a count.  Two texts meet in a terminal node only if all
their bytes are equal, so hash collisions cannot merge them.

Scale.  A first trie runs in each input task as a combiner: it names one representative for
the equal texts of that task, so a group that holds a third of all rows reaches the shuffle
once for each task, and no task ever sees a row of it twice.  A trie that outgrows
``trie_bytes`` spills by subtree: the heaviest branch below the root leaves the trie, its
texts go to the next round's table in the shared folder, and that round uses more partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import groups_for, text_bytes, written

#: A-Z to a-z, all other bytes as they are.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving slices (bytes compare at memory speed)."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Node:
    """A radix-trie node: the edge label above it, children by first byte; owner, count and key if terminal."""

    __slots__ = ("label", "children", "owner", "count", "key")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.count, self.key = label, {}, None, 0, None


class RadixTrie:
    """Byte strings with the smallest owner and the number of rows of each."""

    def __init__(self) -> None:
        self.root, self.bytes, self.gone = Node(b""), 0, set()

    def insert(self, key: bytes, owner: int, count: int = 1) -> Node | None:
        """The terminal node of ``key``; None if its branch has been spilled."""
        node, i, n = self.root, 0, len(key)
        if n and key[0] in self.gone:
            return None
        while i < n:
            child = node.children.get(key[i])
            if child is None:
                child = node.children[key[i]] = Node(key[i:])
                self.bytes += n - i + 200
                node, i = child, n
            elif key.startswith(child.label, i):
                i += len(child.label)
                node = child
            else:
                k = common_prefix(child.label, key[i : i + len(child.label)])
                upper = Node(child.label[:k])
                upper.children[child.label[k]] = child
                node.children[key[i]] = upper
                child.label = child.label[k:]
                self.bytes += 200
                node, i = upper, i + k
        if node.key is None:
            node.key = key
            self.bytes += n
        node.owner = owner if node.owner is None else min(node.owner, owner)
        node.count += count
        return node

    def _branch_bytes(self, node: Node) -> tuple[int, int]:
        """Bytes and terminal nodes of a branch."""
        total, ends, todo = 0, 0, [node]
        while todo:
            x = todo.pop()
            total += len(x.label) + len(x.key or b"") + 200
            ends += x.owner is not None
            todo.extend(x.children.values())
        return total, ends

    def spill(self) -> set[int] | None:
        """Drop the heaviest branch below the root; the ids of its nodes, None if only one text is left."""
        sized = {b: self._branch_bytes(x) for b, x in self.root.children.items()}
        if sum(e for _, e in sized.values()) <= 1:
            return None
        first = max(sized, key=lambda b: sized[b][0])
        found, todo = set(), [self.root.children.pop(first)]
        while todo:
            x = todo.pop()
            found.add(id(x))
            todo.extend(x.children.values())
        self.gone.add(first)
        self.bytes -= sized[first][0]
        return found


_LOCAL = pa.schema([("id", pa.int64()), ("rep", pa.int64()), ("len", pa.int64()), ("hash", pa.int64()), ("sha", pa.binary()), ("n", pa.int64()), ("text", pa.binary())])
_LOCAL_DDL = "id long, rep long, len long, hash long, sha binary, n long, text binary"
_OWNER = pa.schema([("rep", pa.int64()), ("len", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()), ("owner", pa.int64()), ("size", pa.int64()), ("text", pa.binary())])
_OWNER_DDL = "rep long, len long, hash long, n long, owner long, size long, text binary"
#: Stands for a null identifier: it never owns a text that a row with an identifier has.
_NO_ID = (1 << 63) - 1


def _combine(sign: int, fold: bool, limit: int):
    """The combiner: rows of a task, each with its representative; a representative carries the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, rows = RadixTrie(), []

        def flush() -> Iterator[pa.RecordBatch]:
            known: dict[int, tuple[bytes, int]] = {}
            out: list[list] = [[] for _ in _LOCAL]
            size = 0
            for key, node in rows:
                text, first = node.key, id(node) not in known
                if first:
                    known[id(node)] = (hashlib.sha256(text).digest(), xxhash.xxh64_intdigest(text) - (1 << 63))
                    size += len(text)
                sha, h = known[id(node)]
                for column, x in zip(out, (sign * key if key != _NO_ID else None, node.owner, len(text), h, sha, node.count, text if first else None)):
                    column.append(x)
                if size > 4 << 20 or len(out[0]) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _LOCAL)], schema=_LOCAL)
                    out, size = [[] for _ in _LOCAL], 0
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _LOCAL)], schema=_LOCAL)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = _NO_ID if key is None else sign * key
                rows.append((key, trie.insert(text.translate(FOLD) if fold else text, key)))
            if trie.bytes > limit or len(rows) > 1_000_000:
                yield from flush()
                trie, rows = RadixTrie(), []
        yield from flush()

    return K.lean(run)


def _own(limit: int):
    """The owners: representatives of a partition's (length, hash) keys, through one trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, rows = RadixTrie(), []

        def emit(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [[] for _ in _OWNER]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OWNER)], schema=_OWNER)

        for batch in batches:
            later = []
            for rep, length, h, n, text in zip(*(c.to_pylist() for c in batch.columns)):
                node = trie.insert(text, rep, n)
                if node is None:
                    later.append((rep, length, h, n, None, None, text))
                else:
                    rows.append((rep, length, h, n, node))
            while trie.bytes > limit and (out := trie.spill()):
                later += [(*r[:4], None, None, r[4].key) for r in rows if id(r[4]) in out]
                rows = [r for r in rows if id(r[4]) not in out]
            if later:
                yield emit(later)
        for i in range(0, len(rows), 20_000):
            yield emit([(*r[:4], r[4].owner, r[4].count, None) for r in rows[i : i + 20_000]])

    return K.lean(run)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "first", fold_ascii_case: bool = True, trie_bytes: int = 96 << 20) -> DataFrame:
    """Owners of equal texts: one row for each row of ``docs``.

    Returns ``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (of the text as
    compared).  ``keep``: "first" keeps the smallest identifier of a group, "last" the largest.

    Defined cases: a null text equals the empty one; a null identifier owns a group only if all
    its rows have none (``keep_id`` null, ``kept`` true); rows that repeat identifier and text
    count separately in ``group_size`` and share the decision; other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    sign = 1 if keep == "first" else -1
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    local = written(rows.mapInArrow(_combine(sign, fold_ascii_case, trie_bytes // 2), _LOCAL_DDL), "exact-local")
    todo = local.where("text IS NOT NULL").select("rep", "len", "hash", "n", "text")
    parts = groups_for(text_bytes(todo, "text"), trie_bytes // 4)
    owners: DataFrame | None = None
    limit = trie_bytes
    while True:
        step = written(todo.repartition(max(parts, docs.sparkSession.sparkContext.defaultParallelism), "len", "hash").mapInArrow(_own(limit), _OWNER_DDL), "exact-owners")
        done = step.where("text IS NULL").select("rep", "len", "hash", "owner", "size")
        owners = done if owners is None else owners.unionByName(done)
        todo = step.where("text IS NOT NULL").select("rep", "len", "hash", "n", "text")
        if todo.isEmpty():
            break
        parts, limit = parts * 4, limit * 2
    owners = owners.groupBy("rep", "len", "hash").agg(F.min("owner").alias("owner"), F.max("size").alias("size"))
    joined = local.select("id", "rep", "len", "hash", "sha").join(owners, ["rep", "len", "hash"])
    keep_id = F.when(F.col("owner") != _NO_ID, F.col("owner") * sign)
    return joined.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
