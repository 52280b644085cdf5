"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Documents become pieces of at most ``capacity`` tokens.  Best-fit decreasing looks only at
lengths, so the plan is made from the histogram of lengths, which has at most ``capacity`` entries
however large the corpus is: equal lengths are placed in runs, bins with equal contents form
ranges, and a segment tree over the remaining capacities finds the tightest open bin in
logarithmic time.  The plan equals that of placing the pieces one by one, longest first.

Scale.  Tokens never leave the task that made them: only lengths and checksums do.  Each piece is
numbered within its task and length; a running sum over tasks turns that into the piece's
rank among all of its length, and the plan maps the rank to a sequence and an offset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .shared import written

PIECE = 1 << 20


class CapacityTree:
    """A segment tree over remaining capacities 0..n: open bins of each, tightest fit in O(log n)."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.has = bytearray(2 * self.size)

    def set(self, capacity: int, open_bins: bool) -> None:
        i = self.size + capacity
        self.has[i] = open_bins
        while i > 1:
            i >>= 1
            self.has[i] = self.has[2 * i] | self.has[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open bin has."""
        i = self.size + least
        if self.has[i]:
            return least
        while i > 1:
            if not i & 1 and self.has[i + 1]:  # the right neighbour's subtree lies above
                i += 1
                while i < self.size:
                    i = 2 * i if self.has[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) of best-fit decreasing.

    A run places the pieces of ranks [first rank, first rank + count) of a length, one each, in
    sequences [first sequence, first sequence + count), all at the same offset.  The number of runs
    depends on ``capacity``, not on the number of pieces.
    """
    tree, ranges, bins, runs = CapacityTree(capacity), {}, 0, []

    def put(left: int, first: int, n: int) -> None:
        if n:
            ranges.setdefault(left, []).append((first, n))
            tree.set(left, True)

    def take(left: int, most: int) -> tuple[int, int]:
        first, n = ranges[left].pop()
        if n > most:
            ranges[left].append((first + most, n - most))
            n = most
        if not ranges[left]:
            del ranges[left]
            tree.set(left, False)
        return first, n

    for length in sorted((x for x in histogram if x > 0), reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            left = tree.tightest(length)
            if left is None:  # open as many bins as the rest fills
                fit = capacity // length
                put(capacity, bins, n := -(-(count - rank) // fit))
                bins += n
                continue
            fit, rest = left // length, count - rank
            # a bin that can hold the length twice is the tightest for the next piece too
            first, n = take(left, max(1, rest // fit))
            each = min(fit, rest)
            for k in range(each):
                runs.append((length, rank, n, first, capacity - left + k * length))
                rank += n
            put(left - each * length, first, n)
    if histogram.get(0):
        raise ValueError("a piece has at least one token")
    return runs


# ---------------------------------------------------------------- tokenising

#: Kinds of bytes: white space, letters, digits (each a token of its own), other ASCII, and bytes of other characters.
SPACE, LETTER, DIGIT, OTHER, WIDE = range(5)
_KIND = np.full(256, WIDE, np.uint8)
_KIND[:128] = [SPACE if c in K.SPACES else LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else OTHER for c in range(128)]
#: A-Z as a-z, and each white space as a space.
_FOLD = np.array([32 if c in K.SPACES else c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: Second bytes of U+00C0 to U+00FF (lead byte C3): letters, and their lower case.
_LATIN = np.array([chr(0xC0 + (c & 63)).isalpha() if 0x80 <= c < 0xC0 else False for c in range(256)])
_LATIN_FOLD = np.array([ord(chr(0xC0 + (c & 63)).lower()) - 0x40 if _LATIN[c] and chr(0xC0 + (c & 63)).lower() <= "\xff" else c for c in range(256)], np.uint8)

_N, _MOST = 28, (1 << 28) - 1


def segments(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(folded bytes, starts of segments) that cover all bytes; ids of a text are those of its segments in order.

    A segment is white space and then a run of letters, a digit, or a run of other ASCII characters, as the
    vocabulary's pattern cuts them.  Where the pattern or the normaliser looks further (characters
    beyond Latin-1 letters, an apostrophe, the start of a special token), the whole word is one segment, unfolded.
    """
    kind, low = _KIND[buf], _FOLD[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    after = buf[lead + 1]
    lead, after = lead[_LATIN[after]], after[_LATIN[after]]
    kind[lead] = kind[lead + 1] = LETTER
    low[lead + 1] = _LATIN_FOLD[after]
    new = np.empty(len(buf), bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[1:] |= kind[1:] == DIGIT
    new[1:] &= kind[:-1] != SPACE
    hard = kind == WIDE
    hard |= buf == 39
    hard[:-1] |= (buf[:-1] == 60) & (buf[1:] == 124)
    at = np.flatnonzero(hard)
    edges = offsets[:-1][np.diff(offsets) > 0]
    if len(at):  # no cut inside the words that hold them
        begin = np.unique(np.concatenate([[0], np.flatnonzero(kind == SPACE) + 1, edges]))
        k = np.unique(np.searchsorted(begin, at, "right") - 1)
        first, last = begin[k], np.append(begin, len(buf))[k + 1]
        last = last - (kind[last - 1] == SPACE)
        depth = np.zeros(len(buf) + 1, np.int8)
        depth[np.minimum(first + 1, len(buf))] += 1
        np.subtract.at(depth, last, 1)
        inner = np.cumsum(depth[:-1], dtype=np.int8) > 0
        new[inner] = False
        inner[first] = True
        low[inner] = buf[inner]  # special tokens are told by their case
    new[edges] = True
    return low, np.flatnonzero(new)


class WordTokenizer:
    """Token ids of whole texts, with a bounded memory of segments already seen.

    White space always ends a token in this vocabulary and is dropped, so the ids of a text are
    those of its segments in order.  Each distinct segment of a batch is looked up once, and encoded if it is new.  The ids of
    known ones lie in one table; an entry is a place there, times 2**28, plus the number of ids.  Beyond ``most``
    entries a new generation begins; what it meets again it takes over from the last one.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.known: dict[bytes, int] = {}
        self.table, self.used = np.empty(1 << 16, np.uint32), 0
        self._age()

    def _age(self) -> None:
        self.old, self.old_table = self.known, self.table
        self.known = {}
        self.table, self.used = np.empty(1 << 16, np.uint32), 0

    def _add(self, ids: list[int]) -> int:
        """The entry of new ids."""
        n = len(ids)
        while self.used + n > len(self.table):
            self.table = np.concatenate([self.table, np.empty(len(self.table), np.uint32)])
        self.table[self.used : self.used + n] = ids
        self.used += n
        return self.used - n << _N | n

    def _learn(self, new: list[bytes]) -> None:
        """Encode new segments; a run of printable ASCII is one input of the merges."""
        known, old, whole, tokenize = self.known, self.old, [], self.tokenizer.model.tokenize
        plain: list[int] = []
        for raw in new:
            # with and without a space before it a segment has the same ids
            entry = known.get(raw[1:] if raw[0] == 32 else b" " + raw)
            if entry is not None:
                known[raw] = entry
                continue
            entry = old.get(raw)
            if entry is not None:
                known[raw] = self.used + len(plain) << _N | entry & _MOST
                plain += self.old_table[entry >> _N : (entry >> _N) + (entry & _MOST)].tolist()
                continue
            text = raw.decode().lstrip(" ")
            if text.isascii() and text.isprintable() and "'" not in text and "<|" not in text:
                n = len(plain)
                if text:
                    plain += [t.id for t in tokenize(text)]
                known[raw] = self.used + n << _N | len(plain) - n
            else:
                whole.append((raw, text))
        self._add(plain)
        for (raw, _), e in zip(whole, self.tokenizer.encode_batch_fast([t for _, t in whole], add_special_tokens=False)):
            known[raw] = self._add(e.ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text)."""
        buf, offsets = K.buffers(texts)
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        low, starts = segments(buf, offsets)
        ends = np.append(starts, len(buf)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(low)]).dictionary_encode()
        if len(self.known) > self.most:
            self._age()
        held, at = K.buffers(coded.dictionary)
        raw, at = held.tobytes(), at.tolist()
        distinct = [raw[a:b] for a, b in zip(at, at[1:])]
        get = self.known.get
        self._learn([w for w in distinct if get(w) is None])
        entry = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        n = entry & _MOST
        ends = np.cumsum(n)
        place = np.repeat((entry >> _N) - (ends - n), n)
        place += np.arange(len(place))
        return self.table[place], np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]


def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker, which all its tasks share until it takes up another kind of map."""
    return K.kept(("word tokenizer", path), lambda: WordTokenizer(path))


_PIECE = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("tokens", pa.binary()), ("task", pa.int64()), ("nth", pa.int64())])
_PIECE_DDL = "id long, piece int, start long, length long, ids_crc32 long, tokens binary, task long, nth long"


def _cut(ids: np.ndarray, offsets: np.ndarray, capacity: int, end_id: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids with end tokens as bytes; each piece's row, number, first token in them, length)."""
    rows = len(offsets) - 1
    n = np.diff(offsets) + 1
    begin = offsets[:-1] + np.arange(rows)
    flat = np.full(len(ids) + rows, end_id, "<u4")
    flat[np.arange(len(ids)) + np.repeat(np.arange(rows), n - 1)] = ids
    k = -(-n // capacity)
    row = np.repeat(np.arange(rows), k)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
    return flat.tobytes(), row, piece, begin[row] + piece * capacity, np.minimum(capacity, n[row] - piece * capacity)


def _numbered(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length; ``seen`` (by length) goes on."""
    order = np.argsort(length, kind="stable")
    ordered = length[order]
    nth = np.empty(len(length), np.int64)
    nth[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
    seen += np.bincount(length, minlength=len(seen))
    return nth


def _tokenise(path: str, capacity: int, end_id: int, with_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = word_tokenizer(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for i, j in K.pieces(K.buffers(batch.column(1))[1], PIECE):
                part = batch.slice(i, j - i)
                raw, row, piece, begin, length = _cut(*tokenizer.encode(part.column(1)), capacity, end_id)
                view = memoryview(raw)
                spans = list(zip((4 * begin).tolist(), (4 * (begin + length)).tolist()))
                tokens = [raw[a:b] for a, b in spans] if with_tokens else None
                columns = [
                    part.column(0).take(pa.array(row)), piece.astype(np.int32), piece * capacity, length, np.fromiter((zlib.crc32(view[a:b]) for a, b in spans), np.int64, len(spans)),
                    pa.array(tokens, pa.binary()) if with_tokens else pa.nulls(len(row), pa.binary()), np.full(len(row), task), _numbered(length, seen),
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=_PIECE)

    return K.lean(run, keeps=True)


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, with_tokens: bool = False) -> DataFrame:
    """The pieces of every document: ids, then ``end_id``, cut every ``capacity`` tokens."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_tokenise(tokenizer_path, capacity, end_id, with_tokens), _PIECE_DDL)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, with_tokens: bool = False) -> DataFrame:
    """Pack all documents into sequences of ``capacity`` tokens by best-fit decreasing.

    Returns a row for each piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``, and ``tokens`` (little-endian unsigned 32-bit) if asked for.

    Defined cases: a null or empty text has the end token alone; only documents longer than
    ``capacity`` are cut, the last piece may be shorter; repeated rows are packed once each; null
    identifiers stay null; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = written(tokenised_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_tokens), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.withColumn("before", before).drop("n")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    runs = best_fit_plan(histogram, capacity)
    plan: dict[int, tuple[list, list, list]] = {}
    for length, rank, _, first, offset in runs:
        for column, x in zip(plan.setdefault(length, ([], [], [])), (rank, first, offset)):
            column.append(x)
    shared = spark.sparkContext.broadcast({k: tuple(np.array(c, np.int64) for c in v) for k, v in plan.items()})

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):  # noqa: ANN001, ANN202
        import pandas as pd

        lengths, ranks = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        for x in np.unique(lengths):
            at = np.flatnonzero(lengths == x)
            begin, first, start = shared.value[int(x)]
            k = np.searchsorted(begin, ranks[at], "right") - 1
            sequence[at], offset[at] = first[k] + ranks[at] - begin[k], start[k]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    columns = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "to.sequence_id", "to.offset", *["tokens"] * with_tokens]
    joined = cut.drop(*[] if with_tokens else ["tokens"]).join(ranked, ["task", "length"])
    return joined.withColumn("to", place("length", F.col("before") + F.col("nth"))).select(*columns)
