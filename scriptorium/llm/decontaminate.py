"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Pass 1 counts, over all documents, how many contain each word n-gram of the benchmark.  Each item keeps
as seeds its n-grams of least document frequency (``SEED_SHARE`` of them; a rank within the item, not
a cut-off, so an item that a third of all documents contain keeps seeds too).  Pass 2 joins passages
to items by seed, aligns the words around the seeds with the item (local alignment: match +2,
mismatch and gap -1), and returns pairs whose score reaches ``threshold`` of the item's own.  A passage with too few of the
item's words for that is not aligned, so an opening that many items share costs one look at words for each, and no alignment.

Scale.  The benchmark is a stated query set: it goes to the tasks in blocks of ``block_words`` words, so
what is broadcast is bounded, and every block is searched in all documents.  Both passes are maps over
the texts; only counts by n-gram and the result pairs are shuffled.  Alignments run where the text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .kernels import U
from .shared import row_key, written

PIECE = 1 << 19
SEED_SHARE = 0.6
_SEED = 0x93C467E37DB0C7A5
#: Letters, digits and all bytes of other scripts make words; A-Z count as a-z.
IN_WORD = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(best local score, one past the passage word at which it ends) of two sequences of word hashes.

    One row for each item word: the gap along the passage is a running maximum.
    """
    slope = np.arange(len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for w in item:
        new = np.maximum(row - 1, 0)
        np.maximum(new[1:], row[:-1] + np.where(passage == w, 2, -1), out=new[1:])
        row = np.maximum.accumulate(new + slope) - slope
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


class Items:
    """A block of benchmark items: word hashes, and the places of their n-grams."""

    def __init__(self, rows: list[tuple[int, str]], n: int):
        self.n, self.ids, self.words = n, [], []
        grams: dict[int, list[tuple[int, int]]] = {}
        for item_id, text in rows:
            buf = np.frombuffer(text.encode(), np.uint8)
            starts, ends, _ = K.words(buf, np.array([0, len(buf)]), IN_WORD)
            h = K.word_hashes(buf, starts, ends, fold=True)
            at = len(self.ids)
            self.ids.append(item_id)
            self.words.append(h)
            for o, g in enumerate(K.windows(h, n, _SEED).tolist()):
                grams.setdefault(g, []).append((at, o))
        self.grams = np.array(sorted(grams), U)
        self.places = [grams[g] for g in self.grams.tolist()]

    def keep(self, frequency: dict[int, int]) -> None:
        """Only each item's n-grams of least document frequency stay as seeds."""
        of_item: list[list[tuple[int, int, int]]] = [[] for _ in self.ids]
        for k, places in enumerate(self.places):
            for at, o in places:
                of_item[at].append((frequency.get(int(self.grams[k]), 0), k, o))
        chosen = set()
        for at, found in enumerate(of_item):
            chosen.update((k, at, o) for _, k, o in sorted(found)[: max(8, round(SEED_SHARE * len(found)))])
        places: dict[int, list[tuple[int, int]]] = {}
        for k, at_o in enumerate(self.places):
            mine = [(at, o) for at, o in at_o if (k, at, o) in chosen]
            if mine:
                places[k] = mine
        order = sorted(places)
        self.grams, self.places = self.grams[order], [places[k] for k in order]

    def hits(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, first word of each row, places with a gram, which gram, which row)."""
        starts, ends, first = K.words(buf, offsets, IN_WORD)
        h = K.word_hashes(buf, starts, ends, fold=True)
        g = K.windows(h, self.n, _SEED)
        if not len(g) or not len(self.grams):
            none = np.zeros(0, np.int64)
            return h, first, none, none, none
        bits = 22
        table = np.zeros(1 << bits, bool)
        table[self.grams >> U(64 - bits)] = True
        at = np.flatnonzero(table[g >> U(64 - bits)])
        k = np.minimum(np.searchsorted(self.grams, g[at]), len(self.grams) - 1)
        real = self.grams[k] == g[at]
        at, k = at[real], k[real]
        row = np.searchsorted(first, at, "right") - 1
        inside = at + self.n <= first[row + 1]
        return h, first, at[inside], k[inside], row[inside]


_COUNT_DDL = "gram long, n long"
_LINK = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("n_seeds", pa.int64()), ("end_word", pa.int64())])
_LINK_DDL = "id long, item_id long, score double, n_seeds long, end_word long"


def _frequencies(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = items.value
        count = np.zeros(len(own.grams), np.int64)
        for batch in batches:
            buf, offsets = K.buffers(batch.column(1))
            for i, j in K.pieces(offsets, PIECE):
                at = offsets[i : j + 1]
                *_, k, row = own.hits(buf[at[0] : at[-1]], at - at[0])
                if len(k):
                    once = np.unique(row * np.int64(len(own.grams)) + k)
                    count += np.bincount(once % len(own.grams), minlength=len(own.grams))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(own.grams[some].view(np.int64)), pa.array(count[some])], names=["gram", "n"])

    return K.lean(run)


def _align(items, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = items.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            buf, offsets = K.buffers(batch.column(1))
            out = []
            for i, j in K.pieces(offsets, PIECE):
                at = offsets[i : j + 1]
                h, first, places, grams, rows = own.hits(buf[at[0] : at[-1]], at - at[0])
                found: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for p, k, r in zip(places.tolist(), grams.tolist(), rows.tolist()):
                    for item, o in own.places[k]:
                        found.setdefault((r, item), []).append((p, o))
                for (r, item), hit in found.items():
                    words = own.words[item]
                    n, lo, hi = len(words), int(first[r]), int(first[r + 1])
                    best, end = 0, 0
                    hit.sort()
                    spans: list[list[int]] = []
                    for p, o in hit:  # passages that may hold the item around each seed
                        a, b = max(lo, p - o - n // 2 - 2), min(hi, p - o + n + n // 2 + 2)
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(b, spans[-1][1])
                        else:
                            spans.append([a, b])
                    for a, b in spans:
                        if 2 * int(np.isin(words, h[a:b]).sum()) < threshold * 2 * n:
                            continue  # no alignment has more matches than the passage has of the item's words
                        score, stop = smith_waterman(words, h[a:b])
                        if score > best:
                            best, end = score, a - lo + stop
                    if best >= threshold * 2 * n:
                        out.append((ids[i + r], own.ids[item], best / (2 * n), len(hit), end))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, _LINK)], schema=_LINK)

    return K.lean(run)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_words`` words, streamed through the driver."""
    rows, size = [], 0
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct().orderBy("item", "text")
    for r in items.toLocalIterator():
        rows.append((r["item"], r["text"]))
        size += r["text"].count(" ") + 1
        if size >= block_words:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", seed_words: int = 3, threshold: float = 0.4, block_words: int = 500_000) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds a copy, also an edited one.

    Returns ``id_col``, ``item_id``, ``score`` (alignment score over the item's own, ``threshold`` to 1),
    ``n_seeds`` and ``end_word`` (one past the last aligned word of the document): one row for each pair, its best
    passage.  Words are runs of letters, digits and non-ASCII characters, A-Z as a-z.

    Defined cases: null and empty texts match nothing; an item with fewer words than a seed has
    no seed and matches nothing; repeated documents or items give one row for each distinct pair of
    identifiers; a null identifier stays null; other columns are ignored; an empty table on either
    side gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    links = spark.createDataFrame([], _LINK_DDL)
    for block in _blocks(benchmark, item_col, item_text_col, block_words):
        items = Items(block, seed_words)
        all_grams = spark.sparkContext.broadcast(items)
        counts = rows.mapInArrow(_frequencies(all_grams), _COUNT_DDL).groupBy("gram").agg(F.sum("n").alias("n"))
        frequency = {r["gram"] % (1 << 64): r["n"] for r in counts.toLocalIterator()}  # at most one row for each n-gram of the block
        items.keep(frequency)
        found = rows.mapInArrow(_align(spark.sparkContext.broadcast(items), threshold), _LINK_DDL)
        links = links.unionByName(written(found, "links"))
    best = F.max(F.struct("score", "n_seeds", "end_word"))
    return links.groupBy("id", "item_id").agg(best.alias("b")).select(F.col("id").alias(id_col), "item_id", "b.score", "b.n_seeds", "b.end_word")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a copy of a benchmark item; all columns stay as they are.

    Rows are told apart by identifier and text, so null and repeated identifiers do no harm to clean rows.

    Defined cases: null and empty texts hold nothing and stay; a text of any length is searched whole; repeated rows share their
    decision; null, empty, repeated and very short items do nothing more; columns of any name stay; an empty table on either side changes nothing.
    """
    key = "_row"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    hit = contamination(keyed, benchmark, key, text_col, **options).select(key).distinct()
    return keyed.join(hit, key, "left_anti").select(*docs.columns)
