"""MinHash near-duplicates with odd sketches.

Signatures.  Bands of four MinHash values find candidates; their number follows from the threshold,
so that a pair just at it is missed with a probability of at most ``MISS``.  One-permutation MinHash
samples (the least shingle hash of each of 1,024 bins) are folded into a bitmap of 2,048 parities, an odd
sketch.  The XOR of two sketches counts the samples that differ, precisely for similar sets; as there are
at most half as many samples as bits, it tells unlike sets of any size apart.  Candidates
whose count lies more than six standard deviations above that of the threshold are dropped; all others
are confirmed on their full shingle sets.

Candidates without all pairs of a group.  Equal sets (by SHA-256 of the whole set) form a class first, through one aggregation.
(1) Each bucket's smallest class is compared with the others of the bucket: one pair for each
member.  Components of the confirmed links follow.  (2) Only buckets that still hold more than one
component are searched further: members of the largest component meet all others, and these one
another, in blocks of bounded size, by sketch; pairs within a component need no check, as their
connection is known.  Blocks confirm their candidates on the full sets themselves and return only links
that join components, so no table of pairs is made.  So every pair that shares a bucket is either confirmed, refuted, or
already connected, and no partner or candidate is capped.

Scale.  The corpus is read once for signatures (some 550 bytes a document) and once for the
sets of candidate documents; everything else handles signatures, class numbers and pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import connected_components
from .kernels import U
from .shared import dropped, in_tasks_of, written

ROWS, MISS, BIN_BITS, BITS = 4, 1e-5, 10, 2048
BINS = 1 << BIN_BITS
PIECE = 1 << 19
BLOCK = 1024
#: Rows that a task writes: of numbers, with signatures, with sets.
NUMBERS, SIGNED, SETS = 200_000, 8192, 4096
_SHINGLE = 0x8CB92BA72F3D8DD7


def bands_for(threshold: float) -> int:
    """Bands of ROWS values after which a pair just at ``threshold`` is missed at most by MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def sketch_limit(na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """The largest XOR count of two odd sketches of sets at ``threshold``, with six deviations to spare.

    Of the union's elements, those that one set alone has are ``share``; the union's samples are drawn without
    replacement, one a bin.  A sample that one set alone has flips its own bit, and that of the
    other set's sample if its bin is not empty there.  Flips that meet in a bit cancel.
    """
    total = na + nb
    differ = total * (1 - threshold) / (1 + threshold)
    union = (total + differ) / 2
    share = differ / union
    samples = BINS * (1 - np.exp(-union / BINS))
    own = samples * share
    own = np.minimum(differ, own + 6 * np.sqrt(own * (1 - share) * np.maximum(0, 1 - samples / union)) + 1)
    both = 1 - np.exp(-union / BINS)
    flips = np.minimum(own * (1 + both) + 6 * np.sqrt(own * both * (1 - both)) + 2, 2 * differ)
    folded = BITS / 2 * (1 - np.exp(-2 * flips / BITS)) + 6 * flips / np.sqrt(BITS / 2)
    return np.minimum(flips, folded)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted in each row; where each row's begin, and the end)."""
    starts, ends, first = K.words(buf, offsets)
    h = K.word_hashes(buf, starts, ends, fold=True)
    w = K.windows(h, width, _SHINGLE)
    sets, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a >= width:
            one = np.unique(w[a : b - width + 1])
        elif b > a:
            one = K.windows(h[a:b], b - a, _SHINGLE) ^ U(b - a)
        else:
            continue
        sets.append(one)
        sizes[i] = len(one)
    return np.concatenate(sets) if sets else np.zeros(0, U), np.concatenate([[0], np.cumsum(sizes)])


_SIGNATURE_DDL = "id long, text_key long, n long, digest binary, bands array<long>, sketch binary"


def _digest(one: np.ndarray) -> bytes:
    return hashlib.sha256(one.tobytes()).digest()


def _signatures(width: int, bands: int):
    rng = np.random.default_rng(20240229)
    seeds = rng.integers(0, 1 << 64, (2, bands * ROWS), dtype=U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = K.buffers(batch.column(2))
            for i, j in K.pieces(offsets, PIECE):
                at = offsets[i : j + 1]
                d, ends = shingle_sets(buf[at[0] : at[-1]], at - at[0], width)
                n = np.diff(ends)
                some = np.flatnonzero(n)
                begin = ends[:-1][some]
                row = np.repeat(np.arange(len(some)), n[some])
                keys = np.zeros((j - i, bands), U)
                parity = np.zeros((j - i, BITS // 8), np.uint8)
                if len(some):
                    least = np.empty((bands * ROWS, len(some)), U)
                    for k in range(bands * ROWS):
                        least[k] = np.minimum.reduceat((d ^ seeds[0, k]) * (seeds[1, k] | U(1)), begin)
                    for k in range(bands):
                        key = np.full(len(some), U(k))
                        for r in range(ROWS):
                            key = K.mix(key * U(0xD6E8FEB86659FD93) ^ least[k * ROWS + r])
                        keys[some, k] = key
                    bins = d >> U(64 - BIN_BITS)
                    sample = np.ones(len(d), bool)
                    sample[1:] = (bins[1:] != bins[:-1]) | (row[1:] != row[:-1])
                    bit = (K.mix(d[sample]) & U(BITS - 1)).astype(np.int64)
                    odd = np.bincount(row[sample] * BITS + bit, minlength=len(some) * BITS) & 1
                    parity[some] = np.packbits(odd.reshape(-1, BITS).astype(np.uint8), axis=1)
                flat = pa.array(keys.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * bands, bands, dtype=np.int32)), flat)
                digests = [_digest(d[x:y]) for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(n), pa.array(digests, pa.binary()), lists, pa.array([r.tobytes() for r in parity], pa.binary())],
                    names=["id", "text_key", "n", "digest", "bands", "sketch"],
                )

    return K.lean(run)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = K.buffers(batch.column(0))
            for i, j in K.pieces(offsets, PIECE):
                at = offsets[i : j + 1]
                d, ends = shingle_sets(buf[at[0] : at[-1]], at - at[0], width)
                sets = [d[a:b] for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([_digest(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["digest", "set"])

    return K.lean(run)


def _similar_sketches(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), U).reshape(-1, BITS // 64) for c in ("sa", "sb"))
            count = np.bitwise_count(x ^ y).sum(axis=1)
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            yield batch.filter(pa.array(count <= sketch_limit(na, nb, threshold))).select(["a", "b"])

    return K.lean(run)


def _linked(x: np.ndarray, y: np.ndarray, least: Fraction) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # two sorted runs: a merge
    common = int((both[1:] == both[:-1]).sum())
    return least.denominator * common >= least.numerator * (len(both) - common)


def _confirm(threshold: float):
    least = Fraction(str(threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_linked(np.frombuffer(x, U), np.frombuffer(y, U), least) for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return K.lean(run)


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_MEMBER_DDL = "bucket long, to_main boolean, i long, j long, c long, component long, n long, sketch binary, bands array<long>, side int"


class _Block:
    """The members of one block of a bucket; candidates between its two sides (side 0 alone: among themselves).

    A pair is a candidate only in the first bucket that its two sides share, if they are of two components
    and their sketches are near enough.
    """

    def __init__(self, key: tuple, table: pa.Table, threshold: float):
        self.bucket, self.threshold = key[0].as_py(), threshold
        self.ids, self.component, self.n = (table[c].to_numpy() for c in ("c", "component", "n"))
        self.sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), U).reshape(-1, BITS // 64)
        self.bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(self.ids), -1)
        side = table["side"].to_numpy()
        self.left = np.flatnonzero(side == 0)
        self.right = np.flatnonzero(side == 1) if (side == 1).any() else self.left

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of candidate pairs, the nearest first, some left members at a time."""
        right = self.right
        for at in range(0, len(self.left), 16):
            x = self.left[at : at + 16]
            far = self.component[x][:, None] != self.component[right][None, :]
            count = np.bitwise_count(self.sketch[x][:, None, :] ^ self.sketch[right][None, :, :]).sum(axis=2)
            p, q = np.nonzero(far & (count <= sketch_limit(self.n[x][:, None], self.n[right][None, :], self.threshold)))
            shared = self.bands[x][p] == self.bands[right][q]
            first = self.bands[x][p, shared.argmax(axis=1)] == self.bucket
            p, q = p[first], q[first]
            order = np.argsort(count[p, q], kind="stable")
            yield x[p[order]], right[q[order]]


def _with_candidates(threshold: float):
    """The members of a block that are in any candidate pair."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(key, table, threshold)
        wanted = np.zeros(len(block.ids), bool)
        for p, q in block.candidates():
            wanted[p] = wanted[q] = True
        return table.select([c.split()[0] for c in _MEMBER_DDL.split(", ")]).filter(pa.array(wanted))

    return run


def _block_links(threshold: float):
    """Links that join components of a block, confirmed on full sets; none between what is joined already."""
    least = Fraction(str(threshold))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(key, table, threshold)
        sets = [np.frombuffer(x, U) for x in table["set"].to_pylist()]
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        out = []
        for ps, qs in block.candidates():
            for p, q in zip(ps.tolist(), qs.tolist()):
                x, y = find(int(block.component[p])), find(int(block.component[q]))
                if x != y and _linked(sets[p], sets[q], least):
                    parent[max(x, y)] = min(x, y)
                    out.append((int(block.ids[p]), int(block.ids[q])))
        columns = list(zip(*out)) if out else [[], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=_PAIRS)

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, threshold: float = 0.8) -> DataFrame:
    """Near-duplicate components of word-shingle sets with Jaccard similarity of ``threshold`` or more.

    Words are runs without space and \\t \\n \\v \\f \\r, with A-Z lower-cased; a document with fewer words than a
    shingle has its whole sequence as the one shingle.  Returns ``id_col``, ``n_shingles``, ``component_id``
    (the smallest identifier reachable over links, its own included) and ``kept`` (it is that one).

    Defined cases: a null, empty or blank text has no shingles and is linked with nothing; rows that
    share an identifier are one document with several texts, whose links all count; a row with a null identifier takes
    part, but never names a component (a component of such rows alone has a null name); other columns are ignored; an empty table
    gives an empty result.
    """
    if not 0.5 <= threshold <= 1:
        raise ValueError("threshold is from 0.5 to 1")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.select("id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    signatures = rows.mapInArrow(_signatures(shingle_words, bands_for(threshold)), _SIGNATURE_DDL)
    signed = written(signatures.withColumn("row", F.monotonically_increasing_id()), "signatures")
    full = signed.where("n > 0")
    classes = full.groupBy("digest").agg(F.min("id").alias("least"), F.min("row").alias("row"))
    classes = written(in_tasks_of(classes, signed.count(), NUMBERS).withColumn("c", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    reps = signed.join(classes.select("row", "c"), "row").select("c", "id", "text_key", "digest", "n", "bands", "sketch")
    reps = written(in_tasks_of(reps, n, SIGNED), "representatives")
    placed = reps.select("c", F.explode("bands").alias("bucket"))
    buckets = placed.groupBy("bucket").agg(F.min("c").alias("leader"), F.count("*").alias("size")).where("size > 1")
    buckets = written(in_tasks_of(buckets, n * bands_for(threshold), NUMBERS), "buckets")
    members = written(in_tasks_of(placed.join(buckets, "bucket"), n * bands_for(threshold), NUMBERS), "members")
    confirm_on = _Confirmation(rows, reps, shingle_words, threshold)

    pairs = members.where("c > leader").select(F.col("c").alias("a"), F.col("leader").alias("b")).distinct()
    links = confirm_on(pairs).unionByName(_of_one_identifier(full, classes))
    found = connected_components(links, "a", "b")
    # buckets that still hold more than one component
    inside = members.where("size > 2").join(found.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    parts = inside.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    largest = parts.groupBy("bucket").agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.sum("k").alias("all"), F.max("k").alias("most")).where("most < all")
    largest = written(in_tasks_of(largest, buckets.count(), NUMBERS), "mixed-buckets")  # a table, so that the join below can split a hot bucket
    known = reps.select("c", "n", "sketch", "bands")
    mixed = inside.select("bucket", "c", "component").join(largest, "bucket").join(known, "c")
    main_blocks, rest_blocks = F.ceil(F.col("most") / BLOCK), F.ceil((F.col("all") - F.col("most")) / BLOCK)
    at = F.xxhash64("c")
    is_main = F.col("component") == F.col("main")
    mixed = mixed.withColumn("mine", F.when(is_main, F.pmod(at, main_blocks)).otherwise(F.pmod(at, rest_blocks)).cast("long"))
    columns = ["bucket", "c", "component", "n", "sketch", "bands"]
    with_main = mixed.select(
        *columns,
        F.when(is_main, 1).otherwise(0).alias("side"),
        F.lit(True).alias("to_main"),
        "mine",
        F.explode(F.when(is_main, F.sequence(F.lit(0).cast("long"), rest_blocks - 1)).otherwise(F.sequence(F.lit(0).cast("long"), main_blocks - 1))).alias("other"),
    ).select(*columns, "side", "to_main", F.when(F.col("side") == 0, F.col("mine")).otherwise(F.col("other")).alias("i"), F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("mine")).alias("j"))
    rest = mixed.where(~is_main & (F.col("all") - F.col("most") > 1)).select(*columns, "mine", F.explode(F.sequence(F.lit(0).cast("long"), rest_blocks - 1)).alias("other"))
    among = rest.select(*columns, F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"), F.lit(False).alias("to_main"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    block = ["bucket", "to_main", "i", "j"]
    near = with_main.unionByName(among).groupBy(*block).applyInArrow(_with_candidates(threshold), _MEMBER_DDL)
    near = written(near, "near")
    if not near.isEmpty():
        sets = confirm_on.sets(near.select("c").distinct())
        late = written(near.join(sets, "c").groupBy(*block).applyInArrow(_block_links(threshold), "a long, b long"), "late")
        if not late.isEmpty():
            found = connected_components(links.unionByName(late), "a", "b")
        dropped(sets, late)
    dropped(near, largest, members, buckets, reps)

    of_class = classes.select("c", "digest", "least").join(found.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    names = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    named = full.select("id", "n", "digest").join(of_class.join(names, "component").select("digest", "component_id"), "digest").drop("digest")
    alone = signed.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    out = named.unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _of_one_identifier(full: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between the classes of an identifier that has several texts."""
    key = F.xxhash64("digest")
    repeated = full.where("id IS NOT NULL").groupBy("id").agg(F.min(key).alias("x"), F.max(key).alias("y")).where("x <> y").select("id")
    each = full.join(repeated, "id").select("id", "digest").distinct().join(classes.select("digest", "c"), "digest").select("id", "c")
    least = each.groupBy("id").agg(F.min("c").alias("b"))
    return written(each.join(least, "id").where("c > b").select(F.col("c").alias("a"), "b").distinct(), "same-identifier")


class _Confirmation:
    """Links among candidate pairs: odd sketches first, then the full sets of those that pass."""

    def __init__(self, rows: DataFrame, reps: DataFrame, width: int, threshold: float):
        self.rows, self.reps, self.width, self.threshold = rows, reps, width, threshold

    def __call__(self, pairs: DataFrame) -> DataFrame:
        k, t = self.reps, self.threshold
        both = pairs.join(k.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
        both = both.join(k.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
        both = both.where(F.least("na", "nb") >= F.greatest("na", "nb") * (t - 1e-9))
        likely = written(both.mapInArrow(_similar_sketches(t), "a long, b long"), "likely")
        if likely.isEmpty():
            return likely
        sets = self.sets(likely.select(F.col("a").alias("c")).unionByName(likely.select(F.col("b").alias("c"))).distinct())
        full = likely.join(sets.select(F.col("c").alias("a"), F.col("set").alias("xa")), "a").join(sets.select(F.col("c").alias("b"), F.col("set").alias("xb")), "b")
        out = written(in_tasks_of(full, likely.count(), SETS).mapInArrow(_confirm(t), "a long, b long"), "confirmed")
        dropped(likely, sets)
        return out

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(c, set) of the wanted classes, from the texts of their representatives."""
        wanted = written(in_tasks_of(wanted, self.reps.count(), NUMBERS), "wanted")
        asked = self.reps.join(wanted, "c").select("c", "id", "text_key", "digest")
        by_row = asked.select(F.coalesce("id", F.lit(0)).alias("_id"), "text_key").distinct()
        some = self.rows.withColumn("_id", F.coalesce("id", F.lit(0))).join(by_row.hint("merge"), ["_id", "text_key"], "left_semi").select("text")
        found = some.mapInArrow(_sets(self.width), "digest binary, set binary").dropDuplicates(["digest"])
        out = found.join(asked.select("c", "digest"), "digest").select("c", "set")
        out = written(in_tasks_of(out, wanted.count(), SETS), "sets")
        dropped(wanted)
        return out
