"""Exact centroid clustering of quantised vectors.

Components become whole numbers, so distances, sums and means are exact and equal in any order and on any
number of tasks.  Distances to all centroids of a block of vectors are one matrix product,
|x|^2 - 2 x.c + |c|^2 in float64: as long as (number of components) * (largest |x| + largest |c|)^2 is below 2^53, every
partial sum is a whole number that float64 holds exactly.  Vectors beyond that bound are computed in 64-bit whole
numbers, and those beyond 2^62 in whole numbers of any size, row by row.

Scale.  Vectors are gathered into blocks in one pass and written to the shared folder as they came (the bytes of
their components); each round reads the blocks.  A round's sums and counts are combined by ``treeAggregate``, whose messages
have the size of the centroids; no vector is shuffled.  The driver gets one such message a round and never a vector,
but for the first centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Vectors in a block.
BLOCK = 4096
FLOAT_EXACT, INT_EXACT = 1 << 53, 1 << 62
LONG = 1 << 63


def quantised(raw: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component as float64, where that is finite; infinite entries are left to ``whole``."""
    with np.errstate(over="ignore"):
        return np.floor(raw.astype(np.float64) * scale)


def whole(row: np.ndarray, scale: int) -> list[int]:
    """As ``quantised``, in whole numbers of any size, for components too large to be multiplied as float64."""
    return [int(np.floor(float(x) * scale)) if abs(float(x)) < 1e300 else int(float(x)) * scale for x in row]


class Centroids:
    """Centroids as whole numbers, with what each way of computing distances needs of them."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        self.largest = max((abs(v) for r in rows for v in r), default=0)
        fits = self.largest < LONG
        self.as_int = np.array(rows, np.int64) if fits else None
        self.as_float = self.as_int.astype(np.float64) if fits else None
        self.norms = (self.as_float * self.as_float).sum(axis=1) if fits else None

    def nearest(self, x: np.ndarray, raw: np.ndarray, scale: int) -> tuple[np.ndarray, list[int]]:
        """(number of the nearest centroid, squared distance) of each row; of equally near ones the smaller number."""
        cluster = np.zeros(len(x), np.int64)
        width = x.shape[1]
        most = np.minimum(np.abs(x).max(axis=1, initial=0), 1e150)
        bound = width * (most + float(min(self.largest, 10**150))) ** 2  # rounded, hence the thousandth of room below
        by_float = bound < FLOAT_EXACT * 0.999
        by_int = ~by_float & (bound < INT_EXACT * 0.999)
        found = np.zeros(len(x), object)
        if by_float.any():
            some = x[by_float]
            d = (some * some).sum(axis=1)[:, None] - 2 * (some @ self.as_float.T) + self.norms
            k = d.argmin(axis=1)
            cluster[by_float] = k
            found[by_float] = d[np.arange(len(k)), k].astype(np.int64)
        if by_int.any():
            some = x[by_int].astype(np.int64)
            d = np.stack([((some - c) ** 2).sum(axis=1) for c in self.as_int], axis=1)
            k = d.argmin(axis=1)
            cluster[by_int] = k
            found[by_int] = d[np.arange(len(k)), k]
        for i in np.flatnonzero(~by_float & ~by_int).tolist():
            v = whole(raw[i], scale)
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in self.rows]
            cluster[i] = d.index(min(d))
            found[i] = min(d)
        return cluster, found.tolist()

    def digest(self, k: int) -> str:
        return hashlib.sha256(",".join(map(str, self.rows[k])).encode()).hexdigest()


def _summed(x: np.ndarray, raw: np.ndarray, scale: int, cluster: np.ndarray, n: int) -> np.ndarray:
    """Componentwise sums of each cluster's rows, whole numbers of any size."""
    out = np.zeros((n, x.shape[1]), object)
    most = np.abs(x).max(axis=1, initial=0)
    small = most * len(x) < FLOAT_EXACT * 0.999
    member = np.zeros((n, int(small.sum())))
    member[cluster[small], np.arange(member.shape[1])] = 1
    out += (member @ x[small]).astype(np.int64)
    for i in np.flatnonzero(~small).tolist():
        out[cluster[i]] += np.array(whole(raw[i], scale), object)
    return out


def _blocks(kind: str):
    """Rows (id, vector) → blocks (ids, which of them are null, components as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids = part.column(0)
                vectors = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind)
                columns = [ids.fill_null(0).to_numpy().astype("<i8").tobytes(), np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(), vectors.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["ids", "none", "vectors"])

    return run


def _matrix(raw: bytes, kind: str, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(quantised, as stored)"""
    stored = np.frombuffer(raw, kind).reshape(-1, width)
    return quantised(stored, scale), stored


class _Round:
    """Counts, sums and distances of clusters over blocks, for ``treeAggregate``."""

    def __init__(self, centroids: Centroids, kind: str, width: int, scale: int, sums: bool):
        self.centroids, self.kind, self.width, self.scale, self.sums = centroids, kind, width, scale, sums

    def zero(self) -> tuple:
        n = len(self.centroids.rows)
        return [0] * n, [0] * n, np.zeros((n, self.width), object)

    def add(self, total: tuple, block) -> tuple:
        counts, inertia, sums = total
        x, raw = _matrix(block[0], self.kind, self.width, self.scale)
        cluster, distance = self.centroids.nearest(x, raw, self.scale)
        n = len(counts)
        if self.sums:
            sums = sums + _summed(x, raw, self.scale, cluster, n)
        here = [0] * n
        for k, d in zip(cluster.tolist(), distance):
            here[k] += d
        return [a + int(b) for a, b in zip(counts, np.bincount(cluster, minlength=n))], [a + b for a, b in zip(inertia, here)], sums

    @staticmethod
    def merge(a: tuple, b: tuple) -> tuple:
        return [x + y for x, y in zip(a[0], b[0])], [x + y for x, y in zip(a[1], b[1])], a[2] + b[2]


_OUT_DDL = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _long(v: int) -> int | None:
    return v if v < LONG else None


def _assign(centroids: Centroids, inertia: list[int], kind: str, width: int, scale: int):
    digests = [centroids.digest(k) for k in range(len(centroids.rows))]
    of_cluster, total = [_long(v) for v in inertia], _long(sum(inertia))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, none, vectors in zip(*(batch.column(c).to_pylist() for c in range(3))):
                x, raw = _matrix(vectors, kind, width, scale)
                cluster, distance = centroids.nearest(x, raw, scale)
                missing = np.unpackbits(np.frombuffer(none, np.uint8), count=len(x)).astype(bool)
                k = cluster.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(ids, "<i8"), mask=missing),
                        pa.array(cluster.astype(np.int32)),
                        pa.array([_long(d) for d in distance], pa.int64()),
                        pa.array([of_cluster[c] for c in k], pa.int64()),
                        pa.array([total] * len(k), pa.int64()),
                        pa.array([digests[c] for c in k], pa.string()),
                    ],
                    names=[c.split()[0] for c in _OUT_DDL.split(", ")],
                )

    return run


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """Lloyd's clustering of vectors whose components become floor(``scale`` * x).

    Kept are vectors of exactly ``width`` components, none null, NaN or infinite.  The first centroids are the ``k`` of them with
    the smallest SHA-256 of ``seed:identifier``, in that order.  Each round assigns every vector to its nearest centroid (of
    equally near ones that of the smaller number), and replaces each centroid that has vectors by the floor of their
    mean.  Then vectors are assigned once more.  Returns ``id_col``, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia`` (distances summed over the cluster and over all) and ``centroid_sha256`` (of the centroid's components,
    joined by commas).

    Defined cases: a null vector, or one of another length or with a component that is no finite number, gets no
    row; rows that share an identifier are vectors of their own, each with a row, and among such candidates for a first
    centroid the smaller vector comes first; a null identifier stays null and becomes a first centroid only where
    fewer than ``k`` others are; with fewer than ``k`` vectors there are as many centroids as vectors; distances and sums
    that a long cannot hold are null; other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector_col].dataType.elementType.typeName()
    kind = "<f4" if element == "float" else "<f8"
    v = F.col(vector_col) if element in ("float", "double") else F.col(vector_col).cast("array<double>")
    infinite = float("inf")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    kept = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where((F.size("v") == width) & finite)
    blocks = written(kept.mapInArrow(_blocks(kind), "ids binary, none binary, vectors binary"), "vector-blocks")
    first = kept.select("v", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], _OUT_DDL).withColumnRenamed("id", id_col)
    centroids = Centroids([whole(np.array(r["v"], kind), scale) for r in first])
    matrices = blocks.select("vectors").rdd
    for turn in range(rounds + 1):
        step = _Round(centroids, kind, width, scale, turn < rounds)
        counts, inertia, sums = matrices.treeAggregate(step.zero(), step.add, step.merge)
        if turn < rounds:
            centroids = Centroids([[int(s) // n for s in sums[c]] if n else centroids.rows[c] for c, n in enumerate(counts)])
    return blocks.mapInArrow(_assign(centroids, inertia, kind, width, scale), _OUT_DDL).withColumnRenamed("id", id_col)
