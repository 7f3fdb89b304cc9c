"""Exact k-means on integers by delta Lloyd rounds.

Vectors with their owner and distance are a table in the shared folder, replaced in each round. A round compares a
vector with the centroids that changed since the last one, and with all of them only if its own centroid moved; what is
known of an unmoved owner stands. Vectors that change owners are signed transfers: their components leave the sums of the
old cluster and join those of the new one, added up in each task before they are moved. The global sums (clusters times
components) are all that the driver holds, and are written as a table too.

Integer arithmetic is exact: products are taken in doubles where all results stay below 2**53, else in 64-bit integers.

Defined results: vectors of another length, null ones, and such with a null, NaN or infinite component are left out.
Components beyond 2**27 after scaling are an error, since squared distances would leave 64 bits. Ties go to the smaller
cluster number. Rows that repeat an id are vectors of their own; among equal ids the start is ordered by components. A null id
counts as the empty text. With fewer vectors than clusters each is a start; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remove, written

LARGEST = 1 << 27
STATE = "i {id}, v array<int>, old int, cluster int, distance long"


def integers(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """i and v: the kept vectors as integers floor(scale * x)."""
    x = F.col(vec_col)
    usable = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    fits = F.forall(x, lambda c: F.abs(c.cast("double") * scale) <= LARGEST)
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit("a component is too large for exact distances of 64 bits")))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("i"), checked.cast("array<int>").alias("v"))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows, exactly."""
    if x.shape[1] * (2 * max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) + 1) ** 2 < 1 << 53:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def assign(x: np.ndarray, owner: np.ndarray, known: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New owners and distances: against changed centroids, and against all where the owner itself has moved (or is none, -1)."""
    lost = (owner < 0) | changed[owner]
    best, least = owner.copy(), known.copy()
    for rows, against in ((np.flatnonzero(lost), np.arange(len(centroids))), (np.flatnonzero(~lost), np.flatnonzero(changed))):
        if not len(rows) or not len(against):
            continue
        d = distances(x[rows], centroids[against])
        k = d.argmin(axis=1)  # the first of equal ones: the smallest number
        d, k = d[np.arange(len(rows)), k], against[k]
        better = (best[rows] < 0) | changed[best[rows]] | (d < least[rows]) | ((d == least[rows]) & (k < best[rows]))
        best[rows[better]], least[rows[better]] = k[better], d[better]
    return best, least


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def one_round(state: DataFrame, centroids: np.ndarray, changed: np.ndarray, dims: int) -> DataFrame:
    """The state after an assignment; old: the owner before it."""

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            owner = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
            known = batch.column("distance").to_numpy(zero_copy_only=False).astype(np.int64)
            best, least = assign(_matrix(batch.column("v"), dims), owner, known, centroids, changed)
            yield pa.record_batch([batch.column("i"), batch.column("v"), batch.column("cluster"), pa.array(best, pa.int32()), pa.array(least, pa.int64())], names=["i", "v", "old", "cluster", "distance"])

    schema = STATE.format(id=state.schema["i"].dataType.simpleString())
    return state.select("i", "v", "cluster", "distance").mapInArrow(assigned, schema)


def transfers(state: DataFrame, dims: int, k: int) -> DataFrame:
    """(cluster, pos, delta): signed sums of what moved; pos -1 counts vectors."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        rows = 0
        for batch in batches:
            x = np.concatenate([np.ones((len(batch), 1), np.int64), _matrix(batch.column("v"), dims)], axis=1)
            for name, sign in (("old", -1), ("cluster", 1)):
                c = batch.column(name).to_numpy(zero_copy_only=False)
                order = np.argsort(c, kind="stable")[np.count_nonzero(c < 0) :]
                if len(order):
                    clusters, first = np.unique(c[order], return_index=True)
                    total[clusters] += sign * np.add.reduceat(x[order], first, axis=0)
            rows += len(batch)
            if rows > 1 << 30:  # components are at most 2**27: the sums stay in 64 bits
                yield from rows_of(total)
                total[:], rows = 0, 0
        yield from rows_of(total)

    def rows_of(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        c, p = np.nonzero(total)
        yield pa.record_batch([pa.array(c, pa.int32()), pa.array(p - 1, pa.int32()), pa.array(total[c, p], pa.int64())], names=["cluster", "pos", "delta"])

    moved = state.where("old != cluster").select("v", "old", "cluster").mapInArrow(summed, "cluster int, pos int, delta long")
    return moved.groupBy("cluster", "pos").agg(F.sum(F.col("delta").cast("decimal(38,0)")).alias("delta"))


def first_centroids(kept: DataFrame, k: int, seed: str) -> list[list[int]]:
    """k vectors at most: those whose id has the smallest hash."""
    name = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("i").cast("string"), F.lit(""))), 256)
    return [list(r.v) for r in kept.select(name.alias("name"), "v").orderBy("name", "v").limit(k).collect()]


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2:", id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every kept vector after ``rounds`` updates and a last assignment, and the k centroids."""
    spark: SparkSession = vectors.sparkSession
    kept = integers(vectors, dims, scale, id_col, vec_col)
    state = written(kept.select("i", "v", F.lit(-1).alias("old"), F.lit(-1).alias("cluster"), F.lit(0).cast("long").alias("distance")), "vectors")
    centroids = first_centroids(state, k, seed)
    changed = np.ones(len(centroids), bool)
    sums = [[0] * (dims + 1) for _ in centroids]  # of each cluster: its size, and its components' sums
    for turn in range(rounds + 1):
        if not changed.any():
            break
        new = written(one_round(state, np.array(centroids, np.int64).reshape(-1, dims), changed, dims), "vectors")
        remove(spark, state)
        state = new
        if turn == rounds:
            break
        signed = written(transfers(state, dims, len(centroids)), "transfers")
        for r in signed.collect():  # clusters times components at most
            sums[r.cluster][r.pos + 1] += int(r.delta)
        remove(spark, signed)
        after = [[s // n for s in rest] if n else old for (n, *rest), old in zip(sums, centroids, strict=True)]
        changed = np.array([a != b for a, b in zip(after, centroids, strict=True)], bool)
        centroids = after
    return state.select(F.col("i").alias(id_col), "cluster", "distance"), centroids
