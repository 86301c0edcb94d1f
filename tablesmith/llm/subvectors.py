"""Centroid clustering over subvector dictionaries, in exact integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import saved, stage_table
from tablesmith.llm.topk import floored, usable

#: Components of a block; vectors whose blocks share dictionaries.
BLOCK, CHUNK_ROWS = 2, 16_384
#: Largest absolute component for which a squared distance of 64 components fits in a long.
LARGEST = 1 << 27

CHUNKS = "ids array<bigint>, sizes array<int>, words array<bigint>, codes array<int>"


class Dictionaries:
    """Vectors of one chunk without loss: per block of components its distinct subvectors, and each vector's codes."""

    def __init__(self, words: list[np.ndarray], codes: list[np.ndarray]):
        self.words, self.codes = words, codes

    @classmethod
    def of(cls, vectors: np.ndarray, block: int) -> Dictionaries:
        found = [np.unique(vectors[:, at:at + block], axis=0, return_inverse=True)
                 for at in range(0, vectors.shape[1], block)]
        return cls([w for w, _ in found], [c.reshape(-1) for _, c in found])

    def vectors(self) -> np.ndarray:
        """The vectors back."""
        return np.concatenate([w[c] for w, c in zip(self.words, self.codes)], axis=1)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distances (vector, centroid): each distinct subvector's are computed once, then summed by code."""
        out = np.zeros((len(self.codes[0]), len(centroids)), dtype=np.int64)
        at = 0
        for words, codes in zip(self.words, self.codes):
            part = centroids[:, at:at + words.shape[1]]
            out += sum((words[:, j, None] - part[None, :, j]) ** 2 for j in range(words.shape[1]))[codes]
            at += words.shape[1]
        return out

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Component sums (cluster, component): subvectors are counted by code and cluster, then weighed."""
        out = []
        for words, codes in zip(self.words, self.codes):
            times = np.bincount(cluster * len(words) + codes, minlength=k * len(words)).reshape(k, len(words))
            out.append(times @ words)
        return np.concatenate(out, axis=1)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, width)


def dictionary_chunks(vectors: DataFrame, dimensions: int, block: int, chunk_rows: int) -> DataFrame:
    """CHUNKS rows: ``vectors(vec_id, vector)``, dealt evenly, encoded once in chunks of about ``chunk_rows``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append((batch.column("vec_id").to_pylist(), _matrix(batch.column("vector"), dimensions)))
            n += batch.num_rows
            if n >= chunk_rows:
                yield row(held)
                held, n = [], 0
        if n:
            yield row(held)

    def row(held: list) -> pa.RecordBatch:
        coded = Dictionaries.of(np.concatenate([m for _, m in held]), block)
        return pa.RecordBatch.from_pydict({
            "ids": pa.array([[i for ids, _ in held for i in ids]], pa.list_(pa.int64())),
            "sizes": pa.array([[len(w) for w in coded.words]], pa.list_(pa.int32())),
            "words": pa.array([np.concatenate([w.reshape(-1) for w in coded.words])], pa.list_(pa.int64())),
            "codes": pa.array([np.concatenate(coded.codes).astype(np.int32)], pa.list_(pa.int32()))})

    tasks = max(1, -(-vectors.count() // chunk_rows), vectors.sparkSession.sparkContext.defaultParallelism)
    # a checkpoint is read back row by row, so that a task holds a few chunks at a time
    return saved(vectors.select("vec_id", "vector").repartition(tasks).mapInArrow(encode, CHUNKS))


def _decoded(batch: pa.RecordBatch, dimensions: int, block: int) -> Iterator[tuple[list, Dictionaries]]:
    widths = [min(block, dimensions - at) for at in range(0, dimensions, block)]
    for ids, sizes, words, codes in zip(*(batch.column(c) for c in ("ids", "sizes", "words", "codes"))):
        sizes, words, codes = (np.asarray(x.values) for x in (sizes, words, codes))
        cuts = np.cumsum([s * w for s, w in zip(sizes, widths)])[:-1]
        yield ids.as_py(), Dictionaries([w.reshape(-1, d) for w, d in zip(np.split(words, cuts), widths)],
                                        np.split(codes.astype(np.int64), len(widths)))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``salt`` and vec_id, in that order (null vec_id last; rows with
    the same vec_id by their components); all, if there are fewer."""
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(F.asc_nulls_last(order), "vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], dtype=np.int64)


def clusters(vectors: DataFrame, dimensions: int, k: int, rounds: int, salt: str, block: int = BLOCK,
             chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)``, one row per row of ``vectors(vec_id, vector)``, and the final centroids.

    ``vector`` has exactly ``dimensions`` longs, each at most LARGEST in size (a larger one is an error: its squared
    distance would not fit). Each round assigns every vector to the nearest centroid by squared distance (ties: the
    smaller number) and replaces the centroids that have vectors by their exact floored means. A round is one job:
    centroids go to the chunks, a row of sums per chunk and cluster comes back and is summed by Spark; only
    k x dimensions numbers reach the driver. Repeated rows each count; no rows give no rows and no centroids.
    """
    size = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    checked = F.when(size <= LARGEST, F.col("vector")).otherwise(
        F.raise_error(F.lit(f"a component is larger than {LARGEST}")).cast("array<bigint>"))
    chunks = dictionary_chunks(vectors.select("vec_id", checked.alias("vector")), dimensions, block, chunk_rows)
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    for _ in range(rounds):
        centroids = _moved(chunks, centroids, block)
    return _assigned(chunks, centroids, block), centroids


def _moved(chunks: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    k, dimensions = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, coded in _decoded(batch, dimensions, block):
                cluster = coded.distances(centroids).argmin(axis=1)
                sums = coded.sums(cluster, k)
                yield pa.RecordBatch.from_pydict({
                    "cluster": pa.array(np.arange(k, dtype=np.int32)), "n": pa.array(np.bincount(cluster, minlength=k)),
                    "sums": pa.array(list(sums), pa.list_(pa.int64()))})

    parts = chunks.mapInArrow(partial, "cluster int, n bigint, sums array<bigint>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[
        F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(dimensions)])
    new = centroids.copy()
    for r in total.filter("n > 0").collect():
        new[r["cluster"]] = [r[f"s{j}"] // r["n"] for j in range(dimensions)]
    return new


def _assigned(chunks: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    dimensions = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, coded in _decoded(batch, dimensions, block):
                distances = coded.distances(centroids)
                cluster = distances.argmin(axis=1)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": pa.array(ids, pa.int64()), "cluster": pa.array(cluster.astype(np.int32)),
                    "distance": pa.array(distances[np.arange(len(cluster)), cluster])})

    return chunks.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint")


def clustered(rows: DataFrame, embedding: Column, dimensions: int, k: int, rounds: int, salt: str,
              scale: int = 256) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for the rows of ``rows`` whose
    ``embedding`` has ``dimensions`` components, none null or non-finite; others are left out.

    Components are floored at ``scale`` times their value; see ``clusters``. Inertia is the sum of the distances,
    of the cluster and of all; the digest is that of the centroid's components as decimals joined by commas.
    """
    kept = rows.select("vec_id", embedding.alias("embedding")).filter(
        (F.size("embedding") == dimensions) & usable(F.col("embedding")))
    vectors = kept.select("vec_id", floored(F.col("embedding"), scale).alias("vector"))
    found, centroids = clusters(vectors, dimensions, k, rounds, salt)
    assigned = stage_table(found, "assigned")
    own = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = rows.sparkSession.createDataFrame(
        [(c, s, sum(own.values()), digest[c]) for c, s in sorted(own.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
