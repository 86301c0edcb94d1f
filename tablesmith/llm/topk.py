"""Exact top-k by inner product with MaxScore over sharded posting columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard of candidates and of a block of queries; a task holds one of each.
SHARD_ROWS, BLOCK_ROWS = 4096, 1024
#: Rows of a shard that are scored in full to find a first threshold, and terms that are probed between two prunings.
SEED_ROWS, PROBED = 64, 8

HITS = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def floored(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    """True unless the vector is null or holds null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: finite(x.cast("double"))), F.lit(False))


def matrix(column: pa.ChunkedArray, terms: int) -> np.ndarray:
    """A list column as an integer matrix, shorter vectors filled up with zeros."""
    lists = column.combine_chunks()
    lengths = np.asarray(lists.value_lengths(), dtype=np.int64)
    values = np.asarray(lists.flatten(), dtype=np.int64)
    out = np.zeros((len(lists), terms), dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def best(query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores that may be among the k best of a shard; all that tie with the k-th are among them.

    ``postings`` has a line per term (component) with its value in each row. Relative to the worst value of a term
    (``low`` or ``high`` by the query's sign) each row gains 0 or more of it, at most the term's bound. Terms whose
    bounds together cannot lift a row from the base score to the threshold are non-essential: rows are first
    scored by the essential terms, the others are probed largest bound first, and only in rows that still can
    reach the threshold. The threshold is the k-th best score of the rows known in full.
    """
    rows = np.flatnonzero(~own)
    if not len(rows):
        return rows, np.zeros(0, dtype=np.int64)
    worst = np.where(query > 0, low, high)
    bound = np.abs(query) * (high - low)
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    base = (query * worst).sum()
    rest = np.concatenate((np.cumsum(bound[order][::-1])[::-1], [0]))  # what the terms from here on can add
    threshold = -np.inf
    seed = rows[:: max(1, len(rows) // SEED_ROWS)]
    if len(seed) >= k:
        threshold = np.partition(query @ postings[:, seed], len(seed) - k)[len(seed) - k]
    essential = int(np.argmax(base + rest < threshold)) if (base + rest < threshold).any() else len(order)
    scores = (base - (query * worst)[order[:essential]].sum()) + query[order[:essential]] @ postings[order[:essential]]
    rows = rows[scores[rows] + rest[essential] >= threshold]
    scores = scores[rows]
    for at in range(essential, len(order), PROBED):
        terms = order[at:at + PROBED]
        scores = scores + query[terms] @ postings[np.ix_(terms, rows)] - (query * worst)[terms].sum()
        left = rest[min(at + PROBED, len(order))]
        if len(rows) > k:  # what the rows have for certain is a threshold as well
            threshold = max(threshold, np.partition(scores, len(scores) - k)[len(scores) - k])
        alive = scores + left >= threshold
        rows, scores = rows[alive], scores[alive]
    if len(rows) > k:
        alive = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        rows, scores = rows[alive], scores[alive]
    return rows, scores


def search_shard(queries: pa.Table, shard: pa.Table, k: int) -> pa.Table:
    """The k best rows of a shard for each query of a block, ties to the smaller id (null last)."""
    out = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
    if queries.num_rows and shard.num_rows:
        terms = max(max(t["vector"].combine_chunks().value_lengths().to_pylist(), default=0) for t in (queries, shard))
        q, d = matrix(queries["vector"], terms), matrix(shard["vector"], terms)
        most = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * 2 * max(terms, 1)
        exact = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64
        q, postings = q.astype(exact), np.ascontiguousarray(d.T.astype(exact))
        low, high = postings.min(axis=1), postings.max(axis=1)
        ids = np.asarray(shard["vec_id"].fill_null(0))
        null = np.asarray(shard["vec_id"].is_null())
        for n, (query_id, key) in enumerate(zip(queries["vec_id"].to_pylist(), queries["query_key"].to_pylist())):
            rows, scores = best(q[n], postings, low, high, (ids == query_id) & ~null, k)
            first = np.lexsort((ids[rows], null[rows], -scores))[:k]
            out["query_id"] += [query_id] * len(first)
            out["query_key"] += [key] * len(first)
            out["vec_id"] += [None if null[r] else int(ids[r]) for r in rows[first]]
            out["score"] += [int(s) for s in scores[first]]
    return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` its k rows of ``vectors`` with the highest
    inner product, without rows of the query's own vec_id; ties go to the smaller vec_id (null last).

    Both have ``vec_id`` and ``vector`` (array<bigint>, not null; missing components count as 0). A block of
    queries meets each shard of rows in a task of bounded size, and only k rows of each meeting are merged.
    Repeated queries are answered once; repeated rows each count; other columns aren't read.
    """
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    asked = queries.select("vec_id", "vector", F.xxhash64("vec_id", "vector").alias("query_key")).distinct()
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    # the tag spreads any number of equal rows evenly; which shard has a row doesn't change the result
    tagged = F.xxhash64("vec_id", "vector", F.monotonically_increasing_id())
    rows = (vectors.select("vec_id", "vector", F.pmod(tagged, F.lit(shards)).cast("int").alias("shard"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = (asked.withColumn("block", F.pmod(F.col("query_key"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    found = (asked.groupBy("shard", "block").cogroup(rows.groupBy("shard", "block"))
             .applyInArrow(lambda q, d: search_shard(q, d, k), HITS))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

