"""SimHash near-duplicates, found by meet-in-the-middle ball hashing of the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tablesmith.llm.common import OWN, components, saved, stage_table

BITS = 64
#: Shingles that are held at once for one text.
CHUNK = 50_000


def fingerprint_of(text: str | None, words: int, seed: int = 42) -> int:
    """The signed 64-bit SimHash of a whole text: a bit is 1 if more than half of the shingles' hashes have it.

    A-Z are lower-cased; words end at ASCII white space; a shingle is ``words`` words with single spaces (a
    shorter text: all its words), counted as often as it occurs, hashed by XXH64. No words: 0.
    """
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    ends = ends[min(words, len(parts)) - 1:]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        hashes = [xxh64_intdigest(joined[s:e], seed)
                  for s, e in zip(starts[at:min(at + CHUNK, n)].tolist(), ends[at:at + CHUNK].tolist())]
        ones += np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, words: int) -> Column:
    """Column with the fingerprint of each whole text (a null text has no words)."""

    @F.arrow_udf(LongType())
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint_of(x.as_py(), words) for x in batch], pa.int64())

    return simhash(text)


def ball(radius: int) -> list[int]:
    """Signed masks of all at most ``radius`` of 64 bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_links(fingerprints: DataFrame, distance: int) -> DataFrame:
    """Links ``(a, b)`` between the distinct values of ``fp`` that differ in at most ``distance`` bits.

    Every fingerprint emits its variants within half the distance (rounded up). Two within the whole distance
    meet in a variant between them. The rows of a variant are put in order and each is linked to the one before;
    with half of an even distance those at one variant all lie within the whole distance, so such chains connect
    all that meet there, without all pairs. For an odd distance, and as a check, pairs are verified by their bit
    distance, and then all pairs of a variant are needed: at most as many as the ball is large.
    """
    half = (distance + 1) // 2
    distinct = fingerprints.select("fp").distinct()
    masks = F.array(*[F.lit(m).cast("long") for m in ball(half)])
    variants = distinct.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    if distance % 2 == 0:
        before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
        pairs = variants.select(before.alias("a"), F.col("fp").alias("b")).filter("a is not null")
    else:
        other = variants.select(F.col("fp").alias("a"), "variant")
        pairs = variants.withColumnRenamed("fp", "b").join(other, "variant").filter("a < b").select("a", "b")
    return pairs.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def classes(fingerprinted: DataFrame, distance: int) -> DataFrame:
    """``(fp, component_id)`` for each distinct ``fp`` of ``fingerprinted(doc_id, fp)``.

    Documents with equal fingerprints collapse first; ``component_id`` is the smallest doc_id reachable over
    links of at most ``distance`` bits (null if a component has no doc_id).
    """
    smallest = saved(fingerprinted.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(near_links(smallest, distance)).withColumnRenamed("node", "fp")
    rooted = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # few rows are linked: only the roots with several fingerprints need the second aggregate's join
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``; see ``fingerprint_of`` and ``classes``.

    Texts without words share fingerprint 0 and link like any other. Repeated rows stay and share a component;
    an empty table gives an empty one.
    """
    prints = saved(docs.select("doc_id", fingerprint(F.col("text"), words).alias("fp")))
    return prints.join(classes(prints, distance), "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of each component the row with the smallest
    doc_id stays (null after all others; among rows with that doc_id, one of them)."""
    tag, fp = OWN + "row", OWN + "fp"
    kept = stage_table(docs.withColumns({tag: F.monotonically_increasing_id(),
                                         fp: fingerprint(F.col("text"), words)}), "simhash")
    narrow = kept.select("doc_id", F.col(fp).alias("fp"), F.col(tag).alias("tag"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("tag").alias("tag"))
    best = narrow.groupBy("fp").agg(F.min(first).alias("first"))
    roots = components(near_links(narrow, distance)).withColumnRenamed("node", "fp")
    stay = (best.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("first").alias("first")).select(F.col("first")["tag"].alias(tag)))
    return kept.join(stay, tag, "left_semi").select(*docs.columns)
