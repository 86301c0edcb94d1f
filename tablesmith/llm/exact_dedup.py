"""Exact duplicates: counting quotient filters find repeated fingerprints, the bytes of whole texts decide."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tablesmith.llm.common import OWN, small, stage_table

#: Fingerprints have so many bits; a slab of the fingerprint space gets about so many of all rows.
BITS, SLAB_ROWS = 64, 1 << 15
#: Different fingerprints that a filter in the making holds before it is given out.
FILTER_ROWS = 1 << 20
#: The routing bitmap has about so many bits per repeated fingerprint, and at most 2**MOST_ROUTE_BITS (32 MB).
ROUTE_SPACE, MOST_ROUTE_BITS = 64, 28

BLOCKS = "slab int, quotient_bits int, runs binary, remainders binary, places binary, counts binary"
REPEATED = "fp bigint, n bigint"


class QuotientFilter:
    """Counts of the fingerprints of one slab, those whose leading ``slab_bits`` bits are the slab's number.

    The next ``quotient_bits`` bits of a fingerprint are its quotient: they choose a run. What is left, the
    remainder, is kept in the run, sorted, once, with its count. ``runs`` has the length of each run, so quotient
    and remainder together give the fingerprint back: nothing is lost, and filters merge without loss, also those
    with other quotients, since the order by run and remainder is the order of the fingerprints.
    """

    def __init__(self, slab_bits: int, quotient_bits: int, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.slab_bits, self.quotient_bits = slab_bits, quotient_bits
        self.runs, self.remainders, self.counts = runs, remainders, counts

    @classmethod
    def of(cls, slab_bits: int, suffixes: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """From sorted, different fingerprints without their slab bits; about one remainder a run."""
        q = min(max(len(suffixes).bit_length() - 1, 0), BITS - slab_bits - 1, 31)
        low = np.uint64(BITS - slab_bits - q)
        runs = np.bincount((suffixes >> low).astype(np.int64), minlength=1 << q)
        return cls(slab_bits, q, runs, suffixes & ((np.uint64(1) << low) - np.uint64(1)), counts)

    def suffixes(self) -> np.ndarray:
        """The fingerprints without their slab bits, sorted."""
        low = np.uint64(BITS - self.slab_bits - self.quotient_bits)
        return (np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs) << low) | self.remainders

    @classmethod
    def merged(cls, filters: Iterable[QuotientFilter]) -> QuotientFilter:
        """One filter with the summed counts of several of the same slab, merged by their sorted remainders."""
        filters = list(filters)
        values = np.concatenate([f.suffixes() for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(values, kind="stable")
        return cls.of(filters[0].slab_bits, *summed(values[order], counts[order]))

    def packed(self, slab: int) -> dict:
        """A row of BLOCKS: remainders in as many bytes as they need, counts only where they are above one."""
        size = -(-(BITS - self.slab_bits - self.quotient_bits) // 8)
        places = np.flatnonzero(self.counts > 1)
        return {"slab": slab, "quotient_bits": self.quotient_bits, "runs": self.runs.astype("<u4").tobytes(),
                "remainders": self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes(),
                "places": places.astype("<u4").tobytes(), "counts": self.counts[places].astype("<i8").tobytes()}

    @classmethod
    def unpacked(cls, slab_bits: int, row: dict) -> QuotientFilter:
        q = row["quotient_bits"]
        size = -(-(BITS - slab_bits - q) // 8)
        low = np.frombuffer(row["remainders"], np.uint8).reshape(-1, size)
        wide = np.zeros((len(low), 8), dtype=np.uint8)
        wide[:, :size] = low
        counts = np.ones(len(low), dtype=np.int64)
        counts[np.frombuffer(row["places"], "<u4")] = np.frombuffer(row["counts"], "<i8")
        return cls(slab_bits, q, np.frombuffer(row["runs"], "<u4").astype(np.int64),
                   wide.view("<u8").reshape(-1).astype(np.uint64), counts)


def summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values once each, with the sums of their counts."""
    if not len(values):
        return values, counts
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.add.reduceat(counts, first)


def slab_filters(fingerprints: np.ndarray, counts: np.ndarray, slab_bits: int) -> Iterator[dict]:
    """BLOCKS rows of sorted, different fingerprints: a filter for each slab that has some."""
    slabs = (fingerprints >> np.uint64(BITS - slab_bits)).astype(np.int64) if slab_bits else np.zeros(len(fingerprints), np.int64)
    suffixes = fingerprints & np.uint64((1 << (BITS - slab_bits)) - 1)
    cuts = np.flatnonzero(np.diff(slabs)) + 1
    for at, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(slabs)]):
        if end > at:
            yield QuotientFilter.of(slab_bits, suffixes[at:end], counts[at:end]).packed(int(slabs[at]))


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """``(fp, n)``: the values of ``prints.fp`` that ``n`` > 1 rows have.

    Each partition builds counting quotient filters, one per slab (range of fingerprints); the filters of a slab
    meet in one task of bounded size, since equal fingerprints were counted before and different ones spread
    evenly over the slabs. ``rows`` is the number of rows, for the number of slabs.
    """
    slab_bits = max(4, (max(rows, 1) // SLAB_ROWS).bit_length())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new = np.asarray(batch.column("fp")).view(np.uint64)
            values = np.concatenate((values, new))
            order = np.argsort(values, kind="stable")
            values, counts = summed(values[order], np.concatenate((counts, np.ones(len(new), np.int64)))[order])
            if len(values) > FILTER_ROWS:
                yield from blocks(values, counts)
                values, counts = values[:0], counts[:0]
        yield from blocks(values, counts)

    def blocks(values: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("slab", pa.int32()), ("quotient_bits", pa.int32()), ("runs", pa.binary()),
                            ("remainders", pa.binary()), ("places", pa.binary()), ("counts", pa.binary())])
        found = list(slab_filters(values, counts, slab_bits))
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        one = QuotientFilter.merged(QuotientFilter.unpacked(slab_bits, row) for row in table.to_pylist())
        many = one.counts > 1
        fps = one.suffixes()[many] | np.uint64(key[0].as_py() << (BITS - slab_bits))
        return pa.table({"fp": pa.array(fps.view(np.int64)), "n": pa.array(one.counts[many])})

    return prints.select("fp").mapInArrow(build, BLOCKS).groupBy("slab").applyInArrow(
        lambda key, table: merge(key, table), REPEATED)


def routing_bitmap(repeated: DataFrame) -> tuple[int, np.ndarray]:
    """The number of leading bits it looks at, and a bitmap with a 1 for the leading bits of each repeated fingerprint.

    Its size is bounded by MOST_ROUTE_BITS whatever the input. A set bit may also let unrepeated fingerprints
    pass, with more rows more of them; these are told apart later. A repeated one always passes.
    """
    bits = min(MOST_ROUTE_BITS, max(16, (ROUTE_SPACE * repeated.count()).bit_length()))
    words = (repeated.select(F.shiftrightunsigned("fp", BITS - bits).alias("lead"))
             .groupBy(F.shiftright("lead", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(lead & 63 as int)))").alias("set")).toArrow())
    bitmap = np.zeros(1 << (bits - 6), dtype=np.uint64)
    bitmap[np.asarray(words["word"], dtype=np.int64)] = np.asarray(words["set"], dtype=np.int64).view(np.uint64)
    return bits, bitmap


def routed(fp: Column, bitmap: tuple[int, np.ndarray]) -> Column:
    """True for all repeated fingerprints, and for few others."""
    bits, words = bitmap

    @F.pandas_udf(BooleanType())
    def hit(values: pd.Series) -> pd.Series:
        lead = values.to_numpy().view(np.uint64) >> np.uint64(BITS - bits)
        return pd.Series((words[lead >> np.uint64(6)] >> (lead & np.uint64(63)) & np.uint64(1)).astype(bool))

    return hit(fp)


def normalised(text: Column) -> Column:
    """The text without the characters 0x20 and 0x09 to 0x0D; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _prints(docs: DataFrame) -> DataFrame:
    """Narrow rows of ``docs(doc_id, text, tag)``: id, tag, code points, fingerprint and digest of each text."""
    norm = normalised(F.col("text"))
    return docs.select("doc_id", "tag", F.coalesce(F.length("text"), F.lit(0)).alias("length"),
                       F.xxhash64(norm).alias("fp"), F.unhex(F.sha2(norm, 256)).alias("sha"))


def _classes(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """``(fp, sha, n, keep_id, keep_tag)`` for the texts that more than one row of ``prints`` has.

    Texts whose fingerprint the filters count more than once are grouped by their bytes. Grouped before the
    shuffle, a text that many rows of a task share moves once from it. The number of rows by digest must be the
    number by bytes: two texts with the same digest would end the job with an error, not be taken for one.
    """
    bitmap = routing_bitmap(small(repeated_fingerprints(prints, prints.count())))
    norm = normalised(F.col("text"))
    texts = docs.select(norm.alias("norm"), F.xxhash64(norm).alias("fp")).filter(routed(F.col("fp"), bitmap))
    by_bytes = (texts.groupBy("norm").agg(F.count("*").alias("rows"))
                .select(F.xxhash64("norm").alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha"), "rows"))
    first = F.struct((-F.col("length")).alias("shortness"), F.col("doc_id").isNull().alias("none"),
                     F.col("doc_id").alias("id"), F.col("tag").alias("tag"))
    by_digest = (prints.filter(routed(F.col("fp"), bitmap)).groupBy("fp", "sha")
                 .agg(F.min(first).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    same = F.when(F.col("n") == F.col("rows"), F.col("n")).otherwise(
        F.raise_error(F.lit("two different texts have the same SHA-256")).cast("long"))
    return by_digest.join(by_bytes, ["fp", "sha"]).select(
        "fp", "sha", same.alias("n"), F.col("first")["id"].alias("keep_id"), F.col("first")["tag"].alias("keep_tag"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs(doc_id, text, ...)``.

    Texts are equal if they are the same bytes without white space (``normalised``); null counts as empty, and
    all empty texts are equal. Of equal texts the row with the most code points stays, then the one with the
    smallest doc_id (null after all others); of rows that tie in both, one of them. An empty table gives an
    empty one; other columns aren't read.
    """
    tagged = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("tag"))
    prints = stage_table(_prints(tagged), "exact-prints")
    found = prints.join(small(_classes(tagged, prints)), ["fp", "sha"], "left")
    alone = F.col("n").isNull()
    return found.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("tag") == F.col("keep_tag"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without those that ``exact_duplicates`` drops."""
    tag = OWN + "row"
    held = stage_table(docs.withColumn(tag, F.monotonically_increasing_id()), "exact-docs")
    tagged = held.select("doc_id", "text", F.col(tag).alias("tag"))
    prints = stage_table(_prints(tagged), "exact-prints")
    gone = (prints.join(small(_classes(tagged, prints)), ["fp", "sha"]).filter("tag <> keep_tag")
            .select(F.col("tag").alias(tag)))
    return held.join(gone, tag, "left_anti").select(*docs.columns)
