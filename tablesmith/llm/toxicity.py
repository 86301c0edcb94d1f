"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tablesmith.llm.common import parts, small

#: Hash space of the features; the dense weights take 8 bytes for each.
HASH_BITS = 20
#: Labelled documents that the weights are fitted on, about: all if there are no more, else a part by hash.
FIT_DOCS = 16_000
#: Part of them that each label gets at least, if it has so many rows.
LEAST_PART = 0.1
#: FTRL: rates alpha / (beta + sqrt(sum of squared gradients)), L2 strength, passes over the rows.
ALPHA, BETA, L2, PASSES = 4.0, 1.0, 0.0, 4
#: L1 strength for each square root of a row with label 1: about what a feature's gradients sum to by chance.
L1_SCALE = 0.4
#: Words whose hashes a task remembers.
REMEMBERED = 500_000

_WORD = re.compile(r"[^\W_]+")


class Features:
    """Hashed words, pairs of neighbours and pairs with one word between them."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1
        self.known: dict[str, int] = {}

    def words(self, part: str) -> np.ndarray:
        found = _WORD.findall(part.lower())
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in {w for w in found if w not in known}:
            known[w] = crc32(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        """Arrays of feature numbers, repeats included; pairs run on across the parts of a long text."""
        before = np.zeros(0, dtype=np.uint64)
        for part in parts(text or ""):
            new = self.words(part)
            w = np.concatenate((before, new))
            pairs = [self.spot(w[:-1], w[1:], 0x9E3779B1)[max(0, len(before) - 1):],
                     self.spot(w[:-2], w[2:], 0x85EBCA77)[max(0, len(before) - 2):]]
            yield np.concatenate([self.mixed(new * np.uint64(0xC2B2AE3D27D4EB4F)), *pairs])
            before = w[-2:]

    def distinct(self, text: str | None) -> np.ndarray:
        """The feature numbers of a whole text, each once."""
        return np.unique(np.concatenate(list(self.of(text))))

    def spot(self, a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
        return self.mixed(a * np.uint64(0x9FB21C651E98DF25) + b * np.uint64(0xD6E8FEB86659FD93) + np.uint64(kind))

    def mixed(self, h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((h ^ (h >> np.uint64(29))) & np.uint64(self.mask)).astype(np.int64)


def fit_ftrl(rows: Iterable[tuple[str | None, int]], bits: int, alpha: float, beta: float, l1: float, l2: float,
             passes: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature numbers with weights other than 0, these weights, and the bias (which has no penalty).

    A document has each of its features once. Per coordinate: z sums the gradients, less what the weight's
    change explains, n their squares; the weight is 0 while |z| is at most ``l1``. As a gradient is below 1, a
    feature of too few documents can never pass ``l1``: such are left out from the start, with the same result.
    """
    features = Features(bits)
    return fit_features([(features.distinct(text), label) for text, label in rows], bits, alpha, beta, l1, l2, passes)


def fit_features(data: list[tuple[np.ndarray, int]], bits: int, alpha: float, beta: float, l1: float, l2: float,
                 passes: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``fit_ftrl`` of rows whose texts are hashed already: their distinct feature numbers."""
    often = np.zeros(1 << bits, dtype=np.int32)
    for f, _ in data:
        often[f] += 1
    numbers = np.flatnonzero(often * passes > l1)
    place = np.full(1 << bits, -1, dtype=np.int32)
    place[numbers] = np.arange(len(numbers))
    bias = len(numbers)
    data = [(np.append(p[p >= 0], bias), label) for p, label in ((place[f], label) for f, label in data)]
    z, root = np.zeros(bias + 1), np.zeros(bias + 1)  # root: the square root of n
    penalty = np.full(bias + 1, l1)
    penalty[bias] = 0.0

    def weights(zf: np.ndarray, rf: np.ndarray, pf: np.ndarray) -> np.ndarray:
        over = np.maximum(np.abs(zf) - pf, 0.0)
        return -np.copysign(over, zf) / ((beta + rf) / alpha + l2)

    for _ in range(passes):
        for f, label in data:
            zf, rf = z[f], root[f]
            w = weights(zf, rf, penalty[f])
            g = 1 / (1 + math.exp(-min(max(w.sum(), -35.0), 35.0))) - label
            new = np.sqrt(rf * rf + g * g)
            z[f] = zf + g - (new - rf) / alpha * w
            root[f] = new
    w = weights(z, root, penalty)
    some = np.flatnonzero(w[:-1])
    return numbers[some], w[some], float(w[-1])


def fit_weights(docs: DataFrame, labels: DataFrame, bits: int = HASH_BITS, fit_docs: int = FIT_DOCS,
                passes: int = PASSES) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights fitted on ``docs(doc_id, text)`` with ``labels(doc_id, label)``, about ``fit_docs`` different rows.

    Labels are chosen by a hash of doc_id before any text moves, each label with its own share: that of ``fit_docs`` in
    all rows, or what gives it LEAST_PART of ``fit_docs`` if that is more (a rare label would be lost otherwise; the
    bias is corrected for the ratio). If ids have several texts, those are chosen by a hash of the text. Tasks hash the
    chosen texts in parallel; online learning is sequential: one task goes through the rows' feature numbers in the
    order of a hash and returns the weights that L1 left, so that they are the same in each run. Null labels and null
    ids are left out, repeated rows count once. Without rows of both labels there is nothing to learn: no weights, and
    the log-odds of label 1 (0 if there are no rows) as bias.
    """
    known = (labels.select("doc_id", F.col("label").cast("int").alias("label"))
             .filter("doc_id is not null and label is not null").distinct())
    place = lambda *of: F.pmod(F.xxhash64(F.lit("fit"), *of), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = shares({r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}, fit_docs)
    own = F.lit(0.0)
    for label, part in share.items():
        own = F.when(F.col("label") == label, F.lit(part)).otherwise(own)
    known = small(known.filter(place("doc_id") < own))
    texts = docs.select("doc_id", "text").join(known, "doc_id")
    n = texts.select("doc_id", "label", F.xxhash64("text")).distinct().count()
    order = F.xxhash64(F.lit("order"), "text", "label")
    hashed = (texts.filter(place("text") < min(1.0, 2 * fit_docs / max(n, 1)))
              .select("text", "label", order.alias("order")).distinct()
              .mapInArrow(_hashing(bits), "order bigint, label int, features array<int>"))
    chosen = hashed.repartition(1).sortWithinPartitions("order", "label", "features")
    correction = math.log(share.get(1, 1.0) / share.get(0, 1.0))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = [(np.asarray(f.values, dtype=np.int64), y) for b in batches
                for f, y in zip(b.column("features"), b.column("label").to_pylist())]
        ones = sum(y for _, y in data)
        if 0 < ones < len(data):
            which, w, bias = fit_features(data, bits, ALPHA, BETA, L1_SCALE * ones ** 0.5, L2, passes)
        else:
            which, w = np.zeros(0, dtype=np.int64), np.zeros(0)
            bias = float(np.log((ones + 0.5) / (len(data) - ones + 0.5)))
        yield pa.RecordBatch.from_pydict({"which": pa.array([which.tolist()], pa.list_(pa.int64())),
                                          "w": pa.array([w.tolist()], pa.list_(pa.float64())), "bias": [bias]})

    found = chosen.mapInArrow(fit, "which array<bigint>, w array<double>, bias double").collect()
    r = found[0] if found else {"which": [], "w": [], "bias": 0.0}
    return np.array(r["which"], dtype=np.int64), np.array(r["w"]), r["bias"] - (correction if found else 0.0)


def shares(counts: dict[int, int], fit_docs: int) -> dict[int, float]:
    """The part of each label's rows that the fit takes; more than none of any label, however many rows there are."""
    whole = fit_docs / max(sum(counts.values()), 1)
    return {label: min(1.0, max(whole, LEAST_PART * fit_docs / n)) for label, n in counts.items() if n}


def _hashing(bits: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in batches:
            found = [features.distinct(t.as_py()) for t in batch.column("text")]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *found]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["order", "label", "features"])
    return hashed


def toxicity(text: Column, model: tuple[np.ndarray, np.ndarray, float], bits: int = HASH_BITS) -> Column:
    """Column with the probability of label 1 for each whole text; null and empty texts get the bias's.

    The sparse weights go along with the function: at most one entry per hash value, whatever the input.
    """
    which, w, bias = model

    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = np.zeros(1 << bits, dtype=np.float32)
        dense[which] = w
        some = dense != 0
        features = Features(bits)
        for batch in batches:
            logits = []
            for x in batch:
                hit = [f[some[f]] for f in features.of(x.as_py())]
                logits.append(bias + float(dense[np.unique(np.concatenate(hit))].sum(dtype=np.float64)))
            yield pa.array(1 / (1 + np.exp(-np.clip(logits, -35, 35))), pa.float64())

    return score(text)
