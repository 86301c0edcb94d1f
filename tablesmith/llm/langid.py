"""Language identification with hyperdimensional letter n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import OWN

#: Components of a vector, letters of an n-gram, seed of the random letter vectors.
DIMENSIONS, GRAM, SEED = 1024, 3, 20_017
#: Different labelled documents that each language's prototype is fitted on, about: all if there are no more, else a
#: part by hash; the tasks they are dealt to.
FIT_DOCS, FIT_TASKS = 5_000, 32
#: Components by which ``in_languages`` decides: the cosine of unlike texts has a standard deviation of 0.011.
FINE_DIMENSIONS = 8192
#: A cosine over the first DIMENSIONS of these that needs no second look, six standard deviations above none.
SURE_SCORE = 0.2
#: Numbers of n-gram vectors that are held at once.
HELD = 1 << 23
#: Characters that are bundled at once, and the longest part of a text in it.
BATCH_CHARS = 256 * 1024

UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=20_000)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    """The random +1/-1 vector of a letter (0: the space between words); depends on code, size and SEED only."""
    return np.random.default_rng([SEED, code]).integers(0, 2, dimensions).astype(np.int8) * 2 - 1


def symbols(part: str, before: np.ndarray) -> np.ndarray:
    """Lower-case letters of ``part`` as code points, each run of others as one 0, after those of ``before``."""
    codes = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    codes = np.concatenate((before, np.where(_letters()[codes], codes, 0)))
    return codes[(codes != 0) | (np.concatenate(([1], codes[:-1])) != 0)]


def parts_of(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the text, its n-grams as integer keys) for the texts' parts; n-grams run on across parts."""
    for k, text in enumerate(texts):
        if not text:
            continue
        before = np.zeros(1, dtype=np.int64)
        for at in range(0, len(text), BATCH_CHARS):
            last = at + BATCH_CHARS >= len(text)
            codes = symbols(text[at:at + BATCH_CHARS], before)
            if last and codes[-1] != 0:
                codes = np.append(codes, 0)
            grams = sum(codes[i:len(codes) - GRAM + 1 + i] << 21 * (GRAM - 1 - i) for i in range(GRAM))
            if len(codes) >= GRAM:
                yield k, grams
            before = codes[-(GRAM - 1):]


def gram_vectors(grams: np.ndarray, dimensions: int, first: int) -> np.ndarray:
    """One vector per n-gram, its ``first`` components: its letters' vectors, rolled by their place, multiplied."""
    out = None
    for place in range(GRAM):
        codes = (grams >> 21 * (GRAM - 1 - place)) & 0x1FFFFF
        known, which = np.unique(codes, return_inverse=True)
        table = np.stack([np.roll(letter_vector(int(c), dimensions), GRAM - 1 - place)[:first] for c in known])
        out = table[which] if out is None else out * table[which]
    return out.astype(np.float32)


def bundles(texts: list[str | None], dimensions: int, first: int | None = None) -> np.ndarray:
    """The sum of the n-gram vectors of each text, or its ``first`` components; zeros for a text without letters."""
    first = first or dimensions
    out = np.zeros((len(texts), first), dtype=np.float32)
    step = max(1, HELD // first)

    def add(batch: list[tuple[int, np.ndarray]]) -> None:
        rows, which = np.unique([k for k, _ in batch], return_inverse=True)
        grams, column = np.unique(np.concatenate([g for _, g in batch]), return_inverse=True)
        row = np.repeat(which, [len(g) for _, g in batch])
        counts = np.bincount(row * len(grams) + column, minlength=len(rows) * len(grams))
        counts = counts.reshape(len(rows), len(grams)).astype(np.float32)
        for at in range(0, len(grams), step):
            out[rows] += counts[:, at:at + step] @ gram_vectors(grams[at:at + step], dimensions, first)

    batch, held = [], 0
    for part in parts_of(texts):
        batch.append(part)
        held += len(part[1])
        if held >= BATCH_CHARS or len(batch) >= 64:
            add(batch)
            batch, held = [], 0
    if batch:
        add(batch)
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def fit_sample(rows: DataFrame, fit_docs: int) -> DataFrame:
    """About ``fit_docs`` different ``(text, lang)`` of each language, chosen by a hash of the text; all of a language
    that has no more. The share of a language is drawn from a count of its different texts: copies count once, so
    neither the size of the input nor another language takes a language's rows."""
    own = OWN + "n"
    rows = rows.filter("lang is not null and text is not null")
    # one row per language, with a sketch that tasks merge
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("text").alias(own))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (rows.join(F.broadcast(counts), "lang").filter(place * F.col(own) < F.lit(float(fit_docs)))
            .select("text", "lang").distinct())


def fit_prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS, fit_docs: int = FIT_DOCS,
                   text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """A unit vector for each non-null ``lang``: the sum of its documents' unit bundles.

    Fitted on about ``fit_docs`` different labelled documents of each language (``fit_sample``). Tasks sum their own
    rows; the driver gets ``dimensions`` numbers per language. No labelled rows: no languages.
    """
    chosen = fit_sample(labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")), fit_docs)

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 512):
                vectors, some = unit(bundles(texts[at:at + 512], dimensions)), langs[at:at + 512]
                for lang in set(some):
                    total[lang] = total.get(lang, 0) + vectors[some == lang].sum(axis=0, dtype=np.float64)
        if total:
            yield pa.RecordBatch.from_pydict({"lang": list(total), "total": [v.tolist() for v in total.values()]})

    partial = chosen.repartition(FIT_TASKS).mapInArrow(sums, "lang string, total array<double>")
    summed = (partial.select("lang", F.posexplode("total").alias("at", "x")).groupBy("lang", "at")
              .agg(F.sum("x").alias("x")).groupBy("lang")
              .agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("xs")).select("lang", "xs.x").collect())
    return {r["lang"]: unit(np.array(r["x"], dtype=np.float32)) for r in sorted(summed, key=lambda r: r["lang"])}


def language(text: Column, prototypes: dict[str, np.ndarray]) -> Column:
    """Struct column ``(lang, score)``: the prototype with the highest cosine to the text's bundle, ties to the
    first by name, and that cosine (0 if negative). Null and letterless texts, and all if there are no
    prototypes, give ``und`` and 0. The prototypes, ``dimensions`` floats per language, go along with the function.
    """
    names = [*prototypes, UNKNOWN]
    table = np.stack(list(prototypes.values())) if prototypes else None

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best, score = np.full(len(batch), len(names) - 1), np.zeros(len(batch))
            texts = batch.tolist()
            for at in range(0, len(texts) if table is not None else 0, 1024):
                sums = bundles(texts[at:at + 1024], table.shape[1])
                cosines = unit(sums) @ table.T
                some = sums.any(axis=1)
                best[at:at + 1024][some] = cosines.argmax(axis=1)[some]
                score[at:at + 1024][some] = np.clip(cosines.max(axis=1)[some], 0.0, 1.0)
            yield pd.DataFrame({"lang": [names[k] for k in best], "score": score})

    return predict(text)


def in_languages(text: Column, prototypes: dict[str, np.ndarray], least: float) -> Column:
    """Boolean column: whether the text has letters and its bundle a cosine of ``least`` or more to a prototype.

    The first DIMENSIONS components decide where their cosine is SURE_SCORE or more, all of them elsewhere: the
    noise of a cosine shrinks with the square root of the components, and few texts need so many. Without
    prototypes no text is in a language.
    """
    table = np.stack(list(prototypes.values())) if prototypes else None

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        start = unit(table[:, :DIMENSIONS]) if table is not None else None
        for batch in batches:
            out, texts = np.zeros(len(batch), dtype=bool), batch.tolist()
            for at in range(0, len(texts) if table is not None else 0, 1024):
                part = texts[at:at + 1024]
                sums = bundles(part, table.shape[1], min(DIMENSIONS, table.shape[1]))
                sure = (unit(sums) @ start.T).max(axis=1) >= SURE_SCORE
                look = [k for k, t in enumerate(part) if not sure[k] and t and any(map(str.isalpha, t))]
                for some in (look[k:k + 128] for k in range(0, len(look), 128)):
                    fine = unit(bundles([part[k] for k in some], table.shape[1])) @ table.T
                    sure[some] = fine.max(axis=1) >= least
                out[at:at + 1024] = sure
            yield pd.Series(out)

    return known(text)
