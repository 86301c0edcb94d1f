"""Corpus pipeline: language, near duplicates, benchmark leaks, source mix, shards.

``STAGES`` are applied in order, each to the written result of the one before; all but the last return the
columns of ``documents``. ``ORACLE_SQL`` is None: fingerprints, edit distances and hyperdimensional vectors have
no SQL form, the stages are tested against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm import decontam, langid, mixing, queries, sharding, simhash
from tablesmith.llm.common import read_table, stage_table
from tablesmith.session import ensure_checkpoint_dir, ship_package

#: Cosine to the nearest language prototype below which a text is in none of the languages, by 8,192 components.
#: Measured with prototypes of four languages: 400 texts of 5 and 150 words in ten unlearned scripts lie below 0.033;
#: of 479 clean texts of 3 words 0.6 % lie below 0.05, of 5 words none (0.056 and more), whole documents from 0.25 up.
LEAST_LANGUAGE_SCORE = 0.05


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the learned languages: go do texts without letters and unlike all prototypes.

    Prototypes come from the stage's own rows with a language; if there is none, no document can be rejected for
    its score, only for having no letters."""
    prototypes = langid.fit_prototypes(docs.select("text", "lang"), langid.FINE_DIMENSIONS)
    if not prototypes:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return docs.filter(langid.in_languages(F.col("text"), prototypes, LEAST_LANGUAGE_SCORE))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest doc_id."""
    return simhash.deduplicated(docs, queries.SHINGLE_WORDS, queries.SIMHASH_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item within its edit budget."""
    return decontam.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix wants it: rows repeat, or go."""
    return mixing.mixed(docs, queries.MIX_WEIGHTS, queries.MIX_MOST, queries.MIX_SEED)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give each row of the mix its shard and its place there."""
    return sharding.shard_documents(docs, queries.SHARDS, queries.VIRTUAL_NODES, slack=0.0)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing_sources), ("sharding", shards)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
