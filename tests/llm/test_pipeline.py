"""The pipeline's stages on the driver's small table, each against a plain version on what the one before kept."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline as P
from tablesmith.llm import decontam, langid, queries, simhash
from tablesmith.llm.common import read_table, stage_table
from tablesmith.session import ship_package
from tests.conftest import SF_SMALL
from tests.llm.test_methods import brute_bundle, brute_targets, roots


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that enter each stage, and those of the last one."""
    ship_package(spark)
    docs, seen = read_table(spark, SF_SMALL, "documents"), []
    for name, stage in P.STAGES:
        seen.append(docs)
        docs = stage(spark, docs, SF_SMALL)
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = stage_table(docs, name)
    return [*seen, docs]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_language(stages):
    before, after = rows(stages[0]), Counter(rows(stages[1]))
    vectors = langid.unit(np.stack([brute_bundle(t, langid.DIMENSIONS) for _, t, *_ in before]))
    langs = np.array([r[2] for r in before])
    prototypes = langid.unit(np.stack([vectors[langs == lang].sum(axis=0) for lang in sorted(set(langs))]))
    best = (vectors @ prototypes.T).max(axis=1)
    assert after == Counter(r for r, c in zip(before, best) if c >= P.LEAST_LANGUAGE_SCORE)


def test_texts_in_unlearned_scripts_go(spark):
    """Planted among documents: words of letters that no document with a language has; short clean texts stay."""
    rng, rows = random.Random(3), []
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang").collect()
    for script, (first, letters) in enumerate([(0x430, 32), (0x3b1, 24), (0xe01, 40), (0xac00, 600), (0x621, 36)]):
        words = ["".join(chr(first + rng.randrange(letters)) for _ in range(rng.randint(2, 8))) for _ in range(300)]
        rows += [(-1 - 40 * script - k, " ".join(rng.choices(words, k=rng.choice([5, 150]))), None) for k in range(40)]
    short = [(10 ** 6 + r[0], " ".join(r[1].split()[:10]), None) for r in docs[:60]]
    table = spark.createDataFrame([*map(tuple, docs), *rows, *short], "doc_id bigint, text string, lang string")
    left = {r["doc_id"] for r in P.language(spark, table, SF_SMALL).collect()}
    assert not [k for k in left if k < 0] and left == {r[0] for r in [*docs, *short]}


def test_first_components_are_those_of_all():
    texts = ["the end of the story", None, "x", "Straße 日本 текст"]
    assert np.array_equal(langid.bundles(texts, 256, 32), langid.bundles(texts, 256)[:, :32])


def test_near_duplicates(stages):
    before, after = rows(stages[1]), Counter(rows(stages[2]))
    prints = {r[0]: simhash.fingerprint_of(r[1], queries.SHINGLE_WORDS) for r in before}
    near = [(a, b) for a, b in combinations(prints, 2)
            if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= queries.SIMHASH_BITS]
    root, least = roots(prints, near), {}
    for i in sorted(prints):
        least.setdefault(root[i], i)
    assert after == Counter(r for r in before if least[root[r[0]]] == r[0])
    assert len(before) > sum(after.values())


def test_decontamination(spark, stages):
    before, after = rows(stages[2]), Counter(rows(stages[3]))
    items = [decontam.normalised(r["text"]) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    clean = []
    for r in before:
        text = decontam.normalised(r[1])
        if not any(t in text or len(t) <= len(text) + 99 and decontam.myers(decontam.masks(t), len(t), text)[0]
                   <= len(t) // decontam.CHARS_PER_EDIT for t in items):
            clean.append(r)
    assert after == Counter(clean) and len(clean) < len(before)


def test_mixing(stages):
    before, after = Counter(rows(stages[3])), Counter(rows(stages[4]))
    size = {r: len(r[1].split()) for r in before}
    sizes = Counter()
    for r, n in before.items():
        sizes[r[3]] += n * size[r]
    goal = brute_targets(dict(sizes), queries.MIX_WEIGHTS, queries.MIX_MOST)
    assert set(after) <= set(before)
    for s in sizes:
        mine = [r for r in before if r[3] == s]
        rate = goal[s] / sizes[s]
        assert all(int(rate) <= after[r] / before[r] <= int(rate) + 1 for r in mine)
        assert abs(sum(after[r] for r in mine) - rate * len(mine)) <= 1


def test_sharding(stages):
    before, found = stages[4].collect(), stages[5].collect()
    assert Counter(r["doc_id"] for r in before) == Counter(r["doc_id"] for r in found)
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts[s] for s in range(queries.SHARDS)) <= 1


def test_run_is_the_stages(spark, stages):
    got = Counter(tuple(r) for r in P.run(spark, SF_SMALL).collect())
    assert got == Counter(tuple(r) for r in stages[5].collect())
