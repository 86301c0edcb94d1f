"""Token alignment, subvector clustering and exact duplicates against plain versions of themselves."""

import bisect
import functools
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tablesmith.llm import align, exact_dedup, subvectors
from tablesmith.llm import queries as Q
from tests.compare import run
from tests.llm import tables
from tests.llm.test_queries import PAGES, VECTORS

FILE_A, FILE_B = Q.tokenizer_file(Q.TOKENIZER_A), Q.tokenizer_file(Q.TOKENIZER_B)
AWKWARD = ["", " ", "  two  blanks ", "a\n\nb\n c\t\td", "▁ is a blank to B", "<|endoftext|> <s> </s> <0x41>", "it's 'll don't",
           "日本語のテキスト。" * 40, "été naïve Straße " * 30, "🤖 x\x00\x1cy\x85 z", "x" * 900, "word\n" * 200,
           "1234567890,.;:!?" * 50, "مرحبا بالعالم " * 30, "a  " * 100, "\n" * 50 + "end", "no-break　space。x" * 30]


# --- alignment ------------------------------------------------------------------------------------------------

@functools.cache
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_library, b_library = Tokenizer.from_file(FILE_A), SentencePieceProcessor(model_file=FILE_B)
    a_library.encode_special_tokens = True
    return a_library, b_library


def plain_alignment(text):
    """(number of ids of A, of B, groups, links) of one text, or None."""
    if not text:
        return None
    pair = align.pairing(FILE_A, FILE_B)
    a_library, b_library = libraries()
    ids = a_library.encode(" " + text, add_special_tokens=False).ids, b_library.encode(text)
    spelled = [[t.bytes[i] for i in some] for t, some in zip((pair.a, pair.b), ids)]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return None
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
    both = sorted(set(ends[0]) & set(ends[1]))
    member = [[[] for _ in both], [[] for _ in both]]
    for k in (0, 1):
        for i, e in zip(ids[k], ends[k]):
            member[k][bisect.bisect_left(both, e)].append(str(i))
    groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*member)]
    ending = [dict(zip(ends[k], ids[k])) for k in (0, 1)]
    links = [(ending[0][c], ending[1][c]) for c in both]
    return len(ids[0]), len(ids[1]), groups, links


def plain_scores(rows):
    found = [(i, plain_alignment(t)) for i, t in rows]
    n = Counter(x for _, f in found if f for x in f[3])
    most = defaultdict(int)
    for (_, b), k in n.items():
        most[b] = max(most[b], k)
    return Counter((i, f[0], f[1], len(f[2]), len(f[3]), sum(n[x] == most[x[1]] for x in f[3]), sum(n[x] for x in f[3]),
                    hashlib.sha256(";".join(f[2]).encode()).hexdigest()) if f else (i, 0, 0, 0, 0, 0, 0, "")
                   for i, f in found)


def test_fragments_compose_to_the_whole_in_any_bracketing():
    pair = align.pairing(FILE_A, FILE_B)
    rng = random.Random(3)
    for text in AWKWARD[1:] + [tables.EN * 5, tables.DE * 5]:
        ((a, a_ok), (b, b_ok)), = pair.memory.ids([" " + text], [" " + text])
        if not (a_ok and b_ok):
            assert plain_alignment(text) is None
            continue
        a_ends, b_ends = np.cumsum(pair.a.lengths[a]), np.cumsum(pair.b.lengths[b])
        # cut anywhere, tokens of A and of B each at their own place, also through the middle of groups
        n = int(a_ends[-1])
        cuts = sorted(rng.randrange(n + 1) for _ in range(rng.randrange(1, 9)))
        parts, a0, b0 = [], 0, 0
        for cut in [*cuts, n]:
            a1, b1 = int(np.searchsorted(a_ends, cut, "right")), int(np.searchsorted(b_ends, cut, "right"))
            parts.append(align.Fragment.of(pair, align.Tokens(a[a0:a1], a_ends[a0:a1], b[b0:b1], b_ends[b0:b1])))
            a0, b0 = a1, b1
        want = plain_alignment(text)
        for _ in range(5):
            row = [align.Fragment.from_row(pair, p.row()) for p in parts]
            while len(row) > 1:
                k = rng.randrange(len(row) - 1)
                row[k:k + 2] = [row[k] + row[k + 1]]
            got = row[0].finished()
            assert (got["n_a"], got["n_b"], got["groups"]) == (want[0], want[1], ";".join(want[2]))
            assert [tuple(divmod(int(pair.pairs[x]), len(pair.b.bytes))) for x in got["links"]] == want[3]


def test_pieces_and_ranges_encode_as_the_whole():
    a_library, b_library = libraries()
    pair = align.pairing(FILE_A, FILE_B)
    rng = random.Random(5)
    signs = "ab Z9.,'\n\t\r \u0085é日。本▁_-🤖½²٣\x1c"
    texts = AWKWARD + ["".join(rng.choices(signs, k=rng.randrange(1, 300))) for _ in range(400)]
    for text in filter(None, texts):
        whole = " " + text
        a, b = a_library.encode(whole, add_special_tokens=False).ids, b_library.encode(text)
        ((got_a, _), (got_b, _)), = pair.memory.ids([whole], [whole])
        assert got_a.tolist() == a and got_b.tolist() == b
        cuts = [*align.ranges(pair, whole, 20), (len(whole), len(whole))]
        found = list(pair.memory.ids([whole[x0:x1] for (x0, _), (x1, _) in zip(cuts, cuts[1:])],
                                     [whole[y0:y1] for (_, y0), (_, y1) in zip(cuts, cuts[1:])]))
        assert [i for (x, _), _ in found for i in x.tolist()] == a
        assert [i for _, (y, _) in found for i in y.tolist()] == b


def test_remembered_pieces_align_as_whole_texts():
    pair = align.Pairing(FILE_A, FILE_B)
    rng = random.Random(7)
    texts = [t for t in AWKWARD if t] + ["a  b\tc", "\nx y", "x ", " ", "▁x y", "d\x1cd", "a\nb c", "x\u00a0y z", "z" * 200 + " z"]
    texts += ["".join(rng.choices("ab \n\té日▁.\u0085", k=rng.randrange(1, 60))) for _ in range(300)]
    for some in (texts, texts[::-1]):  # the second time most pieces are known
        found = [f.finished() for f in pair.memory.fragments([" " + t for t in some])]
        for text, got in zip(some, found):
            want = plain_alignment(text)
            assert (got["n_a"], got["n_b"], got["groups"]) == ((want[0], want[1], ";".join(want[2])) if want else (0, 0, ""))
            assert [tuple(divmod(int(pair.pairs[x]), len(pair.b.bytes))) for x in got["links"]] == (want[3] if want else [])


def test_pieces_met_again_outlast_a_full_memory(monkeypatch):
    pair = align.Pairing(FILE_A, FILE_B)
    monkeypatch.setattr(align, "REMEMBERED_BYTES", 60_000)
    made = []
    encode = pair.b.encode
    monkeypatch.setattr(pair.b, "encode", lambda texts: made.append("".join(texts)) or encode(texts))
    for k in range(40):
        pair.memory.fragments([" " + " ".join(["often", "met", *(f"w{k}x{j}" for j in range(50))])])
    assert sum(" often" in t or t.startswith("often") for t in made) == 1


def test_a_range_that_is_a_blank_has_its_token():
    assert align.pairing(FILE_A, FILE_B).b.encode([" "]) == [libraries()[1].encode("x ")[-1:]]


def test_memory_of_pieces_is_bounded(monkeypatch):
    pair = align.Pairing(FILE_A, FILE_B)
    monkeypatch.setattr(align, "REMEMBERED_BYTES", 20_000)
    for k in range(30):
        pair.memory.pieces([" " + " ".join(f"w{k}x{j}" for j in range(50)), "日" * 3000])
        assert pair.memory.held < 80_000 and pair.memory.held > len(pair.memory.known) * 200


def test_alignment_over_many_ranges(spark):
    rows = [(k, t) for k, t in enumerate(AWKWARD)] + [(50, None), (None, tables.EN * 9), (51, tables.DE * 20), (51, tables.DE * 20)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, key string, idx string")
    got = align.alignments(docs, FILE_A, FILE_B, range_bytes=64, fan=2).collect()
    want = Counter((i, *(f[:2] + (len(f[2]), ";".join(f[2])) if (f := plain_alignment(t)) else (0, 0, 0, ""))) for i, t in rows)
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.groups) for r in got) == want


def test_alignment_query(spark, tmp_path):
    rows = tables.ROWS + [(100 + k, t, "en", "a") for k, t in enumerate(AWKWARD)]
    path = tables.write(tmp_path, rows)
    got = E.queries()["op11_token_alignment"](spark, path).collect()
    assert Counter(tuple(r) for r in got) == plain_scores([r[:2] for r in rows])


def test_alignment_of_given_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = align.scored(docs, FILE_A, FILE_B).collect()
    assert Counter(tuple(r) for r in got) == plain_scores([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


# --- subvector clustering ------------------------------------------------------------------------------------

def plain_clusters(rows, dimensions, k, rounds, salt):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c)), g) for g, c in enumerate(centroids))
    for _ in range(rounds):
        member = defaultdict(list)
        for _, v in kept:
            member[near(v)[1]].append(v)
        centroids = [[sum(x) // len(member[g]) for x in zip(*member[g])] if member[g] else c
                     for g, c in enumerate(centroids)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, g, d in found:
        own[g] += d
    return Counter((i, g, d, own[g], sum(own.values()),
                    hashlib.sha256(",".join(map(str, centroids[g])).encode()).hexdigest()) for i, g, d in found)


def test_dictionaries_are_lossless_and_exact():
    rng = np.random.default_rng(1)
    for dimensions, block in ((7, 2), (6, 3), (4, 1), (3, 8)):
        vectors = rng.integers(-9, 9, (200, dimensions))
        centroids = rng.integers(-9, 9, (5, dimensions))
        coded = subvectors.Dictionaries.of(vectors, block)
        assert (coded.vectors() == vectors).all()
        assert all(len(w) <= 18 ** min(block, dimensions) and len(w) == len(np.unique(w, axis=0)) for w in coded.words)
        assert (coded.distances(centroids) == ((vectors[:, None] - centroids[None]) ** 2).sum(2)).all()
        cluster = rng.integers(0, 5, 200)
        assert (coded.sums(cluster, 5) == np.array([vectors[cluster == g].sum(0) for g in range(5)])).all()


def test_clusters_of_awkward_vectors(spark):
    rows = [(i, v) for i, v in VECTORS] + [(400 + k, [0.1] * 6) for k in range(60)]
    frame = spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], "c", "d") for i, v in rows],
                                  "vec_id bigint, embedding array<float>, cluster string, vector string")
    for k in (4, 500):
        got = subvectors.clustered(frame, F.col("embedding"), 6, k, 3, "2:")
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert Counter(tuple(r) for r in got.collect()) == plain_clusters(rows, 6, k, 3, "2:")


def test_chunks_do_not_change_clusters(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = frame.select("vec_id", subvectors.floored(F.col("embedding")).alias("vector"))
    one, a = subvectors.clusters(vectors, 64, 10, 3, "2:", block=2, chunk_rows=10_000)
    two, b = subvectors.clusters(vectors, 64, 10, 3, "2:", block=5, chunk_rows=7)
    assert (a == b).all() and Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="larger than"):
        subvectors.clustered(frame, F.col("embedding"), 2, 3, 2, "2:").collect()


@pytest.mark.parametrize("name", ["op12_centroid_clusters", "op13_exact_dedup"])
def test_sql_twins(spark, name):
    assert run([name], "/root/testdata/sf0.001", verbose=False) == {name: []}


# --- exact duplicates ----------------------------------------------------------------------------------------

def plain_duplicates(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for norm, some in groups.items():
        first = min(some, key=lambda r: r[:3])
        for n, r in enumerate(sorted(some, key=lambda r: r[:3])):
            out[r[3], first[3], len(some), n == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(2)
    for slab_bits in (4, 9):
        parts = [rng.integers(0, 2 ** 64, n, dtype=np.uint64) for n in (0, 1, 40, 3000)]
        parts = [np.concatenate((p, parts[3][:50], np.array([0, 2 ** 64 - 1, 2 ** 63], np.uint64))) for p in parts]
        want = Counter(int(x) for p in parts for x in p)
        blocks = defaultdict(list)
        for p in parts:
            values, counts = np.unique(p, return_counts=True)
            for row in exact_dedup.slab_filters(values, counts, slab_bits):
                blocks[row["slab"]].append(exact_dedup.QuotientFilter.unpacked(slab_bits, row))
        got = Counter()
        for slab, filters in blocks.items():
            one = exact_dedup.QuotientFilter.merged(filters[::-1])
            for s, n in zip(one.suffixes().tolist(), one.counts.tolist()):
                got[(slab << (64 - slab_bits)) | s] += n
        assert got == want


def test_repeated_fingerprints_and_routing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_ROWS", 100)
    rows = [(k * 2654435761 % 2 ** 40 << 20,) for k in range(2000)] + [(-5,)] * 700 + [(7,), (7,), (-(2 ** 63),), (-(2 ** 63),)]
    prints = spark.createDataFrame(rows, "fp bigint").repartition(5)
    found = exact_dedup.repeated_fingerprints(prints, len(rows))
    want = {k: n for k, n in Counter(r[0] for r in rows).items() if n > 1}
    assert {r.fp: r.n for r in found.collect()} == want
    bitmap = exact_dedup.routing_bitmap(found)
    passed = prints.filter(exact_dedup.routed(F.col("fp"), bitmap))
    assert set(want) <= {r.fp for r in passed.collect()} and passed.count() < 900


def test_exact_duplicates_of_awkward_rows(spark, tmp_path):
    rows = [r[:2] for r in tables.ROWS] + [(30, "a b"), (31, "a  b"), (29, "ab"), (32, "a b"), (33, "A b"), (34, "  a b"),
                                         (35, "ab"), (35, "ab"), (20, "  a b"), (36, " \n"), (37, "a\x00b"), (38, "a\x00b ")]
    path = tables.write(tmp_path, [(i, t, "en", "a") for i, t in rows])
    got = E.queries()["op13_exact_dedup"](spark, path).collect()
    assert Counter(tuple(r) for r in got) == plain_duplicates(rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = exact_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_a_digest_collision_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, bits: F.lit("00"))
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b")], "doc_id bigint, text string")
    with pytest.raises(Exception, match="same SHA-256"):
        exact_dedup.exact_duplicates(docs).collect()
