"""The registered queries of the corpus operators and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm import (align, decontam, exact_dedup, html_extract, langid, mixing, pii, sharding, simhash,
                            subvectors, token_counts, topk, toxicity)
from tablesmith.llm.common import read_table

TOKENIZER = "word_bpe_49k.json"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
DIMENSIONS, CENTROIDS, ROUNDS, FIRST_SALT = 64, 40, 5, "2:"
TOKEN_LIMIT = 2048
SHARDS, VIRTUAL_NODES = 40, 64
MIX_WEIGHTS, MIX_MOST, MIX_SEED = (5.0, 2.0, 1.0), 3.0, 7
SHINGLE_WORDS, SIMHASH_BITS = 3, 2
TOXIC_FROM = 0.7
#: The key of the pseudonyms unless the session's ``spark.tablesmith.pseudonym.key`` names another.
PSEUDONYM_KEY = "tablesmith example key"


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(modulus: int):
    """crc32 of doc_id as text modulo ``modulus`` (null doc_id: 0)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus, F.lit(0))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, tokenizer_file(), TOKEN_LIMIT).drop("text")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_extract.main_texts(pages, html_extract.fit_weights(pages))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS, VIRTUAL_NODES, slack=0.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(5) == 0
    prototypes = langid.fit_prototypes(docs.filter(~held_out))
    predicted = docs.select("doc_id", held_out.alias("held_out"),
                            langid.language(F.col("text"), prototypes).alias("found"))
    return predicted.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    vectors = rows.select("vec_id", topk.floored(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_documents(read_table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_MOST, MIX_SEED)
    return mix.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([{MIX_WEIGHTS[0]}, {MIX_WEIGHTS[1]}, {MIX_WEIGHTS[2]}]
              [(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - CAST({MIX_MOST} AS DOUBLE) * coalesce(sum(source_size) OVER (
                   ORDER BY source_size / weight, source IS NULL, source
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY source_size / weight, source IS NULL, source
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, (SELECT level FROM l WHERE weight * level <= CAST({MIX_MOST} AS DOUBLE) * source_size
                 ORDER BY source_size / weight, level LIMIT 1) AS final FROM l),
t AS (SELECT source, source_size,
             coalesce(least(CAST({MIX_MOST} AS DOUBLE) * source_size, weight * final), CAST({MIX_MOST} AS DOUBLE) * source_size)
               AS target,
             CAST('0x' || substr(md5(concat_ws('|', '{MIX_SEED}', coalesce(source, 'null'))), 1, 8) AS BIGINT)
               / CAST(4294967296 AS DOUBLE) / {mixing.OFFSETS} AS begin FROM f),
k AS (SELECT d.*, t.source_size, t.target, t.begin,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE CAST(1 AS DOUBLE) END AS rate,
             CAST(row_number() OVER (PARTITION BY d.source ORDER BY md5(concat_ws('|', '{MIX_SEED}',
               coalesce(CAST(doc_id AS VARCHAR), 'null'), CAST(size AS VARCHAR))), doc_id, size) - 1 AS DOUBLE) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
tried AS (SELECT source, j, abs(sum(size * least(floor(begin + j / CAST({mixing.OFFSETS} AS DOUBLE) + rate * (k + 1))
                 - floor(begin + j / CAST({mixing.OFFSETS} AS DOUBLE) + rate * k), ceil(rate - 1e-9))) - any_value(target)) AS miss
          FROM k, range({mixing.OFFSETS}) r(j) GROUP BY source, j),
o AS (SELECT source, j FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, j) = 1),
c AS (SELECT k.*, CAST(least(floor(begin + j / CAST({mixing.OFFSETS} AS DOUBLE) + rate * (k + 1))
                 - floor(begin + j / CAST({mixing.OFFSETS} AS DOUBLE) + rate * k), ceil(rate - 1e-9)) AS INTEGER) AS copies
      FROM k JOIN o ON k.source IS NOT DISTINCT FROM o.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target, copies, CAST(copies * size AS BIGINT) AS taken FROM c
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = remainder(3) == 1
    model = toxicity.fit_weights(docs, labels.filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), SHINGLE_WORDS, SIMHASH_BITS)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_pseudonyms(docs, spark.conf.get("spark.tablesmith.pseudonym.key", PSEUDONYM_KEY)).select(
        "doc_id", "text", F.size("found").cast("int").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("found.kind")), ",").alias("kinds"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.scored(read_table(spark, sf_dir, "documents"), tokenizer_file(TOKENIZER_A), tokenizer_file(TOKENIZER_B))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subvectors.clustered(read_table(spark, sf_dir, "embeddings"), F.col("embedding"), DIMENSIONS, CENTROIDS,
                                ROUNDS, FIRST_SALT)


def _op12_sql() -> str:
    """The rounds one after another: distances to all centroids, the nearest one, floored means."""
    square = ("list_sum(list_transform(list_zip(v.e, c.e), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT)))")
    parts = [f"""
k AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIMENSIONS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, e FROM k),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{FIRST_SALT}' || CAST(vec_id AS VARCHAR)), e) - 1 AS INTEGER) AS g, e
  FROM v ORDER BY sha256('{FIRST_SALT}' || CAST(vec_id AS VARCHAR)), e LIMIT {CENTROIDS})"""]
    for n in range(ROUNDS + 1):
        parts.append(f"""
a{n} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(e) AS e, arg_min(g, d * 1000 + g) AS g, min(d) AS d
  FROM (SELECT v.r, v.vec_id, v.e, c.g, {square} AS d FROM v CROSS JOIN c{n} c) GROUP BY r)""")
        if n < ROUNDS:
            parts.append(f"""
m{n} AS (SELECT g, j, sum(CAST(e[j] AS HUGEINT)) AS s, CAST(count(*) AS HUGEINT) AS n
  FROM a{n}, range(1, {DIMENSIONS + 1}) t(j) GROUP BY g, j),
f{n} AS (SELECT g, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS e FROM m{n} GROUP BY g),
c{n + 1} AS MATERIALIZED (SELECT c.g, coalesce(f.e, c.e) AS e FROM c{n} c LEFT JOIN f{n} f ON c.g = f.g)""")
    return f"""WITH {",".join(parts)}
SELECT vec_id, a.g AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.g) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON a.g = c.g
"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm, row_number() OVER w AS k, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_html_extraction, op3_sharding, op4_language_id, op5_top_k, op6_decontamination, op7_mixing,
    op8_toxicity, op9_simhash, op10_pii, op11_token_alignment, op12_centroid_clusters, op13_exact_dedup)}
ORACLES: dict[str, str] = {"op5_top_k": OP5_SQL, "op7_mixing": OP7_SQL, "op12_centroid_clusters": _op12_sql(),
                           "op13_exact_dedup": OP13_SQL}
