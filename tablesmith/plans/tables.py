"""Test-table roles (see SURVEY section 7) as DataFrames over the driver's parquet files.

* ``bookings``: booking-like facts, orders joined with their customer; key ``o_orderkey``; numeric
  ``o_totalprice``, ``c_acctbal`` (has negatives, like a rate column), ``c_nationkey``, ``o_year``;
  categorical ``o_orderpriority``, ``c_mktsegment``; multi-class target ``o_orderstatus``, binary
  ``is_filled`` (status F).
* ``bookings_gappy``: the same with missing values where the data say so (no row-id rules): a negative
  balance is unknown, and the total price of low-priority orders was not recorded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "o_orderkey"
TARGET = "o_orderstatus"
BINARY_TARGET = "is_filled"
NUMERIC = ["o_totalprice", "c_acctbal", "c_nationkey", "o_year"]
CATEGORICAL = ["o_orderpriority", "c_mktsegment"]
SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    # both sides grow with the data: a shuffle join on the key (AQE may still broadcast a small customer side)
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(
        "o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey",
        F.year("o_orderdate").alias("o_year"), "o_orderpriority", "c_mktsegment", "o_orderstatus",
        (F.col("o_orderstatus") == "F").cast("int").alias("is_filled"))


def bookings_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bookings(spark, sf_dir)
    return b.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        "c_nationkey", "o_year",
        F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("o_orderpriority")).alias("o_orderpriority"),
        "c_mktsegment", "o_orderstatus", "is_filled")


def bookings_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split is a stage table read by several aggregates: written once (reliable checkpoint in the
    session's ``spark.checkpoint.dir``) so its join and ranking are not recomputed per branch."""
    from tablesmith.operators.split import stratified_split
    from tablesmith.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return stratified_split(bookings(spark, sf_dir), KEY, TARGET, (0.7, 0.15, 0.15), SEED).checkpoint(eager=True)


def planted_shift(split: DataFrame, current: str = "test") -> DataFrame:
    """A split whose current part has drifted where the drift plans should find it: prices 20 % up, a category
    renamed, and a copy of ``is_filled`` that is 1 for the renamed category. Other columns stay as they are."""
    now = F.col("split") == current
    low = F.col("o_orderpriority") == "5-LOW"
    return split.withColumns({
        "is_filled_shifted": F.when(now & low, 1).otherwise(F.col("is_filled")),
        "o_totalprice": F.when(now, F.col("o_totalprice") * 1.2).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(now & low, "6-NONE").otherwise(F.col("o_orderpriority"))})


def bookings_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the bookings before and from 1995-06-17 (``_side`` 0 and 1; not stratified), joined again with
    their target by key (J1): the target drifts between such parts, most features don't."""
    from tablesmith.operators.relate import join_target
    b = bookings(spark, sf_dir)
    dates = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderdate") >= F.lit("1995-06-17").cast("date"))
                                                  .cast("int").alias("_side"))
    features = b.drop(TARGET).join(dates, "o_orderkey")
    return join_target(features, b.select(KEY, TARGET), KEY)


def bookings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings as an uncleaned source: a constant column, missing prices (low-priority orders), and a
    balance score with -inf / +inf / NaN where the balance says so (below -900, above 9900, negative)."""
    b = bookings(spark, sf_dir)
    bal = F.col("c_acctbal")
    score = (F.when(bal < -900, F.lit(float("-inf"))).when(bal > 9900, F.lit(float("inf")))
             .when(bal < 0, F.lit(float("nan"))).otherwise(F.log1p(bal)))
    return b.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        "c_acctbal", "c_nationkey", "o_year", "o_orderpriority", "c_mktsegment", "o_orderstatus", "is_filled",
        F.lit("web").alias("channel"), score.alias("balance_score"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnable target: document quality label with a deterministic score (a rational function of the
    length, bit-identical across engines, with ties) standing in for a model probability."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = lab.join(d, "doc_id")
    return j.select("doc_id", F.col("quality").alias("label"),
                    (F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))).alias("score"),
                    "n_chars", "lang", "source")


def gappy_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified split of ``bookings_gappy`` (stage table, checkpointed like ``bookings_split``)."""
    from tablesmith.operators.split import stratified_split
    from tablesmith.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return stratified_split(bookings_gappy(spark, sf_dir), KEY, TARGET, (0.7, 0.15, 0.15), SEED).checkpoint(eager=True)


def train_part(split_df: DataFrame) -> DataFrame:
    return split_df.filter(F.col("split") == "train")


def documents_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified split of the scored documents by label (stage table, checkpointed)."""
    from tablesmith.operators.split import stratified_split
    from tablesmith.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return stratified_split(scored_documents(spark, sf_dir), "doc_id", "label", (0.7, 0.15, 0.15),
                            SEED).checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for a plan's written tables."""
    import uuid
    from tablesmith.session import stage_path
    return stage_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
