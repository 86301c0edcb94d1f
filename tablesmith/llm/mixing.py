"""Mix sources to target weights by systematic sampling of their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.llm.common import OWN, ranked, small, stage_table

#: Candidates for a source's offset.
OFFSETS = 32

#: A word: a run of other characters than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """``sizes(source, source_size)``, one row per source, with ``target``: how many words the mix takes of it.

    Sources in code-point order, null last, get ``weights`` in turn and share the sum of all sizes; no target is
    above ``most`` times its source's size. Resharing what is above by weight, until none is, ends at one level L
    with target = min(most * size, weight * L): with the sources in order of size / weight, L is the rest of the
    sum over the rest of the weights at the first source that isn't cut. Two windows over one row per source.
    """
    kth = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.lit(0.0) + F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                     ((F.row_number().over(kth) - 1) % len(weights) + 1).cast("int"))
    given = sizes.withColumn("weight", turn)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy()
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cut = F.lit(float(most)) * F.col("source_size")
    level = ((F.sum("source_size").over(every) - F.lit(float(most)) * F.coalesce(F.sum("source_size").over(upto), F.lit(0)))
             / F.sum("weight").over(onward))
    held = given.withColumn("level", level).withColumn("cut", F.col("weight") * F.col("level") > cut)
    final = F.min(F.when(~F.col("cut"), F.struct(F.col("source_size") / F.col("weight"), F.col("level")))).over(every)
    return held.withColumn("final", final["level"]).select(
        "source", "source_size",
        F.when(F.col("final").isNull(), cut).otherwise(F.least(cut, F.col("weight") * F.col("final"))).alias("target"))


def seeded(seed: int, *columns: str) -> Column:
    """Hexadecimal MD5 of the seed and the columns' values, null as "null"; any SQL engine has it."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *values))


def systematic_copies(rows: DataFrame, weights: tuple[float, ...], most: float, seed: int) -> DataFrame:
    """Narrow ``rows`` with ``doc_id``, ``source`` and ``size`` get ``source_size``, ``target`` and ``copies``.

    A document of a source is expected target / source_size times. The documents of a source stand in the order
    of a hash of id and size, then of the columns; the prefix sum of their expected copies, plus one offset per source, crosses
    integers: each crossing emits the document once. Hence a document has at most ceil(target / source_size)
    copies, never over ``most``. The offset is drawn from ``seed``: of OFFSETS candidates, evenly apart from a
    random start, the one whose words come nearest to the target (the first, if several do), since in a source
    of few documents a single one may weigh much. Equal rows are interchangeable; reruns agree.
    """
    columns, rank, of = rows.columns, OWN + "rank", OWN + "source"
    tie = seeded(seed, "doc_id", "size")
    order = ranked(rows.withColumns({OWN + "null": F.col("source").isNull(), OWN + "tie": tie}),
                   [OWN + "null", "source", OWN + "tie", *columns], rank)
    per_source = order.groupBy("source").agg(F.sum("size").alias("source_size"), F.min(rank).alias(OWN + "first"))
    firsts = per_source.select(F.col("source").alias(of), OWN + "first")
    goals = targets(per_source.select("source", "source_size"), weights, most)
    # one row per source: broadcast if the rows, once counted, are few
    plan = goals.join(firsts, F.col("source").eqNullSafe(F.col(of))).drop("source")
    begin = F.conv(F.substring(seeded(seed, of), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    plan = small(plan.withColumns({
        "rate": F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)),
        "begin": begin / OFFSETS}))
    planned = order.join(plan, F.col("source").eqNullSafe(F.col(of)))
    sums = [F.sum(F.col("size") * crossed(rank, F.col("begin") + k / OFFSETS)).alias(f"k{k}") for k in range(OFFSETS)]
    tried = planned.groupBy("source").agg(F.first("target").alias("target"), F.first("begin").alias("begin"), *sums)
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"k{k}") - F.col("target")), F.lit(k).alias("k"))
                                    for k in range(OFFSETS)]))["k"]
    offsets = small(tried.select(F.col("source").alias(of + "2"), (F.col("begin") + nearest / OFFSETS).alias("offset")))
    return (planned.join(offsets, F.col("source").eqNullSafe(F.col(of + "2")))
            .select(*columns, "source_size", "target", crossed(rank, F.col("offset")).cast("int").alias("copies")))


def crossed(rank: str, offset: Column) -> Column:
    """The integers that the prefix sum of ``rate`` crosses at a row, from ``offset``."""
    k = F.col(rank) - F.col(OWN + "first")
    many = F.floor(offset + F.col("rate") * (k + 1)) - F.floor(offset + F.col("rate") * k)
    return F.least(many, F.ceil(F.col("rate") - F.lit(1e-9)))  # a sum of doubles may round across one more


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0,
                  seed: int = 7) -> DataFrame:
    """How often the mix takes each document: ``(doc_id, source, size, source_size, target, copies, taken)``.

    One row per input row; ``size`` is the number of words (null and empty texts: 0) and ``taken`` is copies *
    size. Null sources are a source of their own. Documents of a source without any word are taken once. An
    empty table gives an empty one. Other columns aren't read.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return (systematic_copies(rows, weights, most, seed)
            .withColumn("taken", F.col("copies") * F.col("size")))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0,
          seed: int = 7) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, each as many times as it is taken (0 to ``most``).

    The rows are written once with a tag; ranks are computed on narrow rows, and the copies joined by tag.
    """
    tag = OWN + "row"
    kept = stage_table(docs.withColumn(tag, F.monotonically_increasing_id()), "mix")
    rows = kept.select("doc_id", "source", word_count(F.col("text")).alias("size"), tag)
    copies = (systematic_copies(rows, weights, most, seed).filter("copies > 0")
              .select(tag, F.sequence(F.lit(1), F.col("copies")).alias(OWN + "copies")))
    return kept.join(copies, tag).withColumn(OWN + "copy", F.explode(OWN + "copies")).select(*docs.columns)
