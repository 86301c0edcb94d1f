"""Second-order gradient boosting of trees on Spark (M4): histograms of gradients and Hessians, one aggregate a level.

Numeric features are cut at exact quantiles, categorical ones are replaced by ordered target statistics. Each level of
a tree is one job: sums of gradient and Hessian per (node, feature, bin), combined on the map side; the best split of
each node is chosen from that table, whose size depends on nodes, features and bins but not on the rows. Only the
chosen splits, at most one per node, reach the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesmith.functions.columns import clean_value, quote, safe_div
from tablesmith.functions.cumulative import exact_quantiles, running_totals

#: Trees between two checkpoints of the rows' margins: so many trees' conditions are evaluated anew per level at most.
KEEP_EVERY = 5


@dataclass(frozen=True)
class BoostingParams:
    """Strengths and bounds; ``base`` is the probability that the first tree starts from."""
    trees: int = 20
    depth: int = 3
    rate: float = 0.3
    l2: float = 1.0
    least_gain: float = 0.0
    least_hessian: float = 1.0
    bins: int = 32
    base: float = 0.5
    prior_weight: float = 1.0
    seed: int = 42


@dataclass
class Node:
    """A split (rows with at most ``bin`` cuts of ``feature`` below their value go left) or a leaf's weight."""
    feature: int | None
    bin: int | None
    missing_left: bool
    gain: float | None
    weight: float
    hessian: float
    rows: int


Tree = dict[int, Node]  # by number: 1 is the root, the children of k are 2 k and 2 k + 1


@dataclass
class BoostedTrees:
    """A fitted model; ``encodings`` has the categories' target sums and counts of all training rows."""
    numeric: list[str]
    categorical: list[str]
    params: BoostingParams
    cuts: list[list[float]]
    prior: float
    encodings: DataFrame | None
    trees: list[Tree] = field(default_factory=list)

    def names(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def transform(self, df: DataFrame, probability: str = "probability") -> DataFrame:
        """``df`` with the probability of label 1. Unseen and missing categories of training-time statistics have the
        prior or their own; missing numbers go where each split sends them."""
        encoded = self._encoded(df)
        values = [F.col(f"_v{i}") for i in range(len(self.names()))]
        forest, cuts, params = self.trees, self.cuts, self.params

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                binned = [_binned(c.to_numpy(dtype=np.float64, na_value=np.nan), k) for c, k in zip(columns, cuts)]
                yield pd.Series(_probabilities(forest, binned, params))

        return encoded.withColumn(probability, score(*values)).select(*[quote(c) for c in df.columns], probability)

    def _encoded(self, df: DataFrame) -> DataFrame:
        out = df.withColumns({f"_v{i}": clean_value(df, c).cast("double") for i, c in enumerate(self.numeric)})
        for k, c in enumerate(self.categorical):
            known = self.encodings.filter(F.col("feature") == k).select(
                F.col("category").alias("_category"), _statistic("sum", "n", self.prior, self.params).alias("_known"))
            out = (out.withColumn("_category", _category(c)).join(known, "_category", "left")
                   .withColumn(f"_v{len(self.numeric) + k}", F.coalesce("_known", F.lit(self.prior)))
                   .drop("_category", "_known"))
        return out

    def importance(self) -> dict[str, float]:
        """Gain per feature, summed over all splits."""
        out = dict.fromkeys(self.names(), 0.0)
        for tree in self.trees:
            for node in tree.values():
                if node.feature is not None:
                    out[self.names()[node.feature]] += node.gain
        return out

    def save(self, path: str) -> None:
        """Trees and cuts as one JSON row, encodings as a table, below ``path``; must not exist yet."""
        spark = SparkSession.getActiveSession()
        made = {"numeric": self.numeric, "categorical": self.categorical, "params": vars(self.params), "cuts": self.cuts,
                "prior": self.prior, "trees": [{k: vars(n) for k, n in t.items()} for t in self.trees]}
        if self.encodings is not None:
            self.encodings.write.parquet(f"{path}/encodings")
        spark.createDataFrame([(json.dumps(made),)], "model string").write.text(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        made = json.loads(spark.read.text(f"{path}/model").first()[0])
        encodings = spark.read.parquet(f"{path}/encodings") if made["categorical"] else None
        return cls(made["numeric"], made["categorical"], BoostingParams(**made["params"]), made["cuts"], made["prior"],
                   encodings, [{int(k): Node(**n) for k, n in t.items()} for t in made["trees"]])


def _binned(values: np.ndarray, cuts: list[float]) -> np.ndarray:
    """How many cuts lie below each value; -1 if it is missing."""
    return np.where(np.isnan(values), -1, np.searchsorted(np.array(cuts), values, side="left"))


def _probabilities(forest: list[Tree], binned: list[np.ndarray], params: BoostingParams) -> np.ndarray:
    rows = len(binned[0]) if binned else 0
    margin = np.full(rows, _logit(params.base))
    for tree in forest:
        at = np.ones(rows, dtype=np.int64)
        for number in sorted(tree):
            node = tree[number]
            here = at == number
            if node.feature is None:
                margin[here] += params.rate * node.weight
            else:
                own = binned[node.feature][here]
                left = np.where(own < 0, node.missing_left, own <= node.bin)
                at[here] = 2 * number + ~left
    return 1 / (1 + np.exp(-margin))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _category(name: str) -> Column:
    """A category's name; missing is a category of its own."""
    text = F.col(quote(name)).cast("string")
    return F.when(text.isNull(), F.lit("missing")).otherwise(F.concat(F.lit("="), text))


def _statistic(total: str, n: str, prior: float, params: BoostingParams) -> Column:
    a = params.prior_weight
    return (F.col(total) + F.lit(a * prior)) / (F.col(n) + F.lit(a))


def target_statistics(df: DataFrame, key: str, label: str, categorical: list[str], prior: float,
                      params: BoostingParams) -> tuple[DataFrame, DataFrame]:
    """Ordered target statistics ``(key, _t0, _t1, ...)`` and the categories' totals ``(feature, category, sum, n)``.

    The rows are put in the order of ``md5(key:seed)``. A row's statistic of a category is the share of label 1 among
    the rows of that category before it, drawn to ``prior`` by ``prior_weight`` rows: a row's own label is never in it.
    The prefix sums are two-level running totals over (feature, category), so a category may hold any part of the rows.
    """
    order = F.md5(F.concat_ws(":", F.col(quote(key)).cast("string"), F.lit(str(params.seed))))
    entries = F.array(*[F.struct(F.lit(i).alias("feature"), _category(c).alias("category"))
                        for i, c in enumerate(categorical)])
    long = (df.select(F.col(quote(key)).alias("_key"), order.alias("_order"), F.col(quote(label)).cast("double").alias("_y"),
                      F.explode(entries).alias("_e"))
            .select("_key", "_order", "_y", "_e.*", F.lit(1.0).alias("_one")))
    before = running_totals(long, ["feature", "category"], "_order", ["_y", "_one"])
    known = before.withColumns({"_y0": F.col("cum__y") - F.col("_y"), "_n0": F.col("cum__one") - F.col("_one")})
    value = _statistic("_y0", "_n0", prior, params)
    wide = known.groupBy("_key").agg(*[F.max(F.when(F.col("feature") == i, value)).alias(f"_t{i}")
                                       for i in range(len(categorical))])
    totals = long.groupBy("feature", "category").agg(F.sum("_y").alias("sum"), F.sum("_one").alias("n"))
    return wide, totals


def quantile_cuts(values: DataFrame, names: list[str], bins: int) -> list[list[float]]:
    """Per column its distinct exact quantiles at 1/bins, 2/bins, ...; missing and infinite values are left out."""
    long = values.unpivot([], names, "column", "value").filter(F.abs("value") < float("inf"))
    found: dict[str, set] = {n: set() for n in names}
    for r in exact_quantiles(long, ["column"], [k / bins for k in range(1, bins)]).collect():  # bins per column
        found[r["column"]].add(r["quantile"])
    return [sorted(found[n]) for n in names]


def _bin(value: Column, cuts: list[float]) -> Column:
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < value)) if cuts else F.lit(0)
    return F.when(value.isNull(), F.lit(-1)).otherwise(below).cast("int")


def _place(tree: Tree) -> Column:
    """The number of the deepest node that a row reaches in an unfinished or finished tree."""
    def below(number: int) -> Column:
        node = tree.get(number)
        if node is None or node.feature is None:
            return F.lit(number)
        own = F.col(f"_b{node.feature}")
        left = F.when(own < 0, F.lit(node.missing_left)).otherwise(own <= node.bin)
        return F.when(left, below(2 * number)).otherwise(below(2 * number + 1))
    return below(1)


def _leaf(tree: Tree) -> Column:
    weight = F.lit(0.0)
    for number, node in tree.items():
        if node.feature is None:
            weight = F.when(F.col("_at") == number, F.lit(node.weight)).otherwise(weight)
    return weight


def histogram(rows: DataFrame, features: int) -> DataFrame:
    """``(node, feature, bin, g, h, n)``: the sums of ``_g`` and ``_h`` of the rows at node ``_at``, in one aggregate."""
    return (rows.select("_at", "_g", "_h", F.posexplode(F.array(*[F.col(f"_b{i}") for i in range(features)])))
            .groupBy(F.col("_at").alias("node"), F.col("pos").alias("feature"), F.col("col").alias("bin"))
            .agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"), F.count(F.lit(1)).alias("n")))


def best_splits(hist: DataFrame, params: BoostingParams) -> DataFrame:
    """``(node, feature, bin, missing_left, gain)``: each node's split with the largest gain, if one is above 0.

    gain = (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2 - least_gain, with the rows without a value on the
    right or on the left. Both sides need ``least_hessian``. Ties: smaller feature, bin, then missing on the right.
    """
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    present = F.col("bin") >= 0
    known = hist.withColumns({
        "_G": F.sum("g").over(whole), "_H": F.sum("h").over(whole), "_last": F.max("bin").over(whole),
        **{f"_{c}0": F.coalesce(F.sum(F.when(~present, F.col(c))).over(whole), F.lit(0.0)) for c in ("g", "h")},
        **{f"_{c}L": F.sum(F.when(present, F.col(c)).otherwise(0.0)).over(upto) for c in ("g", "h")}})
    sides = known.filter(present & ((F.col("bin") < F.col("_last")) | (F.col("_h0") > 0))).withColumn(
        "missing_left", F.explode(F.array(F.lit(False), F.lit(True))))
    left = {c: F.col(f"_{c}L") + F.when(F.col("missing_left"), F.col(f"_{c}0")).otherwise(0.0) for c in ("g", "h")}
    sides = sides.withColumns({"_gl": left["g"], "_hl": left["h"]}).withColumns(
        {"_gr": F.col("_G") - F.col("_gl"), "_hr": F.col("_H") - F.col("_hl")})
    part = lambda g, h: safe_div(F.col(g) * F.col(g), F.col(h) + params.l2)
    gain = (part("_gl", "_hl") + part("_gr", "_hr") - part("_G", "_H")) / 2 - params.least_gain
    allowed = (F.col("_hl") >= params.least_hessian) & (F.col("_hr") >= params.least_hessian)
    found = sides.filter(allowed).withColumn("gain", gain).filter("gain > 0")
    first = Window.partitionBy("node").orderBy(F.desc("gain"), "feature", "bin", "missing_left")
    return (found.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1")
            .select("node", "feature", "bin", "missing_left", "gain"))


def grow_tree(rows: DataFrame, features: int, params: BoostingParams) -> Tree:
    """One tree over ``rows`` with bins ``_b0``, ..., gradients ``_g`` and Hessians ``_h``: a job per level."""
    tree: Tree = {}
    for level in range(params.depth + 1):
        placed = rows.withColumn("_at", _place(tree)).filter(F.col("_at") >= 2 ** level)
        hist = histogram(placed, features).checkpoint(eager=True)  # nodes x features x bins rows
        sums = hist.filter("feature = 0").groupBy("node").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
        for r in sums.collect():
            weight = -r["g"] / (r["h"] + params.l2) if r["h"] + params.l2 > 0 else 0.0
            tree[r["node"]] = Node(None, None, False, None, weight, r["h"], r["n"])
        split = best_splits(hist, params).collect() if level < params.depth else []
        for r in split:
            node = tree[r["node"]]
            node.feature, node.bin, node.missing_left, node.gain = r["feature"], r["bin"], r["missing_left"], r["gain"]
        if not split:
            break
    return tree


def fit_boosted_trees(df: DataFrame, key: str, label: str, numeric: list[str], categorical: list[str],
                      params: BoostingParams = BoostingParams()) -> BoostedTrees:
    """Boosted trees of the 0/1 column ``label`` by Newton steps on the log-loss.

    ``key`` names each row (unique, not null). Rows without a label are left out. Infinite numbers are numbers, NaN and
    null are missing. No rows or no features give a model that always answers ``params.base``.
    """
    known = df.filter(F.col(quote(label)).isNotNull())
    prior = known.agg(F.avg(F.col(quote(label)).cast("double"))).first()[0]
    model = BoostedTrees(list(numeric), list(categorical), params, [[] for _ in [*numeric, *categorical]],
                         params.base if prior is None else prior, None)
    if not model.names() or prior is None:
        if categorical:
            model.encodings = df.sparkSession.createDataFrame([], "feature int, category string, sum double, n double")
        return model
    names = [f"_v{i}" for i in range(len(model.names()))]
    values = known.select(F.col(quote(key)).alias("_key"), F.col(quote(label)).cast("double").alias("_y"),
                          *[clean_value(known, c).cast("double").alias(n) for c, n in zip(numeric, names)])
    if categorical:
        wide, totals = target_statistics(known, key, label, categorical, prior, params)
        model.encodings = totals.checkpoint(eager=True)
        values = values.join(wide, "_key").withColumnsRenamed(
            {f"_t{i}": names[len(numeric) + i] for i in range(len(categorical))})
    values = values.checkpoint(eager=True)
    model.cuts = quantile_cuts(values.select(*names), names, params.bins)
    rows = values.select("_y", F.lit(_logit(params.base)).alias("_margin"),
                         *[_bin(F.col(n), c).alias(f"_b{i}") for i, (n, c) in enumerate(zip(names, model.cuts))])
    rows = rows.checkpoint(eager=True)
    for k in range(params.trees):
        p = 1 / (1 + F.exp(-F.col("_margin")))
        tree = grow_tree(rows.withColumns({"_g": p - F.col("_y"), "_h": p * (1 - p)}), len(names), params)
        model.trees.append(tree)
        rows = (rows.withColumn("_at", _place(tree)).withColumn("_margin", F.col("_margin") + params.rate * _leaf(tree))
                .drop("_at"))
        if (k + 1) % KEEP_EVERY == 0:
            rows = rows.checkpoint(eager=True)
    return model


def tree_table(model: BoostedTrees, which: int = 0) -> list[tuple]:
    """Rows ``(node, feature, threshold, missing_left, gain, weight, hessian, n)`` of one tree, leaves without a split."""
    out = []
    for number, n in sorted(model.trees[which].items()):
        split = (model.names()[n.feature], model.cuts[n.feature][n.bin] if n.bin < len(model.cuts[n.feature]) else None,
                 n.missing_left, n.gain) if n.feature is not None else (None, None, False, None)
        out.append((number, *split, n.weight, n.hessian, n.rows))
    return out
