"""Boosted trees with an L2 penalty on the leaves, and what each feature adds to a row's margin.

A round fits a regression tree to the rows' negative gradients, which gives the splits. One
aggregate then adds up gradient G and curvature H of the log loss per leaf, and the leaf's
value becomes ``-rate * G / (H + l2)``. The rows' margin is carried in a staged table, so
a round reads one column and the newest trees, however many rounds came before.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwright.functions import hex_bound, seed_key
from churnwright.session import stage

STAGE_EVERY = 8  # rounds whose trees are added up on the fly before the margin is written again
VECTOR = "_x"


@dataclass
class Node:
    """A split with its two sides, or a leaf; gradient and curvature are those of the rows that reach it."""

    feature: int = -1
    test: str = ""
    left: Node | None = None
    right: Node | None = None
    g: float = 0.0
    h: float = 0.0

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else [*self.left.leaves(), *self.right.leaves()]

    def add_up(self) -> None:
        """Sums of a split are those of its leaves."""
        if self.left is not None:
            self.left.add_up()
            self.right.add_up()
            self.g, self.h = self.left.g + self.right.g, self.left.h + self.right.h


@dataclass
class Boosted:
    """Feature stages, base margin and trees."""

    features: PipelineModel
    names: list[str]
    base: float
    rate: float
    l2: float
    trees: list[Node] = field(default_factory=list)

    def value(self, node: Node) -> float:
        return -self.rate * node.g / (node.h + self.l2) if node.h + self.l2 > 0 else 0.0

    def margin(self, trees: Sequence[Node] | None = None) -> Column:
        """The summed leaf values of ``trees`` (default: base and all of them) over rows with ``VECTOR``."""
        chosen = self.trees if trees is None else trees
        out = F.lit(self.base if trees is None else 0.0)
        for tree in chosen:
            out = out + F.expr(tree_text(tree, lambda n: number(self.value(n))))
        return out

    def prepared(self, df: DataFrame) -> DataFrame:
        return self.features.transform(df).withColumn(VECTOR, vector_to_array("features"))

    def score(self, df: DataFrame, keep: Sequence[str | Column], out: str = "score") -> DataFrame:
        """Probability of class 1."""
        return self.prepared(df).select(*keep, sigmoid(self.margin()).alias(out))


def number(value: float) -> str:
    """A double in SQL; without the suffix it would be read as a decimal."""
    return f"{float(value)!r}D"


def sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def read_tree(node) -> Node:
    """A fitted Spark tree as nodes whose tests are SQL over ``VECTOR``."""
    if node.numDescendants() == 0:
        return Node()
    split = node.split()
    at = f"{VECTOR}[{split.featureIndex()}]"
    if split.getClass().getSimpleName() == "ContinuousSplit":
        test = f"{at} <= {number(split.threshold())}"
    else:
        test = f"{at} IN ({', '.join(number(c) for c in split.leftCategories())})"
    return Node(split.featureIndex(), test, read_tree(node.leftChild()), read_tree(node.rightChild()))


def tree_text(node: Node, leaf) -> str:
    if node.left is None:
        return leaf(node)
    return f"CASE WHEN {node.test} THEN {tree_text(node.left, leaf)} ELSE {tree_text(node.right, leaf)} END"


def fit_boosted(
    df: DataFrame, stages: Sequence[Estimator], label: str, *, rounds: int = 20, depth: int = 4, rate: float = 0.1, l2: float = 5.0,
    weight: str | None = None, key: str | None = None, rows: float = 1.0, seed: int = 42, bins: int = 64, min_rows: int = 1,
) -> Boosted:
    """Boosted trees for a 0/1 label; rows without one are left out.

    With ``rows`` below 1 the splits of a round are found on that share of the rows, drawn anew by ``key``; the sums per
    leaf are over all rows. What reaches the driver is a tree and two sums per leaf.
    """
    known = df.where(F.col(label).isNotNull())
    features = Pipeline(stages=list(stages)).fit(known)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    kept = [F.col(key).alias("_key")] if key else []
    shown = features.transform(known)
    ready = stage(shown.select(*kept, "features", vector_to_array("features").alias(VECTOR), F.col(label).cast("double").alias("_y"), w.alias("_w")), "boosting")
    rate_of = ready.groupBy().agg(F.sum(F.col("_w") * F.col("_y")).alias("p"), F.sum("_w").alias("n")).first()
    share = min(max(rate_of["p"] / rate_of["n"], 1e-9), 1 - 1e-9)
    model = Boosted(features, feature_names(shown), math.log(share / (1 - share)), rate, l2)
    now, added = ready.withColumn("_m", F.lit(model.base)), []
    for r in range(rounds):
        p = sigmoid(F.col("_m") + model.margin(added))
        current = now.withColumn("_p", p).withColumn("_r", F.col("_y") - F.col("_p"))
        drawn = current.where(F.substring(seed_key(seed + r, "_key"), 1, 8) < hex_bound(rows)) if rows < 1 and key else current
        grown = DecisionTreeRegressor(
            featuresCol="features", labelCol="_r", weightCol="_w", maxDepth=depth, maxBins=bins, seed=seed, minInstancesPerNode=min_rows
        ).fit(drawn.select("features", "_r", "_w"))
        tree = read_tree(grown._java_obj.rootNode())
        leaves = tree.leaves()
        number = {id(n): str(i) for i, n in enumerate(leaves)}
        at = F.expr(tree_text(tree, lambda n, number=number: number[id(n)]))
        g, h = F.col("_w") * (F.col("_p") - F.col("_y")), F.col("_w") * F.col("_p") * (1 - F.col("_p"))
        for s in current.groupBy(at.alias("leaf")).agg(F.sum(g).alias("g"), F.sum(h).alias("h")).collect():  # one row per leaf
            leaves[int(s["leaf"])].g, leaves[int(s["leaf"])].h = s["g"], s["h"]
        tree.add_up()
        model.trees.append(tree)
        added.append(tree)
        if len(added) == STAGE_EVERY and r + 1 < rounds:
            now = stage(now.withColumn("_m", F.col("_m") + model.margin(added)), "boosting")
            added = []
    return model


def feature_names(shown: DataFrame) -> list[str]:
    """The names of the vector's places."""
    attrs = shown.schema["features"].metadata.get("ml_attr", {})
    named = {a["idx"]: a["name"] for group in attrs.get("attrs", {}).values() for a in group}
    return [named.get(i, f"f{i}") for i in range(attrs.get("num_attrs", len(named)))]


def contributions(model: Boosted, df: DataFrame, keep: Sequence[str | Column]) -> DataFrame:
    """``(keep..., base, contributions, margin)``: what each feature adds to the row's margin, in the order of ``model.names``.

    Along a row's path through a tree, each split moves the expected value from that of the node to that of the side
    taken; the move is the split feature's. ``base`` and the contributions add up to the margin.
    """
    base = model.base + sum(model.value(t) for t in model.trees)

    def moves(node: Node, feature: int) -> str | None:
        """The feature's moves along the path, or None where a part of the tree never asks for it."""
        if node.left is None:
            return None
        sides = [moves(s, feature) for s in (node.left, node.right)]
        if node.feature == feature:
            own = [number(model.value(s) - model.value(node)) for s in (node.left, node.right)]
            sides = [o if s is None else f"{o} + ({s})" for o, s in zip(own, sides, strict=True)]
        if sides == [None, None]:
            return None
        return f"CASE WHEN {node.test} THEN {sides[0] or '0D'} ELSE {sides[1] or '0D'} END"

    def total(feature: int) -> Column:
        out = F.lit(0.0)
        for tree in model.trees:
            if (text := moves(tree, feature)) is not None:
                out = out + F.expr(text)
        return out

    return model.prepared(df).select(
        *keep, F.lit(base).alias("base"), F.array(*[total(i) for i in range(len(model.names))]).alias("contributions"), model.margin().alias("margin")
    )


def attribution(explained: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, mean_abs, rank)`` of ``contributions``, the form that ``monitoring.attribution_drift`` compares."""
    wide = explained.groupBy(*by).agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f"f{i}") for i in range(len(names))])
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"f{i}").alias("mean_abs")) for i, n in enumerate(names)])
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("mean_abs"), "feature")  # one row per feature in each group
    return wide.select(*by, F.inline(rows)).withColumn("rank", F.row_number().over(w))
