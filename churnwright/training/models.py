"""Feature assembly, learners, scoring and importance."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``n / (2 n_class)`` as a weight column; null for a row without a 0/1 label."""
    y = F.col(label)
    counts = df.groupBy().agg(F.struct(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")).alias("c")).scalar()
    held = df.withColumn("_c", counts)
    n = F.col("_c.pos") + F.col("_c.neg")
    own = F.when(y == 1, F.col("_c.pos")).when(y == 0, F.col("_c.neg"))
    return held.withColumn(out, n / (2.0 * own)).drop("_c")


def feature_stages(numeric: Sequence[str], categories: Sequence[str], one_hot: bool, out: str = "features") -> list[Estimator]:
    """Numbers pass through; categories are indexed, and one-hot encoded if asked. Unseen values are kept apart."""
    indexed = [f"{c}__ix" for c in categories]
    stages: list = []
    if categories:
        stages.append(StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep", stringOrderType="frequencyDesc"))
    coded = indexed
    if one_hot and categories:
        coded = [f"{c}__oh" for c in categories]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=coded, handleInvalid="keep", dropLast=False))
    stages.append(VectorAssembler(inputCols=[*numeric, *coded], outputCol=out, handleInvalid="keep"))
    return stages


def boosted_trees(
    label: str,
    *,
    rounds: int = 20,
    depth: int = 4,
    rate: float = 0.1,
    seed: int = 42,
    validation: str | None = None,
    tolerance: float = 0.01,
    rows: float = 1.0,
    columns: str = "all",
    weight: str | None = None,
    bins: int = 64,
) -> GBTClassifier:
    """Gradient-boosted trees. ``rows`` and ``columns`` are sampled per tree.

    With a validation flag column they stop at the first round that gains less than ``tolerance``; for stopping with
    patience fit all rounds and cut them with ``best_round``. Spark's trees have no L2 penalty.
    """
    g = GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, maxBins=bins,
        subsamplingRate=rows, featureSubsetStrategy=columns, validationTol=tolerance,
    )
    if validation:
        g = g.setValidationIndicatorCol(validation)
    return g.setWeightCol(weight) if weight else g


def validation_curve(model: PipelineModel, valid: DataFrame) -> list[float]:
    """The loss on the validation rows after each round, in one pass."""
    learner = model.stages[-1]
    prepared = PipelineModel(model.stages[:-1]).transform(valid)
    return list(learner.evaluateEachIteration(prepared))


def best_round(losses: Sequence[float], patience: int = 50) -> int:
    """The round (from 1) of the least loss before ``patience`` rounds without a gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def cut_rounds(model: PipelineModel, rounds: int) -> Column:
    """The margin of the first ``rounds`` trees, as a column over the model's transformed rows: class 1 if positive."""
    learner = model.stages[-1]
    trees = F.lit(0.0)
    for tree, weight in list(zip(learner.trees, learner.treeWeights, strict=True))[:rounds]:
        trees = trees + F.expr(_tree_text(tree._java_obj.rootNode())) * float(weight)
    return trees


def _tree_text(node) -> str:
    if node.numDescendants() == 0:
        return repr(float(node.prediction()))
    split = node.split()
    at = f"vector_to_array_col[{split.featureIndex()}]"
    if split.getClass().getSimpleName() == "ContinuousSplit":
        test = f"{at} <= {split.threshold()!r}"
    else:
        test = f"{at} IN ({', '.join(repr(float(c)) for c in split.leftCategories())})"
    return f"CASE WHEN {test} THEN {_tree_text(node.leftChild())} ELSE {_tree_text(node.rightChild())} END"


def score_cut(model: PipelineModel, df: DataFrame, rounds: int, keep: Sequence[str], out: str = "score") -> DataFrame:
    """Probability of class 1 by the first ``rounds`` trees only."""
    prepared = PipelineModel(model.stages[:-1]).transform(df).withColumn("vector_to_array_col", vector_to_array("features"))
    return prepared.select(*keep, (1 / (1 + F.exp(-2 * cut_rounds(model, rounds)))).alias(out))


def logistic(label: str, *, weight: str | None = None, rounds: int = 50, reg: float = 0.0) -> LogisticRegression:
    m = LogisticRegression(labelCol=label, featuresCol="features", maxIter=rounds, regParam=reg)
    return m.setWeightCol(weight) if weight else m


def forest(label: str, *, weight: str | None = None, trees: int = 20, depth: int = 5, seed: int = 42, bins: int = 64) -> RandomForestClassifier:
    m = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, maxBins=bins)
    return m.setWeightCol(weight) if weight else m


def fit(df: DataFrame, stages: Sequence[Estimator], learner: Estimator) -> PipelineModel:
    return Pipeline(stages=[*stages, learner]).fit(df)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str | Column], out: str = "score") -> DataFrame:
    """Probability of class 1; the decision value if the model gives no probability, else its label."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        value = vector_to_array("probability")[1]
    elif "rawPrediction" in scored.columns:
        value = vector_to_array("rawPrediction")[1]
    else:
        value = F.col("prediction").cast("double")
    return scored.select(*keep, value.alias(out))


def score_foreign(df: DataFrame, load: Callable[[], Callable], features: Sequence[str], keep: Sequence[str], out: str = "score") -> DataFrame:
    """Score with a model from another library, in Arrow batches. ``load`` runs once per task and returns the scorer."""
    wanted = df.select(*keep, *features)
    schema = wanted.select(*keep).withColumn(out, F.lit(0.0)).schema

    def run(batches: Iterator) -> Iterator:
        scorer = load()
        for pdf in batches:
            part = pdf[list(keep)].copy()
            part[out] = scorer(pdf[list(features)])
            yield part

    return wanted.mapInPandas(run, schema)


def importances(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """``(feature, importance)``, largest first. One row per model feature."""
    learner = model.stages[-1]
    values = learner.featureImportances.toArray() if hasattr(learner, "featureImportances") else abs(learner.coefficients.toArray())
    attrs = scored.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(values)]
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
