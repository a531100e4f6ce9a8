"""Classification metrics of scored rows, per group where ``by`` is given.

Scored rows have a 0/1 label and a score. Everything but the plain confusion counts is
read off one threshold curve: counts per distinct score, run up in score order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwright.functions import count_where, known, ratio
from churnwright.operators.lookups import beside
from churnwright.operators.ordered import ordered_scan
from churnwright.operators.sampling import best_row
from churnwright.session import stage

# Default recall target, the F1 guard and the gap that counts as overfit.
TARGET_RECALL = 0.8
F1_EPS = 1e-12
OVERFIT_GAP = 0.05


def threshold_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, pos, neg, tp, fp, n_pos, n_neg, precision, recall)`` for every distinct score.

    ``tp`` and ``fp`` count the rows with ``score >= threshold``.
    """
    return curve_of_counts(df.withColumn("_one", F.lit(1)), "_one", label, score, by)


def curve_of_counts(df: DataFrame, n: str, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """The threshold curve of rows that stand for ``n`` rows each."""
    by = list(by)
    rows = _with_score(df, label, score)
    y = F.col(label).cast("long")
    hist = stage(
        rows.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(F.sum(y * F.col(n)).alias("pos"), F.sum((1 - y) * F.col(n)).alias("neg")),
        "curve",
    )
    run = ordered_scan(
        hist, ["threshold"], by, before={"_pb": "pos", "_nb": "neg"}, totals={"n_pos": "pos", "n_neg": "neg"}
    )
    tp, fp = F.col("n_pos") - F.col("_pb"), F.col("n_neg") - F.col("_nb")
    return run.select(
        *by, "threshold", "pos", "neg", tp.alias("tp"), fp.alias("fp"), "n_pos", "n_neg",
        (tp.cast("double") / (tp + fp)).alias("precision"),
        F.when(F.col("n_pos") > 0, tp.cast("double") / F.col("n_pos")).alias("recall"),
    )


def _ranking() -> list[Column]:
    neg_below = (F.col("n_neg") - F.col("fp")).cast("double")
    wins = F.sum(F.col("pos") * (neg_below + F.col("neg") * 0.5))
    steps = F.sum(F.col("pos") * F.col("precision"))
    both = (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    return [
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        F.when(both, wins / (F.max("n_pos").cast("double") * F.max("n_neg"))).alias("roc_auc"),
        F.when(F.max("n_pos") > 0, steps / F.max("n_pos")).alias("pr_auc"),
    ]


def ranking_metrics(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n_pos, n_neg, roc_auc, pr_auc)``: ties count half, average precision is a step sum."""
    return curve.groupBy(*by).agg(*_ranking())


def _at_target(target: float) -> tuple[Column, Column, Column]:
    # Along rising thresholds tp and fp only fall, so the highest threshold that still
    # reaches the target has the smallest of both among those that reach it.
    ok = F.col("recall") >= target
    return F.max(F.when(ok, F.col("threshold"))), F.min(F.when(ok, F.col("tp"))), F.min(F.when(ok, F.col("fp")))


def threshold_at_recall(curve: DataFrame, target: float = TARGET_RECALL, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, recall, precision)`` at the highest threshold reaching the target; zeros if none does."""
    thr, tp, fp = _at_target(target)
    best = curve.groupBy(*by).agg(thr.alias("_t"), tp.alias("_tp"), fp.alias("_fp"), F.max("n_pos").alias("_p"))
    zero = F.lit(0.0)
    return best.select(
        *by,
        F.coalesce("_t", zero).alias("threshold"),
        F.coalesce(F.col("_tp").cast("double") / F.col("_p"), zero).alias("recall"),
        F.coalesce(F.col("_tp").cast("double") / (F.col("_tp") + F.col("_fp")), zero).alias("precision"),
    )


def best_f1(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, f1, precision, recall)`` at the largest F1; ties go to the lowest threshold."""
    p, r = F.col("precision"), F.coalesce("recall", F.lit(0.0))
    f1 = 2 * p * r / (p + r + F.lit(F1_EPS))
    scored = curve.withColumn("_f1", f1)
    pick = F.max_by(F.struct("threshold", F.col("_f1").alias("f1"), "precision", "recall"), F.struct("_f1", -F.col("threshold")))
    return scored.groupBy(*by).agg(pick.alias("m")).select(*by, "m.*")


def _with_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """The rows with a label and a score; NaN and the infinities are no scores."""
    rows = df.withColumn(score, known(F.col(score).cast("double")))
    return rows.where(F.col(label).isNotNull() & F.col(score).isNotNull())


def confusion(df: DataFrame, threshold: float | Column, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """``(by..., tn, fp, fn, tp)`` at a fixed threshold, over the rows with a label and a known score."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    rows = _with_score(df, label, score)
    yes, true = F.col(score) >= thr, F.col(label) == 1
    return rows.groupBy(*by).agg(
        count_where(~yes & ~true).alias("tn"),
        count_where(yes & ~true).alias("fp"),
        count_where(~yes & true).alias("fn"),
        count_where(yes & true).alias("tp"),
    )


def rates() -> dict[str, Column]:
    """Rates over the columns ``tn, fp, fn, tp``; a rate with a zero denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    recall, specificity, precision = ratio(tp, tp + fn), ratio(tn, tn + fp), ratio(tp, tp + fp)
    return {
        "accuracy": ratio(tp + tn, n),
        "precision": precision,
        "recall": recall,
        "specificity": specificity,
        "negative_precision": ratio(tn, tn + fn),
        "balanced_accuracy": (recall + specificity) / 2,
        "f1": F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0)),
        "actual_rate": ratio(tp + fn, n),
        "predicted_rate": ratio(tp + fp, n),
    }


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(rates())


def evaluate(curve: DataFrame, target: float = TARGET_RECALL, by: Sequence[str] = ()) -> DataFrame:
    """Everything at once, per group: ranking metrics, the threshold at the recall target and all rates there."""
    thr, tp, fp = _at_target(target)
    # Without a threshold that reaches the target it is 0.0: every row is predicted positive.
    at = [F.coalesce(thr, F.lit(0.0)).alias("threshold"), F.coalesce(tp, F.max("tp")).alias("tp"), F.coalesce(fp, F.max("fp")).alias("fp")]
    both = curve.groupBy(*by).agg(*_ranking(), *at)
    full = both.withColumn("fn", F.col("n_pos") - F.col("tp")).withColumn("tn", F.col("n_neg") - F.col("fp"))
    return with_rates(full)


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., class, precision, recall, f1, support)`` for both classes, then their macro and weighted means."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def entry(name: str, hit: Column, predicted: Column, support: Column) -> Column:
        p, r = ratio(hit, predicted), ratio(hit, support)
        f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), support.alias("support"))

    zero, one = entry("0", tn, tn + fn, tn + fp), entry("1", tp, tp + fp, tp + fn)

    def mean(name: str, weighted: bool) -> Column:
        a, b = zero.getField("support"), one.getField("support")
        def mix(k: str) -> Column:
            x, y = zero.getField(k), one.getField(k)
            return F.when(a + b > 0, (x * a + y * b) / (a + b)) if weighted else (x + y) / 2
        return F.struct(F.lit(name).alias("class"), *[mix(k).alias(k) for k in ("precision", "recall", "f1")], (a + b).alias("support"))

    rows = F.array(zero, one, mean("macro avg", False), mean("weighted avg", True))
    return counts.select(*by, F.inline(rows))


def brier(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    gap = known(F.col(score).cast("double")) - F.col(label)
    return df.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


# Row-level metrics by name; users add their own with ``register_metric``.
ROW_METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "brier": lambda y, s: F.avg((s - y) * (s - y)),
    "log_loss": lambda y, s: F.avg(-F.log(F.when(y == 1, F.greatest(s, F.lit(1e-15))).otherwise(F.greatest(1 - s, F.lit(1e-15))))),
    "mean_score": lambda y, s: F.avg(s),
    "positive_rate": lambda y, s: F.avg(y.cast("double")),
}
CURVE_METRICS = ("roc_auc", "pr_auc", "recall_at_target", "precision_at_target", "threshold_at_target")


def register_metric(name: str, make: Callable[[Column, Column], Column]) -> None:
    """Add a metric: ``make(label, score)`` returns an aggregate column."""
    ROW_METRICS[name] = make


def metric_set(
    df: DataFrame, wanted: Sequence[str], label: str = "label", score: str = "score", by: Sequence[str] = (), target: float = TARGET_RECALL
) -> DataFrame:
    """The metrics in ``wanted``, by name, one row per group. The threshold is always there."""
    unknown = [m for m in wanted if m not in ROW_METRICS and m not in CURVE_METRICS]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    full = evaluate(threshold_curve(df, label, score, by), target, by)
    renamed = {"roc_auc": "roc_auc", "pr_auc": "pr_auc", "recall_at_target": "recall", "precision_at_target": "precision", "threshold_at_target": "threshold"}
    names = [m for m in CURVE_METRICS if m in wanted or m == "threshold_at_target"]
    out = full.select(*by, *[F.col(renamed[m]).alias(m) for m in names])
    rows = [m for m in wanted if m in ROW_METRICS]
    if not rows:
        return out
    scored = _with_score(df, label, score)
    per = scored.groupBy(*by).agg(*[ROW_METRICS[m](F.col(label), F.col(score)).alias(m) for m in rows])
    if by:
        return out.join(per, list(by))
    return beside(out, per)


def overfit_gap(metrics: DataFrame, metric: str, split: str = "split", by: Sequence[str] = (), limit: float = OVERFIT_GAP) -> DataFrame:
    """``(by..., train, valid, gap, overfit)`` from a table with one row per split."""
    of = lambda s: F.max(F.when(F.col(split) == s, F.col(metric)))
    return (
        metrics.groupBy(*by)
        .agg(of("train").alias("train"), of("valid").alias("valid"))
        .withColumn("gap", F.col("train") - F.col("valid"))
        .withColumn("overfit", F.col("gap") > limit)
    )


def compare_models(metrics: DataFrame, model: str = "model", order: Sequence[str] = ("roc_auc",), by: Sequence[str] = ()) -> DataFrame:
    """All rows with a ``winner`` flag: the best by the metrics in turn, ties to the first name."""
    best = best_row(metrics, order, model, by).select(*by, F.col(model), F.lit(True).alias("_w"))
    return metrics.join(best, [*by, model], "left").withColumn("winner", F.coalesce("_w", F.lit(False))).drop("_w")


def cohort_metrics(df: DataFrame, cohorts: Mapping[str, str], label: str = "label", score: str = "score", target: float = TARGET_RECALL) -> DataFrame:
    """``evaluate`` for every value of several cohort columns in one plan: ``(cohort, value, ...)``."""
    wide = df.select(label, score, *[F.col(c).cast("string").alias(n) for n, c in cohorts.items()])
    long = wide.unpivot([label, score], list(cohorts), "cohort", "value").where("value is not null")
    return evaluate(threshold_curve(long, label, score, ["cohort", "value"]), target, ["cohort", "value"])
