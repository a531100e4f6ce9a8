"""Hyperparameter search, cross-validation and run tables."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwright.operators.sampling import sample_fraction
from churnwright.operators.scoring import evaluate, threshold_curve
from churnwright.operators.splitting import fold_sides
from churnwright.session import stage


def grid(values: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the value lists."""
    return [dict(zip(values, combo, strict=True)) for combo in itertools.product(*values.values())]


def random_draws(ranges: Mapping[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """Seeded draws: whole numbers between int bounds, else uniform."""
    rng = random.Random(seed)
    draw = lambda lo, hi: rng.randint(lo, hi) if isinstance(lo, int) and isinstance(hi, int) else rng.uniform(lo, hi)
    return [{k: draw(*r) for k, r in ranges.items()} for _ in range(n)]


Train = Callable[[DataFrame, DataFrame, dict], DataFrame]


def search(train: DataFrame, valid: DataFrame, runs: Sequence[dict], fit_and_score: Train, parallel: int = 3) -> DataFrame:
    """``(job_index, parameters..., metrics...)``: one row per run, best ROC-AUC first.

    ``fit_and_score(train, valid, params)`` returns the scored validation rows (``label, score``).
    Each fit is a distributed job; ``parallel`` of them are in flight at once.
    """

    def one(job: tuple[int, dict]) -> DataFrame:
        i, params = job
        scored = fit_and_score(train, valid, params)
        row = evaluate(threshold_curve(scored))
        for k, v in reversed(params.items()):
            row = row.withColumn(k, F.lit(v))
        return row.withColumn("job_index", F.lit(i))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(one, enumerate(runs)))
    keep = ["job_index", *runs[0], "roc_auc", "pr_auc", "threshold", "recall", "precision", "f1"]
    return reduce(lambda a, b: a.unionByName(b), [r.select(*keep) for r in rows]).orderBy(F.desc("roc_auc"), "job_index")


def halving(
    train: DataFrame, valid: DataFrame, runs: Sequence[dict], fit_and_score: Train, key: str, *, eta: int = 3, share: float = 0.1,
    grows: str | None = None, metric: str = "roc_auc", seed: int = 42, parallel: int = 3,
) -> DataFrame:
    """``(rung, share, n_train, job_index, parameters..., metrics..., survived)``: successive halving.

    The first rung fits all runs on ``share`` of the training rows; the best ``1 / eta`` of them, by ``metric`` and then
    by number, go on to a rung with ``eta`` times the rows, until one is left or all rows are used. Rows are drawn by
    ``key``, so a rung's rows are in the next one's. ``grows`` names a parameter, such as the rounds, that grows by ``eta``
    with the rows. Every rung is written before its survivors are read: what reaches the driver is a row per run.
    """
    left, rungs, rung = list(enumerate(runs)), [], 0
    while left:
        now = min(1.0, share * eta**rung)
        rows = stage(sample_fraction(train, now, key, seed), f"rung-{rung}")
        params = [{**p, grows: p[grows] * eta**rung} if grows else p for _, p in left]
        table = search(rows, valid, params, fit_and_score, parallel)
        numbers = F.array(*[F.lit(i) for i, _ in left])
        table = table.withColumn("job_index", F.get(numbers, F.col("job_index")))
        size = rows.groupBy().agg(F.count(F.lit(1)).alias("n")).scalar()
        table = stage(table.select(F.lit(rung).alias("rung"), F.lit(now).alias("share"), size.alias("n_train"), "*"), f"rung-{rung}-runs")
        last = len(left) == 1 or now >= 1.0
        keep = 0 if last else max(1, len(left) // eta)
        best = [r["job_index"] for r in table.orderBy(F.desc_nulls_last(metric), "job_index").limit(keep or 1).collect()]
        rungs.append(table.withColumn("survived", F.col("job_index").isin(best)))
        left = [] if last else [(i, p) for i, p in left if i in best]
        rung += 1
    return reduce(lambda a, b: a.unionByName(b), rungs)


def search_summary(runs: DataFrame, metric: str = "roc_auc") -> DataFrame:
    return runs.agg(F.max(metric).alias("best"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"), F.count(F.lit(1)).alias("n_runs"))


def cross_validate(df: DataFrame, k: int, fit_and_score: Train, params: dict | None = None, *, fold: str = "fold", expanding: bool = False) -> DataFrame:
    """``(fold, roc_auc, pr_auc, recall_at_target, precision_at_target, threshold_at_target, n_train, n_val)``.

    The loop is over folds; every fit and every metric runs on the cluster.
    """
    rows = []
    for f in range(1, k + 1):
        if expanding:
            tr, va = fold_sides(df, f)
        else:
            tr, va = df.where(F.col(fold) != f - 1), df.where(F.col(fold) == f - 1)
        scored = fit_and_score(tr, va, params or {})
        sizes = tr.groupBy().agg(F.count(F.lit(1)).alias("n")).scalar()
        row = evaluate(threshold_curve(scored)).select(
            F.lit(f).alias("fold"), "roc_auc", "pr_auc", F.col("recall").alias("recall_at_target"),
            F.col("precision").alias("precision_at_target"), F.col("threshold").alias("threshold_at_target"),
            sizes.alias("n_train"), (F.col("n_pos") + F.col("n_neg")).alias("n_val"),
        )
        rows.append(row)
    return reduce(lambda a, b: a.unionByName(b), rows)
