"""Fold summaries, quality gates, promotion and the model registry."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwright.functions import seed_key
from churnwright.operators.lookups import lookup
from churnwright.operators.sampling import best_row
from churnwright.operators.scoring import curve_of_counts, ranking_metrics
from churnwright.session import stage


@dataclass(frozen=True)
class GateLimits:
    """The default limits a candidate has to meet."""

    target_recall: float = 0.80
    stability_std_max: float = 0.03
    min_fold_recall: float = 0.75
    min_pr_auc: float | None = None
    margin: float = 0.0


def fold_summary(folds: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., metric, mean, std_pop, std_samp, best)``: both deviations, named apart."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_a"), F.stddev_pop(m).alias(f"{m}_p"), F.stddev_samp(m).alias(f"{m}_s"), F.max(m).alias(f"{m}_b")]
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"), F.col(f"{m}_a").alias("mean"), F.col(f"{m}_p").alias("std_pop"),
                F.col(f"{m}_s").alias("std_samp"), F.col(f"{m}_b").alias("best"),
            )
            for m in metrics
        ]
    )
    return folds.groupBy(*by).agg(*aggs).select(*by, F.inline(rows))


def quality_gates(folds: DataFrame, limits: GateLimits = GateLimits(), by: Sequence[str] = ("run",), extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per run with its observed values, each gate and whether all hold.

    ``extra`` adds user gates: boolean columns over the observed values.
    """
    seen = folds.groupBy(*by).agg(
        F.avg("recall_at_target").alias("mean_recall_at_target"),
        F.stddev_samp("recall_at_target").alias("std_recall_at_target"),
        F.coalesce(F.min("recall_at_target"), F.lit(0.0)).alias("min_fold_recall"),
        F.avg("pr_auc").alias("mean_pr_auc"),
        F.avg("roc_auc").alias("mean_roc_auc"),
        F.count(F.lit(1)).alias("n_folds"),
    )
    holds = lambda c: F.coalesce(c, F.lit(False))
    gates = {
        "gate_mean_recall": holds(F.col("mean_recall_at_target") >= limits.target_recall),
        "gate_stability": holds(F.col("std_recall_at_target") <= limits.stability_std_max),
        "gate_min_fold": holds(F.col("min_fold_recall") >= limits.min_fold_recall),
    }
    if limits.min_pr_auc is not None:
        gates["gate_min_pr_auc"] = holds(F.col("mean_pr_auc") >= limits.min_pr_auc)
    gates |= {name: holds(c) for name, c in (extra or {}).items()}
    passed = F.lit(True)
    for name in gates:
        passed = passed & F.col(name)
    return seen.withColumns(gates).withColumn("quality_gates_pass", passed)


def promotion(gated: DataFrame, champions: DataFrame, group: str, metric: str = "mean_recall_at_target", margin: float = 0.0, extra_ok: Column | None = None) -> DataFrame:
    """``promote`` and ``reason`` per candidate; ``champions`` has ``(group, champion_value)``.

    Failed gates: no. Failed extra rule: no. No champion value: yes. Else yes if at least ``margin`` better.
    """
    both = lookup(gated, stage(champions.select(group, "champion_value"), "champions"), [group])
    cand, champ = F.col(metric), F.col("champion_value")
    ok = extra_ok if extra_ok is not None else F.lit(True)
    better = F.coalesce(cand >= champ + margin, F.lit(False))
    promote = F.when(~F.col("quality_gates_pass"), False).when(~ok, False).when(champ.isNull(), True).otherwise(better)
    # Fixed values of the output: the texts of the reasons.
    reason = (
        F.when(~F.col("quality_gates_pass"), F.lit("Failed quality gates"))
        .when(~ok, F.lit("Failed extra promotion rules"))
        .when(champ.isNull(), F.lit("Passed gates; no champion metric available"))
        .otherwise(F.format_string("candidate %.4f vs champion %.4f (margin %.4f)", cand, champ, F.lit(float(margin))))
    )
    return both.withColumn("promote", promote).withColumn("reason", reason)


def stability(folds: DataFrame, metric: str, by: Sequence[str] = ("run",), std_max: float = 0.03, z: float = 1.96) -> DataFrame:
    """Normal interval of the fold mean, with a stable / unstable label."""
    s = folds.groupBy(*by).agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"), F.count(metric).alias("k"))
    half = F.try_divide(F.col("std") * z, F.sqrt(F.col("k").cast("double")))
    return s.select(
        *by, "mean", "std", "k", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"),
        F.when(F.col("std") <= std_max, F.lit("stable")).otherwise(F.lit("unstable")).alias("stability"),
    )


def poisson_weight(u: Column) -> Column:
    """A Poisson(1) count from 32 uniform bits as eight hex digits: how many steps of the distribution lie at or below them."""
    at = F.when(u < format(POISSON_STEPS[0], "08x"), 0)
    for k, step in enumerate(POISSON_STEPS[1:], 1):
        at = at.when(u < format(step, "08x"), k)
    return at.otherwise(len(POISSON_STEPS))


def poisson_steps() -> list[int]:
    """The distribution function of Poisson(1) in units of 2^-32, up to where it no longer differs from 1."""
    out, p, total = [], math.exp(-1), 0.0
    for k in range(1, 14):
        total += p
        p /= k
        out.append(math.floor(total * 2**32))
    return out


POISSON_STEPS = poisson_steps()


def bootstrap(
    df: DataFrame, key: Sequence[str], replicates: int = 100, label: str = "label", score: str = "score", by: Sequence[str] = (), seed: int = 42
) -> DataFrame:
    """``(by..., replicate, roc_auc, pr_auc)`` of resampled tables.

    In each replicate a row counts Poisson(1) times, by the md5 of seed, replicate and ``key``: the same whatever the
    partitioning. All replicates come from one scan, which leaves each task as counts per replicate and score; the
    curves of all replicates are then run up together.
    """
    # the digest is made in the generator: in a projection the filter on its weight would make it again for every step
    named = F.when(F.coalesce(*[F.col(k).cast("string") for k in key]).isNotNull(), F.concat_ws("|", *[F.col(k).cast("string") for k in key]))
    drawn = lambda r: F.struct(r.alias("replicate"), F.substring(seed_key(seed, r, F.col("_key")), 1, 8).alias("_u"))
    rows = df.select(*by, label, score, named.alias("_key"))
    copies = rows.select(*by, label, score, F.inline(F.transform(F.sequence(F.lit(1), F.lit(replicates)), drawn)))
    weighted = copies.withColumn("_n", poisson_weight(F.col("_u"))).where("_n > 0")
    curve = curve_of_counts(weighted, "_n", label, score, [*by, "replicate"])
    return ranking_metrics(curve, [*by, "replicate"]).select(*by, "replicate", "roc_auc", "pr_auc")


def metric_interval(resampled: DataFrame, metric: str, by: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """``(by..., mean, std, low, high, n)`` of a metric over ``bootstrap``'s replicates: the middle ``level`` of them."""
    tail = (1 - level) / 2
    q = F.percentile(F.col(metric), F.array(F.lit(tail), F.lit(1 - tail)))
    found = resampled.groupBy(*by).agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"), q.alias("_q"), F.count(metric).alias("n"))
    return found.select(*by, "mean", "std", F.col("_q")[0].alias("low"), F.col("_q")[1].alias("high"), "n")


def latest_approved(registry: DataFrame, metric_key: str, status: str = "Approved") -> DataFrame:
    """The newest approved package per group and its metric from the metadata map (null if absent or no number)."""
    newest = best_row(registry.where(F.col("status") == status), ["created"], "arn", ["group"])
    value = F.try_element_at("meta", F.lit(metric_key)).try_cast("double")
    return newest.select("group", "arn", "created", F.lit(metric_key).alias("metric_key"), value.alias("champion_value"))


def resolve_champion(registry: DataFrame, candidate_run_id: str | None, require_champion_tag: bool = True, status: str = "Approved") -> DataFrame:
    """One approved package per group: run-id match first, then the champion tag, then the newest.

    The priorities hold over the whole group: an older run-id match beats a newer champion tag.
    """
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    by_run = F.coalesce(tag("candidate_run_id") == candidate_run_id, F.lit(False)) if candidate_run_id else F.lit(False)
    by_tag = F.coalesce(F.lower(tag("is_champion")) == "true", F.lit(False)) if require_champion_tag else F.lit(False)
    ranked = registry.where(F.col("status") == status).withColumn("_rank", F.when(by_run, 2).when(by_tag, 1).otherwise(0))
    best = best_row(ranked, ["_rank", "created"], "arn", ["group"])
    via = F.when(F.col("_rank") == 2, F.lit("run_id")).when(F.col("_rank") == 1, F.lit("champion_tag")).otherwise(F.lit("latest"))
    return best.withColumn("via", via).drop("_rank")


def lineage(packages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``lineage``: the expected keys, each from the tags or else from the metadata; keys found in neither are left out."""
    wanted = F.array(*[F.lit(k) for k in keys])
    both = F.map_from_entries(
        F.transform(
            wanted, lambda k: F.struct(k.alias("k"), F.coalesce(F.try_element_at("tags", k), F.try_element_at("meta", k)).alias("v"))
        )
    )
    return packages.withColumn("lineage", F.map_filter(both, lambda k, v: v.isNotNull()))


def tags_to_map(pairs: Column) -> Column:
    """An array of ``(Key, Value)`` structs as a map; the last entry of a key wins, null keys and values are left out."""
    good = F.filter(pairs, lambda p: p["Key"].isNotNull() & p["Value"].isNotNull())
    last = F.filter(good, lambda p, i: ~F.exists(F.slice(good, i + 2, F.size(good)), lambda q: q["Key"] == p["Key"]))
    return F.map_from_entries(last)
