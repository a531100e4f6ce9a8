"""Population stability, two-sample Kolmogorov-Smirnov and drift tables.

Both sides come as long tables ``(feature, value)``; all features, and all time windows
of the current side, go through one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwright.functions import known
from churnwright.operators.encoding import bin_index, edge_probs, inner_edges, quantile_edges
from churnwright.operators.lookups import lookup
from churnwright.operators.ordered import ordered_scan
from churnwright.operators.quantiles import from_run
from churnwright.session import stage

# Bins, the smallest sample, the floor of a share, and the limits of the severities.
BUCKETS = 10
MIN_ROWS = 10
FLOOR = 1e-6
PSI_MODERATE, PSI_SIGNIFICANT, KS_LIMIT = 0.1, 0.25, 0.1


def as_features(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide to long ``(keep..., feature, value)`` over known values."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot(list(keep), list(cols), "feature", "value")
    return long.select(*keep, "feature", known("value").alias("value")).where("value is not null")


def shared_features(base: DataFrame, current: DataFrame, numeric: Sequence[str]) -> list[str]:
    """The numeric baseline columns, in order, that the current table has too."""
    return [c for c in numeric if c in base.columns and c in current.columns]


def psi_edges(base: DataFrame, buckets: int = BUCKETS, *, exact: bool = True) -> DataFrame:
    """``(feature, n, inner)`` from the baseline; one row per feature."""
    return quantile_edges(base, "value", buckets, ["feature"], exact=exact)


def bin_counts(side: DataFrame, edges: DataFrame, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """``(by..., feature, bin, k)``. Rows are binned where they are read, so the shuffle carries bin counts only.

    ``edges`` has one row per feature; ``n`` is the count column of a side that is a histogram.
    """
    placed = side.join(F.broadcast(edges), "feature")
    grouped = placed.groupBy(*by, "feature", bin_index(F.col("value"), F.col("inner")).alias("bin"))
    return grouped.agg((F.sum(n) if n else F.count(F.lit(1))).alias("k"))


def psi_of_bins(base_bins: DataFrame, current_bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, psi)`` from bin counts; null if either side has fewer than ten values."""

    def gathered(bins: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
        # at most `buckets` rows per group
        return bins.groupBy(*keys, "feature").agg(
            F.sum("k").alias(total), F.map_from_entries(F.collect_list(F.struct("bin", "k"))).alias(f"{total}_bins")
        )

    base = gathered(base_bins, (), "_e")  # one row per feature
    both = gathered(current_bins, by, "_a").join(F.broadcast(base), "feature")
    occurring = F.array_sort(F.array_union(F.map_keys("_e_bins"), F.map_keys("_a_bins")))

    def term(k):
        pe = F.greatest(F.coalesce(F.try_element_at("_e_bins", k), F.lit(0)) / F.col("_e"), F.lit(FLOOR))
        pa = F.greatest(F.coalesce(F.try_element_at("_a_bins", k), F.lit(0)) / F.col("_a"), F.lit(FLOOR))
        return (pa - pe) * F.log(pa / pe)

    total = F.aggregate(F.transform(occurring, term), F.lit(0.0), lambda s, x: s + x)
    enough = (F.col("_e") >= MIN_ROWS) & (F.col("_a") >= MIN_ROWS)
    return both.select(*by, "feature", F.when(enough, total).alias("psi"))


def psi(base: DataFrame, current: DataFrame, edges: DataFrame, by: Sequence[str] = (), *, base_n: str | None = None, current_n: str | None = None) -> DataFrame:
    """``(by..., feature, psi)`` of two long tables (or histograms with a count column)."""
    edges = edges.select("feature", "inner")
    return psi_of_bins(bin_counts(base, edges, (), base_n), bin_counts(current, edges, by, current_n), by)


def pooled_run(base: DataFrame, current: DataFrame) -> DataFrame:
    """Counts of both sides per feature and distinct value, with running counts and totals; staged."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    both = base.select("feature", "value", one.alias("e"), zero.alias("a")).unionByName(
        current.select("feature", "value", zero.alias("e"), one.alias("a"))
    )
    pooled = stage(both.groupBy("feature", "value").agg(F.sum("e").alias("e"), F.sum("a").alias("a")), "pooled")
    return stage(ordered_scan(pooled, ["value"], ["feature"], through={"_e": "e", "_a": "a"}, totals={"_ne": "e", "_na": "a"}), "run")


def ks_of_run(run: DataFrame) -> DataFrame:
    gap = F.abs(F.col("_e").cast("double") / F.col("_ne") - F.col("_a").cast("double") / F.col("_na"))
    return run.where("_ne > 0 and _na > 0").groupBy("feature").agg(F.max(gap).alias("ks"))


def ks(base: DataFrame, current: DataFrame) -> DataFrame:
    """``(feature, ks)``: the largest gap of the two empirical distribution functions."""
    return ks_of_run(pooled_run(base, current))


def base_run(base: DataFrame, current_hist: DataFrame) -> DataFrame:
    """The baseline's running counts at its own values and at those of the current side; staged."""
    count = F.count(F.lit(1))
    points = base.groupBy("feature", "value").agg(count.alias("e")).unionByName(
        current_hist.select("feature", "value").distinct().withColumn("e", F.lit(0).cast("bigint"))
    )
    points = stage(points.groupBy("feature", "value").agg(F.sum("e").alias("e")), "points")
    return stage(ordered_scan(points, ["value"], ["feature"], before={"_b": "e"}, through={"_t": "e"}, totals={"_ne": "e"}), "run")


def ks_by(run: DataFrame, current_hist: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by..., feature, ks)`` of every group against the one baseline.

    Between two values of a group its own distribution function is flat, so the largest gap
    is found at the group's values, just before or at the step. The baseline is therefore
    only needed at those values and is never copied per group.
    """
    by = list(by)
    at = run.where("_ne > 0").select("feature", "value", (F.col("_b") / F.col("_ne")).alias("_fb"), (F.col("_t") / F.col("_ne")).alias("_ft"))
    own = ordered_scan(current_hist, ["value"], [*by, "feature"], before={"_ab": "a"}, through={"_at": "a"}, totals={"_na": "a"})
    held = lookup(own, at, ["feature", "value"], how="inner")
    gap = F.greatest(
        F.abs(F.col("_fb") - F.col("_ab") / F.col("_na")), F.abs(F.col("_ft") - F.col("_at") / F.col("_na"))
    )
    return held.groupBy(*by, "feature").agg(F.max(gap).alias("ks"))


def every_feature(found: DataFrame, seen: DataFrame, by: Sequence[str], features: Sequence[str] | None, windows: DataFrame | None) -> DataFrame:
    """``found`` with a row for each feature, in each window: those without values on one side have nulls.

    ``seen`` holds the features of either side; ``features`` and ``windows`` add those without any value.
    """
    by = list(by)
    names = seen.select("feature").distinct().groupBy().agg(F.collect_set("feature").alias("f")).scalar()  # one entry per feature
    listed = F.array_distinct(F.concat(F.coalesce(names, F.array().cast("array<string>")), F.array(*[F.lit(f) for f in features or ()]).cast("array<string>")))
    if by:
        at = found.select(*by).distinct()
        at = at.unionByName(windows.select(*by)).distinct() if windows is not None else at
    else:
        at = seen.sparkSession.range(1).select()
    return at.withColumn("feature", F.explode(listed)).join(found, [*by, "feature"], "left").select(*found.columns)


def drift_table(
    base: DataFrame,
    current: DataFrame,
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
    *,
    features: Sequence[str] | None = None,
    windows: DataFrame | None = None,
) -> DataFrame:
    """``(by..., feature, psi, ks)`` from two long tables. The KS run-up is computed once and also gives the PSI edges and bins.

    Every feature of either side has a row, in every window of the current side. psi and ks are null where a side has no
    value. Name ``features`` and ``windows`` that may have no value at all on either side.
    """
    by, probs = list(by), edge_probs(buckets)
    if not by:
        run = pooled_run(base, current)
        e, a = run.where("e > 0"), run.where("a > 0")
        edges = inner_edges(from_run(e, probs, ["feature"], value="value", count="e", upto="_e", total="_ne"))
        found = psi(e, a, edges, base_n="e", current_n="a").join(ks_of_run(run), "feature", "full")
        return every_feature(found, run, by, features, windows)
    hist = stage(current.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("a")), "current")
    run = base_run(base, hist)
    e = run.where("e > 0")
    edges = inner_edges(from_run(e, probs, ["feature"], value="value", count="e", upto="_t", total="_ne"))
    found = psi(e, hist, edges, by, base_n="e", current_n="a").join(ks_by(run, hist, by), [*by, "feature"], "full")
    seen = hist.select(*by).distinct()
    return every_feature(found, run, by, features, seen.unionByName(windows.select(*by)) if windows is not None else seen)


def with_severity(drift: DataFrame) -> DataFrame:
    severity = (
        F.when(F.col("psi").isNull() & F.col("ks").isNull(), F.lit("missing"))  # a side without values
        .when(F.col("psi").isNull(), F.lit("unknown"))
        .when(F.col("psi") < PSI_MODERATE, F.lit("stable"))
        .when(F.col("psi") <= PSI_SIGNIFICANT, F.lit("moderate"))
        .otherwise(F.lit("significant"))
    )
    return drift.withColumn("severity", severity).withColumn("ks_drift", F.coalesce(F.col("ks") > KS_LIMIT, F.lit(False)))


SKETCH_K, GRID = 400, 512


def rank_error(k: int = SKETCH_K, cdf: bool = False) -> float:
    """The normalised rank error that a quantile sketch of size ``k`` keeps to with 99 % confidence; ``cdf`` for several ranks at once."""
    return 2.446 / k**0.9433 if cdf else 2.296 / k**0.9723


def sketches(long: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``(by..., feature, n, sketch)``: a mergeable quantile sketch per feature and, say, day. A few kilobytes each, whatever the rows."""
    return long.groupBy(*by, "feature").agg(F.count("value").alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch"))


def merged(stored: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Stored sketches put together, for any window of days: no row of the data is read again."""
    return stored.groupBy(*by, "feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketched_quantiles(stored: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, n, prob, value)`` within ``rank_error`` of the asked rank."""
    at = F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("value")) for p in probs]))
    return stored.select(*by, "feature", "n", at.alias("q")).select(*by, "feature", "n", "q.prob", "q.value")


def sketched_psi(base: DataFrame, current: DataFrame, by: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """``(by..., feature, psi, ks)`` from sketches alone: baseline quantiles as edges, shares of both sides by their ranks.

    A rank is read off ``GRID`` quantiles of a sketch, which adds 1 / GRID to the error of a rank; a share is off by twice
    that at most. The KS value is that at the edges. Null where a side has fewer than ten values.
    """
    grid = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    probs = F.array(*[F.lit(p) for p in edge_probs(buckets)[1:-1]])
    edges = base.select("feature", F.col("n").alias("_n0"), F.col("sketch").alias("_base"), F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", probs))).alias("_e"))
    both = current.join(F.broadcast(edges), "feature")  # one row per feature
    read = both.withColumn("_qa", F.kll_sketch_get_quantile_double("_base", grid)).withColumn("_qb", F.kll_sketch_get_quantile_double("sketch", grid))
    below = lambda q: F.transform("_e", lambda e: F.size(F.filter(q, lambda v: v < e)) / F.lit(float(GRID)))
    ranks = lambda q: F.concat(F.array(F.lit(0.0)), below(q), F.array(F.lit(1.0)))
    placed = read.withColumn("_a", ranks("_qa")).withColumn("_b", ranks("_qb"))
    share = lambda r: F.transform(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.greatest(F.get(r, i) - F.get(r, i - 1), F.lit(FLOOR)))
    terms = F.zip_with(share("_b"), share("_a"), lambda c, b: (c - b) * F.log(c / b))
    apart = F.array_max(F.zip_with("_a", "_b", lambda a, b: F.abs(a - b)))
    enough = (F.col("n") >= MIN_ROWS) & (F.col("_n0") >= MIN_ROWS)
    return placed.select(*by, "feature", F.when(enough, F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).alias("psi"), F.when(enough, apart).alias("ks"))
