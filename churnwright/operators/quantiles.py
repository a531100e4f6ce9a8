"""Quantiles per group, exact or sketched.

The built-in exact percentile keeps every distinct value of a group in one
aggregate state, so it is used only where their estimated number is small. Beyond that the
exact form takes two scans: a sketch with a known error brackets each quantile, then
only the values inside the brackets are counted one by one, and all others are added
up where they are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwright.functions import known
from churnwright.operators.lookups import BROADCAST_BYTES, size_of
from churnwright.operators.ordered import ordered_scan
from churnwright.session import chunks_for, stage

ACCURACY = 10_000
# Half-width of a bracket as a share of the rows: three times the error of the sketch.
BRACKET = 3.0 / ACCURACY
# Groups up to this size are bracketed by their own minimum and maximum.
SMALL_GROUP = 20_000


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), *, exact: bool = True) -> DataFrame:
    """``(by..., n, q)`` where ``q`` is the array of linear-interpolated quantiles in the order of ``probs``.

    The sketched form (``exact=False``) takes one scan and returns values that occur, within 1e-4 of the rank.
    """
    by, probs = list(by), [float(p) for p in probs]
    rows = df.select(*by, known(F.col(value).cast("double")).alias("_v")).where("_v is not null")
    if not exact:
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", probs, ACCURACY).alias("q"))
    hist = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    distinct = rows.agg(F.approx_count_distinct(F.struct(*by, "_v")).alias("d")).first()["d"]
    if chunks_for(distinct, df.sparkSession) == 1:
        # few enough distinct values for one task's aggregate state
        at = F.array(*[F.lit(p) for p in probs])
        return hist.groupBy(*by).agg(F.sum("_c").alias("n"), F.percentile("_v", at, F.col("_c")).alias("q"))
    narrow = _bracketed(rows, probs, by)
    if narrow is not None:
        return narrow
    run = ordered_scan(stage(hist, "hist"), ["_v"], by, through={"_upto": "_c"}, totals={"n": "_c"})
    return from_run(run, probs, by)


def from_run(run: DataFrame, probs: Sequence[float], by: Sequence[str] = (), *, value: str = "_v", count: str = "_c", upto: str = "_upto", total: str = "n") -> DataFrame:
    """``(by..., n, q)`` from a histogram that carries its running count and total."""
    held = run.select(*by, F.col(value).alias("_v"), F.col(count).alias("_c"), F.col(upto).alias("_upto"), F.col(total).alias("n"))
    aggs = [c for i, p in enumerate(probs) for c in _neighbours(i, p, F.col("_upto"), F.lit(True))]
    return _interpolated(held.groupBy(*by).agg(F.max("n").alias("n"), *aggs), probs, by)


def _interpolated(picked: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    between = []
    for i, p in enumerate(probs):
        pos = (F.col("n") - 1) * F.lit(p)
        between.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (pos - F.floor(pos)))
    return picked.select(*by, "n", F.array(*between).alias("q"))


def _neighbours(i: int, p: float, upto: Column, within: Column) -> list[Column]:
    """The values at the two positions around quantile ``p``, as aggregates over a run-up histogram."""
    pos = (F.col("n") - 1) * F.lit(p)
    out = []
    for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
        here = within & (at < upto) & (at >= upto - F.col("_c"))
        out.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}{i}"))
    return out


def _bracketed(rows: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame | None:
    """Quantiles from the values near them, or None where that cannot be done: too many groups to broadcast
    their brackets, or a bracket that turned out not to hold its quantile."""
    lows = [max(0.0, p - BRACKET) for p in probs]
    highs = [min(1.0, p + BRACKET) for p in probs]
    k = len(probs)
    sketch = stage(
        rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("_v").alias("_min"),
            F.max("_v").alias("_max"),
            F.percentile_approx("_v", [*lows, *highs], ACCURACY).alias("_a"),
        ),
        "sketch",
    )
    if size_of(sketch) > BROADCAST_BYTES:
        return None
    small = F.col("_n") <= SMALL_GROUP
    low = lambda i: F.when(small | F.lit(lows[i] <= 0.0), F.col("_min")).otherwise(F.col("_a")[i])
    high = lambda i: F.when(small | F.lit(highs[i] >= 1.0), F.col("_max")).otherwise(F.col("_a")[k + i])
    ends = [c for i in range(k) for c in (low(i).alias(f"_l{i}"), high(i).alias(f"_h{i}"))]
    if by:
        brackets = sketch.select(*[F.col(b).alias(f"_k_{b}") for b in by], *ends)
        same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_k_{b}")) for b in by])
        held = rows.join(F.broadcast(brackets), same)  # one row per group, counted above
    else:
        held = rows.withColumn("_br", sketch.select(F.struct(*ends).alias("s")).scalar()).select("*", "_br.*")
    inside = lambda i: (F.col("_v") >= F.col(f"_l{i}")) & (F.col("_v") <= F.col(f"_h{i}"))
    near = F.when(reduce(lambda a, b: a | b, [inside(i) for i in range(k)]), F.col("_v"))
    # All values outside the brackets of a group fall into one row of it, before any shuffle.
    below = [F.count_if(F.col("_v") < F.col(f"_l{i}")).alias(f"_b{i}") for i in range(k)]
    bounds = [c for i in range(k) for c in (F.min(f"_l{i}").alias(f"_l{i}"), F.min(f"_h{i}").alias(f"_h{i}"))]
    counted = stage(held.groupBy(*by, near.alias("_near")).agg(F.count(F.lit(1)).alias("_c"), *below, *bounds), "near")
    counted = counted.withColumnRenamed("_near", "_v")
    outside = F.col("_v").isNull()
    cum = ordered_scan(
        counted,
        ["_v"],
        by,
        through={"_upto": F.when(~outside, F.col("_c")).otherwise(F.lit(0))},
        totals={"n": "_c", **{f"_o{i}": F.when(outside, F.col(f"_b{i}")).otherwise(F.lit(0)) for i in range(k)}},
    )
    aggs = [c for i, p in enumerate(probs) for c in _neighbours(i, p, F.col("_upto") + F.col(f"_o{i}"), ~outside & inside(i))]
    picked = stage(cum.groupBy(*by).agg(F.max("n").alias("n"), *aggs), "picked")
    missed = reduce(lambda a, b: a | b, [F.col(f"_{s}{i}").isNull() for i in range(k) for s in ("lo", "hi")])
    return None if picked.where(missed).limit(1).count() else _interpolated(picked, probs, by)


def long_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide to long: ``(keep..., column, value)`` with values as double."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "column", "value")


def column_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), *, exact: bool = True
) -> DataFrame:
    """``(by..., column, n, q)`` for several columns in one plan."""
    return quantiles(long_numeric(df, cols, by), "value", probs, [*by, "column"], exact=exact)


def as_struct(stats: DataFrame, cols: Sequence[str], value: Column) -> Column:
    """A table keyed by ``column`` as one scalar struct, field per column name. One row, whatever the data size."""
    one = stats.groupBy().agg(F.struct(*[F.max(F.when(F.col("column") == c, value)).alias(c) for c in cols]).alias("s"))
    return one.scalar()
