"""Train, validation and test splits and folds, written as a column on the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwright.functions import seed_key
from churnwright.operators.ordered import ordered_scan
from churnwright.operators.quantiles import quantiles
from churnwright.session import stage

# A time split needs more than this share of usable dates; the cutoff is this quantile of them.
USABLE_DATES = 0.8
CUTOFF = 0.8


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp")).cast("double")


def time_cutoff(df: DataFrame, time: str, q: float = CUTOFF, *, exact: bool = True) -> Column:
    """The ``q`` quantile of ``time`` in microseconds, as a scalar."""
    times = df.select(_micros(time).alias("_t"))
    return quantiles(times, "_t", [q], exact=exact).select(F.col("q")[0].alias("c")).scalar()


def time_split(df: DataFrame, time: str, q: float = CUTOFF, *, exact: bool = True, out: str = "split") -> DataFrame:
    """``train`` before the cutoff, ``valid`` from it on. Rows without a date go to ``valid``."""
    early = _micros(time) < time_cutoff(df, time, q, exact=exact)
    return df.withColumn(out, F.when(F.coalesce(early, F.lit(False)), F.lit("train")).otherwise(F.lit("valid")))


def time_or_stratified_split(
    df: DataFrame, time: str, target: str, key: str, test_size: float = 0.2, seed: int = 42, *, exact: bool = True
) -> DataFrame:
    """Time split if enough rows have a date, else a stratified one. Reads one aggregate row to decide."""
    share = df.agg(F.avg(F.col(time).isNotNull().cast("double")).alias("s")).first()["s"]
    if share is not None and share > USABLE_DATES:
        return time_split(df, time, exact=exact)
    return stratified_split(df, target, key, test_size, seed, names=("train", "valid"))


def holdout(df: DataFrame, time: str, q: float = CUTOFF, *, exact: bool = True, out: str = "split") -> DataFrame:
    """Strict holdout: ``test`` at or after the cutoff; rows without a date are in neither side."""
    late = _micros(time) >= time_cutoff(df, time, q, exact=exact)
    return df.where(F.col(time).isNotNull()).withColumn(out, F.when(late, F.lit("test")).otherwise(F.lit("train")))


def positional_split(df: DataFrame, order: Sequence[str], train: float = 0.8, valid: float = 0.1, out: str = "split") -> DataFrame:
    """Cut the sorted table at ``int(n * train)`` and ``int(n * (train + valid))``. ``order`` must identify a row."""
    ranked = ordered_scan(df, order, position="_pos", totals={"_n": F.lit(1)})
    upto = lambda share: F.floor(F.col("_n") * F.lit(share))
    name = (
        F.when(F.col("_pos") <= upto(train), F.lit("train"))
        .when(F.col("_pos") <= upto(train + valid), F.lit("valid"))
        .otherwise(F.lit("test"))
    )
    return ranked.withColumn(out, name).select(*df.columns, out)


def stratified_split(
    df: DataFrame, target: str, key: str, test_size: float = 0.2, seed: int = 42, names: tuple[str, str] = ("train", "test"), out: str = "split"
) -> DataFrame:
    """Exact class shares on both sides: the first ``round(n_class * test_size)`` rows of each class in seeded order."""
    ranked = ordered_scan(
        df.withColumn("_h", seed_key(seed, key)), ["_h", key], [target], position="_pos", totals={"_n": F.lit(1)}
    )
    size = F.floor(F.col("_n") * F.lit(test_size) + F.lit(0.5))
    name = F.when(F.col("_pos") <= size, F.lit(names[1])).otherwise(F.lit(names[0]))
    return ranked.withColumn(out, name).select(*df.columns, out)


def three_way_split(
    df: DataFrame, target: str, key: str, test_size: float = 0.2, val_size: float = 0.1, seed: int = 42, time: str | None = None
) -> DataFrame:
    """Test by time (or stratified), then validation as ``val_size / (1 - test_size)`` of the rest, stratified."""
    if time is not None:
        outer = holdout(df, time, 1.0 - test_size)
    else:
        outer = stratified_split(df, target, key, test_size, seed)
    outer = stage(outer, "outer")  # both branches read it
    rest = outer.where(F.col("split") == "train").drop("split")
    inner = stratified_split(rest, target, key, val_size / (1.0 - test_size), seed, names=("train", "val"))
    return inner.unionByName(outer.where(F.col("split") == "test"))


def stratified_folds(df: DataFrame, target: str, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold 0 .. k-1, dealt out within each class in seeded order."""
    ranked = ordered_scan(df.withColumn("_h", seed_key(seed, key)), ["_h", key], [target], position="_pos")
    return ranked.withColumn(out, ((F.col("_pos") - 1) % k).cast("int")).select(*df.columns, out)


def expanding_folds(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """Expanding time folds: fold f tests one block of ``n // (k + 1)`` rows and trains on all rows before it.

    Adds ``block``: 0 for the rows that are only ever trained on, f for the test block of
    fold f (1 .. k). Fold f is ``block < f`` for training and ``block = f`` for the test,
    so no row is copied per fold.
    """
    ranked = ordered_scan(df, order, position="_pos", totals={"_n": F.lit(1)})
    size = F.floor(F.col("_n") / (k + 1))
    start = F.col("_n") - size * k
    pos = F.col("_pos") - 1
    block = F.when((pos < start) | (size == 0), F.lit(0)).otherwise(F.floor((pos - start) / size) + 1)
    return ranked.withColumn("block", block.cast("int")).select(*df.columns, "block")


def fold_sides(blocks: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one expanding fold."""
    return blocks.where(F.col("block") < fold), blocks.where(F.col("block") == fold)


def fold_sizes(blocks: DataFrame, target: str, k: int = 5) -> DataFrame:
    """``(fold, n_train, n_test, test_rate)`` from the per-block counts."""
    counts = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("pos"))
    train = [F.sum(F.when(F.col("block") < f, F.col("n"))).alias(f"a{f}") for f in range(1, k + 1)]
    test = [F.sum(F.when(F.col("block") == f, F.col("n"))).alias(f"b{f}") for f in range(1, k + 1)]
    pos = [F.sum(F.when(F.col("block") == f, F.col("pos"))).alias(f"c{f}") for f in range(1, k + 1)]
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("fold"),
                F.col(f"a{f}").alias("n_train"),
                F.col(f"b{f}").alias("n_test"),
                (F.col(f"c{f}") / F.col(f"b{f}")).alias("test_rate"),
            )
            for f in range(1, k + 1)
        ]
    )
    return counts.agg(*train, *test, *pos).select(F.inline(rows))


def split_report(df: DataFrame, time: str, target: str, split: str = "split") -> DataFrame:
    """``(split, n, share, first, last, target_rate)``."""
    per = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
        F.avg(F.col(target).cast("double")).alias("target_rate"),
    )
    total = per.groupBy().agg(F.sum("n").alias("n")).scalar()  # one row per split
    return per.withColumn("share", F.col("n") / total)
