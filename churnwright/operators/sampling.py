"""Seeded samples, limits and ranks that do not depend on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwright.functions import hex_bound, seed_key
from churnwright.operators.lookups import lookup
from churnwright.session import stage


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The first ``n`` rows in seeded order (all if there are fewer).

    Rows are counted by the first four digits of their order key; whole prefixes below the cut are kept where they are,
    and only the rows of the prefix at the cut are ranked. The rows stay spread, and come in no order.
    """
    keyed = df.withColumn("_h", seed_key(seed, key)).withColumn("_p", F.substring("_h", 1, 4))
    counts = keyed.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))  # at most 65,536 rows
    upto = counts.select("_p", "_c", F.sum("_c").over(Window.orderBy("_p")).alias("_upto"))
    cut = upto.where(F.col("_upto") > n).groupBy().agg(F.min(F.struct("_p", (F.lit(n) - F.col("_upto") + F.col("_c")).alias("_left"))).alias("c"))
    held = keyed.withColumn("_cut", cut.scalar())
    whole = held.where(F.col("_cut").isNull() | (F.col("_p") < F.col("_cut._p")))
    at = held.where(F.col("_p") == F.col("_cut._p"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_h", key))
    last = at.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_cut._left"))
    return whole.select(*df.columns).unionByName(last.select(*df.columns))


def sample_fraction(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, chosen row by row from the key; no shuffle, and works on a stream."""
    return df.where(F.substring(seed_key(seed, key), 1, 8) < hex_bound(fraction))


def sample_per_stratum(df: DataFrame, stratum: str, key: str, ratio: float, cap: int | None = None, seed: int = 42) -> DataFrame:
    """``ceil(n * ratio)`` rows of each stratum, e.g. of each input file; at most ``cap`` if one is given.

    The rows are those that come first in seeded order, but they are not sorted: as in ``sample_rows``, each stratum's rows are
    counted by the first four digits of their order key, and only the rows at the prefix where the stratum is cut are ranked.
    Rows without a stratum are a stratum of their own. Rows that repeat a key are ranked in no stated order among themselves.
    """
    name = F.col(f"`{stratum}`")
    keyed = df.withColumn("_h", seed_key(seed, key)).withColumn("_p", F.substring("_h", 1, 4))
    keyed = keyed.withColumn("_s", F.struct(name.isNull().alias("no"), F.coalesce(name.cast("string"), F.lit("")).alias("of")))
    counts = keyed.groupBy("_s", "_p").agg(F.count(F.lit(1)).alias("_c"))
    one = Window.partitionBy("_s")  # a window group is one stratum's prefixes: at most 65,536 rows
    upto = counts.select("_s", "_p", "_c", F.sum("_c").over(one.orderBy("_p")).alias("_upto"), F.sum("_c").over(one).alias("_n"))
    share = F.ceil(F.col("_n") * min(ratio, 1.0))
    wanted = share if cap is None else F.least(share, F.lit(cap))
    left = (wanted - F.col("_upto") + F.col("_c")).alias("_left")
    cuts = stage(upto.where(F.col("_upto") > wanted).groupBy("_s").agg(F.min(F.struct("_p", left)).alias("_cut")), "cuts")
    held = lookup(keyed, cuts, ["_s"])
    whole = held.where(F.col("_cut").isNull() | (F.col("_p") < F.col("_cut._p")))
    rank = F.row_number().over(Window.partitionBy("_s", "_p").orderBy("_h", key))
    last = held.where(F.col("_p") == F.col("_cut._p")).withColumn("_rank", rank).where(F.col("_rank") <= F.col("_cut._left"))
    return whole.select(*df.columns).unionByName(last.select(*df.columns))


def first_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def top_k(df: DataFrame, by: Column, k: int, tie: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties go to the smaller ``tie``."""
    return df.orderBy(by.desc_nulls_last(), F.col(tie).asc()).limit(k)


def best_row(df: DataFrame, metrics: Sequence[str], tie: str, by: Sequence[str] = ()) -> DataFrame:
    """The best row by several metrics in turn (each descending), per group if ``by`` is given.

    Only one row per group survives in each task before the shuffle.
    """
    order = [F.desc_nulls_last(m) for m in metrics] + [F.asc(tie)]
    if not by:
        return df.orderBy(*order).limit(1)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 1).drop("_rn")
