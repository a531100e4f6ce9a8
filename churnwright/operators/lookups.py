"""Lookups and joins that hold up when one key owns much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32_000_000
SPREAD = 4096


def size_of(table: DataFrame) -> int:
    """Bytes of a table's rows: eight per fixed column, nested values as their JSON text."""
    fixed, parts = 0, []
    for f in table.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.octet_length(c))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.octet_length(F.to_json(F.struct(c))))
        fixed += 8
    varying = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts], F.lit(0).cast("long"))
    found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(varying).alias("b")).first()
    return found["n"] * (fixed + 16) + (found["b"] or 0)


def lookup(
    facts: DataFrame, table: DataFrame, on: Sequence[str], *, how: str = "left", hot_keys: int = 512, small_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join ``facts`` with a table that has one row per key.

    The table is measured first, so stage() one that is costly to compute. One of up to ``small_bytes`` is
    broadcast. Otherwise keys holding more than 1 / ``hot_keys`` of the facts (so fewer than ``hot_keys`` of them) are
    spread over as many salted copies of their table row as they have such shares. Rows
    without a key match nothing and are spread by their other columns.
    """
    on = list(on)
    if size_of(table) <= small_bytes:
        return facts.join(F.broadcast(table), on, how)
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_c"))
    total = facts.groupBy().agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.col("_c") * hot_keys / total
    hot = counts.where(share > 1).select(*on, F.ceil(share).cast("int").alias("_copies"))
    # hot has fewer than hot_keys rows by construction
    spread = facts.join(F.broadcast(hot), on, "left")
    others = [c for c in facts.columns if c not in on] or on
    content = F.xxhash64(*others)
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salt = F.when(keyless, F.pmod(content, F.lit(SPREAD))).otherwise(F.coalesce(F.pmod(content, F.col("_copies")), F.lit(0)))
    salted = spread.withColumn("_salt", salt.cast("int"))
    copied = table.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    )
    joined = salted.drop("_copies").join(copied.drop("_copies"), [*on, "_salt"], how)
    return joined.drop("_salt")


def beside(one: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of a one-row table added to another table, as a scalar."""
    return one.withColumn("_other", other.select(F.struct("*").alias("s")).scalar()).select("*", "_other.*").drop("_other")


def map_values(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str, default=None) -> DataFrame:
    """``df[col]`` looked up in ``table``; keys that are not there give ``default``."""
    found = lookup(df, table.select(F.col(key).alias(col), F.col(value).alias("_found")), [col])
    mapped = F.coalesce(F.col("_found"), F.lit(default)) if default is not None else F.col("_found")
    return found.select(*df.columns, mapped.alias(out))


def with_truth(predictions: DataFrame, truth: DataFrame, key: str, *, within: Column | None = None) -> DataFrame:
    """Predictions that have a ground-truth row; ``within`` adds a time condition."""
    joined = predictions.join(truth, key, "inner")
    return joined if within is None else joined.where(within)


def apply_split(df: DataFrame, membership: DataFrame, key: str, split: str | None = None) -> DataFrame:
    """Re-apply a saved split by key: all of it with its name, or only the rows of one split."""
    if split is None:
        return df.join(membership, key, "inner")
    return df.join(membership.where(F.col("split") == split), key, "left_semi")


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is also in ``right``; none in a leakage-safe split."""
    return left.join(right.select(key).distinct(), key, "left_semi")


def lost(whole: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Rows of ``whole`` whose key is in none of the parts; none in a complete split."""
    return whole.join(parts.select(key).distinct(), key, "left_anti")


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames on top of each other by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def outside_domain(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Distinct non-null values of ``col`` that are not in ``allowed``; empty if the column is a subset."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().where(~F.col(col).isin(list(allowed)))
