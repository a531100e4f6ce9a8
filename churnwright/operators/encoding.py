"""Derived columns and category encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwright.functions import seed_key, weekday
from churnwright.operators.lookups import lookup
from churnwright.operators.ordered import ordered_scan
from churnwright.operators.quantiles import quantiles
from churnwright.session import stage


def date_parts(df: DataFrame, col: str, prefix: str = "ts") -> DataFrame:
    """Year, month and weekday (Monday = 0)."""
    return df.withColumns(
        {f"{prefix}_year": F.year(col), f"{prefix}_month": F.month(col), f"{prefix}_dow": weekday(col)}
    )


def product(df: DataFrame, a: str, b: str, out: str, digits: int | None = 2) -> DataFrame:
    """``a * b``, rounded half-even unless ``digits`` is None."""
    raw = F.col(a) * F.col(b)
    return df.withColumn(out, raw if digits is None else F.bround(raw, digits))


def ratio_column(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")))


def cut(c: Column, edges: Sequence[float]) -> Column:
    """Index of the right-closed bin ``(edges[i], edges[i + 1]]``; null outside the edges."""
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        out = F.when((c > edges[i - 1]) & (c <= edges[i]), F.lit(i - 1)).otherwise(out)
    return out


def recent_flag(df: DataFrame, days: str, within: int, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(days) <= within, F.lit(False)).cast("int"))


def frequency_encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>__freq``: share of the category among the known values; null stays null."""
    # one scan counts the values of all columns; the totals are sums of those counts
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value").where("value is not null")
    counts = stage(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "shares")
    out = df
    for c in cols:
        own = counts.where(F.col("column") == c)
        total = own.groupBy().agg(F.sum("n").alias("n")).scalar()
        out = lookup(out, own.select(F.col("value").cast(df.schema[c].dataType).alias(c), (F.col("n") / total).alias(f"{c}__freq")), [c])
    return out


def vocabulary(frames: Sequence[DataFrame], col: str) -> DataFrame:
    """``(value, code)``: the distinct known values of several frames, numbered from 0 in order."""
    values = frames[0].select(F.col(col).alias("value"))
    for f in frames[1:]:
        values = values.unionByName(f.select(F.col(col).alias("value")))
    values = stage(values.where("value is not null").distinct(), "vocabulary")
    return ordered_scan(values, ["value"], position="_pos").select("value", (F.col("_pos") - 1).cast("int").alias("code"))


def ordinal_encode(df: DataFrame, col: str, codes: DataFrame, out: str) -> DataFrame:
    """Codes of a vocabulary; unseen and missing values are -1."""
    found = lookup(df, stage(codes.select(F.col("value").alias(col), "code"), "codes"), [col])
    return found.select(*df.columns, F.coalesce("code", F.lit(-1)).alias(out))


def one_hot_values(train: DataFrame, col: str, most: int = 2_000) -> list[str]:
    """The values of a category on the training side, in order: one column each. More than ``most`` are an error, not cut off."""
    values = [r["value"] for r in train.select(F.col(col).cast("string").alias("value")).where("value is not null").distinct().orderBy("value").limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{col} has more than {most} values; use frequency_encode or ordinal_encode")
    return values


def one_hot(df: DataFrame, col: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """A 0/1 column for each listed value; a value that is not listed is all zeros."""
    p = prefix or col
    return df.withColumns({f"{p}_{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in values})


def quantile_edges(long: DataFrame, value: str, buckets: int, by: Sequence[str], *, exact: bool = True) -> DataFrame:
    """``(by..., n, inner)``: the distinct inner quantile edges of a reference sample."""
    return inner_edges(quantiles(long, value, edge_probs(buckets), by, exact=exact))


def edge_probs(buckets: int) -> list[float]:
    return [i / buckets for i in range(buckets + 1)]


def inner_edges(q: DataFrame) -> DataFrame:
    """Distinct quantiles without the outermost two."""
    cuts = F.array_sort(F.array_distinct("q"))
    inner = F.when(F.size("_cuts") > 2, F.slice("_cuts", F.lit(2), F.size("_cuts") - 2)).otherwise(F.slice("_cuts", 1, 0))
    return q.withColumn("_cuts", cuts).withColumn("inner", inner).drop("q", "_cuts")


UNROLLED = 12


def bin_index(value: Column, inner: Column) -> Column:
    """Left-closed bin: the number of inner edges at or below the value.

    The first edges are compared one by one, which stays in generated code; only a longer
    list falls back to an array function for the rest.
    """
    passed = F.lit(0)
    for i in range(UNROLLED):
        passed = passed + F.when(value >= F.get(inner, F.lit(i)), 1).otherwise(0)
    rest = F.size(F.filter(F.slice(inner, F.lit(UNROLLED + 1), F.size(inner)), lambda x: value >= x))
    return passed + F.when(F.size(inner) > UNROLLED, rest).otherwise(0)


def target_encode(df: DataFrame, train: DataFrame, col: str, target: str, out: str) -> DataFrame:
    """Mean target of the category on the training rows; the overall mean for categories not seen there."""
    means = train.where(F.col(col).isNotNull()).groupBy(col).agg(F.avg(F.col(target).cast("double")).alias("_m"))
    overall = train.groupBy().agg(F.avg(F.col(target).cast("double")).alias("m")).scalar()
    return lookup(df, stage(means, "means"), [col]).select(*df.columns, F.coalesce("_m", overall).alias(out))


def ordered_target_encode(
    df: DataFrame, col: str, target: str, key: str, out: str, *, seed: int = 42, prior: float = 0.5, weight: float = 1.0
) -> DataFrame:
    """Each row's category by the targets of the rows ahead of it in a seeded permutation: ``(sum + prior * weight) / (n + weight)``.

    A row never sees its own target, nor that of a row behind it, so the column may be trained on. ``prior`` is a fixed
    number, as a mean of the table would hold the row's own target. Rows without a target add nothing; a null category is
    one of its own. The permutation is by md5 of seed and ``key``, ties by ``key``, which should identify a row. A category
    of any size is cut into chunks by the ordered scan.
    """
    y = F.col(target).cast("double")
    drawn = df.withColumn("_draw", seed_key(seed, key))
    run = ordered_scan(drawn, ["_draw", key], [col], before={"_sum": F.coalesce(y, F.lit(0.0)), "_n": y.isNotNull().cast("long")})
    value = (F.col("_sum") + prior * weight) / (F.col("_n") + F.lit(float(weight)))
    return run.select(*df.columns, value.alias(out))


def target_statistics(train: DataFrame, col: str, target: str) -> DataFrame:
    """``(col, sum, n)``: what the whole training table says of each category; mergeable by adding up."""
    y = F.col(target).cast("double")
    return train.groupBy(col).agg(F.coalesce(F.sum(y), F.lit(0.0)).alias("sum"), F.count(y).alias("n"))


def apply_target_statistics(df: DataFrame, statistics: DataFrame, col: str, out: str, *, prior: float = 0.5, weight: float = 1.0) -> DataFrame:
    """Rows to be scored take the statistics of all training rows; an unseen category takes the prior."""
    held = stage(statistics.select(F.struct(F.col(col).alias("v")).alias("_k"), "sum", "n").withColumnsRenamed({"sum": "_sum", "n": "_n"}), "statistics")
    found = lookup(df.withColumn("_k", F.struct(F.col(col).alias("v"))), held, ["_k"])  # in a struct a null category is a key like any other
    value = (F.coalesce("_sum", F.lit(0.0)) + prior * weight) / (F.coalesce("_n", F.lit(0)) + F.lit(float(weight)))
    return found.select(*df.columns, value.alias(out))
