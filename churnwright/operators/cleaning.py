"""Column selection, coercion, filling and repair of one table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.functions import count_where, known, tidy_text
from churnwright.operators.quantiles import as_struct, column_quantiles

# The tokens that stand for a missing category.
MISSING = "<MISSING>"
MISSING_PLAIN = "__MISSING__"
# Fixed value: the int64 that stands for "no timestamp" in exported tables.
NO_TIME = -(2**63)
# Fixed value: eight digits, year month day.
DAY_DIGITS = r"^\d{8}$"

NUMERIC = (T.NumericType,)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def columns_of(df: DataFrame, kinds: tuple[type, ...], skip: Iterable[str] = ()) -> list[str]:
    """Names of the columns whose type is one of ``kinds``."""
    skip = set(skip)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def drop_listed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def drop_named_like(df: DataFrame, parts: Sequence[str] = ("id", "codigo")) -> DataFrame:
    """Drop every column whose lower-cased name contains one of ``parts``."""
    return df.select(*[c for c in df.columns if not any(p in c.lower() for p in parts)])


def drop_times(df: DataFrame) -> DataFrame:
    return df.drop(*columns_of(df, TIMES))


def drop_sparse(df: DataFrame, max_null_ratio: float) -> DataFrame:
    """Drop the columns whose share of nulls is above the limit. Reads one aggregate row to decide."""
    shares = df.agg(F.count(F.lit(1)).alias("_n"), *[count_where(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    total = shares["_n"]
    return df.drop(*[c for c in df.columns if total and shares[c] / total > max_null_ratio])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast a text column to double only if every non-null value of it converts. Reads one aggregate row to decide."""
    bad = df.agg(*[count_where(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in cols]).first()
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols if bad[c] == 0})


def parse_dates(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Eight-digit days if the whole column looks like that (or is an integer), else general dates; bad values are null."""
    text = F.col(col).cast("string")
    if isinstance(df.schema[col].dataType, T.IntegralType):
        day_form = F.lit(True)
    else:
        day_form = df.groupBy().agg(F.every(F.coalesce(text.rlike(DAY_DIGITS), F.lit(False))).alias("b")).scalar()
    by_day = F.try_to_timestamp(F.when(text.rlike(DAY_DIGITS), text), F.lit("yyyyMMdd"))
    return df.withColumn(out or col, F.when(day_form, by_day).otherwise(F.try_to_timestamp(text)))


def coerce_timestamp(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    if isinstance(df.schema[col].dataType, TIMES):
        return df.withColumn(out or col, F.col(col))
    return df.withColumn(out or col, F.try_to_timestamp(F.col(col).cast("string")))


def timestamp_from_micros(df: DataFrame, col: str) -> DataFrame:
    """int64 microseconds to timestamp, with the no-time sentinel as null."""
    return df.withColumn(col, F.timestamp_micros(F.when(F.col(col) != F.lit(NO_TIME), F.col(col))))


def interval_days(df: DataFrame, col: str) -> DataFrame:
    """A day-time interval as fractional days; numeric columns pass unchanged."""
    if not isinstance(df.schema[col].dataType, T.DayTimeIntervalType):
        return df
    c = f"`{col}`"
    days = F.expr(
        f"extract(DAY FROM {c}) + extract(HOUR FROM {c}) / 24D + extract(MINUTE FROM {c}) / 1440D"
        f" + cast(extract(SECOND FROM {c}) as double) / 86400D"
    )
    return df.withColumn(col, days.cast("double"))


def fill_ints(df: DataFrame, cols: Sequence[str], value: int = -1, to: str = "int") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)).cast(to) for c in cols if c in df.columns})


def fill_floats(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.coalesce(known(F.col(c).cast("double")), F.lit(value)) for c in cols if c in df.columns})


def fill_categories(df: DataFrame, cols: Sequence[str], token: str = MISSING) -> DataFrame:
    return df.na.fill(token, list(cols))


def fill_median(df: DataFrame, cols: Sequence[str], *, exact: bool = True) -> DataFrame:
    """Missing numerics get the median of their column, measured on ``df``."""
    stats = as_struct(column_quantiles(df, cols, [0.5], exact=exact), cols, F.col("q")[0])
    filled = df.withColumn("_stats", stats)
    return filled.withColumns(
        {c: F.coalesce(known(F.col(c).cast("double")), F.col("_stats").getField(c)) for c in cols}
    ).drop("_stats")


def null_where(df: DataFrame, col: str, invalid: Column) -> DataFrame:
    """Values for which ``invalid`` holds become null."""
    return df.withColumn(col, F.when(F.coalesce(invalid, F.lit(False)), F.lit(None)).otherwise(F.col(col)))


def null_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return reduce(lambda d, c: null_where(d, c, F.col(c) < 0), cols, df)


def unify_missing(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every floating column."""
    return df.withColumns({c: known(c) for c in columns_of(df, (T.DoubleType, T.FloatType))})


def normalise_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: tidy_text(c) for c in cols})


def cap_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, *, exact: bool = True) -> DataFrame:
    """Clip each column to [Q1 - k IQR, Q3 + k IQR]; nulls stay null."""
    stats = column_quantiles(df, cols, [0.25, 0.75], exact=exact)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    bounds = as_struct(stats, cols, F.struct((q1 - (q3 - q1) * k).alias("lo"), (q3 + (q3 - q1) * k).alias("hi")))
    held = df.withColumn("_b", bounds)
    clip = lambda c: F.when(
        F.col(c).isNotNull(), F.greatest(F.least(F.col(c).cast("double"), F.col(f"_b.{c}.hi")), F.col(f"_b.{c}.lo"))
    )
    return held.withColumns({c: clip(c) for c in cols}).drop("_b")


def drop_unlabelled(df: DataFrame, target: str) -> DataFrame:
    return df.na.drop(subset=[target])


def binary_target(df: DataFrame, target: str) -> DataFrame:
    """The target as int. Under ANSI mode a value that is no number fails the job."""
    return df.withColumn(target, F.col(target).cast("int"))


def as_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def label_at(df: DataFrame, score: str, threshold: float | Column, out: str = "predicted") -> DataFrame:
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn(out, (F.col(score) >= thr).cast("int"))


def apply_rules(df: DataFrame, rules: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """User cleaning rules, in order."""
    return reduce(lambda d, rule: d.transform(rule), rules, df)
