"""Column helpers shared by the operators; all stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the characters a category is stripped of (space and the ASCII control whitespace).
WHITESPACE = " \t\n\r\f\v"


def known(c: Column | str) -> Column:
    """NaN and the infinities become null, so that null is the only missing marker."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def present(df: DataFrame, col: str) -> Column:
    """The column with null as its only missing marker: of a floating-point column only what is ``known``."""
    return known(F.col(col)) if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) else F.col(col)


def tidy_text(c: Column | str) -> Column:
    """Strip surrounding whitespace and lower-case."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.btrim(c, F.lit(WHITESPACE)))


def seed_key(seed: int, *cols: Column | str) -> Column:
    """Pseudo-random order key: the same for the same seed and key, whatever the partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]))


def hex_bound(fraction: float) -> str:
    """Eight hex digits below which ``fraction`` of all md5 keys fall."""
    return format(min(int(fraction * 16**8), 16**8 - 1), "08x") if fraction < 1 else "g"


def ratio(a: Column, b: Column, otherwise: float | None = 0.0) -> Column:
    """``a / b`` as double, ``otherwise`` where ``b`` is not positive."""
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(otherwise).cast("double"))


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` holds; null counts as no."""
    return F.count_if(condition)


def weekday(c: Column | str) -> Column:
    """Day of the week, Monday = 0."""
    return F.weekday(c)
