"""Data checks: one row ``(check, passed, observed, bound)`` each, all read in one pass where they can be."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwright.functions import count_where, known, tidy_text
from churnwright.operators.monitoring import unknown_values
from churnwright.operators.profiling import text_values


@dataclass(frozen=True)
class Check:
    """An aggregate, the limit it is held against, and how (``<=``, ``>=``, ``>``, ``=`` or ``record``)."""

    name: str
    observed: Column
    bound: float | None = None
    how: str = "record"


def no_nulls(col: str, name: str | None = None) -> Check:
    return Check(name or f"no_null_{col}", count_where(F.col(col).isNull()), 0, "=")


def in_domain(col: str, allowed: Sequence, name: str | None = None) -> Check:
    outside = F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))
    return Check(name or f"domain_{col}", count_where(outside), 0, "=")


def more_rows_than(n: int) -> Check:
    return Check("row_count", F.count(F.lit(1)), n, ">")


def class_balance(col: str) -> Check:
    return Check(f"rate_{col}", F.avg(F.col(col).cast("double")))


def null_ratio(col: str, limit: float | None = None) -> Check:
    share = F.avg(F.col(col).isNull().cast("double"))
    return Check(f"null_ratio_{col}", share, limit, "record" if limit is None else "<=")


def in_range(col: str, lo: float | None, hi: float | None) -> Check:
    value, bad = known(F.col(col).cast("double")), F.lit(False)  # NaN is missing, not out of range
    if lo is not None:
        bad = bad | (value < lo)
    if hi is not None:
        bad = bad | (value > hi)
    return Check(f"range_{col}", count_where(bad), 0, "=")


def adds_up(total: str, parts: Column, tolerance: float, name: str) -> Check:
    return Check(name, count_where(F.abs(F.col(total) - parts) > tolerance), 0, "=")


def fresh(ts: str, now: Column, max_days: int) -> Check:
    return Check(f"age_days_{ts}", F.datediff(now, F.max(ts)), max_days, "<=")


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks over ``df`` in one aggregate pass."""
    wide = df.agg(*[c.observed.cast("double").alias(f"c{i}") for i, c in enumerate(checks)])

    def passed(c: Check, v: Column) -> Column:
        tests = {"<=": v <= c.bound, ">=": v >= c.bound, ">": v > c.bound, "=": v == c.bound} if c.bound is not None else {}
        return F.coalesce(tests[c.how], F.lit(False)) if c.how in tests else F.lit(True)

    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                passed(c, F.col(f"c{i}")).alias("passed"),
                F.col(f"c{i}").alias("observed"),
                F.lit(c.bound).cast("double").alias("bound"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return wide.select(F.inline(rows))


def require(results: DataFrame) -> DataFrame:
    """Stop the flow if a check failed. Reads the failed rows only."""
    failed = [r["check"] for r in results.where(~F.col("passed")).select("check").collect()]
    if failed:
        raise ValueError(f"failed checks: {', '.join(failed)}")
    return results


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, n)`` for keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def mixed_spellings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, category, n_spellings, n)`` for categories written in more than one way."""
    counts = text_values(df, cols).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    merged = counts.groupBy("column", tidy_text("value").alias("category")).agg(
        F.count(F.lit(1)).alias("n_spellings"), F.sum("c").alias("n")
    )
    return merged.where("n_spellings > 1")


def conformance(df: DataFrame, contract: Mapping[str, Mapping]) -> DataFrame:
    """Violations of a schema contract: ``(column, rule, n)`` with rules presence, type, null, range and category.

    ``contract`` maps a column to ``{"type", "nullable", "min", "max", "categories"}``, all optional.
    """
    types = dict(df.dtypes)
    found, counted = [], []
    for col, want in contract.items():
        if col not in types:
            found.append((col, "presence"))
            continue
        if "type" in want and want["type"] != types[col]:
            found.append((col, "type"))
        c = F.col(col)
        if want.get("nullable") is False:
            counted.append((col, "null", count_where(c.isNull())))
        if want.get("min") is not None or want.get("max") is not None:
            lo, hi = want.get("min"), want.get("max")
            bad = (c < F.lit(lo) if lo is not None else F.lit(False)) | (c > F.lit(hi) if hi is not None else F.lit(False))
            counted.append((col, "range", count_where(bad)))
        if want.get("categories") is not None:
            counted.append((col, "category", count_where(c.isNotNull() & ~c.isin(list(want["categories"])))))
    aggs = [a.alias(f"c{i}") for i, (_, _, a) in enumerate(counted)] + [F.count(F.lit(1)).alias("_n")]
    rows = [F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.lit(1).cast("bigint").alias("n")) for c, r in found]
    rows += [F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"c{i}").alias("n")) for i, (c, r, _) in enumerate(counted)]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).where("n > 0")


def contract_violations(df: DataFrame, columns: DataFrame, values: DataFrame) -> DataFrame:
    """``conformance`` to a written contract: its table of columns, and its complete table of category values."""
    contract = {}
    for r in columns.collect():  # one row per column
        number = r["dtype"] not in ("string", "boolean") and not r["dtype"].startswith(("timestamp", "date"))
        limits = {k: float(r[k]) for k in ("min", "max") if number and r[k] is not None}
        contract[r["column"]] = {"type": r["dtype"], "nullable": r["nullable"], **limits}
    texts = [c for c, want in contract.items() if want["type"] == "string" and c in df.columns]
    found = conformance(df, contract)
    return found.unionByName(unknown_values(df, values, texts)) if texts else found
