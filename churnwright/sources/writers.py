"""Writing processed data, split membership, metric tables and the schema contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.operators.profiling import EXAMPLES, category_values, schema_profile
from churnwright.operators.sampling import sample_rows


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_membership(df: DataFrame, path: str, key: str, split: str = "split") -> None:
    """Split membership as a ``(key, split)`` table. A key is required: there is no row index to fall back on."""
    write_parquet(df.select(F.col(key).cast("string").alias("key"), F.col(split).alias("split")), path, ["split"])


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """A metric, threshold, drift or run table as CSV with header, or as JSON lines."""
    if fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode(mode).json(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def write_baseline_sample(df: DataFrame, path: str, n: int, key: str, seed: int = 42) -> None:
    """A seeded sample as CSV with header."""
    write_table(sample_rows(df, n, key, seed), path, "csv")


def write_schema_contract(df: DataFrame, path: str, examples: int = EXAMPLES) -> None:
    """``columns``: the schema profile, one JSON object per column. ``values``: every value of every text column, as ``(column, value)``."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    write_table(schema_profile(df, examples), f"{path}/columns", "json")
    write_parquet(category_values(df, texts) if texts else df.sparkSession.createDataFrame([], "column string, value string"), f"{path}/values")
