"""Reading tables, captured requests and log metrics. NaN and the infinities become null on the way in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.operators.cleaning import unify_missing

# One JSON line of captured traffic.
CAPTURE_SCHEMA = T.StructType([T.StructField("request", T.StructType([T.StructField("body", T.StringType())]))])


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, glob: str | None = None) -> DataFrame:
    """One file, a folder or a wildcard set. Spark fails if nothing matches."""
    reader = spark.read.schema(schema) if schema else spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return unify_missing(reader.parquet(*([path] if isinstance(path, str) else path)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return unify_missing(spark.read.schema(schema).option("header", True).csv(path))


def read_query(spark: SparkSession, url: str, sql: str, properties: Mapping[str, str] | None = None, *, split_on: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 64) -> DataFrame:
    """A warehouse query over JDBC. With ``split_on`` and its value bounds it is read in ``parts`` slices side by side."""
    reader = spark.read.format("jdbc").option("url", url)
    if split_on:
        if bounds is None:
            raise ValueError("split_on needs bounds")
        reader = (
            reader.option("dbtable", f"({sql}) q")
            .option("partitionColumn", split_on)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(parts))
        )
    else:
        reader = reader.option("query", sql)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return unify_missing(reader.load())


def read_sql(spark: SparkSession, sql: str, views: Mapping[str, DataFrame]) -> DataFrame:
    """The same query text over DataFrames, passed as named arguments (``{name}`` in the text)."""
    return unify_missing(spark.sql(sql, **views))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV or Parquet by suffix, as a baseline may be either."""
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV baseline needs a schema")
        return read_csv(spark, path, schema)
    return read_parquet(spark, path, schema)


def read_capture(spark: SparkSession, path: str, schema: T.StructType = CAPTURE_SCHEMA) -> DataFrame:
    """Captured JSON lines, plain or gzip (by suffix)."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def read_schema_contract(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The columns ``(column, dtype, nullable, min, max, n_categories, example_values)`` and the values ``(column, value)`` of a written contract."""
    columns = "column string, dtype string, nullable boolean, min string, max string, n_categories bigint, example_values array<string>"
    return spark.read.schema(columns).json(f"{path}/columns"), spark.read.schema("column string, value string").parquet(f"{path}/values")


def newest_files(spark: SparkSession, path: str, n: int, schema: T.StructType = CAPTURE_SCHEMA) -> DataFrame:
    """Rows of the ``n`` newest capture files, by modification time and then name; no other file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime")
    newest = listing.orderBy(F.desc("modificationTime"), F.desc("path")).limit(n).collect()
    rows = spark.read.schema(schema).json([r["path"] for r in newest])
    return rows.withColumn("_file", F.col("_metadata.file_path"))


def log_metrics(lines: DataFrame, patterns: Mapping[str, str], text: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., metric, value)`` for every log line that matches a metric's pattern (first group)."""
    entries = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.regexp_extract(text, p, 1).try_cast("double").alias("value")) for m, p in patterns.items()]
    )
    return lines.select(*keep, F.inline(entries)).where("value is not null")
