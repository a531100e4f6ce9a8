"""Named queries over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.sources.readers import read_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SCHEMAS: dict[str, T.StructType] = {}

DIGITS = 6


class Tables:
    """The given tables by name, and the derived inputs the queries share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in SCHEMAS:  # read a table's schema from its files once
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return read_parquet(self.spark, path, SCHEMAS[path])

    def derive(self, name: str) -> DataFrame:
        source, columns = DERIVED[name]
        return getattr(self, source).selectExpr(*[f"{text} AS `{c}`" for c, text in columns.items()])


# Derived inputs: source table and column expressions, in text that both engines read alike.
DERIVED: dict[str, tuple[str, dict[str, str]]] = {
    # orders with planted faults
    "dirty": (
        "orders",
        {
            "o_orderkey": "o_orderkey",
            "o_custkey": "o_custkey",
            "price": "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -o_totalprice ELSE o_totalprice END",
            "priority": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END",
            "status": "CASE WHEN o_orderkey % 5 = 0 THEN '  ' || lower(o_orderstatus) || ' ' ELSE o_orderstatus END",
            "placed": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END",
            "visits": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INTEGER) END",
            "target": "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
        },
    ),
    # an order as a contract that runs 30, 60 or 90 days
    "contracts": (
        "orders",
        {
            "contract_id": "o_orderkey",
            "customer_id": "o_custkey",
            "start": "CAST(o_orderdate AS DATE)",
            "end": "CAST(o_orderdate AS DATE) + CAST(30 + 30 * (o_orderkey % 3) AS INTEGER)",
            "price": "o_totalprice",
        },
    ),
    # line items scored by two fixed rules with a planted signal
    "scored": (
        "lineitem",
        {
            "segment": "l_linestatus",
            "quarter": "CAST(quarter(l_shipdate) AS INTEGER)",
            "shipped": "l_shipdate",
            "label": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
            "score": "CAST((l_partkey * 7 + l_linenumber * 13 + CASE WHEN l_returnflag = 'R' THEN 150 ELSE 0 END) % 997 AS DOUBLE) / 997",
            "score_b": "CAST((l_suppkey * 31 + l_linenumber * 17 + CASE WHEN l_returnflag = 'R' THEN 60 ELSE 0 END) % 499 AS DOUBLE) / 499",
            "fold": "CAST(l_orderkey % 5 AS INTEGER)",
            "run": "l_suppkey % 20",
        },
    ),
    "lines": (
        "lineitem",
        {
            "target": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
            "quantity": "l_quantity",
            "price": "l_extendedprice",
            "discount": "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_discount END",
            "tax": "l_tax",
            "linestatus": "l_linestatus",
            "quarter": "CAST(quarter(l_shipdate) AS STRING)",
            "size_class": "CASE WHEN l_quantity > 40 THEN 'large' WHEN l_quantity > 15 THEN 'mid' ELSE 'small' END",
        },
    ),
    # a model registry: one package per order
    "registry": (
        "orders",
        {
            "arn": "'pkg/' || CAST(o_orderkey AS STRING)",
            "group": "'group-' || CAST(o_custkey % 40 AS STRING)",
            "status": "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'PendingManualApproval' ELSE 'Rejected' END",
            "created": "o_orderdate",
            "run_id": "CASE WHEN o_orderkey % 3 = 0 THEN 'run-' || CAST(o_orderkey % 50 AS STRING) END",
            "champion": "CASE WHEN o_orderkey % 4 = 0 THEN 'True' WHEN o_orderkey % 4 = 1 THEN 'false' END",
            "metric": "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 'n/a' ELSE CAST(CAST(o_orderkey % 100 AS INTEGER) AS STRING) END",
            "owner": "o_orderpriority",
        },
    ),
}


def ctes(*names: str) -> str:
    """The derived inputs as common table expressions."""
    parts = []
    for name in names:
        source, columns = DERIVED[name]
        body = ", ".join(f'{text} AS "{c}"' for c, text in columns.items())
        parts.append(f"{name} AS (SELECT {body} FROM {source})")
    return "WITH " + ", ".join(parts)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, as the two engines add in different orders."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in cols}) if cols else df


def query(key: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``key``, with its SQL where there is one."""

    def add(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add
