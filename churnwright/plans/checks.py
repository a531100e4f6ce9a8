"""Data checks."""

from pyspark.sql import functions as F

from churnwright.operators import checks as v
from churnwright.plans.registry import ctes, query, rounded
from churnwright.session import new_path
from churnwright.sources.readers import read_schema_contract
from churnwright.sources.writers import write_schema_contract

DIRTY = ctes("dirty")


def _row(name: str, passed: str, observed: str, bound: str) -> str:
    return f"SELECT '{name}' AS \"check\", {passed} AS passed, ROUND(CAST({observed} AS DOUBLE), 6) AS observed, CAST({bound} AS DOUBLE) AS bound FROM dirty"


V_ROWS = [
    _row("no_null_target", "COUNT(*) FILTER (target IS NULL) = 0", "COUNT(*) FILTER (target IS NULL)", "0"),
    _row("domain_target", "true", "COUNT(*) FILTER (target NOT IN (0, 1))", "0"),
    _row("domain_visits", "COUNT(*) FILTER (visits NOT IN (0, 1, 2)) = 0", "COUNT(*) FILTER (visits NOT IN (0, 1, 2))", "0"),
    _row("row_count", "COUNT(*) > 1000", "COUNT(*)", "1000"),
    _row("rate_target", "true", "AVG(CAST(target AS DOUBLE))", "NULL"),
    _row("no_null_o_orderkey", "true", "COUNT(*) FILTER (o_orderkey IS NULL)", "0"),
    _row("null_ratio_price", "COUNT(*) FILTER (price IS NULL) / COUNT(*) <= 0.1", "COUNT(*) FILTER (price IS NULL) / COUNT(*)", "0.1"),
    _row("null_ratio_visits", "true", "COUNT(*) FILTER (visits IS NULL) / COUNT(*)", "NULL"),
    _row("range_price", "COUNT(*) FILTER (price < 0) = 0", "COUNT(*) FILTER (price < 0)", "0"),
    _row("age_days_placed", "date_diff('day', CAST(MAX(placed) AS DATE), DATE '2001-09-01') <= 7", "date_diff('day', CAST(MAX(placed) AS DATE), DATE '2001-09-01')", "7"),
]


@query("v_all_checks", DIRTY + " " + " UNION ALL ".join(V_ROWS))
def _(t):
    checks = [
        v.no_nulls("target"),
        v.in_domain("target", [0, 1]),
        v.in_domain("visits", [0, 1, 2]),
        v.more_rows_than(1000),
        v.class_balance("target"),
        v.no_nulls("o_orderkey"),
        v.null_ratio("price", 0.1),
        v.null_ratio("visits"),
        v.in_range("price", 0, None),
        v.fresh("placed", F.lit("2001-09-01").cast("date"), 7),
    ]
    return rounded(v.run_checks(t.derive("dirty"), checks))


SINGLE = {
    "v1_no_null_target": (0, lambda: v.no_nulls("target")),
    "v2_target_domain": (1, lambda: v.in_domain("target", [0, 1])),
    "v3_row_count": (3, lambda: v.more_rows_than(1000)),
    "v4_class_balance": (4, lambda: v.class_balance("target")),
    "v5_no_null_key": (5, lambda: v.no_nulls("o_orderkey")),
    "v6_null_ratio": (6, lambda: v.null_ratio("price", 0.1)),
    "v8_out_of_range": (8, lambda: v.in_range("price", 0, None)),
    "v10_timeliness": (9, lambda: v.fresh("placed", F.lit("2001-09-01").cast("date"), 7)),
}


def _single(make):
    return lambda t: rounded(v.run_checks(t.derive("dirty"), [make()]))


for _key, (_i, _make) in SINGLE.items():
    query(_key, f"{DIRTY} {V_ROWS[_i]}")(_single(_make))


@query("v5b_duplicate_keys", "SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1")
def _(t):
    return v.duplicate_keys(t.lineitem, "l_orderkey")


@query(
    "v7_mixed_spellings",
    DIRTY
    + """, s AS (SELECT 'status' AS "column", status AS v FROM dirty UNION ALL SELECT 'priority', priority FROM dirty WHERE priority IS NOT NULL)
         SELECT "column", lower(trim(v)) AS category, COUNT(DISTINCT v) AS n_spellings, COUNT(*) AS n FROM s GROUP BY 1, 2 HAVING COUNT(DISTINCT v) > 1""",
)
def _(t):
    return v.mixed_spellings(t.derive("dirty"), ["status", "priority"])


@query(
    "v9_adds_up",
    """SELECT 'price_adds_up' AS "check", COUNT(*) FILTER (ABS(l_extendedprice - l_quantity * p_retailprice) > 1000) = 0 AS passed,
              CAST(COUNT(*) FILTER (ABS(l_extendedprice - l_quantity * p_retailprice) > 1000) AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS bound FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return v.run_checks(lines, [v.adds_up("l_extendedprice", F.col("l_quantity") * F.col("p_retailprice"), 1000.0, "price_adds_up")])


CONTRACT = {
    "o_orderkey": {"type": "bigint", "nullable": False},
    "price": {"type": "float", "min": 0, "max": 400000},
    "priority": {"type": "string", "nullable": False, "categories": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
    "visits": {"type": "int", "min": 0, "max": 3},
    "region": {"type": "string"},
}


@query(
    "v11_conformance",
    DIRTY
    + """ SELECT * FROM (SELECT 'price' AS "column", 'type' AS rule, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'region', 'presence', 1
          UNION ALL SELECT 'price', 'range', COUNT(*) FILTER (price < 0 OR price > 400000) FROM dirty
          UNION ALL SELECT 'priority', 'null', COUNT(*) FILTER (priority IS NULL) FROM dirty
          UNION ALL SELECT 'priority', 'category', COUNT(*) FILTER (priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) FROM dirty) WHERE n > 0""",
)
def _(t):
    return v.conformance(t.derive("dirty"), CONTRACT)


@query(
    "v11b_written_contract",
    """WITH o AS (SELECT o_orderkey, o_totalprice AS price, 'clerk ' || CAST(o_custkey % 61 AS VARCHAR) AS clerk FROM orders),
            b AS (SELECT * FROM o WHERE o_orderkey % 2 = 0 AND clerk <> 'clerk 5'), c AS (SELECT o_orderkey, price, CASE WHEN o_orderkey % 9 <> 0 THEN clerk END AS clerk FROM o WHERE o_orderkey % 2 = 1)
       SELECT * FROM (SELECT 'price' AS "column", 'range' AS rule, COUNT(*) FILTER (price < (SELECT MIN(price) FROM b) OR price > (SELECT MAX(price) FROM b)) AS n FROM c
         UNION ALL SELECT 'o_orderkey', 'range', COUNT(*) FILTER (o_orderkey < (SELECT MIN(o_orderkey) FROM b) OR o_orderkey > (SELECT MAX(o_orderkey) FROM b)) FROM c
         UNION ALL SELECT 'clerk', 'null', COUNT(*) FILTER (clerk IS NULL) FROM c
         UNION ALL SELECT 'clerk', 'category', COUNT(*) FILTER (clerk NOT IN (SELECT clerk FROM b)) FROM c) WHERE n > 0""",
)
def _(t):
    # the contract is written from one half of the orders and read back for the other
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.concat(F.lit("clerk "), (F.col("o_custkey") % 61).cast("string")).alias("clerk"))
    path = new_path(t.spark, "contract")
    write_schema_contract(rows.where("o_orderkey % 2 = 0 and clerk <> 'clerk 5'"), path)
    later = rows.where("o_orderkey % 2 = 1").withColumn("clerk", F.when(F.col("o_orderkey") % 9 != 0, F.col("clerk")))
    return v.contract_violations(later, *read_schema_contract(t.spark, path))
