"""Samples, limits, splits and folds."""

from pyspark.sql import functions as F

from churnwright.operators import sampling as sa
from churnwright.operators import splitting as sp
from churnwright.plans.registry import ctes, query, rounded

KEY = "md5('42|' || CAST(o_orderkey AS VARCHAR))"


@query("l1_sample_rows", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {KEY}, o_orderkey LIMIT 1000")
def _(t):
    return sa.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), 1000, "o_orderkey")


@query("l2_sample_fraction", f"SELECT o_orderkey, o_totalprice FROM orders WHERE substr({KEY}, 1, 8) < '4ccccccc'")
def _(t):
    return sa.sample_fraction(t.orders.select("o_orderkey", "o_totalprice"), 0.3, "o_orderkey")


@query(
    "l3_sample_per_stratum",
    f"""WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY {KEY}, o_orderkey) AS rn, COUNT(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
        SELECT o_orderkey, o_orderpriority FROM r WHERE rn <= LEAST(CEIL(n * CAST(0.25 AS DOUBLE)), 700)""",
)
def _(t):
    return sa.sample_per_stratum(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 0.25, 700)


@query(
    "l3b_sample_per_hot_stratum",
    f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS VARCHAR) END AS stratum FROM orders),
        r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY stratum ORDER BY {KEY}, o_orderkey) AS rn, COUNT(*) OVER (PARTITION BY stratum) AS n FROM s)
        SELECT o_orderkey, stratum FROM r WHERE rn <= CEIL(n * CAST(0.4 AS DOUBLE))""",
)
def _(t):
    """A third of the rows are without a stratum; they are one of their own, and no rows but those at the cuts are ranked."""
    stratum = F.when(F.col("o_orderkey") % 3 != 0, (F.col("o_custkey") % 50).cast("string")).alias("stratum")
    return sa.sample_per_stratum(t.orders.select("o_orderkey", stratum), "stratum", "o_orderkey", 0.4)


@query("l4_first_by_key", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 200")
def _(t):
    return sa.first_by_key(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 200)


@query("l5_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return sa.top_k(t.orders.select("o_orderkey", "o_totalprice"), F.col("o_totalprice"), 20, "o_orderkey")


@query(
    "l6_best_row",
    """SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM orders
       QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_totalprice DESC, o_orderkey) = 1""",
)
def _(t):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    return sa.best_row(df, ["o_orderpriority", "o_totalprice"], "o_orderkey", ["o_custkey"])


DIRTY = ctes("dirty")


@query(
    "l7_time_split",
    DIRTY
    + """, c AS (SELECT quantile_cont(CAST(epoch_us(placed) AS DOUBLE), 0.8) AS q FROM dirty WHERE placed IS NOT NULL)
         SELECT o_orderkey, CASE WHEN CAST(epoch_us(placed) AS DOUBLE) < q THEN 'train' ELSE 'valid' END AS split FROM dirty, c""",
)
def _(t):
    df = t.derive("dirty").select("o_orderkey", "placed", "status")
    return sp.time_or_stratified_split(df, "placed", "status", "o_orderkey").select("o_orderkey", "split")


@query(
    "l8_positional_split",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, COUNT(*) OVER () AS n FROM orders)
       SELECT o_orderkey, CASE WHEN rn <= FLOOR(n * CAST(0.8 AS DOUBLE)) THEN 'train' WHEN rn <= FLOOR(n * CAST(0.9 AS DOUBLE)) THEN 'valid' ELSE 'test' END AS split FROM r""",
)
def _(t):
    return sp.positional_split(t.orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "split")


def _strata(source: str, cls: str, share: str, seed: int = 42) -> str:
    key = f"md5('{seed}|' || CAST(o_orderkey AS VARCHAR))"
    return f"""SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY {cls} ORDER BY {key}, o_orderkey) <= FLOOR(COUNT(*) OVER (PARTITION BY {cls}) * CAST({share} AS DOUBLE) + 0.5) THEN 1 ELSE 0 END AS hit FROM {source}"""


@query("l9_stratified_split", f"WITH s AS ({_strata('orders', 'o_orderstatus', '0.2')}) SELECT o_orderkey, o_orderstatus, CASE hit WHEN 1 THEN 'test' ELSE 'train' END AS split FROM s")
def _(t):
    return sp.stratified_split(t.orders, "o_orderstatus", "o_orderkey").select("o_orderkey", "o_orderstatus", "split")


@query(
    "l10_three_way_split",
    f"""WITH c AS (SELECT quantile_cont(CAST(epoch_us(o_orderdate) AS DOUBLE), 0.8) AS q FROM orders),
             rest AS (SELECT o_orderkey, o_orderstatus FROM orders, c WHERE CAST(epoch_us(o_orderdate) AS DOUBLE) < q), s AS ({_strata('rest', 'o_orderstatus', '0.125')})
        SELECT o_orderkey, CASE hit WHEN 1 THEN 'val' ELSE 'train' END AS split FROM s
        UNION ALL SELECT o_orderkey, 'test' FROM orders, c WHERE CAST(epoch_us(o_orderdate) AS DOUBLE) >= q""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return sp.three_way_split(df, "o_orderstatus", "o_orderkey", time="o_orderdate").select("o_orderkey", "split")


@query(
    "l11_stratified_folds",
    f"SELECT o_orderkey, o_orderstatus, CAST((ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY {KEY}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders",
)
def _(t):
    return sp.stratified_folds(t.orders, "o_orderstatus", "o_orderkey").select("o_orderkey", "o_orderstatus", "fold")


BLOCKS = """WITH r AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, COUNT(*) OVER () AS n FROM orders),
  b AS (SELECT *, CAST(CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INTEGER) AS block FROM r)"""


def _blocks(t):
    df = t.orders.withColumn("target", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    return sp.expanding_folds(df, ["o_orderdate", "o_orderkey"], 5)


@query("l12_expanding_blocks", BLOCKS + " SELECT o_orderkey, block FROM b")
def _(t):
    return _blocks(t).select("o_orderkey", "block")


@query(
    "l12b_expanding_folds",
    BLOCKS
    + """ SELECT CAST(f AS INTEGER) AS fold, COUNT(*) FILTER (block < f) AS n_train, COUNT(*) FILTER (block = f) AS n_test, ROUND(AVG(CAST(target AS DOUBLE)) FILTER (block = f), 6) AS test_rate
          FROM b, range(1, 6) x(f) GROUP BY 1""",
)
def _(t):
    return rounded(sp.fold_sizes(_blocks(t), "target"))


@query(
    "l13_split_report",
    """WITH r AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS target, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, COUNT(*) OVER () AS n FROM orders),
            s AS (SELECT *, CASE WHEN rn <= FLOOR(n * CAST(0.8 AS DOUBLE)) THEN 'train' WHEN rn <= FLOOR(n * CAST(0.9 AS DOUBLE)) THEN 'valid' ELSE 'test' END AS split FROM r)
       SELECT split, COUNT(*) AS n, ROUND(COUNT(*) / MAX(n), 6) AS share, MIN(o_orderdate) AS first, MAX(o_orderdate) AS last, ROUND(AVG(CAST(target AS DOUBLE)), 6) AS target_rate FROM s GROUP BY 1""",
)
def _(t):
    df = t.orders.withColumn("target", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    return rounded(sp.split_report(sp.positional_split(df, ["o_orderdate", "o_orderkey"]), "o_orderdate", "target"))


@query(
    "l14_time_holdout",
    DIRTY
    + """, c AS (SELECT quantile_cont(CAST(epoch_us(placed) AS DOUBLE), 0.8) AS q FROM dirty WHERE placed IS NOT NULL)
         SELECT o_orderkey, CASE WHEN CAST(epoch_us(placed) AS DOUBLE) >= q THEN 'test' ELSE 'train' END AS split FROM dirty, c WHERE placed IS NOT NULL""",
)
def _(t):
    return sp.holdout(t.derive("dirty").select("o_orderkey", "placed"), "placed").select("o_orderkey", "split")
