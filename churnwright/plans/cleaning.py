"""Selection, coercion, filling and repair."""

from pyspark.sql import functions as F

from churnwright.operators import cleaning as c
from churnwright.plans.registry import ctes, query, rounded

DIRTY = ctes("dirty")


@query("p1_drop_listed", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def _(t):
    return c.drop_listed(t.orders, ["o_custkey", "o_orderstatus", "o_orderpriority", "not_there"])


@query("p2_drop_named_like", "SELECT ts, event_type, value, props FROM events")
def _(t):
    return c.drop_named_like(t.events)


@query("p3_drop_times", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(t):
    return c.drop_times(t.orders)


@query("p4_drop_sparse", DIRTY + " SELECT o_orderkey, o_custkey, status, placed, CAST(visits AS DOUBLE) AS visits, CAST(target AS DOUBLE) AS target FROM dirty")
def _(t):
    # price (1 / 7) and priority (1 / 9) are over the limit, placed (1 / 13), visits (1 / 10) and target (1 / 17) are not
    return c.drop_sparse(t.derive("dirty"), 0.105).withColumns({n: F.col(n).cast("double") for n in ("visits", "target")})


@query(
    "p5_coerce_numeric",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price_text, o_orderpriority AS mixed
       FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END AS o_orderpriority FROM orders)""",
)
def _(t):
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(F.col("o_orderpriority"))
    return c.coerce_numeric(t.orders.select("o_orderkey", F.col("o_totalprice").cast("string").alias("price_text"), mixed.alias("mixed")), ["price_text", "mixed"])


@query(
    "p6_parse_yyyymmdd",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS day,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS general FROM orders""",
)
def _(t):
    digits = F.date_format("o_orderdate", "yyyyMMdd")
    day = F.when(F.col("o_orderkey") % 8 == 0, F.lit("20011399")).otherwise(digits)
    general = F.when(F.col("o_orderkey") % 5 == 0, F.lit("soon")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = t.orders.select("o_orderkey", day.alias("day"), general.alias("general"))
    out = c.parse_dates(c.parse_dates(df, "day"), "general")
    return out.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("day", "general")})


@query("p7_coerce_timestamp", "SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE date_trunc('second', ts) END AS ts FROM events")
def _(t):
    text = F.when(F.col("event_id") % 6 == 0, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    out = c.coerce_timestamp(t.events.select("event_id", text.alias("ts")), "ts")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "p8_interval_days",
    "SELECT event_id, ROUND(CAST(date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) AS DOUBLE) / 86400000000, 6) AS age_days FROM events",
)
def _(t):
    df = t.events.select("event_id", (F.col("ts") - F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")).alias("age_days"))
    return rounded(c.interval_days(df, "age_days"))


@query("p9_fill_ints", DIRTY + " SELECT o_orderkey, CAST(COALESCE(visits, -1) AS INTEGER) AS visits FROM dirty")
def _(t):
    return c.fill_ints(t.derive("dirty").select("o_orderkey", "visits"), ["visits"])


@query("p10_fill_floats", DIRTY + " SELECT o_orderkey, COALESCE(price, 0.0) AS price FROM dirty")
def _(t):
    return c.fill_floats(t.derive("dirty").select("o_orderkey", "price"), ["price"])


@query("p11_fill_categories", DIRTY + " SELECT o_orderkey, COALESCE(priority, '<MISSING>') AS priority FROM dirty")
def _(t):
    return c.fill_categories(t.derive("dirty").select("o_orderkey", "priority"), ["priority"])


@query(
    "p12_median_fill",
    DIRTY
    + """ SELECT o_orderkey, ROUND(COALESCE(price, (SELECT median(price) FROM dirty)), 6) AS price,
                 ROUND(COALESCE(CAST(visits AS DOUBLE), (SELECT median(visits) FROM dirty)), 6) AS visits FROM dirty""",
)
def _(t):
    return rounded(c.fill_median(t.derive("dirty").select("o_orderkey", "price", "visits"), ["price", "visits"]))


@query("p13_null_negative", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def _(t):
    return c.null_negative(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"])


@query(
    "p14_unify_missing",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN NULL ELSE o_totalprice END AS price FROM orders",
)
def _(t):
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    v = F.when(F.col("o_orderkey") % 4 == 0, nan).when(F.col("o_orderkey") % 8 == 1, inf).when(F.col("o_orderkey") % 8 == 5, -inf)
    return c.unify_missing(t.orders.select("o_orderkey", v.otherwise(F.col("o_totalprice")).alias("price")))


@query("p15_tidy_text", DIRTY + " SELECT o_orderkey, lower(trim(status)) AS status FROM dirty")
def _(t):
    return c.normalise_text(t.derive("dirty").select("o_orderkey", "status"), ["status"])


@query(
    "p16_cap_iqr",
    """WITH v AS (SELECT *, value AS raw FROM events), q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM v)
       SELECT event_id, ROUND(GREATEST(LEAST(value, b + 1.5 * (b - a)), a - 1.5 * (b - a)), 6) AS value FROM v, q""",
)
def _(t):
    return rounded(c.cap_outliers(t.events.select("event_id", "value"), ["value"]))


@query("p17_drop_unlabelled", DIRTY + " SELECT o_orderkey, target FROM dirty WHERE target IS NOT NULL")
def _(t):
    return c.drop_unlabelled(t.derive("dirty").select("o_orderkey", "target"), "target")


@query("p18_binary_target", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target FROM orders")
def _(t):
    return c.binary_target(t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("target")), "target")


@query("p19_key_as_text", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders")
def _(t):
    return c.as_text(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey", "o_custkey"])


@query(
    "p20_label_at_threshold",
    ctes("scored") + " SELECT segment, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted, COUNT(*) AS n FROM scored GROUP BY ALL",
)
def _(t):
    return c.label_at(t.derive("scored"), "score", 0.5).groupBy("segment", "predicted").agg(F.count(F.lit(1)).alias("n"))


@query(
    "xu4_user_cleaning_rules",
    DIRTY + " SELECT o_orderkey, CASE WHEN price < 0 THEN NULL ELSE price END AS price, COALESCE(lower(trim(priority)), 'none') AS priority FROM dirty WHERE target IS NOT NULL",
)
def _(t):
    rules = [
        lambda d: c.drop_unlabelled(d, "target"),
        lambda d: c.null_negative(d, ["price"]),
        lambda d: c.normalise_text(d, ["priority"]),
        lambda d: c.fill_categories(d, ["priority"], "none"),
        lambda d: d.select("o_orderkey", "price", "priority"),
    ]
    return c.apply_rules(t.derive("dirty"), rules)
