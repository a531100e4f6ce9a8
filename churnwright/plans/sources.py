"""Sources and sinks: written and read back, or parsed from text derived from the tables."""

from pyspark.sql import functions as F

from churnwright.operators.lookups import outside_domain, stack
from churnwright.operators.splitting import stratified_split
from churnwright.plans.registry import query
from churnwright.session import new_path
from churnwright.sources import readers, writers

# The log patterns of the search metrics.
LOG_PATTERNS = {
    "roc_auc": r"Final ROC-AUC: ([0-9]+\.[0-9]+)",
    "f1_score": r"Final F1 @ target recall: ([0-9]+\.[0-9]+)",
    "churner_recall": r"Churner recall:\s+([0-9]+\.[0-9]+)",
    "churner_precision": r"Churner precision:\s+([0-9]+\.[0-9]+)",
}


@query(
    "s1_parquet_wildcard",
    "SELECT o_orderstatus, COUNT(*) AS n, MIN(o_orderkey) AS first_key, MAX(o_orderdate) AS last_date FROM orders GROUP BY 1",
)
def _(t):
    # three files of a folder that the pattern names, and one that it does not
    path = new_path(t.spark, "snapshots")
    for part in range(3):
        t.orders.where(F.col("o_orderkey") % 3 == part).write.parquet(f"{path}/orders-{part}.parquet")
    t.orders.limit(1).write.parquet(f"{path}/other.parquet")
    df = readers.read_parquet(t.spark, f"{path}/order*.parquet")
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderdate").alias("last_date")
    )


@query(
    "s2_query_text",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def _(t):
    return readers.read_sql(t.spark, "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderstatus = 'F'", {"orders": t.orders})


@query(
    "s3_csv_header",
    "SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys, MAX(c_acctbal) AS top FROM customer GROUP BY 1",
)
def _(t):
    path = new_path(t.spark, "csv")
    writers.write_table(t.customer, path, "csv")
    return readers.read_csv(t.spark, path, t.customer.schema).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"), F.max("c_acctbal").alias("top")
    )


def _bodies(t):
    body = F.concat_ws(",", "event_id", "user_id", "event_type", F.col("value").cast("string"))
    return t.events.select(F.struct(body.alias("body")).alias("request"))


@query(
    "s4_capture_gzip",
    "SELECT event_id, user_id, event_type FROM events",
)
def _(t):
    path = new_path(t.spark, "capture")
    _bodies(t).write.option("compression", "gzip").json(path)
    parts = F.split("request.body", ",")
    return readers.read_capture(t.spark, path).select(
        F.get(parts, F.lit(0)).cast("bigint").alias("event_id"),
        F.get(parts, F.lit(1)).cast("bigint").alias("user_id"),
        F.get(parts, F.lit(2)).alias("event_type"),
    )


@query(
    "s5_log_metrics",
    """SELECT o_orderkey AS run, CASE WHEN o_orderkey % 4 = 0 THEN 'roc_auc' WHEN o_orderkey % 4 = 1 THEN 'f1_score' ELSE 'churner_recall' END AS metric,
              CAST('0.' || CAST(1000 + o_orderkey % 9000 AS VARCHAR) AS DOUBLE) AS value
       FROM orders WHERE o_orderkey % 4 <> 3""",
)
def _(t):
    number = F.concat(F.lit("0."), (1000 + F.col("o_orderkey") % 9000).cast("string"))
    kind = F.col("o_orderkey") % 4
    line = (
        F.when(kind == 0, F.concat(F.lit("step 9 Final ROC-AUC: "), number))
        .when(kind == 1, F.concat(F.lit("Final F1 @ target recall: "), number))
        .when(kind == 2, F.concat(F.lit("Churner recall:   "), number, F.lit(" (ok)")))
        .otherwise(F.concat(F.lit("loss: "), number))
    )
    return readers.log_metrics(t.orders.select(F.col("o_orderkey").alias("run"), line.alias("value_text")), LOG_PATTERNS, "value_text", ["run"])


@query("s6_newest_files", "SELECT COUNT(*) AS n, CAST(2 AS BIGINT) AS n_files FROM orders WHERE o_orderkey % 4 >= 2")
def _(t):
    path = new_path(t.spark, "files")
    kept = 0
    for part in range(4):  # oldest first; a part is as many files as its rows ask for
        bodies = t.orders.where(F.col("o_orderkey") % 4 == part).select(F.struct(F.col("o_orderkey").cast("string").alias("body")).alias("request"))
        bodies.write.mode("append").json(f"{path}/{part}")
        kept += t.spark.read.format("binaryFile").load(f"{path}/{part}").count() if part > 1 else 0
    newest = readers.newest_files(t.spark, path, kept).withColumn("part", F.regexp_extract("_file", "/([0-9])/[^/]*$", 1))
    return newest.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("part").alias("n_files"))


@query(
    "s7_partitioned_parquet",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
                         COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
            s AS (SELECT *, CASE WHEN rn <= FLOOR(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS split FROM r)
       SELECT split, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM s GROUP BY 1""",
)
def _(t):
    path = new_path(t.spark, "splits")
    writers.write_parquet(stratified_split(t.orders, "o_orderstatus", "o_orderkey"), path, ["split"])
    return readers.read_parquet(t.spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(
    "s8_membership",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
                         COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
       SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN rn <= FLOOR(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def _(t):
    path = new_path(t.spark, "membership")
    writers.write_membership(stratified_split(t.orders, "o_orderstatus", "o_orderkey"), path, "o_orderkey")
    return t.spark.read.schema("key string, split string").parquet(path)


@query(
    "s9_metric_table",
    "SELECT l_returnflag AS flag, COUNT(*) AS n, CAST(SUM(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY 1",
)
def _(t):
    path = new_path(t.spark, "metrics")
    table = t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_linenumber").cast("bigint")).alias("total")
    )
    writers.write_table(table, path, "json")
    return t.spark.read.schema("flag string, n bigint, total bigint").json(path)


@query(
    "s10_baseline_sample",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY md5('42|' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 500",
)
def _(t):
    path = new_path(t.spark, "baseline")
    writers.write_baseline_sample(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), path, 500, "c_custkey")
    return readers.read_csv(t.spark, path, t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").schema)


@query(
    "s11_schema_contract",
    """WITH c AS (SELECT c_acctbal, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS segment, 'clerk ' || CAST(c_custkey % 37 AS VARCHAR) AS clerk FROM customer)
       SELECT 'c_acctbal' AS "column", 'double' AS dtype, false AS nullable, ROUND(MIN(c_acctbal), 2) AS low, ROUND(MAX(c_acctbal), 2) AS high, CAST(NULL AS DOUBLE) AS n_categories, NULL AS every_value FROM c
       UNION ALL SELECT 'segment', 'string', true, NULL, NULL, CAST(COUNT(DISTINCT segment) AS DOUBLE), string_agg(DISTINCT segment, '|' ORDER BY segment) FROM c
       UNION ALL SELECT 'clerk', 'string', false, NULL, NULL, CAST(COUNT(DISTINCT clerk) AS DOUBLE), string_agg(DISTINCT clerk, '|' ORDER BY clerk) FROM c""",
)
def _(t):
    path = new_path(t.spark, "contract")
    segment = F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("segment")
    clerk = F.concat(F.lit("clerk "), (F.col("c_custkey") % 37).cast("string")).alias("clerk")
    writers.write_schema_contract(t.customer.select("c_acctbal", segment, clerk), path)
    columns, values = readers.read_schema_contract(t.spark, path)
    every = values.groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("every_value"))  # five and 37 values
    number = lambda c: F.round(F.col(c).cast("double"), 2)
    return columns.join(every, "column", "left").select(
        "column", "dtype", "nullable", number("min").alias("low"), number("max").alias("high"), F.col("n_categories").cast("double").alias("n_categories"), "every_value"
    )


@query(
    "u1_stack_frames",
    """SELECT o_orderkey AS key, o_totalprice AS price, NULL AS segment FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT c_custkey, CAST(NULL AS DOUBLE), c_mktsegment FROM customer""",
)
def _(t):
    a = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    b = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return stack([a, b])


@query("u2_value_subset", "SELECT DISTINCT l_linenumber AS value FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3)")
def _(t):
    return outside_domain(t.lineitem, "l_linenumber", [1, 2, 3]).select(F.col("l_linenumber").alias("value"))
