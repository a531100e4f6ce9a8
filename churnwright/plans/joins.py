"""Lookups, truth joins, split re-use and set checks (J1-J7), and the ordered scan itself."""

from pyspark.sql import functions as F

from churnwright.operators import lookups as j
from churnwright.operators.ordered import ordered_scan
from churnwright.operators.splitting import stratified_split, time_split
from churnwright.plans.registry import query, rounded

STRATIFIED = """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
                          COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
  s AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN rn <= FLOOR(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS split FROM r)"""


@query("j1_map_values", "SELECT c_custkey, COALESCE(n_name, 'none') AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20")
def _(t):
    out = j.map_values(t.customer, "c_nationkey", t.nation.where("n_nationkey < 20"), "n_nationkey", "n_name", "nation", "none")
    return out.select("c_custkey", "nation")


@query(
    "j1b_salted_lookup",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, p_brand FROM (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_partkey END AS k FROM lineitem) LEFT JOIN part ON k = p_partkey""",
)
def _(t):
    # a third of all lines share one part key
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", F.when(F.col("l_partkey") % 3 == 0, 0).otherwise(F.col("l_partkey")).alias("p_partkey"))
    return j.lookup(facts, t.part.select("p_partkey", "p_brand"), ["p_partkey"], hot_keys=64, small_bytes=0).drop("p_partkey")


@query("j2_with_truth", "SELECT doc_id, quality, CAST(n_chars % 101 AS DOUBLE) / 101 AS score, lang FROM documents JOIN labels USING (doc_id)")
def _(t):
    pred = t.documents.select("doc_id", ((F.col("n_chars") % 101).cast("double") / 101).alias("score"), "lang")
    return j.with_truth(pred, t.labels.select("doc_id", "quality"), "doc_id")


@query(
    "j3_aligned_features",
    """WITH b AS (SELECT 'l_quantity' AS feature, AVG(l_quantity) AS m FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' UNION ALL SELECT 'l_tax', AVG(l_tax) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
            c AS (SELECT 'l_quantity' AS feature, AVG(l_quantity) AS m FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' UNION ALL SELECT 'l_discount', AVG(l_discount) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')
       SELECT feature, ROUND(b.m, 6) AS base_mean, ROUND(c.m, 6) AS current_mean FROM b JOIN c USING (feature)""",
)
def _(t):
    from churnwright.operators.drift import as_features

    old = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    base = as_features(t.lineitem.where(old), ["l_quantity", "l_tax"]).groupBy("feature").agg(F.avg("value").alias("base_mean"))
    cur = as_features(t.lineitem.where(~old), ["l_quantity", "l_discount"]).groupBy("feature").agg(F.avg("value").alias("current_mean"))
    return rounded(base.join(cur, "feature"))


@query("j4_apply_split", STRATIFIED + " SELECT o_orderkey, o_totalprice FROM s WHERE split = 'test'")
def _(t):
    members = stratified_split(t.orders, "o_orderstatus", "o_orderkey").select("o_orderkey", "split")
    return j.apply_split(t.orders.select("o_orderkey", "o_totalprice"), members, "o_orderkey", "test")


@query(
    "j5_split_overlap",
    """WITH c AS (SELECT quantile_cont(CAST(epoch_us(o_orderdate) AS DOUBLE), 0.8) AS q FROM orders),
            s AS (SELECT o_orderkey, CAST(epoch_us(o_orderdate) AS DOUBLE) < q AS train FROM orders, c),
            leaky AS (SELECT o_orderkey FROM s WHERE NOT train OR o_orderkey % 20 = 0)
       SELECT o_orderkey FROM s WHERE train AND o_orderkey IN (SELECT o_orderkey FROM leaky)""",
)
def _(t):
    # every twentieth key of the training side also sits in the validation side
    split = time_split(t.orders, "o_orderdate")
    return j.overlap(split.where("split = 'train'"), split.where("split = 'valid' or o_orderkey % 20 = 0"), "o_orderkey").select("o_orderkey")


@query("j6_keys_lost", STRATIFIED + " SELECT o_orderkey FROM s WHERE split = 'train' AND o_orderkey % 10 = 0")
def _(t):
    # a split that lost every tenth training key
    split = stratified_split(t.orders, "o_orderstatus", "o_orderkey")
    return j.lost(t.orders, split.where("split = 'test' or o_orderkey % 10 <> 0"), "o_orderkey").select("o_orderkey")


@query(
    "j7_candidate_champion",
    """WITH c AS (SELECT o_custkey % 50 AS grp, MAX(o_totalprice) AS m FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
            h AS (SELECT o_custkey % 50 AS grp, MAX(o_totalprice) AS m FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 50 < 40 GROUP BY 1)
       SELECT grp, c.m AS candidate, h.m AS champion FROM c LEFT JOIN h USING (grp)""",
)
def _(t):
    g = (F.col("o_custkey") % 50).alias("grp")
    cand = t.orders.where("o_orderstatus = 'O'").groupBy(g).agg(F.max("o_totalprice").alias("candidate"))
    champ = t.orders.where("o_orderstatus = 'F' and o_custkey % 50 < 40").groupBy(g).agg(F.max("o_totalprice").alias("champion"))
    return j.lookup(cand, champ, ["grp"])


@query(
    "x1_ordered_scan",
    """SELECT o_orderkey, ROW_NUMBER() OVER w AS pos, CAST(SUM(o_custkey) OVER w AS BIGINT) AS upto, MAX(o_totalprice) OVER w AS peak,
              COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
)
def _(t):
    # three groups, each a third of the table, cut into chunks whatever the size
    out = ordered_scan(
        t.orders, ["o_orderdate", "o_orderkey"], ["o_orderstatus"],
        position="pos", through={"upto": "o_custkey"}, peak={"peak": "o_totalprice"}, totals={"n": F.lit(1).cast("bigint")}, chunks=24,
    )
    return out.select("o_orderkey", "pos", "upto", "peak", "n")
