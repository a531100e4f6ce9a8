"""Feature engineering, encodings and the contract snapshot."""

from pyspark.sql import functions as F

from churnwright.operators import encoding as e
from churnwright.operators import snapshot as s
from churnwright.operators.drift import as_features
from churnwright.operators.profiling import top_categories
from churnwright.operators.splitting import split_report, time_split
from churnwright.plans.registry import ctes, query, rounded
from churnwright.session import stage
from churnwright.training.models import feature_stages

CONTRACTS = ctes("contracts")
DIRTY = ctes("dirty")
HORIZON = 365

HISTORY = (
    CONTRACTS
    + f""", h AS (SELECT *, "end" - "start" AS len, ROW_NUMBER() OVER w - 1 AS n, LAG("end") OVER w AS prev_end, LEAD("start") OVER w AS next_start,
                     MIN("start") OVER (PARTITION BY customer_id) AS first_start, (SELECT MAX("start") FROM contracts) AS seen
              FROM contracts WINDOW w AS (PARTITION BY customer_id ORDER BY "start", contract_id)),
         l AS (SELECT *, CASE WHEN next_start - "end" <= {HORIZON} THEN 0 WHEN "end" + {HORIZON} <= seen THEN 1 END AS churn FROM h)"""
)


def history(t):
    return s.contract_history(t.derive("contracts"), HORIZON)


@query(
    "flagship_churn_by_split",
    HISTORY
    + """, k AS (SELECT *, epoch_us(CAST("start" AS TIMESTAMP)) AS us FROM l WHERE churn IS NOT NULL),
           q AS (SELECT *, CASE WHEN us < (SELECT quantile_cont(CAST(us AS DOUBLE), 0.8) FROM k) THEN 'train' ELSE 'valid' END AS split FROM k)
         SELECT split, COUNT(*) AS n, CAST(MIN("start") AS VARCHAR) AS first, CAST(MAX("start") AS VARCHAR) AS last, ROUND(AVG(CAST(churn AS DOUBLE)), 6) AS target_rate,
                ROUND(COUNT(*) / (SELECT COUNT(*) FROM k), 6) AS share FROM q GROUP BY 1""",
)
def _(t):
    # the cutoff and the report read the history; only what they need of it is written
    known = stage(history(t).where("churn is not null").select("start", "churn"), "history")
    report = split_report(time_split(known, "start"), "start", "churn")
    return rounded(report.withColumns({c: F.col(c).cast("string") for c in ("first", "last")}))


@query(
    "f1_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ts_year, CAST(month(o_orderdate) AS INTEGER) AS ts_month,
              CAST(isodow(o_orderdate) - 1 AS INTEGER) AS ts_dow FROM orders""",
)
def _(t):
    return e.date_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("f2_product", "SELECT l_orderkey, l_quantity * l_extendedprice AS value, l_quantity, l_extendedprice, ROUND_EVEN(l_quantity * l_linenumber / 4, 0) AS rounded FROM lineitem")
def _(t):
    # quarters, so that a half is exact and goes to the even neighbour
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", (F.col("l_linenumber") / 4).alias("part"))
    both = e.product(e.product(lines, "l_quantity", "l_extendedprice", "value", None), "l_quantity", "part", "rounded", 0)
    return both.drop("part")


@query(
    "f3_ratio_bin_flag",
    """SELECT o_orderkey, ROUND(CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 5) END, 6) AS per_visit,
              CAST(CASE WHEN o_totalprice > 0 AND o_totalprice <= 100000 THEN 0 WHEN o_totalprice > 100000 AND o_totalprice <= 250000 THEN 1
                        WHEN o_totalprice > 250000 AND o_totalprice <= 1000000 THEN 2 ELSE -1 END AS INTEGER) AS band,
              CASE WHEN o_orderkey % 100 <= 30 THEN 1 ELSE 0 END AS recent FROM orders""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 5).alias("visits"), (F.col("o_orderkey") % 100).alias("days"))
    df = e.ratio_column(df, "o_totalprice", "visits", "per_visit")
    df = df.withColumn("band", F.coalesce(e.cut(F.col("o_totalprice"), [0.0, 1e5, 2.5e5, 1e6]), F.lit(-1)))
    return rounded(e.recent_flag(df, "days", 30, "recent").select("o_orderkey", "per_visit", "band", "recent"))


@query(
    "f4_frequency_encode",
    DIRTY
    + """, c AS (SELECT priority, COUNT(*) AS n FROM dirty WHERE priority IS NOT NULL GROUP BY 1)
         SELECT o_orderkey, d.priority, ROUND(c.n / (SELECT SUM(n) FROM c), 6) AS priority__freq FROM dirty d LEFT JOIN c ON d.priority = c.priority""",
)
def _(t):
    return rounded(e.frequency_encode(t.derive("dirty").select("o_orderkey", "priority"), ["priority"]))


@query(
    "f5_ordinal_encode",
    DIRTY
    + """, v AS (SELECT DISTINCT priority FROM dirty WHERE priority IS NOT NULL AND o_orderkey % 2 = 0 UNION SELECT DISTINCT priority FROM dirty WHERE priority IS NOT NULL AND o_orderkey % 3 = 0),
           k AS (SELECT priority, ROW_NUMBER() OVER (ORDER BY priority) - 1 AS code FROM v)
         SELECT o_orderkey, CAST(COALESCE(code, -1) AS INTEGER) AS code FROM dirty LEFT JOIN k USING (priority)""",
)
def _(t):
    df = t.derive("dirty").select("o_orderkey", "priority")
    codes = e.vocabulary([df.where("o_orderkey % 2 = 0"), df.where("o_orderkey % 3 = 0")], "priority")
    return e.ordinal_encode(df, "priority", codes, "code").drop("priority")


@query(
    "f6_one_hot",
    """WITH train AS (SELECT DISTINCT c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 AND c_mktsegment <> 'MACHINERY')
       SELECT c_custkey, c_acctbal, """
    + ", ".join(f"CAST(c_mktsegment = '{s}' AND c_mktsegment IN (FROM train) AS INTEGER) AS seg_{s}" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))
    + " FROM customer",
)
def _(t):
    # learned on the training side, which never has MACHINERY: its rows are zero in every column
    rows = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    values = e.one_hot_values(rows.where("c_custkey % 3 <> 0 and c_mktsegment <> 'MACHINERY'"), "c_mktsegment")
    return e.one_hot(rows, "c_mktsegment", values, "seg").drop("c_mktsegment")


@query(
    "f7_top_categories",
    """WITH m AS (SELECT 'p_type' AS "column", p_type AS category FROM part UNION ALL SELECT 'p_brand', p_brand FROM part),
            c AS (SELECT "column", category, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY COUNT(*) DESC, category) AS rn FROM m GROUP BY 1, 2)
       SELECT "column", CASE WHEN rn <= 3 THEN category ELSE '__other__ (>3)' END AS category, CAST(SUM(n) AS BIGINT) AS n FROM c GROUP BY 1, 2""",
)
def _(t):
    return top_categories(t.part, ["p_type", "p_brand"], 3).groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f8_unpivot",
    """SELECT l_returnflag AS target, 'l_quantity' AS feature, COUNT(*) AS n, MAX(l_quantity) AS top FROM lineitem GROUP BY 1
       UNION ALL SELECT l_returnflag, 'l_tax', COUNT(*), MAX(l_tax) FROM lineitem GROUP BY 1""",
)
def _(t):
    long = as_features(t.lineitem.withColumn("target", F.col("l_returnflag")), ["l_quantity", "l_tax"], ["target"])
    return long.groupBy("target", "feature").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


@query(
    "f9_quantile_bins",
    """WITH e AS (SELECT list_distinct(list_sort(quantile_cont(l_extendedprice, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]))) AS q FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
            c AS (SELECT list_sort(q) AS q FROM e), i AS (SELECT q[2:len(q)-1] AS inner_edges FROM c)
       SELECT CAST(len(list_filter(inner_edges, lambda x : l_extendedprice >= x)) AS INTEGER) AS bin, COUNT(*) AS n FROM lineitem, i WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def _(t):
    old = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    long = as_features(t.lineitem.where(old), ["l_extendedprice"])
    edges = e.quantile_edges(long, "value", 10, ["feature"]).select("inner").scalar()
    new = t.lineitem.where(~old).withColumn("_e", edges)
    return new.groupBy(e.bin_index(F.col("l_extendedprice"), F.col("_e")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f10_target_encode",
    DIRTY
    + """, m AS (SELECT priority, AVG(CAST(target AS DOUBLE)) AS m FROM dirty WHERE o_orderkey % 5 <> 0 AND priority IS NOT NULL GROUP BY 1)
         SELECT o_orderkey, ROUND(COALESCE(m, (SELECT AVG(CAST(target AS DOUBLE)) FROM dirty WHERE o_orderkey % 5 <> 0)), 6) AS encoded FROM dirty LEFT JOIN m USING (priority)""",
)
def _(t):
    df = t.derive("dirty").select("o_orderkey", "priority", "target")
    return rounded(e.target_encode(df, df.where("o_orderkey % 5 <> 0"), "priority", "target", "encoded").select("o_orderkey", "encoded"))


@query(
    "f10b_ordered_target_encode",
    DIRTY
    + """, d AS (SELECT *, md5('42|' || CAST(o_orderkey AS VARCHAR)) AS draw FROM dirty)
         SELECT o_orderkey, ROUND((COALESCE(SUM(CAST(target AS DOUBLE)) OVER w, 0) + 0.3 * 2) / (COUNT(target) OVER w + 2), 6) AS encoded FROM d
         WINDOW w AS (PARTITION BY priority ORDER BY draw, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def _(t):
    df = t.derive("dirty").select("o_orderkey", "priority", "target")
    return rounded(e.ordered_target_encode(df, "priority", "target", "o_orderkey", "encoded", prior=0.3, weight=2.0).select("o_orderkey", "encoded"))


@query(
    "f10c_target_statistics",
    DIRTY
    + """, s AS (SELECT priority, COALESCE(SUM(CAST(target AS DOUBLE)), 0) AS s, COUNT(target) AS n FROM dirty WHERE o_orderkey % 5 <> 0 AND coalesce(priority, '') <> '1-URGENT' GROUP BY 1)
         SELECT o_orderkey, ROUND((COALESCE(s, 0) + 0.3 * 2) / (COALESCE(n, 0) + 2), 6) AS encoded FROM dirty LEFT JOIN s ON dirty.priority IS NOT DISTINCT FROM s.priority WHERE o_orderkey % 5 = 0""",
)
def _(t):
    # the training side lacks one category
    df = t.derive("dirty").select("o_orderkey", "priority", "target")
    held = e.target_statistics(df.where("o_orderkey % 5 <> 0 AND coalesce(priority, '') <> '1-URGENT'"), "priority", "target")
    return rounded(e.apply_target_statistics(df.where("o_orderkey % 5 = 0"), held, "priority", "encoded", prior=0.3, weight=2.0).select("o_orderkey", "encoded"))


@query("f11_assemble", "SELECT c_custkey, CAST(3 AS INTEGER) AS n_features, c_acctbal AS first FROM customer")
def _(t):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    df = t.customer.withColumn("nation", F.col("c_nationkey").cast("double"))
    model = Pipeline(stages=feature_stages(["c_acctbal", "nation"], ["c_mktsegment"], False)).fit(df)
    v = vector_to_array("features")
    return model.transform(df).select("c_custkey", F.size(v).alias("n_features"), v[0].alias("first"))


@query("c1_contract_number", HISTORY + " SELECT contract_id, CAST(n AS BIGINT) AS contract_number, CAST(n AS BIGINT) AS n_prev_contracts FROM l")
def _(t):
    return history(t).select("contract_id", "contract_number", "n_prev_contracts")


@query("c2_gap_since_expiry", HISTORY + ' SELECT contract_id, CAST("start" - prev_end AS DOUBLE) AS gap FROM l')
def _(t):
    return history(t).select("contract_id", F.col("gap_since_prev_expiry").cast("double").alias("gap"))


@query(
    "c3_previous_lengths",
    HISTORY
    + """ SELECT contract_id, ROUND(AVG(CAST(len AS DOUBLE)) OVER b, 6) AS mean_len_prev, ROUND(STDDEV_SAMP(CAST(len AS DOUBLE)) OVER b, 6) AS std_len_prev
          FROM l WINDOW b AS (PARTITION BY customer_id ORDER BY "start", contract_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def _(t):
    return rounded(history(t).select("contract_id", "mean_len_prev", "std_len_prev"))


@query("c4_length_tenure", HISTORY + ' SELECT contract_id, CAST(len AS INTEGER) AS contract_len_days, CAST("end" - first_start AS INTEGER) AS tenure_days FROM l')
def _(t):
    return history(t).select("contract_id", "contract_len_days", "tenure_days")


@query(
    "c5_tenure_bucket",
    HISTORY
    + """ SELECT CASE WHEN "end" - first_start < 183 THEN '<6 mo' WHEN "end" - first_start <= 365 THEN '6–12 mo' ELSE '>1 yr' END AS tenure_bucket, COUNT(*) AS n FROM l GROUP BY 1""",
)
def _(t):
    return history(t).groupBy("tenure_bucket").agg(F.count(F.lit(1)).alias("n"))


@query("c6_expiry_parts", CONTRACTS + ' SELECT contract_id, CAST(month("end") AS INTEGER) AS expiry_month, CAST(isodow("end") - 1 AS INTEGER) AS expiry_dow FROM contracts')
def _(t):
    return history(t).select("contract_id", "expiry_month", "expiry_dow")


@query(
    "c7_past_churns",
    HISTORY
    + """ SELECT contract_id, CAST(COALESCE(SUM(COALESCE(churn, 0)) OVER (PARTITION BY customer_id ORDER BY "start", contract_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS past_churns FROM l""",
)
def _(t):
    return s.past_churns(history(t)).select("contract_id", "past_churns")


def _anchors(t):
    return t.events.where("event_type = 'signup'").select("event_id", "user_id", F.to_date("ts").alias("day"))


ANCHORS = """WITH a AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'signup'),
  v AS (SELECT user_id, CAST(ts AS DATE) AS day, value, event_type, CAST(json_extract(props, '$.k') AS INTEGER) % 4 AS channel FROM events)"""


@query(
    "c8_topup_lookback",
    ANCHORS
    + """, g AS (SELECT a.event_id, COUNT(v.day) AS n, SUM(v.value) AS s, AVG(v.value) AS m, STDDEV_SAMP(v.value) AS sd, MIN(a.day - v.day) AS since
             FROM a LEFT JOIN v ON v.user_id = a.user_id AND v.event_type = 'purchase' AND v.day >= a.day - 7 AND v.day < a.day GROUP BY 1)
         SELECT event_id, n AS topup_count, ROUND(COALESCE(s, 0.0), 6) AS topup_total, ROUND(m, 6) AS topup_avg, ROUND(sd, 6) AS topup_std,
                ROUND(CASE WHEN n > 1 THEN sd / m END, 6) AS topup_cv, CAST(since AS DOUBLE) AS topup_days_since_last FROM g""",
)
def _(t):
    out = s.lookback(_anchors(t), t.events.where("event_type = 'purchase'"), who="user_id", anchor_day="day", ts="ts", days=7, value="value", prefix="topup")
    cols = ["topup_count", "topup_total", "topup_avg", "topup_std", "topup_cv"]
    return rounded(out.select("event_id", *cols, F.col("topup_days_since_last").cast("double").alias("topup_days_since_last")))


@query(
    "c8b_topup_distinct",
    ANCHORS
    + """ SELECT a.event_id, COUNT(DISTINCT v.event_type) AS n_types, COUNT(DISTINCT v.channel) AS n_channels
          FROM a LEFT JOIN v ON v.user_id = a.user_id AND v.day >= a.day - 7 AND v.day < a.day GROUP BY 1""",
)
def _(t):
    ev = t.events.withColumn("channel", F.get_json_object("props", "$.k").cast("int") % 4)
    spec = dict(who="user_id", anchor_day="day", ts="ts", days=7)
    out = s.lookback_distinct(_anchors(t), ev, what="event_type", out="n_types", **spec)
    out = s.lookback_distinct(out, ev, what="channel", out="n_channels", **spec)
    return out.select("event_id", "n_types", "n_channels")


@query(
    "c9_contact_lookback",
    ANCHORS
    + """, g AS (SELECT a.event_id, COUNT(v.day) AS n, COUNT(*) FILTER (v.value > 50) AS ok, MIN(a.day - v.day) AS since
             FROM a LEFT JOIN v ON v.user_id = a.user_id AND v.event_type = 'click' AND v.day >= a.day - 7 AND v.day < a.day GROUP BY 1)
         SELECT event_id, n AS contact_count, ok AS contact_hits, CAST(ok > 0 AS INTEGER) AS contact_any, CAST(n > 0 AS INTEGER) AS contact_was_seen,
                CAST(since AS DOUBLE) AS contact_days_since_last FROM g""",
)
def _(t):
    clicks = t.events.where("event_type = 'click'")
    out = s.lookback(_anchors(t), clicks, who="user_id", anchor_day="day", ts="ts", days=7, flag=F.col("value") > 50, prefix="contact")
    return out.select("event_id", "contact_count", "contact_hits", "contact_any", "contact_was_seen", F.col("contact_days_since_last").cast("double").alias("contact_days_since_last"))


@query(
    "c10_as_of_attributes",
    """WITH h AS (SELECT user_id, ts AS valid_from, MAX(value) AS v, MAX(ts) AS f FROM events WHERE event_type = 'view' GROUP BY 1, 2),
            a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup')
       SELECT a.event_id, h.v AS last_view, CASE WHEN h.v IS NULL THEN 1 ELSE 0 END AS view_missing, CAST(CAST(a.ts AS DATE) - CAST(h.valid_from AS DATE) AS DOUBLE) AS view_age_days
       FROM a ASOF LEFT JOIN h ON a.user_id = h.user_id AND a.ts >= h.valid_from""",
)
def _(t):
    views = t.events.where("event_type = 'view'").withColumn("seen_at", F.col("ts"))
    rows = t.events.where("event_type = 'signup'").select("event_id", "user_id", "ts")
    out = s.as_of(rows, views, who="user_id", at="ts", valid_from="ts", key="event_id", take={"last_view": "value", "seen_at": "seen_at"})
    return out.select(
        "event_id", "last_view", F.col("last_view").isNull().cast("int").alias("view_missing"), F.datediff("ts", "seen_at").cast("double").alias("view_age_days")
    )


@query(
    "c10b_as_of_with_nulls",
    """WITH e AS (SELECT event_id, value, event_type, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts FROM events),
            h AS (SELECT user_id, ts AS valid_from, MAX(value) AS v FROM e WHERE event_type = 'view' AND user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
            a AS (SELECT event_id, user_id, ts FROM e WHERE event_type = 'signup')
       SELECT a.event_id, h.v AS last_view FROM (SELECT * FROM a WHERE user_id IS NOT NULL AND ts IS NOT NULL) a ASOF LEFT JOIN h ON a.user_id = h.user_id AND a.ts >= h.valid_from
       UNION ALL SELECT event_id, NULL FROM a WHERE user_id IS NULL OR ts IS NULL""",
)
def _(t):
    # an eleventh of the events without a customer, a seventh without a time
    ev = t.events.withColumns({"user_id": F.when(F.col("event_id") % 11 != 0, F.col("user_id")), "ts": F.when(F.col("event_id") % 7 != 0, F.col("ts"))})
    rows = ev.where("event_type = 'signup'").select("event_id", "user_id", "ts")
    views = ev.where("event_type = 'view'")
    return s.as_of(rows, views, who="user_id", at="ts", valid_from="ts", key="event_id", take={"last_view": "value"}).select("event_id", "last_view")


@query(
    "c8c_lookback_with_nulls",
    """WITH e AS (SELECT event_id, value, event_type, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, CAST(ts AS DATE) AS day FROM events),
            a AS (SELECT * FROM e WHERE event_type = 'signup')
       SELECT a.event_id, COUNT(v.day) AS topup_count, ROUND(COALESCE(SUM(v.value), 0.0), 6) AS topup_total, CAST(COUNT(v.day) > 0 AS INTEGER) AS topup_was_seen, COUNT(DISTINCT v.value) AS n_values
       FROM a LEFT JOIN e v ON v.user_id = a.user_id AND v.event_type = 'purchase' AND v.day >= a.day - 7 AND v.day < a.day GROUP BY 1""",
)
def _(t):
    ev = t.events.withColumns({"user_id": F.when(F.col("event_id") % 11 != 0, F.col("user_id")), "day": F.to_date("ts")})
    anchors, buys = ev.where("event_type = 'signup'").select("event_id", "user_id", "day"), ev.where("event_type = 'purchase'")
    out = s.lookback(anchors, buys, who="user_id", anchor_day="day", ts="ts", days=7, value="value", prefix="topup")
    out = s.lookback_distinct(out, buys, who="user_id", anchor_day="day", ts="ts", what="value", days=7, out="n_values")
    return rounded(out.select("event_id", "topup_count", "topup_total", "topup_was_seen", "n_values"))


@query("c11_churn_label", HISTORY + " SELECT contract_id, CAST(churn AS DOUBLE) AS churn FROM l")
def _(t):
    return history(t).select("contract_id", F.col("churn").cast("double").alias("churn"))


@query(
    "c12_used_selfcare",
    ANCHORS + " SELECT event_id, CAST(EXISTS (SELECT 1 FROM v WHERE v.user_id = a.user_id AND v.event_type = 'error' AND v.day >= a.day - 7 AND v.day < a.day) AS INTEGER) AS used_selfcare FROM a",
)
def _(t):
    used = s.used_before(_anchors(t), t.events.where("event_type = 'error'"), who="user_id", anchor_day="day", ts="ts", days=7, out="used_selfcare")
    return used.select("event_id", "used_selfcare")
