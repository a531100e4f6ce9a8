"""Capture, drift, violations, alerts, fairness and attribution."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.operators import drift as d
from churnwright.operators import monitoring as mo
from churnwright.operators import scoring as sc
from churnwright.operators.checks import in_range, run_checks
from churnwright.operators.cleaning import label_at
from churnwright.operators.profiling import null_profile
from churnwright.plans.metrics import curve_sql
from churnwright.plans.registry import ctes, query, rounded
from churnwright.session import stage

SCORED = ctes("scored")
SPLIT_DAY = "1998-01-01"
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("m1_capture_percent", "SELECT event_id, user_id FROM events WHERE substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8) < '33333333'")
def _(t):
    return mo.capture(t.events.select("event_id", "user_id"), 20, "event_id")


@query(
    "m2_csv_body",
    "SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS who, event_type AS kind FROM events WHERE event_id % 10 > 1",
)
def _(t):
    # a tenth of the bodies has no comma, another tenth runs over two lines; the last field has no header
    csv = F.concat_ws(",", "event_id", "user_id", "event_type", F.lit("extra"))
    body = F.when(F.col("event_id") % 10 == 0, F.col("event_type")).when(F.col("event_id") % 10 == 1, F.concat(csv, F.lit("\n"), csv)).otherwise(csv)
    return mo.parse_csv_body(t.events.select(body.alias("body")), "body", ["id", "who", "kind"])


JSON_RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user", T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType())])),
    ]
)


@query(
    "m3_json_body",
    """SELECT event_id AS id, user_id AS user_id, event_type AS user_kind FROM events
       UNION ALL SELECT event_id + 1000000000, user_id, 'again' FROM events WHERE event_id % 3 = 0""",
)
def _(t):
    one = lambda key, kind: F.struct(key.alias("id"), F.struct(F.col("user_id").alias("id"), kind.alias("kind")).alias("user"))
    first = one(F.col("event_id"), F.col("event_type"))
    both = F.array(first, one(F.col("event_id") + 1_000_000_000, F.lit("again")))
    body = F.when(F.col("event_id") % 3 == 0, F.to_json(both)).otherwise(F.to_json(first))
    flat = mo.parse_json_body(t.events.select(body.alias("body")), "body", JSON_RECORD)
    return flat.withColumnsRenamed({"user.id": "user_id", "user.kind": "user_kind"})


@query(
    "m3d_unknown_bodies",
    """SELECT event_id AS event_id, event_id AS id, CASE WHEN event_id % 3 = 1 THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS user_kind,
              CASE WHEN event_id % 3 = 1 THEN CAST(event_id % 7 AS DOUBLE) / 2 END AS amount, CASE WHEN event_id % 3 = 2 THEN 'true' END AS flag_by_hand, CAST(NULL AS VARCHAR) AS note FROM events
       UNION ALL SELECT event_id, event_id + 1000000000, CAST(user_id AS VARCHAR), 'again', NULL, NULL, NULL FROM events WHERE event_id % 3 = 0""",
)
def _(t):
    # objects of three shapes, some in lists, one of whose keys is a number here and text there; nothing says so beforehand
    user = lambda kind: F.struct(F.col("user_id").alias("id"), kind.alias("kind"))
    first = F.struct(F.col("event_id").alias("id"), user(F.col("event_type")).alias("user"))
    listed = F.to_json(F.array(first, F.struct((F.col("event_id") + 1_000_000_000).alias("id"), user(F.lit("again")).alias("user"))))
    priced = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.concat(F.lit("u"), "user_id").alias("id")).alias("user"), ((F.col("event_id") % 7).cast("double") / 2).alias("amount")))
    flagged = F.concat(F.lit('{"id": '), "event_id", F.lit(', "user": {"id": '), "user_id", F.lit('}, "flag": {"by hand": true}, "note": null}'))
    part = F.col("event_id") % 3
    bodies = t.events.select("event_id", F.when(part == 0, listed).when(part == 1, priced).otherwise(flagged).alias("body"))
    flat = mo.parse_any_json(bodies, "body", ["event_id"])
    named = {"user.id": "user_id", "user.kind": "user_kind", "flag.by hand": "flag_by_hand"}
    return flat.withColumnsRenamed(named).withColumns({"amount": F.col("amount").cast("double"), "flag_by_hand": F.col("flag_by_hand").cast("string")})


@query("m3b_event_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    return mo.parse_json_body(t.events.select("event_id", "props"), "props", T.StructType([T.StructField("k", T.LongType())]), ["event_id"])


@query(
    "m3c_rejected_bodies",
    """SELECT CASE event_id % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no object' ELSE 'no body' END AS reason, COUNT(*) AS n FROM events WHERE event_id % 5 < 3 GROUP BY 1
       UNION ALL SELECT 'parsed', COUNT(*) FROM events WHERE event_id % 5 > 2""",
)
def _(t):
    part = F.col("event_id") % 5
    body = F.when(part == 0, F.concat(F.lit("{"), F.col("event_type"))).when(part == 1, F.col("event_id").cast("string")).when(part > 2, F.col("props"))
    rows = t.events.select(body.alias("body"))
    parsed = mo.parse_json_body(rows, "body", T.StructType([T.StructField("k", T.LongType())]))
    return mo.rejects(rows, mo.json_fault("body")).unionByName(parsed.groupBy().agg(F.lit("parsed").alias("reason"), F.count(F.lit(1)).alias("n")))


@query("m2b_csv_headers", "SELECT CAST(event_id AS VARCHAR) AS user_id, event_type AS kind FROM events")
def _(t):
    # header names with blanks, colons and commas
    rows = t.events.select(F.concat_ws(",", "event_id", "event_type").alias("body"))
    return mo.parse_csv_body(rows, "body", ["user id", "kind:a, b"]).withColumnsRenamed({"user id": "user_id", "kind:a, b": "kind"})


def _limit_row(c: str, numeric: bool) -> str:
    lo, hi = (f"CAST(MIN({c}) AS DOUBLE)", f"CAST(MAX({c}) AS DOUBLE)") if numeric else ("NULL", "NULL")
    cats = "NULL" if numeric else f"(SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT {c} AS x FROM dirty WHERE {c} IS NOT NULL AND o_orderkey % 2 = 0))"
    return f"""SELECT '{c}' AS "column", '{'numeric' if numeric else 'category'}' AS kind, ROUND(COUNT({c}) / COUNT(*), 6) AS completeness, {lo} AS low, {hi} AS high,
               COUNT(DISTINCT {c}) AS n_distinct, {cats} AS categories FROM dirty WHERE o_orderkey % 2 = 0"""


DIRTY = ctes("dirty")


@query("m4_baseline_limits", f"{DIRTY} {_limit_row('price', True)} UNION ALL {_limit_row('visits', True)} UNION ALL {_limit_row('priority', False)} UNION ALL {_limit_row('status', False)}")
def _(t):
    base = t.derive("dirty").where("o_orderkey % 2 = 0")
    out = mo.baseline_limits(base, ["price", "visits"], ["priority", "status"])
    out = out.withColumnsRenamed({"min": "low", "max": "high"}).withColumn("categories", F.array_join("example_values", "|"))
    return rounded(out.select("column", "kind", "completeness", "low", "high", "n_distinct", "categories"))


UNKNOWN = "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END"


@query(
    "m5b_nan_is_missing",
    """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 4 = 1 THEN NULL ELSE o_totalprice END AS price FROM orders), b AS (SELECT MIN(price) AS lo, MAX(price) AS hi, COUNT(price) / COUNT(*) AS cp FROM d WHERE o_orderkey % 2 = 0),
            c AS (SELECT * FROM d WHERE o_orderkey % 2 = 1)
       SELECT * FROM (SELECT 'price' AS "column", 'range' AS rule, COUNT(*) FILTER (price < lo OR price > hi) AS n FROM c, b
         UNION ALL SELECT 'price', 'completeness', CASE WHEN MAX(cp) > COUNT(price) / COUNT(*) THEN COUNT(*) FILTER (price IS NULL) ELSE 0 END FROM c, b
         UNION ALL SELECT 'price', 'profile', COUNT(*) FILTER (price IS NULL) FROM d UNION ALL SELECT 'price', 'check', COUNT(*) FILTER (price < 0 OR price > 100000) FROM d) WHERE n > 0""",
)
def _(t):
    # NaN prices count as missing in the limits, the null profile and the range check
    df = t.orders.selectExpr("o_orderkey", f"{UNKNOWN} AS price")
    breached = mo.violations(df.where("o_orderkey % 2 = 1"), df.where("o_orderkey % 2 = 0"), ["price"], [])
    nulls = null_profile(df, ["price"]).select("column", F.lit("profile").alias("rule"), F.col("n_null").alias("n"))
    checked = run_checks(df, [in_range("price", 0, 100000)]).select(F.lit("price").alias("column"), F.lit("check").alias("rule"), F.col("observed").cast("long").alias("n"))
    return breached.unionByName(nulls).unionByName(checked).where("n > 0")


@query(
    "m5_violations",
    DIRTY
    + """, b AS (SELECT MIN(price) AS lo, MAX(price) AS hi, COUNT(price) / COUNT(*) AS cp, COUNT(priority) / COUNT(*) AS cq FROM dirty WHERE o_orderkey % 2 = 0),
           k AS (SELECT DISTINCT status FROM dirty WHERE o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0), c AS (SELECT * FROM dirty WHERE o_orderkey % 2 = 1)
         SELECT * FROM (SELECT 'price' AS "column", 'range' AS rule, COUNT(*) FILTER (price < lo OR price > hi) AS n FROM c, b
           UNION ALL SELECT 'price', 'completeness', CASE WHEN MAX(cp) > COUNT(price) / COUNT(*) THEN COUNT(*) FILTER (price IS NULL) ELSE 0 END FROM c, b
           UNION ALL SELECT 'status', 'category', COUNT(*) FILTER (status NOT IN (SELECT status FROM k)) FROM c) WHERE n > 0""",
)
def _(t):
    df = t.derive("dirty")
    base = df.where("o_orderkey % 2 = 0").withColumn("status", F.when(F.col("o_orderkey") % 5 != 0, F.col("status")))
    base = base.withColumn("status", F.coalesce("status", F.lit("F")))
    return mo.violations(df.where("o_orderkey % 2 = 1"), base, ["price"], ["status"])


@query(
    "m5b_violations_wide",
    """WITH k AS (SELECT DISTINCT o_custkey % 97 AS clerk FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 97 < 80)
       SELECT 'clerk' AS "column", 'category' AS rule, COUNT(*) AS n FROM orders WHERE o_orderkey % 2 = 1 AND o_custkey % 97 NOT IN (SELECT clerk FROM k)""",
)
def _(t):
    # up to 80 values in the baseline, and 17 that it never has
    df = t.orders.select("o_orderkey", (F.col("o_custkey") % 97).cast("string").alias("clerk"))
    base = df.where("o_orderkey % 2 = 0 and cast(clerk as int) < 80")
    return mo.violations(df.where("o_orderkey % 2 = 1"), base, [], ["clerk"])


def _sides(t):
    old = F.col("l_shipdate") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    # the current side is shifted so that there is drift to find
    cur = t.lineitem.where(~old).withColumns({"l_quantity": F.col("l_quantity") + F.floor(F.col("l_partkey") % 7), "l_discount": F.col("l_discount") * 2})
    base = t.lineitem.where(old)
    cols = d.shared_features(base, cur, FEATURES)
    return d.as_features(base, cols), d.as_features(cur, cols)


DRIFT = f"""WITH base AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT_DAY}') ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value),
  cur AS (UNPIVOT (SELECT l_quantity + l_partkey % 7 AS l_quantity, l_extendedprice, l_discount * 2 AS l_discount, l_tax FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SPLIT_DAY}') ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value),
  q AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS cuts FROM base GROUP BY 1),
  i AS (SELECT feature, cuts[2:len(cuts) - 1] AS edges FROM q),
  e AS (SELECT feature, len(list_filter(edges, lambda x : value >= x)) AS bin, COUNT(*) AS e FROM base JOIN i USING (feature) GROUP BY 1, 2),
  a AS (SELECT feature, len(list_filter(edges, lambda x : value >= x)) AS bin, COUNT(*) AS a FROM cur JOIN i USING (feature) GROUP BY 1, 2),
  p AS (SELECT feature, bin, GREATEST(COALESCE(e, 0) / SUM(COALESCE(e, 0)) OVER (PARTITION BY feature), 1e-6) AS pe, GREATEST(COALESCE(a, 0) / SUM(COALESCE(a, 0)) OVER (PARTITION BY feature), 1e-6) AS pa
        FROM e FULL JOIN a USING (feature, bin)),
  psi AS (SELECT feature, SUM((pa - pe) * LN(pa / pe)) AS psi FROM p GROUP BY 1),
  v AS (SELECT feature, value, SUM(e) AS e, SUM(a) AS a FROM (SELECT feature, value, 1 AS e, 0 AS a FROM base UNION ALL SELECT feature, value, 0, 1 FROM cur) GROUP BY 1, 2),
  ks AS (SELECT feature, MAX(gap) AS ks FROM (SELECT feature, ABS(CAST(SUM(e) OVER w AS DOUBLE) / SUM(e) OVER (PARTITION BY feature) - CAST(SUM(a) OVER w AS DOUBLE) / SUM(a) OVER (PARTITION BY feature)) AS gap
         FROM v WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY 1)"""


@query("m6_psi", DRIFT + " SELECT feature, ROUND(psi, 6) AS psi FROM psi")
def _(t):
    base, cur = _sides(t)
    return rounded(d.psi(base, cur, d.psi_edges(base)))


@query("m7_ks", DRIFT + " SELECT feature, ROUND(ks, 6) AS ks FROM ks")
def _(t):
    return rounded(d.ks(*_sides(t)))


@query("m8_drift_table", DRIFT + " SELECT feature, ROUND(psi, 6) AS psi, ROUND(ks, 6) AS ks FROM psi JOIN ks USING (feature)")
def _(t):
    return rounded(d.drift_table(*_sides(t)))


@query(
    "m8b_drift_missing_feature",
    DRIFT + """ SELECT feature, ROUND(psi, 6) AS psi, ROUND(ks, 6) AS ks, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.25 THEN 'moderate' ELSE 'significant' END AS severity FROM psi JOIN ks USING (feature) WHERE feature <> 'l_tax'
        UNION ALL SELECT 'l_tax', NULL, NULL, 'missing'""",
)
def _(t):
    # the current side has lost l_tax
    base, cur = _sides(t)
    return rounded(d.with_severity(d.drift_table(base, cur.where("feature <> 'l_tax'"))).select("feature", "psi", "ks", "severity"))


SEVERITY = "CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.25 THEN 'moderate' ELSE 'significant' END"


@query("m9_severity", DRIFT + f" SELECT feature, {SEVERITY} AS severity, ks > 0.1 AS ks_drift FROM psi JOIN ks USING (feature)")
def _(t):
    return d.with_severity(d.drift_table(*_sides(t))).select("feature", "severity", "ks_drift")


@query(
    "m10_alerts",
    DRIFT
    + f""" SELECT 'drift' AS kind, feature AS subject, {SEVERITY} AS detail, true AS retrain FROM psi JOIN ks USING (feature) WHERE psi > 0.25
           UNION ALL SELECT 'drift', 'lost', 'missing', true
           UNION ALL SELECT 'quality', CAST(l_linestatus AS VARCHAR), 'discounted ' || CAST(COUNT(*) FILTER (l_discount > 0.05) AS VARCHAR), true FROM lineitem GROUP BY l_linestatus HAVING COUNT(*) FILTER (l_discount > 0.05) > 0""",
)
def _(t):
    drift = d.with_severity(d.drift_table(*_sides(t), features=["lost"]))
    quality = t.lineitem.groupBy("l_linestatus").agg(F.count_if(F.col("l_discount") > 0.05).alias("n"))
    return mo.alerts(drift, F.col("severity").isin("significant", "missing"), "drift", "feature", F.col("severity")).unionByName(
        mo.alerts(quality, F.col("n") > 0, "quality", "l_linestatus", F.concat(F.lit("discounted "), F.col("n").cast("string")))
    )


@query(
    "m11_drift_by_day",
    """WITH base AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-11'), cur AS (SELECT strftime(ts, '%Y-%m-%d') AS day, value * (1 + day(ts) / 40) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-11'),
       q AS (SELECT list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS cuts FROM base), i AS (SELECT cuts[2:len(cuts) - 1] AS edges FROM q),
       e AS (SELECT len(list_filter(edges, lambda x : value >= x)) AS bin, COUNT(*) AS e FROM base, i GROUP BY 1),
       a AS (SELECT day, len(list_filter(edges, lambda x : value >= x)) AS bin, COUNT(*) AS a FROM cur, i GROUP BY 1, 2), days AS (SELECT DISTINCT day FROM cur), bins AS (SELECT bin FROM e UNION SELECT bin FROM a),
       p AS (SELECT day, GREATEST(COALESCE(e, 0) / (SELECT SUM(e) FROM e), 1e-6) AS pe, GREATEST(COALESCE(a, 0) / SUM(COALESCE(a, 0)) OVER (PARTITION BY day), 1e-6) AS pa
             FROM days CROSS JOIN bins LEFT JOIN e USING (bin) LEFT JOIN a USING (day, bin)),
       psi AS (SELECT day, SUM((pa - pe) * LN(pa / pe)) AS psi FROM p GROUP BY 1),
       v AS (SELECT day, value, SUM(e) AS e, SUM(a) AS a FROM (SELECT day, value, 1 AS e, 0 AS a FROM base CROSS JOIN days UNION ALL SELECT day, value, 0, 1 FROM cur) GROUP BY 1, 2),
       ks AS (SELECT day, MAX(gap) AS ks FROM (SELECT day, ABS(CAST(SUM(e) OVER w AS DOUBLE) / SUM(e) OVER (PARTITION BY day) - CAST(SUM(a) OVER w AS DOUBLE) / SUM(a) OVER (PARTITION BY day)) AS gap
              FROM v WINDOW w AS (PARTITION BY day ORDER BY value)) GROUP BY 1)
       SELECT day, 'value' AS feature, ROUND(psi, 6) AS psi, ROUND(ks, 6) AS ks FROM psi JOIN ks USING (day)""",
)
def _(t):
    early = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    cur = t.events.where(~early).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("value") * (1 + F.dayofmonth("ts") / 40)).alias("value"))
    return rounded(d.drift_table(d.as_features(t.events.where(early), ["value"]), d.as_features(cur, ["value"], ["day"]), ["day"]))


@query(
    "m11b_days_without_values",
    """WITH cur AS (SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN day(ts) % 3 = 0 THEN NULL ELSE value END AS value FROM events WHERE ts >= TIMESTAMP '2024-01-11')
       SELECT day, 'value' AS feature, COUNT(value) = 0 AS missing FROM cur GROUP BY day""",
)
def _(t):
    # every third day has no value at all
    early = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    cur = t.events.where(~early).select(day, F.when(F.dayofmonth("ts") % 3 != 0, F.col("value")).alias("value"))
    base = d.as_features(t.events.where(early), ["value"])
    found = d.drift_table(base, d.as_features(cur, ["value"], ["day"]), ["day"], features=["value"], windows=cur.select("day").distinct())
    return d.with_severity(found).select("day", "feature", (F.col("severity") == "missing").alias("missing"))


@query(
    "m12_quality_over_time",
    f"""{SCORED}, u AS (SELECT strftime(date_trunc('month', shipped), '%Y-%m') AS month, label, score FROM scored), {curve_sql('u', ('month',))}
        SELECT month, CAST(rank.n_pos AS BIGINT) AS n_pos, ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc, ROUND(threshold, 6) AS threshold, ROUND(CAST(tp AS DOUBLE) / hit.n_pos, 6) AS recall FROM rank JOIN hit USING (month)""",
)
def _(t):
    df = t.derive("scored").withColumn("month", F.date_format("shipped", "yyyy-MM"))
    full = sc.evaluate(sc.threshold_curve(df, by=["month"]), 0.8, ["month"])
    return rounded(full.select("month", "n_pos", "roc_auc", "pr_auc", "threshold", "recall"))


@query(
    "m13_fairness",
    SCORED
    + """, u AS (SELECT 'segment' AS facet, segment AS value, label, score >= 0.5 AS hit FROM scored UNION ALL SELECT 'quarter', CAST(quarter AS VARCHAR), label, score >= 0.5 FROM scored),
           r AS (SELECT facet, value, AVG(CAST(hit AS DOUBLE)) AS rate, AVG(CAST(hit AS DOUBLE)) FILTER (label = 1) AS recall FROM u GROUP BY 1, 2)
         SELECT facet, COUNT(*) AS n_values, ROUND(MAX(rate) - MIN(rate), 6) AS parity_gap, ROUND(MAX(recall) - MIN(recall), 6) AS opportunity_gap FROM r GROUP BY 1""",
)
def _(t):
    return rounded(mo.fairness(label_at(t.derive("scored"), "score", 0.5), ["segment", "quarter"], "label", "predicted"))


WEIGHTS = {"l_quantity": 0.5, "l_discount": -30.0, "l_tax": 80.0}


@query(
    "m14_attribution_drift",
    f"""WITH b AS (SELECT AVG(l_quantity) AS mq, AVG(l_discount) AS md, AVG(l_tax) AS mt FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT_DAY}'),
        r AS (SELECT year(l_shipdate) AS y, l_shipdate < TIMESTAMP '{SPLIT_DAY}' AS old, ABS((l_quantity - mq) * 0.5) AS q, ABS((l_discount * CASE WHEN l_shipdate < TIMESTAMP '{SPLIT_DAY}' THEN 1 ELSE 20 END - md) * 30) AS d, ABS((l_tax - mt) * 80) AS t FROM lineitem, b),
        g AS (SELECT y, AVG(q) AS q, AVG(d) AS d, AVG(t) AS t FROM r WHERE NOT old GROUP BY 1), o AS (SELECT AVG(q) AS q, AVG(d) AS d, AVG(t) AS t FROM r WHERE old),
        gl AS (SELECT y, 'l_quantity' AS feature, q AS m FROM g UNION ALL SELECT y, 'l_discount', d FROM g UNION ALL SELECT y, 'l_tax', t FROM g),
        ol AS (SELECT 'l_quantity' AS feature, q AS m FROM o UNION ALL SELECT 'l_discount', d FROM o UNION ALL SELECT 'l_tax', t FROM o),
        gr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY y ORDER BY m DESC, feature) AS rk FROM gl), orr AS (SELECT *, ROW_NUMBER() OVER (ORDER BY m DESC, feature) AS rk FROM ol)
        SELECT CAST(y AS INTEGER) AS year, feature, ROUND(orr.m, 6) AS base_mean_abs, ROUND(gr.m, 6) AS mean_abs, CAST(gr.rk - orr.rk AS INTEGER) AS rank_change FROM gr JOIN orr USING (feature)""",
)
def _(t):
    old = F.col("l_shipdate") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    base = t.lineitem.where(old)
    cur = t.lineitem.where(~old).withColumn("l_discount", F.col("l_discount") * 20).withColumn("year", F.year("l_shipdate"))
    return rounded(mo.attribution_drift(mo.attribution(base, WEIGHTS, base), mo.attribution(cur, WEIGHTS, base, ["year"]), ["year"]))


PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]


@query(
    "m8c_sketched_quantiles",
    f"""WITH w AS (SELECT year(l_shipdate) AS y, l_quantity, l_extendedprice FROM lineitem), f AS (SELECT y, 'l_quantity' AS feature, COUNT(*) AS n FROM w GROUP BY 1 UNION ALL SELECT y, 'l_extendedprice', COUNT(*) FROM w GROUP BY 1)
        SELECT CAST(y AS INTEGER) AS year, feature, n, CAST(p AS DOUBLE) AS prob, true AS within FROM f, (SELECT unnest([{", ".join(map(str, PROBS))}]) AS p)""",
)
def _(t):
    """Sketches kept per day, merged into years; each quantile's exact rank is within the stated error of the asked one."""
    long = d.as_features(t.lineitem.withColumn("day", F.to_date("l_shipdate")), ["l_quantity", "l_extendedprice"], ["day"])
    daily = stage(d.sketches(long, ["day"]), "sketches")
    yearly = stage(d.merged(daily.withColumn("year", F.year("day")), ["year"]), "sketches")
    asked = d.sketched_quantiles(yearly, PROBS, ["year"])
    values = long.groupBy(F.year("day").alias("year"), "feature", "value").agg(F.count(F.lit(1)).alias("c"))
    ranked = asked.withColumnRenamed("value", "q").join(values, ["year", "feature"]).groupBy("year", "feature", "n", "prob")
    below = ranked.agg(F.sum(F.when(F.col("value") < F.col("q"), F.col("c")).otherwise(0)).alias("less"), F.sum(F.when(F.col("value") <= F.col("q"), F.col("c")).otherwise(0)).alias("upto"))
    room = F.lit(2 * d.rank_error()) + 1 / F.col("n")  # twice the error of one rank in a hundred
    near = (F.col("less") / F.col("n") <= F.col("prob") + room) & (F.col("upto") / F.col("n") >= F.col("prob") - room)
    return below.select("year", "feature", "n", "prob", near.alias("within"))


@query(
    "m8d_sketched_drift",
    f"""WITH n AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SPLIT_DAY}' GROUP BY 1)
        SELECT year, feature, feature = 'shifted' AS drifted FROM n, (SELECT unnest(['l_quantity', 'l_extendedprice', 'shifted']) AS feature)""",
)
def _(t):
    """Drift of later years from sketches alone: only the feature that was shifted on purpose drifts."""
    cut = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    moved = F.when(F.col("l_shipdate") < cut, F.col("l_quantity")).otherwise(F.col("l_quantity") * 1.5)
    rows = t.lineitem.withColumn("day", F.to_date("l_shipdate")).withColumn("shifted", moved)
    daily = stage(d.sketches(d.as_features(rows, ["l_quantity", "l_extendedprice", "shifted"], ["day"]), ["day"]), "sketches")
    old = F.col("day") < F.lit(SPLIT_DAY).cast("date")
    found = d.sketched_psi(stage(d.merged(daily.where(old)), "sketches"), d.merged(daily.where(~old).withColumn("year", F.year("day")), ["year"]), ["year"])
    return found.select("year", "feature", (F.col("psi") > d.PSI_SIGNIFICANT).alias("drifted"))
