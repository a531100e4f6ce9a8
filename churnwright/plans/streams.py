"""Structured Streaming forms (M1s-M3s, M10s, M12s, J2s, M15, M16). Each drains a file stream into a table and reads it."""

from pyspark.sql import functions as F

from churnwright.operators import drift as d
from churnwright.operators import monitoring as mo
from churnwright.plans.metrics import curve_sql
from churnwright.plans.monitoring import JSON_RECORD
from churnwright.plans.registry import Tables, query, rounded
from churnwright.session import new_path, stage
from churnwright.streaming import capture as st
from churnwright.streaming import monitors as wm


def _events(t: Tables, delay: str = "0 seconds"):
    stream = st.stream_parquet(t.spark, t.folder, t.events.schema, "events.parquet")
    return st.with_event_time(stream, "ts", delay)


# Append mode emits a window once the watermark, the newest event time less the delay, has passed its end.
CLOSED = """SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, {cols} FROM (SELECT time_bucket(INTERVAL '{every}', ts) AS s, * FROM events) WHERE s + INTERVAL '{every}' <= (SELECT MAX(ts) FROM events) GROUP BY {keys}"""


def _start(df):
    return rounded(df.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss")))


@query("m1s_stream_capture", "SELECT event_id FROM events WHERE substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8) < '33333333'")
def _(t):
    return st.run_to_table(mo.capture(_events(t), 20, "event_id").select("event_id"), "captured")


@query("m2s_stream_csv_body", "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind FROM events")
def _(t):
    bodies = _events(t).select(F.concat_ws(",", "event_id", "event_type").alias("body"))
    return st.run_to_table(mo.parse_csv_body(bodies, "body", ["id", "kind"]), "csv-bodies")


@query("m3s_stream_json_body", "SELECT event_id AS id, user_id, event_type AS user_kind FROM events")
def _(t):
    # captured requests as gzip JSON lines, read back as a stream
    folder = new_path(t.spark, "requests")
    user = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"))
    body = F.to_json(F.array(F.struct(F.col("event_id").alias("id"), user.alias("user"))))
    t.events.select(F.struct(body.alias("body")).alias("request")).write.option("compression", "gzip").json(folder)
    stream = st.stream_capture(t.spark, folder, "request struct<body: string>")
    flat = mo.parse_json_body(stream, "request.body", JSON_RECORD)
    return st.run_to_table(flat.withColumnsRenamed({"user.id": "user_id", "user.kind": "user_kind"}), "json-bodies")


@query(
    "m15_windowed_monitor",
    CLOSED.format(
        every="4 hours", keys="s, event_type",
        cols="event_type, COUNT(*) AS n, ROUND(AVG(value), 6) AS mean, MIN(value) AS low, MAX(value) AS high",
    ),
)
def _(t):
    out = st.run_to_table(wm.window_stats(_events(t), "ts", "value", ["event_type"], "4 hours"), "window-stats")
    return _start(out.select("start", "event_type", "n", "mean", F.col("min").alias("low"), F.col("max").alias("high")))


EDGES = [5.0, 10.0, 20.0, 40.0, 80.0]


@query(
    "m15b_windowed_bins",
    CLOSED.format(
        every="1 day", keys="s, bin",
        cols="'value' AS feature, CAST((value >= 5)::INT + (value >= 10)::INT + (value >= 20)::INT + (value >= 40)::INT + (value >= 80)::INT AS INTEGER) AS bin, COUNT(*) AS k",
    ),
)
def _(t):
    edges = t.spark.createDataFrame([("value", EDGES)], "feature string, inner array<double>")
    return _start(st.run_to_table(wm.window_bins(d.as_features(_events(t), ["value"], ["ts"]), "ts", edges), "window-bins"))


@query(
    "m11s_stream_psi",
    """WITH base AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-11'),
       cur AS (SELECT strftime(ts, '%Y-%m-%d 00:00:00') AS start, value FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND date_trunc('day', ts) + INTERVAL '1 day' <= (SELECT MAX(ts) FROM events)),
       q AS (SELECT list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS cuts FROM base), i AS (SELECT cuts[2:len(cuts) - 1] AS edges FROM q),
       e AS (SELECT len(list_filter(edges, lambda x : value >= x)) AS bin, COUNT(*) AS e FROM base, i GROUP BY 1),
       a AS (SELECT start, len(list_filter(edges, lambda x : value >= x)) AS bin, COUNT(*) AS a FROM cur, i GROUP BY 1, 2), days AS (SELECT DISTINCT start FROM cur), bins AS (SELECT bin FROM e UNION SELECT bin FROM a),
       p AS (SELECT start, GREATEST(COALESCE(e, 0) / (SELECT SUM(e) FROM e), 1e-6) AS pe, GREATEST(COALESCE(a, 0) / SUM(COALESCE(a, 0)) OVER (PARTITION BY start), 1e-6) AS pa
             FROM days CROSS JOIN bins LEFT JOIN e USING (bin) LEFT JOIN a USING (start, bin))
       SELECT start, 'value' AS feature, ROUND(SUM((pa - pe) * LN(pa / pe)), 6) AS psi FROM p GROUP BY 1""",
)
def _(t):
    day = F.lit("2024-01-11")
    base = d.as_features(t.events.where(F.col("ts") < day.cast("timestamp_ntz")), ["value"])
    edges = stage(d.psi_edges(base), "edges")
    current = d.as_features(_events(t).where(F.col("ts") >= day.cast("timestamp")), ["value"], ["ts"])
    counted = st.run_to_table(wm.window_bins(current, "ts", edges), "window-bins")
    return _start(d.psi_of_bins(d.bin_counts(base, edges.select("feature", "inner")), counted, ["start"]))


@query("m16_repeats_and_windows", CLOSED.format(every="4 hours", keys="s", cols="COUNT(*) AS n"))
def _(t):
    # every third event is captured twice; the second copy must not count
    folder = new_path(t.spark, "repeated")
    t.events.unionByName(t.events.where("event_id % 3 = 0")).write.parquet(folder)
    stream = st.with_event_time(st.stream_parquet(t.spark, folder, t.events.schema), "ts", "0 seconds")
    once = st.drop_repeats(stream, "event_id")
    return _start(st.run_to_table(wm.window_stats(once, "ts", "value", [], "4 hours"), "deduplicated").select("start", "n"))


@query(
    "j2s_stream_truth",
    """SELECT p.event_id, p.score, b.label FROM (SELECT event_id, ts, value / 500 AS score FROM events WHERE event_type <> 'error') p
       JOIN (SELECT event_id, ts + to_minutes(CAST(event_id % 90 AS INTEGER)) AS at, event_id % 2 AS label FROM events) b ON p.event_id = b.event_id AND b.at <= p.ts + INTERVAL '1 hour'""",
)
def _(t):
    return _joined(t)


def _joined(t):
    return st.run_to_table(_joined_stream(t, t.folder, "events.parquet"), "with-truth").drop("ts")


def _joined_stream(t, folder, glob=None, files_per_batch=None):
    source = lambda: st.stream_parquet(t.spark, folder, t.events.schema, glob, files_per_batch)
    pred = st.with_event_time(source(), "ts", "2 hours").where("event_type <> 'error'").select("event_id", "ts", (F.col("value") / 500).alias("score"))
    later = F.expr("make_dt_interval(0, 0, cast(event_id % 90 as int))")
    truth = source().select("event_id", (F.col("ts").cast("timestamp") + later).alias("at"), (F.col("event_id") % 2).alias("label"))
    joined = wm.join_truth(pred, truth.withWatermark("at", "2 hours"), "event_id", "ts", "at", "1 hour")
    return joined.select("event_id", "score", "label", "ts")


JUDGED = """p AS (SELECT event_id, ts, time_bucket(INTERVAL '1 day', ts) AS start, value / 500 AS score, event_id % 2 AS label FROM events WHERE event_type <> 'error' AND event_id % 90 <= 60),
   scored AS (SELECT * FROM p WHERE start + INTERVAL '1 day' + INTERVAL '1 hour' <= (SELECT MAX(ts) FROM p))"""


@query(
    "m12s_stream_quality",
    f"""WITH {JUDGED}, {curve_sql("scored", ("start",))} SELECT strftime(rank.start, '%Y-%m-%d %H:%M:%S') AS start, CAST(rank.n_pos AS BIGINT) AS n_pos, CAST(rank.n_neg AS BIGINT) AS n_neg,
        ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc, ROUND(threshold, 6) AS threshold, ROUND(CAST(tp AS DOUBLE) / hit.n_pos, 6) AS recall FROM rank JOIN hit USING (start)""",
)
def _(t):
    return _start(_stream_quality(t).select("start", "n_pos", "n_neg", "roc_auc", "pr_auc", "threshold", "recall"))


def _stream_quality(t):
    """Events come in three files, by time; truth comes up to an hour later, so a window is fed by more than one batch."""
    folder, path = new_path(t.spark, "sliced"), new_path(t.spark, "score-counts")
    span = t.events.agg(F.min("ts").cast("timestamp").cast("long").alias("a"), F.max("ts").cast("timestamp").cast("long").alias("b"))
    place = F.least(F.lit(2), F.floor((F.col("ts").cast("timestamp").cast("long") - F.col("_s.a")) * 3 / (F.col("_s.b") - F.col("_s.a"))))
    placed = t.events.withColumn("_s", span.select(F.struct("a", "b").alias("s")).scalar()).withColumn("_slice", place).drop("_s")
    for i in range(3):  # one after the other, as the source takes files by their time
        placed.where(F.col("_slice") == i).drop("_slice").coalesce(1).write.mode("append").parquet(folder)
    joined = _joined_stream(t, folder, files_per_batch=1)
    st.run_batches(joined, lambda batch, i: wm.keep_scores(batch, i, path, "ts"), "quality")
    return wm.window_quality(t.spark, path, "1 day", "1 hour")


@query(
    "m10s_stream_alerts",
    CLOSED.format(every="4 hours", keys="s HAVING AVG(value) > 21", cols="'quality' AS kind, 'mean' AS subject, true AS retrain"),
)
def _(t):
    # a micro-batch that breaches a limit appends to the alert table
    path = new_path(t.spark, "alerts")
    stats = wm.window_stats(_events(t), "ts", "value", [], "4 hours").withColumn("what", F.lit("mean"))

    def act(batch, batch_id):
        found = mo.alerts(batch, F.col("mean") > 21, "quality", "what", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
        found.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")  # a repeated batch replaces itself

    st.run_batches(stats, act, "alerts")
    table = t.spark.read.schema("kind string, subject string, detail string, retrain boolean").parquet(path)
    return table.select("kind", "subject", F.col("detail").alias("start"), "retrain")
