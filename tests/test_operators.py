"""Operators on small frames with planted faults."""

import datetime as dt
import gzip
import hashlib
import json
import math
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.operators import checks, cleaning, drift, encoding, gates, lookups, monitoring, profiling, sampling, snapshot, splitting
from churnwright.sources import readers, writers
from churnwright.streaming import capture as st
from churnwright.streaming import monitors as wm
from churnwright.training import search


def test_nan_and_inf_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (-math.inf,), (None,)], "x double")
    assert [r["x"] for r in cleaning.unify_missing(df).collect()] == [1.0, None, None, None, None]
    assert {r["x"] for r in cleaning.fill_median(df, ["x"]).collect()} == {1.0}


def test_no_time_sentinel(spark):
    df = spark.createDataFrame([(-(2**63),), (1_700_000_000_000_000,)], "t bigint")
    assert [r["t"] is None for r in cleaning.timestamp_from_micros(df, "t").collect()] == [True, False]


def test_dates_by_column_form(spark):
    digits = spark.createDataFrame([("20240131",), ("20249999",)], "d string")
    assert [str(r["d"])[:10] for r in cleaning.parse_dates(digits, "d").collect()] == ["2024-01-31", "None"]
    mixed = spark.createDataFrame([("2024-01-31",), ("bad",)], "d string")
    assert [str(r["d"])[:10] for r in cleaning.parse_dates(mixed, "d").collect()] == ["2024-01-31", "None"]
    ints = spark.createDataFrame([(20240131,)], "d int")
    assert str(cleaning.parse_dates(ints, "d").first()["d"])[:10] == "2024-01-31"


def test_coercion_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "1"), ("2.5", "x"), (None, None)], "a string, b string")
    assert dict(cleaning.coerce_numeric(df, ["a", "b"]).dtypes) == {"a": "double", "b": "string"}


def test_tidy_text_strips_tabs(spark):
    df = spark.createDataFrame([("\t Male \n",)], "s string")
    assert cleaning.normalise_text(df, ["s"]).first()["s"] == "male"


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (9.0,)], "x double")
    assert [r[0] for r in df.select(encoding.cut(F.col("x"), [0, 1, 2])).collect()] == [None, 0, 1, 1, None]


def test_frequencies_sum_to_one(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    out = {r["c"]: r["c__freq"] for r in encoding.frequency_encode(df, ["c"]).collect()}
    assert out == {"a": 2 / 3, "b": 1 / 3, None: None}


@pytest.mark.parametrize("small", [0, 1000])
def test_lookup_with_a_hot_key(spark, small):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 != 1, 7).otherwise(F.col("id") % 40).alias("k"))
    table = spark.range(35).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = lookups.lookup(facts, table, ["k"], hot_keys=16, small_bytes=small)
    want = facts.join(table, "k", "left")
    assert got.count() == 3000 and got.select("k", "id", "v").exceptAll(want.select("k", "id", "v")).count() == 0


def test_lookup_keeps_null_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    table = spark.createDataFrame([("a", 5)], "k string, v int")
    for small in (0, 10):
        assert {r["id"]: r["v"] for r in lookups.lookup(facts, table, ["k"], small_bytes=small).collect()} == {1: 5, 2: None}


def test_splits_are_disjoint_complete_and_exact(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    out = splitting.stratified_split(df, "y", "id", 0.2)
    assert out.count() == 1003 and out.select("id").distinct().count() == 1003
    sizes = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert sizes[(1, "test")] == 50 and sizes[(0, "test")] == 150
    again = splitting.stratified_split(df.repartition(13), "y", "id", 0.2)
    assert out.exceptAll(again).count() == 0


def test_undated_rows_go_to_validation(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(95)] + [(100 + i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, at timestamp")
    out = {r["id"]: r["split"] for r in splitting.time_split(df, "at").collect()}
    assert all(out[100 + i] == "valid" for i in range(5)) and out[0] == "train" and out[94] == "valid"
    assert splitting.holdout(df, "at").where("id >= 100").count() == 0


def test_time_split_needs_dates(spark):
    rows = [(i, dt.datetime(2024, 1, 1) if i < 5 else None, i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, at timestamp, y int")
    out = splitting.time_or_stratified_split(df, "at", "y", "id", 0.2)
    assert {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}[(1, "valid")] == 1


@pytest.mark.parametrize("n", [3, 10, 23])
def test_expanding_folds(spark, n):
    df = spark.range(n).withColumn("y", F.lit(1))
    blocks = [r["block"] for r in splitting.expanding_folds(df, ["id"], 3).orderBy("id").collect()]
    size = n // 4
    assert blocks == [0] * (n - 3 * size) + [f for f in (1, 2, 3) for _ in range(size)]


def test_stratum_sample_caps(spark):
    df = spark.range(100).withColumn("f", (F.col("id") % 2).cast("int"))
    assert sampling.sample_per_stratum(df, "f", "id", 0.5, 10).groupBy("f").count().where("count = 10").count() == 2
    assert sampling.sample_per_stratum(df, "f", "id", 1.0, 30).count() == 60
    assert sampling.sample_per_stratum(df, "f", "id", 0.05, 10).count() == 6


def test_history_reads_no_later_rows(spark):
    """Features of a contract stay the same when later contracts of the customer are removed."""
    d0 = dt.date(2020, 1, 1)
    rows = [(i, i % 3, d0 + dt.timedelta(days=40 * i), d0 + dt.timedelta(days=40 * i + 20 + i)) for i in range(30)]
    df = spark.createDataFrame(rows, "contract_id int, customer_id int, start date, end date")
    feats = ["contract_id", "contract_number", "gap_since_prev_expiry", "mean_len_prev", "std_len_prev", "tenure_days"]
    whole = snapshot.contract_history(df).select(feats)
    early = snapshot.contract_history(df.where("contract_id < 15")).select(feats)
    assert early.exceptAll(whole).count() == 0


def test_unobserved_label_is_null(spark):
    rows = [(1, 1, dt.date(2020, 1, 1), dt.date(2020, 2, 1)), (2, 1, dt.date(2022, 1, 1), dt.date(2022, 2, 1)), (3, 2, dt.date(2022, 3, 1), dt.date(2022, 4, 1))]
    df = spark.createDataFrame(rows, "contract_id int, customer_id int, start date, end date")
    assert {r["contract_id"]: r["churn"] for r in snapshot.contract_history(df, 365).collect()} == {1: 1, 2: None, 3: None}


def test_lookback_excludes_the_anchor_day(spark):
    day = lambda n: dt.datetime(2024, 1, n, 12)
    events = spark.createDataFrame([("u", day(3), 5.0, "a"), ("u", day(10), 7.0, "b"), ("u", day(9), 1.0, "a")], "who string, ts timestamp, v double, kind string")
    anchors = spark.createDataFrame([(1, "u", dt.date(2024, 1, 10)), (2, "u", dt.date(2024, 1, 11)), (3, "x", dt.date(2024, 1, 11))], "id int, who string, day date")
    spec = dict(who="who", anchor_day="day", ts="ts", days=7)
    got = {r["id"]: (r["lb_count"], r["lb_total"], r["lb_days_since_last"]) for r in snapshot.lookback(anchors, events, value="v", **spec).collect()}
    assert got == {1: (2, 6.0, 1), 2: (2, 8.0, 1), 3: (0, 0.0, None)}
    kinds = {r["id"]: r["n"] for r in snapshot.lookback_distinct(anchors, events, what="kind", out="n", **spec).collect()}
    assert kinds == {1: 1, 2: 2, 3: 0}


def test_cramers_v_edges(spark):
    perfect = spark.createDataFrame([(x, y) for x, y in (("a", 0), ("b", 1), ("c", 1)) for _ in range(10)], "x string, y int")
    assert profiling.cramers_v(perfect, "x", "y").first()["v"] == pytest.approx(1.0)
    diagonal = spark.createDataFrame([("a", 0)] * 10 + [("b", 1)] * 10, "x string, y int")
    # 2 x 2 with the continuity correction: chi2 = sum (|O - 5| - 0.5)^2 / 5 = 16.2
    assert profiling.cramers_v(diagonal, "x", "y").first()["v"] == pytest.approx(math.sqrt(16.2 / 20))
    flat = spark.createDataFrame([("a", 0), ("a", 1)], "x string, y int")
    assert profiling.cramers_v(flat, "x", "y").first()["v"] is None


def test_stratum_sample_is_that_of_sorted_rows_without_sorting_them(spark):
    n = 4000
    stratum = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot")).otherwise((F.col("id") % 40).cast("string"))
    df = spark.range(n).select("id", stratum.alias("f"), F.lit(1).alias("_x"))
    for ratio, cap in ((0.3, None), (0.5, 7), (1.0, None), (0.0, None)):
        got = sorted(r.id for r in sampling.sample_per_stratum(df, "f", "id", ratio, cap, 5).collect())
        groups = {}
        for r in df.collect():
            groups.setdefault(r.f, []).append(r.id)
        want = []
        for ids in groups.values():
            k = math.ceil(len(ids) * ratio)
            want += sorted(ids, key=lambda i: hashlib.md5(f"5|{i}".encode()).hexdigest())[: k if cap is None else min(k, cap)]
        assert got == sorted(want), (ratio, cap)
    rows = sampling.sample_per_stratum(df, "f", "id", 0.3)
    assert rows.columns == df.columns
    assert sampling.sample_per_stratum(df.limit(0), "f", "id", 0.3).count() == 0
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("Window") :]
    assert "_cut" in ranked and "Filter" in ranked  # what is ranked has been cut down to the rows of one prefix


def test_fingerprint_of_files_reads_only_new_ones(spark, tmp_path):
    folder, manifest = str(tmp_path / "some files"), str(tmp_path / "manifest")
    cols = ["id", "x"]
    table = lambda low, high: spark.range(low, high).select("id", (F.col("id") % 7).cast("string").alias("x"))
    table(0, 100).repartition(3).write.parquet(folder + "/day=1")
    look = lambda: profiling.fingerprint_files(spark, folder, manifest, cols).first()
    full = lambda low, high: profiling.fingerprint(table(low, high), cols).first()
    first = look()
    assert tuple(first)[:3] == tuple(full(0, 100)) and first.n_read == first.n_files == 3
    # what is known is not opened again: its bytes may be anything as long as name, length and time are the same
    old = next((tmp_path / "some files").glob("day=1/*.parquet"))
    for f in (tmp_path / "some files").glob("day=1/.*.crc"):
        f.unlink()
    kept, stat = old.read_bytes(), old.stat()
    old.write_bytes(b"?" * len(kept))
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    table(100, 150).coalesce(1).write.mode("append").option("compression", "none").parquet(folder + "/day=2")
    found = look()
    assert (found.n_files, found.n_read) == (4, 1)
    assert tuple(found)[:3] == tuple(full(0, 150))
    assert look().n_read == 0
    # a changed file is read again, one that is gone does not count
    old.write_bytes(kept)
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns + 10**10))
    assert look().n_read == 1
    old.unlink()
    held = profiling.fingerprint(spark.read.parquet(folder), cols).first()
    left = look()
    assert tuple(left)[:3] == tuple(held) and (left.n_files, left.n_read) == (3, 0)
    # other columns are another digest; a file without rows is known, too
    table(0, 0).coalesce(1).write.mode("append").parquet(folder + "/day=3")
    assert profiling.fingerprint_files(spark, folder, manifest, ["id"]).first().n_read == 4
    assert look().n_read == 1 and look().n_read == 0
    whole = profiling.fingerprint_files(spark, folder, manifest).first()
    assert tuple(whole)[:3] == tuple(profiling.fingerprint(spark.read.parquet(folder)).first()) and whole.n_read == 4


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(100).withColumn("t", F.col("id").cast("string"))
    same = df.repartition(7).orderBy(F.desc("id"))
    assert profiling.fingerprint(df).first() == profiling.fingerprint(same).first()
    assert profiling.fingerprint(df).first() != profiling.fingerprint(df.where("id <> 5")).first()


def test_gates_and_promotion(spark):
    folds = spark.createDataFrame(
        [("good", f, 0.85 + f / 1000, 0.6, 0.9) for f in range(3)] + [("shaky", f, 0.7 + f / 5, 0.6, 0.9) for f in range(3)] + [("single", 0, 0.9, 0.6, 0.9)],
        "run string, fold int, recall_at_target double, pr_auc double, roc_auc double",
    )
    gated = gates.quality_gates(folds)
    # one fold has no deviation, so its stability gate does not hold
    assert {r["run"]: r["quality_gates_pass"] for r in gated.collect()} == {"good": True, "shaky": False, "single": False}
    champions = spark.createDataFrame([("good", 0.9)], "run string, champion_value double")
    out = {r["run"]: (r["promote"], r["reason"]) for r in gates.promotion(gated, champions, "run", margin=0.01).collect()}
    assert out["good"] == (False, "candidate 0.8510 vs champion 0.9000 (margin 0.0100)")
    assert out["shaky"] == (False, "Failed quality gates")
    free = gates.promotion(gated, champions.where("champion_value < 0"), "run")
    assert free.where("promote").first()["reason"] == "Passed gates; no champion metric available"


def test_champion_priorities(spark):
    rows = [
        ("old-run", "g", "Approved", dt.datetime(2024, 1, 1), {"candidate_run_id": "r1"}, {}),
        ("tagged", "g", "Approved", dt.datetime(2024, 2, 1), {"is_champion": "TRUE"}, {}),
        ("new", "g", "Approved", dt.datetime(2024, 3, 1), {}, {"m": "0.5"}),
        ("newest", "g", "Rejected", dt.datetime(2024, 4, 1), {}, {}),
    ]
    reg = spark.createDataFrame(rows, "arn string, group string, status string, created timestamp, tags map<string,string>, meta map<string,string>")
    pick = lambda run, tag: gates.resolve_champion(reg, run, tag).first()["arn"]
    assert (pick("r1", True), pick("none", True), pick(None, False)) == ("old-run", "tagged", "new")
    assert gates.latest_approved(reg, "m").first()["champion_value"] == 0.5
    assert gates.latest_approved(reg, "absent").first()["champion_value"] is None


def test_tags_to_map(spark):
    df = spark.createDataFrame([([("a", "1"), (None, "2"), ("b", None), ("a", "3")],)], "t array<struct<Key:string,Value:string>>")
    assert df.select(gates.tags_to_map(F.col("t")).alias("m")).first()["m"] == {"a": "3"}


def test_require_stops_the_flow(spark):
    df = spark.createDataFrame([(1,), (None,)], "y int")
    with pytest.raises(ValueError, match="no_null_y"):
        checks.require(checks.run_checks(df, [checks.no_nulls("y")]))


def test_capture_files_plain_and_gzip(spark, tmp_path):
    line = json.dumps({"request": {"body": "1,2"}}) + "\n"
    (tmp_path / "a.jsonl").write_text(line)
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(line.encode()))
    assert readers.read_capture(spark, str(tmp_path)).where("request.body = '1,2'").count() == 2


def test_csv_body_drops_extra_fields(spark):
    df = spark.createDataFrame([("1,x,9",), ("7",), ("1,2\n3,4",), ("5,",)], "b string")
    got = [tuple(r) for r in monitoring.parse_csv_body(df, "b", ["n", "s"]).collect()]
    assert got == [("1", "x"), ("5", None)]


def test_schema_contract_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    writers.write_schema_contract(df, str(tmp_path / "c"))
    columns, values = readers.read_schema_contract(spark, str(tmp_path / "c"))
    back = {r["column"]: r for r in columns.collect()}
    assert back["n"]["min"] == "1.0" and back["s"]["example_values"] == ["a"] and back["s"]["nullable"]
    assert [tuple(r) for r in values.collect()] == [("s", "a")]
    later = spark.createDataFrame([(1, "a"), (5, "b"), (None, None)], "n int, s string")
    assert {(r["column"], r["rule"], r["n"]) for r in checks.contract_violations(later, columns, values).collect()} == {("n", "null", 1), ("n", "range", 1), ("s", "category", 1)}


def test_wide_categories_are_held_to_the_baseline(spark):
    base = spark.createDataFrame([(str(i), float(i)) for i in range(30)], "c string, x double")
    now = spark.createDataFrame([(str(i), 1.0) for i in range(20, 40)] + [("3", float("nan"))], "c string, x double")
    assert [tuple(r) for r in monitoring.violations(now, base, ["x"], ["c"]).where("rule = 'category'").collect()] == [("c", "category", 10)]


def test_drift_keeps_features_without_values(spark):
    rows = [(d, "a", float(i)) for d in ("x", "y") for i in range(40)] + [("x", "b", float(i)) for i in range(40)]
    base = spark.createDataFrame([("a", float(i)) for i in range(40)] + [("b", float(i)) for i in range(40)], "feature string, value double")
    now = spark.createDataFrame(rows, "day string, feature string, value double")
    whole = {r["feature"]: r["severity"] for r in drift.with_severity(drift.drift_table(base, now.where("feature = 'a'").drop("day"))).collect()}
    assert whole == {"a": "stable", "b": "missing"}
    empty = spark.createDataFrame([("z",)], "day string")
    daily = {(r["day"], r["feature"]): r["severity"] for r in drift.with_severity(drift.drift_table(base, now, ["day"], features=["c"], windows=empty)).collect()}
    assert daily[("x", "b")] == "stable" and daily[("y", "b")] == "missing" and daily[("z", "a")] == "missing" and daily[("x", "c")] == "missing" and len(daily) == 9


def test_rejected_bodies_are_counted(spark):
    bodies = ['{"k": 1}', '[{"k": 2}, {"k": 3}]', "{bad", "not json", "7", None, ""]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    record = T.StructType([T.StructField("k", T.LongType())])
    assert sorted(r["k"] for r in monitoring.parse_json_body(df, "b", record).collect()) == [1, 2, 3]
    assert {r["reason"]: r["n"] for r in monitoring.rejects(df, monitoring.json_fault("b")).collect()} == {"malformed": 3, "no object": 1, "no body": 1}
    csv = spark.createDataFrame([("1,2",), ("x",), ("1,2\n3,4",), (None,)], "b string")
    got = monitoring.parse_csv_body(csv, "b", ["user id", "a:b`c"])
    assert got.columns == ["user id", "a:b`c"] and [tuple(r) for r in got.collect()] == [("1", "2")]
    assert {r["reason"]: r["n"] for r in monitoring.rejects(csv, monitoring.csv_fault("b")).collect()} == {"no comma": 1, "more than one line": 1, "no body": 1}


def test_missing_files_fail(spark, tmp_path):
    with pytest.raises(Exception):
        readers.read_parquet(spark, str(tmp_path / "nothing*.parquet")).count()


def test_stream_equals_batch_with_late_and_repeated_rows(spark, tmp_path):
    """Three files in three batches: repeats count once, rows behind the watermark are dropped, the open window waits."""
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    schema = "id bigint, ts timestamp_ntz, value double"
    folder = str(tmp_path / "in")
    files = [
        [(1, at(1), 1.0), (1, at(1), 1.0), (2, at(2), 3.0), (3, at(9), 5.0)],
        [(4, at(13), 7.0), (4, at(13), 7.0)],
        [(9, at(1, 30), 100.0), (5, at(20), 1.0)],
    ]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder, mode="append")
        time.sleep(1.1)
    stream = st.stream_parquet(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1)
    once = st.drop_repeats(st.with_event_time(stream, "ts", "1 hour"), "id")
    out = st.run_to_table(wm.window_stats(once, "ts", "value"))
    got = {r["start"].hour: (r["n"], r["mean"]) for r in out.collect()}
    assert got == {0: (2, 2.0), 8: (1, 5.0), 12: (1, 7.0)}


def test_grid_and_draws():
    assert search.grid({"a": [1, 2], "b": ["x", "y", "z"]})[:2] == [{"a": 1, "b": "x"}, {"a": 1, "b": "y"}] and len(search.grid({"a": [1, 2], "b": [3, 4, 5]})) == 6
    ranges = {"trees": (3, 9), "rate": (0.1, 0.4)}
    assert search.random_draws(ranges, 5) == search.random_draws(ranges, 5)
    assert all(3 <= d["trees"] <= 9 and isinstance(d["trees"], int) and 0.1 <= d["rate"] <= 0.4 for d in search.random_draws(ranges, 50))


def test_best_round_waits():
    from churnwright.training.models import best_round

    assert best_round([5, 4, 3, 3.5, 3.4, 2.9, 3], 2) == 3 and best_round([5, 4, 3, 3.5, 3.4, 2.9, 3], 3) == 6 and best_round([1.0]) == 1


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500, 900])
def test_sample_by_prefix_cut(spark, n):
    df = spark.range(500).repartition(5)
    whole = [r["id"] for r in df.withColumn("h", F.md5(F.concat_ws("|", F.lit("42"), F.col("id").cast("string")))).orderBy("h", "id").collect()]
    assert sorted(r["id"] for r in sampling.sample_rows(df, n, "id").collect()) == sorted(whole[:n])


def test_one_hot_is_learned_and_never_cut(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert encoding.one_hot_values(train, "c") == ["a", "b"]
    with pytest.raises(ValueError):
        encoding.one_hot_values(train, "c", most=1)


def test_nulls_and_nan_do_not_count(spark):
    from churnwright.operators import scoring
    from churnwright.training.models import balanced_weights

    rows = [(1, 0.9), (0, 0.2), (1, float("nan")), (0, float("nan")), (None, 0.5), (0, None)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert scoring.ranking_metrics(scoring.threshold_curve(df)).first()["roc_auc"] == 1.0
    assert scoring.threshold_curve(df).first()["n_neg"] == 1
    assert math.isclose(scoring.brier(df).first()["brier"], (0.01 + 0.04) / 2)
    assert {(r["label"], r["weight"]) for r in balanced_weights(df, "label").collect()} == {(1, 1.25), (0, 5 / 6), (None, None)}
