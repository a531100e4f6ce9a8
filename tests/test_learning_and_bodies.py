"""Bodies of unknown shape, ordered statistics, regularised trees, sketches, intervals and halving against plain versions."""

import json
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwright.functions import known
from churnwright.operators import drift, gates, monitoring, profiling, scoring
from churnwright.operators.checks import in_range, run_checks
from churnwright.operators.encoding import apply_target_statistics, ordered_target_encode, target_statistics
from churnwright.streaming import monitors
from churnwright.session import new_path
from churnwright.training import boosting, models, search

ROWS = "id bigint, cat string, y int, x double, z double"


def table(n=300, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cat = rnd.choice(["a", "a", "a", "b", "c", None])
        x = rnd.choice([rnd.random(), rnd.randint(0, 5) / 5, float("nan"), None])
        y = None if i % 19 == 0 else int((cat == "a") + (x if x and x == x else 0.5) + rnd.random() > 1.3)
        rows.append((i, cat, y, x, rnd.choice([None, rnd.random()])))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(table(), ROWS).repartition(3)


# ---- JSON bodies ----


def flat(o, path=()):
    for k, v in o.items():
        if isinstance(v, dict) and v:
            yield from flat(v, (*path, k))
        else:
            yield ".".join((*path, k)), v


def test_bodies_of_any_shape(spark):
    objects = [
        {"a": 1, "b": {"c": "x", "d e": 2.5}}, {"a": 2.75}, {"a": 10**12, "B": True, "b": {"c": 7}}, {"l": [1, 2], "b": {"c": {"deep": 1}}}, {}, {"n": None, "OBJECT<": "odd", "it's": 3},
    ]
    bodies = [json.dumps(o) for o in objects[:4]] + [json.dumps(objects[4:]), "[]", "5", '"text"', "{broken", None, '[7, {"a": 3}, "x"]', ""]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string").repartition(3)
    got = monitoring.parse_any_json(df, "body", ["id"])
    assert set(got.columns) == {"id", "a", "b.c", "b.d e", "B", "l", "n", "OBJECT<", "it's"}
    kinds = dict(got.dtypes)
    assert kinds["b.c"] == "string" and kinds["l"] == "array<bigint>" and kinds["a"].startswith(("decimal", "double"))
    want = sorted((i, tuple(sorted(flat(o)))) for i, o in [*enumerate(objects[:4]), (4, objects[4]), (4, objects[5]), (10, {"a": 3})])
    found = []
    for r in got.collect():
        row = {c: v for c, v in zip(got.columns, r, strict=True) if c != "id" and v is not None}
        row = {c: float(v) if c in ("a", "b.d e") else v for c, v in row.items()}
        found.append((r[0], row))
    shown = [(i, {c: float(v) if c in ("a", "b.d e") else str(v) if c == "b.c" else v for c, v in o if v is not None and c != "b.c.deep"}) for i, o in want]
    assert sorted((i, sorted((c, str(v)) for c, v in o.items() if c != "b.c")) for i, o in found) == sorted((i, sorted((c, str(v)) for c, v in o.items() if c != "b.c")) for i, o in shown)
    assert {o["b.c"] for _, o in found if "b.c" in o} == {"x", "7", '{"deep":1}'}


def test_bodies_without_an_object(spark):
    df = spark.createDataFrame([(1, "5"), (2, None)], "id int, body string")
    got = monitoring.parse_any_json(df, "body", ["id"])
    assert got.columns == ["id"] and got.count() == 0
    assert monitoring.parse_any_json(df.where("false"), "body", ["id"]).count() == 0


def test_given_shape_leaves_other_kinds_null(spark):
    base = spark.createDataFrame([('{"a": 1, "b": "t"}',)], "body string")
    shape = monitoring.json_shape(monitoring.json_objects(base, "body"))
    got = monitoring.parse_any_json(spark.createDataFrame([('{"a": {"deep": 1}, "new": 5}',), ('{"b": "u"}',)], "body string"), "body", shape=shape)
    assert sorted(map(tuple, got.collect()), key=str) == [(None, "u"), (None, None)]


# ---- ordered target statistics ----


@pytest.mark.parametrize("chunks", ["1000000", "25"])
def test_ordered_statistics_never_see_the_own_target(spark, rows, chunks):
    spark.conf.set("churnwright.rowsPerChunk", chunks)
    try:
        coded = lambda df: {r.id: r.e for r in ordered_target_encode(df, "cat", "y", "id", "e", prior=0.3, weight=2.0).collect()}
        got = coded(rows)
        import hashlib

        seen, want = defaultdict(lambda: [0.0, 0]), {}
        for i, cat, y, *_ in sorted(table(), key=lambda r: (hashlib.md5(f"42|{r[0]}".encode()).hexdigest(), r[0])):
            want[i] = (seen[cat][0] + 0.6) / (seen[cat][1] + 2)
            if y is not None:
                seen[cat][0] += y
                seen[cat][1] += 1
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)
        for own in (5, 77, 140):
            flipped = coded(rows.withColumn("y", F.when(F.col("id") == own, 1 - F.col("y")).otherwise(F.col("y"))))
            assert flipped[own] == got[own]
    finally:
        spark.conf.unset("churnwright.rowsPerChunk")


def test_statistics_for_rows_to_score(spark, rows):
    held = target_statistics(rows.where("cat = 'a' OR cat IS NULL"), "cat", "y")
    got = {r.id: r.e for r in apply_target_statistics(rows, held, "cat", "e", prior=0.25, weight=4.0).collect()}
    for i, cat, *_ in table():
        ys = [r[2] for r in table() if r[1] == cat and r[2] is not None] if cat in ("a", None) else []
        assert abs(got[i] - (sum(ys) + 1) / (len(ys) + 4)) < 1e-12


# ---- regularised trees ----


def test_boosted_leaves_and_contributions(spark, rows):
    ready = rows.withColumn("x", F.coalesce(known("x"), F.lit(-1.0)))
    stages = models.feature_stages(["x"], ["cat"], False)
    model = boosting.fit_boosted(ready.fillna("none", ["cat"]), stages, "y", rounds=11, depth=3, rate=0.4, l2=2.0)
    assert len(model.trees) == 11 and model.names[0] == "x"
    out = boosting.contributions(model, ready.fillna("none", ["cat"]), ["id"]).collect()
    assert len(out) == len(table()) and all(abs(r.base + sum(r.contributions) - r.margin) < 1e-9 for r in out)
    # every leaf is -rate G / (H + l2) of the rows that reach it, from the margin of the trees before
    prepared = model.prepared(ready.fillna("none", ["cat"]).where("y IS NOT NULL"))
    for r in (0, 1, 9):
        before = F.lit(model.base) + model.margin(model.trees[:r])
        p = boosting.sigmoid(before)
        own = F.expr(boosting.tree_text(model.trees[r], lambda n: boosting.number(model.value(n))))
        sums = prepared.select(own.alias("v"), p.alias("p"), "y").groupBy("v").agg(F.sum(F.col("p") - F.col("y")).alias("g"), F.sum(F.col("p") * (1 - F.col("p"))).alias("h")).collect()
        assert all(abs(s.v + 0.4 * s.g / (s.h + 2.0)) < 1e-9 for s in sums)
    plain = boosting.fit_boosted(ready.fillna("none", ["cat"]), stages, "y", rounds=1, depth=3, rate=0.4, l2=0.0)
    strong = boosting.fit_boosted(ready.fillna("none", ["cat"]), stages, "y", rounds=1, depth=3, rate=0.4, l2=1e6)
    assert max(abs(strong.value(n)) for n in strong.trees[0].leaves()) < 1e-3 < max(abs(plain.value(n)) for n in plain.trees[0].leaves())


# ---- ranks, missingness, repeats ----


@pytest.mark.parametrize("chunks", ["1000000", "25"])
def test_rank_correlation(spark, rows, chunks):
    spark.conf.set("churnwright.rowsPerChunk", chunks)
    try:
        (got,) = profiling.rank_correlations(rows, ["x", "z"]).collect()
    finally:
        spark.conf.unset("churnwright.rowsPerChunk")
    both = [(x, z) for *_, x, z in table() if x is not None and x == x and z is not None]
    mid = lambda v: [sum(o < a for o in v) + (sum(o == a for o in v) + 1) / 2 for a in v]
    x, z = (mid([p[i] for p in both]) for i in (0, 1))
    assert got.n == len(both) and abs(got.r - np.corrcoef(x, z)[0, 1]) < 1e-12


def test_joint_missingness_and_repeats(spark, rows):
    got = {(r.a, r.b): r for r in profiling.joint_missingness(rows, ["cat", "y", "x"]).collect()}
    gone = {"cat": [r[1] is None for r in table()], "y": [r[2] is None for r in table()], "x": [r[3] is None or r[3] != r[3] for r in table()]}
    for (a, b), r in got.items():
        p, q = np.array(gone[a]), np.array(gone[b])
        assert (r.n_both, r.n_either) == ((p & q).sum(), (p | q).sum()) and abs(r.r - np.corrcoef(p, q)[0, 1]) < 1e-9
    assert tuple(profiling.duplicate_rows(rows.unionByName(rows.limit(10))).first()) == (310, 300, 10, 10, 2)
    assert tuple(profiling.duplicate_rows(rows.where("false")).first()) == (0, 0, 0, 0, 0)


# ---- NaN ----


def test_nan_is_missing_in_metrics_and_limits(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, float("nan")), (0, float("inf")), (1, None)], "label int, score double")
    assert tuple(scoring.confusion(df, 0.5).first()) == (1, 0, 0, 1)
    row = scoring.metric_set(df, ["brier", "mean_score", "roc_auc"]).first()
    assert abs(row.brier - 0.01) < 1e-12 and row.mean_score == 0.5 and row.roc_auc == 1.0
    assert profiling.null_profile(df, ["score"]).first().n_null == 3
    assert run_checks(df, [in_range("score", 0, 1)]).first().observed == 0
    base = spark.createDataFrame([(0.0,), (1.0,)], "score double")
    assert [tuple(r) for r in monitoring.violations(df, base, ["score"], []).collect()] == [("score", "completeness", 3)]


# ---- sketches, intervals, halving, stream counts ----


def test_merged_sketches_keep_their_rank_error(spark):
    rnd = np.random.default_rng(3)
    values = rnd.normal(size=40_000)
    long = spark.createDataFrame([(int(i % 9), "f", float(v)) for i, v in enumerate(values)], "day int, feature string, value double").repartition(6)
    daily = drift.sketches(long, ["day"])
    whole = drift.sketched_quantiles(drift.merged(daily), [0.05, 0.5, 0.95]).collect()
    assert all(r.n == 40_000 and abs((values <= r.value).mean() - r.prob) <= 2 * drift.rank_error() for r in whole)
    same = drift.sketched_psi(drift.merged(daily), drift.merged(daily.where("day < 3"))).first()
    assert same.psi < 0.02 and same.ks < 0.03
    few = drift.sketched_psi(drift.merged(daily), drift.sketches(long.limit(5))).first()
    assert few.psi is None and few.ks is None


def test_bootstrap_does_not_depend_on_the_partitioning(spark):
    rnd = random.Random(8)
    data = [(i, int(rnd.random() < 0.4), round(rnd.random(), 2)) for i in range(400)]
    runs = [gates.bootstrap(spark.createDataFrame(data, "id int, label int, score double").repartition(k), ["id"], 25) for k in (1, 5)]
    a, b = ({r.replicate: (r.roc_auc, r.pr_auc) for r in f.collect()} for f in runs)
    assert a == b and len(a) == 25
    row = gates.metric_interval(runs[0], "roc_auc").first()
    aucs = sorted(v[0] for v in a.values())
    assert row.low >= aucs[0] and row.high <= aucs[-1] and abs(row.mean - np.mean(aucs)) < 1e-12
    steps = gates.poisson_steps()
    assert abs(steps[0] / 2**32 - math.exp(-1)) < 1e-9 and steps == sorted(steps)


def test_halving_keeps_the_best(spark, rows):
    labelled = rows.where("y IS NOT NULL").withColumnRenamed("y", "label")
    tried = []

    def fit_and_score(train, valid, params):
        tried.append((params["k"], params["rounds"]))
        return valid.select("label", (F.col("label") * params["k"] + F.rand(1)).alias("score"))

    runs = search.halving(labelled, labelled, [{"k": k / 10, "rounds": 2} for k in (1, 5, 0, 9)], fit_and_score, "id", eta=2, share=0.25, grows="rounds").collect()
    by = defaultdict(list)
    for r in runs:
        by[r.rung].append(r)
    assert [len(by[i]) for i in range(3)] == [4, 2, 1] and {r.job_index for r in by[1]} == {1, 3} and [r.job_index for r in by[2]] == [3]
    assert {r.rounds for r in by[1]} == {4} and by[0][0].n_train < by[1][0].n_train < by[2][0].n_train == labelled.count()


def test_late_truth_revises_a_window_and_a_repeated_batch_does_not(spark):
    path = new_path(spark, "score-counts")
    batch = lambda rows: spark.createDataFrame(rows, "ts string, label bigint, score double").withColumn("ts", F.col("ts").cast("timestamp"))
    first = [("2024-01-01 01:00:00", 1, 0.9), ("2024-01-01 02:00:00", 0, 0.2), ("2024-01-02 09:00:00", 1, 0.4)]
    late = [("2024-01-01 23:00:00", 0, 0.95), ("2024-01-03 00:30:00", 1, 0.5), ("2024-01-01 05:00:00", 1, float("nan"))]
    monitors.keep_scores(batch(first), 0, path, "ts")
    one = monitors.window_quality(spark, path).collect()
    assert [(str(r.start), r.n_pos, r.n_neg, r.roc_auc, r.n_batches) for r in one] == [("2024-01-01 00:00:00", 1, 1, 1.0, 1)]
    for _ in range(2):
        monitors.keep_scores(batch(late), 1, path, "ts")
    two = {str(r.start): r for r in monitors.window_quality(spark, path).collect()}
    assert set(two) == {"2024-01-01 00:00:00", "2024-01-02 00:00:00"}
    assert (two["2024-01-01 00:00:00"].n_neg, two["2024-01-01 00:00:00"].roc_auc, two["2024-01-01 00:00:00"].n_batches) == (2, 0.5, 2)
    assert set(str(r.start) for r in monitors.window_quality(spark, path, within="1 hour").collect()) == {"2024-01-01 00:00:00"}
