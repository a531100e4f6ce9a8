"""Metrics against brute force in numpy."""

import numpy as np
import pytest

from churnwright.operators import drift as d
from churnwright.operators import scoring as m
from churnwright.operators.quantiles import quantiles
from churnwright.session import ROWS_PER_CHUNK_KEY


def scored(rng, n=400, levels=37):
    y = (rng.random(n) < 0.3).astype(int)
    s = np.round((rng.random(n) + 0.3 * y) * levels) / levels
    return y, s


def frame(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")


@pytest.mark.parametrize("seed", [1, 2])
def test_curve_metrics(many_chunks, seed):
    y, s = scored(np.random.default_rng(seed))
    curve = m.threshold_curve(frame(many_chunks, y, s))
    got = m.evaluate(curve, 0.8).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean()
    thresholds = np.unique(s)[::-1]
    tp = np.array([((s >= t) & (y == 1)).sum() for t in thresholds])
    fp = np.array([((s >= t) & (y == 0)).sum() for t in thresholds])
    precision, recall = tp / (tp + fp), tp / y.sum()
    ap = np.sum(np.diff(np.concatenate([[0], recall])) * precision)
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert got["pr_auc"] == pytest.approx(ap, abs=1e-12)
    i = int(np.argmax(recall >= 0.8))
    assert got["threshold"] == pytest.approx(thresholds[i])
    assert got["recall"] == pytest.approx(recall[i]) and got["precision"] == pytest.approx(precision[i])
    assert got["tp"] + got["fn"] == y.sum() and got["fp"] + got["tn"] == (1 - y).sum()
    best = m.best_f1(curve).first()
    f1 = 2 * precision * recall / (precision + recall + 1e-12)
    assert best["f1"] == pytest.approx(f1.max())
    assert best["threshold"] == pytest.approx(min(thresholds[f1 == f1.max()]))


def test_mirrored_scores(spark):
    y, s = scored(np.random.default_rng(5))
    a = m.ranking_metrics(m.threshold_curve(frame(spark, y, s))).first()["roc_auc"]
    b = m.ranking_metrics(m.threshold_curve(frame(spark, y, -s))).first()["roc_auc"]
    assert a + b == pytest.approx(1.0)


def test_one_class_and_constant_score(spark):
    only = m.evaluate(m.threshold_curve(frame(spark, [0, 0, 0], [0.1, 0.2, 0.3]))).first()
    assert only["roc_auc"] is None and only["pr_auc"] is None and only["threshold"] == 0.0
    flat = m.evaluate(m.threshold_curve(frame(spark, [0, 1, 1, 0], [0.5] * 4))).first()
    assert flat["roc_auc"] == 0.5 and flat["pr_auc"] == 0.5 and flat["threshold"] == 0.5


def test_unreachable_target_gives_zeros(spark):
    t = m.threshold_at_recall(m.threshold_curve(frame(spark, [0, 0], [0.1, 0.2]))).first()
    assert (t["threshold"], t["recall"], t["precision"]) == (0.0, 0.0, 0.0)


def test_unknown_metric_is_refused(spark):
    with pytest.raises(ValueError):
        m.metric_set(frame(spark, [0, 1], [0.1, 0.9]), ["no_such_metric"])


def psi_numpy(e, a, buckets=10):
    cuts = np.unique(np.quantile(e, np.linspace(0, 1, buckets + 1)))
    count = lambda v: np.bincount(np.digitize(v, cuts[1:-1]), minlength=len(cuts) - 1) / len(v)
    p, q = np.maximum(count(e), 1e-6), np.maximum(count(a), 1e-6)
    return float(np.sum((q - p) * np.log(q / p)))


def ks_numpy(e, a):
    at = np.concatenate([e, a])
    cdf = lambda v: np.searchsorted(np.sort(v), at, side="right") / len(v)
    return float(np.abs(cdf(e) - cdf(a)).max())


@pytest.mark.parametrize("chunk", ["30", "1000000"])
def test_psi_and_ks(spark, chunk):
    rng = np.random.default_rng(9)
    base = {"x": np.round(rng.normal(size=500), 2), "y": rng.integers(0, 4, 500).astype(float)}
    cur = {w: {"x": np.round(rng.normal(0.1 * w, 1, size=200), 2), "y": rng.integers(0, 3, 200).astype(float)} for w in (1, 2, 3)}
    long = lambda side: [(f, float(v)) for f, vs in side.items() for v in vs]
    b = spark.createDataFrame(long(base), "feature string, value double")
    c = spark.createDataFrame([(w, f, v) for w, side in cur.items() for f, v in long(side)], "w int, feature string, value double")
    spark.conf.set(ROWS_PER_CHUNK_KEY, chunk)
    try:
        got = {(r["w"], r["feature"]): (r["psi"], r["ks"]) for r in d.drift_table(b, c, ["w"]).collect()}
        one = {r["feature"]: (r["psi"], r["ks"]) for r in d.drift_table(b, c.where("w = 2").drop("w")).collect()}
        raw = {r["feature"]: r["psi"] for r in d.psi(b, c.where("w = 2"), d.psi_edges(b)).collect()}
        same = d.drift_table(b, b).collect()
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_KEY)
    for w, side in cur.items():
        for f, vs in side.items():
            assert got[w, f] == pytest.approx((psi_numpy(base[f], vs), ks_numpy(base[f], vs)))
    for f in base:
        assert one[f] == pytest.approx(got[2, f]) and raw[f] == pytest.approx(got[2, f][0])
    assert all(r["psi"] == 0 and r["ks"] == 0 for r in same)


def test_psi_needs_ten_values(spark):
    b = spark.createDataFrame([("x", float(i)) for i in range(9)], "feature string, value double")
    c = spark.createDataFrame([("x", float(i)) for i in range(50)], "feature string, value double")
    assert d.drift_table(b, c).first()["psi"] is None


@pytest.mark.parametrize("chunk", ["10", "1000000"])
def test_quantiles(spark, chunk):
    rng = np.random.default_rng(3)
    groups = {"big": rng.lognormal(size=60000), "ties": rng.integers(0, 5, 30000).astype(float), "few": np.array([4.0, 1.0, 10.0]), "one": np.array([7.0])}
    pdf = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("few", float("nan")), ("few", None)]
    df = spark.createDataFrame(pdf, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.8, 0.999, 1.0]
    spark.conf.set(ROWS_PER_CHUNK_KEY, chunk)
    try:
        got = {r["g"]: (r["n"], list(r["q"])) for r in quantiles(df, "v", probs, ["g"]).collect()}
        whole = quantiles(df, "v", probs).first()
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_KEY)
    for g, vs in groups.items():
        assert got[g][0] == len(vs)
        assert got[g][1] == pytest.approx(list(np.quantile(vs, probs)))
    everything = np.concatenate(list(groups.values()))
    assert list(whole["q"]) == pytest.approx(list(np.quantile(everything, probs)))


def test_sketched_quantiles_are_near(spark):
    v = np.random.default_rng(4).normal(size=20000)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    q = quantiles(df, "v", [0.1, 0.5, 0.9], exact=False).first()["q"]
    ranks = [(v <= x).mean() for x in q]
    assert ranks == pytest.approx([0.1, 0.5, 0.9], abs=2e-3)


def test_metrics_ignore_the_partitioning(many_chunks):
    y, s = scored(np.random.default_rng(8), 600)
    df = frame(many_chunks, y, s)
    rows = [m.evaluate(m.threshold_curve(df.repartition(p))).first().asDict() for p in (1, 4, 17)]
    assert rows[0] == pytest.approx(rows[1]) and rows[0] == pytest.approx(rows[2])
