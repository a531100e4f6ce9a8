"""Work that must not grow faster than the rows: what is staged, and how often a digest is made."""

import hashlib
import itertools

import numpy as np
from pyspark.sql import functions as F

from churnwright.llm import common
from churnwright.operators import gates, profiling


def test_a_row_is_digested_once_per_replicate(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(gates, "curve_of_counts", lambda rows, *rest: seen.append(rows) or rows)
    monkeypatch.setattr(gates, "ranking_metrics", lambda curve, by: curve.withColumns({"roc_auc": F.lit(0.0), "pr_auc": F.lit(0.0)}))
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"k{i}", i % 2, i / 50) for i in range(50)], "id int, name string, label int, score double")
    gates.bootstrap(rows, ["id", "name"], 6)
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    text = lambda i, r: "|".join(["42", str(r), str(i), *([] if i % 7 == 0 else [f"k{i}"])])
    weight = lambda i, r: sum(int(hashlib.md5(text(i, r).encode()).hexdigest()[:8], 16) >= s for s in gates.POISSON_STEPS)
    want = sorted((r, i / 50, weight(i, r)) for i in range(50) for r in range(1, 7) if weight(i, r))
    assert sorted((r.replicate, r.score, r._n) for r in seen[0].collect()) == want


def test_rank_correlations_stage_values_and_not_pairs(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    data = [[None if rnd.random() < 0.1 else float(v) for v in (rnd.random(), rnd.random(), rnd.random(), rnd.integers(5))] for _ in range(300)]
    data += [[1.0, None, None, None], [float("nan"), 0.5, 0.0, 1.0], [0.5, 0.25, -0.0, 1.0]]
    sizes, stage = [], profiling.stage

    def counted(df, label):
        out = stage(df, label)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(profiling, "stage", counted)
    got = {(r.a, r.b): r for r in profiling.rank_correlations(spark.createDataFrame(data, "a double, b double, c double, d double"), list("abcd")).collect()}
    assert max(sizes) <= 4 * len(data)  # a cell per pair and row was up to 6 times as many
    known = [[None if v is None or v != v else v for v in r] for r in data]
    mid = lambda v: [sum(o < a for o in v) + (sum(o == a for o in v) + 1) / 2 for a in v]
    for i, j in itertools.combinations(range(4), 2):
        both = [(r[i], r[j]) for r in known if r[i] is not None and r[j] is not None]
        r = got["abcd"[i], "abcd"[j]]
        assert r.n == len(both) and abs(r.r - np.corrcoef(*(mid([p[k] for p in both]) for k in (0, 1)))[0, 1]) < 1e-12
    assert profiling.rank_correlations(spark.createDataFrame([(1.0, None)], "a double, b double"), ["a", "b"]).collect() == []


def test_few_links_are_joined_without_rounds_over_all_partitions(spark, monkeypatch):
    tables, stage = [], common.stage
    monkeypatch.setattr(common, "stage", lambda df, label: tables.append(label) or stage(df, label))
    rnd = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(int(a), int(b)) for a, b in rnd.integers(-9000, -1, (400, 2))] + [(7, 7), (None, 5), (3, None)]
    low = {x: x for e in edges for x in e if x is not None}
    for _ in edges:
        for a, b in [e for e in edges if None not in e]:
            low[a] = low[b] = min(low[a], low[b])
        if all(low[a] == low[b] for a, b in edges if None not in (a, b)):
            break
    want = sorted((x, r) for x, r in low.items() if x != r)
    given = spark.createDataFrame(edges, "u bigint, v bigint").repartition(8)
    assert sorted(map(tuple, common.components(given).collect())) == want
    assert len(tables) == 2  # a table per round before, each by several shuffles: most of the disk where links are few
    for links in (8, 300):  # rounds to the end, or until few are left
        monkeypatch.setattr(common, "LINKS", links)
        assert sorted(map(tuple, common.components(given).collect())) == want
