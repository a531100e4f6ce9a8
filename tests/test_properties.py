"""Properties that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnwright.operators import drift, scoring
from churnwright.operators.ordered import ordered_scan

LOOSE = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@LOOSE
@given(rows=hs.lists(hs.tuples(hs.integers(0, 2), hs.integers(-5, 5)), min_size=1, max_size=60), chunks=hs.integers(2, 9))
def test_scan_equals_window(spark, rows, chunks):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g int, v int")
    got = ordered_scan(df, ["v", "id"], ["g"], position="p", before={"b": "v"}, following={"f": "id"}, chunks=chunks)
    w = Window.partitionBy("g").orderBy("v", "id")
    want = df.select(
        "id", "g", "v", F.row_number().over(w).cast("long").alias("p"),
        F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"), F.lead("id").over(w).alias("f"),
    )
    assert got.count() == len(rows) and got.select(want.columns).exceptAll(want).count() == 0


@LOOSE
@given(rows=hs.lists(hs.tuples(hs.integers(0, 1), hs.integers(0, 9)), min_size=2, max_size=50))
def test_auc_of_mirrored_scores(spark, rows):
    df = spark.createDataFrame([(y, s / 10) for y, s in rows], "label int, score double")
    a = scoring.ranking_metrics(scoring.threshold_curve(df)).first()["roc_auc"]
    b = scoring.ranking_metrics(scoring.threshold_curve(df.withColumn("score", -F.col("score")))).first()["roc_auc"]
    assert (a is None and b is None) or abs(a + b - 1) < 1e-12


@LOOSE
@given(a=hs.lists(hs.integers(0, 20), min_size=10, max_size=50), b=hs.lists(hs.integers(0, 20), min_size=10, max_size=50))
def test_drift_is_bounded(spark, a, b):
    frame = lambda v: spark.createDataFrame([("x", float(i)) for i in v], "feature string, value double")
    row = drift.drift_table(frame(a), frame(b)).first()
    assert 0 <= row["ks"] <= 1 and row["psi"] >= 0
