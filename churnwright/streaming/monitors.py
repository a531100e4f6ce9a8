"""Windowed monitors over streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.functions import count_where, known
from churnwright.operators.encoding import bin_index
from churnwright.operators.scoring import TARGET_RECALL, curve_of_counts, evaluate


def window_stats(events: DataFrame, ts: str, value: str, by: Sequence[str] = (), every: str = "4 hours") -> DataFrame:
    """``(start, end, by..., n, n_null, mean, min, max)`` per tumbling window; needs a watermark on ``ts``."""
    v = known(F.col(value).cast("double"))
    return (
        events.groupBy(F.window(ts, every).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"), count_where(v.isNull()).alias("n_null"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "n_null", "mean", "min", "max")
    )


def window_bins(long: DataFrame, ts: str, edges: DataFrame, every: str = "1 day") -> DataFrame:
    """``(start, feature, bin, k)``: counts per bin and window of a long stream ``(ts, feature, value)``.

    The baseline's ``edges`` are static, one row per feature. Bin counts add up, so they are what a
    stream keeps; PSI per window follows from them exactly, a KS value only at the bin edges.
    """
    placed = long.join(F.broadcast(edges.select("feature", "inner")), "feature")
    return (
        placed.groupBy(F.window(ts, every).alias("w"), "feature", bin_index(F.col("value"), F.col("inner")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("k"))
        .select(F.col("w.start").alias("start"), "feature", "bin", "k")
    )


def window_scores(scored: DataFrame, ts: str, label: str = "label", score: str = "score", every: str = "1 day") -> DataFrame:
    """``(start, score, label, n)``: counts per window, score and label of a scored stream with its truth.

    Counts add up, so they are what a stream keeps; ``scoring.curve_of_counts`` makes the exact threshold curve and with
    it every metric of a window.
    """
    counted = scored.groupBy(F.window(ts, every).alias("w"), known(F.col(score).cast("double")).alias("score"), F.col(label).alias("label"))
    return counted.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "score", "label", "n")


def keep_scores(batch: DataFrame, batch_id: int, path: str, ts: str, label: str = "label", score: str = "score", every: str = "1 day") -> None:
    """Add one micro-batch of scored rows with truth to the table of score counts.

    A batch writes the counts of its own rows under its number, so that a repeated batch replaces itself. Truth that comes
    late, in whatever later batch, adds to the counts of the window its prediction is in. ``newest`` is the latest event
    time that the batch saw.
    """
    newest = batch.groupBy().agg(F.max(ts).alias("t")).scalar()
    counted = window_scores(batch, ts, label, score, every).withColumn("newest", newest)
    counted.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


COUNTS = "start timestamp, score double, label long, n long, newest timestamp, batch int"


def window_quality(spark: SparkSession, path: str, every: str = "1 day", within: str = "0 seconds", target: float = TARGET_RECALL) -> DataFrame:
    """``scoring.evaluate`` for each closed window of the table that ``keep_scores`` adds to, with the batches that fed it.

    A window is closed when the newest event seen is at least ``within``, the time that truth may take, beyond its end.
    Counts of all batches are added up first, so a window is revised by simply reading again.
    """
    counts = spark.read.schema(COUNTS).parquet(path)
    seen = counts.groupBy().agg(F.max("newest").alias("t")).scalar()
    closed = counts.where(F.col("start") + F.expr(f"interval {every}") + F.expr(f"interval {within}") <= seen)
    fed = closed.groupBy("start").agg(F.count_distinct("batch").alias("n_batches"))
    summed = closed.groupBy("start", "score", "label").agg(F.sum("n").alias("n"))
    return evaluate(curve_of_counts(summed, "n", by=["start"]), target, ["start"]).join(fed, "start", "left")


def join_truth(predictions: DataFrame, truth: DataFrame, key: str, at: str, truth_at: str, within: str) -> DataFrame:
    """Stream-stream join of predictions with ground truth that arrives up to ``within`` later.

    Both sides carry watermarks; the time bound lets the state of either side expire.
    """
    in_time = (F.col(truth_at) >= F.col(at)) & (F.col(truth_at) <= F.col(at) + F.expr(f"interval {within}"))
    return predictions.join(truth, (predictions[key] == truth[key]) & in_time, "inner").drop(truth[key])
