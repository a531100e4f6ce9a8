"""The ordered scan equals a plain window, whatever the chunks, the partitioning and the skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnwright.operators.ordered import ordered_scan


def rows(spark, n=3000):
    # group 0 holds a third of the rows, group None some
    g = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(n).select(
        "id", g.cast("int").alias("g"), F.pmod(F.xxhash64("id"), F.lit(200)).alias("o"), F.when(F.col("id") % 5 != 0, F.col("id") * 2).alias("v")
    )


SPEC = dict(
    position="pos", before={"b": "v"}, through={"t": "v"}, totals={"s": "v"}, previous={"p": "v"}, following={"f": "v"}, first={"o1": "v"}, peak={"m": "v"}
)


def expected(df, by):
    part = Window.partitionBy(*(by or [F.lit(0)]))
    w = part.orderBy("o", "id")
    zero = lambda c: F.coalesce(c, F.lit(0))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "*",
        F.row_number().over(w).cast("long").alias("pos"),
        zero(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1))).alias("b"),
        zero(F.sum("v").over(upto)).alias("t"),
        zero(F.sum("v").over(part)).alias("s"),
        F.lag("v").over(w).alias("p"),
        F.lead("v").over(w).alias("f"),
        F.first("v").over(upto).alias("o1"),
        F.max("v").over(upto).alias("m"),
    )


@pytest.mark.parametrize("chunks", [1, 2, 7, 40])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_equals_window(spark, by, chunks):
    df = rows(spark)
    got, want = ordered_scan(df, ["o", "id"], by, chunks=chunks, **SPEC), expected(df, by)
    got = got.select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_partitioning_does_not_matter(spark, parts):
    df = rows(spark)
    a = ordered_scan(df, ["o", "id"], ["g"], chunks=9, **SPEC)
    b = ordered_scan(df.repartition(parts), ["o", "id"], ["g"], chunks=9, **SPEC)
    assert a.exceptAll(b).count() == 0


def test_empty_input(spark):
    assert ordered_scan(rows(spark).where("id < 0"), ["o", "id"], ["g"], chunks=5, **SPEC).count() == 0


def test_hot_group_is_spread(spark):
    """No chunk of the window holds more than a small part of one hot group."""
    df = spark.range(20000).withColumn("g", F.lit(1))
    from churnwright.operators import ordered as o

    cuts = o._cut_points(df, ["g", "id"], 16, 20000)
    sizes = [r["count"] for r in o._with_chunk(df, ["g", "id"], cuts, 16).groupBy(o.CHUNK).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 20000 / 4


def test_repeated_keys_stay_together(spark):
    df = spark.range(4000).withColumn("k", F.col("id") % 3)
    out = ordered_scan(df.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"], through={"t": "n"}, chunks=8)
    assert [r["t"] for r in out.orderBy("k").collect()] == [1334, 2667, 4000]
