"""What the corpus operators share: table access, Arrow maps over texts, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import churnwright.llm
from churnwright.session import stage

# Tasks get the functions of this package with the job, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(churnwright.llm)

BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4_000_000

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """The UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).cast("binary")


def short_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at ``BATCH_BYTES``, unless the session names less.

    A setting of the session, read when a plan starts: the buffers of a batch are held by the JVM and by the worker at once.
    """
    if int(spark.conf.get(BATCH_KEY).rstrip("bB") or 0) > BATCH_BYTES:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def map_rows(df: DataFrame, make: Callable[[], Callable[[list], list[tuple]]], schema: str) -> DataFrame:
    """Replace the last column, a text as bytes, by the columns ``schema`` names.

    ``make()`` runs once per task and returns a function from a list of byte
    strings to one tuple per string. The other columns pass through. Batches hold
    about 4 MB; where the session's batches are larger for another reason, they are cut into
    pieces of about 8 MB of text, so that a task's memory does not
    depend on how long the texts of a batch are.
    """
    short_batches(df.sparkSession)
    kept = df.columns[:-1]
    out = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    full = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out.fields), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        target = None
        for batch in batches:
            for piece in pieces(batch):
                columns = list(zip(*work(piece.column(piece.num_columns - 1).to_pylist()), strict=True))
                if target is None:
                    target = arrow_types(schema)
                made = [pa.array(values, kind) for values, kind in zip(columns, target.types, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *made], names=[*kept, *target.names])

    return df.mapInArrow(run, full)


def filter_rows(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows of ``df``, with all their columns, for whose text (as bytes, null as empty) the made function says so."""
    short_batches(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeps = make()
        for batch in batches:
            for piece in pieces(batch):
                texts = [t or b"" for t in piece.column(at).cast(pa.binary()).to_pylist()]
                yield piece.filter(pa.array(keeps(texts), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def arrow_types(schema: str) -> pa.Schema:
    """The Arrow types of a flat ``name type`` list."""
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
        "array<int>": pa.list_(pa.int32()),
        "array<bigint>": pa.list_(pa.int64()),
        "array<double>": pa.list_(pa.float64()),
        "array<string>": pa.list_(pa.string()),
        "array<binary>": pa.list_(pa.binary()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def pieces(batch: pa.RecordBatch, target: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``target`` bytes; a longer row is a slice of its own."""
    if batch.num_rows == 0:
        return
    width = max(1, batch.nbytes // batch.num_rows)
    step = max(1, target // width)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``stage`` that also frees the shuffle files of the write, as nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, "false")
    conf.set(FREE_SHUFFLES, "true")
    try:
        return stage(df, label)
    finally:
        conf.set(FREE_SHUFFLES, before)


LINKS = 250_000  # links that a task joins at once


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node of the edges (u, v) but the smallest of each group, which is its root."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, root[a], low)
        np.minimum.at(now, root[b], low)
        while (now[now] != now).any():
            now = now[now]
        root = now[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def joined_in_tasks(edges: DataFrame) -> DataFrame:
    """Edges (u, v) by which the same nodes are linked: those of a task give way to stars, ``LINKS`` at a time, so that its memory is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def joined() -> pa.RecordBatch:
            u, v = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(u, v)], names=["u", "v"])

        for batch in batches:
            held, rows = [*held, batch], rows + batch.num_rows
            if rows > LINKS:
                held = [joined()]
                rows = held[0].num_rows
                if rows > LINKS // 2:
                    yield held[0]
                    held, rows = [], 0
        if rows:
            yield joined()

    return edges.mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame, label: str = "component") -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), which are longs, but the roots: root is the smallest node reachable.

    Every task joins the edges that it holds into stars first. Where ``LINKS`` or fewer are left, one task joins those: a round over
    all partitions would be more work than the links. Where more are left, alternating large-star and small-star contractions go on: each
    step is a minimum per node, combined before the shuffle, and a join back, so a node with very many neighbours is neither collected
    nor paired with itself. Steps are written to the shared folder. Stops once neither step changes the edges, or few are left.
    """

    def best(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = both.join(best(both), "u").where("v > u")
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = down.join(best(down), "u")
        moved = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        return moved.select("e.u", "e.v")

    now = written(joined_in_tasks(edges.select("u", "v").where("u <> v")), label)
    left, seen, mark = now.count(), None, ()
    while left > LINKS and mark != seen:
        now, seen = written(small(large(now).where("u <> v").distinct()).where("u <> v").distinct(), label), mark
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        left = mark[0]
    if left <= LINKS:
        now = written(joined_in_tasks(now.coalesce(1)), label)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
