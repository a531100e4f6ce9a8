"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Vectors of one label and length are compared by cosine. Equal vectors are one, with
its number of copies. The rest go to tiles of about ``TILE`` vectors that have the
nearest pivot in common; tiles whose centres are farther apart than their radii and
the threshold allow hold no link and are left out by the triangle inequality.

For two tiles the unit vectors are multiplied as int8 numbers: x = s q + e, so the
product is off by at most ``(1 + |e_x|) |e_y| + |e_x|``, with the error lengths known
exactly. Only pairs that the bound leaves possible are computed in double precision.
A tile pair returns link counts, and for each vector the smallest one that it reaches
inside the pair: never the pairs themselves, so dense groups cost no more rows.

Rows: a vector without a label or id, null, empty, zero, or with a null or non-finite
component links with nothing. Repeated rows are copies. Rows that share an id but not
the vector count the links of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import components, table
from churnwright.llm.learning import by_hash
from churnwright.session import stage

THRESHOLD = 0.98
TILE = 1024
PIVOTS = 256
SLACK = 1e-9  # for the rounding of the bounds themselves


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at unit length; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 numbers, scale and error length of each unit row."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows: single precision holds sums of 1,024 products."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        out += a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
    return out


def tile_links(a: dict, b: dict, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b that link, as two arrays of positions."""
    near = product(a["q"], b["q"]) * a["scale"][:, None] * b["scale"][None, :]
    bound = (1 + a["error"][:, None]) * b["error"][None, :] + a["error"][:, None] + SLACK
    i, j = np.nonzero(near + bound >= threshold)
    if same:
        i, j = i[i < j], j[i < j]
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 50_000):
        x, y = a["x"][i[at : at + 50_000]], b["x"][j[at : at + 50_000]]
        x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
        cosine = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
        keep[at : at + 50_000] = cosine >= threshold
    return i[keep], j[keep]


def lowest(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each position reaches over the links."""
    low = ids.copy()
    while True:
        before = low.copy()
        np.minimum.at(low, i, before[j])
        np.minimum.at(low, j, low[i])
        if (low == before).all():
            return low


def unpack(row: dict, side: str) -> dict:
    """A tile's arrays from its row."""
    n = row[f"{side}_n"]
    x = np.frombuffer(row[f"{side}_x"], "<f4" if row["single"] else "<f8").reshape(n, -1).astype(float)
    q, scale, error = quantised(unit(x))
    return {
        "ids": np.frombuffer(row[f"{side}_ids"], "<i8"),
        "copies": np.frombuffer(row[f"{side}_copies"], "<i8"),
        "x": x,
        "q": q,
        "scale": scale,
        "error": error,
    }


def tiles(reps: DataFrame, tile: int = TILE, pivots: int = PIVOTS) -> DataFrame:
    """One row per tile: its vectors, ids and copies, a centre and the angle around it that holds them all.

    ``reps`` has (label, dim, vector, rep, copies).
    """
    spark = reps.sparkSession
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    wanted = min(pivots, max(1, math.ceil(largest / tile)))
    chosen = [r.vector for r in by_hash(reps.select("rep", "vector"), "rep", wanted).orderBy("rep").collect()]
    by_dim: dict[int, np.ndarray] = {}
    for d in {len(v) for v in chosen}:
        by_dim[d] = unit(np.array([v for v in chosen if len(v) == d], dtype=float))
    held = spark.sparkContext.broadcast(by_dim)  # at most about PIVOTS vectors

    def nearest(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), np.int32)
        for d, at in vectors.groupby(vectors.map(len)).groups.items():
            if d in held.value:
                x = unit(np.array(vectors[at].tolist(), dtype=float))
                out[vectors.index.get_indexer(at)] = np.argmax(x @ held.value[d].T, axis=1)
        return pd.Series(out)

    placed = stage(reps.withColumn("pivot", F.pandas_udf(nearest, "int")("vector")), "vectors")
    cells = placed.groupBy("label", "dim", "pivot").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))
    cell = ["label", "dim", "pivot"]
    chunked = placed.join(cells, cell).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    chunked = chunked.repartition(*cell, "chunk")  # or a large cell would stay in the one task that its join needed
    single = dict(reps.dtypes)["vector"] == "array<float>"

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep")
        x = np.array(rows["vector"].tolist(), dtype="<f4" if single else "<f8")
        u = unit(x.astype(float))
        centre = u.mean(axis=0)
        centre = centre / max(np.linalg.norm(centre), 1e-12) if np.linalg.norm(centre) > 1e-9 else u[0]
        angle = float(np.arccos(np.clip(u @ centre, -1, 1)).max())
        made = {
            "label": key[0], "dim": key[1], "tile": f"{key[2]}-{key[3]}", "n": len(x), "ids": rows["rep"].to_numpy("<i8").tobytes(),
            "copies": rows["copies"].to_numpy("<i8").tobytes(), "x": x.tobytes(), "single": single, "centre": [centre.tolist()], "angle": angle,
        }
        return pd.DataFrame(made, index=[0])

    kind = dict(reps.dtypes)["label"]
    schema = f"label {kind}, dim int, tile string, n int, ids binary, copies binary, x binary, single boolean, centre array<double>, angle double"
    return chunked.groupBy(*cell, "chunk").applyInPandas(pack, schema)


def linked(reps: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(rep, links, low) per vector and tile pair in which it links: copies linked, and the smallest rep reached."""
    packed = stage(tiles(reps, tile), "tiles")
    outline = packed.select("label", "dim", "tile", "centre", "angle")
    a = outline.select("label", "dim", F.col("tile").alias("a"), F.col("centre").alias("ca"), F.col("angle").alias("ra"))
    b = outline.select("label", "dim", F.col("tile").alias("b"), F.col("centre").alias("cb"), F.col("angle").alias("rb"))
    cosine = F.aggregate(F.zip_with("ca", "cb", lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    pairs = a.join(b, ["label", "dim"]).where("a <= b").where(apart <= F.col("ra") + F.col("rb") + math.acos(threshold) + 1e-6).select("label", "dim", "a", "b")
    side = lambda s: packed.select("label", "dim", F.col("tile").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "ids", "copies", "x", "single")])
    both = pairs.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"]).withColumn("single", F.col("a_single"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                left, right, same = unpack(row, "a"), unpack(row, "b"), row["a"] == row["b"]
                i, j = tile_links(left, right, same, threshold)
                if not len(i):
                    continue
                ids = left["ids"] if same else np.concatenate([left["ids"], right["ids"]])
                copies = left["copies"] if same else np.concatenate([left["copies"], right["copies"]])
                j = j if same else j + len(left["ids"])
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                low = lowest(i, j, ids)
                on = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(links[on]), pa.array(low[on])], names=["rep", "links", "low"])

    return both.select("a", "b", "single", *[f"{s}_{c}" for s in "ab" for c in ("n", "ids", "copies", "x")]).mapInArrow(run, "rep bigint, links bigint, low bigint")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = TILE
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"), F.col(f"`{label_col}`").alias("label"))
    if dict(rows.dtypes)["vector"] != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    inf = float("inf")
    sound = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != inf)
    able = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", sound) & F.exists("vector", lambda v: v != 0)
    able = F.coalesce(able, F.lit(False))
    reps = stage(
        rows.where(able).groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).withColumn("dim", F.size("vector")), "vector-reps"
    )
    found = stage(linked(reps, threshold, tile), "vector-links")
    roots = components(found.select(F.col("rep").alias("u"), F.col("low").alias("v")), "vector-components")
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = reps.join(sums, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    named = named.select(
        F.col("label").alias("l"), F.col("vector").alias("v"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "rep").alias("c")
    )
    given = rows.withColumn("able", able)
    met = given.where("able").join(named, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v"))).select("id", "n", "c")
    alone = given.where("not able").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("c"))
    out = met.unionByName(alone)
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_links"), F.col("c").alias("component_id"), F.coalesce(F.col("id") == F.col("c"), F.lit(False)).alias("kept")
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), walk AS (
  SELECT u, v FROM link
  UNION
  SELECT walk.u, link.v FROM walk JOIN link ON walk.v = link.u
), counts AS (SELECT u, count(*) AS n FROM link GROUP BY u)
, low AS (SELECT u, min(v) AS m FROM walk GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings e LEFT JOIN counts ON counts.u = vec_id LEFT JOIN low ON low.u = vec_id
"""
