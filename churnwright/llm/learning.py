"""What the trained operators share: hold-out rule, bounded samples of labelled rows, small fits."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnwright.session import stage

GRAIN = 1 << 20
PICK = "__pick"


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(parts))


def held_out(id_col: str, parts: int, at: int) -> Column:
    """Whether a row is kept from learning; a null id is never learned from and not held out."""
    return F.coalesce(remainder(id_col, parts) == at, F.lit(False)).alias("held_out")


def labelled_sample(labels: DataFrame, label: str, parts: int, at: int, bound: int, id_col: str = "doc_id") -> DataFrame:
    """(id, y): about ``bound`` labelled ids that may be learned from, chosen by hash; an id labelled twice takes the larger label."""
    able = labels.where(F.col(f"`{label}`").isNotNull() & F.coalesce(remainder(id_col, parts) != at, F.lit(False)))
    one = able.groupBy(F.col(f"`{id_col}`").alias("sample_id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("y"))
    return bounded_sample(one, bound)


def bounded_sample(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` of the different rows, the same ones in every run; equal rows are one.

    A row is known by a 64-bit hash of all its columns, so many rows of one id, or of none, cannot exceed the bound. The
    different rows are estimated in one scan; a second keeps the hashes below twice the share asked for, and of
    those the smallest. Where that estimate is far off, fewer than ``bound`` may come, never more.
    """
    key = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.lit("sample"))
    distinct = rows.select(F.approx_count_distinct(key)).first()[0]
    share = min(1.0, (2 * bound + 64) / max(1, distinct))
    near = rows.withColumn(PICK, key).where(F.pmod(F.col(PICK), F.lit(GRAIN)) < math.ceil(share * GRAIN)).dropDuplicates([PICK])
    near = stage(near, "sample")
    cell = F.pmod(PICK, F.lit(GRAIN))
    cut = near.select(F.struct(cell.alias("cell"), F.col(PICK).alias("key")).alias("at")).orderBy("at").limit(bound).agg(F.max("at").alias("at")).first().at
    if cut is None:
        return near.drop(PICK)
    return near.where((cell < cut.cell) | ((cell == cut.cell) & (F.col(PICK) <= cut.key))).drop(PICK)


def by_hash(rows: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About ``bound`` rows, the same ones in every run, of rows whose ids are distinct."""
    share = min(1.0, bound / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit("sample")), F.lit(GRAIN)) < round(share * GRAIN))


def with_texts(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sample's rows with their texts; the sample is bounded, so it is sent to the texts.

    An id with many rows gives all of them: see ``bounded_sample`` for what is collected.
    """
    return docs.select(F.col(f"`{id_col}`").alias("sample_id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(sample), "sample_id")


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights and, last, the intercept of a ridge logistic regression by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty * len(x))
    ridge[-1] = 1e-6 * len(x)
    for _ in range(steps):
        p = logistic(x @ w)
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(curve, slope)
        w = w - np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return w
