"""Quality by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are documents labelled 1; the unlabelled ones are any documents,
their labels unread. With class prior p the risk of calling unlabelled text bad is
``E_U[bad] - p E_P[bad]``, which cannot be below zero for a true classifier; where it
is, the step goes back against it. p is estimated from a first positive-or-unlabelled
classifier: the best positives' share of their kind that unlabelled text matches.

Inputs are shares of character kinds and signs of repetition over the whole text.
Positives and unlabelled texts are samples of about ``POSITIVES`` and ``UNLABELLED``
rows, chosen by hash. Labels 0 are never read.

Rows: null and empty texts have inputs of zero and get a score like any other.
Repeated rows give one output row each. Without positives every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Callable
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import map_rows, table, text_bytes
from churnwright.llm.learning import bounded_sample, fit_logistic, held_out, labelled_sample, logistic, with_texts

POSITIVES, UNLABELLED = 10_000, 20_000
PARTS, AT = 3, 1


def kinds() -> np.ndarray:
    """The kind of each byte: lower case and beyond ASCII, capital, digit, blank, line end, other control, each sign."""
    out = np.zeros(256, np.int64)
    for c in range(128):
        out[c] = 0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c == 32 else 4 if c == 10 else 5
    signs = [c for c in range(33, 127) if not chr(c).isalnum()]
    for i, c in enumerate(signs):
        out[c] = 6 + i
    return out


KINDS = kinds()
WIDTH = int(KINDS.max()) + 1


def features(text: bytes) -> list[float]:
    """Square roots of the shares of character kinds; repetition, word length and size."""
    codes = np.frombuffer(text, np.uint8)
    shares = np.sqrt(np.bincount(KINDS[codes], minlength=WIDTH) / max(1, len(codes)))
    words = text.split()
    n = max(1, len(words))
    lines = text.split(b"\n")
    again = sum(map(eq, words, words[1:])) / n
    return [*shares.tolist(), np.sqrt(again), len(set(words)) / n, 1 - len(set(lines)) / len(lines), np.log1p(len(codes) / n), np.log1p(len(words)) / 10]


def measured(rows: DataFrame) -> DataFrame:
    return map_rows(rows, lambda: lambda texts: [(features(t),) for t in texts], "x array<double>")


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The positives' share among unlabelled rows from scores of both: the least ratio of upper tails, with room for chance."""
    cuts = np.quantile(p, np.linspace(0.0, 0.9, 46))
    in_p = np.array([(p >= c).mean() for c in cuts])
    in_u = np.array([(u >= c).mean() for c in cuts])
    room = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(u)) + 1 / np.sqrt(len(p)))
    best = int(np.argmin((in_u + room) / in_p))
    return float(np.clip(in_u[best] / in_p[best], 0.01, 0.99))


def fit_nonnegative(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, penalty: float = 1e-4) -> np.ndarray:
    """Weights and intercept that minimise the non-negative risk under the logistic loss."""
    p, u = np.column_stack([p, np.ones(len(p))]), np.column_stack([u, np.ones(len(u))])
    w = np.zeros(p.shape[1])
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        called_bad = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        bad_slope = u.T @ logistic(zu) / len(u) - prior * (p.T @ logistic(zp)) / len(p)
        good_slope = -prior * (p.T @ logistic(-zp)) / len(p)
        slope = (good_slope + bad_slope if called_bad >= 0 else -bad_slope) + penalty * np.append(w[:-1], 0)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Scaling, weights and class prior, as plain values."""
    trusted = labelled_sample(labels.where(F.col("quality") == 1), "quality", PARTS, AT, positives, id_col)
    any_ids = bounded_sample(docs.select(F.col(f"`{id_col}`").alias("sample_id"), F.col(f"`{text_col}`").alias("text")), unlabelled)
    rows = bounded_sample(with_texts(docs, trusted, id_col, text_col), positives).select(F.lit(1).alias("p"), text_bytes())
    seen = measured(rows.unionByName(any_ids.select(F.lit(0).alias("p"), text_bytes()))).orderBy("p", "x").collect()
    p, u = (np.array([r.x for r in seen if r.p == kind]) for kind in (1, 0))
    if not len(p) or not len(u):
        return {"mean": [0.0], "scale": [1.0], "weights": [0.0], "prior": 0.5}
    mean, scale = u.mean(axis=0), u.std(axis=0) + 1e-3
    p, u = (p - mean) / scale, (u - mean) / scale
    mix = np.random.default_rng(7)
    mix.shuffle(p), mix.shuffle(u)
    a, b = len(p) // 2 or 1, len(u) // 2 or 1
    first = fit_logistic(np.concatenate([p[:a], u[:b]]), np.concatenate([np.ones(a), np.zeros(b)]))
    side = lambda x: x @ first[:-1] + first[-1]
    prior = class_prior(side(p[a:] if len(p) > 1 else p), side(u[b:] if len(u) > 1 else u))
    return {"mean": mean.tolist(), "scale": scale.tolist(), "weights": fit_nonnegative(p, u, prior).tolist(), "prior": prior}


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of ``docs``: the estimated probability of good text."""

    def make() -> Callable[[list], list[tuple]]:
        mean, scale, w = np.array(model["mean"]), np.array(model["scale"]), np.array(model["weights"])

        def score(texts: list) -> list[tuple]:
            if len(w) == 1:
                return [(0.5,) for _ in texts]
            x = (np.array([features(t) for t in texts]) - mean) / scale
            return [(float(s),) for s in logistic(x @ w[:-1] + w[-1])]

        return score

    return map_rows(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), make, "score double")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = scored(docs, learn(docs, table(spark, folder, "labels")))
    return found.select("doc_id", held_out("doc_id", PARTS, AT), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
