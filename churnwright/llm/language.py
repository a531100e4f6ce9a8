"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed byte trigrams of its lowered letters: 1 + log counts
times inverse document frequency, at unit length. Document frequencies count every
document that may be learned from. Each language's centroids are spherical k-means
clusters of about ``PER_LANGUAGE`` of its documents, chosen by hash. The language of
the nearest centroid by cosine wins; ties go to the first by name. The score is the
softmax of the cosines. Texts farther from it than all but a hundredth of its own
documents are rejected: they keep the nearest language, are marked, and their score
is halved.

Rows: ``und`` with score 0 for null texts and texts without a letter, and where
nothing could be learned. Null languages are not learned from. Repeated rows give one
output row each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import map_rows, table, text_bytes
from churnwright.llm.learning import GRAIN, held_out, remainder

PARTS, AT = 4, 2
BITS = 11
PER_LANGUAGE = 600
CLUSTERS = 4
SHARPNESS = 40.0
FAR = 0.01

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
LETTER = re.compile(r"[^\W\d_]")


def counts(text: bytes) -> np.ndarray:
    """How often each hashed trigram of letters occurs; blanks stand around the text."""
    codes = np.frombuffer(b" %s " % text.translate(LETTERS), np.uint8).astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(1 << BITS)
    grams = codes[:-2] << np.uint32(16) | codes[1:-1] << np.uint32(8) | codes[2:]
    grams = grams[grams != 0x202020]
    return np.bincount((grams * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)


def vector(text: bytes, idf: np.ndarray) -> np.ndarray:
    n = counts(text)
    x = np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0) * idf
    return x / max(np.linalg.norm(x), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Texts, and in how many of them each hashed trigram occurs; added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[:-1] += counts(text) > 0
                total[-1] += 1
        if total[-1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["gram", "n"])

    rows = texts.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in rows:
        out[r.gram] = r.n
    return int(out[-1]), out[:-1]


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from farthest-first starts."""
    chosen = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        chosen.append(x[np.argmin(np.max(x @ np.array(chosen).T, axis=1))])
    centres = np.array(chosen)
    for _ in range(rounds):
        centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        own = np.argmax(x @ centres.T, axis=1)
        centres = np.array([x[own == i].mean(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Inverse document frequencies, centroids and rejection distances, as plain arrays."""
    able = docs.where(F.coalesce(remainder(id_col, PARTS) != AT, F.lit(False)) & F.col(f"`{lang_col}`").isNotNull())
    rows = able.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), text_bytes(text_col).alias("text"))
    n, df = document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    share = F.create_map(*[F.lit(v) for lang, size in sizes.items() for v in (lang, round(min(1.0, per_language / size) * GRAIN))]) if sizes else None
    if share is None:
        return {"langs": [], "idf": idf, "centres": np.zeros((0, 1 << BITS)), "of": [], "far": []}
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(GRAIN)) < share[F.col("lang")])

    def make() -> Callable[[list], list[tuple]]:
        return lambda texts: [(vector(t, idf).astype("<f4").tobytes(),) for t in texts]

    seen = map_rows(sample.select("id", "lang", "text"), make, "x binary").orderBy("id", "x").collect()
    langs = sorted({r.lang for r in seen})
    centres, of, far = [], [], []
    for i, lang in enumerate(langs):
        x = np.array([np.frombuffer(r.x, "<f4") for r in seen if r.lang == lang], dtype=float)
        own = cluster(x, CLUSTERS)
        centres.append(own)
        of += [i] * len(own)
        far.append(float(np.quantile(np.max(x @ own.T, axis=1), FAR)))
    return {"langs": langs, "idf": idf, "centres": np.concatenate(centres), "of": of, "far": far}


def predicted(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, cosine, rejected) for every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of arrays per language

    def make() -> Callable[[list], list[tuple]]:
        m = held.value
        langs, first = m["langs"], np.flatnonzero(np.diff([-1, *m["of"]]))

        def one(text: bytes) -> tuple[str, float, float, bool]:
            if not langs or not LETTER.search(text.decode("utf-8", "replace")):
                return "und", 0.0, 0.0, True
            near = np.maximum.reduceat(m["centres"] @ vector(text, m["idf"]), first)
            best = int(np.argmax(near))
            score = 1 / np.exp(SHARPNESS * (near - near[best])).sum()
            rejected = bool(near[best] < m["far"][best])
            return langs[best], float(score / 2 if rejected else score), float(near[best]), rejected

        return lambda texts: [one(t) for t in texts]

    return map_rows(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), make, "lang_pred string, score double, cosine double, rejected boolean")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return predicted(docs, learn(docs)).select("doc_id", held_out("doc_id", PARTS, AT), "lang_pred", "score", "rejected")
