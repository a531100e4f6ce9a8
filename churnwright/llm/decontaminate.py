"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan per text.

Normalised means A-Z lowered and words of digits, letters and everything beyond
ASCII. An item's windows are its runs of 13 words; a shorter item is one window. The
automaton holds all windows between blanks, so matches begin and end at words. A
document word inside any occurrence of any window is hit. Normalising keeps every
byte in its place, so word numbers lead back to offsets in the original text.

The automaton is built in the tasks from the items of one block. Blocks hold windows
of about ``BLOCK_BYTES``; a benchmark that is larger is scanned block by block, and
the hits of a text are put together by its digest, so a task and the driver never
hold more than one block.

Rows: null texts have no words. Items without words match nothing. Repeated rows
give one output row each, repeated items count once. A null item_id counts as ''.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import filter_rows, map_rows, table, text_bytes

WINDOW = 13
BLOCK_BYTES = 4_000_000
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def windows(text: bytes, window: int = WINDOW) -> list[bytes]:
    """The windows of one item, as words between blanks."""
    words = text.translate(NORMAL).split()
    n = min(window, len(words))
    return [b" %s " % b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []


def automaton(items: list[tuple[str, bytes]], window: int = WINDOW) -> ahocorasick.Automaton:
    """Every window with its number of words and the items that hold it."""
    holders: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows(text, window):
            holders.setdefault(w, set()).add(item)
    found = ahocorasick.Automaton()
    for w, names in holders.items():
        found.add_word(w.decode("latin-1"), (w.count(b" ") - 1, sorted(names)))
    found.make_automaton()
    return found


def scan(found: ahocorasick.Automaton, text: bytes) -> tuple[int, list[int], list[str], list[int]]:
    """Words, numbers of the hit words, items, and (start, end) code points of the hit stretches."""
    normal = text.translate(NORMAL)
    words = normal.split()
    if not words or not len(found):
        return len(words), [], [], []
    line = b" %s " % b" ".join(words)
    hits = list(found.iter(line.decode("latin-1")))
    if not hits:
        return len(words), [], [], []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    marks = np.zeros(len(words) + 1, np.int64)
    names: set[str] = set()
    for (_, (n, items)), last in zip(hits, np.searchsorted(ends, [at for at, _ in hits]).tolist(), strict=True):
        marks[last - n + 1] += 1
        marks[last + 1] -= 1
        names.update(items)
    hit = np.cumsum(marks[:-1]) > 0
    letters = np.frombuffer(normal, np.uint8) != 32
    edges = np.diff(np.concatenate([[0], letters.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    turns = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, past = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    spans = np.stack([points[starts[first]], points[stops[past - 1]]], axis=1).ravel()
    return len(words), np.flatnonzero(hit).tolist(), sorted(names), spans.tolist()


def blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with the number of their block, and how many blocks there are."""
    named = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"), text_bytes(text_col).alias("text"))
    # a window starts at each word, and repeats about WINDOW words
    total = named.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(total * WINDOW / block_bytes))
    return named.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count))), count


def block_items(named: DataFrame, k: int) -> list[tuple[str, bytes]]:
    """The items of one block; its size is bounded."""
    return [(r.item, bytes(r.text)) for r in named.where(F.col("block") == k).select("item", "text").distinct().collect()]


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_words, hits, items, spans) for every row of ``docs``: hit words, items and places."""
    named, count = blocks(items, item_col, item_text, block_bytes)

    def scanner(k: int) -> Callable[[], Callable[[list], list[tuple]]]:
        held = block_items(named, k)

        def make() -> Callable[[list], list[tuple]]:
            found = automaton(held, window)
            return lambda texts: [scan(found, t) for t in texts]

        return make

    schema = "n_words bigint, hits array<int>, items array<string>, spans array<int>"
    if count == 1:
        return map_rows(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), scanner(0), schema)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col).alias("text")).withColumn("digest", F.sha2("text", 256))
    lengths = map_rows(rows.select("id", "digest", "text"), lambda: lambda texts: [(len(t.translate(NORMAL).split()),) for t in texts], "n_words bigint")
    parts = [map_rows(rows.select("digest", "text"), scanner(k), schema).where("size(items) > 0") for k in range(count)]
    met = parts[0]
    for part in parts[1:]:
        met = met.unionByName(part)
    flat = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    # the stretches of several blocks may overlap; each keeps its own pair
    met = met.groupBy("digest").agg(flat("hits").alias("hits"), flat("items").alias("items"), F.flatten(F.collect_set("spans")).alias("spans"))
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    return lengths.join(met, "digest", "left").select(
        F.col("id").alias(id_col), "n_words", none("hits", "array<int>"), none("items", "array<string>"), none("spans", "array<int>")
    )


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    named, count = blocks(items, item_col, item_text, block_bytes)
    if count > 1:
        keyed = docs.select(F.sha2(text_bytes(text_col), 256).alias("digest"), F.col(f"`{text_col}`").alias("text"))
        found = matches(keyed, items, "digest", "text", item_col, item_text, block_bytes=block_bytes)
        bad = found.where(is_contaminated(F.size("hits").cast("long"), F.col("n_words"))).select(F.col("digest").alias("__bad")).distinct()
        return docs.join(bad, F.sha2(text_bytes(text_col), 256) == F.col("__bad"), "left_anti")
    held = block_items(named, 0)

    def make() -> Callable[[list], list[bool]]:
        found = automaton(held)

        def clean(text: bytes) -> bool:
            n_words, hits, _, _ = scan(found, text)
            return not (hits and 20 * len(hits) >= n_words)

        return lambda texts: [clean(t) for t in texts]

    return filter_rows(docs, text_col, make)


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), s AS (
  SELECT item, least(13, len(ws)) AS n, ws, unnest(range(len(ws) - least(13, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0
), win AS (
  SELECT DISTINCT item, n, array_to_string(ws[i + 1:i + n], ' ') AS g FROM s
), starts AS (
  SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n
), hit AS (
  SELECT doc_id, i, starts.n, item FROM starts JOIN win ON win.n = starts.n AND win.g = array_to_string(ws[i + 1:i + starts.n], ' ')
), covered AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id
), names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN names USING (doc_id)
"""
