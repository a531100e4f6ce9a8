"""Substring dedup by recompression: repeats of ``WINDOW`` words, wherever they start.

A word is removed if a window of 20 words that covers it also starts earlier, in a
document of smaller id or earlier in its own.

Recompression rewrites every text in rounds. A round names pairs: each symbol falls to
a left or a right side by its name, and a left one followed by a right one becomes one
symbol; then runs of equal symbols become one. A name is a hash of what it stands for,
so names are global without a table or a shuffle, and a stretch that occurs twice gets
the same symbols inside, but for those near its ends. For every symbol the words that
force it are known: its own and those of the neighbours that decided about it. Each
window picks the highest-level symbol forced by at most ``REACH`` words inside it, so
equal windows pick the same place. That place is named by its ``REACH`` words. A window
without any symbol is its own name.

Places whose name occurs once cannot lie in a repeated window. The others, with the
texts they are in, are brought together; the windows that picked them are named by 128
bits of their words. An equal window before it in its text, or in a document of smaller
id, decides. So the shuffles carry about one row for seven words, then one row for each
window with a shared place.

Names that very many documents share are added up before the shuffle and joined back,
so that one name is never collected in one task. Of equal texts only the first takes
part; the windows of the others all start earlier in it.

Rows: null texts have no words. Rows with a null id are left as they are and do not
count as earlier. Repeated rows of one id and text are judged alike. Rows that share an
id but not the text do not remove words from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import map_rows, pieces, table, text_bytes, written

WINDOW = 20
REACH = 8
LEVELS = 3
FAR = np.int64(1) << np.int64(40)
PLACE_BITS = np.uint64(24)
PLACES = np.uint64((1 << 24) - 1)
KEPT_WORDS = 400_000


class Names(dict):
    """64-bit names of words, kept between texts."""

    def __missing__(self, word: bytes) -> int:
        name = self[word] = xxhash.xxh64_intdigest(word)
        return name

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KEPT_WORDS:
            self.clear()
        if len(words) == 1:
            return np.array([self[words[0]]], np.uint64)
        return np.fromiter(itemgetter(*words)(self), np.uint64, len(words)) if words else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram(names: np.ndarray, starts: np.ndarray, n: int, base: int) -> np.ndarray:
    """The name of the ``n`` words from each start."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(n):
        out = out * np.uint64(base) + names[starts + k]
    return mixed(out)


GRAM, FIRST, SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def symbols(names: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, name, first forcing word, end of the forcing words) of all symbols made, round by round.

    ``doc`` numbers the text of each word; symbols never reach over two texts.
    """
    low = np.arange(len(names), dtype=np.int64)
    high = low + 1
    for level in range(1, LEVELS + 1):
        if len(names) < 2:
            return
        right = (mixed(names ^ np.uint64(level * GRAM & (1 << 64) - 1)) & np.uint64(1)).astype(bool)
        same_doc = doc[:-1] == doc[1:]
        pair = ~right[:-1] & right[1:] & same_doc
        first, second = np.append(pair, False), np.append(False, pair)
        # an unpaired left symbol is forced by what follows, an unpaired right one by what comes before
        after = np.append(np.where(same_doc, high[1:], FAR), FAR)
        before = np.append(-FAR, np.where(same_doc, low[:-1], -FAR))
        alone = ~first & ~second
        reach_low = np.where(alone & right, np.minimum(low, before), low)
        reach_high = np.where(alone & ~right, np.maximum(high, after), high)
        at = np.flatnonzero(first)
        joined = mixed(names[at] * np.uint64(FIRST) + mixed(names[at + 1]) + np.uint64(level))
        pair_low, pair_high = np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
        yield level, joined, pair_low, pair_high
        names = names.copy()
        names[at], reach_low[at], reach_high[at] = joined, pair_low, pair_high
        left = np.flatnonzero(~second)
        names, low, high, doc = names[left], reach_low[left], reach_high[left], doc[left]
        # runs of equal symbols; where a run begins and ends depends on both neighbours
        same_doc = doc[:-1] == doc[1:]
        before = np.append(-FAR, np.where(same_doc, low[:-1], -FAR))
        after = np.append(np.where(same_doc, high[1:], FAR), FAR)
        starts = np.flatnonzero(np.append(True, (names[:-1] != names[1:]) | ~same_doc))
        lengths = np.diff(np.append(starts, len(names)))
        ends = starts + lengths - 1
        runs = lengths > 1
        low, high = np.minimum(low[starts], before[starts]), np.maximum(high[ends], after[ends])
        names, doc = np.where(runs, mixed(names[starts] ^ mixed(lengths.astype(np.uint64) * np.uint64(SECOND))), names[starts]), doc[starts]
        yield level, names[runs], low[runs], high[runs]


def sliding_max(x: np.ndarray, n: int) -> np.ndarray:
    """The largest of each ``n`` neighbours."""
    width = 1
    while width * 2 <= n:
        x = np.maximum(x[:-width], x[width:])
        width *= 2
    return np.maximum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def places(names: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, name) of every place that some window picks; ``sizes`` are the texts' words.

    A place is its word's number in the text, with how far before it the first window
    that picks it starts, and how many more do, in the low bytes.
    """
    begins = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    n = len(names)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    local = np.arange(n) - begins[doc]
    value = np.zeros(n, np.uint64)
    for level, name, low, high in symbols(names, doc):
        near = high - low <= REACH
        at = low[near]
        # the level counts first, then the name, then the earlier place
        rank = (np.uint64(level) << np.uint64(62)) | ((name[near] >> np.uint64(26)) << PLACE_BITS) | (PLACES - local[at].astype(np.uint64) % (PLACES + np.uint64(1)))
        np.maximum.at(value, at, rank)
    best = sliding_max(value, WINDOW - REACH + 1)
    start = np.arange(n - WINDOW + 1)
    start = start[doc[start] == doc[start + WINDOW - 1]]
    best = best[start]
    own = best == 0
    ahead = ((PLACES - (best & PLACES)).astype(np.int64) - local[start]) % (1 << 24)
    picked = np.where(own, start, start + ahead)
    fresh = np.flatnonzero(np.append(True, (picked[1:] != picked[:-1]) | (own[1:] != own[:-1]))) if len(picked) else np.zeros(0, np.int64)
    first, more = start[fresh], np.diff(np.append(fresh, len(picked))) - 1
    picked, own = picked[fresh], own[fresh]
    key = np.zeros(len(picked), np.uint64)
    key[~own] = gram(names, picked[~own], REACH, GRAM)
    key[own] = gram(names, picked[own], WINDOW, GRAM)
    return doc[picked], local[picked] << 8 | (picked - first) << 4 | more, key


def window_names(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return gram(names, starts, WINDOW, FIRST), gram(mixed(names), starts, WINDOW, SECOND)


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, digest, n_words, plain, keys, at) for every row: its picked places with their names."""

    def make() -> Callable[[list], list[tuple]]:
        known = Names()

        def work(texts: list) -> list[tuple]:
            words = [t.split() for t in texts]
            sizes = np.array([len(w) for w in words], np.int64)
            names = known.of([w for own in words for w in own])
            doc, at, key = places(names, sizes)
            cuts = np.searchsorted(doc, np.arange(1, len(texts)))
            return [
                (len(w), hashlib.sha256(b" ".join(w)).hexdigest(), k.view(np.int64), a)
                for w, k, a in zip(words, np.split(key, cuts), np.split(at, cuts), strict=True)
            ]

        return work

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col).alias("text"))
    rows = rows.select("id", F.crc32("text").alias("mark"), F.unhex(F.md5("text")).alias("digest"), "text")
    return map_rows(rows, make, "n_words bigint, plain string, keys array<bigint>, at array<bigint>")


class Picked:
    """The windows of a batch of texts that picked the given places: where they start, their names, and which have an equal before them in their text."""

    def __init__(self, known: Names, spots: pa.Array, texts: list):
        self.words = [t.split() for t in texts]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.begins = np.cumsum(sizes) - sizes
        names = known.of([w for own in self.words for w in own])
        row = np.repeat(np.arange(len(texts)), spots.value_lengths().to_numpy(zero_copy_only=False))
        at = spots.flatten().to_numpy(zero_copy_only=False)
        first, n = (at >> 8) - (at >> 4 & 15) + self.begins[row], (at & 15) + 1
        self.starts = np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        self.starts.sort()
        self.row = np.searchsorted(self.begins, self.starts, side="right") - 1
        self.h1, self.h2 = window_names(names, self.starts)
        key = mixed(self.h1 + mixed(self.row.astype(np.uint64) + np.uint64(1)))
        _, earliest, back = np.unique(key, return_index=True, return_inverse=True)
        earliest = earliest[back]
        equal = (self.row == self.row[earliest]) & (self.h1 == self.h1[earliest]) & (self.h2 == self.h2[earliest])
        self.repeated = equal & (earliest < np.arange(len(key)))


def windows_of(near: DataFrame) -> DataFrame:
    """(id, mark, start, h1, h2) of every window that picked a shared place and has no equal before it in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Names()
        for batch in batches:
            for piece in pieces(batch):
                p = Picked(known, piece.column(2), piece.column(3).to_pylist())
                new = ~p.repeated
                row = pa.array(p.row[new])
                made = [pa.array((p.starts - p.begins[p.row])[new].astype(np.int32)), pa.array(p.h1[new].view(np.int64)), pa.array(p.h2[new].view(np.int64))]
                yield pa.RecordBatch.from_arrays([piece.column(0).take(row), piece.column(1).take(row), *made], names=["id", "mark", "start", "h1", "h2"])

    kind = dict(near.dtypes)["id"]
    return near.select("id", "mark", "at", "text").mapInArrow(run, f"id {kind}, mark bigint, start int, h1 bigint, h2 bigint")


def without(cut: DataFrame) -> DataFrame:
    """(id, mark, n_removed, kept): the words that no removed window covers, from (id, mark, at, starts, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Names()
        for batch in batches:
            for piece in pieces(batch):
                p = Picked(known, piece.column(2), piece.column(4).to_pylist())
                later = piece.column(3)
                row = np.repeat(np.arange(piece.num_rows), later.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                gone = np.union1d(p.starts[p.repeated], later.flatten().to_numpy(zero_copy_only=False) + p.begins[row])
                mask = np.zeros(sum(map(len, p.words)) + 1, np.int32)
                mask[gone] += 1  # each start once
                mask[gone + WINDOW] -= 1
                stays = np.cumsum(mask[:-1]) == 0
                removed, kept = [], []
                for words, begin in zip(p.words, p.begins.tolist(), strict=True):
                    own = stays[begin : begin + len(words)]
                    removed.append(int(len(words) - own.sum()))
                    kept.append(hashlib.sha256(b" ".join(compress(words, own.tolist()))).hexdigest())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["id", "mark", "n_removed", "kept"])

    kind = dict(cut.dtypes)["id"]
    return cut.select("id", "mark", "at", "starts", "text").mapInArrow(run, f"id {kind}, mark bigint, n_removed bigint, kept string")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) for every row of ``docs``."""
    seen = written(described(docs, id_col, text_col), "substring-places")
    firsts = seen.where("id is not null").groupBy("digest").agg(F.min("id").alias("first"))
    copy = F.coalesce((F.col("id") > F.col("first")) & (F.col("n_words") >= WINDOW), F.lit(False))
    base = written(seen.drop("keys", "at").join(firsts, "digest", "left").select("id", "mark", "n_words", "plain", copy.alias("copy")), "substring-base")
    same = (F.col("id") == F.col("i")) & (F.col("mark") == F.col("m"))
    renamed = lambda df, *more: df.select(F.col("id").alias("i"), F.col("mark").alias("m"), *more)

    # Names that occur twice are written down, so that the joins with them can split a name that very many rows have.
    spots = seen.where("id is not null").select("id", "mark", F.explode(F.arrays_zip("keys", "at")).alias("p")).select("id", "mark", F.col("p.keys").alias("key"), F.col("p.at").alias("at"))
    shared = written(spots.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("k")), "substring-shared")
    met = spots.join(shared, F.col("key") == F.col("k"), "left_semi").groupBy("id", "mark").agg(F.collect_set("at").alias("at"))
    met = met.join(renamed(base.where("not copy")), same, "left_semi")
    text = text_bytes(text_col)
    texts = docs.select(F.col(f"`{id_col}`").alias("i"), F.crc32(text).alias("m"), text.alias("text"))
    near = written(met.join(texts, same).select("id", "mark", "at", "text"), "substring-near")

    windows = windows_of(near)
    earliest = windows.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1")
    earliest = written(earliest.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), "low"), "substring-earliest")
    later = windows.join(earliest, (F.col("h1") == F.col("e1")) & (F.col("h2") == F.col("e2"))).where("id > low")
    starts = renamed(later.groupBy("id", "mark").agg(F.collect_set("start").alias("starts")), "starts")
    kept = without(near.join(starts, same, "left").select("id", "mark", "at", "starts", "text")).where("n_removed > 0")
    kept = renamed(kept, "n_removed", "kept").distinct()

    out = base.join(kept, same, "left")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept", "plain")).alias("kept_sha256"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return removed(table(spark, folder, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i + 1:i + 20], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(len(ws) - 19)) AS i FROM d WHERE len(ws) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM g) WHERE k > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, j: NOT list_contains(ps, j - 1)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
