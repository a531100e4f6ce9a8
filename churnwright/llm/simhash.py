"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; bit i is set if it is set in over half of the XXH64
hashes (seed 42) of the text's word shingles. Fingerprints link at ``radius`` 4 or
fewer differing bits.

Two fingerprints within 4 bits have a value half-way: within 2 bits of both. So every
fingerprint emits the variants within half the radius, and those that meet on a
variant are linked. All that meet on one variant are within 4 bits of each other,
so a star from the smallest links them all: there are no pairs to lose and none to
multiply, however large the group.

A full ball has 2,081 variants, most of them for nothing, as most fingerprints have
no neighbour. A first, narrower ball finds out what can matter:

1. The 64 bits are three blocks. Of 4 differing bits at most 2 lie outside the
   worst block, so on the other two blocks (42 or 43 bits) the pair is within 2, and
   meets on a variant within 1: 131 variants per fingerprint.
2. Those that meet there are compared with the smallest of them. What is within the
   radius is linked, and linked ones become one group. A variant whose fingerprints
   are all in one group has nothing left to find; most are done here.
3. On the others, up to ``DIRECT`` fingerprints are compared with each other, inside
   their row. Where more meet, the bits in which they differ are noted: a linked pair
   differs only in such bits, so the ball of radius 2 over those bits is enough.

``keep_first`` takes out near copies by the similarity of their word shingles. Fingerprints of
shingles move too far for that (five words are lost for each one changed), so its first candidates
come from two fingerprints of the words, by the same ball. That finds the bulk cheaply but not all:
an added passage moves too many bits. The second source is complete: of two texts of n distinct
shingles or fewer with a similarity of 0.8, each shares one of its first n - ceil(0.8 n) + 1 with the
other's, in any order of shingles that holds for all texts. The order here puts those last that are
frequent in a share of the texts that does not fall as they grow more, so that common passages do not bring texts together.

A candidate is first judged by bitmaps: bit i says whether an odd number of the text's shingles fall on it. A shingle that only
one of two texts has changes one bit, so bitmaps differ in no more bits than the sets in shingles; where they differ in more
than a similarity of 0.8 allows, the pair is none. That loses no pair and is asked inside the join. All others are compared by their words.

Rows: null and empty texts have the fingerprint zero and link like any other.
Repeated rows and doc_ids give one output row each. A null doc_id keeps its row and
does not name a component unless nothing else does.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnwright.llm.common import LOWER, components, map_rows, pieces, table, text_bytes, written
from churnwright.llm.learning import by_hash
from churnwright.operators.lookups import lookup
from churnwright.session import stage

RADIUS = 4
SEED = 42
BLOCKS = ((0, 21), (21, 42), (42, 64))
SHARE, SAMPLE = 4, 10_000  # one of so many texts is asked for frequent shingles, but not fewer than so many
FREQUENT, NAMED = 4, 500_000  # how often a shingle is there, and how many are told to the tasks
FEW = 8  # pairs per text up to which all are compared at once
WORDS = 8  # of 64 bits in a bitmap of shingles
DIRECT = 64  # fingerprints on a narrow variant up to which they are compared with each other instead of making balls
PAIRS, TURNS = 1, 1  # open pairs per row of shared shingles from which on stars go first, and for how many turns at least


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = hashes[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint as a signed long."""

    def make() -> Callable[[list], list[tuple]]:
        return lambda texts: [(signed(fingerprint(t, shingle)),) for t in texts]

    return map_rows(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), make, "fp bigint")


def narrow_variants() -> list[tuple[int, int]]:
    """(bits kept, bits flipped) of the 131 variants on two of three blocks.

    The left-out block is zero in the key and there carries the number of its kind.
    """
    out = []
    for kind, (low, high) in enumerate(BLOCKS):
        keep = sum(1 << b for b in range(64) if not low <= b < high)
        tag = (kind + 1) << low
        out += [(keep, tag)] + [(keep, tag | 1 << b) for b in range(64) if keep >> b & 1]
    return [(signed(k), signed(f)) for k, f in out]


def apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def narrow_keys(fps: DataFrame) -> DataFrame:
    """(key, fp, n, low): the narrow variants on which two fingerprints or more meet, how many do, and the smallest of them."""
    made = F.array(*[F.struct(F.lit(k).alias("keep"), F.lit(f).alias("flip")) for k, f in narrow_variants()])
    # spread first, as one row becomes 131; dealt by key before counting, as hardly any key is there twice in a task
    spread = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    each = spread.select("fp", F.explode(F.transform(made, lambda v: F.col("fp").bitwiseAND(v.keep).bitwiseXOR(v.flip))).alias("key")).repartition("key")
    met = written(each.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("low")).where("n > 1"), "simhash-met")
    return written(lookup(each, met, ["key"], how="inner").select("key", "fp", "n", "low"), "simhash-narrow")


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): pairs of fingerprints within ``radius`` bits by which all that are linked can be reached from each other."""
    keys = narrow_keys(fps)
    stars = written(keys.where((F.col("fp") != F.col("low")) & (apart(F.col("fp"), F.col("low")) <= radius)).select(F.col("fp").alias("u"), F.col("low").alias("v")).distinct(), "simhash-stars")
    roots = components(stars, "simhash-groups").select(F.col("node").alias("fp"), "root")
    now = lookup(keys.select("key", "fp", "n"), written(roots, "simhash-roots"), ["fp"]).withColumn("root", F.coalesce("root", "fp"))
    now = written(now, "simhash-rooted")
    same = now.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("apart"))
    mixed = written(same.where("least <> most").select("key", "apart"), "simhash-mixed")
    left = written(lookup(now, mixed, ["key"], how="inner"), "simhash-open")
    masks = left.where(F.col("n") > DIRECT).groupBy("fp").agg(F.bit_or("apart").alias("mask"))
    return stars.unionByName(direct_links(left.where(F.col("n") <= DIRECT), radius)).unionByName(ball_links(masks, radius)).distinct()


def direct_links(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): the linked pairs among the few fingerprints of a key that are in different groups; nothing leaves a key but links."""
    held = rows.groupBy("key").agg(F.collect_list(F.struct("fp", "root")).alias("all"))
    linked = lambda x: F.filter("all", lambda y: (y.fp < x.fp) & (y.root != x.root) & (apart(x.fp, y.fp) <= radius))
    pairs = F.flatten(F.transform("all", lambda x: F.transform(linked(x), lambda y: F.struct(x.fp.alias("u"), y.fp.alias("v")))))
    return held.select(F.explode(pairs).alias("e")).select("e.u", "e.v")


def ball_links(masks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): stars over the variants within two bits of ``mask``, verified."""
    one = F.lit(1).cast("long")
    shift = lambda b: F.call_function("shiftleft", one, b.cast("int"))
    bits = masks.select("fp", F.filter(F.transform(F.sequence(F.lit(0), F.lit(63)), shift), lambda b: F.col("mask").bitwiseAND(b) != 0).alias("bits"))
    flips = F.concat(
        F.array(F.lit(0).cast("long")),
        F.col("bits"),
        F.flatten(F.transform("bits", lambda b, i: F.transform(F.slice("bits", i + 2, F.size("bits")), lambda c: b.bitwiseOR(c)))),
    )
    balls = written(bits.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("variant")), "simhash-balls")
    heads = written(balls.groupBy("variant").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n"), "simhash-heads")
    star = lookup(balls, heads, ["variant"], how="inner").where("fp <> low").select("fp", "low").distinct()
    return star.where(apart(F.col("fp"), F.col("low")) <= radius).select(F.col("fp").alias("u"), F.col("low").alias("v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp, component_id) for every row: component_id is the smallest id reachable over links."""
    rows = stage(with_fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "id"), "simhash")
    fps = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-fps")
    found = components(near_links(fps), "simhash-links")
    rooted = fps.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("f"), "component_id")
    return rows.join(named, F.col("fp") == F.col("f"), "left").select(F.col("id").alias(id_col), "fp", "component_id")


def word_fingerprints(text: bytes) -> tuple[int, int]:
    """Two fingerprints of the distinct words, each weighted by 1 + the log of its count: a changed word moves few bits."""
    counts = Counter(text.translate(LOWER).split())
    if not counts:
        return 0, 0
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, counts, repeat(SEED)), np.uint64, len(counts))
    weights = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    out = []
    for h in (hashes, mixed(hashes)):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out.append(int.from_bytes(np.packbits(weights @ bits * 2 > weights.sum(), bitorder="little").tobytes(), "little"))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def similarity(a: bytes, b: bytes, shingle: int) -> float:
    """Jaccard similarity of the sets of word shingles; a text of fewer words is one shingle."""

    def grams(text: bytes) -> set[bytes]:
        words = text.translate(LOWER).split()
        return set(map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))) or {b" ".join(words)}

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (u, v) of ids whose texts (id, text) are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                near = [similarity(a, b, shingle) >= least for a, b in zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True)]
                yield piece.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(run, both.select("u", "v").schema)


class WordHashes(dict):
    """Hashes of words, each made once; emptied at a fixed size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = made = xxhash.xxh64_intdigest(word, SEED)
        return made


def shingle_hashes(text: bytes, shingle: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of ``similarity`` as sorted 64-bit hashes."""
    words = text.translate(LOWER).split()
    if len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED + 1)], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - shingle + 1
    out = np.zeros(n, np.uint64)
    for i in range(shingle):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


def prefix(grams: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """The shingles of which a text shares one with every text of a similarity of ``least`` or more, in the order that holds for all."""
    n = len(grams)
    keys, counts = frequent
    if len(keys):
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        grams = grams[np.argsort(np.where(keys[at] == grams, counts[at], 0), kind="stable")]
    return grams[: n - math.ceil(least * n - 1e-9) + 1]


def bitmap(grams: np.ndarray) -> list[int]:
    """For each of 64 * ``WORDS`` equal ranges of hashes whether an odd number of shingles is there."""
    width = 64 * WORDS
    odd = np.bincount((grams >> np.uint64(64 - (width.bit_length() - 1))).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def frequent_shingles(named: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of shingles that occur in ``FREQUENT`` or more of a share of the texts; only the order of shingles depends on it."""

    def make() -> Callable[[list], list[tuple]]:
        hashes = WordHashes()
        return lambda texts: [(shingle_hashes(t, shingle, hashes).view(np.int64).tolist(),) for t in texts]

    asked = by_hash(named.select("id", "text"), "id", max(SAMPLE, named.count() // SHARE))
    grams = map_rows(asked, make, "grams array<bigint>")
    counted = grams.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
    rows = written(counted, "copies-frequent").orderBy(F.desc("n"), "gram").limit(NAMED).toArrow()
    keys = rows.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows.column("n").to_numpy()[order]


def distinct_texts(named: DataFrame, shingle: int, least: float) -> DataFrame:
    """(node, id, digest, fp0, fp1, n, bits, grams): a number for each distinct text of (id, digest, text), its smallest id, fingerprints, bitmap and prefix."""
    held = named.sparkSession.sparkContext.broadcast(frequent_shingles(named, shingle))

    def make() -> Callable[[list], list[tuple]]:
        hashes, frequent = WordHashes(), held.value

        def one(text: bytes) -> tuple:
            grams = shingle_hashes(text, shingle, hashes)
            return *map(signed, word_fingerprints(text)), len(grams), bitmap(grams), prefix(grams, frequent, least).view(np.int64).tolist()

        return lambda texts: [one(t) for t in texts]

    seen = map_rows(named.select("id", "digest", "text"), make, "fp0 bigint, fp1 bigint, n int, bits array<bigint>, grams array<bigint>")
    once = seen.groupBy("digest").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("fp0", "fp1", "n", "bits", "grams")])
    return written(once.select(F.monotonically_increasing_id().alias("node"), "id", "digest", "fp0", "fp1", "n", "bits", "grams"), "copies-texts")


def ball_pairs(once: DataFrame) -> DataFrame:
    """(u, v): for a node the least one that the ball links it to, in either kind of word fingerprint; ``shared_shingles`` is complete without."""
    pairs = None
    for name in ("fp0", "fp1"):
        fps = written(once.groupBy(F.col(name).alias("fp")).agg(F.min("node").alias("first")), "copies-fps")
        first = lambda c, fps=fps: fps.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_node"))
        across = near_links(fps).join(first("u"), "u").join(first("v"), "v").select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))
        within = once.join(fps, F.col(name) == F.col("fp")).where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
        both = across.unionByName(within).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        both = written(both.groupBy("u").agg(F.min("v").alias("v")), "copies-ball")
        pairs = both if pairs is None else pairs.unionByName(both)
    return pairs.distinct()


def shared_shingles(once: DataFrame) -> DataFrame:
    """(gram, node, n, at): the prefix shingles that two texts or more have, and their places in the prefix."""
    each = once.select("node", "n", F.posexplode("grams").alias("at", "gram"))
    count = F.count("*").over(Window.partitionBy("gram"))
    return written(each.select("gram", "node", "n", "at", count.alias("texts")).where("texts > 1").drop("texts"), "copies-shared")


def can_reach(a: str, b: str, least: float) -> Column:
    """Whether texts whose first common shingle in the order is at these places can be similar: it and all that follow are the most they share."""
    col = lambda side, c: F.col(f"{side}.{c}")
    most = F.least(col(a, "n") - col(a, "at"), col(b, "n") - col(b, "at"))
    return most * (1 + least) >= (col(a, "n") + col(b, "n")) * least - 1e-6


def can_be_similar(a: str, b: str, least: float) -> Column:
    """``can_reach``, and whether the bitmaps differ in no more bits than the shingles of similar texts can."""
    col = lambda side, c: F.col(f"{side}.{c}")
    differ = sum((F.bit_count(F.get(col(a, "bits"), F.lit(i)).bitwiseXOR(F.get(col(b, "bits"), F.lit(i)))) for i in range(WORDS)), F.lit(0))
    return can_reach(a, b, least) & (differ * (1 + least) <= (col(a, "n") + col(b, "n")) * (1 - least) + 1e-6)


def with_bits(rows: DataFrame, once: DataFrame) -> DataFrame:
    """``rows`` (gram, node, n, at, root) as ``x`` beside their shingle, with the bitmaps of their texts."""
    bits = once.select(F.col("node").alias("__node"), "bits")
    return rows.join(bits, F.col("node") == F.col("__node")).select("gram", F.struct("node", "n", "at", "root", "bits").alias("x"))


def joined_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with the root of the group that each is in so far."""
    known = roots.select(F.col("node").alias("__node"), "root")
    return nodes.join(known, F.col("node") == F.col("__node"), "left").drop("__node").withColumn("root", F.coalesce("root", "node"))


def linked(pairs: DataFrame, once: DataFrame, named: DataFrame, roots: DataFrame | None, shingle: int, least: float) -> DataFrame:
    """(node, root): the groups ``roots`` grown by those of the pairs (u, v) of nodes that are similar."""
    pairs = written(pairs, "copies-pairs")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    places = once.select("node", F.col("id").alias("__id"), F.col("digest").alias("__digest")).join(wanted, "node")
    texts = named.join(places, (F.col("id") == F.col("__id")) & (F.col("digest") == F.col("__digest"))).dropDuplicates(["node"])
    texts = written(texts.select(F.col("node").alias("id"), "text"), "copies-compared")
    links = written(verified(pairs, texts, shingle, least), "copies-similar")
    if roots is not None:
        links = links.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
    return components(links, "copies-links")


def settled(pairs: DataFrame, once: DataFrame, named: DataFrame, roots: DataFrame, shingle: int, least: float) -> DataFrame:
    """``linked``, where there are many pairs per text: each text is compared with one other first, which joins most groups; pairs inside a group are done."""
    pairs = written(pairs, "copies-candidates")
    size, turn = pairs.count(), 0
    while size > FEW * pairs.select("u").distinct().count():
        roots = linked(pairs.groupBy("u").agg(F.min_by("v", F.xxhash64("u", "v", F.lit(turn))).alias("v")), once, named, roots, shingle, least)
        now = joined_roots(joined_roots(pairs.withColumnRenamed("u", "node"), roots).withColumnsRenamed({"node": "u", "root": "root_u", "v": "node"}), roots)
        pairs = written(now.where("root_u <> root").select("u", F.col("node").alias("v")), "copies-candidates")
        before, size, turn = size, pairs.count(), turn + 1
        if size > before / 2:
            break
    return linked(pairs, once, named, roots, shingle, least)


def mixed_shingles(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of shared shingles whose texts are in more than one group, with their roots."""
    now = joined_roots(shared.select("gram", "node", "n", "at"), roots)
    same = Window.partitionBy("gram")
    marked = now.select("*", F.min("root").over(same).alias("low"), F.max("root").over(same).alias("high"))
    return written(marked.where("low <> high").select("gram", "node", "n", "at", "root"), "copies-open")


def open_size(rows: DataFrame) -> tuple[int, float]:
    """(rows, pairs): how many rows there are, and how many pairs of them share a shingle and are in different groups."""
    per_root = rows.groupBy("gram", "root").agg(F.count("*").cast("double").alias("c"))
    per_gram = per_root.groupBy("gram").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("own"))
    found = per_gram.agg(F.sum("m").alias("rows"), F.sum(F.col("m") * F.col("m") - F.col("own")).alias("twice")).first()
    return int(found.rows or 0), (found.twice or 0.0) / 2


def star_pairs(rows: DataFrame, once: DataFrame, turn: int, least: float) -> DataFrame:
    """(u, v): the texts of each shared shingle with one of them, if in another group.

    In the first turn the same text leads all shingles that it has, so that groups of copies become stars. In a group of texts of which
    many are unlike, that finds few; from then on each shingle has a head of its own, so that a text meets as many as it has shingles.
    """
    order = F.xxhash64("x.node", F.lit(turn)) if turn == 0 else F.xxhash64("x.node", "gram", F.lit(turn))
    head = F.min_by("x", order).over(Window.partitionBy("gram"))
    both = with_bits(rows, once).select("x", head.alias("y")).where("x.root <> y.root").where(can_be_similar("x", "y", least))
    return both.select(F.greatest("x.node", "y.node").alias("u"), F.least("x.node", "y.node").alias("v")).distinct()


def open_pairs(rows: DataFrame, once: DataFrame, least: float) -> DataFrame:
    """(u, v): all texts of a shared shingle that are in different groups and can be similar."""
    sides = with_bits(rows, once)
    both = sides.join(sides.withColumnRenamed("x", "y"), "gram").where("x.node > y.node and x.root <> y.root").where(can_be_similar("x", "y", least))
    return both.select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(id, digest) of the rows to keep, by id and MD5 of the text: one for each group of texts that are linked by a similarity of ``least`` or more.

    First candidates are texts within four bits in either of two word fingerprints, found by the ball; then texts that share
    a shingle of their prefixes. They are compared by their word shingles. Equal texts are one. The smallest id of a group stays.

    A text that is unlike the one it was compared with is not done: as long as a shared shingle has texts of different groups,
    they are compared. Stars around another text in each turn join large groups first, so that few pairs are left; then all that
    are left are judged by their bitmaps, where they meet, and compared if those allow it. Only where very many texts that are not
    similar share rare shingles does the judging grow with their square; the texts compared do not.
    """
    named = docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), text_bytes(text_col).alias("text"))
    named = named.select("id", F.unhex(F.md5("text")).alias("digest"), "text")
    once = distinct_texts(named, shingle, least)
    roots = linked(ball_pairs(once), once, named, None, shingle, least)
    rows = mixed_shingles(shared_shingles(once), roots)
    size, ahead = open_size(rows)
    turn = 0
    while ahead > PAIRS * size:
        roots = linked(star_pairs(rows, once, turn, least), once, named, roots, shingle, least)
        rows, before = mixed_shingles(rows, roots), ahead
        size, ahead = open_size(rows)
        turn += 1
        if turn >= TURNS and ahead > before / 2:
            break
    roots = settled(open_pairs(rows, once, least), once, named, roots, shingle, least)
    least_of = F.min(F.struct("id", "digest")).alias("kept")
    return joined_roots(once.select("node", "id", "digest"), roots).groupBy("root").agg(least_of).select("kept.id", "kept.digest")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """One row of each group of near copies, with all its columns: the one with the smallest id; rows with a null id stay.

    Every text is judged for itself, also where texts share an id; of rows that repeat both id and text one stays.
    """
    kept = written(near_copies(docs, id_col, text_col, shingle, least).select(F.col("id").alias("__kept"), F.col("digest").alias("__digest")), "copies-kept")
    unnamed = docs.where(F.col(f"`{id_col}`").isNull())
    key = [F.col(f"`{id_col}`").alias("__id"), F.unhex(F.md5(text_bytes(text_col))).alias("__text")]
    named = docs.join(kept, (F.col(f"`{id_col}`") == F.col("__kept")) & (F.unhex(F.md5(text_bytes(text_col))) == F.col("__digest")), "left_semi")
    if not docs.where(F.col(f"`{id_col}`").isNotNull()).groupBy(*key).count().where("count > 1").isEmpty():
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        named = named.groupBy(*key).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("__row")).select("__row.*")
    return named.unionByName(unnamed)


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
