"""The prefix trie of conversations by whole-sequence collapse.

Conversations are rebuilt first (``rebuilt``): the first h turns of conversation
``c - c % 20``, then the conversation's own turns after its first h, with h = crc32 of the
decimal id, modulo 4. A node is a distinct sequence of first turns (role, text).

1. Identical rebuilt conversations become one weighted sequence with a list of ends. A
   prefix is named by its depth and four sums, over its turns, of 31 bits of the SHA-256
   of (place, role, text). Sums are what ordered scans give for conversations of any
   length, split over tasks; two prefixes would have to agree in 124 bits to be confused.
2. Sequences that are a proper prefix of another are taken out by an anti-join; the rest
   are the leaves.
3. Prefixes of the weighted sequences are added up. What a subtree saves needs no row
   per node and ancestor: each node belongs to one leaf (the smallest below it), a scan
   from the end of each leaf's sequence adds up the nodes that belong to it, and a node
   adds these sums over the leaves below it.

The digest of a node's ends is made from numbers in order, read as a stream from pieces
of up to ``PIECE`` ids that were joined before the shuffle; so a node with any number
of ends costs its task time but no memory.

Rows: a null role or text is empty; a null turn comes first; turns of the same number go
by their content. Repeated rows are repeated turns. Rows without a conversation id
belong to no conversation and are left out. A conversation without turns ends in the
root. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import table, written
from churnwright.operators.lookups import lookup
from churnwright.operators.ordered import ordered_scan

FAMILY, MOST = 20, 4  # conversations that share a first one; h is below MOST
PARTS = 4
PIECE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def prefix_key(depth: Column, sums: list[Column]) -> Column:
    return F.concat_ws(":", depth.cast("string"), *[s.cast("string") for s in sums])


ROOT = ":".join("0" * (PARTS + 1))


def borrowed_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first one of its family."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(MOST))


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, digest, words): each turn by its place, the SHA-256 of its role and text, and its number of words."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    content = F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary"))
    rows = conversations.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    return ordered_scan(rows, ["turn", "digest"], ["conv"], position="pos").drop("turn")


def rebuilt(placed: DataFrame) -> DataFrame:
    """(conv, depth, digest, words) of the rebuilt conversations, from ``turns``."""
    own = placed.where(F.col("pos") > borrowed_turns(F.col("conv"))).select("conv", F.lit(1).alias("part"), "pos", "digest", "words")
    lent = placed.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < MOST)).select(F.col("conv").alias("base"), "pos", "digest", "words")
    ids = placed.select("conv").distinct().withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    taken = ids.join(lent, "base").where(F.col("pos") <= borrowed_turns(F.col("conv"))).select("conv", F.lit(0).alias("part"), "pos", "digest", "words")
    rows = written(own.unionByName(taken), "trie-turns")
    return ordered_scan(rows, ["part", "pos"], ["conv"], position="depth").select("conv", "depth", "digest", "words")


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, words, key, parent): every prefix by its name, with the name of the prefix one turn shorter."""
    place = F.sha2(F.concat("digest", F.col("depth").cast("string").cast("binary")), 256)
    bits = [F.conv(F.substring(place, 1 + 8 * i, 8), 16, 10).cast("long").bitwiseAND(0x7FFFFFFF).alias(f"b{i}") for i in range(PARTS)]
    marked = written(rows.select("conv", "depth", "words", *bits), "trie-places")
    summed = ordered_scan(marked, ["depth"], ["conv"], through={f"s{i}": f"b{i}" for i in range(PARTS)})
    sums, shorter = [F.col(f"s{i}") for i in range(PARTS)], [F.col(f"s{i}") - F.col(f"b{i}") for i in range(PARTS)]
    named = summed.select("conv", "depth", "words", prefix_key(F.col("depth"), sums).alias("key"), prefix_key(F.col("depth") - 1, shorter).alias("parent"))
    return written(named, "trie-prefixes")


def sequences(ids: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ends, sequences): ends (conv, key, length) has every conversation's whole sequence; sequences (key, conv, weight, length) has each once, by its smallest conversation."""
    last = named.groupBy("conv").agg(F.max_by("key", "depth").alias("key"), F.max("depth").alias("length"))
    ends = ids.join(last, "conv", "left").select("conv", F.coalesce("key", F.lit(ROOT)).alias("key"), F.coalesce("length", F.lit(0)).cast("long").alias("length"))
    ends = written(ends, "trie-ends")
    return ends, written(ends.groupBy("key").agg(F.min("conv").alias("conv"), F.count("*").alias("weight"), F.first("length").alias("length")), "trie-sequences")


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of the ids that end in each node, in order, joined by commas."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    bucket = F.floor(F.col("conv") / PIECE)
    parts = ends.groupBy("key", bucket.alias("bucket")).agg(joined.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out: list[tuple[str, str]] = []
            for now, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now != key:
                    if digest is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["key", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    return parts.repartition("key").sortWithinPartitions("key", "bucket").select("key", "ids").mapInArrow(run, "key string, ends_sha256 string")


def trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for every node."""
    placed = written(turns(conversations, id_col, turn_col, role_col, text_col), "trie-placed")
    named = prefixes(rebuilt(placed))
    ends, whole = sequences(placed.select("conv").distinct(), named)

    # the prefixes of each distinct sequence, along its smallest conversation, and the root
    path = lookup(named, whole.select("conv", "weight", "length"), ["conv"], how="inner")
    top = whole.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), "weight", "length")
    path = written(path.select(*top.columns).unionByName(top), "trie-path")
    inner = path.where("depth < length").select("key").distinct()
    leaves = written(whole.join(inner, "key", "left_anti").select("conv"), "trie-leaves")
    leaf_path = written(lookup(path.select("conv", "depth", "key"), leaves, ["conv"], how="inner"), "trie-leaf-path")

    nodes = path.groupBy("key").agg(
        F.min("conv").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("words").alias("words"), F.sum("weight").alias("n_convs")
    )
    below = leaf_path.groupBy("key").agg(F.count("*").alias("n_leaves"), F.min("conv").alias("owner"))
    nodes = written(nodes.join(below, "key"), "trie-nodes")

    # sums from the end of each leaf's sequence over the nodes that belong to it; a node's own row counts for itself
    values = nodes.select(F.col("owner").alias("conv"), (-F.col("depth")).alias("up"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("key"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    steps = leaf_path.select("conv", (-F.col("depth")).alias("up"), F.lit(1).alias("kind"), "key", F.lit(0).cast("long").alias("saved"))
    run = ordered_scan(written(values.unionByName(steps), "trie-values"), ["up", "kind"], ["conv"], through={"rest": "saved"})
    saved = run.where("kind = 1").groupBy("key").agg(F.sum("rest").alias("saved_tokens"))

    children = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "key")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(saved, "key").join(children, "key", "left").join(end_digests(ends), "key", "left")
    zero = F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")
    return lookup(found, parents, ["parent"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", zero, "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return trie(table(spark, folder, "conversations"))


SQL = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), turned AS (
  SELECT ids.conv_id, 0 AS part, pos, role, text FROM ids JOIN t ON t.conv_id = ids.base AND pos <= h
  UNION ALL
  SELECT ids.conv_id, 1, pos, role, text FROM ids JOIN t ON t.conv_id = ids.conv_id AND pos > h
), whole AS (
  SELECT ids.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS s
  FROM ids LEFT JOIN turned USING (conv_id) GROUP BY ids.conv_id
), reached AS (
  SELECT conv_id, s, d, s[1:d] AS node FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM whole)
), nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = d), '') AS ends,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM reached GROUP BY node, d
), kids AS (
  SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), up AS (
  SELECT n.node[1:e] AS node, sum((n_convs - 1) * words) AS saved, count(*) FILTER (kids.node IS NULL) AS n_leaves
  FROM (SELECT node, n_convs, words, unnest(range(d + 1)) AS e FROM nodes) n LEFT JOIN kids USING (node) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN up USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]
"""
