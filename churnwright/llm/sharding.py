"""Sharding by balanced label propagation: linked documents gather, shards stay even.

Documents with equal texts are linked. Every document starts in a shard dealt by its
id. The documents of a group in one of 256 cells of the id move as one, so the state
that the rounds work on has one row per group and cell, however many copies there are.
In each round the cells of a group vote with their documents; a cell outside the
group's best shards asks to move to one of them, if that has at least as many votes as
its own. A group larger than a shard has as many best shards as it needs, and one
more. Requests are let in by hash order up to what the shard's quota leaves free.

The law is ``rows``: counts differ by at most one. What a shard holds beyond its quota
in the end, unlinked documents first, goes to shards with room. Places in a shard
come from counts per bucket of the id's hash: no task sees more than a bucket.

Rows: a null text has no bytes, and is linked with empty texts. Repeated rows are
linked copies like others. Rows with a null id share a cell. The same input gives the
same shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnwright.llm.common import table, text_bytes
from churnwright.session import stage

SHARDS = 16
CELLS = 256
ROUNDS = 12
BUCKETS = 1024


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def pick(values: list[int], at: Column) -> Column:
    """The value at a position, from a short list."""
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), at)


def requests(state: DataFrame, free: list[int], quota: int, turn: int) -> DataFrame:
    """The state with ``dest``, where a cell asks to move to (null: it stays), and ``bucket``, its place in the queue."""
    votes = state.groupBy("grp", "shard").agg(F.sum("n").alias("v"))
    ranked = votes.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("v", (-F.col("shard")).alias("s"))), asc=False).alias("ranked"))
    both = state.join(ranked, "grp")
    wide = F.greatest(F.lit(1), F.ceil(F.col("total") / quota + F.when(F.col("total") > quota, 1).otherwise(0))).cast("int")
    # a small group needs room for all its other documents, a cell of a large one for itself
    need = lambda x: F.when(F.col("total") * 8 <= quota, F.col("total") - x.v).otherwise(F.col("n"))
    room = lambda x: (pick(free, -x.s) > 0) & (pick(free, -x.s) >= need(x))
    best = F.slice("ranked", F.lit(1), wide)
    opened = F.filter(best, room)
    opened = F.when(F.size(opened) > 0, opened).otherwise(F.slice(F.filter("ranked", room), F.lit(1), wide))
    spread = F.pmod(F.xxhash64("cell", F.lit(turn)), F.greatest(F.size(opened), F.lit(1))).cast("int")
    to = F.get(opened, spread)
    own = F.filter("ranked", lambda x: -x.s == F.col("shard"))[0]["v"]
    stays = F.exists(best, lambda x: -x.s == F.col("shard")) | to.isNull() | (to["v"] < own)
    # a small group that is split over full shards only moves as a whole to any shard with room
    others = [s for s, n in enumerate(free) if n > 0 and 2 * n >= max(free)]
    whole = to.isNull() & (F.size("ranked") > 1) & (F.col("total") * 8 <= quota) if others else F.lit(False)
    other = pick(others or [0], F.pmod(F.xxhash64("grp", F.lit(turn)), F.lit(max(1, len(others)))).cast("int")).cast("int")
    dest = F.when(whole, other).when(~stays, -to["s"])
    ticket = F.xxhash64("grp", F.when(F.col("total") * 8 > quota, F.col("cell")).otherwise(-1), F.lit(turn))
    return both.select("grp", "cell", "n", "total", "shard", dest.alias("dest"), F.pmod(ticket, F.lit(BUCKETS)).cast("int").alias("bucket"))


def let_in(asked: DataFrame, free: list[int]) -> list[int]:
    """For each shard, the first bucket of the queue that its free places no longer hold."""
    sums = np.zeros((len(free), BUCKETS))
    for r in asked.where("dest is not null").groupBy("dest", "bucket").agg(F.sum("n").alias("n")).collect():
        sums[r.dest, r.bucket] = r.n
    return [int(np.searchsorted(np.cumsum(sums[s]), max(0, free[s]), side="right")) for s in range(len(free))]


def propagate(cells: DataFrame, n: int, shards: int, rounds: int) -> DataFrame:
    """(grp, cell, shard) of linked cells after the rounds."""
    quota = quotas(n, shards)
    state = cells
    for turn in range(rounds):
        loads = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        free = [quota[s] - loads.get(s, 0) for s in range(shards)]
        asked = stage(requests(state, free, max(1, quota[-1]), turn), "shard-asked")
        cut = let_in(asked, free)
        moves = F.col("dest").isNotNull() & (F.col("bucket") < pick(cut, F.col("dest")))
        state = asked.select("grp", "cell", "n", "total", F.when(moves, F.col("dest")).otherwise(F.col("shard")).alias("shard"))
        if asked.where("dest is not null").isEmpty():
            break
    return state


def placed(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """The rows with their final shard and slot, from ``shard`` and ``linked``."""
    bucket = F.pmod(F.xxhash64("id", F.lit("slot")), F.lit(BUCKETS)).cast("int") + F.when(F.col("linked"), 0).otherwise(BUCKETS)
    rows = rows.withColumn("bucket", bucket)
    counts = stage(rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")), "shard-buckets")
    ahead = counts.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("ahead"))
    held = {r.shard: r.n for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    quota = quotas(n, shards)
    have = [held.get(s, 0) for s in range(shards)]
    over = [max(0, have[s] - quota[s]) for s in range(shards)]
    room = np.cumsum([max(0, quota[s] - have[s]) for s in range(shards)]).tolist()
    over_before = [sum(over[:s]) for s in range(shards)]
    room_before = [0, *room[:-1]]
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "crc", "size"))
    # at most shards * 2 * BUCKETS rows, whatever the input
    at = rows.withColumn("within", within).join(F.broadcast(ahead), ["shard", "bucket"]).withColumn("at", F.col("ahead") + F.col("within") - 1)
    extra = F.col("at") - pick(quota, F.col("shard"))
    index = pick(over_before, F.col("shard")) + extra
    target = F.size(F.filter(F.array(*[F.lit(int(x)).cast("long") for x in room]), lambda x: x <= index))
    stays = extra < 0
    return at.withColumn("target", F.when(stays, F.col("shard")).otherwise(target)).select(
        "id", "size", "crc", F.col("target").cast("int").alias("shard"),
        F.when(stays, F.col("at")).otherwise(pick(have, F.col("target")) + index - pick(room_before, F.col("target"))).alias("slot"),
    )


def shards_of(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, crc, shard, slot) for every row: size is the text's bytes plus one."""
    text = text_bytes(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), F.unhex(F.md5(text)).alias("grp"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit("cell")), F.lit(CELLS)).cast("int").alias("cell"),
    )
    rows = stage(rows, "shard-rows")
    n = rows.count()
    cells = rows.groupBy("grp", "cell").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy("grp")))  # at most CELLS rows a group
    linked = cells.where("total > 1").select("grp", "cell", "n", "total", (F.col("cell") % shards).cast("int").alias("shard"))
    final = propagate(stage(linked, "shard-cells"), n, shards, rounds).select(F.col("grp").alias("g"), F.col("cell").alias("c"), F.col("shard").alias("s"))
    found = rows.join(final, (F.col("grp") == F.col("g")) & (F.col("cell") == F.col("c")), "left")
    first = found.select("id", "size", "crc", F.coalesce("s", (F.col("cell") % shards).cast("int")).alias("shard"), F.col("g").isNotNull().alias("linked"))
    return placed(stage(first, "shard-first"), n, shards).withColumnRenamed("id", id_col)


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = shards_of(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
