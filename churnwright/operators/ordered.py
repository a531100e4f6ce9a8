"""Ordered scans over groups of any size.

A window over one hot group, or over a whole table, runs in one task. Here rows
are first cut into chunks by their position in the total order ``(by, order)``,
so that a window only ever sees one chunk of one group. What a chunk needs to
know about the chunks before it (a count, a sum, the last value) is a table with
at most one row per chunk boundary, which is small enough to broadcast whatever
the size of the input.

The cut points come from a hash sample of the keys, so a recomputed task puts
every row back into the same chunk, and equal keys never straddle two chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwright.session import chunks_for

CHUNK = "_chunk"
SAMPLE_PER_CHUNK = 48


def _cut_points(df: DataFrame, keys: Sequence[str], chunks: int, rows: int) -> DataFrame:
    """One row: ``cuts``, the sorted array of at most ``chunks - 1`` key structs."""
    draw = F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))
    picked = df.select(*keys).where(draw < F.lit(chunks * SAMPLE_PER_CHUNK / max(1, rows)))
    # collect_set folds repeated keys on the map side: one row per distinct sampled key, ~48 per chunk.
    sample = picked.groupBy().agg(F.array_sort(F.collect_set(F.struct(*keys))).alias("s"))
    at = lambda i: F.get("s", F.floor(i * F.size("s") / F.lit(chunks)).cast("int"))
    cuts = F.filter(F.transform(F.sequence(F.lit(1), F.lit(chunks - 1)), at), lambda b: b.isNotNull())
    return sample.select(F.array_distinct(cuts).alias("cuts"))


def _with_chunk(df: DataFrame, keys: Sequence[str], cut_points: DataFrame, chunks: int) -> DataFrame:
    """Number of cut points at or below the row's key: from large to small, each step is taken if the cut point there is not beyond the key."""
    key = F.struct(*keys)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(chunks.bit_length()))])
    further = lambda at, step: F.when(F.get("_cuts", at + step - 1) <= key, at + step).otherwise(at)
    return df.withColumn("_cuts", cut_points.select("cuts").scalar()).withColumn(CHUNK, F.aggregate(steps, F.lit(0), further)).drop("_cuts")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def ordered_scan(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    *,
    position: str | None = None,
    before: Mapping[str, Column | str] | None = None,
    through: Mapping[str, Column | str] | None = None,
    totals: Mapping[str, Column | str] | None = None,
    previous: Mapping[str, Column | str] | None = None,
    following: Mapping[str, Column | str] | None = None,
    first: Mapping[str, Column | str] | None = None,
    peak: Mapping[str, Column | str] | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Add running columns to ``df``, ordered by ``order`` (ascending) within ``by``.

    ``position``  1-based row number
    ``before``    sum over the rows ahead of this one (0 for the first)
    ``through``   sum up to and including this row
    ``totals``    sum over the whole group
    ``previous``  value on the row before (null for the first)
    ``following`` value on the row after (null for the last)
    ``first``     value on the group's first row
    ``peak``      largest value up to and including this row

    ``(by, order)`` should identify a row; equal keys are kept together, in no fixed order.
    """
    by, order = list(by), list(order)
    as_col = lambda m: {k: F.col(v) if isinstance(v, str) else v for k, v in (m or {}).items()}
    before, through, totals = as_col(before), as_col(through), as_col(totals)
    previous, following, first, peak = as_col(previous), as_col(following), as_col(first), as_col(peak)
    keys = by + order

    # 1. put every row in its chunk; the count reads no column of a plain scan
    rows = df.count()
    chunks = chunks or chunks_for(rows, df.sparkSession)
    if chunks > 1:
        cuts = _cut_points(df, keys, chunks, rows)
        cut = _with_chunk(df, keys, cuts, chunks)
    else:
        cut = df.withColumn(CHUNK, F.lit(0))

    # 2. running values inside the chunk
    inside = Window.partitionBy(*by, CHUNK)
    run = inside.orderBy(*order)
    ahead = run.rowsBetween(Window.unboundedPreceding, -1)
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {"_rn": F.row_number().over(run)}
    for name, c in before.items():
        added[name] = F.coalesce(F.sum(c).over(ahead), F.lit(0))
    for name, c in through.items():
        added[name] = F.coalesce(F.sum(c).over(upto), F.lit(0))
    for name, c in totals.items():
        added[name] = F.coalesce(F.sum(c).over(inside), F.lit(0))
    for name, c in previous.items():
        added[name] = F.lag(F.struct(c.alias("v"))).over(run)
    for name, c in following.items():
        added[name] = F.lead(F.struct(c.alias("v"))).over(run)
    for name, c in first.items():
        added[name] = F.first(F.struct(c.alias("v"))).over(upto)
    for name, c in peak.items():
        added[name] = F.max(c).over(upto)
    own = cut.select("*", *[c.alias(n) for n, c in added.items()])

    structs = {*previous, *following, *first}
    if chunks == 1:
        out = own.withColumns({n: F.col(n).getField("v") for n in structs}) if structs else own
        return _finish(out.withColumn("_rn", F.col("_rn").cast("long")).drop(CHUNK), position)

    # 3. what the other chunks of a split group contribute
    if by:
        split = cuts.select(F.explode("cuts").alias("k")).select(*[F.col("k").getField(b).alias(b) for b in by]).distinct()
        part = cut.join(F.broadcast(split), _same(cut, split, by), "left_semi")
    else:
        part = cut
    at = F.struct(*order)
    sums = {f"_s_{n}": F.sum(c) for n, c in {**before, **through, **totals}.items()}
    lasts = {f"_l_{n}": F.max_by(F.struct(c.alias("v")), at) for n, c in previous.items()}
    opens = {f"_o_{n}": F.min_by(F.struct(c.alias("v")), at) for n, c in {**following, **first}.items()}
    peaks = {f"_p_{n}": F.max(c) for n, c in peak.items()}
    aggs = {"_n": F.count(F.lit(1)), **sums, **lasts, **opens, **peaks}
    per_chunk = part.groupBy(*by, CHUNK).agg(*[c.alias(n) for n, c in aggs.items()])

    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    seq = group.orderBy(CHUNK)
    earlier = seq.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        *[F.col(b).alias(f"_b_{b}") for b in by],
        F.col(CHUNK).alias("_b_chunk"),
        F.sum("_n").over(earlier).alias("_n0"),
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_f_{n}") for n in {**before, **through}],
        *[F.sum(f"_s_{n}").over(group).alias(f"_f_{n}") for n in totals],
        *[F.lag(f"_l_{n}").over(seq).alias(f"_f_{n}") for n in previous],
        *[F.lead(f"_o_{n}").over(seq).alias(f"_f_{n}") for n in following],
        *[F.first(f"_o_{n}").over(seq).alias(f"_f_{n}") for n in first],
        *[F.max(f"_p_{n}").over(earlier).alias(f"_f_{n}") for n in peak],
    )
    on = reduce(
        lambda a, b: a & b,
        [own[b].eqNullSafe(offsets[f"_b_{b}"]) for b in by] + [own[CHUNK] == offsets["_b_chunk"]],
    )
    # At most one row per chunk boundary and side: bounded by 2 * chunks, never by the data.
    joined = own.join(F.broadcast(offsets), on, "left")

    fixed = {"_rn": F.col("_rn") + F.coalesce("_n0", F.lit(0))}
    for name in {**before, **through}:
        fixed[name] = F.col(name) + F.coalesce(f"_f_{name}", F.lit(0))
    for name in totals:
        fixed[name] = F.coalesce(f"_f_{name}", name)
    for name in {**previous, **following}:
        fixed[name] = F.coalesce(name, f"_f_{name}").getField("v")
    for name in first:
        fixed[name] = F.coalesce(f"_f_{name}", name).getField("v")
    for name in peak:
        fixed[name] = F.greatest(name, f"_f_{name}")
    return _finish(joined.select(*df.columns, *[c.alias(n) for n, c in fixed.items()]), position)


def _finish(out: DataFrame, position: str | None) -> DataFrame:
    return out.withColumnRenamed("_rn", position) if position else out.drop("_rn")
