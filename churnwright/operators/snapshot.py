"""Contract history and look-back features, one row per contract or anchor.

A contract table has ``contract_id, customer_id, start, end`` (dates or timestamps).
Every feature of a row reads only what was known before the row's own cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnwright.functions import weekday
from churnwright.operators.lookups import lookup
from churnwright.operators.ordered import ordered_scan
from churnwright.session import stage

# Names and limits (in days) of the tenure buckets.
TENURE_BUCKETS = (("<6 mo", 183), ("6–12 mo", 365), (">1 yr", None))


def tenure_bucket(days: Column) -> Column:
    (short, half), (middle, year), (long_, _) = TENURE_BUCKETS
    return F.when(days < half, F.lit(short)).when(days <= year, F.lit(middle)).when(days.isNotNull(), F.lit(long_))


def contract_history(contracts: DataFrame, horizon_days: int = 365, observed_until: Column | None = None) -> DataFrame:
    """Contract number, gaps, lengths, tenure, past churns and the churn label, in one scan per customer.

    ``churn`` is 1 if no contract starts within ``horizon_days`` of the end, 0 if one does,
    and null while the horizon has not been observed yet.
    """
    length = F.datediff("end", "start")
    rows = contracts.withColumn("contract_len_days", length)
    seen = observed_until if observed_until is not None else rows.groupBy().agg(F.max("start").alias("m")).scalar()
    numbered = ordered_scan(
        rows,
        ["start", "contract_id"],
        ["customer_id"],
        position="_pos",
        before={
            "_len": F.col("contract_len_days").cast("long"),
            "_len2": F.col("contract_len_days").cast("long") * F.col("contract_len_days"),
        },
        previous={"_prev_end": "end"},
        following={"_next_start": "start"},
        first={"_first_start": "start"},
    )
    n = F.col("_pos") - 1
    gap_to_next = F.datediff("_next_start", "end")
    observed = F.date_add(F.col("end").cast("date"), horizon_days) <= F.lit(seen).cast("date")
    churn = (
        F.when(gap_to_next <= horizon_days, F.lit(0))
        .when(observed, F.lit(1))
        .otherwise(F.lit(None).cast("int"))
    )
    spread = F.col("_len2") - F.col("_len").cast("double") * F.col("_len") / n
    labelled = numbered.select(
        *rows.columns,
        n.alias("contract_number"),
        n.alias("n_prev_contracts"),
        F.datediff("start", "_prev_end").alias("gap_since_prev_expiry"),
        F.when(n > 0, F.col("_len") / n).alias("mean_len_prev"),
        F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1))).alias("std_len_prev"),
        F.datediff("end", "_first_start").alias("tenure_days"),
        F.month("end").alias("expiry_month"),
        weekday("end").alias("expiry_dow"),
        churn.alias("churn"),
    )
    return labelled.withColumn("tenure_bucket", tenure_bucket(F.col("tenure_days")))


def past_churns(labelled: DataFrame) -> DataFrame:
    """Earlier contracts of the customer that ended in churn."""
    return ordered_scan(
        stage(labelled, "labelled"), ["start", "contract_id"], ["customer_id"], before={"past_churns": F.coalesce("churn", F.lit(0)).cast("long")}
    )


def _daily(events: DataFrame, who: str, ts: str, aggs: list[Column]) -> DataFrame:
    return events.groupBy(who, F.to_date(ts).alias("_day")).agg(*aggs)


def _day_number(day: str) -> Column:
    return F.unix_date(day)


def lookback(
    anchors: DataFrame, events: DataFrame, *, who: str, anchor_day: str, ts: str, days: int, value: str | None = None, flag: Column | None = None, prefix: str = "lb"
) -> DataFrame:
    """Counts, sums, moments and recency of the events in the ``days`` whole days before each anchor's day.

    Events are first added up per customer and day, so a customer has at most one row per
    calendar day however many events there are, and no event is paired with an anchor.
    Values are added as decimals: the result does not depend on the order.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    if value:
        v = F.col(value).cast("decimal(18,4)")
        aggs += [F.sum(v).alias("_s"), F.sum(v * v).alias("_s2")]
    if flag is not None:
        aggs.append(F.sum(flag.cast("long")).alias("_f"))
    daily = _daily(events, who, ts, aggs)
    asked = anchors.select(who, F.col(anchor_day).cast("date").alias("_day")).where(F.col(who).isNotNull() & F.col("_day").isNotNull()).distinct()
    grid = daily.withColumn("_has", F.col("_day")).unionByName(asked.withColumn("_ask", F.lit(True)), allowMissingColumns=True)
    # at most two rows per customer and calendar day
    w = Window.partitionBy(who).orderBy(_day_number("_day"))
    back = w.rangeBetween(-days, -1)
    total = lambda c: F.sum(c).over(back)
    out = {f"{prefix}_count": F.coalesce(total("_n"), F.lit(0))}
    out["_last"] = F.max("_has").over(back)
    if value:
        n, s, s2 = (F.col(f"{prefix}_count").cast("double"), F.col("_sum").cast("double"), F.col("_sum2").cast("double"))
        out["_sum"], out["_sum2"] = total("_s"), total("_s2")
    if flag is not None:
        out[f"{prefix}_hits"] = F.coalesce(total("_f"), F.lit(0))
    seen = grid.select("*", *[c.alias(k) for k, c in out.items()]).where("_ask")
    cols = [F.col(f"{prefix}_count"), F.datediff("_day", "_last").alias(f"{prefix}_days_since_last")]
    if value:
        std = F.sqrt(F.greatest(s2 - s * s / n, F.lit(0.0)) / (n - 1))
        cols += [
            F.coalesce(s, F.lit(0.0)).alias(f"{prefix}_total"),
            F.when(n > 0, s / n).alias(f"{prefix}_avg"),
            F.when(n > 1, std).alias(f"{prefix}_std"),
            F.when((n > 1) & (s != 0), std / (s / n)).alias(f"{prefix}_cv"),
        ]
    if flag is not None:
        cols += [
            F.col(f"{prefix}_hits"),
            (F.col(f"{prefix}_hits") > 0).cast("int").alias(f"{prefix}_any"),
        ]
    cols.append((F.col(f"{prefix}_count") > 0).cast("int").alias(f"{prefix}_was_seen"))
    per_day = seen.select(F.col(who), F.col("_day"), *cols)
    found = lookup(anchors.withColumn("_day", F.col(anchor_day).cast("date")), stage(per_day, "lookback"), [who, "_day"]).drop("_day")
    # a row without a customer or day has seen nothing, as a customer without events
    none = [f"{prefix}_count", f"{prefix}_total", f"{prefix}_hits", f"{prefix}_any", f"{prefix}_was_seen"]
    return found.fillna(0, [c for c in none if c in found.columns and c not in anchors.columns])


def lookback_distinct(anchors: DataFrame, events: DataFrame, *, who: str, anchor_day: str, ts: str, what: str, days: int, out: str) -> DataFrame:
    """Distinct values of ``what`` in the look-back window.

    A value seen on day d counts for the anchors of the following ``days`` days, or until its
    next occurrence takes over. The spans of one value do not overlap, so the number of
    distinct values on a day is the running sum of span starts less span ends.
    """
    by_value = events.where(F.col(what).isNotNull() & F.col(who).isNotNull() & F.col(ts).isNotNull()).select(who, F.to_date(ts).alias("_day"), F.col(what).alias("_v")).distinct()
    nxt = F.lead("_day").over(Window.partitionBy(who, "_v").orderBy("_day"))
    spans = by_value.select(
        who, F.date_add("_day", 1).alias("_from"), F.date_add(F.least(F.date_add("_day", days), F.coalesce(nxt, F.date_add("_day", days))), 1).alias("_to")
    )
    steps = spans.select(
        who, F.inline(F.array(F.struct(F.col("_from").alias("_day"), F.lit(1).alias("_d")), F.struct(F.col("_to").alias("_day"), F.lit(-1).alias("_d"))))
    )
    asked = anchors.select(who, F.col(anchor_day).cast("date").alias("_day")).where(F.col(who).isNotNull() & F.col("_day").isNotNull()).distinct().withColumn("_d", F.lit(0)).withColumn("_ask", F.lit(True))
    daily = steps.unionByName(asked, allowMissingColumns=True).groupBy(who, "_day").agg(F.sum("_d").alias("_d"), F.bool_or(F.coalesce("_ask", F.lit(False))).alias("_ask"))
    # one row per customer and calendar day
    running = daily.withColumn(out, F.sum("_d").over(Window.partitionBy(who).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)))
    per_day = running.where("_ask").select(who, "_day", out)
    return lookup(anchors.withColumn("_day", F.col(anchor_day).cast("date")), stage(per_day, "lookback"), [who, "_day"]).drop("_day").fillna(0, [out])


def as_of(rows: DataFrame, history: DataFrame, *, who: str, at: str, valid_from: str, key: str, take: dict[str, str]) -> DataFrame:
    """The newest history row per customer with ``valid_from <= at``, joined to each row.

    History without a customer or a date holds for nobody; rows without one get nulls. Both sides go through one ordered scan per customer; no row is paired with more than the one it takes.
    ``take`` maps output names to history columns; ``key`` identifies a row of ``rows``.
    """
    marked = history.where(F.col(who).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(who), F.col(valid_from).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast("string").alias("_key"),
        F.struct(F.col(valid_from).alias("_from"), *[F.col(c).alias(n) for n, c in take.items()]).alias("_h"),
    )
    # one history row per customer and instant
    marked = marked.groupBy(who, "_at", "_side", "_key").agg(F.max("_h").alias("_h"))
    placed = F.col(who).isNotNull() & F.col(at).isNotNull()
    asked = rows.where(placed).withColumn("_row", F.struct(*rows.columns)).select(
        F.col(who), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.col(key).cast("string").alias("_key"), "_row"
    )
    both = marked.unionByName(asked, allowMissingColumns=True)
    scanned = ordered_scan(both, ["_at", "_side", "_key"], [who], peak={"_seen": "_h"})
    found = scanned.where("_side = 1").select("_row.*", *[F.col(f"_seen.{n}").alias(n) for n in take])
    kinds = {n: history.schema[c].dataType for n, c in take.items()}
    return found.unionByName(rows.where(~placed).select("*", *[F.lit(None).cast(k).alias(n) for n, k in kinds.items()]))


def used_before(anchors: DataFrame, events: DataFrame, *, who: str, anchor_day: str, ts: str, days: int, out: str) -> DataFrame:
    """1 if the customer has any such event in the look-back window."""
    counted = lookback(anchors, events, who=who, anchor_day=anchor_day, ts=ts, days=days, prefix="_u")
    return counted.select(*anchors.columns, F.col("_u_was_seen").alias(out))
