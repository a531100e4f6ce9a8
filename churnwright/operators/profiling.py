"""Counts, shares, moments, associations and schema profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.functions import count_where, known, present
from churnwright.operators.cleaning import TIMES, columns_of
from churnwright.operators.lookups import beside, lookup
from churnwright.operators.ordered import ordered_scan
from churnwright.operators.quantiles import long_numeric, quantiles
from churnwright.session import stage

# Fixed value: how many example values a text column keeps in the schema profile.
EXAMPLES = 20


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def _per_column(df: DataFrame, cols: Sequence[str], parts: dict) -> DataFrame:
    """One aggregate pass over all columns, then one row per column. ``parts``: name -> (column name -> aggregate)."""
    wide = df.agg(*[make(c).alias(f"{i}_{name}") for i, c in enumerate(cols) for name, make in parts.items()])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{name}").alias(name) for name in parts])
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(F.inline(rows))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null, n_known, null_ratio)``; NaN and the infinities count as null."""
    counted = _per_column(
        df,
        cols or df.columns,
        {"n_null": lambda c: count_where(present(df, c).isNull()), "n_known": lambda c: F.count(present(df, c))},
    )
    total = F.col("n_null") + F.col("n_known")
    return counted.withColumn("null_ratio", F.when(total > 0, F.col("n_null") / total))


def value_counts(df: DataFrame, col: str, *, drop_null: bool = True) -> DataFrame:
    """``(value, n, share)`` over the counted rows."""
    rows = df.where(F.col(col).isNotNull()) if drop_null else df
    counts = rows.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy().agg(F.sum("n").alias("n")).scalar()  # the counts' exchange is used again
    return counts.withColumn("share", F.col("n") / total)


def target_rate(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count(target).alias("n"), F.avg(F.col(target).cast("double")).alias("rate"))


def text_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide to long: ``(keep..., column, value)`` with values as string."""
    wide = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "column", "value")


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, *, exact: bool = True) -> DataFrame:
    """``(column, n_distinct)``, nulls not counted. The exact form spreads the values of a column over the cluster."""
    cols = list(cols or df.columns)
    if not exact:
        return _per_column(df, cols, {"n_distinct": lambda c: F.approx_count_distinct(c)})
    values = text_values(df, cols).groupBy("column", "value").agg(F.lit(1).alias("_"))
    return values.groupBy("column").agg(F.count("value").alias("n_distinct"))


def drop_constant(df: DataFrame) -> DataFrame:
    """Drop columns with at most one distinct value. Reads one row per column to decide."""
    flat = {r["column"] for r in distinct_counts(df).where("n_distinct <= 1").collect()}
    return df.drop(*flat)


def numeric_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, n_null, min, max)`` over finite values."""
    finite = lambda c: known(F.col(c).cast("double"))
    return _per_column(
        df,
        cols,
        {
            "n_null": lambda c: count_where(F.col(c).isNull()),
            "min": lambda c: F.min(finite(c)),
            "max": lambda c: F.max(finite(c)),
        },
    )


def category_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value)``: every value of every column, one row each."""
    return text_values(df, cols).where("value is not null").groupBy("column", "value").agg(F.lit(1).alias("_")).drop("_")


def first_categories(df: DataFrame, cols: Sequence[str], k: int = EXAMPLES) -> DataFrame:
    """``(column, n_categories, example_values)``: the first ``k`` values in order, as an array."""
    values = category_values(df, cols)
    sizes = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_categories"))
    # the rank filter is applied before the shuffle too, so a task sends at most k values per column
    top = values.withColumn("rn", F.row_number().over(Window.partitionBy("column").orderBy("value"))).where(F.col("rn") <= k)
    listed = top.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("example_values"))
    return sizes.join(listed, "column")


def schema_profile(df: DataFrame, k: int = EXAMPLES) -> DataFrame:
    """``(column, dtype, nullable, min, max, n_categories, example_values)``, one row per column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    numeric = columns_of(df, (T.NumericType,))
    times = columns_of(df, TIMES)
    texts = [c for c in df.columns if c not in numeric and c not in times]
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    parts = []
    if numeric:
        parts.append(
            numeric_range(df, numeric).select(
                "column", "n_null", F.col("min").cast("string").alias("min"), F.col("max").cast("string").alias("max")
            )
        )
    if times:
        parts.append(
            _per_column(
                df,
                times,
                {
                    "n_null": lambda c: count_where(F.col(c).isNull()),
                    "min": lambda c: stamp(F.min(c)),
                    "max": lambda c: stamp(F.max(c)),
                },
            )
        )
    if texts:
        nulls = null_profile(df, texts).select("column", "n_null")
        parts.append(nulls.join(first_categories(df, texts, k), "column", "left"))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    for name, kind in (("min", "string"), ("max", "string"), ("n_categories", "bigint"), ("example_values", "array<string>")):
        if name not in merged.columns:
            merged = merged.withColumn(name, F.lit(None).cast(kind))
    dtype = F.create_map(*[x for kv in types.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return merged.select(
        "column",
        dtype[F.col("column")].alias("dtype"),
        (F.col("n_null") > 0).alias("nullable"),
        "min",
        "max",
        "n_categories",
        "example_values",
    )


def means_by_target(df: DataFrame, cols: Sequence[str], target: str, classes: Sequence) -> DataFrame:
    """``(column, mean_<class>...)``."""
    wide = df.groupBy().agg(
        *[F.avg(F.when(F.col(target) == k, known(F.col(c).cast("double")))).alias(f"{i}_{k}") for i, c in enumerate(cols) for k in classes]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{k}").alias(f"mean_{k}") for k in classes]) for i, c in enumerate(cols)]
    )
    return wide.select(F.inline(rows))


def contingency(df: DataFrame, x: str, y: str, classes: Sequence) -> DataFrame:
    """``(x, n_<class>...)`` counts."""
    return df.groupBy(x).agg(*[count_where(F.col(y) == k).alias(f"n_{k}") for k in classes])


def top_categories(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = ()) -> DataFrame:
    """Long ``(keep..., column, category)``; all but the ``k`` commonest categories of a column become one."""
    long = text_values(df, cols, keep).withColumn("category", F.coalesce("value", F.lit("<NA>"))).drop("value")
    counts = long.groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), "category")
    kept = counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select("column", "category", F.lit(True).alias("_kept"))
    # at most k rows per column
    marked = long.join(F.broadcast(kept), ["column", "category"], "left")
    other = F.lit(f"__other__ (>{k})")
    return marked.select(*keep, "column", F.when(F.col("_kept"), F.col("category")).otherwise(other).alias("category"))


def target_share(long: DataFrame, target: str) -> DataFrame:
    """``(column, category, target, n, share)``: share of each target value within its category."""
    counts = long.groupBy("column", "category", target).agg(F.count(F.lit(1)).alias("n"))
    # one row per target value in each window group
    whole = F.sum("n").over(Window.partitionBy("column", "category"))
    return counts.withColumn("share", F.col("n") / whole)


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """``(bin, n)`` over equal-width bins of [lo, hi); bin 0 is below, ``bins + 1`` is at or above ``hi``."""
    v = F.col(col).cast("double")
    bin_ = (
        F.when(v < lo, F.lit(0))
        .when(v >= hi, F.lit(bins + 1))
        .otherwise(F.floor((v - lo) * bins / (hi - lo)).cast("int") + 1)
    )
    return df.where(F.col(col).isNotNull()).groupBy(bin_.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, cols: Sequence[str], target: str, *, exact: bool = True) -> DataFrame:
    """Quartiles, whisker ends and outlier counts per column and target value."""
    long = long_numeric(df, cols, [target]).select(target, "column", known("value").alias("value")).where("value is not null")
    q = quantiles(long, "value", [0.25, 0.5, 0.75], [target, "column"], exact=exact)
    iqr = F.col("q")[2] - F.col("q")[0]
    fences = q.select(
        target,
        "column",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
        (F.col("q")[0] - iqr * 1.5).alias("_lo"),
        (F.col("q")[2] + iqr * 1.5).alias("_hi"),
    )
    held = lookup(long, stage(fences, "fences"), [target, "column"], how="inner")
    ok = (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
    return held.groupBy(target, "column", "q1", "median", "q3").agg(
        F.min(F.when(ok, F.col("value"))).alias("whisker_low"),
        F.max(F.when(ok, F.col("value"))).alias("whisker_high"),
        count_where(~ok).alias("n_outliers"),
    )


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(a, b, r)``: Pearson over the rows where both are known, upper triangle, one pass."""
    pairs = list(combinations(cols, 2))
    d = df.select(*[known(F.col(c).cast("double")).alias(c) for c in cols])
    both = lambda a, b: (F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b)))
    wide = d.agg(*[F.corr(*both(a, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(rows))


def rank_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(a, b, n, r)``: Spearman over the rows where both are known, upper triangle; ties take their middle rank.

    The rank of a value follows from the counts below it, among the rows that know the other column. So values are counted per
    column and per set of columns known beside them, and a scan over the distinct values, however many there are, ranks them
    against every other column at once. Rows take the ranks of their values and leave their task as one sum of products per
    pair; all other sums come from the counts. Ranks are doubled, so that they are whole.
    """
    at = range(len(cols))
    d = df.select(*[(known(F.col(c).cast("double")) + 0.0).alias(f"c{i}") for i, c in enumerate(cols)])
    beside_it = F.array(*[F.col(f"c{i}").isNotNull() for i in at]).alias("beside")
    each = d.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v"), beside_it) for i in at]))).where("v is not null")
    counted = each.groupBy("i", "v", "beside").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counted.groupBy("i", "v").agg(*[F.sum(F.when(F.get("beside", F.lit(j)), F.col("n")).otherwise(0)).alias(f"k{j}") for j in at]), "rank-counts")
    scanned = ordered_scan(counts, ["v"], ["i"], before={f"less{j}": f"k{j}" for j in at})
    ranks = stage(scanned.select("i", "v", *[f"k{j}" for j in at], *[(2 * F.col(f"less{j}") + F.col(f"k{j}") + 1).alias(f"r{j}") for j in at]), "ranks")

    whole = lambda c: F.col(c).cast("decimal(19,0)")
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    own = F.array(*[F.struct(F.sum(f"k{j}").alias("n"), wide(whole(f"r{j}") * whole(f"r{j}") * whole(f"k{j}")).alias("squares")) for j in at])
    sums = ranks.groupBy("i").agg(own.alias("own"))
    for i in at:
        table = ranks.where(F.col("i") == i).select(F.col("v").alias(f"c{i}"), *[F.col(f"r{j}").alias(f"r{i}_{j}") for j in at if j != i])
        d = lookup(d, table, [f"c{i}"])
    pairs = list(combinations(at, 2))
    products = d.agg(*[wide(whole(f"r{i}_{j}") * whole(f"r{j}_{i}")).alias(f"p{i}_{j}") for i, j in pairs])
    listed = products.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"p{i}_{j}").alias("sxy")) for i, j in pairs])))
    x, y = (sums.select(F.col("i").alias(k), F.col("own").alias(f"own_{k}")) for k in "ij")
    joined = listed.join(F.broadcast(x), "i").join(F.broadcast(y), "j").where("sxy is not null")
    name = lambda k: F.get(F.array(*[F.lit(c) for c in cols]), F.col(k))
    mine, theirs = F.get("own_i", F.col("j")), F.get("own_j", F.col("i"))
    n = mine.n.cast("double")
    total = (mine.n.cast("decimal(19,0)") * (mine.n + 1).cast("decimal(19,0)")).cast("double")  # of doubled ranks, with or without ties
    sxx, syy, sxy = (c.cast("double") for c in (mine.squares, theirs.squares, F.col("sxy")))
    spread = F.sqrt((sxx - total * total / n) * (syy - total * total / n))
    return joined.select(name("i").alias("a"), name("j").alias("b"), mine.n.alias("n"), F.when(spread > 0, (sxy - total * total / n) / spread).alias("r"))


def missing_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(pattern, n)``: which of the columns are missing together; a 1 in the text per missing column, in order."""
    marks = F.concat(*[F.when(present(df, c).isNull(), "1").otherwise("0") for c in cols])
    return df.groupBy(marks.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def joint_missingness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(a, b, n_both, n_either, r)`` for each two columns: rows that lack both, rows that lack one, and the correlation of lacking them.

    The rows are read once, into counts per pattern; the pairs are sums over those.
    """
    patterns = stage(missing_patterns(df, cols), "missing-patterns")
    pairs = list(combinations(range(len(cols)), 2))
    lacks = lambda i: F.substring("pattern", i + 1, 1) == "1"
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    single = [count(lacks(i)).alias(f"m{i}") for i in range(len(cols))]
    double = [count(lacks(i) & lacks(j)).alias(f"b{i}_{j}") for i, j in pairs]
    wide = patterns.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"), *single, *double)

    def entry(i: int, j: int) -> Column:
        n, a, b, both = F.col("n"), F.col(f"m{i}"), F.col(f"m{j}"), F.col(f"b{i}_{j}")
        spread = F.sqrt(a * (n - a) * (b * (n - b)))
        r = F.when(spread > 0, (n * both - a * b) / spread)
        return F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), both.alias("n_both"), (a + b - both).alias("n_either"), r.alias("r"))

    return wide.select(F.inline(F.array(*[entry(i, j) for i, j in pairs])))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(n_rows, n_distinct, n_repeats, n_groups, largest)`` over the given columns: repeats are rows beyond the first of their kind."""
    counts = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("c"))
    total = F.coalesce(F.sum("c"), F.lit(0))
    return counts.agg(
        total.alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), (total - F.count(F.lit(1))).alias("n_repeats"),
        F.count_if(F.col("c") > 1).alias("n_groups"), F.coalesce(F.max("c"), F.lit(0)).alias("largest"),
    )


def _corr_with(c: str, target: str) -> Column:
    v = known(F.col(c).cast("double"))
    return F.corr(v, F.when(v.isNotNull(), F.col(target).cast("double")))


def point_biserial(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """``(column, r)`` of each numeric with a 0/1 target."""
    return _per_column(df, cols, {"r": lambda c: _corr_with(c, target)})


def cramers_v(long: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., v)`` = sqrt(chi2 / n / min(r - 1, k - 1)), with the continuity correction on 2 x 2 tables.

    Only the cells that occur are needed: chi2 = n (sum O^2 / (R C) - 1).
    """
    by = list(by)
    cells = long.groupBy(*by, x, y).agg(F.count(F.lit(1)).cast("double").alias("o"))
    # a window group is one row of the table: at most as many cells as y has values
    cells = cells.withColumn("r", F.sum("o").over(Window.partitionBy(*by, x)))
    columns = cells.groupBy(*by, y).agg(F.sum("o").alias("c"), F.sum(F.col("o") * F.col("o") / F.col("r")).alias("t"))
    rows = cells.groupBy(*by, x).agg(F.max("r").alias("r"))
    first = cells.groupBy(*by).agg(F.max(F.struct(x, y, "o", "r")).alias("cell"))
    side_y = columns.groupBy(*by).agg(
        F.sum("c").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("t") / F.col("c")).alias("q"),
        F.sum(1 / F.col("c")).alias("ic"),
        F.max(F.struct(y, "c")).alias("last_y"),
    )
    side_x = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("r"), F.sum(1 / F.col("r")).alias("ir"))
    if by:
        joined = side_y.join(side_x, by).join(first, by)
    else:
        joined = beside(beside(side_y, side_x), first)
    return joined.select(*by, _v_from_sums(x, y).alias("v"))


def _v_from_sums(x: str, y: str) -> Column:
    n = F.col("n")
    plain = n * (F.col("q") - 1)
    # On a 2 x 2 table |O - E| is the same in all four cells; read it from one that occurs, whose column
    # total is that of its class.
    other = n - F.col("last_y.c")
    c = F.when(F.col(f"cell.{y}") == F.col(f"last_y.{y}"), F.col("last_y.c")).otherwise(other)
    gap = F.abs(F.col("cell.o") - F.col("cell.r") * c / n)
    shrunk = gap - F.least(F.lit(0.5), gap)
    corrected = shrunk * shrunk * n * F.col("ir") * F.col("ic")
    chi2 = F.when((F.col("r") == 2) & (F.col("k") == 2), corrected).otherwise(plain)
    smaller = F.least(F.col("r"), F.col("k")) - 1
    return F.when(smaller > 0, F.sqrt(F.greatest(chi2, F.lit(0.0)) / n / smaller))


def association_ranking(df: DataFrame, target: str, max_cat_unique: int | None = None) -> DataFrame:
    """``(feature, correlation, method)``: point-biserial for numbers, Cramér's V for categories.

    Columns with at most one distinct value are left out. With ``max_cat_unique`` the other columns that are
    neither text nor numbers and have more values are not ranked: their method is ``skipped``. Null is a category of its own.
    """
    numeric = columns_of(df, (T.NumericType, T.BooleanType), skip=[target])
    texts = columns_of(df, (T.StringType,))
    cats = [c for c in df.columns if c != target and c not in numeric]
    parts = []
    if numeric:
        v = lambda c: known(F.col(c).cast("double"))
        varies = _per_column(df, numeric, {"r": lambda c: _corr_with(c, target), "varies": lambda c: F.min(v(c)) < F.max(v(c))})
        parts.append(varies.where("varies").select("column", F.col("r").alias("correlation"), F.lit("point-biserial").alias("method")))
    if cats:
        texty = F.col("column").isin(texts) if texts else F.lit(False)
        varied = distinct_counts(df, cats).where(F.col("n_distinct") > 1)
        ranked = texty | (F.col("n_distinct") <= max_cat_unique) if max_cat_unique is not None else F.lit(True)
        wanted = varied.where(ranked)
        if max_cat_unique is not None:
            parts.append(varied.where(~ranked).select("column", F.lit(None).cast("double").alias("correlation"), F.lit("skipped").alias("method")))
        long = text_values(df, cats, [target]).withColumn("value", F.coalesce("value", F.lit("<NA>")))
        found = cramers_v(long, "value", target, ["column"]).join(wanted, "column", "left_semi")
        parts.append(found.select("column", F.col("v").alias("correlation"), F.lit("cramers_v").alias("method")))
    ranked = reduce(DataFrame.unionByName, parts)
    return ranked.select(F.col("column").alias("feature"), "correlation", "method").orderBy(F.desc_nulls_last("correlation"), "feature")


def _row_digest(cols: Sequence[str]) -> Column:
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 10), 16, 10).cast("bigint")


def _digest() -> list[Column]:
    """The sums of row digests ``h`` that ``fingerprint`` returns; each can be combined with that of other rows."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor("h"), F.lit(0).cast("bigint")).alias("mix"),
        F.coalesce(F.sum(F.col("h") % 1_000_003), F.lit(0).cast("bigint")).alias("total"),
    ]


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(n, mix, total)``: an order-free digest of the rows. Columns are rendered as string."""
    return df.select(_row_digest(list(cols or df.columns)).alias("h")).agg(*_digest())


MANIFEST = "file string, bytes bigint, modified timestamp, cols string, n bigint, mix bigint, total bigint"


def fingerprint_files(spark: SparkSession, folder: str, manifest: str, cols: Sequence[str] | None = None) -> DataFrame:
    """``(n, mix, total, n_files, n_read)`` of a folder of Parquet files: ``fingerprint`` of all rows, and the files that were read for it.

    A digest per file is kept in ``manifest``, a folder of its own in storage that executors share. A file is known by path, length,
    time of change and the digested columns; only files that are not known are read, and files that are gone do not count. Files
    are listed without opening them. The folder is to be left alone while it is read; one without files has the digest of
    no rows if ``cols`` are given. A run that ends half-way leaves a manifest that is still right:
    lines are added, and equal lines count once.
    """
    listed = spark.read.format("binaryFile").load(folder)  # finds the files, and partition columns, as a read of the table does
    named = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_size", "bytes"), ("file_modification_time", "modified"))]
    files = stage(listed.select(*named), "listing")
    if cols is None:
        cols = spark.read.parquet(folder).columns
    # quoted and joined, so that no two lists of columns read alike
    files = files.withColumn("cols", F.to_json(F.array(*[F.lit(c) for c in cols])))
    key = ["file", "bytes", "modified", "cols"]
    lines = spark.createDataFrame([], MANIFEST) if not _exists(spark, manifest) else spark.read.schema(MANIFEST).parquet(manifest)
    fresh = stage(files.join(lines.select(*key).distinct(), key, "left_anti"), "fresh")
    n_read = fresh.count()
    if n_read:
        paths = [r.file for r in fresh.select("file").collect()]  # one short text per file, as in the listing that Spark itself keeps
        rows = spark.read.parquet(folder).select("*", F.col("_metadata.file_path").alias("_file")).where(F.col("_metadata.file_path").isin(paths))
        per_file = rows.select(F.col("_file").alias("file"), _row_digest(cols).alias("h")).groupBy("file").agg(*_digest())
        zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n", "mix", "total")}
        fresh.join(per_file, "file", "left").withColumns(zero).select(*key, "n", "mix", "total").write.mode("append").parquet(manifest)
        lines = spark.read.schema(MANIFEST).parquet(manifest)
    whole = files.join(lines.dropDuplicates(key), key).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"),
        F.coalesce(F.bit_xor("mix"), F.lit(0).cast("bigint")).alias("mix"),
        F.coalesce(F.sum("total"), F.lit(0).cast("bigint")).alias("total"),
        F.count(F.lit(1)).alias("n_files"),
    )
    return whole.withColumn("n_read", F.lit(n_read).cast("bigint"))


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and holds a written table, on whatever storage the path names."""
    try:
        return not spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").isEmpty()
    except AnalysisException:
        return False


def dataset_record(df: DataFrame, source: str, uri: str, target: str | None = None, digest_cols: Sequence[str] | None = None) -> DataFrame:
    """One row describing a data set, for a lineage table."""
    nulls = sum((count_where(F.col(c).isNull()) for c in df.columns[1:]), count_where(F.col(df.columns[0]).isNull()))
    facts = [F.count(F.lit(1)).alias("n_rows"), nulls.alias("n_missing")]
    if target:
        t = F.col(target).cast("double")
        facts += [count_where(t == 1).alias("n_positive"), count_where(t == 0).alias("n_negative"), F.avg(t).alias("target_rate")]
    digest = fingerprint(df, digest_cols).select(F.struct("mix", "total").alias("d")).scalar()
    return df.agg(*facts).select(
        F.lit(source).alias("source"),
        F.lit(uri).alias("uri"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(",".join(t for _, t in df.dtypes)).alias("dtypes"),
        "*",
        F.concat_ws("-", digest.getField("mix").cast("string"), digest.getField("total").cast("string")).alias("data_hash"),
    )


def moments(df: DataFrame, cols: Sequence[str], *, exact: bool = True) -> DataFrame:
    """``(column, n, n_null, mean, std, skew, kurt, min, q25, median, q75, max, n_distinct, top, top_n)``."""
    v = lambda c: known(F.col(c).cast("double"))
    base = _per_column(
        df,
        cols,
        {
            "n": lambda c: F.count(v(c)),
            "n_null": lambda c: count_where(v(c).isNull()),
            "mean": lambda c: F.avg(v(c)),
            "std": lambda c: F.stddev_samp(v(c)),
            "skew": lambda c: F.skewness(v(c)),
            "kurt": lambda c: F.kurtosis(v(c)),
            "min": lambda c: F.min(v(c)),
            "max": lambda c: F.max(v(c)),
        },
    )
    long = long_numeric(df, cols).select("column", known("value").alias("value")).where("value is not null")
    q = quantiles(long, "value", [0.25, 0.5, 0.75], ["column"], exact=exact).select(
        "column", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75")
    )
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    # commonest value, smallest on ties
    common = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"), F.min_by(F.struct("value", "c"), F.struct(-F.col("c"), F.col("value"))).alias("m")
    )
    top = common.select("column", "n_distinct", F.col("m.value").alias("top"), F.col("m.c").alias("top_n"))
    return base.join(q, "column", "left").join(top, "column", "left")
