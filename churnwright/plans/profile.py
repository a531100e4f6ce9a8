"""Profiles, shares and associations."""

from pyspark.sql import functions as F

from churnwright.operators import profiling as p
from churnwright.operators.gates import fold_summary
from churnwright.plans.registry import ctes, query, rounded
from churnwright.session import new_path
from churnwright.training.search import search_summary

DIRTY = ctes("dirty")
LINES = ctes("lines")


@query("a1_shape", "SELECT COUNT(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem")
def _(t):
    return p.shape(t.lineitem)


def _null_rows(*cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS n_null, COUNT({c}) AS n_known, ROUND(COUNT(*) FILTER ({c} IS NULL) / COUNT(*), 6) AS null_ratio FROM dirty"
        for c in cols
    )


@query("a2_null_profile", f"{DIRTY} {_null_rows('price', 'priority', 'placed', 'visits', 'target', 'status')}")
def _(t):
    return rounded(p.null_profile(t.derive("dirty"), ["price", "priority", "placed", "visits", "target", "status"]))


@query(
    "a3_value_counts",
    DIRTY + " SELECT priority AS value, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(priority) FROM dirty), 6) AS share FROM dirty WHERE priority IS NOT NULL GROUP BY 1",
)
def _(t):
    return rounded(p.value_counts(t.derive("dirty"), "priority"))


@query("a4_target_rate", DIRTY + " SELECT COUNT(target) AS n, ROUND(AVG(CAST(target AS DOUBLE)), 6) AS rate FROM dirty")
def _(t):
    return rounded(p.target_rate(t.derive("dirty"), "target"))


A5_COLS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "a5_distinct_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS n_distinct FROM orders" for c in A5_COLS),
)
def _(t):
    return p.distinct_counts(t.orders, A5_COLS)


@query("a5b_drop_constant", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    df = t.orders.select("o_orderkey", "o_totalprice", F.lit("x").alias("same"), F.lit(None).cast("int").alias("empty"))
    return p.drop_constant(df)


@query(
    "a6_schema_profile",
    """SELECT 'o_orderdate' AS "column", 'timestamp_ntz' AS dtype, false AS nullable, strftime(MIN(o_orderdate), '%Y-%m-%d %H:%M:%S') AS low, strftime(MAX(o_orderdate), '%Y-%m-%d %H:%M:%S') AS high, CAST(NULL AS DOUBLE) AS n_categories, NULL AS categories FROM orders
       UNION ALL SELECT 'priority', 'string', true, NULL, NULL, CAST(COUNT(DISTINCT o_orderpriority) AS DOUBLE), (SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT o_orderpriority AS x FROM orders WHERE o_orderkey % 9 <> 0 ORDER BY 1 LIMIT 3)) FROM orders WHERE o_orderkey % 9 <> 0
       UNION ALL SELECT 'o_custkey', 'bigint', false, CAST(CAST(MIN(o_custkey) AS DOUBLE) AS VARCHAR), CAST(CAST(MAX(o_custkey) AS DOUBLE) AS VARCHAR), NULL, NULL FROM orders""",
)
def _(t):
    df = t.orders.select("o_orderdate", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("priority"), "o_custkey")
    return p.schema_profile(df, 3).select(
        "column", "dtype", "nullable", F.col("min").alias("low"), F.col("max").alias("high"),
        F.col("n_categories").cast("double").alias("n_categories"), F.array_join("example_values", "|").alias("categories"),
    )


@query(
    "a7_means_by_target",
    LINES
    + " UNION ALL ".join(
        f" SELECT '{c}' AS \"column\", ROUND(AVG({c}) FILTER (target = 0), 6) AS mean_0, ROUND(AVG({c}) FILTER (target = 1), 6) AS mean_1 FROM lines" for c in ("quantity", "discount", "tax")
    ),
)
def _(t):
    return rounded(p.means_by_target(t.derive("lines"), ["quantity", "discount", "tax"], "target", [0, 1]))


@query("a8_contingency", LINES + " SELECT size_class, COUNT(*) FILTER (target = 0) AS n_0, COUNT(*) FILTER (target = 1) AS n_1 FROM lines GROUP BY 1")
def _(t):
    return p.contingency(t.derive("lines"), "size_class", "target", [0, 1])


@query(
    "a9_target_share",
    LINES
    + """, m AS (SELECT 'size_class' AS "column", size_class AS category, target FROM lines UNION ALL SELECT 'quarter', quarter, target FROM lines)
         SELECT "column", category, target, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY "column", category), 6) AS share FROM m GROUP BY 1, 2, 3""",
)
def _(t):
    long = p.top_categories(t.derive("lines"), ["size_class", "quarter"], 10, ["target"])
    return rounded(p.target_share(long, "target"))


@query(
    "a10_histogram",
    """SELECT CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 21 ELSE FLOOR((o_totalprice - 50000) * 20 / 400000) + 1 END AS INTEGER) AS bin, COUNT(*) AS n FROM orders GROUP BY 1""",
)
def _(t):
    return p.histogram(t.orders, "o_totalprice", 50000.0, 450000.0, 20)


@query(
    "a11_box_stats",
    LINES
    + """, m AS (SELECT target, 'price' AS "column", price AS value FROM lines UNION ALL SELECT target, 'quantity', quantity FROM lines),
           q AS (SELECT target, "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS md, quantile_cont(value, 0.75) AS q3 FROM m GROUP BY 1, 2)
         SELECT target, "column", ROUND(q1, 6) AS q1, ROUND(md, 6) AS median, ROUND(q3, 6) AS q3,
                MIN(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) AS whisker_low, MAX(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
                COUNT(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
         FROM m JOIN q USING (target, "column") GROUP BY target, "column", q1, md, q3""",
)
def _(t):
    return rounded(p.box_stats(t.derive("lines"), ["price", "quantity"], "target"))


PAIRS = [("quantity", "price"), ("quantity", "discount"), ("quantity", "tax"), ("price", "discount"), ("price", "tax"), ("discount", "tax")]


@query(
    "a12_correlations",
    LINES + " UNION ALL ".join(f" SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a}, {b}), 6) AS r FROM lines" for a, b in PAIRS),
)
def _(t):
    return rounded(p.correlations(t.derive("lines"), ["quantity", "price", "discount", "tax"]))


def _spearman_sql(a: str, b: str) -> str:
    rank = lambda c: f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2"
    return f" SELECT '{a}' AS a, '{b}' AS b, COUNT(*) AS n, ROUND(CORR(x, y), 6) AS r FROM (SELECT {rank(a)} AS x, {rank(b)} AS y FROM lines WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"


@query("a18b_rank_correlations", LINES + " UNION ALL ".join(_spearman_sql(a, b) for a, b in PAIRS))
def _(t):
    return rounded(p.rank_correlations(t.derive("lines"), ["quantity", "price", "discount", "tax"]))


GAPS = ["price", "priority", "placed", "visits", "target"]


@query(
    "a18c_joint_missingness",
    DIRTY
    + " UNION ALL ".join(
        f" SELECT '{a}' AS a, '{b}' AS b, COUNT(*) FILTER ({a} IS NULL AND {b} IS NULL) AS n_both, COUNT(*) FILTER ({a} IS NULL OR {b} IS NULL) AS n_either, ROUND(CORR(CAST({a} IS NULL AS INTEGER), CAST({b} IS NULL AS INTEGER)), 6) AS r FROM dirty"
        for i, a in enumerate(GAPS) for b in GAPS[i + 1 :]
    ),
)
def _(t):
    return rounded(p.joint_missingness(t.derive("dirty"), GAPS))


@query(
    "a18d_duplicate_rows",
    """WITH c AS (SELECT l_partkey, l_quantity, COUNT(*) AS c FROM lineitem GROUP BY 1, 2)
       SELECT CAST(SUM(c) AS BIGINT) AS n_rows, COUNT(*) AS n_distinct, CAST(SUM(c) - COUNT(*) AS BIGINT) AS n_repeats, COUNT(*) FILTER (c > 1) AS n_groups, MAX(c) AS largest FROM c""",
)
def _(t):
    return p.duplicate_rows(t.lineitem, ["l_partkey", "l_quantity"])


@query(
    "a13_point_biserial",
    LINES + " UNION ALL ".join(f" SELECT '{c}' AS \"column\", ROUND(CORR({c}, target), 6) AS r FROM lines" for c in ("quantity", "price", "discount", "tax")),
)
def _(t):
    return rounded(p.point_biserial(t.derive("lines"), ["quantity", "price", "discount", "tax"], "target"))


def _cramers_sql(column: str, expr: str, target: str = "target", source: str = "lines") -> str:
    """Cramér's V written out over the full table of expected counts."""
    return f"""(WITH c AS (SELECT {expr} AS x, {target} AS y, COUNT(*) AS o FROM {source} GROUP BY 1, 2),
        xs AS (SELECT x, SUM(o) AS r FROM c GROUP BY 1), ys AS (SELECT y, SUM(o) AS k FROM c GROUP BY 1), nn AS (SELECT CAST(SUM(o) AS DOUBLE) AS n FROM c),
        d AS (SELECT COUNT(*) AS rows_, (SELECT COUNT(*) FROM ys) AS cols_ FROM xs),
        e AS (SELECT COALESCE(o, 0) AS o, r * k / n AS e FROM xs, ys, nn LEFT JOIN c ON c.x = xs.x AND c.y = ys.y),
        g AS (SELECT o, e, CASE WHEN rows_ = 2 AND cols_ = 2 THEN GREATEST(ABS(o - e) - 0.5, 0) ELSE ABS(o - e) END AS gap FROM e, d)
        SELECT '{column}' AS feature, ROUND(SQRT(SUM(gap * gap / e) / MAX(n) / MAX(LEAST(rows_, cols_) - 1)), 6) AS correlation FROM g, nn, d)"""


@query("a14_cramers_v", LINES + f" SELECT correlation AS v FROM {_cramers_sql('x', 'size_class')}")
def _(t):
    return rounded(p.cramers_v(t.derive("lines"), "size_class", "target"))


@query("a14b_cramers_v_2x2", LINES + f" SELECT correlation AS v FROM {_cramers_sql('x', 'linestatus')}")
def _(t):
    return rounded(p.cramers_v(t.derive("lines"), "linestatus", "target"))


@query(
    "a15_association_ranking",
    LINES
    + " UNION ALL ".join(f" SELECT *, 'cramers_v' AS method FROM {_cramers_sql(c, c)}" for c in ("linestatus", "quarter", "size_class"))
    + "".join(f" UNION ALL SELECT '{c}', ROUND(CORR({c}, target), 6), 'point-biserial' FROM lines" for c in ("quantity", "price", "discount", "tax")),
)
def _(t):
    return rounded(p.association_ranking(t.derive("lines"), "target"))


FINGERPRINT = """SELECT COUNT(*) AS n, bit_xor(h) AS mix, CAST(SUM(h % 1000003) AS BIGINT) AS total FROM (
   SELECT CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus || '|' || o_orderpriority), 1, 10) AS BIGINT) AS h FROM orders)"""
HASHED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("a16_fingerprint", FINGERPRINT)
def _(t):
    return p.fingerprint(t.orders, HASHED)


@query(
    "a16b_incremental_fingerprint",
    f"SELECT f.*, s.n_first, CAST(0 AS BIGINT) AS n_again, true AS only_new FROM ({FINGERPRINT}) f, (SELECT COUNT(*) AS n_first FROM orders WHERE o_orderkey % 3 < 2) s",
)
def _(t):
    """Two of three orders are written and digested, the rest is added: only files of the second part are read, and none in a third look."""
    path, manifest = new_path(t.spark, "files"), new_path(t.spark, "manifest")
    parts = [t.orders.where("o_orderkey % 3 < 2"), t.orders.where("o_orderkey % 3 = 2")]
    seen = []
    for rows in [*parts, None]:
        if rows is not None:
            rows.write.mode("append").parquet(path)
        seen.append(p.fingerprint_files(t.spark, path, manifest, HASHED))
    first, second, third = (s.first() for s in seen)
    only_new = second.n_read == second.n_files - first.n_files
    return seen[2].select(
        "n", "mix", "total", F.lit(first.n).cast("bigint").alias("n_first"), F.lit(third.n_read).cast("bigint").alias("n_again"), F.lit(only_new).alias("only_new")
    )


@query(
    "a17_dataset_record",
    DIRTY
    + """, f AS (SELECT bit_xor(h) AS mix, CAST(SUM(h % 1000003) AS BIGINT) AS total FROM (
           SELECT CAST('0x' || substr(md5(COALESCE(priority, '\\N') || '|' || COALESCE(CAST(target AS VARCHAR), '\\N')), 1, 10) AS BIGINT) AS h FROM dirty))
         SELECT 'parquet' AS source, 'orders' AS uri, CAST(2 AS INTEGER) AS n_columns, COUNT(*) AS n_rows, COUNT(*) FILTER (priority IS NULL) + COUNT(*) FILTER (target IS NULL) AS n_missing,
                COUNT(*) FILTER (target = 1) AS n_positive, COUNT(*) FILTER (target = 0) AS n_negative, ROUND(AVG(CAST(target AS DOUBLE)), 6) AS target_rate,
                (SELECT CAST(mix AS VARCHAR) || '-' || CAST(total AS VARCHAR) FROM f) AS data_hash FROM dirty""",
)
def _(t):
    return rounded(p.dataset_record(t.derive("dirty").select("priority", "target"), "parquet", "orders", "target").drop("columns", "dtypes"))


def _moments_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", COUNT({c}) AS n, COUNT(*) FILTER ({c} IS NULL) AS n_null, ROUND(AVG({c}), 5) AS mean, ROUND(STDDEV_SAMP({c}), 5) AS std,
        ROUND((SELECT SUM(POW({c} - m, 3)) / COUNT({c}) / POW(SUM(POW({c} - m, 2)) / COUNT({c}), 1.5) FROM lines, (SELECT AVG({c}) AS m FROM lines)), 5) AS skew,
        ROUND(kurtosis_pop({c}), 5) AS kurt, MIN({c}) AS min, ROUND(quantile_cont({c}, 0.25), 5) AS q25, ROUND(quantile_cont({c}, 0.5), 5) AS median, ROUND(quantile_cont({c}, 0.75), 5) AS q75,
        MAX({c}) AS max, COUNT(DISTINCT {c}) AS n_distinct, (SELECT v FROM (SELECT {c} AS v, COUNT(*) AS k FROM lines WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY k DESC, v LIMIT 1)) AS top,
        (SELECT k FROM (SELECT {c} AS v, COUNT(*) AS k FROM lines WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY k DESC, v LIMIT 1)) AS top_n FROM lines"""


@query("a18_moments", LINES + " " + " UNION ALL ".join(_moments_sql(c) for c in ("quantity", "discount", "tax")))
def _(t):
    return rounded(p.moments(t.derive("lines"), ["quantity", "discount", "tax"]), 5)


FOLDS = """, f AS (SELECT run, fold, AVG(score) AS m, AVG(CAST(label AS DOUBLE)) AS r FROM scored GROUP BY 1, 2)"""


def _folds(t):
    return t.derive("scored").groupBy("run", "fold").agg(F.avg("score").alias("m"), F.avg(F.col("label").cast("double")).alias("r"))


@query("a19_fold_mean_std_pop", ctes("scored") + FOLDS + " SELECT run, 'm' AS metric, ROUND(AVG(m), 6) AS mean, ROUND(STDDEV_POP(m), 6) AS std_pop FROM f GROUP BY 1 UNION ALL SELECT run, 'r', ROUND(AVG(r), 6), ROUND(STDDEV_POP(r), 6) FROM f GROUP BY 1")
def _(t):
    return rounded(fold_summary(_folds(t), ["m", "r"], ["run"]).select("run", "metric", "mean", "std_pop"))


@query("a20_fold_mean_std_samp", ctes("scored") + FOLDS + " SELECT run, 'm' AS metric, ROUND(AVG(m), 6) AS mean, ROUND(STDDEV_SAMP(m), 6) AS std_samp FROM f GROUP BY 1")
def _(t):
    return rounded(fold_summary(_folds(t), ["m"], ["run"]).select("run", "metric", "mean", "std_samp"))


@query("a21_search_summary", ctes("scored") + FOLDS + " SELECT ROUND(MAX(m), 6) AS best, ROUND(AVG(m), 6) AS mean, ROUND(STDDEV_SAMP(m), 6) AS std, COUNT(*) AS n_runs FROM f")
def _(t):
    return rounded(search_summary(_folds(t), "m"))
