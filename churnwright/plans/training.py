"""Training, tuning and scoring on rows derived from the tables.

What a learner finds has no SQL form in general. The queries return what is certain: rows scored and classes counted,
fold sizes, parameters tried, that the planted signal is found (ROC-AUC over one half); and, where it has a closed form
(one category as the only feature), the scores themselves.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnwright.functions import seed_key
from churnwright.operators import scoring as sc
from churnwright.operators.sampling import top_k
from churnwright.operators.splitting import expanding_folds, stratified_folds
from churnwright.plans.registry import ctes, query, rounded
from churnwright.session import new_path, stage
from churnwright.sources.writers import write_table
from churnwright.training import boosting as bo
from churnwright.training import models as mo
from churnwright.training import search as se

NUMERIC = ["o_totalprice", "items", "quantity", "returned"]
CATEGORIES = ["o_orderpriority", "segment"]


def training_rows(t):
    """One row per order: its lines summed up, its customer's segment, and a label with a planted signal."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("l_quantity").alias("quantity"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    rows = t.orders.join(lines, "o_orderkey").join(customers, "o_custkey")
    signal = F.col("o_totalprice") / 500000 + F.col("returned") / 10 + F.when(F.col("segment") == "BUILDING", 0.3).otherwise(0.0)
    noise = F.conv(F.substring(seed_key(7, "o_orderkey"), 1, 6), 16, 10).cast("double") / 2**24
    draw = F.substring(seed_key(11, "o_orderkey"), 1, 2)
    ready = rows.select(
        "o_orderkey", "o_orderdate", *[F.col(c).cast("double").alias(c) for c in NUMERIC], *CATEGORIES,
        (signal + noise > 1.2).cast("double").alias("label"), (draw < "33").alias("is_valid"),
    )
    return stage(ready, "training")  # learners read their input many times


def _fit_boosted(train, valid, params):
    both = train.withColumn("is_valid", F.lit(False)).unionByName(valid.withColumn("is_valid", F.lit(True)))
    learner = mo.boosted_trees("label", rounds=params.get("rounds", 5), depth=params.get("depth", 3), rate=params.get("rate", 0.1), validation="is_valid")
    model = mo.fit(both, mo.feature_stages(NUMERIC, CATEGORIES, False), learner)
    return mo.score(model, valid, ["o_orderkey", "label"])


def _fit_logistic(train, valid, params):
    weighted = mo.balanced_weights(train, "label")
    model = mo.fit(weighted, mo.feature_stages(NUMERIC, CATEGORIES, True), mo.logistic("label", weight="weight", reg=params.get("reg", 0.0), rounds=20))
    return mo.score(model, valid, ["o_orderkey", "label"])


def _sides(t):
    rows = training_rows(t)
    return rows.where("not is_valid"), rows.where("is_valid")


ROWS = """WITH l AS (SELECT l_orderkey AS o_orderkey, COUNT(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1),
  r AS (SELECT o_orderkey, o_orderdate, c_mktsegment AS segment,
          CAST((o_totalprice / 500000 + returned / 10 + CASE WHEN c_mktsegment = 'BUILDING' THEN 0.3 ELSE 0.0 END)
               + CAST('0x' || substr(md5('7|' || CAST(o_orderkey AS VARCHAR)), 1, 6) AS BIGINT) / 16777216.0 > 1.2 AS INTEGER) AS label,
          substr(md5('11|' || CAST(o_orderkey AS VARCHAR)), 1, 2) < '33' AS is_valid
        FROM orders JOIN l USING (o_orderkey) JOIN customer ON c_custkey = o_custkey)"""
FOUND = ROWS + " SELECT CAST(SUM(label) AS BIGINT) AS n_pos, COUNT(*) - CAST(SUM(label) AS BIGINT) AS n_neg, true AS signal_found FROM r WHERE is_valid"


def _quality(scored):
    return sc.evaluate(sc.threshold_curve(scored)).select(F.col("n_pos").cast("bigint"), F.col("n_neg").cast("bigint"), (F.col("roc_auc") > 0.5).alias("signal_found"))


@query("t1_boosted_trees", FOUND)
def _(t):
    return _quality(_fit_boosted(*_sides(t), {}))


@query("t2_logistic_balanced", FOUND)
def _(t):
    return _quality(_fit_logistic(*_sides(t), {}))


@query(
    "t1b_patience",
    "SELECT CAST(12 AS BIGINT) AS n_rounds, true AS is_least, true AS cut_scores_equal, true AS signal_found FROM region WHERE r_regionkey = 0",
)
def _(t):
    """All rounds fitted with row and column sampling, the validation loss of each, and the scores of the model cut at the best one."""
    train, valid = _sides(t)
    learner = mo.boosted_trees("label", rounds=12, depth=3, rate=0.3, rows=0.8, columns="0.7")
    model = mo.fit(train, mo.feature_stages(NUMERIC, CATEGORIES, False), learner)
    losses = mo.validation_curve(model, valid)
    best = mo.best_round(losses, 5)
    cut = sc.evaluate(sc.threshold_curve(mo.score_cut(model, valid, best, ["o_orderkey", "label"])))
    all_rounds = mo.score_cut(model, valid, len(losses), ["o_orderkey"], "cut").join(mo.score(model, valid, ["o_orderkey"], "whole"), "o_orderkey")
    gap = all_rounds.groupBy().agg(F.max(F.abs(F.col("cut") - F.col("whole"))).alias("g")).scalar()
    return cut.select(
        F.lit(len(losses)).cast("bigint").alias("n_rounds"), F.lit(losses[best - 1] == min(losses[: best + 5])).alias("is_least"),
        (gap < 1e-9).alias("cut_scores_equal"), (F.col("roc_auc") > 0.5).alias("signal_found"),
    )


@query(
    "t2b_logistic_closed_form",
    ROWS
    + """, c AS (SELECT SUM(label) AS p, COUNT(*) - SUM(label) AS n FROM r WHERE NOT is_valid), g AS (SELECT segment, SUM(label) / (SELECT p FROM c) AS p, (COUNT(*) - SUM(label)) / (SELECT n FROM c) AS n FROM r WHERE NOT is_valid GROUP BY 1)
         SELECT segment, ROUND(p / (p + n), 3) AS score FROM g WHERE segment IN (SELECT segment FROM r WHERE is_valid)""",
)
def _(t):
    """One category, no penalty: the fitted probability is the weighted rate of each value."""
    train, valid = _sides(t)
    weighted = mo.balanced_weights(train, "label")
    model = mo.fit(weighted, mo.feature_stages([], ["segment"], True), mo.logistic("label", weight="weight", rounds=200))
    return rounded(mo.score(model, valid, ["segment"]).groupBy("segment").agg(F.max("score").alias("score")), 3)


@query(
    "xu2b_tree_closed_form",
    ROWS + " SELECT segment, ROUND(AVG(label), 6) AS score FROM r WHERE NOT is_valid AND segment IN (SELECT segment FROM r WHERE is_valid) GROUP BY 1",
)
def _(t):
    """One category and a deep enough tree: the leaves are the values, the score is their rate."""
    from pyspark.ml.regression import DecisionTreeRegressor

    train, valid = _sides(t)
    model = mo.fit(train, mo.feature_stages([], ["segment"], False), DecisionTreeRegressor(labelCol="label", maxDepth=6))
    return rounded(mo.score(model, valid, ["segment"]).groupBy("segment").agg(F.max("score").alias("score")))


@query(
    "t1c_regularised_leaves",
    ROWS
    + """, p AS (SELECT AVG(CAST(label AS DOUBLE)) AS p FROM r WHERE NOT is_valid),
        g AS (SELECT segment, SUM(p - label) AS g, SUM(p * (1 - p)) AS h, MAX(LN(p / (1 - p))) AS base FROM r, p WHERE NOT is_valid GROUP BY 1)
        SELECT CAST(l2 AS DOUBLE) AS l2, segment, ROUND(base - 0.3 * g / (h + l2), 6) AS margin, ROUND(1 / (1 + EXP(-(base - 0.3 * g / (h + l2)))), 6) AS score
        FROM g, (SELECT unnest([0, 5]) AS l2) WHERE segment IN (SELECT segment FROM r WHERE is_valid)""",
)
def _(t):
    """One round over one category: base and leaves have a closed form, with and without the penalty."""
    train, valid = _sides(t)
    found = []
    for l2 in (0.0, 5.0):
        model = bo.fit_boosted(train, mo.feature_stages([], ["segment"], False), "label", rounds=1, depth=6, rate=0.3, l2=l2)
        rows = model.prepared(valid).select("segment", model.margin().alias("margin")).distinct()
        found.append(rows.select(F.lit(l2).alias("l2"), "segment", "margin", bo.sigmoid(F.col("margin")).alias("score")))
    return rounded(found[0].unionByName(found[1]))


@query(
    "t1d_regularised_quality",
    ROWS + " SELECT CAST(SUM(label) AS BIGINT) AS n_pos, CAST(COUNT(*) - SUM(label) AS BIGINT) AS n_neg, true AS sums_to_margin, true AS gains FROM r WHERE is_valid",
)
def _(t):
    """Ten rounds over all features: contributions add up to the margin in every row, and ten rounds rank better than two."""
    train, valid = _sides(t)
    fitted = lambda rounds: bo.fit_boosted(train, mo.feature_stages(NUMERIC, CATEGORIES, False), "label", rounds=rounds, depth=3, rate=0.3, key="o_orderkey", rows=0.8)
    long, short = fitted(10), fitted(2)
    explained = bo.contributions(long, valid, ["o_orderkey"])
    gap = F.abs(F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x) - F.col("margin"))
    worst = explained.groupBy().agg(F.max(gap).alias("g")).scalar()
    auc = lambda m: sc.evaluate(sc.threshold_curve(m.score(valid, ["label"])))
    return auc(long).select(
        F.col("n_pos").cast("bigint"), F.col("n_neg").cast("bigint"), (worst < 1e-9).alias("sums_to_margin"), (F.col("roc_auc") > auc(short).select("roc_auc").scalar()).alias("gains")
    )


@query("t3_forest_balanced", FOUND)
def _(t):
    train, valid = _sides(t)
    model = mo.fit(mo.balanced_weights(train, "label"), mo.feature_stages(NUMERIC, CATEGORIES, False), mo.forest("label", weight="weight", trees=10))
    return _quality(mo.score(model, valid, ["o_orderkey", "label"]))


@query(
    "t4_balanced_weights",
    ctes("scored")
    + """, c AS (SELECT segment, label, COUNT(*) AS n FROM scored GROUP BY 1, 2)
         SELECT segment, label, n, ROUND((SELECT SUM(n) FROM c) / (2.0 * (SELECT SUM(n) FROM c k WHERE k.label = c.label)), 6) AS weight FROM c""",
)
def _(t):
    weighted = mo.balanced_weights(t.derive("scored"), "label")
    return rounded(weighted.groupBy("segment", "label").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")))


@query("t5_grid_search", "SELECT CAST(r_regionkey AS BIGINT) AS job_index, [0.0, 0.01, 0.1][r_regionkey + 1]::DOUBLE AS reg, true AS signal_found FROM region WHERE r_regionkey < 3")
def _(t):
    runs = se.search(*_sides(t), se.grid({"reg": [0.0, 0.01, 0.1]}), _fit_logistic)
    return runs.select(F.col("job_index").cast("bigint"), "reg", (F.col("roc_auc") > 0.5).alias("signal_found"))


@query("t6_random_search", "SELECT CAST(r_regionkey AS BIGINT) AS job_index, true AS within, true AS signal_found FROM region WHERE r_regionkey < 2")
def _(t):
    draws = se.random_draws({"rounds": (3, 6), "depth": (2, 4), "rate": (0.05, 0.3)}, 2)
    runs = se.search(*_sides(t), draws, _fit_boosted, parallel=2)
    within = F.col("rounds").between(3, 6) & F.col("depth").between(2, 4) & F.col("rate").between(0.05, 0.3)
    return runs.select(F.col("job_index").cast("bigint"), within.alias("within"), (F.col("roc_auc") > 0.5).alias("signal_found"))


@query(
    "t6b_successive_halving",
    ROWS
    + """, n AS (SELECT rung, share, COUNT(*) AS n_train FROM r, (SELECT unnest([0, 1, 2]) AS rung, unnest([0.25, 0.5, 1.0]) AS share, unnest(['40000000', '80000000', 'g']) AS bound)
             WHERE NOT is_valid AND substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 8) < bound GROUP BY ALL)
        SELECT CAST(rung AS INTEGER) AS rung, CAST(share AS DOUBLE) AS share, n_train, CAST([4, 2, 1][rung + 1] AS BIGINT) AS n_runs, CAST([2, 1, 1][rung + 1] AS BIGINT) AS n_survived, true AS best_survived, true AS known_before FROM n""",
)
def _(t):
    """Four penalties over three rungs; sizes and survivors are recomputed from the table of runs."""
    runs = stage(se.halving(*_sides(t), se.grid({"reg": [0.0, 0.05, 0.2, 1.0]}), _fit_logistic, "o_orderkey", eta=2, share=0.25), "halving")
    place = F.row_number().over(Window.partitionBy("rung").orderBy(F.desc_nulls_last("roc_auc"), "job_index"))  # a row per run
    ranked = runs.withColumn("place", place)
    before = runs.where("survived").select((F.col("rung") + 1).alias("rung"), "job_index", F.lit(True).alias("_known"))
    checked = ranked.join(before, ["rung", "job_index"], "left")
    sizes = checked.groupBy("rung", "share", "n_train").agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_if("survived").alias("n_survived"), F.max(F.when(F.col("survived"), F.col("place"))).alias("last"),
        F.every((F.col("rung") == 0) | F.coalesce("_known", F.lit(False))).alias("known_before"),
    )
    return sizes.select("rung", "share", "n_train", "n_runs", "n_survived", (F.col("last") == F.col("n_survived")).alias("best_survived"), "known_before")


@query("t7_run_table", "SELECT CAST(i AS BIGINT) AS place, CAST(4 AS BIGINT) AS n_runs, true AS ranked, true AS same FROM (SELECT unnest([1, 2, 3, 4]) AS i), region WHERE r_regionkey = 0")
def _(t):
    """Two searches appended to one table of runs, read back and ranked; the summary of what was read equals that of what was run."""
    path, sides = new_path(t.spark, "runs"), _sides(t)
    for regs in ([0.0, 0.05], [0.2, 0.5]):
        write_table(se.search(*sides, se.grid({"reg": regs}), _fit_logistic), path, "json", "append")
    runs = t.spark.read.schema("job_index int, reg double, roc_auc double, pr_auc double, threshold double, recall double, precision double, f1 double").json(path)
    by = Window.partitionBy(F.lit(0)).orderBy(F.desc("roc_auc"), "reg")  # one row per run
    ranked = runs.withColumn("place", F.row_number().over(by).cast("bigint")).withColumn("ahead", F.lag("roc_auc").over(by))
    total = se.search_summary(runs).select(F.struct("best", "n_runs").alias("s")).scalar()
    held = ranked.withColumn("s", total)
    return held.select("place", F.col("s.n_runs").alias("n_runs"), F.coalesce(F.col("ahead") >= F.col("roc_auc"), F.col("roc_auc") == F.col("s.best")).alias("ranked"),
                       F.col("reg").isin(0.0, 0.05, 0.2, 0.5).alias("same"))


def _folds(found):
    return found.select(F.col("fold").cast("bigint"), F.col("n_train").cast("bigint"), F.col("n_val").cast("bigint"), (F.col("roc_auc") > 0.5).alias("signal_found"))


@query(
    "t8_cross_validation",
    ROWS
    + """, f AS (SELECT (ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % 3 AS fold FROM r)
         SELECT CAST(fold + 1 AS BIGINT) AS fold, (SELECT COUNT(*) FROM f) - COUNT(*) AS n_train, COUNT(*) AS n_val, true AS signal_found FROM f GROUP BY fold""",
)
def _(t):
    rows = stage(stratified_folds(training_rows(t), "label", "o_orderkey", 3), "folds")  # every fit reads it
    return _folds(se.cross_validate(rows, 3, _fit_logistic))


@query(
    "t8b_expanding_validation",
    ROWS
    + """, n AS (SELECT COUNT(*) AS n, COUNT(*) // 4 AS size FROM r)
         SELECT CAST(k AS BIGINT) AS fold, n - size * (4 - k) AS n_train, size AS n_val, true AS signal_found FROM n, (SELECT unnest([1, 2, 3]) AS k)""",
)
def _(t):
    rows = stage(expanding_folds(training_rows(t), ["o_orderdate", "o_orderkey"], 3), "folds")
    return _folds(se.cross_validate(rows, 3, _fit_logistic, expanding=True))


def _model(t) -> tuple[PipelineModel, object]:
    train, valid = _sides(t)
    model = mo.fit(train, mo.feature_stages(NUMERIC, CATEGORIES, False), mo.forest("label", trees=5))
    return model, valid


@query(
    "t9_feature_importance",
    "SELECT unnest(['items', 'o_orderpriority', 'o_totalprice', 'quantity', 'returned', 'segment']) AS feature, true AS is_share, CAST(1.0 AS DOUBLE) AS total FROM region WHERE r_regionkey = 0",
)
def _(t):
    model, valid = _model(t)
    ranked = top_k(mo.importances(model, model.transform(valid)), F.col("importance"), 20, "feature")
    total = ranked.groupBy().agg(F.sum("importance").alias("s")).scalar()
    return rounded(ranked.select(F.regexp_replace("feature", "__ix$", "").alias("feature"), F.col("importance").between(0, 1).alias("is_share"), total.alias("total")))


@query("t10_batch_score", ROWS + " SELECT o_orderkey, true AS is_share FROM r WHERE is_valid")
def _(t):
    model, valid = _model(t)
    return mo.score(model, valid, ["o_orderkey"]).select("o_orderkey", F.col("score").between(0, 1).alias("is_share"))


@query(
    "t10b_foreign_model",
    "SELECT l_orderkey, l_linenumber, ROUND(1.0 / (1.0 + EXP(-(l_quantity * 0.1 - l_discount * 10 - 2))), 6) AS score FROM lineitem",
)
def _(t):
    def load():
        import numpy as np

        return lambda x: 1.0 / (1.0 + np.exp(-(x["l_quantity"] * 0.1 - x["l_discount"] * 10 - 2)))

    return rounded(mo.score_foreign(t.lineitem, load, ["l_quantity", "l_discount"], ["l_orderkey", "l_linenumber"]))


@query("xu2_user_model", FOUND)
def _(t):
    from pyspark.ml.classification import DecisionTreeClassifier

    train, valid = _sides(t)
    model = mo.fit(train, mo.feature_stages(NUMERIC, CATEGORIES, False), DecisionTreeClassifier(labelCol="label", maxDepth=4))
    return _quality(mo.score(model, valid, ["o_orderkey", "label"]))
