"""Scored-row metrics, gates and the registry."""

from pyspark.sql import functions as F

from churnwright.operators import gates as g
from churnwright.operators import scoring as m
from churnwright.operators.lookups import with_truth
from churnwright.operators.splitting import time_split
from churnwright.plans.registry import ctes, query, rounded

SCORED = ctes("scored")


def curve_sql(source: str, by: tuple[str, ...] = ("segment",), score: str = "score", prefix: str = "") -> str:
    """CTEs ``<prefix>curve`` and ``<prefix>rank`` for scored rows."""
    b = ", ".join(by) if by else "1"
    keys = f"{', '.join(by)}, " if by else ""
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""{prefix}hist AS (SELECT {keys}{score} AS threshold, SUM(label) AS pos, SUM(1 - label) AS neg FROM {source} GROUP BY {keys}{score}),
      {prefix}curve AS (SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER a AS n_pos, SUM(neg) OVER a AS n_neg,
          CAST(SUM(pos) OVER w AS DOUBLE) / (SUM(pos) OVER w + SUM(neg) OVER w) AS precision, CAST(SUM(pos) OVER w AS DOUBLE) / SUM(pos) OVER a AS recall
        FROM {prefix}hist WINDOW w AS ({part} ORDER BY threshold DESC), a AS ({part})),
      {prefix}rank AS (SELECT {keys}MAX(n_pos) AS n_pos, MAX(n_neg) AS n_neg, SUM(CAST(pos AS DOUBLE) * (n_neg - fp + neg * 0.5)) / MAX(CAST(n_pos AS DOUBLE) * n_neg) AS roc_auc,
          SUM(pos * precision) / MAX(n_pos) AS pr_auc FROM {prefix}curve GROUP BY {b if by else 'ALL'}),
      {prefix}hit AS (SELECT {keys}MAX(threshold) AS threshold, MAX_BY(tp, threshold) AS tp, MAX_BY(fp, threshold) AS fp, MAX(n_pos) AS n_pos, MAX(n_neg) AS n_neg
          FROM {prefix}curve WHERE recall >= 0.8 GROUP BY {b if by else 'ALL'})"""


CURVE = f"{SCORED}, {curve_sql('scored')}"


def _curve(t, by=("segment",), score="score"):
    return m.threshold_curve(t.derive("scored"), "label", score, by)


@query(
    "e1_threshold_curve",
    CURVE + " SELECT segment, ROUND(threshold, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall FROM curve",
)
def _(t):
    return rounded(_curve(t).select("segment", "threshold", "tp", "fp", "precision", "recall"))


@query("e2_roc_auc", CURVE + " SELECT segment, ROUND(roc_auc, 6) AS roc_auc FROM rank")
def _(t):
    return rounded(m.ranking_metrics(_curve(t), ["segment"]).select("segment", "roc_auc"))


@query("e3_average_precision", CURVE + " SELECT segment, ROUND(pr_auc, 6) AS pr_auc FROM rank")
def _(t):
    return rounded(m.ranking_metrics(_curve(t), ["segment"]).select("segment", "pr_auc"))


@query(
    "e4_threshold_at_recall",
    CURVE + " SELECT segment, ROUND(threshold, 6) AS threshold, ROUND(CAST(tp AS DOUBLE) / n_pos, 6) AS recall, ROUND(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision FROM hit",
)
def _(t):
    return rounded(m.threshold_at_recall(_curve(t), 0.8, ["segment"]))


@query(
    "e5_best_f1",
    CURVE
    + """, f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM curve)
         SELECT segment, ROUND(threshold, 6) AS threshold, ROUND(f1, 6) AS f1, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall
         FROM f QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY f1 DESC, threshold) = 1""",
)
def _(t):
    return rounded(m.best_f1(_curve(t), ["segment"]))


@query(
    "e6_confusion",
    SCORED
    + """ SELECT segment, COUNT(*) FILTER (score < 0.4 AND label = 0) AS tn, COUNT(*) FILTER (score >= 0.4 AND label = 0) AS fp,
                 COUNT(*) FILTER (score < 0.4 AND label = 1) AS fn, COUNT(*) FILTER (score >= 0.4 AND label = 1) AS tp FROM scored GROUP BY 1""",
)
def _(t):
    return m.confusion(t.derive("scored"), 0.4, by=["segment"])


NAN_SCORED = """WITH scored AS (SELECT l_linestatus AS segment, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
   CASE WHEN l_partkey % 9 <> 0 THEN CAST((l_partkey * 7 + l_linenumber * 13 + CASE WHEN l_returnflag = 'R' THEN 150 ELSE 0 END) % 997 AS DOUBLE) / 997 END AS score FROM lineitem), known AS (SELECT * FROM scored WHERE score IS NOT NULL)"""


@query(
    "e1b_unknown_scores",
    f"""{NAN_SCORED}, {curve_sql("known")}, c AS (SELECT segment, COUNT(*) FILTER (score < 0.4 AND label = 0) AS tn, COUNT(*) FILTER (score >= 0.4 AND label = 0) AS fp, COUNT(*) FILTER (score < 0.4 AND label = 1) AS fn,
          COUNT(*) FILTER (score >= 0.4 AND label = 1) AS tp, AVG((score - label) * (score - label)) AS brier, AVG(score) AS mean_score FROM known GROUP BY 1)
        SELECT segment, c.tn, c.fp, c.fn, c.tp, ROUND(roc_auc, 6) AS roc_auc, ROUND(brier, 6) AS brier, ROUND(mean_score, 6) AS mean_score, ROUND(brier, 6) AS brier_alone FROM rank JOIN c USING (segment)""",
)
def _(t):
    # a ninth of the scores is NaN or infinite: no metric may count them
    odd = F.when(F.col("l_partkey") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    returned = F.col("l_returnflag") == "R"
    value = ((F.col("l_partkey") * 7 + F.col("l_linenumber") * 13 + F.when(returned, 150).otherwise(0)) % 997).cast("double") / 997
    score = F.when(F.col("l_partkey") % 9 == 0, odd).otherwise(value)
    rows = t.lineitem.select(F.col("l_linestatus").alias("segment"), F.when(returned, 1).otherwise(0).alias("label"), score.alias("score"))
    metrics = m.metric_set(rows, ["roc_auc", "brier", "mean_score"], by=["segment"]).drop("threshold_at_target")
    alone = m.brier(rows, by=["segment"]).withColumnRenamed("brier", "brier_alone")
    return rounded(m.confusion(rows, 0.4, by=["segment"]).join(metrics, "segment").join(alone, "segment"))


RATES = """ROUND((tp + tn) / (tn + fp + fn + tp), 6) AS accuracy, ROUND(tp / (tp + fp), 6) AS precision, ROUND(tp / (tp + fn), 6) AS recall, ROUND(tn / (tn + fp), 6) AS specificity,
   ROUND(COALESCE(tn / NULLIF(tn + fn, 0), 0), 6) AS negative_precision, ROUND((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
   ROUND(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1, ROUND((tp + fn) / (tn + fp + fn + tp), 6) AS actual_rate, ROUND((tp + fp) / (tn + fp + fn + tp), 6) AS predicted_rate"""


def full_sql(by: tuple[str, ...]) -> str:
    keys = ", ".join(by)
    on = f"USING ({keys})" if by else "ON true"
    return f"""full_eval AS (SELECT {keys + ', ' if by else ''}rank.n_pos, rank.n_neg, roc_auc, pr_auc, threshold, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp,
        CAST(rank.n_pos - tp AS DOUBLE) AS fn, CAST(rank.n_neg - fp AS DOUBLE) AS tn FROM rank JOIN hit {on})"""


EVAL_COLS = """CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc, ROUND(threshold, 6) AS threshold,
   CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn"""


@query("e7_full_evaluation", f"{CURVE}, {full_sql(('segment',))} SELECT segment, {EVAL_COLS}, {RATES} FROM full_eval")
def _(t):
    return rounded(m.evaluate(_curve(t), 0.8, ["segment"]))


@query("e7b_full_evaluation_overall", f"{SCORED}, {curve_sql('scored', ())}, {full_sql(())} SELECT {EVAL_COLS}, {RATES} FROM full_eval")
def _(t):
    return rounded(m.evaluate(_curve(t, ())))


@query(
    "e8_class_report",
    SCORED
    + """, c AS (SELECT segment, CAST(COUNT(*) FILTER (score < 0.4 AND label = 0) AS DOUBLE) AS tn, CAST(COUNT(*) FILTER (score >= 0.4 AND label = 0) AS DOUBLE) AS fp,
                 CAST(COUNT(*) FILTER (score < 0.4 AND label = 1) AS DOUBLE) AS fn, CAST(COUNT(*) FILTER (score >= 0.4 AND label = 1) AS DOUBLE) AS tp FROM scored GROUP BY 1),
           r AS (SELECT segment, '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, tn + fp AS s FROM c UNION ALL SELECT segment, '1', tp / (tp + fp), tp / (tp + fn), tp + fn FROM c),
           f AS (SELECT *, 2 * p * r / (p + r) AS f FROM r)
         SELECT segment, class, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM f
         UNION ALL SELECT segment, 'macro avg', ROUND(AVG(p), 6), ROUND(AVG(r), 6), ROUND(AVG(f), 6), CAST(SUM(s) AS BIGINT) FROM f GROUP BY 1
         UNION ALL SELECT segment, 'weighted avg', ROUND(SUM(p * s) / SUM(s), 6), ROUND(SUM(r * s) / SUM(s), 6), ROUND(SUM(f * s) / SUM(s), 6), CAST(SUM(s) AS BIGINT) FROM f GROUP BY 1""",
)
def _(t):
    return rounded(m.class_report(m.confusion(t.derive("scored"), 0.4, by=["segment"]), ["segment"]))


@query("e9_brier", SCORED + " SELECT segment, ROUND(AVG((score - label) * (score - label)), 6) AS brier FROM scored GROUP BY 1")
def _(t):
    return rounded(m.brier(t.derive("scored"), by=["segment"]))


@query(
    "e10_metric_set",
    f"""{CURVE}, b AS (SELECT segment, AVG((score - label) * (score - label)) AS brier, AVG(score) AS mean_score FROM scored GROUP BY 1)
        SELECT segment, ROUND(pr_auc, 6) AS pr_auc, ROUND(CAST(tp AS DOUBLE) / hit.n_pos, 6) AS recall_at_target, ROUND(threshold, 6) AS threshold_at_target,
               ROUND(brier, 6) AS brier, ROUND(mean_score, 6) AS mean_score FROM rank JOIN hit USING (segment) JOIN b USING (segment)""",
)
def _(t):
    return rounded(m.metric_set(t.derive("scored"), ["pr_auc", "recall_at_target", "brier", "mean_score"], by=["segment"]))


@query(
    "e11_overfit_gap",
    f"""{SCORED}, c AS (SELECT quantile_cont(CAST(epoch_us(shipped) AS DOUBLE), 0.8) AS q FROM scored),
        s AS (SELECT scored.*, CASE WHEN CAST(epoch_us(shipped) AS DOUBLE) < q THEN 'train' ELSE 'valid' END AS split FROM scored, c), {curve_sql('s', ('segment', 'split'))}
        SELECT segment, ROUND(MAX(roc_auc) FILTER (split = 'train'), 6) AS train, ROUND(MAX(roc_auc) FILTER (split = 'valid'), 6) AS valid,
               ROUND(MAX(roc_auc) FILTER (split = 'train') - MAX(roc_auc) FILTER (split = 'valid'), 6) AS gap,
               MAX(roc_auc) FILTER (split = 'train') - MAX(roc_auc) FILTER (split = 'valid') > 0.05 AS overfit FROM rank GROUP BY 1""",
)
def _(t):
    df = time_split(t.derive("scored"), "shipped")
    by = ["segment", "split"]
    return rounded(m.overfit_gap(m.ranking_metrics(m.threshold_curve(df, by=by), by), "roc_auc", by=["segment"]))


def _both_models(t):
    df = t.derive("scored")
    a = df.select("segment", "quarter", "run", "fold", "label", "score", F.lit("model_a").alias("model"))
    return a.unionByName(df.select("segment", "quarter", "run", "fold", "label", F.col("score_b").alias("score"), F.lit("model_b").alias("model")))


@query(
    "e12_compare_models",
    f"""{SCORED}, u AS (SELECT segment, label, score, 'model_a' AS model FROM scored UNION ALL SELECT segment, label, score_b, 'model_b' FROM scored), {curve_sql('u', ('segment', 'model'))}
        SELECT segment, model, ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc, ROW_NUMBER() OVER (PARTITION BY segment ORDER BY roc_auc DESC, model) = 1 AS winner FROM rank""",
)
def _(t):
    by = ["segment", "model"]
    table = m.ranking_metrics(m.threshold_curve(_both_models(t), by=by), by)
    return rounded(m.compare_models(table, by=["segment"]).select("segment", "model", "roc_auc", "pr_auc", "winner"))


@query(
    "e13_cohort_metrics",
    f"""{SCORED}, u AS (SELECT 'segment' AS cohort, segment AS value, label, score FROM scored UNION ALL SELECT 'quarter', CAST(quarter AS VARCHAR), label, score FROM scored),
        {curve_sql('u', ('cohort', 'value'))}, {full_sql(('cohort', 'value'))} SELECT cohort, value, {EVAL_COLS}, {RATES} FROM full_eval""",
)
def _(t):
    return rounded(m.cohort_metrics(t.derive("scored"), {"segment": "segment", "quarter": "quarter"}))


@query(
    "e13b_labelled_documents",
    f"""WITH u AS (SELECT lang, quality AS label, CAST(n_chars % 101 AS DOUBLE) / 101 AS score FROM documents JOIN labels USING (doc_id)), {curve_sql('u', ('lang',))}
        SELECT lang, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc FROM rank""",
)
def _(t):
    pred = t.documents.select("doc_id", "lang", ((F.col("n_chars") % 101).cast("double") / 101).alias("score"))
    rows = with_truth(pred, t.labels.select("doc_id", F.col("quality").alias("label")), "doc_id")
    return rounded(m.ranking_metrics(m.threshold_curve(rows, by=["lang"]), ["lang"]))


FOLDS = f"""{SCORED}, {curve_sql('scored', ('run', 'fold'))},
   folds AS (SELECT run, fold, roc_auc, pr_auc, CAST(tp AS DOUBLE) / hit.n_pos AS recall_at_target, CAST(tp AS DOUBLE) / (tp + fp) AS precision_at_target FROM rank JOIN hit USING (run, fold)),
   gated AS (SELECT run, AVG(recall_at_target) AS mean_recall, STDDEV_SAMP(recall_at_target) AS std_recall, MIN(recall_at_target) AS min_recall, AVG(pr_auc) AS mean_pr, AVG(roc_auc) AS mean_roc, COUNT(*) AS n_folds FROM folds GROUP BY 1),
   decided AS (SELECT *, mean_recall >= 0.8 AS g1, std_recall <= 0.002 AS g2, min_recall >= 0.75 AS g3, mean_pr >= 0.4 AS g4 FROM gated)"""
LIMITS = g.GateLimits(target_recall=0.8, stability_std_max=0.002, min_fold_recall=0.75, min_pr_auc=0.4)


def _folds(t):
    by = ["run", "fold"]
    return m.evaluate(_curve(t, by), 0.8, by).withColumnsRenamed({"recall": "recall_at_target", "precision": "precision_at_target"})


@query(
    "e14_quality_gates",
    FOLDS
    + """ SELECT run, ROUND(mean_recall, 6) AS mean_recall_at_target, ROUND(std_recall, 6) AS std_recall_at_target, ROUND(min_recall, 6) AS min_fold_recall, ROUND(mean_pr, 6) AS mean_pr_auc,
                 ROUND(mean_roc, 6) AS mean_roc_auc, n_folds, g1 AS gate_mean_recall, g2 AS gate_stability, g3 AS gate_min_fold, g4 AS gate_min_pr_auc, g1 AND g2 AND g3 AND g4 AS quality_gates_pass FROM decided""",
)
def _(t):
    return rounded(g.quality_gates(_folds(t), LIMITS))


PROMOTE = """, champ AS (SELECT o_custkey % 20 AS run, 0.79 + CAST(MAX(o_orderkey) % 30 AS DOUBLE) / 1000 AS v FROM orders WHERE o_custkey % 20 < 15 GROUP BY 1)"""


def _champions(t):
    value = F.lit(0.79).cast("double") + (F.max("o_orderkey") % 30).cast("double") / 1000
    return t.orders.where("o_custkey % 20 < 15").groupBy((F.col("o_custkey") % 20).alias("run")).agg(value.alias("champion_value"))


@query(
    "e15_promotion",
    FOLDS
    + PROMOTE
    + """ SELECT run, ROUND(v, 6) AS champion_value, CASE WHEN NOT (g1 AND g2 AND g3 AND g4) THEN false WHEN v IS NULL THEN true ELSE mean_recall >= v + 0.001 END AS promote,
                 CASE WHEN NOT (g1 AND g2 AND g3 AND g4) THEN 'Failed quality gates' WHEN v IS NULL THEN 'Passed gates; no champion metric available'
                      ELSE printf('candidate %.4f vs champion %.4f (margin %.4f)', mean_recall, v, CAST(0.001 AS DOUBLE)) END AS reason FROM decided LEFT JOIN champ USING (run)""",
)
def _(t):
    out = g.promotion(g.quality_gates(_folds(t), LIMITS), _champions(t), "run", margin=0.001)
    return rounded(out.select("run", "champion_value", "promote", "reason"))


def _registry(t):
    df = t.derive("registry")
    drop_null = lambda mp: F.map_filter(mp, lambda k, v: v.isNotNull())
    return df.select(
        "arn", "group", "status", "created",
        drop_null(F.create_map(F.lit("candidate_run_id"), "run_id", F.lit("is_champion"), "champion")).alias("tags"),
        drop_null(F.create_map(F.lit("mean_recall_at_target"), "metric", F.lit("owner"), "owner", F.lit("is_champion"), F.lit("unknown"))).alias("meta"),
    )


@query(
    "e16_latest_approved",
    ctes("registry")
    + """ SELECT "group", arn, created, 'mean_recall_at_target' AS metric_key, TRY_CAST(metric AS DOUBLE) AS champion_value FROM registry WHERE status = 'Approved'
          QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY created DESC, arn) = 1""",
)
def _(t):
    return g.latest_approved(_registry(t), "mean_recall_at_target")


CHAMPION = ctes("registry") + """, r AS (SELECT *, CASE WHEN run_id = 'run-9' THEN 2 WHEN lower(champion) = 'true' THEN 1 ELSE 0 END AS rk FROM registry WHERE status = 'Approved'),
    best AS (SELECT * FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY "group" ORDER BY rk DESC, created DESC, arn) = 1)"""


@query("e17_resolve_champion", CHAMPION + """ SELECT "group", arn, created, CASE rk WHEN 2 THEN 'run_id' WHEN 1 THEN 'champion_tag' ELSE 'latest' END AS via FROM best""")
def _(t):
    return g.resolve_champion(_registry(t), "run-9").select("group", "arn", "created", "via")


@query(
    "e18_lineage",
    CHAMPION + """ SELECT arn, run_id AS candidate_run_id, COALESCE(champion, 'unknown') AS is_champion, owner, CAST(2 + CAST(run_id IS NOT NULL AS INTEGER) AS INTEGER) AS n_keys FROM best""",
)
def _(t):
    keys = ["candidate_run_id", "is_champion", "owner", "not_recorded"]
    out = g.lineage(g.resolve_champion(_registry(t), "run-9"), keys)
    of = lambda k: F.try_element_at("lineage", F.lit(k)).alias(k)
    return out.select("arn", of("candidate_run_id"), of("is_champion"), of("owner"), F.size("lineage").alias("n_keys"))


def _weight_sql(bits: str) -> str:
    return " + ".join(f"CAST({bits} >= {step} AS INTEGER)" for step in g.POISSON_STEPS)


@query(
    "e19b_bootstrap_interval",
    f"""{SCORED}, drawn AS (SELECT l_linestatus AS segment, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CAST((l_partkey * 7 + l_linenumber * 13 + CASE WHEN l_returnflag = 'R' THEN 150 ELSE 0 END) % 997 AS DOUBLE) / 997 AS score, replicate,
          CAST('0x' || substr(md5('42|' || replicate || '|' || l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) AS u FROM lineitem, (SELECT unnest(range(1, 13)) AS replicate)),
        w AS (SELECT segment, replicate, score, y, {_weight_sql("u")} AS n FROM drawn),
        hist AS (SELECT segment, replicate, score, SUM(n * y) AS pos, SUM(n * (1 - y)) AS neg FROM w WHERE n > 0 GROUP BY ALL),
        run AS (SELECT *, SUM(neg) OVER (PARTITION BY segment, replicate ORDER BY score) AS upto, SUM(pos) OVER (PARTITION BY segment, replicate) AS np, SUM(neg) OVER (PARTITION BY segment, replicate) AS nn FROM hist),
        auc AS (SELECT segment, replicate, SUM(CAST(pos AS DOUBLE) * (upto - neg + neg * 0.5)) / MAX(CAST(np AS DOUBLE) * nn) AS auc FROM run GROUP BY ALL)
        SELECT segment, ROUND(AVG(auc), 6) AS mean, ROUND(STDDEV_SAMP(auc), 6) AS std, ROUND(quantile_cont(auc, 0.025), 6) AS low, ROUND(quantile_cont(auc, 0.975), 6) AS high, COUNT(*) AS n FROM auc GROUP BY 1""",
)
def _(t):
    keyed = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_linestatus AS segment", "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label",
                                  "CAST((l_partkey * 7 + l_linenumber * 13 + CASE WHEN l_returnflag = 'R' THEN 150 ELSE 0 END) % 997 AS DOUBLE) / 997 AS score")
    drawn = g.bootstrap(keyed, ["l_orderkey", "l_linenumber"], 12, by=["segment"])
    return rounded(g.metric_interval(drawn, "roc_auc", ["segment"]))


@query(
    "e19_stability",
    FOLDS
    + """ SELECT run, ROUND(mean_roc, 6) AS mean, ROUND(s, 6) AS std, k, ROUND(mean_roc - 1.96 * s / SQRT(k), 6) AS low, ROUND(mean_roc + 1.96 * s / SQRT(k), 6) AS high,
                 CASE WHEN s <= 0.03 THEN 'stable' ELSE 'unstable' END AS stability FROM (SELECT run, AVG(roc_auc) AS mean_roc, STDDEV_SAMP(roc_auc) AS s, COUNT(roc_auc) AS k FROM folds GROUP BY 1)""",
)
def _(t):
    return rounded(g.stability(_folds(t), "roc_auc"))


@query(
    "xu1_user_metric",
    SCORED + " SELECT segment, ROUND(AVG(ABS(score - label)), 6) AS mean_abs_error FROM scored GROUP BY 1",
)
def _(t):
    m.register_metric("mean_abs_error", lambda y, s: F.avg(F.abs(s - y)))
    return rounded(m.metric_set(t.derive("scored"), ["mean_abs_error"], by=["segment"]).drop("threshold_at_target"))


@query(
    "xu3_user_gate",
    FOLDS + PROMOTE + """ SELECT run, mean_roc >= 0.57 AS gate_roc, CASE WHEN NOT (g1 AND g3 AND mean_roc >= 0.57) THEN 'Failed quality gates' WHEN run % 2 = 1 THEN 'Failed extra promotion rules'
         WHEN v IS NULL THEN 'Passed gates; no champion metric available' ELSE 'compared' END AS outcome FROM decided LEFT JOIN champ USING (run)""",
)
def _(t):
    loose = g.GateLimits(stability_std_max=1.0)
    gated = g.quality_gates(_folds(t), loose, extra={"gate_roc": F.col("mean_roc_auc") >= 0.57})
    out = g.promotion(gated, _champions(t), "run", extra_ok=F.col("run") % 2 == 0)
    outcome = F.when(F.col("reason").startswith("candidate"), F.lit("compared")).otherwise(F.col("reason"))
    return out.select("run", "gate_roc", outcome.alias("outcome"))
