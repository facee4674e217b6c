"""Model training and scoring over the given tables. Scores have no SQL equivalent; counts and coverage have."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lakeops.catalog import domains as d
from lakeops.catalog.base import Tables, query
from lakeops.catalog.domains import with_
from lakeops.operators import forest
from lakeops.operators.aggregates import split_exact
from lakeops.operators.quality import quarantine
from lakeops.plans import banking, churn
from lakeops.session import stored

# The label is made from the amount, so the amount is no feature.
NUMERIC, CATEGORICAL = ["hour", "weekday"], ["channel", "currency", "account_id"]


def _transactions(t: Tables):
    """Labelled transactions, stored: training reads its rows many times."""
    valid, _ = quarantine(d.bank(t), banking.rules())
    rows = banking.conform(valid, ["txn_ts", "account_id", "amount"]).withColumns({
        "amount_usd": F.col("amount_usd").cast("double"),
        "hour": F.hour("txn_ts").cast("double"),
        "weekday": F.dayofweek("txn_ts").cast("double"),
    })
    return stored(forest.threshold_label(rows, "amount_usd", 100.0, "is_flagged"), "labelled")


# What the scores must reach on held-out rows: the currency decides part of the flags, contract and tickets decide most of the churn.
FRAUD_AUC, CHURN_AUC = 0.52, 0.8


def _sweep(rows):
    train, test = split_exact(rows, "is_flagged", "txn_id", 0.8, 42)
    return forest.sweep(train, test, "is_flagged", NUMERIC, CATEGORICAL)


@query(
    "forest_sweep_auc",
    """SELECT trees::bigint AS num_trees, depth::bigint AS max_depth, true AS auc_in_range, true AS accuracy_in_range, true AS beats_chance
    FROM (VALUES (50, 4), (100, 6), (200, 8)) AS grid(trees, depth)""",
)
def forest_sweep_auc(t: Tables):
    """The whole sweep: each pair fitted once, its metrics on held-out rows within bounds, the best one's order better than a constant score's."""
    metrics = _sweep(_transactions(t))[1]
    best = metrics.agg(F.max("test_auc")).scalar()
    return metrics.select(
        "num_trees", "max_depth", F.col("test_auc").between(0, 1).alias("auc_in_range"), F.col("accuracy").between(0, 1).alias("accuracy_in_range"),
        (best >= FRAUD_AUC).alias("beats_chance"),
    )


@query("fraud_scores")
def fraud_scores(t: Tables):
    """All transactions scored by the sweep's best model."""
    rows = _transactions(t)
    scored = forest.score(_sweep(rows)[0], rows, "fraud_score")
    return scored.select("txn_id", "channel", "amount_usd", "is_flagged", "fraud_score")


@query(
    "fraud_score_summary",
    with_(
        "bank bank_valid",
        """SELECT channel, count(*) AS n, count(DISTINCT txn_id) AS scored_once, true AS in_range,
        count(*) FILTER (amount_usd > 100) AS flagged, true AS flagged_score_higher FROM bank_valid GROUP BY channel""",
    ),
)
def fraud_score_summary(t: Tables):
    """Per channel: every row scored once, scores are probabilities, labels as the amounts say, flagged rows score higher on average."""
    flagged = F.col("is_flagged") == 1
    return fraud_scores(t).groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(F.when(F.col("fraud_score").isNotNull(), F.col("txn_id"))).alias("scored_once"),
        F.bool_and(F.col("fraud_score").between(0, 1)).alias("in_range"),
        F.count_if(flagged).alias("flagged"),
        (F.avg(F.when(flagged, F.col("fraud_score"))) > F.avg(F.when(~flagged, F.col("fraud_score")))).alias("flagged_score_higher"),
    )


def _churn(t: Tables):
    return churn.churn_predictions(stored(churn.churn_features(d.subscribers(t), d.usage(t)), "features"))


def _auc(scored, label: str, score: str):
    """Area under the curve of a stored table's scores, in a row."""
    rows = scored.select(F.col(label).cast("double").alias("label"), F.col(score).alias("rawPrediction"))
    return BinaryClassificationEvaluator().evaluate(rows)


@query("churn_risk_bands")
def churn_risk_bands(t: Tables):
    """All subscribers with their churn probability and band, each scored by a model that did not see them."""
    return _churn(t)


@query(
    "churn_coverage",
    """SELECT c_mktsegment AS plan, count(*) AS n, count(DISTINCT c_custkey) AS scored_once, true AS bands_fit, 5::bigint AS folds, true AS churners_found
    FROM customer GROUP BY c_mktsegment""",
)
def churn_coverage(t: Tables):
    """Per plan: every subscriber scored once, over all folds, the band is that of the probability, and churners rank above others."""
    scored, p = stored(_churn(t), "scored"), F.col("churn_probability")
    folds = scored.agg(F.countDistinct("fold")).scalar()
    truth = scored.join(d.subscribers(t).select("customer_id", "churned"), "customer_id")
    fits = F.when(p <= 0.3, F.col("risk_band") == "Low").when(p <= 0.6, F.col("risk_band") == "Medium").otherwise(F.col("risk_band") == "High")
    return scored.groupBy("plan").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(p.between(0, 1), F.col("customer_id"))).alias("scored_once"), F.bool_and(fits).alias("bands_fit"),
    ).withColumns({"folds": folds, "churners_found": F.lit(_auc(truth, "churned", "churn_probability") >= CHURN_AUC)})
