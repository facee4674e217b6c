"""Subscriber churn: feature mart and scored predictions."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.aggregates import split_stratified
from lakeops.operators.forest import fit_forest, metrics_of, score_bands
from lakeops.session import stored

NUMERIC = ["age", "tenure_months", "monthly_charge", "support_tickets_90d", "avg_data_gb", "avg_voice_minutes",
           "avg_sms_count"]
CATEGORICAL = ["plan", "contract_type", "autopay_enabled"]


def churn_features(customers: DataFrame, usage: DataFrame, key: str = "customer_id") -> DataFrame:
    """Subscribers with the mean of every usage measure; subscribers without usage stay, with null means."""
    means = usage.groupBy(key).agg(*[F.avg(m).alias(f"avg_{m}") for m in usage.columns if m != key])
    return customers.join(means, key, "left")


def prepared(features: DataFrame) -> DataFrame:
    """Features in the form the forest takes: no nulls in the numbers, categories as text, label 0/1."""
    return features.fillna(0, subset=NUMERIC).withColumns({
        **{c: F.col(c).cast("string") for c in CATEGORICAL},
        **{c: F.col(c).cast("double") for c in NUMERIC},
        "label": F.col("churned").cast("int"),
    })


def train_churn(
    features: DataFrame, trees: int = 200, depth: int = 8, seed: int = 42
) -> tuple[PipelineModel, DataFrame, tuple[float, float]]:
    """Class-balanced forest on a stratified 80 % split; model, held-out rows, (AUC, accuracy) on them."""
    train, test = split_stratified(prepared(features), "label", "customer_id", 0.8, seed)
    model = fit_forest(train, "label", NUMERIC, CATEGORICAL, trees, depth, balanced=True, one_hot=True, seed=seed)
    return model, test, metrics_of(model, test, "label")


def churn_predictions(features: DataFrame, folds: int = 5, trees: int = 200, depth: int = 8, seed: int = 42, at_once: int = 3) -> DataFrame:
    """Every subscriber's churn probability and band, by a forest fitted on the other folds. ``at_once`` fits share the cluster."""
    rows = stored(prepared(features).withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), "customer_id"), F.lit(folds))), "prepared")

    def fit(fold: int) -> PipelineModel:
        return fit_forest(rows.where(F.col("fold") != fold), "label", NUMERIC, CATEGORICAL, trees, depth, balanced=True, one_hot=True, seed=seed)

    # Threads hand the session's settings on to the jobs they start.
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, folds))) as pool:
        models = list(pool.map(inheritable_thread_target(rows.sparkSession)(fit), range(folds)))
    scored = reduce(DataFrame.unionByName, [score_bands(model, rows.where(F.col("fold") == fold)) for fold, model in enumerate(models)])
    return scored.select("customer_id", "plan", "contract_type", "tenure_months", "churn_probability", "risk_band", "fold")
