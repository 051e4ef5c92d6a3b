"""Fraud model: training (ML1, ML5, ML7) and batch scoring (ML2-ML4, MD22), job variables in SQL (MC1).

The warehouse trains a logistic regression with vendor defaults (mean
imputation, standardisation); ``plans/logistic.py`` fits, stores and applies
it.  Train and serve share one feature list and the same boolean-to-integer
casts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans import logistic
from ledgerlake.plans.logistic import LogisticModel
from ledgerlake.plans.models import written

# The model's feature list, in the training query's order.
FEATURES = [
    "original_amount", "amount_log1p_original", "year_number", "quarter_number", "month_number",
    "iso_week_number", "day_of_week", "hour_24", "is_business_hours", "is_weekend", "has_merchant_geo",
    "user_recency_seconds", "merchant_recency_seconds", "user_merchant_recency_seconds",
    "user_txn_count_24h", "user_txn_count_30d", "user_original_amount_sum_24h", "user_original_amount_avg_24h",
    "user_original_amount_max_24h", "user_original_amount_sum_30d", "user_original_amount_avg_30d",
    "user_original_amount_max_30d", "merchant_txn_count_30d", "merchant_original_amount_avg_30d",
    "user_merchant_txn_count_30d", "user_merchant_original_amount_avg_30d",
]
BOOL_FEATURES = ["is_business_hours", "is_weekend", "has_merchant_geo"]
LABEL = "is_fraud"


THRESHOLD_VARIABLE = "fraud_probability_threshold"


@dataclass(frozen=True)
class JobVars:
    """MC1: job variables (model location, decision threshold)."""
    model_path: str
    fraud_probability_threshold: float = 0.1

    def declare(self, spark: SparkSession) -> None:
        """Make the threshold a session variable, which SQL and views over it read when they run."""
        spark.sql(f"DECLARE OR REPLACE VARIABLE {THRESHOLD_VARIABLE} DOUBLE DEFAULT 0.1")
        spark.sql(f"SET VARIABLE {THRESHOLD_VARIABLE} = :value", args={"value": self.fraud_probability_threshold})


def feature_frame(df: DataFrame) -> DataFrame:
    """ML5: booleans to integers, every feature as double (the model
    needs numbers; NULLs are filled by the model)."""
    cols = []
    for c in FEATURES:
        x = F.col(c).cast("int") if c in BOOL_FEATURES else F.col(c)
        cols.append(x.cast("double").alias(c))
    keep = [c for c in df.columns if c not in FEATURES]
    return df.select(*keep, *cols)


def training_rows(features: DataFrame) -> DataFrame:
    return feature_frame(features).where(F.col(LABEL).isNotNull())


def scaling_stats(features: DataFrame) -> DataFrame:
    """ML1's preparation, one row per feature: the value that replaces NULLs, and
    the mean and sample standard deviation after imputation."""
    return features.sparkSession.createDataFrame(
        logistic.scaling(training_rows(features), FEATURES),
        "feature string, fill_value double, mean_value double, std_value double")


def train(features: DataFrame, model_path: str | None = None) -> LogisticModel:
    """ML1 (+ ML7 when ``model_path`` is given: create or replace the model)."""
    model = logistic.fit(training_rows(features), FEATURES, LABEL)
    if model_path:
        logistic.save(features.sparkSession, model, model_path)
    return model


def positive_probability(probs: F.Column) -> F.Column:
    """ML3 / FLT4 / JN8 / SL3: ``(select prob from unnest(probs) where label
    is true limit 1)`` as a higher-order filter on the array, no join."""
    return F.element_at(F.filter(probs, lambda x: x["label"]), 1)["prob"]


def decide(scored: DataFrame, probs: F.Column, threshold: float) -> DataFrame:
    """ML3 positive-class probability and ML4 threshold: (transaction_id,
    fraud_probability, predicted_fraud)."""
    return scored.select("transaction_id", positive_probability(probs).alias("fraud_probability")).withColumn(
        "predicted_fraud", F.col("fraud_probability") >= F.lit(threshold))


PREDICT = "predict_fraud_lr_v1"


def scored(serving: DataFrame, model: LogisticModel) -> DataFrame:
    """ML2 in SQL: the model as a table function over the serving query."""
    spark = serving.sparkSession
    logistic.register_predict(spark, model, PREDICT, "transaction_id", LABEL)
    return spark.sql(f"SELECT * FROM {PREDICT}(TABLE(SELECT * FROM {{rows}}))", rows=feature_frame(serving))


def predict(serving: DataFrame, model: LogisticModel, threshold: float = 0.1) -> DataFrame:
    """MD22: ML2 scoring, ML3 / ML4, and the time."""
    s = scored(serving, model)
    return decide(s, F.col(f"predicted_{LABEL}_probs"), threshold).withColumn("predicted_at", F.current_timestamp())


def decision_view(scores: DataFrame, job: JobVars, name: str = "fraud_decisions") -> str:
    """MC1: a view of (transaction_id, fraud_probability, predicted_fraud) over the scorer's output; its threshold is the
    session variable's value whenever it is read."""
    spark = scores.sparkSession
    job.declare(spark)
    scores.createOrReplaceTempView(f"{name}_scores")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {name} AS
        SELECT transaction_id, fraud_probability, fraud_probability >= {THRESHOLD_VARIABLE} AS predicted_fraud
        FROM (SELECT transaction_id, element_at(filter(predicted_{LABEL}_probs, p -> p.label), 1).prob AS fraud_probability
              FROM {name}_scores)""")
    return name


def score_stored(models, job: JobVars) -> DataFrame:
    """MD22 with the model stored at ``job.model_path``."""
    model = logistic.load(models.spark, job.model_path)
    return predict(models.fraud_features_serving, model, job.fraud_probability_threshold)


def fraud_predictions(models, job: JobVars) -> DataFrame:
    """Train on the feature table, store the model and score the serving view with it."""
    train(models.fraud_features, job.model_path)
    return score_stored(models, job)


# --- scoring by fixed coefficients: what the registered queries compare ------------------


def fixed_model() -> LogisticModel:
    """Coefficients by a rule, so that any engine can write them down."""
    n = range(len(FEATURES))
    return LogisticModel(tuple(FEATURES), tuple(i / 2 for i in n), tuple(float(i) for i in n),
                         tuple(1000.0 * (1 + i) for i in n), tuple(((7 * i) % 11 - 5) / 10 for i in n), -0.25)


def predict_function(models) -> DataFrame:
    """ML2 by the table function, with a query as its argument."""
    serving = scored(models.fraud_features_serving, fixed_model())
    both = F.col(f"predicted_{LABEL}_probs")
    return serving.select("transaction_id", F.col(f"predicted_{LABEL}"), positive_probability(both).alias("prob_true"),
                          both[0]["prob"].alias("prob_first"))


def threshold_counts(models) -> DataFrame:
    """MC1: decisions of one view at two thresholds, over scores that are made once and written."""
    scores = written(scored(models.fraud_features_serving, fixed_model()), "fraud_scores")
    view, out = decision_view(scores, JobVars("")), None
    for t in (0.1, 0.45):
        JobVars("", t).declare(models.spark)
        one = models.spark.table(view).groupBy("predicted_fraud").agg(F.count("*").alias("row_count")).withColumn(
            "threshold", F.lit(t))
        out = one if out is None else out.unionByName(one)
    return out
