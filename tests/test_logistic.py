"""Newton fit against a plain one, the versioned store, the table function and the threshold variable."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracles
from ledgerlake.plans import logistic, ml
from ledgerlake.plans.logistic import LogisticModel
from ledgerlake.plans.models import Models

NAMES = ["a", "b", "c", "never"]


def some_rows(n=900):
    rng, rows = random.Random(6), []
    for i in range(n):
        a, b, c = rng.gauss(5, 2), rng.gauss(-1000, 400), rng.random() * 1e6
        y = rng.random() < 1 / (1 + math.exp(-(0.8 * (a - 5) - 0.004 * (b + 1000) + 1e-6 * c - 0.7)))
        gone = rng.random()
        rows.append((f"t{i}", a if gone > 0.1 else None, b if gone < 0.9 else float("nan"), c, 3.0, None if i % 50 == 0 else y))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(some_rows(), "transaction_id string, a double, b double, c double, never double, is_fraud boolean")


def plain_fit(data, ridge=1e-6):
    """Newton on one matrix, to the end."""
    data = [r for r in data if r[-1] is not None]
    x = np.array([[np.nan if v is None else v for v in r[1:-1]] for r in data], float)
    y = np.array([float(r[-1]) for r in data])
    fill = np.nanmean(x, axis=0)
    x = np.where(np.isnan(x), fill, x)
    std = x.std(axis=0, ddof=1)
    z = np.column_stack([np.divide(x - fill, std, out=np.zeros_like(x), where=std > 0), np.ones(len(x))])
    beta, penalty = np.zeros(z.shape[1]), np.append(np.full(z.shape[1] - 1, ridge), 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(z @ beta)))
        gram = z.T @ (z * (p * (1 - p))[:, None]) / len(y) + np.diag(np.where(penalty > 0, penalty, 0)) + 1e-300
        beta = beta - np.linalg.solve(gram, z.T @ (p - y) / len(y) + penalty * beta)
    return beta, fill, std


def test_fit_equals_plain_newton(rows):
    model = logistic.fit(rows, NAMES, "is_fraud")
    beta, fill, std = plain_fit(some_rows())
    assert np.allclose([*model.coefficients, model.intercept], beta, atol=1e-9) and model.rounds < 15
    assert np.allclose(model.fill, fill) and np.allclose(model.std, std) and model.coefficients[3] == 0.0


def test_fit_does_not_depend_on_the_layout(rows):
    one, many = (logistic.fit(rows.repartition(n), NAMES, "is_fraud") for n in (1, 23))
    assert np.allclose(one.coefficients, many.coefficients, atol=1e-12)


def test_separable_classes_end(spark):
    rows = spark.createDataFrame([(str(i), float(i), i >= 10) for i in range(20)], "transaction_id string, a double, is_fraud boolean")
    model = logistic.fit(rows, ["a"], "is_fraud", ridge=1e-3)
    w, c = model.weights()
    assert all(((w[0] * i + c) > 0) == (i >= 10) for i in range(20))


def test_fit_needs_both_classes(spark, rows):
    with pytest.raises(ValueError, match="both classes"):
        logistic.fit(rows.where("is_fraud"), NAMES, "is_fraud")
    with pytest.raises(ValueError, match="both classes"):
        logistic.fit(rows.where("false"), NAMES, "is_fraud")


def test_store_replaces_by_one_rename(spark, rows, tmp_path, monkeypatch):
    path = f"{tmp_path}/fraud_lr_v1"
    assert logistic.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        logistic.load(spark, path)
    old = logistic.fit(rows, NAMES, "is_fraud")
    first = logistic.save(spark, old, path)
    got = logistic.load(spark, path)
    assert got.features == old.features and got.coefficients == old.coefficients and got.intercept == old.intercept
    # a fit that fails half-way
    real, calls = logistic._sums, []

    def failing(*a):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("executor lost")
        return real(*a)
    monkeypatch.setattr(logistic, "_sums", failing)
    with pytest.raises(RuntimeError):
        ml.logistic.save(spark, logistic.fit(rows, NAMES, "is_fraud"), path)
    assert logistic.current_version(spark, path) == first and logistic.load(spark, path).coefficients == old.coefficients
    # a writer that is lost between the version and the pointer
    monkeypatch.setattr(logistic, "_sums", real)
    monkeypatch.setattr(logistic, "_files", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        logistic.save(spark, old, path)
    monkeypatch.undo()
    assert logistic.current_version(spark, path) == first and len(logistic.versions(spark, path)) == 2
    second = logistic.save(spark, LogisticModel(("a",), (0.0,), (0.0,), (1.0,), (2.0,), 1.0), path)
    assert logistic.current_version(spark, path) == second and logistic.load(spark, path).intercept == 1.0
    assert logistic.load(spark, path, first).coefficients == old.coefficients


def test_table_function(spark, rows):
    model = logistic.fit(rows, NAMES, "is_fraud")
    logistic.register_predict(spark, model, "score_rows", "transaction_id", "is_fraud")
    rows.createOrReplaceTempView("to_score")
    out = spark.sql("SELECT * FROM score_rows(TABLE(SELECT *, 1 AS other FROM to_score)) WHERE transaction_id <> 't0'").collect()
    beta, fill, std = plain_fit(some_rows())
    want = {}
    for t, *x, _ in some_rows():
        z = sum(b * ((f if v is None or math.isnan(v) else v) - f) / s for b, v, f, s in zip(beta, x, fill, std) if s > 0) + beta[-1]
        want[t] = 1 / (1 + math.exp(-z))
    assert len(out) == 899
    for r in out:
        probs = {p["label"]: p["prob"] for p in r["predicted_is_fraud_probs"]}
        assert abs(probs[True] - want[r["transaction_id"]]) < 1e-9 and abs(sum(probs.values()) - 1) < 1e-12
        assert r["predicted_is_fraud"] == (probs[True] >= 0.5) == r["predicted_is_fraud_probs"][0]["label"]
    assert spark.sql("SELECT * FROM score_rows(TABLE(SELECT * FROM to_score WHERE false))").count() == 0


def test_view_follows_the_threshold(spark, rows):
    scores = spark.createDataFrame([(f"t{i}", i >= 5, [(True, i / 10), (False, 1 - i / 10)]) for i in range(10)],
                                   "transaction_id string, predicted_is_fraud boolean, "
                                   "predicted_is_fraud_probs array<struct<label: boolean, prob: double>>")
    view = ml.decision_view(scores, ml.JobVars(""), "test_decisions")
    positive = lambda: spark.table(view).where("predicted_fraud").count()
    assert positive() == 9
    ml.JobVars("", 0.75).declare(spark)
    assert positive() == 2
    spark.sql("SET VARIABLE fraud_probability_threshold = 0.5")
    assert positive() == 5


def test_written_coefficients(spark):
    """The coefficients in the SQL of md22 are those of a plain fit over all rows."""
    m = Models(spark, "/root/testdata/sf0.01").build((*Models.SHARED, "fraud_features"))
    data = ml.training_rows(m.fraud_features).select("transaction_id", *ml.FEATURES, F.col("is_fraud")).collect()
    beta, _, _ = plain_fit([tuple(r) for r in data])
    assert np.allclose(beta, oracles.MD22_COEFFICIENTS, atol=1e-9)
