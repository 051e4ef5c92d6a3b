"""Logistic regression by Newton rounds, stored in versions, applied as a table function (ML1, ML2, ML7).

The fit minimises the mean log loss plus ``ridge`` / 2 times the squared norm of the standardised coefficients (the
intercept is free).  A round is one distributed aggregate: every task sums its rows' gradient, Gram matrix (weighted by
p (1 - p)) and loss, the sums are added up by Spark, and the driver solves one system of features + 1 unknowns.  Its
result does not depend on how rows are spread but for rounding.

Before the first round one aggregate takes each feature's mean and deviation: NULL and NaN are replaced by the mean, and
features are standardised by mean and sample deviation, as the warehouse does by default.  A feature that never changes has
no weight.  Rows without a label take no part; a fit needs both classes.

Scoring is an Arrow table function for SQL, ``SELECT ... FROM name(TABLE(query))``: whole batches are multiplied by the
weights that the function carries, so a task loads the model once and reads no file.

A stored model is a folder of versions and a small file that names the current one.  A version is written whole before the
file is replaced, in one rename; a fit that fails, or a writer that is lost, leaves the model before it in place.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL_SCHEMA = "place int, feature string, fill_value double, mean_value double, std_value double, coefficient double"
POINTER = "CURRENT"


@dataclass(frozen=True)
class LogisticModel:
    """Features with the value that replaces NULL, mean, deviation (0: no weight) and standardised coefficient."""
    features: tuple[str, ...]
    fill: tuple[float, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float
    rounds: int = 0

    def weights(self) -> tuple[np.ndarray, float]:
        """Weights of the features as they are, and the constant."""
        std = np.array(self.std)
        w = np.where(std > 0, np.array(self.coefficients) / np.where(std > 0, std, 1.0), 0.0)
        return w, float(self.intercept - w @ np.array(self.mean))

    def rows(self) -> list[tuple]:
        out = [(i, *r) for i, r in enumerate(zip(self.features, self.fill, self.mean, self.std, self.coefficients))]
        return [*out, (len(out), None, None, None, None, self.intercept)]

    @staticmethod
    def of(rows) -> "LogisticModel":
        rows = sorted(rows, key=lambda r: r["place"])
        cols = list(zip(*[(r["feature"], r["fill_value"], r["mean_value"], r["std_value"], r["coefficient"]) for r in rows[:-1]]))
        return LogisticModel(*cols, intercept=rows[-1]["coefficient"])


# --- fit (ML1) ----------------------------------------------------------------------


def _value(c: str):
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def scaling(rows: DataFrame, features: list[str]) -> list[tuple[str, float, float, float]]:
    """(feature, fill, mean, sample deviation after filling) by one aggregate; the columns' number bounds its size."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(features):
        aggs += [F.count(_value(c)).alias(f"n{i}"), F.avg(_value(c)).alias(f"m{i}"), F.var_pop(_value(c)).alias(f"v{i}")]
    r = rows.agg(*aggs).first()
    out = []
    for i, c in enumerate(features):
        mean, spread = r[f"m{i}"] or 0.0, (r[f"v{i}"] or 0.0) * r[f"n{i}"]
        out.append((c, mean, mean, (spread / (r["n"] - 1)) ** 0.5 if r["n"] > 1 else 0.0))
    return out


def _sums(rows: DataFrame, size: int, fill, mean, scale, beta) -> np.ndarray:
    """Gradient, upper Gram triangle, loss and rows of each class at ``beta``: one aggregate over all rows."""
    upper = np.triu_indices(size)
    names = pa.schema([("place", pa.int32()), ("value", pa.float64())])

    def part(batches):
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(size - 1)])
            x = np.where(np.isnan(x), fill, x)
            x = np.column_stack([(x - mean) * scale, np.ones(len(x))])
            y = b.column(size - 1).to_numpy(zero_copy_only=False)
            z = x @ beta
            p = 0.5 * (1 + np.tanh(0.5 * z))
            gram = (x * (p * (1 - p))[:, None]).T @ x
            loss = np.logaddexp(0.0, z) - y * z
            add = np.concatenate([x.T @ (p - y), gram[upper], [loss.sum(), y.sum(), len(y)]])
            total = add if total is None else total + add
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], schema=names)
    sums = rows.mapInArrow(part, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size + len(upper[0]) + 3)
    for r in sums:
        out[r["place"]] = r["value"]
    return out


def fit(rows: DataFrame, features: list[str], label: str, ridge: float = 1e-6, most_rounds: int = 60,
        tolerance: float = 1e-11) -> LogisticModel:
    """The model of the rows with a label (boolean or 0 / 1)."""
    size = len(features) + 1
    rows = rows.where(F.col(label).isNotNull())
    stats = scaling(rows, features)
    fill, mean, std = (np.array([s[i] for s in stats], float) for i in (1, 2, 3))
    # a deviation that is rounding only is none
    used = std > 1e-12 * np.maximum(np.abs(mean), 1e-300)
    std = np.where(used, std, 0.0)
    scale = np.where(used, 1.0 / np.where(used, std, 1.0), 0.0)
    data = rows.select(*[_value(c).alias(c) for c in features], F.col(label).cast("int").cast("double").alias(label))
    upper, free = np.triu_indices(size), np.append(~used, False)
    beta, before, step, rounds = np.zeros(size), None, np.zeros(size), 0
    while True:
        s = _sums(data, size, fill, mean, scale, beta)
        loss, ones, n = s[-3:]
        if not 0 < ones < n:
            raise ValueError("a fit needs labelled rows of both classes")
        penalty = np.append(np.where(used, ridge, 0.0), 0.0)
        value = loss / n + 0.5 * float(penalty @ (beta * beta))
        rounds += 1
        if before is not None and value > before * (1 + 1e-12) and np.abs(step).max() > tolerance:
            step = step / 2     # too far: half way back
            beta = beta - step
            continue
        before = value
        if rounds >= most_rounds:
            break
        gram = np.zeros((size, size))
        gram[upper] = s[size:-3] / n
        gram = gram + np.triu(gram, 1).T + np.diag(penalty)
        gram[free, :], gram[:, free] = 0.0, 0.0
        gram[free, free] = 1.0
        gradient = np.where(free, 0.0, s[:size] / n + penalty * beta)
        step = -np.linalg.solve(gram, gradient)
        beta = beta + step
        if np.abs(step).max() <= tolerance:
            break
    floats = [tuple(float(v) for v in a) for a in (fill, mean, std, beta[:-1])]
    return LogisticModel(tuple(features), *floats, intercept=float(beta[-1]), rounds=rounds)


# --- store (ML7) --------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    return jvm, jvm.FileContext.getFileContext(jvm.Path(path).toUri(), spark._jsc.hadoopConfiguration())


def save(spark: SparkSession, model: LogisticModel, path: str) -> str:
    """Store ``model`` as a new version under ``path`` and make it the current one; returns the version."""
    version = uuid.uuid4().hex
    root = path.rstrip("/")
    spark.createDataFrame(model.rows(), MODEL_SCHEMA).coalesce(1).write.parquet(f"{root}/versions/{version}")
    jvm, files = _files(spark, root)
    fresh = jvm.Path(f"{root}/.{POINTER}-{version}")
    out = fresh.getFileSystem(spark._jsc.hadoopConfiguration()).create(fresh, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    how = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 1)
    how[0] = getattr(jvm, "Options$Rename").OVERWRITE
    files.rename(fresh, jvm.Path(f"{root}/{POINTER}"), how)
    return version


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that the pointer names, or None where no model is stored."""
    jvm, files = _files(spark, path)
    at = jvm.Path(f"{path.rstrip('/')}/{POINTER}")
    if not files.util().exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def load(spark: SparkSession, path: str, version: str | None = None) -> LogisticModel:
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no model is stored at {path}")
    return LogisticModel.of(spark.read.schema(MODEL_SCHEMA).parquet(f"{path.rstrip('/')}/versions/{version}").collect())


def versions(spark: SparkSession, path: str) -> list[str]:
    """All stored versions, current or not."""
    jvm, files = _files(spark, path)
    at = jvm.Path(f"{path.rstrip('/')}/versions")
    return sorted(s.getPath().getName() for s in files.util().listStatus(at)) if files.util().exists(at) else []


# --- score (ML2) --------------------------------------------------------------------


def register_predict(spark: SparkSession, model: LogisticModel, name: str, id_column: str, label: str) -> str:
    """Register ``name`` as a table function of one table argument: (id, predicted_<label>, predicted_<label>_probs), where
    the probabilities are ``array<struct<label: boolean, prob: double>>``, the predicted class first.  The query's columns are
    found by name; others are ignored, NULL features are replaced, a missing feature is an error."""
    from pyspark.sql.functions import arrow_udtf
    weights, constant = model.weights()
    features, fill = list(model.features), np.array(model.fill)
    out, probs = f"predicted_{label}", f"predicted_{label}_probs"

    @arrow_udtf(returnType=f"{id_column} string, {out} boolean, {probs} array<struct<label: boolean, prob: double>>")
    class Predict:
        def eval(self, table):
            x = np.column_stack([table.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in features]) \
                if table.num_rows else np.zeros((0, len(features)))
            z = np.where(np.isnan(x), fill, x) @ weights + constant
            p = 0.5 * (1 + np.tanh(0.5 * z))
            yes = p >= 0.5
            both = pa.StructArray.from_arrays(
                [pa.array(np.column_stack([yes, ~yes]).ravel()),
                 pa.array(np.column_stack([np.where(yes, p, 1 - p), np.where(yes, 1 - p, p)]).ravel())], names=["label", "prob"])
            ends = pa.array(np.arange(0, 2 * len(p) + 1, 2, dtype=np.int32))
            ids = table.column(id_column).cast(pa.string())
            yield pa.table({id_column: ids, out: pa.array(yes), probs: pa.ListArray.from_arrays(ends, both)})

    spark.udtf.register(name, Predict)
    return name
