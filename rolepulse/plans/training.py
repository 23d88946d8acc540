"""Linear churn models: ten steps of gradient descent, one aggregate per step.

The step rule is the one of the SGD linear models: no intercept, zero start,
step size 1/sqrt(t), L2 strength 0.01, whole data in every step. Sums run on the
executors; only one number per feature returns to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolepulse.layouts import SGD_ITERATIONS

# ---- fixed values: defaults of the SGD models -------------------------------
STEP = 1.0
REGULARISATION = 0.01
TOLERANCE = 0.001
# ---- end of fixed values ----------------------------------------------------


def _margin(weights: list[float], names: list[str]) -> Column:
    out = F.lit(0.0)
    for w, n in zip(weights, names):
        out = out + F.lit(w) * F.col(n)
    return out


def _logistic_pull(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("label")


def _hinge_pull(margin: Column) -> Column:
    sign = F.col("label") * 2 - 1
    return F.when(sign * margin < 1.0, -sign).otherwise(0.0)


PULLS = {"svm": _hinge_pull, "logistic": _logistic_pull}


def train(features: DataFrame, names: list[str], models: tuple[str, ...] = tuple(PULLS), iterations: int = SGD_ITERATIONS) -> dict[str, list[float]]:
    """Weights of each model after the given steps; one pass over the features serves a step of all of them.

    A model stops early once a step hardly moves it.
    """
    weights = {m: [0.0] * len(names) for m in models}
    moving = list(models)
    for t in range(1, iterations + 1):
        if not moving:
            break
        force = features.select("*", *[PULLS[m](_margin(weights[m], names)).alias(f"_pull_{m}") for m in moving])
        sums = [F.sum(F.col(f"_pull_{m}") * F.col(n)).alias(f"{m}_{i}") for m in moving for i, n in enumerate(names)]
        row = force.agg(F.count(F.lit(1)).alias("_n"), *sums).first()
        if not row["_n"]:
            break
        step = STEP / math.sqrt(t)
        for m in list(moving):
            w = weights[m]
            new = [wi * (1 - step * REGULARISATION) - step * (row[f"{m}_{i}"] / row["_n"]) for i, wi in enumerate(w)]
            moved = math.sqrt(sum((a - b) ** 2 for a, b in zip(new, w)))
            size = math.sqrt(sum(a * a for a in new))
            weights[m] = new
            if t > 1 and moved < TOLERANCE * max(size, 1.0):
                moving.remove(m)
    return weights


def train_svm(features: DataFrame, names: list[str], iterations: int = SGD_ITERATIONS) -> list[float]:
    return train(features, names, ("svm",), iterations)["svm"]


def train_logistic(features: DataFrame, names: list[str], iterations: int = SGD_ITERATIONS) -> list[float]:
    return train(features, names, ("logistic",), iterations)["logistic"]


def weights_table(features: DataFrame, names: list[str], **models: list[float]) -> DataFrame:
    """One row per feature with its weight in each model."""
    rows = [(n, *[float(w[i]) for w in models.values()]) for i, n in enumerate(names)]
    schema = "feature string, " + ", ".join(f"{m} double" for m in models)
    return features.sparkSession.createDataFrame(rows, schema)
