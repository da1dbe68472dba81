"""Federated training and evaluation: gradients summed per site, weighted averages, confusion metrics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_average(df: DataFrame, weight: str, values: list[str], by: list[str] | None = None) -> DataFrame:
    """sum(w x) / sum(w) of each column; rows whose value isn't a number are refused when read."""

    def guarded(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(F.isnan(x), F.raise_error(F.lit(f"{c} isn't a number")).cast("double")).otherwise(x)

    return df.groupBy(*(by or [])).agg(*[(F.sum(F.col(weight) * guarded(c)) / F.sum(weight)).alias(c) for c in values])


def confusion(df: DataFrame, truth: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp, accuracy, precision, recall, f1; a ratio of nothing is 0."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    counts = df.groupBy(*(by or [])).agg(F.count_if(~t & ~p).alias("tn"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(t & p).alias("tp"))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {"accuracy": ratio(tp + tn, tn + fp + fn + tp), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}
    )


def positive_weight(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """negatives, positives and negatives / positives, the weight of a positive."""
    y = F.col(label)
    counts = df.groupBy(*(by or [])).agg(F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives"))
    return counts.withColumn("pos_weight", F.try_divide(F.col("negatives").cast("double"), F.col("positives")))


@dataclass(frozen=True)
class Linear:
    """weights and bias of z = w.x + b; rows are positive where z > 0."""

    weights: tuple[float, ...]
    bias: float

    def z(self, columns: list[str]) -> Column:
        return sum((F.col(c) * w for c, w in zip(columns, self.weights)), F.lit(self.bias))


def train_rounds(
    df: DataFrame, site: str, columns: list[str], label: str, loss: str = "logistic", rounds: int = 20, rate: float = 1.0, l1: float = 0.0, l2: float = 0.0, min_sites: int = 1, pos_weight: float = 1.0
) -> Linear:
    """Rounds of one gradient per site, averaged by the sites' row counts; from weights of 0.

    loss: logistic (labels 0 and 1, positives weighted) or squared (mean squared error
    of z). l1 and l2 weigh the sums of |w| and w² in the loss; the bias is free. Each
    round is one aggregation; a row of len(columns) + 2 numbers leaves a site.
    A round with fewer than min_sites sites, or with a gradient that isn't a number,
    fails. df should be cached or small: it is read once a round.
    """
    if loss not in ("logistic", "squared"):
        raise ValueError(f"loss {loss!r} isn't known")
    model = Linear((0.0,) * len(columns), 0.0)
    y = F.col(label).cast("double")
    for _ in range(rounds):
        z = model.z(columns)
        gap = F.when(y == 1, pos_weight).otherwise(1.0) * (1 / (1 + F.exp(-z)) - y) if loss == "logistic" else 2 * (z - y)
        local = df.groupBy(site).agg(F.count(F.lit(1)).alias("n"), F.avg(gap).alias("g_bias"), *[F.avg(gap * F.col(c)).alias(f"g_{i}") for i, c in enumerate(columns)])
        rows = local.collect()  # one row a site
        if len(rows) < min_sites:
            raise RuntimeError(f"{len(rows)} sites replied, {min_sites} are needed")
        n = sum(r["n"] for r in rows)
        g = sum(r["n"] * np.array([r["g_bias"], *[r[f"g_{i}"] for i in range(len(columns))]]) for r in rows) / n
        if np.isnan(g).any():
            raise RuntimeError("a gradient isn't a number")
        held = np.array([0.0, *model.weights])
        now = np.array([model.bias, *model.weights]) - rate * (g + l1 * np.sign(held) + 2 * l2 * held)
        model = Linear(tuple(float(x) for x in now[1:]), float(now[0]))
    return model


def train_logistic(df: DataFrame, site: str, columns: list[str], label: str, rounds: int = 20, rate: float = 1.0, l2: float = 1e-3, min_sites: int = 1, pos_weight: float = 1.0) -> Linear:
    """train_rounds with the logistic loss and half of l2 on w²."""
    return train_rounds(df, site, columns, label, "logistic", rounds, rate, 0.0, l2 / 2, min_sites, pos_weight)


def train_linear(df: DataFrame, site: str, columns: list[str], label: str, rounds: int = 20, rate: float = 0.1, l1: float = 0.0, l2: float = 0.0, min_sites: int = 1) -> Linear:
    """train_rounds with the squared loss."""
    return train_rounds(df, site, columns, label, "squared", rounds, rate, l1, l2, min_sites)


def regression_scores(df: DataFrame, columns: list[str], label: str, model: Linear, by: list[str] | None = None) -> DataFrame:
    """(by..., mse, and the confusion metrics of z > 0, which is sigmoid(z) > 0.5) of a model."""
    rows = df.withColumns({"z": model.z(columns), "predicted": (model.z(columns) > 0).cast("int")})
    errors = rows.groupBy(*(by or [])).agg(F.avg((F.col("z") - F.col(label)) ** 2).alias("mse"))
    scores = confusion(rows, label, "predicted", by)
    return errors.join(scores, by) if by else errors.crossJoin(scores)  # two single rows


def evaluate_across(df: DataFrame, site: str, columns: list[str], label: str, models: dict[str, Linear]) -> DataFrame:
    """model, site and confusion metrics of every model on every site's rows, in one pass over df.

    models: a handful, so the rows that the pass makes are rows times models.
    """
    verdicts = F.array(*[F.struct(F.lit(k).alias("model"), (m.z(columns) > 0).cast("int").alias("predicted")) for k, m in models.items()])
    rows = df.select(site, label, F.inline(verdicts))
    return confusion(rows, label, "predicted", ["model", site])


def best_model(scores: DataFrame, metric: str = "accuracy") -> DataFrame:
    """The model whose mean metric over sites is best; the first by name of equals."""
    means = scores.groupBy("model").agg(F.avg(metric).alias(metric))
    return means.orderBy(F.desc(metric), "model").limit(1)
