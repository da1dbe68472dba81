"""Losses over rows of labels, probabilities and embeddings, as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.functions.arrays import angle, squared_distance
from caresieve.operators.replicates import close_pairs
from caresieve.operators.skew import cut


def _safe_log(p: Column) -> Column:
    return F.log(F.greatest(p, F.lit(1e-12)))


def binary_cross_entropy(df: DataFrame, truth: str, p: str, pos_weight: float = 1.0) -> DataFrame:
    y, q = F.col(truth).cast("double"), F.col(p)
    return df.agg(F.avg(-(pos_weight * y * _safe_log(q) + (1 - y) * _safe_log(1 - q))).alias("loss"))


def weighted_cross_entropy(df: DataFrame, truth: str, probabilities: str, weights: list[float]) -> DataFrame:
    """Mean over the weights of -w log p of the true class; probabilities is an array."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col(truth) + 1)
    p = F.element_at(F.col(probabilities), F.col(truth) + 1)
    return df.agg((F.sum(-w * _safe_log(p)) / F.sum(w)).alias("loss"))


def dice_loss(df: DataFrame, truth: str, p: str, epsilon: float = 1e-6) -> DataFrame:
    """1 - 2 sum(ab) / sum(a² + b²)."""
    a, b = F.col(truth).cast("double"), F.col(p)
    return df.agg((1 - 2 * F.sum(a * b) / F.greatest(F.sum(a * a + b * b), F.lit(epsilon))).alias("loss"))


def generalised_dice_loss(df: DataFrame, label: str, truth: str, p: str, epsilon: float = 1e-6) -> DataFrame:
    """Dice over classes (rows of long form) weighted by 1 / volume²."""
    a, b = F.col(truth).cast("double"), F.col(p)
    per = df.groupBy(label).agg(F.sum(a * b).alias("ab"), F.sum(a + b).alias("both"), F.sum(a).alias("vol"))
    w = 1 / F.greatest(F.col("vol") ** 2, F.lit(epsilon))
    return per.agg((1 - 2 * F.sum(w * F.col("ab")) / F.greatest(F.sum(w * F.col("both")), F.lit(epsilon))).alias("loss"))


def squared_error(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(truth) - F.col(predicted)) ** 2).alias("loss"))


def smooth_l1(df: DataFrame, truth: str, predicted: str, beta: float = 1.0) -> DataFrame:
    """Mean of d² / (2 beta) below beta and |d| - beta / 2 from there on."""
    d = F.abs(F.col(truth) - F.col(predicted))
    return df.agg(F.avg(F.when(d < beta, d * d / (2 * beta)).otherwise(d - beta / 2)).alias("loss"))


def pixel_cross_entropy(df: DataFrame, truth: str, scores: str, weight: str, class_weights: list[float], ignore: int | None = None) -> DataFrame:
    """Mean over pixels and classes of -weight * class weight * log softmax of the true class; ignored pixels add 0."""
    x = F.col(scores)
    top = F.array_max(x)
    total = F.aggregate(x, F.lit(0.0), lambda s, v: s + F.exp(v - top))
    counts = F.lit(True) if ignore is None else F.col(truth) != ignore
    place = F.when(counts, F.col(truth) + 1).otherwise(1)
    own = F.element_at(x, place) - top - F.log(total)
    w = F.element_at(F.array(*[F.lit(float(c)) for c in class_weights]), place)
    return df.agg((F.sum(F.when(counts, -F.col(weight) * w * own).otherwise(0.0)) / (F.count(F.lit(1)) * len(class_weights))).alias("loss"))


def square_angular(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Sum of the squared angles between two directions of each row, weighted if asked."""
    a = angle(F.col(truth), F.col(predicted))
    return df.agg(F.sum(a * a if weight is None else a * a * F.col(weight)).alias("loss"))


def contrastive(df: DataFrame, instance: str, vector: str, near: float = 0.5, far: float = 1.5, terms: tuple[float, float, float] = (1.0, 1.0, 0.001)) -> DataFrame:
    """Variance, distance and size terms of embeddings by instance, with hinges at near and 2 * far.

    Only means meet in pairs, and of these only pairs nearer than 2 * far, as the hinge of
    others is 0; they come from cells, and equal means are one with a count.
    """
    width = df.select(F.size(vector)).first()[0]
    centre = F.array(*[F.avg(F.element_at(F.col(vector), i + 1)) for i in range(width)])
    means = df.groupBy(F.col(instance).alias("__i")).agg(centre.alias("__m"), F.count(F.lit(1)).alias("__n"))
    rows = df.join(means, F.col(instance) == F.col("__i"))
    pull = F.greatest(F.sqrt(squared_distance(F.col(vector), F.col("__m"))) - near, F.lit(0.0)) ** 2
    variance = rows.groupBy("__i").agg(F.avg(pull).alias("x")).agg(F.avg("x").alias("variance"))
    named = cut(means.select(F.col("__m").alias("m"), F.monotonically_increasing_id().alias("k")))
    classes = named.groupBy("m").agg(F.min("k").alias("k"), F.count(F.lit(1)).cast("double").alias("copies"))
    near_ = close_pairs(classes, "k", "m", 2 * far)
    copies = classes.select("k", "copies")
    between = near_.join(copies.withColumnsRenamed({"k": "a", "copies": "na"}), "a").join(copies.withColumnsRenamed({"k": "b", "copies": "nb"}), "b")
    pushed = between.agg(F.coalesce(F.sum(F.col("na") * F.col("nb") * (2 * far - F.col("distance")) ** 2), F.lit(0.0)).alias("x"))
    n = F.sum("copies")
    alike = classes.agg((F.sum(F.col("copies") * (F.col("copies") - 1) / 2) * (2 * far) ** 2).alias("y"), (n * (n - 1) / 2).alias("pairs"))
    distance = pushed.crossJoin(alike).select(F.coalesce(F.try_divide(F.col("x") + F.col("y"), F.col("pairs")), F.lit(0.0)).alias("distance"))  # two single rows
    size = means.agg(F.avg(F.sqrt(F.aggregate("__m", F.lit(0.0), lambda s, v: s + v * v))).alias("size"))
    one = variance.crossJoin(distance).crossJoin(size)  # three single rows
    return one.withColumn("loss", terms[0] * F.col("variance") + terms[1] * F.col("distance") + terms[2] * F.col("size"))
