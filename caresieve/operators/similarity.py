"""How alike sites are: bounding boxes and their overlap, Fréchet distance of feature distributions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounding_boxes(df: DataFrame, site: str, columns: list[str]) -> DataFrame:
    """One row per site: lower and upper corner and the volume."""
    box = df.groupBy(site).agg(*[f(c).alias(f"{k}_{c}") for c in columns for k, f in (("min", F.min), ("max", F.max))])
    volume: Column = F.lit(1.0)
    for c in columns:
        volume = volume * (F.col(f"max_{c}") - F.col(f"min_{c}"))
    return box.select(site, F.array(*[f"min_{c}" for c in columns]).alias("low"), F.array(*[f"max_{c}" for c in columns]).alias("high"), volume.alias("volume"))


def overlap_similarity(boxes: DataFrame, site: str) -> DataFrame:
    """(site_a, site_b, similarity) of all ordered pairs of sites, also of a site with itself.

    2 * overlap / (volume + volume); 0 if an axis doesn't overlap. There is one box a
    site, so the pairs are of summaries.
    """
    a = boxes.select(F.col(site).alias("site_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.col("volume").alias("volume_a"))
    b = boxes.select(F.col(site).alias("site_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("volume").alias("volume_b"))
    low = F.zip_with("low_a", "low_b", lambda x, y: F.greatest(x, y))
    high = F.zip_with("high_a", "high_b", lambda x, y: F.least(x, y))
    side = F.zip_with(low, high, lambda x, y: y - x)
    shared = F.when(F.exists(side, lambda d: d < 0), 0.0).otherwise(F.aggregate(side, F.lit(1.0), lambda acc, d: acc * d))
    return a.join(b).select("site_a", "site_b", (2 * shared / (F.col("volume_a") + F.col("volume_b"))).alias("similarity"))


def frechet(mean_a: np.ndarray, cov_a: np.ndarray, mean_b: np.ndarray, cov_b: np.ndarray) -> float:
    """|difference of means|² + trace(A + B - 2 sqrt(AB)), by symmetric eigenvalues."""

    def root(m: np.ndarray) -> np.ndarray:
        values, vectors = np.linalg.eigh(m)
        return (vectors * np.sqrt(np.clip(values, 0, None))) @ vectors.T

    half = root(cov_a)
    inner = np.sqrt(np.clip(np.linalg.eigvalsh(half @ cov_b @ half), 0, None)).sum()
    return float(((mean_a - mean_b) ** 2).sum() + np.trace(cov_a) + np.trace(cov_b) - 2 * inner)


def frechet_matrix(local: DataFrame) -> DataFrame:
    """(site_a, site_b, distance, similarity) from the rows of vector_scatter.

    similarity: 1 - distance / largest distance, 4 digits; 1 where all are 0. Sites
    with one row have no covariance and are left out.
    """
    rows = sorted((r["site"], r["n"], np.array(r["mean"]), np.array(r["scatter"])) for r in local.collect() if r["n"] > 1)  # one row a site
    stats = []
    for name, n, mean, upper in rows:
        p = len(mean)
        s = np.zeros((p, p))
        s[np.triu_indices(p)] = upper
        stats.append((name, mean, (s + np.triu(s, 1).T) / (n - 1)))
    found = {}
    for i, (a, ma, ca) in enumerate(stats):
        for b, mb, cb in stats[i:]:
            found[a, b] = found[b, a] = 0.0 if a == b else max(0.0, frechet(ma, ca, mb, cb))
    top = max(found.values(), default=0.0)
    out = [(a, b, d, 1.0 if top == 0 else round(1 - d / top, 4)) for (a, b), d in sorted(found.items())]
    return local.sparkSession.createDataFrame(out, "site_a string, site_b string, distance double, similarity double")
