"""Scatter matrices per site, pooled covariance and correlation, principal components, T² outliers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.functions.distributions import f_quantile
from caresieve.operators.skew import HOT_KEYS, cut, salted_join

#: Beyond this many columns, one aggregation of all pairs would be too wide to compile.
MAX_COLUMNS = 50
#: Matrices of one site that are merged in one task.
FAN, LEVELS = 32, 2


def pairs(columns: list[str]) -> list[tuple[int, int]]:
    """(i, j), i <= j."""
    return [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]


def local_scatter(df: DataFrame, site: str, columns: list[str]) -> DataFrame:
    """Per site: n, mean and scatter (sum of products of deviations, upper triangle by rows).

    One aggregation with partial sums; only a row a site leaves it.
    """
    if len(columns) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns: use vector_scatter")
    sums = [(F.covar_pop(columns[i], columns[j]) * F.count(F.lit(1))).alias(f"s_{i}_{j}") for i, j in pairs(columns)]
    rows = df.dropna(subset=columns).groupBy(site).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)], *sums)
    return rows.select(
        site, "n", F.array(*[f"m_{i}" for i in range(len(columns))]).alias("mean"), F.array(*[f"s_{i}_{j}" for i, j in pairs(columns)]).alias("scatter")
    )


def vector_scatter(df: DataFrame, site: str, vector: str, width: int) -> DataFrame:
    """The same for rows that hold a vector: tasks sum products in numpy, sites merge by Chan's rule in pandas.

    A task returns one row of width² numbers a site, so the shuffle grows with tasks
    and sites and not with rows. Rows of a site merge FAN at a time, LEVELS times, before
    the rest (of 30,000 tasks some 30) merge at last. A task holds one matrix a site:
    width² doubles must fit in a worker.
    """
    import pandas as pd

    schema = "site string, part int, n bigint, mean array<double>, scatter array<double>"

    def local(frames):
        from pyspark import TaskContext

        held: dict[str, list] = {}
        for f in frames:
            for name, part in f.groupby("site"):
                x = np.stack(part["v"].to_numpy()).astype(float)
                m = x.mean(axis=0)
                held[name] = merge_moments(held.get(name), (len(x), m, (x - m).T @ (x - m)))
        part = TaskContext.get().partitionId()
        rows = [(k, part, n, m.tolist(), s[np.triu_indices(width)].tolist()) for k, (n, m, s) in held.items()]
        yield pd.DataFrame(rows, columns=["site", "part", "n", "mean", "scatter"])

    def merged(key, f):
        out = None
        for n, m, s in zip(f["n"], f["mean"], f["scatter"]):
            own = np.zeros((width, width))
            own[np.triu_indices(width)] = s
            out = merge_moments(out, (n, np.array(m), own))
        n, m, s = out  # below the diagonal are sums that aren't read
        return pd.DataFrame([(key[0], int(f["part"].iloc[0]) // FAN, n, m.tolist(), s[np.triu_indices(width)].tolist())], columns=["site", "part", "n", "mean", "scatter"])

    rows = df.select(F.col(site).cast("string").alias("site"), F.col(vector).alias("v")).where("v is not null")
    out = rows.mapInPandas(local, schema)
    for _ in range(LEVELS):
        out = out.groupBy("site", F.floor(F.col("part") / FAN).cast("int").alias("group")).applyInPandas(merged, schema)
    return out.groupBy("site").applyInPandas(merged, schema).drop("part")


def merge_moments(a, b):
    """(n, mean, scatter) of two disjoint parts together."""
    if a is None:
        return b
    n = a[0] + b[0]
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


@dataclass(frozen=True)
class Pooled:
    """What the sites' summaries say about all rows."""

    n: int
    mean: np.ndarray
    covariance: np.ndarray

    @property
    def deviation(self) -> np.ndarray:
        return np.sqrt(np.diag(self.covariance))

    @property
    def correlation(self) -> np.ndarray:
        d = self.deviation
        return self.covariance / np.outer(d, d)


def pooled(local: DataFrame) -> Pooled:
    """Covariance over all rows from one row per site: within plus between sites, divided by N - 1."""
    rows = [r.asDict() for r in local.select("n", "mean", "scatter").collect()]  # one row a site
    p = len(rows[0]["mean"])
    n = sum(r["n"] for r in rows)
    mean = sum(r["n"] * np.array(r["mean"]) for r in rows) / n
    total = np.zeros((p, p))
    for r in rows:
        s = np.zeros((p, p))
        s[np.triu_indices(p)] = r["scatter"]
        s = s + np.triu(s, 1).T
        d = np.array(r["mean"]) - mean
        total += s + r["n"] * np.outer(d, d)
    return Pooled(n, mean, total / (n - 1))


@dataclass(frozen=True)
class Components:
    """Loadings (columns) of the kept components, and the variance that each of all explains."""

    loadings: np.ndarray
    explained: np.ndarray

    @property
    def kept(self) -> int:
        return self.loadings.shape[1]


def principal_components(correlation: np.ndarray, threshold: float = 0.7) -> Components:
    """The fewest components that explain `threshold` of the variance; each sign makes its largest loading positive."""
    values, vectors = np.linalg.eigh(correlation)
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order]
    share = values / values.sum()
    k = int(np.argmax(np.cumsum(share) >= threshold - 1e-12)) + 1
    top = np.abs(vectors).argmax(axis=0)
    return Components((vectors * np.sign(vectors[top, range(len(values))]))[:, :k], share)


def score_columns(columns: list[str], stats: Pooled, loadings: np.ndarray, standardise: bool = True) -> list[Column]:
    """pc1, pc2, ... as sums over the columns; raw values if not standardised."""
    out = []
    for j in range(loadings.shape[1]):
        total = F.lit(0.0)
        for i, c in enumerate(columns):
            x = F.col(c).cast("double")
            if standardise:
                x = (x - float(stats.mean[i])) / float(stats.deviation[i])
            total = total + x * float(loadings[i, j])
        out.append(total.alias(f"pc{j + 1}"))
    return out


def t2_threshold(n: int, p: int, alpha: float = 0.05) -> float:
    """p (n - 1) / (n - p) times the F quantile."""
    return p * (n - 1) / (n - p) * f_quantile(1 - alpha, p, n - p)


def t2_outliers(df: DataFrame, site: str, scores: list[str], alpha: float = 0.05, centre: bool = True) -> DataFrame:
    """df with t2 and outlier, by the score variances of each row's site.

    Statistics are one row a site, the F quantile is taken once in each. They go to the rows where
    these lie; of over HOT_KEYS sites (any column may be the site) rows are dealt by site, large sites over many tasks.
    centre=False squares the scores as they are.
    """

    @F.pandas_udf("double")
    def limit(n):
        return n.map(lambda k: t2_threshold(int(k), len(scores), alpha) if k > len(scores) else None).astype(float)

    stats = df.groupBy(site).agg(F.count(F.lit(1)).alias("__n"), *[f(c).alias(f"__{k}_{c}") for c in scores for k, f in (("v", F.var_samp), ("m", F.avg))])
    stats = cut(stats.withColumn("__limit", limit("__n")))
    t2 = sum(((F.col(c) - (F.col(f"__m_{c}") if centre else 0.0)) ** 2 / F.col(f"__v_{c}") for c in scores), F.lit(0.0))
    joined = df.join(F.broadcast(stats), site) if stats.count() <= HOT_KEYS else salted_join(df, stats, [site], "__n", scores[0])
    out = joined.withColumn("t2", t2).withColumn("outlier", F.coalesce(F.col("t2") > F.nanvl("__limit", F.lit(None)), F.lit(False)))
    return out.drop(*[c for c in out.columns if c.startswith("__")])
