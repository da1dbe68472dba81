"""Mixing sources to target weights by Poisson replication and a global shuffle."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import cut, free_names, null_safe_key, others, quoted, salted_join

SEED = "mix-1"
#: Sources get weights in proportion to their document count to this power.
TEMPERATURE = 0.5
#: More sources than this aren't broadcast but joined by a shuffle.
MAX_BROADCAST_SOURCES = 100_000
#: Terms of the distribution that are looked at: mean + SPREAD * sqrt(mean) + FLOOR.
SPREAD, FLOOR = 12, 24
#: Up to this mean terms are added from 0 on, as exp(-mean) must be a normal double; over it from SPREAD deviations below the mean.
FROM_ZERO = 700


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts: 52 bits."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _log_term(k: Column, mean: Column) -> Column:
    """ln P(X = k) of a Poisson X near its mean, for large k: Stirling's series, with no difference of large numbers."""
    k = k.cast("double")
    return (k - mean) + k * F.log1p((mean - k) / k) - F.log(k * (2 * math.pi)) / 2 - 1 / (12 * k) + 1 / (360 * k * k * k)


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The smallest k with P(X <= k) > u, X being Poisson with this mean.

    Terms are added from 0 on, or, with a mean over FROM_ZERO, from SPREAD deviations
    below it: what lies below that, as the tail past SPREAD deviations above, is less
    than the steps of u. So any mean whose draws are ints takes its turn, in a number
    of steps that grows with the root of a large mean.
    """
    large, reach = mean > FROM_ZERO, SPREAD * F.sqrt(mean) + FLOOR
    least = F.when(large, (mean - reach).cast("int")).otherwise(0)
    most = (mean + reach).cast("int")
    first = F.exp(F.when(large, _log_term(least, mean)).otherwise(-mean))
    start = F.struct(least.alias("k"), first.alias("p"), first.alias("c"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        return F.when(s["c"] > u, s).otherwise(F.struct(i.alias("k"), p.alias("p"), (s["c"] + p).alias("c")))

    return F.aggregate(F.sequence(least + 1, most), start, step, lambda s: s["k"])


def rates(docs: DataFrame, source_col: str = "source", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = 1.0) -> DataFrame:
    """One row per source: stratum, n_source, rate: the mean number of copies of its documents.

    The mixture holds epochs * N documents in expectation. weights: target share
    by source, scaled to sum 1, sources that aren't named get none, and if no source
    with a weight is there, none gets any; a weight that is negative or no finite
    number raises an error. Without weights a source's share is its document count to
    the power `temperature`, scaled. A null source is one of its own. An empty table
    gives no rows; repeated rows count as often as they come; other columns, texts
    included, aren't read.
    """
    for name, w in (weights or {}).items():
        if not 0 <= w < math.inf:
            raise ValueError(f"the weight of source {name} is {w}")
    counts = docs.groupBy(null_safe_key(F.col(source_col)).alias("stratum")).agg(F.count(F.lit(1)).alias("n_source"))
    if weights is None:
        share = F.pow(F.col("n_source").cast("double"), F.lit(float(temperature)))
    elif not weights:
        share = F.lit(0.0)
    else:
        named = F.create_map(*[F.lit(x) for k, v in weights.items() for x in ("-" if k is None else f"={k}", float(v))])
        share = F.coalesce(F.try_element_at(named, F.col("stratum")), F.lit(0.0))
    counts = cut(counts.withColumn("share", share))  # a row a source, read again below
    total = counts.agg(F.sum("n_source").alias("n_all"), F.sum("share").alias("share_all")).first()
    return counts.select("stratum", "n_source", (F.lit(float(epochs)) * F.lit(total.n_all) * F.col("share") / F.lit(total.share_all or 1.0) / F.col("n_source")).alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = 1.0, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs, each as often as a Poisson draw with its source's rate says, in a global random order.

    All columns return, with copy_no (from 1), n_copies, and mix_key, the random
    number by which rows are ordered over all output partitions; they replace
    columns of these names, and no other name clashes. Draws depend on seed and id
    alone, so a rerun or a lost task repeats them, and rows of equal id (a null id is
    one) get equal draws. Null source is a source of its own; texts, null, empty or
    very long, are carried and not read. A rate under 1 leaves some documents out:
    that is the sampling itself; weights of which no source is there leave out all. An
    empty table gives no rows.

    The order is uniform in [0, 1), so rows go straight to the partition of their
    part of it; no sample is taken to find bounds.
    """
    added = ("copy_no", "n_copies", "mix_key")
    names = others(docs, added)
    stratum, rate, ident, part = free_names([*names, *added], "stratum", "rate", "ident", "part")
    table = cut(rates(docs, source_col, weights, temperature, epochs).withColumnsRenamed({"stratum": stratum, "rate": rate}))
    rows = docs.select(*quoted(names), null_safe_key(F.col(source_col)).alias(stratum), null_safe_key(F.col(id_col)).alias(ident))
    if table.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES:
        rows = rows.join(F.broadcast(table.select(stratum, rate)), stratum)
    else:
        n_source = free_names(rows.columns, "n_source")[0]
        rows = salted_join(rows, table.withColumnRenamed("n_source", n_source), [stratum], n_source, ident)
    rows = rows.withColumn("n_copies", poisson_inverse(uniform(F.lit(seed), F.col(ident)), F.col(rate))).where("n_copies > 0")
    rows = rows.select(*quoted(names), ident, "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy_no"))
    rows = rows.withColumn("mix_key", uniform(F.lit(seed), F.lit("order"), F.col(ident), F.col("copy_no")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn(part, F.floor(F.col("mix_key") * parts).cast("int")).repartitionById(parts, F.col(part))
    return rows.sortWithinPartitions("mix_key").select(*quoted(names), *added)
