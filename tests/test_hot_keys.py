"""Operators with a third of all rows in one key, against plain versions."""

import json

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from caresieve.operators import joins, losses, prepare, quality, replicates
from caresieve.sources import files


def plain_asof(rows, facts):
    out = []
    for i, k, t in rows:
        own = [(ft, v) for fk, ft, v in facts if k is not None and fk == k and ft is not None and t is not None and ft <= t]
        out.append((i, k, t, max(own)[1] if own else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_asof_with_a_hot_key_and_null_keys(spark, partitions):
    rng = np.random.default_rng(3)
    key = lambda: None if rng.random() < 0.1 else 0 if rng.random() < 0.4 else int(rng.integers(1, 6))
    when = lambda: None if rng.random() < 0.05 else int(rng.integers(0, 300))
    rows = [(i, key(), when()) for i in range(300)] + [(300 + i, 0, 150) for i in range(40)]
    facts = [(key(), when(), int(i)) for i in range(120)]
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        a, b = spark.createDataFrame(rows, "id int, k int, t int"), spark.createDataFrame(facts, "k int, t int, v int")
        got = joins.asof_join(a, b, ["k"], "t", ["v"])
        assert sorted(map(tuple, got.collect()), key=str) == plain_asof(rows, facts)
        # without a key all rows are one
        one = joins.asof_join(a.drop("k"), b.drop("k"), [], "t", ["v"])
        assert sorted(map(tuple, one.collect()), key=str) == sorted(((i, t, v) for i, _, t, v in plain_asof([(i, 0, t) for i, _, t in rows], [(0, t, v) for _, t, v in facts])), key=str)
        assert [r.v for r in joins.asof_join(a, b.where("false"), ["k"], "t", ["v"]).collect()] == [None] * len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def crowd(n, width=12):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, width))
    x[: n // 3] = x[0] + rng.normal(size=(n // 3, width)) * 1e-5  # a third lies in one place
    x[n // 3 : n // 3 + 20] = x[n // 3] + np.arange(20)[:, None] * 0.9e-3 / np.sqrt(width)  # a chain: each is near the next one alone
    x[-5:] = x[-6]
    return x


@pytest.mark.parametrize("full, most", [(1 << 14, 12), (50, 12), (50, 6)])
def test_groups_of_a_crowd_are_those_of_all_pairs(spark, monkeypatch, full, most):
    monkeypatch.setattr(replicates, "FULL_CELL", full)
    monkeypatch.setattr(replicates, "MOST_AXES", most)
    x = crowd(400)
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) < 1e-6
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(near, root[None, :], len(x)).min(axis=1))
        if (new == root).all():
            break
        root = new
    want = sorted((i, int(root[i]), bool(root[i] == i)) for i in range(len(x)) if (root == root[i]).sum() > 1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>").repartition(6)
    assert sorted(map(tuple, replicates.replicate_groups(df, "id", "v").collect())) == want
    links = replicates.close_links(df.select(F.col("id").alias("k"), F.col("v").alias("x")))
    assert links.count() < 8 * len(x)  # and not the 8,700 pairs of the crowd


def test_first_of_equal_rows(spark):
    rows = [(i, i % 3, None if i % 3 == 2 else "x") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a int, `b.c` string").repartition(5)
    assert sorted(map(tuple, quality.keep_first(df, "id").collect())) == [(0, 0, "x"), (1, 1, "x"), (2, 2, None)]
    assert quality.keep_first(df.unionByName(df), "id", "row").count() == 300
    numbered = quality.number_replicates(df, "id", ["id"]).where("copy = 1").drop("copy")
    assert sorted(map(tuple, numbered.collect())) == sorted(map(tuple, quality.keep_first(df, "id").collect()))


def test_splits_do_not_depend_on_the_buckets(spark):
    df = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("s"))
    a, b = (sorted(map(tuple, prepare.split(df, "id", 5, 0.2, "s", rows).collect())) for rows in (64, 1 << 20))
    assert a == b
    n = {r.s: (r.t, r.n) for r in prepare.split(df, "id", 5, 0.2, "s", 64).groupBy("s").agg(F.count_if(F.col("split") == "test").alias("t"), F.count("*").alias("n")).collect()}
    assert all(t == int(k * 0.2) for t, k in n.values())


def test_counts_come_with_the_pass_that_reads(spark, tmp_path):
    for name, text in {"a": json.dumps({"x": 1, "y": 2.5}), "b": "{}", "c": "[broken", "d": json.dumps({"x": None})}.items():
        (tmp_path / f"{name}.json").write_text(text)
    metrics = Observation("samples")
    rows = files.read_samples(spark, str(tmp_path), metrics)
    got = sorted(((r.sample, r.feature, r.value) for r in rows.collect()), key=str)
    assert ("a", "y", 2.5) in got and ("c", None, None) in got
    assert metrics.get == {"n_files": 4, "n_unreadable": 1, "n_empty": 1}


def test_contrastive_hinge_against_all_pairs_of_means(spark):
    rng = np.random.default_rng(2)
    means = np.concatenate([rng.normal(size=(30, 4)) * 3, np.zeros((4, 4)), rng.normal(size=(20, 4)) * 0.1])
    rows = [(i, (m + s * d).tolist()) for i, m in enumerate(means) for d in (rng.normal(size=4) * 0.2,) for s in (-1, 1)]
    got = losses.contrastive(spark.createDataFrame(rows, "i int, v array<double>"), "i", "v", 0.1, 0.6).first()
    m = np.array([(np.array(rows[2 * i][1]) + np.array(rows[2 * i + 1][1])) / 2 for i in range(len(means))])
    gap = np.sqrt(((m[:, None] - m[None]) ** 2).sum(axis=2))[np.triu_indices(len(m), 1)]
    assert got.distance == pytest.approx((np.maximum(0, 1.2 - gap) ** 2).mean(), rel=1e-9)
