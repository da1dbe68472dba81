"""Operators that compare documents, against plain Python over all rows."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caresieve.llm import common, exact_dedup, language_id, line_dedup, mixing, oracles, sharding, simhash

KEY = lambda r: str(r)
WS = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- line dedup


def plain_line_dedup(rows):
    docs = [(r[0], (r[1] or "").split("\n")) for r in rows]
    holders = defaultdict(set)
    for i, lines in docs:
        for x in lines:
            k = x.strip(WS).translate(LOW)
            if len(k) >= 10:
                holders[k].add(i)
    out = []
    for i, lines in docs:
        kept = [x for x in lines if not (len(h := holders.get(x.strip(WS).translate(LOW), ())) > 1 and min(h) != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def digest(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()), key=KEY)


def test_line_dedup(edge, rows, empty):
    out = line_dedup.line_dedup(edge)
    assert set(out.columns) == set(edge.columns)
    assert digest(out) == sorted(plain_line_dedup(rows), key=KEY)
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_dedup_with_full_filters_loses_nothing(edge, rows, monkeypatch):
    """Filters far too small suspect nearly every line; the result is the same."""
    monkeypatch.setattr(line_dedup, "MIN_WORDS", 8)
    assert digest(line_dedup.line_dedup(edge, max_words=8)) == sorted(plain_line_dedup(rows), key=KEY)


def test_a_line_of_very_many_documents(spark):
    rows = [(i, f"a line that all documents have\nown line number {i} is here") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(12)
    got = line_dedup.line_dedup(df).groupBy("n_dropped").count().collect()
    assert {r.n_dropped: r["count"] for r in got} == {0: 1, 1: 8999}


def test_an_id_that_a_third_of_all_rows_share(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("a line of all documents\nsome line of part "), F.col("id") % 100).alias("text"))
    got = sorted(map(tuple, line_dedup.line_dedup(df).groupBy("doc_id", "n_dropped").count().collect()))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = Counter((i, dropped) for i, _, dropped, _ in plain_line_dedup(rows))
    assert got == sorted((*k, n) for k, n in want.items())


def test_rows_of_one_id_with_many_lost_lines(spark):
    """Each row gets its own lost lines and no other's: 3,000 rows of one id lose a line each."""
    first = [(1, "\n".join(f"line number {i} of many" for i in range(3000)))]
    hot = [(2, f"line number {i} of many\nown line {i} of the hot id") for i in range(3000)]
    df = spark.createDataFrame(first + hot + hot[:5], "doc_id bigint, text string").repartition(8)
    out = line_dedup.line_dedup(df)
    joined = plan(out)
    assert "version" in joined
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect())
    assert got == sorted([(1, 3000, 0, first[0][1])] + [(2, 2, 1, t.split("\n")[1]) for _, t in hot + hot[:5]])


def test_lines_of_one_hash_are_told_apart_by_their_bytes(edge, rows, monkeypatch):
    monkeypatch.setattr(line_dedup.xxhash, "xxh3_128_digest", lambda key: b"same")
    assert digest(line_dedup.line_dedup(edge)) == sorted(plain_line_dedup(rows), key=KEY)


def test_rows_without_an_id_lose_nothing(spark):
    df = spark.createDataFrame([(None, "a line in two rows"), (1, "a line in two rows"), (2, "a line in two rows")], "doc_id bigint, text string")
    assert sorted((str(r.doc_id), r.n_dropped) for r in line_dedup.line_dedup(df).collect()) == [("1", 0), ("2", 1), ("None", 0)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=30), min_size=1, max_size=6))
def test_filters_have_no_false_negative(parts):
    hashes = [np.array([xxhash.xxh3_64_intdigest(str(x).encode()) for x in p], np.uint64) for p in parts]
    once, twice = np.zeros(16, np.uint64), np.zeros(16, np.uint64)
    for h in hashes:  # each part as one task, then merged
        f = line_dedup.TwoFilters(16)
        f.add(h)
        once, twice = once | f.once, twice | f.twice | (once & f.once)
    n = Counter(x for p in parts for x in p)
    again = [x for x, k in n.items() if k > 1]
    if again:
        assert line_dedup.suspected(twice, np.array([xxhash.xxh3_64_intdigest(str(x).encode()) for x in again], np.uint64)).all()


# ---- exact dedup


def plain_exact(rows):
    norm = lambda t: (t or "").translate({ord(c): None for c in WS})
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append((-len(r[1] or ""), r[0]))
    out, seen = [], set()
    for r in sorted(rows, key=lambda r: (-len(r[1] or ""), r[0])):
        g = groups[norm(r[1])]
        keep = min(g)[1]
        kept = r[0] == keep and (norm(r[1]), keep) not in seen
        seen.add((norm(r[1]), r[0]))
        out.append((r[0], keep, len(g), kept, hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return out


def test_exact_dedup(edge, rows, empty):
    out = exact_dedup.exact_dedup(edge)
    assert sorted(map(tuple, out.drop("bucket", "chain").collect()), key=KEY) == sorted(plain_exact(rows), key=KEY)
    assert "Python" not in plan(out) and "Arrow" not in plan(out)
    assert exact_dedup.exact_dedup(empty).count() == 0
    first = out.where("kept").groupBy("text_sha256").count().where("count <> 1").count()
    assert first == 0


def test_exact_dedup_null_ids(spark):
    df = spark.createDataFrame([(None, "x"), (5, "x"), (None, "only")], "doc_id bigint, text string")
    got = sorted((str(r.doc_id), str(r.keep_id), r.kept) for r in exact_dedup.exact_dedup(df).collect())
    assert got == [("5", "5", True), ("None", "5", False), ("None", "None", True)]


def test_a_group_of_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy of one text").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_dedup.exact_dedup(df, capacity=500)
    assert out.where("group_size = 10000").count() == 10_000 and out.where("kept").count() == 20_001
    assert out.select("bucket").distinct().count() > 16


def few_hashes(norm):
    """A bad hash: three values for all texts, at either end of the range and in the middle."""
    return F.element_at(F.array(*[F.lit(x).cast("long") for x in (7, -1, 1 << 62)]), F.length(norm) % 3 + 1)


@pytest.mark.parametrize("hash_of", [few_hashes, lambda norm: F.lit(5).cast("long")])
def test_texts_of_one_hash_are_told_apart_by_their_bytes(edge, rows, hash_of, monkeypatch):
    for many in (256, 1):  # the second: every hash of two rows is merged before it goes to its owner
        monkeypatch.setattr(exact_dedup, "HOT_COPIES", many)
        out = exact_dedup.exact_dedup(edge, hash_of=hash_of)
        assert sorted(map(tuple, out.drop("bucket", "chain").collect()), key=KEY) == sorted(plain_exact(rows), key=KEY)
        assert out.agg(F.max("chain")).first()[0] > 5


def test_index_entries_lie_in_their_buckets(spark, edge):
    entries, index = exact_dedup.build_index(edge, capacity=2)
    assert index.groupBy("bucket", "h", "chain").count().where("count > 1").count() == 0
    assert index.select("bucket").distinct().count() > 5
    assert index.select("bucket", "h").distinct().count() == index.select("h").distinct().count()
    assert entries.join(index, ["bucket", "h", "sha"]).count() == edge.count() == index.agg(F.sum("group_size")).first()[0]
    order = [r.h for r in index.orderBy("bucket", "h").collect()]
    assert order == sorted(order, key=lambda h: h % (1 << 64))  # buckets are ranges of the hash


def test_the_directory_routes(edge, rows, monkeypatch):
    """Texts whose cells the directory doesn't know have no owner and no group."""
    real = exact_dedup._owners
    monkeypatch.setattr(exact_dedup, "_owners", lambda *a: real(*a)[::2])
    assert exact_dedup.exact_dedup(edge, capacity=1).count() < len(rows)


def test_a_row_that_is_a_third_of_all(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "one  text").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_dedup.exact_dedup(df).cache()
    assert out.count() == 20_000 and out.where("kept").count() == 13_334
    assert out.where("doc_id = 7 and text_sha256 = sha2('onetext', 256)").agg(F.sum(F.col("kept").cast("int"))).first()[0] == 1


def test_checkpoints_are_removed_when_nothing_reads_them(spark, tmp_path):
    import gc
    import os
    import time

    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    sc.setCheckpointDir(str(tmp_path / "ckpt"))
    try:
        held = common.cut(spark.range(1000))
        exact_dedup.exact_dedup(spark.range(1000).selectExpr("id doc_id", "string(id % 9) text")).write.parquet(str(tmp_path / "out"))
        left = 9
        for _ in range(60):
            gc.collect()
            spark._jvm.System.gc()
            left = sum(name.startswith("rdd-") for _, dirs, _ in os.walk(tmp_path / "ckpt") for name in dirs)
            if left == 1:
                break
            time.sleep(0.5)
        assert left == 1 and held.count() == 1000  # what is still held stays
    finally:
        sc.setCheckpointDir(before.removeprefix("file:") if before else str(tmp_path / "later"))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 63), st.integers(1, 50), max_size=40), st.integers(1, 60))
def test_directory_doubling(counts, capacity):
    buckets = exact_dedup.directory(counts, 6, capacity)
    covered = [c for first, local, _ in buckets for c in range(first, first + (1 << (6 - local)))]
    assert sorted(covered) == list(range(64)) and covered == sorted(covered)
    for first, local, n in buckets:
        assert n == sum(counts.get(c, 0) for c in range(first, first + (1 << (6 - local))))
        assert n <= capacity or local == 6  # only a full-depth bucket chains its overflow


# ---- sharding


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_sharding(edge, rows, monkeypatch, bucket_rows):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    df = sharding.interleave(edge, shards=4)
    assert "Python" not in plan(df) and "Arrow" not in plan(df)
    out = df.collect()
    n = Counter(r.shard for r in out)
    assert len(out) == len(rows) and max(n.values()) - min(n.values()) <= 1 and set(n) == {0, 1, 2, 3}
    for s in n:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n[s]))
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    # ranks are those of one sort by the seeded hash within each source
    for source in {r.source for r in out}:
        own = [r for r in out if r.source == source]
        order = sorted(own, key=lambda r: (hashlib.md5(f"{sharding.SEED}:={r.doc_id}:{r.size}:{r.text_crc32}".encode()).hexdigest(), r.doc_id, r.size, r.text_crc32))
        assert sorted(r.rank for r in own) == list(range(1, len(own) + 1))
        assert [(r.doc_id, r.size) for r in sorted(own, key=lambda r: r.rank)] == [(r.doc_id, r.size) for r in order]
    assert [r.share for r in sorted(out, key=lambda r: (r.shard, r.slot))] == sorted(r.share for r in out)


def test_every_shard_matches_the_mixture(spark):
    df = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    out = sharding.interleave(df, shards=16)
    share = {r.source: r["count"] / 16 for r in out.groupBy("source").count().collect()}
    for r in out.groupBy("shard", "source").count().collect():
        assert abs(r["count"] - share[r.source]) <= len(share) + 1


def test_sharding_edges(spark, empty):
    assert sharding.interleave(empty).count() == 0
    few = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "b", "x")], "doc_id bigint, text string, source string")
    out = sharding.interleave(few).collect()
    assert len({r.shard for r in out}) == 3 and all(r.slot == 0 and r.law == "rows" and r.grown_shard is None for r in out)
    one_each = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("source"))
    n = [r["count"] for r in sharding.interleave(one_each).groupBy("shard").count().collect()]
    assert max(n) - min(n) <= 1


def test_rows_of_one_id_are_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    out = sharding.interleave(df).cache()
    n = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert sum(n) == 6000 and max(n) - min(n) <= 1
    assert out.select("shard", "slot").distinct().count() == 6000 == out.select("rank").distinct().count()


@pytest.mark.parametrize("hot", [0, 100, 7000])
def test_shards_depend_on_the_rows_alone(spark, monkeypatch, hot):
    """With a hot id, and rows repeated very often, the same places for any partitions and sizes of buckets."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 64)
    monkeypatch.setattr(sharding, "COPIES", 50)
    same = F.when(F.col("id") % 2 == 0, "equal").otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
    df = spark.range(9000).select(F.when(F.col("id") < hot, 5).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < hot, same).otherwise("t").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    seen = []
    for parts, rows in ((3, 64), (7, 64), (4, 5000)):
        monkeypatch.setattr(sharding, "BUCKET_ROWS", rows)
        out = sharding.interleave(df.repartition(parts)).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
        seen.append(sorted(map(tuple, out)))
    assert seen[0] == seen[1] == seen[2]
    assert len({(x[3], x[4]) for x in seen[0]}) == 9000


def test_hot_ids_agree_with_the_oracle(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 40).alias("text"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    df.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = c.sql(oracles.ORACLE["op5_sharding"]).df()[["doc_id", "size", "text_crc32", "shard", "slot"]]
    assert sorted(map(tuple, sharding.interleave(got).select("doc_id", "size", "text_crc32", "shard", "slot").collect())) == sorted(map(tuple, want.itertuples(index=False)))


# ---- mixing


def plain_poisson(u, mean):
    k, p = 0, math.exp(-mean)
    c = p
    while c <= u and k < mean + 12 * math.sqrt(mean) + 24 - 1:
        k += 1
        p *= mean / k
        c += p
    return k


def unit(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) / (1 << 52)


def test_mixing(edge, rows, empty):
    out = mixing.mix(edge)
    assert {c.lower() for c in out.columns} == {*(c.lower() for c in edge.columns), "copy_no", "n_copies", "mix_key"} and len(out.columns) == len({c.lower() for c in out.columns})
    n = Counter(r[3] for r in rows)
    total = sum(math.sqrt(v) for v in n.values())
    want = Counter()
    for r in rows:
        rate = len(rows) * math.sqrt(n[r[3]]) / total / n[r[3]]
        k = plain_poisson(unit(mixing.SEED, f"={r[0]}"), rate)
        for c in range(1, k + 1):
            want[r[0], c, k] += 1
    assert Counter((r.doc_id, r.copy_no, r.n_copies) for r in out.collect()) == want
    assert mixing.mix(empty).count() == 0


def test_mixture_reaches_its_weights_in_random_order(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("source"))
    out = mixing.mix(df, weights={"big": 1, "small": 1}).collect()
    share = sum(r.source == "small" for r in out) / len(out)
    assert abs(share - 0.5) < 0.02 and abs(len(out) - 20_000) < 600
    keys = [r.mix_key for r in out]
    assert keys == sorted(keys) and [r.doc_id for r in out] != sorted(r.doc_id for r in out)
    assert {r.source for r in mixing.mix(df, weights={"small": 1}).collect()} == {"small"}


def test_weights_without_a_source(spark, edge):
    for weights in ({"nosuch": 1.0}, {}, {"a": 0.0}):
        assert mixing.mix(edge, weights=weights).count() == 0
    for bad in (-1.0, math.inf, math.nan):
        with pytest.raises(ValueError, match="weight of source a"):
            mixing.mix(edge, weights={"a": bad})
    assert {r.source for r in mixing.mix(edge, weights={None: 1.0, "nosuch": 5.0}).collect()} == {None}


def test_mixing_returns_every_column_as_it_was(spark, edge):
    marked = edge.select("*", F.col("doc_id").alias("own")).toDF(*edge.columns, "own")
    for clash in ("stratum", "rate", "__stratum", "__rate", "ident", "part"):
        assert {r[clash] for r in mixing.mix(marked).collect()} == {"y"}


def test_very_many_sources_are_joined_with_salt(spark, monkeypatch, edge):
    before = sorted((str(r.doc_id), r.copy_no, r.mix_key) for r in mixing.mix(edge).collect())
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", 1)
    assert sorted((str(r.doc_id), r.copy_no, r.mix_key) for r in mixing.mix(edge).collect()) == before


def test_mixing_takes_no_sample_to_find_bounds(edge):
    assert "rangepartitioning" not in plan(mixing.mix(edge)).lower()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 0.999), st.floats(0.01, 60)), min_size=1, max_size=20))
def test_poisson_inverse(spark, pairs):
    df = spark.createDataFrame(pairs, "u double, m double")
    got = [r[0] for r in df.select(mixing.poisson_inverse(F.col("u"), F.col("m"))).collect()]
    assert got == [plain_poisson(u, m) for u, m in pairs]


def far_poisson(u, mean):
    """The smallest k with P(X <= k) > u, summed over the terms themselves, largest means included."""
    k, c = 0, 0.0
    while True:
        c += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        if c > u:
            return k
        k += 1


def test_poisson_inverse_of_large_means(spark):
    pairs = [(u, m) for m in (699.9, 700.1, 774.6, 837.3, 2500.5, 40_000.25) for u in (1e-9, 0.003, 0.25, 0.5, 0.77, 0.9999)]
    got = [r[0] for r in spark.createDataFrame(pairs, "u double, m double").select(mixing.poisson_inverse(F.col("u"), F.col("m"))).collect()]
    assert got == [far_poisson(u, m) for u, m in pairs]


def test_large_draws_have_mean_and_variance_of_their_rate(spark):
    u = mixing.uniform(F.lit("t"), F.col("id").cast("string"))
    r = spark.range(4000, numPartitions=8).select(mixing.poisson_inverse(u, F.lit(5e3)).alias("k")).agg(F.avg("k").alias("m"), F.var_samp("k").alias("v")).first()
    assert abs(r.m - 5e3) < 5 * math.sqrt(5e3 / 4000) and abs(r.v / 5e3 - 1) < 5 * math.sqrt(2 / 4000)


def test_a_rare_source_is_repeated_as_often_as_its_rate_says(spark):
    df = spark.createDataFrame([(1, "a")] + [(i, "b") for i in range(2, 2000)], "doc_id bigint, source string")
    out = mixing.mix(df, weights={"a": 1, "b": 1}).collect()
    want = far_poisson(unit(mixing.SEED, "=1"), 1999 / 2)
    assert sorted(r.copy_no for r in out if r.source == "a") == list(range(1, want + 1))
    assert {r.doc_id: r.n_copies for r in out if r.source == "b"} == {i: k for i in range(2, 2000) if (k := plain_poisson(unit(mixing.SEED, f"={i}"), 1999 / 2 / 1998))}


# ---- SimHash


def plain_fingerprint(text, width=3):
    words = (text or "").translate(LOW).split()
    words = [w for w in "".join(" " if c in WS else c for c in (text or "").translate(LOW)).split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, most=3):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in ids:
        for y in ids:
            if x < y and (fps[x] ^ fps[y]).bit_count() <= most:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_simhash(edge, rows, empty):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_dedup(edge).collect()}
    assert {k for k in got} == {(r[0], f"{plain_fingerprint(r[1]):016x}") for r in rows}
    byfp = defaultdict(lambda: 10**9)
    for r in rows:
        byfp[plain_fingerprint(r[1])] = min(byfp[plain_fingerprint(r[1])], r[0])
    comp = plain_components({i: f for f, i in byfp.items()})
    assert all(c == comp[byfp[int(f, 16)]] for (_, f), c in got.items())
    assert simhash.near_dedup(empty).count() == 0


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(500))
    monkeypatch.setattr(simhash, "COUNT_AT_ONCE", 17)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("full, crowds", [(1 << 14, 100_000), (8, 100_000), (8, 10)])
def test_links_join_all_close_pairs(spark, full, crowds, monkeypatch):
    """Clustered fingerprints; with a small `full` most blocks are split, some of them before any task gets them."""
    monkeypatch.setattr(simhash, "MAX_CROWDS", crowds)
    rng = np.random.default_rng(6)
    fps = set()
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(25):
            x = centre
            for b in rng.integers(0, 64, int(rng.integers(0, 7))):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp bigint")
    found = simhash.links(df, full=full).collect()
    unsigned = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in found]
    assert all((a ^ b).bit_count() <= 3 for a, b in unsigned)
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in unsigned:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    assert {x: find(x) for x in fps} == plain_components({x: x for x in fps})


def test_masks_leave_pairs_together():
    for blocks, n in ((5, 10), (16, 560)):
        masks = simhash.block_masks(blocks, 3)
        assert len(masks) == n
        rng = np.random.default_rng(blocks)
        for _ in range(300):
            d = 0
            for b in rng.integers(0, 64, 3):
                d |= 1 << int(b)
            assert any(d & m == 0 for m in masks)
    for mask in (simhash.block_masks(5, 3)[0], simhash.block_masks(5, 3)[9], (1 << 61) - 1, (1 << 57) - 1):
        finer = simhash.finer_masks(mask, 6, 3)
        assert len(finer) <= 20 and all(m & mask == mask for m in finer)
        rest = [i for i in range(64) if not mask >> i & 1]
        for _ in range(200):
            d = sum(1 << i for i in {int(x) for x in rng.choice(rest, 3)})
            assert len(rest) <= 3 or any(d & m == 0 for m in finer)


def test_a_run_is_full_by_its_different_fingerprints():
    import pyarrow as pa

    def batch(fps):
        return pa.RecordBatch.from_pydict({"mask": pa.array([3] * len(fps), pa.int64()), "key": pa.array([0] * len(fps), pa.int64()), "fp": pa.array(fps, pa.int64())})

    runs = list(simhash._runs(iter([batch([4, 8, 4]), batch([8, 4, 12])]), 3))
    assert [(mask, over, sorted(set(fps.tolist()))) for mask, over, fps in runs] == [(3, False, [4, 8, 12])]
    parts = list(simhash._runs(iter([batch([4, 8, 4]), batch([8, 4, 12])]), 2))
    assert all(over for _, over, _ in parts) and sorted({x for _, _, fps in parts for x in fps.tolist()}) == [4, 8, 12]


def test_a_crowded_block_is_split_and_not_copied_often(spark):
    """6,000 fingerprints that agree on 40 bits: split blocks hold few rows, and all links are found."""
    df = spark.range(6000).select((F.col("id") * 2_731 % (1 << 24)).alias("fp")).distinct()
    fps = [r.fp for r in df.collect()]
    found = simhash.links(df, full=512).collect()
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for r in found:
        assert (r.a ^ r.b).bit_count() <= 3
        root[find(r.a)] = find(r.b)
    x = np.array(fps, np.uint64)
    want = {v: v for v in fps}
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= 3) + i + 1:
            assert find(fps[i]) == find(fps[j])
    assert len(want) == len(fps)


def test_salted_join_keeps_every_row(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("m"))
    out = common.salted_join(rows, facts, ["k"], "n", "v", hot_rows=100)
    assert out.count() == 20_000 and out.where("k = 0").count() == 10_000


# ---- pipeline and registration


def plain_language_model(rows):
    """Feature counts of the labelled rows that aren't held out, by one loop."""
    sums = {}
    for i, text, lang, *_ in rows:
        if text is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            at, n, _ = language_id.trigram_counts(text)
            sums.setdefault(lang, np.zeros(1 << language_id.FEATURE_BITS))[at] += n
    return language_id.Model(sorted(sums), np.stack([sums[x] for x in sorted(sums)]))


def test_pipeline_stages_ignore_other_columns_and_take_empty_tables(spark, edge, empty):
    import corpus_pipeline as cp

    for _, stage in cp.STAGES:
        assert stage(spark, empty, "").count() == 0
        more, plain = stage(spark, edge, ""), stage(spark, edge.select(*cp.COLUMNS), "")
        assert more.columns == plain.columns
        assert sorted(map(str, more.collect())) == sorted(map(str, plain.collect()))


def test_pipeline(spark, tmp_path, rows, edge):
    import corpus_pipeline as cp

    docs = edge.select(*cp.COLUMNS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "source_mixing", "byte_bpe"]
    seen = []
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, now, str(tmp_path))
        assert i == len(cp.STAGES) - 1 or out.columns == cp.COLUMNS
        out.write.parquet(str(tmp_path / f"s{i}"))
        now = spark.read.parquet(str(tmp_path / f"s{i}"))
        seen.append(now.collect())
    model = plain_language_model(rows)
    told = Counter()
    for r in rows:
        lang, score, _ = model.predict(r[1])
        told[r[0], r[1], lang] += lang != "und" and score >= cp.LEAST_SCORE
    assert Counter((r.doc_id, r.text, r.lang) for r in seen[0]) == +told and 0 < len(seen[0]) < len(rows)
    want = {(i, d) for i, *_, d in plain_line_dedup([(r.doc_id, r.text) for r in seen[0]])}
    assert {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in seen[1]} == want
    fps = {r.doc_id: plain_fingerprint(r.text) for r in seen[1]}
    assert {r.doc_id for r in seen[2]} == {i for i, c in plain_components(fps).items() if i == c}
    assert {r.doc_id for r in seen[3]} <= {r.doc_id for r in seen[2]} and len(seen[4]) == len(seen[3])
    whole = cp.run(spark, str(tmp_path))
    assert sorted(map(str, whole.select("doc_id", "ids_sha256").collect())) == sorted(str(r) for r in now.select("doc_id", "ids_sha256").collect())


def test_pipeline_passes_lettered_texts_of_an_unlabelled_corpus(spark, tmp_path, rows, edge):
    import corpus_pipeline as cp

    letters = Counter(r[0] for r in rows if any(c.isalpha() for c in r[1] or ""))
    for lang in (F.lit(None).cast("string"), F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "en")):  # no label; labels on held-out ids only
        docs = edge.withColumn("lang", lang).select(*cp.COLUMNS)
        out = cp.known_language(spark, docs, "")
        assert out.columns == cp.COLUMNS and Counter(r.doc_id for r in out.collect()) == letters
    edge.withColumn("lang", F.lit(None).cast("string")).select(*cp.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() > 0


def test_pipeline_keeps_one_row_of_each_group_of_near_copies(spark):
    import corpus_pipeline as cp

    a, b, c, d = (" ".join(f"{x}{i * i % 97}" for i in range(60)) for x in "abcd")
    fps = [plain_fingerprint(t) for t in (a, b, c, d)]
    assert all((x ^ y).bit_count() > 3 for i, x in enumerate(fps) for y in fps[:i])
    given = [(None, a)] * 3 + [(None, b)] * 2 + [(7, c)] * 3 + [(9, c), (None, c)] + [(7, d), (3, d), (8, d)]  # id 7 is in two groups
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in given], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)
    out = cp.drop_near_copies(spark, docs, "")
    assert out.columns == cp.COLUMNS
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(None, a), (None, b), (7, c), (3, d)])


def test_each_operator_has_one_query():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
