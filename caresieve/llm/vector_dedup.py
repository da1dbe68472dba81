"""Embedding near-dedup: a robust-pruned flat graph built on overlapping cluster shards, range search, verification."""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.llm import graph_index
from caresieve.llm.common import arrow_map, cut, pick, salted_join, slots
from caresieve.llm.vector_codes import usable
from caresieve.operators.graph import components

LEAST_COSINE = 0.9
#: Clusters are cut until they hold at most SHARD_MOST vectors; parts are planned for SHARD_ROWS, at most FAN at once.
SHARD_ROWS, SHARD_MOST, FAN = 2048, 4096, 64
#: Vectors that a cluster's centres are learned from, in expectation, by hash.
SAMPLE = 2048
#: A vector belongs to its nearest SHARDS clusters, as far as it lies within MARGIN of their border.
SHARDS, MARGIN = 2, 0.2
#: Where so much of an overfull cluster's sample lies within CROWD_ANGLE of one vector, these are one node.
CROWD_ANGLE, CROWD_SHARE, CROWDS = math.radians(8), 0.02, 32
#: Entries of a search's beam.
BEAM = 96
#: Vectors whose links are counted by brute force, and the share of them that must have been found.
AUDIT, LEAST_RECALL = 512, 0.97
#: Bytes of cluster centres that are broadcast at once.
PASS_BYTES = 64 << 20
#: Angles that decide have this much room for rounding; what lies in it is verified vector by vector.
ROUNDING = 1e-7


def _units(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of length 1, in double precision, whatever their size."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from the first k of the (hashed) sample."""
    centres = x[:k].copy()
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, total / np.maximum(size, 1e-9), centres)
    return centres


def _crowds(x: np.ndarray, angle: float) -> np.ndarray:
    """Vectors about which CROWD_SHARE of the sample lies, the fullest first, without those that another one took."""
    near = x @ x.T >= math.cos(angle)
    left, out = np.ones(len(x), bool), []
    while len(out) < CROWDS:
        count = (near & left).sum(axis=1) * left
        i = int(count.argmax())
        if count[i] < max(8, CROWD_SHARE * len(x)):
            break
        out.append(i)
        left &= ~near[i]
    return x[out]


def _fitter(angle: float):
    """A map from the sample of one cluster to its centres and crowds."""

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("cls")
        x = _units(table.column("v"))
        n = table.column("n")[0].as_py()
        k = max(2, min(FAN, -(-n // SHARD_ROWS), len(x)))
        centres, crowds = _centres(x, k), _crowds(x, angle)
        return pa.table({"cell": table.column("cell").slice(0, 1), "centres": pa.array([centres.tobytes()], pa.binary()), "crowds": pa.array([crowds.tobytes()], pa.binary())})

    return fit


def _passes(fits: DataFrame) -> Iterator[dict[int, tuple[bytes, bytes]]]:
    """The fits of a level, PASS_BYTES at a time."""
    held, size = {}, 0
    for r in fits.toLocalIterator():
        held[r.cell] = (bytes(r.centres), bytes(r.crowds))
        size += len(r.centres) + len(r.crowds)
        if size > PASS_BYTES:
            yield held
            held, size = {}, 0
    if held:
        yield held


def _descended(rows: DataFrame, fits: DataFrame, most: int, margin: float, crowd_angle: float = CROWD_ANGLE) -> DataFrame:
    """rows with the clusters of their cells' next level.

    rows hold v, radius, cells and gaps (how far the row lies beyond each cell's
    border), crowd and away. With most = 1 vectors of a crowd get its number and
    leave the cells; with more, each goes to the `most` nearest clusters within the margin.
    """
    names, schema = rows.columns, ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    for found in _passes(fits):
        shared = rows.sparkSession.sparkContext.broadcast(found)

        def run(batches, shared=shared):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, radius = _units(batch.column("v")), batch.column("radius").to_numpy()
                cells, gaps, crowd, away = (batch.column(c).to_pylist() for c in ("cells", "gaps", "crowd", "away"))
                by_cell: dict[int, list[int]] = {}
                for i, own in enumerate(cells):
                    for c in own:
                        if c in shared.value:
                            by_cell.setdefault(c, []).append(i)
                for cell, at in by_cell.items():
                    centres, crowds = (np.frombuffer(b).reshape(-1, x.shape[1]) for b in shared.value[cell])
                    at = np.array(at)
                    if most == 1 and len(crowds):
                        cos = x[at] @ crowds.T
                        best = cos.argmax(axis=1)
                        angle = np.arccos(np.minimum(1, cos[np.arange(len(at)), best]))
                        for i, b, a in zip(at[angle <= crowd_angle].tolist(), best[angle <= crowd_angle].tolist(), angle[angle <= crowd_angle].tolist()):
                            cells[i], gaps[i], crowd[i], away[i] = [], [], cell * CROWDS + b, a
                        at = at[angle > crowd_angle]
                    cos = x[at] @ centres.T
                    best = cos.argmax(axis=1)
                    apart = np.linalg.norm(centres[best][:, None, :] - centres[None], axis=2)
                    beyond = (cos[np.arange(len(at)), best][:, None] - cos) / np.maximum(apart, 1e-12)
                    order = np.argsort(beyond, axis=1, kind="stable")[:, :most]
                    for i, js, b in zip(at.tolist(), order.tolist(), np.take_along_axis(beyond, order, axis=1).tolist()):
                        k = cells[i].index(cell)
                        reach = [(gaps[i][k] + g, cell * FAN + j + 1) for j, g in zip(js, b) if g <= margin + radius[i] or j == js[0]]
                        kept = [(g, c) for m, (g, c) in enumerate(zip(gaps[i], cells[i])) if m != k]
                        gaps[i], cells[i] = (list(z) for z in zip(*sorted([*kept, *reach])))
                if most > 1:
                    gaps, cells = [g[:most] for g in gaps], [c[:most] for c in cells]
                new = {"cells": pa.array(cells, pa.list_(pa.int64())), "gaps": pa.array(gaps, pa.list_(pa.float64())), "crowd": pa.array(crowd, pa.int64()), "away": pa.array(away, pa.float64())}
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names)

        rows = arrow_map(rows, run, schema)
    return rows


def _state(rows: DataFrame) -> DataFrame:
    """rows at the root of the tree of clusters."""
    no = F.lit(None)
    return rows.select("*", F.array(F.lit(0).cast("bigint")).alias("cells"), F.array(F.lit(0.0)).alias("gaps"), no.cast("bigint").alias("crowd"), no.cast("double").alias("away"))


def _tree(classes: DataFrame, crowd_angle: float) -> tuple[list[DataFrame], DataFrame]:
    """The fits of each level of clusters, and classes with their crowd, if they are in one.

    A cluster of over SHARD_MOST vectors is cut by centres learned from a sample of
    it, after its crowds are taken out. Ends when none is left, or when a cut parts
    nothing (more than SHARD_MOST vectors that centres can't tell apart).
    """
    rows, levels, last = cut(_state(classes.withColumn("radius", F.lit(0.0)))), [], None  # written, so that the root isn't a constant to the optimizer
    while True:
        here = rows.where(F.size("cells") > 0).withColumn("cell", F.col("cells")[0])
        full = cut(here.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_MOST))
        now = full.agg(F.sum("n"), F.max("n")).first()
        if now[0] is None or now == last:
            return levels, rows
        last = now
        chosen = F.pmod(F.xxhash64("cls", F.lit(len(levels))), F.lit(1 << 30)) < F.lit(float(SAMPLE << 30)) / F.col("n")
        fits = cut(here.join(full, "cell").where(chosen).select("cell", "n", "cls", "v").groupBy("cell").applyInArrow(_fitter(crowd_angle), "cell bigint, centres binary, crowds binary"))
        levels.append(fits)
        rows = cut(_descended(rows, fits, 1, 0.0, crowd_angle))


def _graph(table: pa.Table) -> pa.Table:
    """The out-edges of one shard's nodes."""
    nodes = table.column("node").to_numpy()
    order = np.argsort(nodes, kind="stable")
    nodes, x = nodes[order], _units(table.column("v"))[order].astype(np.float32)
    graph = graph_index.build(x)
    out = [nodes[g[g >= 0]] for g in graph]
    return pa.table({"node": pa.array(nodes), "out": pa.array(out, pa.list_(pa.int64()))})


def _linked(cos: np.ndarray, radius: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of nodes whether all their vectors are linked, and whether some may be and some not."""
    angle, limit = np.arccos(np.clip(cos, -1, 1)), math.acos(least)
    sure = np.where(radius > 0, angle + radius <= limit - ROUNDING, cos >= least)
    return sure, ~sure & (radius > 0) & (angle - radius <= limit + ROUNDING)


def _searcher(least: float, beam: int):
    """A map from one shard with its part of the united graph to rows (kind, a, b, n): 0 links of a node, 1 joined nodes, 2 pairs to be verified."""
    limit = math.acos(least)

    def search(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        order = np.argsort(nodes, kind="stable")
        table, nodes = table.take(pa.array(order)), nodes[order]
        exact, weight, radius = _units(table.column("v")), table.column("weight").to_numpy(), table.column("radius").to_numpy()
        x, n, leaf = exact.astype(np.float32), len(nodes), table.column("leaf")[0].as_py()
        out = table.column("out").combine_chunks()
        row, to = np.repeat(np.arange(n), np.diff(out.offsets.to_numpy())), out.flatten().to_numpy()
        at = np.minimum(np.searchsorted(nodes, to), n - 1)
        here = nodes[at] == to
        graph = graph_index.both_ways(graph_index._packed(row[here], at[here], n, -1))
        start = graph_index.medoid(x)
        # a pair of two shards is counted in the first one that both are in
        others = table.column("cells").to_pylist()
        earlier = sorted({c for own in others for c in own if c < leaf})
        place = {c: i for i, c in enumerate(earlier)}
        member = np.zeros((n, len(earlier)), bool)
        for i, own in enumerate(others):
            for c in own:
                if c < leaf:
                    member[i, place[c]] = True

        pairs = []
        for s in range(0, n, graph_index.TOGETHER):
            own = np.arange(s, min(n, s + graph_index.TOGETHER))
            bound = np.cos(np.minimum(math.pi, limit + radius[own] + radius.max())) - 1e-5
            r, c = graph_index.Search(x, graph, start, x[own], own).within(bound.astype(np.float32), beam)
            a, b = np.minimum(own[r], c), np.maximum(own[r], c)
            pairs.append(np.unique((a * n + b)[a < b]))
        codes = np.unique(np.concatenate(pairs))
        links, joined, unsure = np.zeros(n, np.int64), np.arange(n), []
        for s in range(0, len(codes), 1 << 18):
            a, b = codes[s : s + (1 << 18)] // n, codes[s : s + (1 << 18)] % n
            if len(earlier):
                first = ~(member[a] & member[b]).any(axis=1)
                a, b = a[first], b[first]
            sure, perhaps = _linked(np.einsum("ij,ij->i", exact[a], exact[b]), radius[a] + radius[b], least)
            unsure.append(np.stack([a[perhaps], b[perhaps]]))
            a, b = a[sure], b[sure]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            joined = _joined(joined, a, b)
        far = np.flatnonzero(joined != np.arange(n))
        a, b = np.concatenate(unsure, axis=1) if unsure else (far[:0], far[:0])
        kind = np.repeat([0, 1, 2], [n, len(far), len(a)])
        left = nodes[np.concatenate([np.arange(n), far, a])]
        right = nodes[np.concatenate([np.arange(n), joined[far], b])]
        return pa.table({"kind": pa.array(kind, pa.int32()), "a": pa.array(left), "b": pa.array(right), "n": pa.array(np.concatenate([links, np.zeros(len(far) + len(a), np.int64)]))})

    return search


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each place reaches, when the links (a, b) are added to those that gave root."""
    while len(a):
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            break
        new = root.copy()
        np.minimum.at(new, high, low)
        while (new != new[new]).any():
            new = new[new]
        root = new
    return root


def _cosine(a: Column, b: Column) -> Column:
    """The cosine of two double arrays, scaled so that no square leaves the range."""

    def unit(v: Column) -> Column:
        top = F.array_max(F.transform(v, F.abs))
        return F.transform(v, lambda x: x / top)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    a, b = unit(a), unit(b)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _class_links(classes: DataFrame, shards: int, beam: int, least: float) -> DataFrame:
    """classes (cls, h1, h2, least, weight) with n_links and component_id."""
    # vectors of a crowd lie within twice its angle of each other: all are linked
    levels, placed = _tree(classes.select("cls", "least", "weight", "v"), min(CROWD_ANGLE, math.acos(least) / 2 - 2 * ROUNDING))
    members = cut(placed.select("cls", "least", "weight", "v", F.coalesce(-1 - F.col("crowd"), F.col("cls")).alias("node"), F.coalesce("away", F.lit(0.0)).alias("away")))
    total = F.sum("weight").alias("weight")
    nodes = members.groupBy("node").agg(F.min("least").alias("least"), total, F.max("away").alias("radius"), F.min_by("v", "away").alias("v"), F.count(F.lit(1)).alias("n_members"))
    # the vector in the middle lies at no angle, but for rounding
    nodes = cut(nodes.withColumn("radius", F.when(F.col("n_members") > 1, F.col("radius") + 2 * ROUNDING).otherwise(0.0)))

    spread = _state(nodes)
    for fits in levels:
        spread = _descended(spread, fits, shards, MARGIN)
    spread = cut(spread.select("node", "weight", "radius", "v", F.array_sort("cells").alias("cells")))
    parts = 4 * slots(spread)
    in_shards = spread.select("node", "v", F.explode("cells").alias("leaf")).repartition(parts, "leaf")
    edges = in_shards.groupBy("leaf").applyInArrow(_graph, "node bigint, out array<bigint>")
    united = cut(edges.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("out"))).alias("out")))  # DEGREE edges a shard of the node
    whole = spread.join(united, "node").select("*", F.explode("cells").alias("leaf")).repartition(parts, "leaf")
    found = cut(whole.groupBy("leaf").applyInArrow(_searcher(least, beam), "kind int, a bigint, b bigint, n bigint"))

    links = found.where("kind = 0").groupBy("a").agg(F.sum("n").alias("n"))
    joined = found.where("kind = 1").select("a", "b")
    unsure = found.where("kind = 2").select("a", "b")
    extra = None
    if not unsure.isEmpty():
        left, right = (members.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "cls", "weight", "v")]) for s in "ab")
        met = unsure.join(left, unsure["a"] == F.col("node_a")).join(right, unsure["b"] == F.col("node_b")).where(_cosine(F.col("v_a"), F.col("v_b")) >= least)
        extra = cut(met.select("a", "b", F.explode(F.array(F.struct(F.col("cls_a").alias("cls"), F.col("weight_b").alias("n")), F.struct(F.col("cls_b").alias("cls"), F.col("weight_a").alias("n")))).alias("x")).groupBy("a", "b", "x.cls").agg(F.sum("x.n").alias("n")))
        joined = joined.unionByName(extra.select("a", "b").distinct())
        extra = extra.groupBy("cls").agg(F.sum("n").alias("extra"))
    roots = components(joined)
    rooted = nodes.join(roots.withColumnRenamed("node", "linked"), nodes["node"] == F.col("linked"), "left").join(links.withColumnRenamed("a", "counted"), nodes["node"] == F.col("counted"), "left")
    rooted = cut(rooted.select("node", "least", "n_members", F.coalesce("root", "node").alias("root"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("links")))
    groups = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n_nodes")))
    named = cut(salted_join(rooted, groups, ["root"], "n_nodes", "node").select("node", "n_members", "links", "component_id"))
    out = salted_join(members.select("cls", "node"), named, ["node"], "n_members", "cls")
    if extra is not None:
        out = out.join(extra, "cls", "left").withColumn("links", F.col("links") + F.coalesce("extra", F.lit(0)))
    return cut(out.select("cls", "links", "component_id"))


def recall(classes: DataFrame, found: DataFrame, least: float = LEAST_COSINE, audit: int = AUDIT) -> float:
    """The share of the links of `audit` hashed vectors that were found; each of these is compared with all vectors, in blocks."""
    chosen = classes.orderBy(F.xxhash64("cls", F.lit(3)), "cls").limit(audit).select("cls", "v")
    asked = chosen.join(found.select("cls", "links"), "cls").collect()  # at most `audit` rows
    shared = classes.sparkSession.sparkContext.broadcast(_units(pa.array([r.v for r in asked])).tobytes())

    def count(batches):
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _units(batch.column("v"))
                total += (np.frombuffer(shared.value).reshape(len(asked), -1) @ x.T >= least) @ batch.column("weight").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(asked))), pa.array(total)], ["at", "n"])

    exact = {r["at"]: r.n - 1 for r in arrow_map(classes.select("v", "weight"), count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    want = sum(exact.values())
    return sum(min(r.links, exact[i]) for i, r in enumerate(asked)) / want if want else 1.0


def near_dedup(vectors: DataFrame, least: float = LEAST_COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors are linked at a cosine of `least` or more, in double precision; n_links
    counts the other rows linked to a row, component_id is the smallest id that links
    reach, itself included, and the row of that id is kept. Vectors that are null, empty or
    zero, or hold a null or non-finite component, link with nothing. Equal vectors are
    one node, so are crowds of a small angle, of which all are linked; only pairs of a
    crowd at the edge of the limit are compared one by one. All other vectors must
    have one length, else an error is raised. A null id counts as a row and is a
    component's id only where it has no other. Repeated rows are linked like
    others; an empty table gives no rows; other columns aren't read.

    Found links are verified, so none is wrong; the index may miss some. Its recall is
    measured on AUDIT vectors against all rows; under LEAST_RECALL it is built again
    with more overlap and a wider beam, twice at most, and a warning tells what is left.
    """
    rows = pick(vectors, vec_id=id_col, v=vector_col)
    good = usable(F.col("v")) & (F.size("v") > 0) & F.exists("v", lambda x: x != 0)
    v = F.when(good, F.col("v").cast("array<double>"))
    rows = cut(rows.select("vec_id", v.alias("v"), F.when(good, F.xxhash64(v)).alias("h1"), F.when(good, F.xxhash64(F.lit(7), v)).alias("h2")))
    shortest, longest = rows.where("v is not null").agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} components can't be compared")
    lone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    classes = rows.where("v is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v"))
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()))
    if classes.isEmpty():
        return lone.withColumn("kept", F.lit(True))
    shards, beam = SHARDS, BEAM
    for attempt in range(3):
        found = _class_links(classes, shards, beam, least)
        reached = recall(classes, found, least)
        if reached >= LEAST_RECALL:
            break
        shards, beam = shards * 2, beam * 2
    else:
        warnings.warn(f"the graph index found {reached:.3f} of the audited links", stacklevel=2)
    facts = cut(classes.select("cls", "h1", "h2", "weight").join(found, "cls").drop("cls"))
    out = salted_join(rows.where("v is not null").select("vec_id", "h1", "h2"), facts, ["h1", "h2"], "weight", "vec_id")
    out = out.select("vec_id", F.col("links").alias("n_links"), "component_id").unionByName(lone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
