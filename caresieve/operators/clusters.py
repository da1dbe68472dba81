"""Clusters of embedding vectors by density (HDBSCAN) and by mode (mean shift), within groups such as volumes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.operators.graph import components, joined
from caresieve.operators.images import adapted_rand
from caresieve.operators.skew import Steps, cut
from caresieve.session import ship

#: Points of a cell: each group has a pivot for so many, and a point belongs to its nearest one.
CELL_POINTS = 1024
NOISE = -1
#: Components of a round that are united on the driver, 16 bytes each.
DRIVER_LINKS = 100_000


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all points of x to all of y."""
    return np.sqrt(np.maximum(0, (x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)[None]))


def _may_reach(gap: np.ndarray, limit: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether fast distances, which are rounded, may be within limits."""
    return gap * gap <= limit * limit * (1 + 1e-8) + 1e-12 * (1 + (x * x).sum(axis=1) + (y * y).sum(axis=1).max())


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of points side by side."""
    return np.sqrt(((x - y) ** 2).sum(axis=1))


class _Cells:
    """Points in cells about pivots, and which other cells may hold something nearer than a bound."""

    def __init__(self, rows: DataFrame):
        spark = ship(rows.sparkSession)
        count = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        # by hash, so a rerun picks the same ones; a pivot for CELL_POINTS rows, which are broadcast: 16 MB for 2 million points of 1,024 x 8 values
        chosen = rows.join(count, "g").where(F.pmod(F.xxhash64("p"), F.lit(1 << 30)) <= F.lit(float(1 << 30)) / F.greatest(F.lit(1.0), F.least(F.lit(float(CELL_POINTS)), F.col("n").cast("double"))))
        least = rows.groupBy("g").agg(F.min_by(F.struct("p", "v"), "p").alias("r")).select("g", "r.*")
        found: dict[str, list] = {}
        for r in chosen.select("g", "p", "v").unionByName(least).distinct().orderBy("g", "p").toLocalIterator():
            found.setdefault(r.g, []).append(r.v)
        self.pivots = spark.sparkContext.broadcast({g: np.array(v) for g, v in found.items()})
        pivots = self.pivots

        def nearest(batches):
            for batch in batches:
                cells, away = [], []
                for g, v in zip(batch.column("g").to_pylist(), batch.column("v")):
                    gap = np.linalg.norm(pivots.value[g] - v.values.to_numpy(zero_copy_only=False), axis=1)
                    cells.append(int(gap.argmin()))
                    away.append(float(gap.min()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("g", "p", "v")), pa.array(cells, pa.int32()), pa.array(away, pa.float64())], ["g", "p", "v", "cell", "away"])

        self.points = cut(rows.select("g", "p", "v").mapInArrow(nearest, "g string, p bigint, v array<double>, cell int, away double"))
        far = {g: np.full(len(v), -np.inf) for g, v in found.items()}
        for r in self.points.groupBy("g", "cell").agg(F.max("away").alias("away")).toLocalIterator():  # a number a pivot
            far[r.g][r.cell] = r.away
        self.reach = spark.sparkContext.broadcast(far)

    def others(self, rows: DataFrame, bound: str, schema: str) -> DataFrame:
        """rows (g, v, cell, bound, ...) once for each other cell whose points may lie within the bound, as `there`.

        A cell is left out if it ends before the bound, or if the plane midway between both pivots, beyond which it lies, is farther.
        """
        pivots, reach, names = self.pivots, self.reach, rows.columns

        def near(x, limit, p, far, cell):
            """(row, cell) of the other cells that may lie within each row's limit."""
            between, out = _exact(p, p[cell][None]), []
            step = max(1, (1 << 22) // p.size)
            for s in range(0, len(x), step):
                square = ((x[s : s + step, None] - p[None]) ** 2).sum(axis=2)
                own = square[:, cell, None]
                room = square - own - 1e-12 * (square + own + far * far + between * between)  # of rounding
                plane = np.where(between > 0, room / np.where(between > 0, 2 * between, 1.0), -np.inf)
                least = np.maximum(np.sqrt(square) - far, plane)
                found = (least <= limit[s : s + step, None] * (1 + 1e-9) + 1e-12) & np.isfinite(far)
                found[:, cell] = False
                at, there = np.nonzero(found)
                out.append((at + s, there))
            return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])

        def run(batches):
            for batch in batches:
                held: dict[tuple, list] = {}
                for i, key in enumerate(zip(batch.column("g").to_pylist(), batch.column("cell").to_pylist())):
                    held.setdefault(key, []).append(i)
                limit = batch.column(bound).to_numpy(zero_copy_only=False)
                for (g, cell), own in held.items():
                    own = np.array(own)
                    at, there = near(_matrix(batch.column("v").take(pa.array(own))), limit[own], pivots.value[g], reach.value[g], cell)
                    out = batch.take(pa.array(own[at]))
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(there, pa.int32())], [*names, "there"])

        return rows.mapInArrow(run, f"{schema}, there int")


def core_distances(cells: _Cells, k: int) -> DataFrame:
    """(g, p, v, cell, core): the distance of each point to its k-th nearest other one of its group; infinite where there are fewer."""

    def own(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("v"))
        nearest = []
        for s in range(0, len(x), 512):
            gap = _gaps(x[s : s + 512], x)
            gap[np.arange(len(gap)), np.arange(s, s + len(gap))] = np.inf
            m = min(k, len(x) - 1)
            part = np.argpartition(gap, m - 1, axis=1)[:, :m] if m else np.zeros((len(gap), 0), int)
            exact = np.sqrt(((x[part] - x[s : s + 512, None]) ** 2).sum(axis=2))
            nearest += np.sort(exact, axis=1).tolist()
        bound = [n[k - 1] if len(n) >= k else np.inf for n in nearest]
        return table.select(["g", "p", "v", "cell"]).append_column("near", pa.array(nearest, pa.list_(pa.float64()))).append_column("bound", pa.array(bound, pa.float64()))

    schema = "g string, p bigint, v array<double>, cell int, near array<double>, bound double"
    first = cut(cells.points.select("g", "p", "v", "cell").groupBy("g", "cell").applyInArrow(own, schema))
    asked = cells.others(first, "bound", schema).select("g", "there", "p", "v", "bound")

    def other(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not len(queries) or not len(points):
            return pa.table({"p": pa.array([], pa.int64()), "near": pa.array([], pa.list_(pa.float64()))})
        x, y, limit, at, out = _matrix(queries.column("v")), _matrix(points.column("v")), queries.column("bound").to_numpy(), [], []
        for s in range(0, len(x), 512):
            gap = _gaps(x[s : s + 512], y)
            hit = np.flatnonzero(_may_reach(gap.min(axis=1), limit[s : s + 512], x[s : s + 512], y))
            m = min(k, len(y))
            part = np.argpartition(gap[hit], m - 1, axis=1)[:, :m]
            at += (hit + s).tolist()
            out += np.sqrt(((y[part] - x[hit + s][:, None]) ** 2).sum(axis=2)).tolist()
        return pa.table({"p": queries.column("p").take(pa.array(at, pa.int64())), "near": pa.array(out, pa.list_(pa.float64()))})

    more = asked.groupBy("g", "there").cogroup(cells.points.withColumnRenamed("cell", "there").groupBy("g", "there")).applyInArrow(other, "p bigint, near array<double>")
    more = more.groupBy("p").agg(F.flatten(F.collect_list("near")).alias("more"))  # k numbers a cell that was asked
    core = F.try_element_at(F.array_sort(F.concat("near", F.coalesce("more", F.array().cast("array<double>")))), F.lit(k))
    return cut(first.join(more, "p", "left").select("g", "p", "v", "cell", F.coalesce(core, F.lit(float("inf"))).alias("core")))


def spanning_edges(cells: _Cells, cores: DataFrame) -> DataFrame:
    """(g, a, b, w): a smallest spanning tree of each group under the mutual reachability, the larger of a pair's distance and both core distances.

    Borůvka's rounds: each component takes its smallest edge to another one; of
    equal ones the smallest pair of points. A point looks into its own cell first, then into those other cells that may hold
    a smaller edge than its component has. The largest component of a group only waits to be met, as most points are soon
    in it. Each round at least halves the others.
    """
    spark, steps = cores.sparkSession, Steps(cores.sparkSession)
    found = None
    now = cores.withColumn("c", F.col("p"))
    schema = "g string, p bigint, v array<double>, cell int, core double, c bigint"

    def best(x, core_x, p_x, c_x, y, core_y, p_y, c_y, limit=None):
        """Each x's smallest edge to a y of another component, d: (w, a, b, d), infinite without one or if it is over the limit for sure."""
        out = []
        for s in range(0, len(x), 512):
            part = slice(s, s + 512)
            gap = np.maximum(np.maximum(_gaps(x[part], y), core_x[part, None]), core_y[None])
            gap[c_x[part, None] == c_y[None]] = np.inf
            least = gap.min(axis=1)
            if limit is not None:
                least[~_may_reach(least, limit[part], x[part], y)] = np.inf
            for i, m in enumerate(least.tolist()):
                if not np.isfinite(m):
                    out.append((np.inf, -1, -1, -1))
                    continue
                near = np.flatnonzero(gap[i] <= m * (1 + 1e-9) + 1e-12)  # the fast distances are rounded
                w = np.maximum(np.maximum(_exact(y[near], x[s + i][None]), core_x[s + i]), core_y[near])
                a, b = np.minimum(p_x[s + i], p_y[near]), np.maximum(p_x[s + i], p_y[near])
                k = np.lexsort((b, a, w))[0]
                out.append((float(w[k]), int(a[k]), int(b[k]), int(c_y[near[k]])))
        return out

    def columns(t: pa.Table):
        return _matrix(t.column("v")), t.column("core").to_numpy(), t.column("p").to_numpy(), t.column("c").to_numpy()

    def named(edges: list) -> dict:
        return {n: pa.array([e[i] for e in edges], t) for i, (n, t) in enumerate((("w", pa.float64()), ("a", pa.int64()), ("b", pa.int64()), ("d", pa.int64())))}

    def own(table: pa.Table) -> pa.Table:
        asking = table.filter(table.column("asks"))
        edges = best(*columns(asking), *columns(table)) if len(asking) else []
        return pa.table({**{c: asking.column(c) for c in ("g", "p", "v", "cell", "core", "c")}, **named(edges)})

    def other(queries: pa.Table, points: pa.Table) -> pa.Table:
        edges = best(*columns(queries), *columns(points), queries.column("bound").to_numpy()) if len(queries) and len(points) else []
        at = [i for i, e in enumerate(edges) if e[0] < np.inf]
        return pa.table({"g": queries.column("g").take(pa.array(at, pa.int64())), "c": queries.column("c").take(pa.array(at, pa.int64())), **named([edges[i] for i in at])})

    try:
        while True:
            largest = now.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("g").agg(F.max(F.struct("n", "c")).alias("l")).select("g", F.col("l.c").alias("waits"))
            asking = now.join(F.broadcast(largest), "g").withColumn("asks", F.col("c") != F.col("waits")).drop("waits")  # a row a group, as the pivots
            inside = steps.keep(asking.groupBy("g", "cell").applyInArrow(own, f"{schema}, w double, a bigint, b bigint, d bigint"))
            known = inside.groupBy("c").agg(F.min("w").alias("bound"))
            # an edge from a point weighs its core distance at least
            asked = cells.others(inside.drop("w", "a", "b", "d").join(known, "c").where("core <= bound").select(*[c.split()[0] for c in schema.split(", ")], "bound"), "bound", f"{schema}, bound double")
            far = asked.select("g", "there", "p", "v", "core", "c", "bound").groupBy("g", "there").cogroup(now.withColumnRenamed("cell", "there").groupBy("g", "there")).applyInArrow(other, "g string, c bigint, w double, a bigint, b bigint, d bigint")
            edges = inside.select("g", "c", "w", "a", "b", "d").unionByName(far).where(F.col("w") < float("inf"))
            least = steps.keep(edges.groupBy("g", "c").agg(F.min(F.struct("w", "a", "b", "d")).alias("e")).select("g", "c", "e.*"))
            n = least.count()
            if not n:
                break
            found = cut((least if found is None else found.unionByName(least.drop("c", "d"))).select("g", "w", "a", "b").distinct())
            now = steps.keep(now.join(_united(least, n), "c", "left").select("g", "p", "v", "cell", "core", F.coalesce("root", "c").alias("c")))
    finally:
        steps.forget()
    return found if found is not None else spark.createDataFrame([], "g string, w double, a bigint, b bigint")


def _united(links: DataFrame, n: int) -> DataFrame:
    """(c, root) of components that links (c, d) join: on the driver up to DRIVER_LINKS of them, else as a graph."""
    if n > DRIVER_LINKS:
        return components(links.select(F.col("c").alias("a"), F.col("d").alias("b"))).withColumnRenamed("node", "c")
    pairs = np.array([(r.c, r.d) for r in links.select("c", "d").collect()], np.int64)
    names, place = np.unique(pairs, return_inverse=True)
    place = place.reshape(pairs.shape)
    root = names[joined(np.arange(len(names)), place[:, 0], place[:, 1])]
    return F.broadcast(links.sparkSession.createDataFrame(pa.table({"c": names, "root": root})))


def condensed(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray, least: int) -> np.ndarray:
    """The label of each of n points from a spanning tree's edges: clusters of `least` points or more by excess of mass, NOISE for the others."""
    inner, height, size, top = [], [], [1] * n, list(range(2 * n))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    # edges of one weight join all at once, so which of several equal spanning trees was found doesn't matter
    order = np.argsort(w, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(w[order]) > 0)) if len(w) else np.zeros(0, int)
    for s, e in zip(starts.tolist(), np.append(starts[1:], len(w)).tolist()):
        met: dict[int, set[int]] = {}
        for k in order[s:e].tolist():
            x, y = find(int(a[k])), find(int(b[k]))
            new = len(size)
            own = met.pop(x, {x}) | met.pop(y, {y})
            top[x] = top[y] = new
            met[new] = own
            size.append(0)
            inner.append([])
            height.append(float(w[order[s]]))
        for node, own in met.items():
            inner[node - n] = sorted(own)
            size[node] = sum(size[i] for i in own)

    label = np.full(n, NOISE)
    if not inner:
        return label
    parent, birth, mass, fell = [-1], [0.0], [0.0], [[]]
    todo = [(len(size) - 1, 0)]

    def under(node: int) -> list[int]:
        out, stack = [], [node]
        while stack:
            i = stack.pop()
            if i < n:
                out.append(i)
            else:
                stack += inner[i - n]
        return out

    while todo:
        node, c = todo.pop()
        if node < n:
            fell[c].append(node)
            continue
        level = 1 / max(height[node - n], 1e-150)
        sides = inner[node - n]
        large = [s for s in sides if size[s] >= least]
        gone = size[node] if len(large) != 1 else size[node] - size[large[0]]
        mass[c] += gone * (level - birth[c])
        for s in sides:
            if len(large) > 1 and size[s] >= least:
                parent.append(c)
                birth.append(level)
                mass.append(0.0)
                fell.append([])
                todo.append((s, len(parent) - 1))
            elif size[s] >= least:
                todo.append((s, c))
            else:
                fell[c] += under(s)
    below, chosen = [0.0] * len(parent), [True] * len(parent)
    for c in range(len(parent) - 1, 0, -1):  # children come after their parents
        if below[c] > mass[c]:
            chosen[c] = False
        below[parent[c]] += max(below[c], mass[c])
    own, names = [NOISE] * len(parent), 0
    for c in range(1, len(parent)):
        if own[parent[c]] != NOISE:
            own[c] = own[parent[c]]
        elif chosen[c]:
            own[c] = names
            names += 1
    for c, points in enumerate(fell):
        label[points] = own[c]
    return label


def density_clusters(df: DataFrame, keys: list[str], id_col: str, vector: str, least: int = 100, samples: int | None = None) -> DataFrame:
    """(keys, id, label) of the rows whose vector is whole: clusters of at least `least` points by density, -1 for noise; labels count from 0 in each group.

    HDBSCAN with Euclidean distance and excess of mass: core distances to the `samples`-th
    other point (`least` by default), a smallest spanning tree of mutual reachability, and from it the clusters that
    last longest; the whole group is no cluster. Cells about pivots leave out what can't be
    near, so there is no table of pairs. The tree's edges of one group, 24 bytes each, meet in one task.
    """
    base = cut(df.select(*keys, F.col(id_col).alias("id"), F.col(vector).alias("v")).where(_whole(F.col("v"))).withColumn("p", F.monotonically_increasing_id()))
    rows = base.select((F.to_json(F.struct(*keys)) if keys else F.lit("")).alias("g"), "p", F.transform("v", lambda x: x.cast("double")).alias("v"))
    cells = _Cells(rows)
    edges = spanning_edges(cells, core_distances(cells, samples or least))

    def label(points: pa.Table, tree: pa.Table) -> pa.Table:
        p = np.sort(points.column("p").to_numpy())
        a, b = (np.searchsorted(p, tree.column(c).to_numpy()) for c in ("a", "b"))
        return pa.table({"p": pa.array(p), "label": pa.array(condensed(len(p), a, b, tree.column("w").to_numpy(), least), pa.int32())})

    found = cells.points.select("g", "p").groupBy("g").cogroup(edges.groupBy("g")).applyInArrow(label, "p bigint, label int")
    return base.join(found, "p").select(*keys, F.col("id").alias(id_col), "label")


def _whole(v: Column) -> Column:
    return v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))), F.lit(False))


#: Coordinates that the cells of mean shift are cut along.
GRID_AXES = 3


def mean_shift(df: DataFrame, keys: list[str], id_col: str, vector: str, bandwidth: float, rounds: int = 300) -> DataFrame:
    """(keys, id, label) of the rows whose vector is whole: clusters by the modes of a flat kernel of radius `bandwidth`.

    Seeds are the middles of the bins, `bandwidth` wide, that hold points. Each moves to the mean of the points
    within the bandwidth until it moves by a thousandth of it at most, or `rounds` are over. Modes
    within the bandwidth of one with more points (of equal ones, of smaller coordinates) are dropped; a point has the
    label of its nearest mode, labels counting from 0 by points. Points and seeds meet
    in cells of the first coordinates, seeds that came together are one, and each round is a
    table in the shared folder. The modes of a group meet in one task and are broadcast.
    """
    base = cut(df.select(*keys, F.col(id_col).alias("id"), F.col(vector).alias("v")).where(_whole(F.col("v"))).withColumn("p", F.monotonically_increasing_id()))
    spark = ship(df.sparkSession)
    group = F.to_json(F.struct(*keys)) if keys else F.lit("")
    points = base.select(group.alias("g"), "p", F.transform("v", lambda x: x.cast("double")).alias("v"))
    width = points.agg(F.max(F.size("v"))).first()[0]
    if not width:
        return base.select(*keys, F.col("id").alias(id_col), F.lit(None).cast("int").alias("label"))
    axes = min(GRID_AXES, width)
    cell = lambda v: F.array(*[F.floor(F.element_at(v, i + 1) / bandwidth) for i in range(axes)])
    placed = cut(points.withColumn("cell", cell("v")))
    shifts = F.array(*[F.array(*[F.lit(s) for s in shift]) for shift in np.array(np.meshgrid(*[[-1, 0, 1]] * axes)).reshape(axes, -1).T.tolist()])

    def partial(seeds: pa.Table, here: pa.Table) -> pa.Table:
        if not len(seeds) or not len(here):
            return pa.table({"s": pa.array([], pa.list_(pa.float64())), "g": pa.array([], pa.string()), "n": pa.array([], pa.int64()), "total": pa.array([], pa.list_(pa.float64()))})
        s, x, n, total = _matrix(seeds.column("s")), _matrix(here.column("v")), [], []
        for i in range(0, len(s), 256):
            near = np.sqrt(((s[i : i + 256, None] - x[None]) ** 2).sum(axis=2)) <= bandwidth
            n += near.sum(axis=1).tolist()
            total += (near.astype(float) @ x).tolist()
        return pa.table({"s": seeds.column("s"), "g": seeds.column("g"), "n": pa.array(n, pa.int64()), "total": pa.array(total, pa.list_(pa.float64()))})

    steps = Steps(spark)
    try:
        bins = F.transform("v", lambda x: F.rint(x / bandwidth) * bandwidth)
        seeds = steps.keep(placed.select("g", bins.alias("s")).distinct())
        ended = None
        for turn in range(rounds + 1):
            asked = seeds.select("g", "s", F.explode(F.transform(shifts, lambda d: F.zip_with(cell("s"), d, lambda a, b: a + b))).alias("cell"))
            sums = asked.groupBy("g", "cell").cogroup(placed.groupBy("g", "cell")).applyInArrow(partial, "s array<double>, g string, n bigint, total array<double>")
            sums = sums.groupBy("g", "s").agg(F.sum("n").alias("n"), *[F.sum(F.element_at("total", i + 1)).alias(f"t{i}") for i in range(width)]).where("n > 0")
            mean = F.array(*[F.col(f"t{i}") / F.col("n") for i in range(width)])
            moved = sums.select("g", "n", mean.alias("m"), F.sqrt(F.aggregate(F.zip_with(mean, "s", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x)).alias("d"))
            moved = steps.keep(moved)
            stays = F.lit(True) if turn == rounds else F.col("d") <= 1e-3 * bandwidth
            done = moved.where(stays).groupBy("g", "m").agg(F.max("n").alias("n"))
            ended = cut(done if ended is None else ended.unionByName(done))
            seeds = steps.keep(moved.where(~stays).select("g", F.col("m").alias("s")).distinct())
            if seeds.isEmpty():
                break
    finally:
        steps.forget()

    def strongest(table: pa.Table) -> pa.Table:
        m, n = _matrix(table.column("m")), table.column("n").to_numpy()
        left = np.lexsort((*m.T[::-1], -n)).tolist()
        kept: list[int] = []
        while left:
            kept.append(left[0])
            left = [i for i in left[1:] if _exact(m[i : i + 1], m[kept[-1] : kept[-1] + 1])[0] > bandwidth]
        return pa.table({"g": table.column("g").take(pa.array(kept)), "label": pa.array(range(len(kept)), pa.int32()), "m": table.column("m").take(pa.array(kept))})

    modes: dict[str, list] = {}
    for r in ended.groupBy("g").applyInArrow(strongest, "g string, label int, m array<double>").orderBy("g", "label").toLocalIterator():
        modes.setdefault(r.g, []).append(r.m)
    shared = spark.sparkContext.broadcast({g: np.array(m) for g, m in modes.items()})

    def nearest(batches):
        for batch in batches:
            label = [int(np.linalg.norm(shared.value[g] - v.values.to_numpy(zero_copy_only=False), axis=1).argmin()) for g, v in zip(batch.column("g").to_pylist(), batch.column("v"))]
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(label, pa.int32())], ["p", "label"])

    return base.join(points.mapInArrow(nearest, "p bigint, label int"), "p").select(*keys, F.col("id").alias(id_col), "label")


def clustered_rand_error(df: DataFrame, keys: list[str], id_col: str, vector: str, truth: str, least: int = 100, samples: int | None = None, bandwidth: float | None = None) -> DataFrame:
    """error, precision and recall of the adapted Rand index: clusters of embeddings against true labels; by mean shift if a bandwidth is given.

    Noise is one more cluster of its group, as is what has no whole vector.
    """
    found = mean_shift(df, keys, id_col, vector, bandwidth) if bandwidth else density_clusters(df, keys, id_col, vector, least, samples)
    own = df.select(*keys, id_col, F.col(truth).alias("t")).join(found, [*keys, id_col], "left")
    # labels of different groups are different segments, as the true ones are
    side = lambda c: F.when(c > 0, F.xxhash64(*keys, c).bitwiseAND(F.lit((1 << 62) - 1)) + 1).otherwise(0)
    return adapted_rand(own.select(side(F.col("t")).alias("t"), side(F.coalesce("label", F.lit(NOISE)) + 2).alias("p")), "t", "p")
