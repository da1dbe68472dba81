"""Clusters by density and by mode against plain versions."""

import numpy as np
import pytest

from caresieve.operators import clusters


def groups():
    rng = np.random.default_rng(0)
    a = np.concatenate([rng.normal(size=(60, 3)) * 0.3, rng.normal(size=(50, 3)) * 0.2 + [3, 0, 0], rng.normal(size=(40, 3)) * 0.5 + [0, 4, 0], rng.uniform(-6, 8, (40, 3))])
    b = np.concatenate([rng.normal(size=(40, 3)), rng.normal(size=(30, 3)) + [8, 0, 0]])
    return {"a": a, "b": b, None: np.zeros((3, 3)), "one": np.ones((1, 3))}


def table(spark):
    rows = [(k, i, v.tolist()) for k, x in groups().items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows + [("a", -1, None), ("a", -2, [1.0, None, 2.0]), ("a", -3, [1.0, float("nan"), 0.0])], "g string, i int, v array<double>").repartition(4)


def labels(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.g, {})[r.i] = r.label
    return {k: np.array([v[i] for i in range(len(v))]) for k, v in out.items()}


def same(x, y):
    """Equal up to the names of labels, -1 apart."""
    pairs = set(zip(x.tolist(), y.tolist()))
    return len(pairs) == len(set(x.tolist())) == len(set(y.tolist())) and all((a == -1) == (b == -1) for a, b in pairs)


def plain_density(x, least, k):
    """HDBSCAN from the full matrix: the clusters of each level of the sorted weights, followed downward."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    core = np.sort(d + np.diag([np.inf] * n), axis=1)[:, k - 1] if n > k else np.full(n, np.inf)
    m = np.maximum(np.maximum(d, core[:, None]), core[None])

    def parts(points, below):
        """Connected parts of points over edges lighter than `below`."""
        out, left = [], set(points)
        while left:
            todo = [left.pop()]
            part = set(todo)
            while todo:
                i = todo.pop()
                new = {j for j in left if m[i, j] < below}
                left -= new
                part |= new
                todo += new
            out.append(part)
        return out

    def heaviest(part):
        """The weight at which a part comes apart: the largest of its smallest spanning tree."""
        own = sorted(part)
        inside, best, top = {own[0]}, {j: m[own[0], j] for j in own[1:]}, 0.0
        while best:
            j = min(best, key=best.get)
            top = max(top, best.pop(j))
            inside.add(j)
            for q in best:
                best[q] = min(best[q], m[j, q])
        return top

    def cluster(part, birth):
        """(mass, clusters) of the best choice within a cluster born at a level, without the cluster itself; and its own mass."""
        own, now = 0.0, part
        while True:
            if len(now) == 1:
                return own, 0.0, []
            w = heaviest(now)
            level = 1 / max(w, 1e-150)
            pieces = parts(now, w)
            large = [p for p in pieces if len(p) >= least]
            own += (len(now) - (len(large[0]) if len(large) == 1 else 0)) * (level - birth)
            if len(large) == 1:
                now = large[0]
                continue
            total, found = 0.0, []
            for p in large:
                mine, below, inner = cluster(p, level)
                total += max(mine, below)
                found += inner if below > mine else [p]
            return own, total, found

    out = np.full(n, -1)
    if n > 1 and np.isfinite(core).all():
        for i, p in enumerate(cluster(set(range(n)), 0.0)[2]):
            out[sorted(p)] = i
    return out


@pytest.mark.parametrize("cell", [30, 1024])
def test_density_clusters_equal_the_full_matrix(spark, monkeypatch, cell):
    monkeypatch.setattr(clusters, "CELL_POINTS", cell)
    got = labels(clusters.density_clusters(table(spark), ["g"], "i", "v", 10, 5))
    for k, x in groups().items():
        assert same(got[k], plain_density(x, 10, 5)), k
    assert len(set(got["a"])) == 4 and len(set(got["b"])) == 2


def test_spanning_edges_weigh_as_much_as_prims(spark, monkeypatch):
    monkeypatch.setattr(clusters, "CELL_POINTS", 15)
    x = groups()["b"]
    df = spark.createDataFrame([("", i, v.tolist()) for i, v in enumerate(x)], "g string, p bigint, v array<double>")
    cells = clusters._Cells(df)
    edges = clusters.spanning_edges(cells, clusters.core_distances(cells, 4)).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    core = np.sort(d + np.diag([np.inf] * len(x)), axis=1)[:, 3]
    m = np.maximum(np.maximum(d, core[:, None]), core[None])
    best, total = {j: m[0, j] for j in range(1, len(x))}, 0.0
    while best:
        j = min(best, key=best.get)
        total += best.pop(j)
        for q in best:
            best[q] = min(best[q], m[j, q])
    assert len(edges) == len(x) - 1 and sum(e.w for e in edges) == pytest.approx(total, rel=1e-12)


def plain_shift(x, bandwidth):
    found = {}
    for s in sorted(set(map(tuple, np.rint(x / bandwidth) * bandwidth))):
        s = np.array(s)
        for _ in range(300):
            near = np.sqrt(((x - s) ** 2).sum(axis=1)) <= bandwidth
            if not near.any():
                s = None
                break
            new = x[near].mean(axis=0)
            d, s = np.linalg.norm(new - s), new
            if d <= 1e-3 * bandwidth:
                break
        if s is not None:
            found[tuple(np.round(s, 9))] = int(near.sum())
    modes = []
    for s, _ in sorted(found.items(), key=lambda kv: (-kv[1], kv[0])):
        if all(np.linalg.norm(np.array(s) - m) > bandwidth for m in modes):
            modes.append(np.array(s))
    return np.array([int(np.argmin([np.linalg.norm(p - m) for m in modes])) for p in x])


def test_mean_shift_equals_a_plain_loop(spark):
    got = labels(clusters.mean_shift(table(spark), ["g"], "i", "v", 1.5))
    for k, x in groups().items():
        assert same(got[k], plain_shift(x, 1.5)), k
    assert set(got[None]) == {0} and got["one"].tolist() == [0]
    assert clusters.mean_shift(table(spark).where("i < 0"), ["g"], "i", "v", 1.0).count() == 0
    assert clusters.density_clusters(table(spark).where("i < 0"), ["g"], "i", "v", 3).count() == 0


def test_rand_error_of_clusters(spark):
    x = groups()["b"]
    df = spark.createDataFrame([("b", i, v.tolist(), 1 + (i >= 40)) for i, v in enumerate(x)] + [("c", i, v.tolist(), 1 + (i >= 40)) for i, v in enumerate(x)], "g string, i int, v array<double>, t int")
    assert clusters.clustered_rand_error(df, ["g"], "i", "v", "t", 10, 5).first().error == pytest.approx(0, abs=1e-9)
    assert clusters.clustered_rand_error(df, ["g"], "i", "v", "t", bandwidth=50.0).first().precision < 0.6


def test_cells_beyond_the_middle_plane_are_not_asked(spark, monkeypatch):
    monkeypatch.setattr(clusters, "CELL_POINTS", 64)
    x, bound = np.random.default_rng(3).uniform(size=(2000, 4)), 0.1
    rows = spark.createDataFrame([("g", i, v.tolist()) for i, v in enumerate(x)], "g string, p bigint, v array<double>")
    cells = clusters._Cells(rows)
    cell = np.array([r.cell for r in cells.points.orderBy("p").collect()])
    asked = cells.others(cells.points.selectExpr("g", "p", "v", "cell", f"{bound}D AS bound"), "bound", "g string, p bigint, v array<double>, cell int, bound double")
    got = {(r.p, r.there) for r in asked.collect()}
    near = np.argwhere(((x[:, None] - x[None]) ** 2).sum(axis=2) <= bound**2)
    needed = {(i, int(cell[j])) for i, j in near.tolist() if cell[i] != cell[j]}
    gap = np.linalg.norm(x[:, None] - cells.pivots.value["g"][None], axis=2)
    reach = np.array([gap[cell == c, c].max() if (cell == c).any() else -np.inf for c in range(gap.shape[1])])
    balls = int((gap - reach <= bound).sum()) - len(x)
    assert needed <= got and len(got) < 0.6 * balls
