"""A flat graph index over unit vectors in one task: greedy search, robust pruning, range search. Numpy only."""

from __future__ import annotations

import numpy as np

#: Out-edges of a node, the beam of a search while building, and by how much farther a pruned neighbour may be.
DEGREE, BUILD_BEAM, ALPHA = 32, 48, 1.2
#: Queries that are searched side by side, and beam entries of each that are expanded in one step.
TOGETHER, STEP = 256, 4


def _packed(rows: np.ndarray, values: np.ndarray, n: int, fill) -> np.ndarray:
    """Values by row, rows ascending, as a matrix of n rows padded with `fill`."""
    size = np.bincount(rows, minlength=n)
    out = np.full((n, max(1, size.max(initial=0))), fill, values.dtype)
    out[rows, np.arange(len(rows)) - (np.cumsum(size) - size)[rows]] = values
    return out


class Search:
    """Greedy searches of a block of queries through one graph, from a start node and, for queries that are nodes, from their own."""

    def __init__(self, vectors: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, own: np.ndarray | None = None):
        self.x, self.graph, self.q, self.own = vectors, graph, queries, own
        self.seen = np.zeros((len(queries), len(vectors)), bool)
        self.seen[:, start] = True
        self.start = start
        self.least: np.ndarray | None = None
        self.passed: list[tuple[np.ndarray, np.ndarray]] = []

    def _expand(self, rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, node, cosine) of the neighbours that their queries haven't seen; rows ascending."""
        near = self.graph[nodes]
        row = np.broadcast_to(rows[:, None], near.shape)
        new = near >= 0
        row, near = row[new], near[new]
        new = ~self.seen[row, near]
        code = np.unique(row[new].astype(np.int64) * len(self.x) + near[new])
        row, near = code // len(self.x), code % len(self.x)
        self.seen[row, near] = True
        cos = np.einsum("ij,ij->i", self.q[row], self.x[near])
        if self.least is not None:
            hit = cos >= self.least[row]
            self.passed.append((row[hit], near[hit]))
        return row, near, cos

    def beam(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, cosines) of the best nodes of each query, -1 where there are fewer, and (rows, nodes) of all that were expanded."""
        n = len(self.q)
        ids, cos, done = np.full((n, size), -1), np.full((n, size), -np.inf, np.float32), np.zeros((n, size), bool)
        ids[:, 0], cos[:, 0] = self.start, self.q @ self.x[self.start]
        if self.own is not None:
            row = np.flatnonzero(self.own != self.start)
            ids[row, 1], cos[row, 1], self.seen[row, self.own[row]] = self.own[row], 1, True
        walked: list[np.ndarray] = []
        while True:
            open_ = np.where(done, -np.inf, cos)
            pick = np.argpartition(-open_, min(STEP, size) - 1, axis=1)[:, :STEP] if size > STEP else np.tile(np.arange(size), (n, 1))
            row, slot = np.nonzero(np.take_along_axis(open_, pick, axis=1) > -np.inf)
            if not len(row):
                break
            slot = pick[row, slot]
            done[row, slot] = True
            walked.append(np.stack([row, ids[row, slot]]))
            r, node, c = self._expand(row, ids[row, slot])
            if not len(r):
                continue
            more, more_cos = _packed(r, node, n, -1), _packed(r, c.astype(np.float32), n, np.float32(-np.inf))
            ids, cos, done = np.concatenate([ids, more], axis=1), np.concatenate([cos, more_cos], axis=1), np.concatenate([done, np.zeros(more.shape, bool)], axis=1)
            best = np.argpartition(-cos, size - 1, axis=1)[:, :size]
            ids, cos, done = (np.take_along_axis(a, best, axis=1) for a in (ids, cos, done))
        rows, nodes = np.concatenate(walked, axis=1)
        order = np.argsort(rows, kind="stable")
        return ids, cos, rows[order], nodes[order]

    def within(self, least: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, nodes) with a cosine of `least` (by row) or more: those that the beam came by, and what can be reached from them through such nodes."""
        self.least = least
        first = np.flatnonzero(self.q @ self.x[self.start] >= least)
        self.passed = [(first, np.full(len(first), self.start))]
        self.beam(size)
        found = [tuple(np.concatenate(x) for x in zip(*self.passed))]
        while len(found[-1][0]):
            self.passed = []
            self._expand(*found[-1])
            found.append(self.passed[0])
        return tuple(np.concatenate(x) for x in zip(*found))


def prune(vectors: np.ndarray, base: np.ndarray, near: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """The out-edges of each base node from its candidates: nearest first, without those that a chosen one is nearer to by alpha.

    near: (n, c) ids, -1 for none.
    """
    v = vectors[near]
    far = 2 - 2 * np.einsum("ncd,nd->nc", v, vectors[base])
    far[(near < 0) | (near == base[:, None])] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    far, near, v = np.take_along_axis(far, order, axis=1), np.take_along_axis(near, order, axis=1), np.take_along_axis(v, order[:, :, None], axis=1)
    between = 2 - 2 * np.matmul(v, v.transpose(0, 2, 1))
    alive, out, n = far < np.inf, np.full((len(base), degree), -1), np.zeros(len(base), np.int64)
    for i in range(near.shape[1]):
        take = np.flatnonzero(alive[:, i] & (n < degree))
        if not len(take):
            continue
        out[take, n[take]] = near[take, i]
        n[take] += 1
        alive[take] &= alpha * alpha * between[take, i] > far[take]
    return out


def both_ways(graph: np.ndarray, degree: int = 2 * DEGREE) -> np.ndarray:
    """The graph with its edges' other directions, at most `degree` of those a node."""
    n = len(graph)
    at, slot = np.nonzero(graph >= 0)
    to = graph[at, slot]
    order = np.argsort(to, kind="stable")
    return np.concatenate([graph, _packed(to[order], at[order], n, -1)[:, :degree]], axis=1)


def medoid(vectors: np.ndarray) -> int:
    """The place of the vector nearest to the mean."""
    return int(np.argmax(vectors @ vectors.mean(axis=0)))


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 1) -> np.ndarray:
    """(n, degree) out-edges, -1 for none: nodes are inserted in growing batches, searched from the medoid, pruned and linked back."""
    n = len(vectors)
    start = medoid(vectors)
    graph = np.full((n, degree), -1)
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != start]
    at, size = 0, 1
    while at < len(order):
        batch = order[at : at + size]
        _, _, rows, nodes = Search(vectors, graph, start, vectors[batch]).beam(beam)
        graph[batch] = prune(vectors, batch, _packed(rows, nodes, len(batch), -1), degree)
        _link_back(vectors, graph, batch, degree)
        at += len(batch)
        size = min(2 * size, TOGETHER)
    return graph


def _link_back(vectors: np.ndarray, graph: np.ndarray, batch: np.ndarray, degree: int) -> None:
    """Adds the batch's edges the other way round; nodes with too many are pruned."""
    to = graph[batch]
    at, slot = np.nonzero(to >= 0)
    target, source = to[at, slot], batch[at]
    cos = np.einsum("ij,ij->i", vectors[target], vectors[source])
    order = np.lexsort((-cos, target))
    target, source = target[order], source[order]
    own, row = np.unique(target, return_inverse=True)
    new = _packed(row, source, len(own), -1)[:, : 2 * degree]
    new[(new[:, :, None] == graph[own][:, None, :]).any(axis=2)] = -1
    both = np.concatenate([graph[own], new], axis=1)
    few = (both >= 0).sum(axis=1) <= degree
    packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
    graph[own[few]] = packed[few, :degree]
    for s in range(0, int((~few).sum()), 512):
        part = np.flatnonzero(~few)[s : s + 512]
        graph[own[part]] = prune(vectors, own[part], both[part], degree)
