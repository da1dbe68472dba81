import hashlib
import math

import numpy as np
import pytest

from caresieve.llm import graph_index, vector_codes, vector_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, node string, `a.b` string, code string"


def table(spark, vectors, labels=None, ids=None, parts=5):
    rows = []
    for i, x in enumerate(vectors):
        rows.append((i if ids is None else ids[i], None if x is None else [None if c is None else float(c) for c in x], None if labels is None else labels[i], "y", "y", "y", "y"))
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def crowd(rng, around, n, degrees, width=16):
    """n vectors at about so many degrees from one direction, of different lengths."""
    away = rng.normal(size=(n, width))
    away -= (away @ around)[:, None] * around
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    t = np.radians(degrees)
    return (math.cos(t) * around + math.sin(t) * away) * rng.uniform(0.5, 2, (n, 1))


def brute(vectors, least=0.9):
    """(links, smallest reachable place) of float32 vectors by all pairs."""
    good = [i for i, x in enumerate(vectors) if x is not None and len(x) and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    links, root = [0] * len(vectors), list(range(len(vectors)))
    if not good:
        return links, root
    x = np.array([np.float32(vectors[i]) for i in good], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    place = np.arange(len(good))
    while True:
        new = np.minimum(place, np.where(near, place[None, :], len(good)).min(axis=1, initial=len(good)))
        if (new == place).all():
            break
        place = new
    for k, i in enumerate(good):
        links[i], root[i] = int(near[k].sum()), good[place[k]]
    return links, root


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def wanted(vectors):
    return {i: (n, r, r == i) for i, (n, r) in enumerate(zip(*brute(vectors)))}


def test_links_equal_all_pairs_with_odd_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = list(rng.normal(size=(120, 16)))
    for i in range(0, 40, 2):  # near copies, some of them chains
        vectors.append(vectors[i] * 3 + rng.normal(size=16) * 0.15)
        vectors.append(vectors[-1] + rng.normal(size=16) * 0.9)
    vectors += [vectors[5], vectors[5], 2 * vectors[5], np.zeros(16), None, [], [None] * 16, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15, vectors[7]]
    assert found(vector_dedup.near_dedup(table(spark, vectors))) == wanted(vectors)


def test_crowds_clusters_and_the_edge_of_the_limit(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "SHARD_MOST", 150)
    monkeypatch.setattr(vector_dedup, "SHARD_ROWS", 80)
    rng = np.random.default_rng(8)
    axes = np.linalg.qr(rng.normal(size=(16, 16)))[0]
    at_edge = math.cos(math.acos(0.9)) * axes[0] + math.sin(math.acos(0.9)) * axes[1]  # so many pairs of a crowd are linked to it and many aren't
    vectors = [*crowd(rng, axes[0], 250, 4), *crowd(rng, at_edge, 30, 0.5), *crowd(rng, at_edge, 200, 3), *crowd(rng, axes[5], 40, 9), *rng.normal(size=(230, 16))]
    vectors = [vectors[i] for i in rng.permutation(len(vectors))]
    levels, placed = vector_dedup._tree(spark.createDataFrame([(i, i, 1, [float(c) for c in x]) for i, x in enumerate(vectors)], "cls bigint, least bigint, weight bigint, v array<double>"), vector_dedup.CROWD_ANGLE)
    assert levels and placed.where("crowd is not null").count() > 300  # both crowds are nodes
    got, want = found(vector_dedup.near_dedup(table(spark, vectors))), wanted(vectors)
    assert {i: x[1:] for i, x in got.items()} == {i: x[1:] for i, x in want.items()}
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(x[0] for x in got.values()) >= 0.97 * sum(x[0] for x in want.values())


def test_search_in_one_shard_has_its_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 32))
    x[::3] = x[1::3] + rng.normal(size=x[::3].shape) * 0.25
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = graph_index.both_ways(graph_index.build(x))
    own = np.arange(len(x))
    row, node = graph_index.Search(x, graph, graph_index.medoid(x), x, own).within(np.full(len(x), 0.9, np.float32), 64)
    near = x @ x.T >= 0.9
    hit = np.zeros_like(near)
    hit[row, node] = True
    np.fill_diagonal(near, False)
    np.fill_diagonal(hit, False)
    assert not (hit & ~near).any()
    assert (hit & near).sum() >= 0.97 * near.sum()


def test_a_low_recall_is_answered_with_more_overlap_and_told(spark, monkeypatch):
    tried = []
    whole = vector_dedup._class_links
    monkeypatch.setattr(vector_dedup, "_class_links", lambda c, shards, beam, least: tried.append((shards, beam)) or whole(c, shards, beam, least))
    monkeypatch.setattr(vector_dedup, "LEAST_RECALL", 1.5)
    rng = np.random.default_rng(6)
    vectors = list(rng.normal(size=(30, 16)))
    vectors += [v + rng.normal(size=16) * 0.1 for v in vectors[:10]]
    with pytest.warns(UserWarning, match="found 1.000 of the audited links"):
        assert found(vector_dedup.near_dedup(table(spark, vectors))) == wanted(vectors)
    assert tried == [(vector_dedup.SHARDS << i, vector_dedup.BEAM << i) for i in range(3)]


def test_lengths_that_differ_and_no_rows(spark):
    with pytest.raises(ValueError, match="can't be compared"):
        vector_dedup.near_dedup(table(spark, [[1, 2], [1, 2, 3]]))
    assert vector_dedup.near_dedup(table(spark, [])).count() == 0
    assert found(vector_dedup.near_dedup(table(spark, [None, [0, 0]]))) == {0: (0, 0, True), 1: (0, 1, True)}
    got = vector_dedup.near_dedup(table(spark, [[1, 2], [1, 2], [2, 4]], ids=[3, None, 3])).collect()
    assert sorted((r.vec_id is None, r.n_links, r.component_id, r.kept) for r in got) == [(False, 2, 3, True), (False, 2, 3, True), (True, 2, 3, False)]


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(id, code, error, label error, digest) by full search."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in x], label) for i, x, label in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    width = len(kept[0][1]) // parts
    cut = [[q[p * width : (p + 1) * width] for p in range(parts)] for _, q, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0], kept[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [nearest(c[p], books[p])[1] for c in cut]
            books[p] = [[sum(cut[k][p][d] for k in of) // len(of) for d in range(width)] if (of := [k for k, a in enumerate(at) if a == e]) else books[p][e] for e in range(len(books[p]))]
    out = []
    for (i, _, label), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, c, e, total[label], digest) for i, c, e, label in out)


@pytest.mark.parametrize("n, spread", [(300, 1.0), (70, 0.02), (40, 3.0)])  # many ties; fewer vectors than entries
def test_codes_equal_full_search(spark, n, spread):
    rng = np.random.default_rng(n)
    vectors = [list(x) for x in rng.normal(size=(n, 32)) * spread]
    vectors += [vectors[1], None, [math.nan] * 32, [None] * 32, [-math.inf] * 32, [-spread] * 32]
    labels = [[None, 1, 2, 2, 2][i % 5] for i in range(len(vectors))]
    ids = [(i * 7) % 1000 for i in range(len(vectors))]
    ids[-1] = ids[0]
    got = vector_codes.compress(table(spark, vectors, labels, ids))
    assert sorted(tuple(r) for r in got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()) == plain_codes(list(zip(ids, vectors, labels)))


def test_trees_equal_full_search_and_prune():
    rng = np.random.default_rng(2)
    centre = rng.integers(-4000, 4000, (3, 32, 4))
    points = centre[:, rng.integers(0, 32, 4096)] + rng.integers(-20, 20, (3, 4096, 4))
    weight = (np.arange(4096) < 4000).astype(np.int64)
    for entries in (centre, np.repeat(centre[:, :5], 3, axis=1), centre[:, :1], points[:, :64]):
        codes, sums, counts, compared = vector_codes.assign(points, weight, entries)
        gap = ((points[:, :, None] - entries[:, None]) ** 2).sum(axis=3)
        assert (codes == gap.argmin(axis=2)).all()
        for p in range(3):
            for e in range(entries.shape[1]):
                mine = (codes[p] == e) & (weight == 1)
                assert counts[p, e] == mine.sum() and (sums[p, e] == points[p, mine].sum(axis=0)).all()
    assert vector_codes.assign(points, weight, centre)[3] < 0.2 * 3 * 4000  # clusters go to their entry as a whole


def test_decoded_vectors_lie_within_their_error(spark):
    rng = np.random.default_rng(3)
    vectors = [list(x) for x in rng.normal(size=(200, 32))]
    rows = vector_codes.integers(table(spark, vectors))
    books = vector_codes.train(rows)
    back = {r.vec_id: np.array(r.vector) for r in vector_codes.decode(vector_codes.encode(rows, books), books).collect()}
    error = {r.vec_id: r.error for r in vector_codes.encode(rows, books).collect()}
    for i, x in enumerate(vectors):
        assert np.linalg.norm(np.array(x) - back[i]) <= (math.sqrt(error[i]) + math.sqrt(32)) / 256


def test_codes_refuse_what_they_cannot_cut(spark):
    assert vector_codes.compress(table(spark, [])).count() == 0
    assert vector_codes.compress(table(spark, [None, []])).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(table(spark, [[1.0] * 20]))
    with pytest.raises(ValueError, match="exact sums"):
        vector_codes.compress(table(spark, [[1e9] * 32]))
