"""Embedding near-dedup against all pairs."""

import math

import numpy as np
from pyspark.sql import functions as F

from nodecast.llm import vectors
from nodecast.llm.queries import QUERIES
from tests.llm.test_simhash import plain_components


def plain(ids, x, least=0.9):
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    close = x @ x.T >= least
    np.fill_diagonal(close, False)
    links = dict(zip(ids, close.sum(axis=1).tolist()))
    edges = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(close)))]
    return links, plain_components(edges, ids)


def compare(found, links, groups):
    """Recall of links and share of rows with the right component."""
    recall = sum(r.n_links for r in found) / max(1, sum(links.values()))
    assert all(r.n_links <= links[r.vec_id] for r in found)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    return recall, sum(r.component_id == groups[r.vec_id] for r in found) / len(found)


def test_recall_on_given_vectors_and_noisy_copies(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    links, groups = plain([r.vec_id for r in rows], x)
    found = QUERIES["op6_embedding_near_dedup"](spark, folder).collect()
    assert len(found) == len(rows)
    assert compare(found, links, groups)[0] == (1 if sum(links.values()) else 0)
    rnd = np.random.default_rng(2)
    near = x[rnd.integers(0, 60, 300)]
    x = np.concatenate([x, near + 0.03 * rnd.normal(size=near.shape)])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    recall, right = compare(vectors.near_duplicates(frame, 0.9).collect(), *plain(list(range(len(x))), x))
    assert recall >= 0.97 and right >= 0.98


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MEMBERS", 32)
    monkeypatch.setattr(vectors, "CELL", 16)
    monkeypatch.setattr(vectors, "PRODUCT", 200)
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, 16))
    x[100:220] = x[100] + 0.05 * rnd.normal(size=(120, 16))
    x[220:260] = x[220] + 0.12 * rnd.normal(size=(40, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = vectors.near_duplicates(frame, 0.9).collect()
    recall, right = compare(found, *plain(list(range(400)), x))
    assert recall >= 0.95 and right >= 0.97


def test_odd_vectors(spark):
    good = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, good), (2, [2.0, 4.0, 6.0, 8.0]), (2, [2.0, 4.0, 6.0, 8.0]), (3, None), (4, [0.0] * 4), (5, [1.0, None, 3.0, 4.0]),
            (6, [math.nan] * 4), (7, [math.inf, 1.0, 1.0, 1.0]), (8, [1.0]), (9, []), (None, good), (10, [1e300, 2e300, 3e300, 4e300]),
            (11, [-1.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    found = sorted(map(tuple, vectors.near_duplicates(frame, 0.9).collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)]
    assert found == sorted(
        [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (10, 4, 1, False), (None, 4, 1, False), *alone], key=str
    )
    assert vectors.near_duplicates(frame.limit(0), 0.9).collect() == []


def test_one_id_with_two_vectors_and_rows_without_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 0.1]), (None, [-1.0, 0.0]), (None, [-1.0, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(tuple, vectors.near_duplicates(frame, 0.9).collect()), key=str)
    assert found == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (None, 1, None, False), (None, 1, None, False)], key=str)


def test_recall_of_a_large_table_with_a_hot_third_and_small_groups(spark):
    """Through the index, against all pairs in blocks."""
    n, rnd = 24_000, np.random.default_rng(9)
    x = hot_vectors(n, rnd)
    x[n // 3 + 3000 : n // 3 + 6000] = vectors.made_pairs(scaled(x[n // 3 : n // 3 + 3000]), 0.93, each=1)[1]
    x = x.astype(np.float32)
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in vectors.near_duplicates(frame, 0.9).collect()}
    own = scaled(x.astype(float))
    links = np.concatenate([(own[i : i + 2000] @ own.T >= 0.9).sum(axis=1) - 1 for i in range(0, n, 2000)])
    got = np.array([found[i].n_links for i in range(n)])
    small = np.arange(n) >= n // 3
    assert (got <= links).all()
    assert got[~small].sum() >= 0.97 * links[~small].sum() and got[small].sum() >= 0.97 * links[small].sum()


def test_visits_are_in_order():
    left, right = np.array([3.0, 1.0, 2.0]), np.array([0.5, 4.0])
    sums = [left[a] + right[b] for a, b in vectors.visits(left, right, 10)]
    assert sums == sorted(sums) and len(sums) == 6


def test_forest_keeps_components():
    rnd = np.random.default_rng(1)
    close = rnd.random((40, 30)) < 0.03
    rows, columns = vectors.forest(close)
    edges = [(("r", int(a)), ("c", int(b))) for a, b in zip(*np.nonzero(close))]
    nodes = sorted({n for e in edges for n in e}, reverse=True)
    order = {n: i for i, n in enumerate(sorted(nodes, key=lambda n: (n[0] == "c", n[1])))}
    wanted = plain_components([(order[a], order[b]) for a, b in edges], range(len(order)))
    names = {i: n for n, i in order.items()}
    for (kind, at), i in order.items():
        assert (rows if kind == "r" else columns)[at] == names[wanted[i]][1]


def hot_vectors(n, rnd, width=64):
    """A third are near copies of one vector, at cosines of 0.95 and more to it."""
    x = rnd.normal(size=(n, width))
    hot, noise = n // 3, rnd.normal(size=(n // 3, width))
    noise -= np.outer(noise @ x[0], x[0]) / (x[0] @ x[0])
    cosine = rnd.uniform(0.95, 0.995, hot)[:, None]
    length = np.sqrt((noise * noise).sum(axis=1, keepdims=True))
    x[:hot] = cosine * x[0] / np.sqrt(x[0] @ x[0]) + np.sqrt(1 - cosine**2) * noise / length
    return x


def test_hot_group_of_near_copies_is_found_whole(spark):
    n = 20_000
    x = hot_vectors(n, np.random.default_rng(5))
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    found = vectors.near_duplicates(frame, 0.9).collect()
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    links = dict(enumerate(np.concatenate([(unit[i : i + 2000] @ unit.T >= 0.9).sum(axis=1) - 1 for i in range(0, n, 2000)])))
    assert compare(found, links, {r.vec_id: r.component_id for r in found})[0] >= 0.97
    assert all(r.component_id == 0 for r in found if r.vec_id < n // 3)


def visits_find(grid, x, y):
    """Share of the pairs of which either visits the cell of the other."""
    reach = lambda a, b: (grid.visited(a) == grid.cell_of(b)[:, None]).any(axis=1)
    return (reach(x, y) | reach(y, x)).mean()


def scaled(x):
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def test_index_finds_a_hot_group():
    rnd = np.random.default_rng(6)
    sample = scaled(hot_vectors(6000, rnd))
    grid = vectors.Grid(sample, 1024, 0.9)
    a, b = rnd.integers(0, 2000, (2, 500))
    true = (sample[a] * sample[b]).sum(axis=1) >= 0.9
    assert visits_find(grid, sample[a[true]], sample[b[true]]) >= 0.97


def test_index_is_fitted_without_pairs_in_the_sample(spark, monkeypatch):
    """Copies come in twos, of which the sample has one: the index is still fitted for them."""
    rnd = np.random.default_rng(7)
    x = scaled(rnd.normal(size=(6000, 64)))
    y = vectors.made_pairs(x, 0.905, each=1)[1]
    grid = vectors.Grid(x, 128, 0.9)
    fresh = scaled(rnd.normal(size=(300, 64)))
    assert visits_find(grid, fresh, vectors.made_pairs(fresh, 0.905, each=1)[1]) >= 0.97
    monkeypatch.setattr(vectors, "SAMPLE", 256)
    monkeypatch.setattr(vectors, "CELL", 16)
    both = np.concatenate([x[:500], y[:500]])
    frame = spark.createDataFrame(list(enumerate(both.tolist())), "vec_id long, embedding array<double>")
    recall, _ = compare(vectors.near_duplicates(frame, 0.9).collect(), *plain(list(range(1000)), both))
    assert recall >= 0.97
