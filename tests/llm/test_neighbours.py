import io

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wrenchlake.llm import neighbours


def brute(rows, k):
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q in sorted(set(ids[ids % 20 == 0].tolist())):
        score = (vectors * vectors[ids == q][0]).sum(1)
        other = ids != q
        order = np.lexsort((ids[other], -score[other]))[:k]
        out[q] = list(zip(ids[other][order].tolist(), score[other][order].round(9).tolist(), strict=True))
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], round(r["score"], 9)))
    return out


def table(spark, rows):
    data = [(None if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v], 1, 0.5, 2) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, score double, shard int")


def points(n=1500, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(int(i), centres[i % 12] + 0.6 * rng.normal(size=dim)) for i in range(n)]


def query():
    return F.col("vec_id") % 20 == 0


def test_factor_one_is_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 400)
    rows = points()
    rows += [(10_000 + i, rows[3][1]) for i in range(60)]  # copies of one vector, ties by id
    assert got(neighbours.nearest(table(spark, rows), query(), relax=1.0)) == brute(rows, 20)


def test_recall_of_the_default(spark):
    rows = points(4000, 32, 5)
    found, wanted = got(neighbours.nearest(table(spark, rows), query())), brute(rows, 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 20 * len(wanted)


def on_sphere(n, dim, seed):
    data = np.random.default_rng(seed).normal(size=(n, dim))
    return data / np.sqrt((data**2).sum(1, keepdims=True))


def products(queries, data):
    return lambda q, row: (queries[q] * data[row]).sum(1)


def test_a_tree_finds_the_best_with_factor_one():
    data = on_sphere(4000, 3, 3)
    tree = neighbours.Tree(data)
    found, _ = tree.search(data[:50], 5, 1.0, products(data[:50], data), np.arange(4000))
    want = -np.sort(-(data[:50] @ data.T), axis=1)[:, :5]
    assert np.allclose(found, want)
    assert sorted(tree.order.tolist()) == list(range(4000))


def test_ties_go_to_the_least_ids(spark):
    """399 different vectors with one inner product, as many as one may ask for and more."""
    rng = np.random.default_rng(2)
    side = rng.permutation(399)
    rows = [(0, [1.0, 0.0, 0.0])] + [(int(i) + 1, [0.5, float(k % 20), float(k // 20)]) for k, i in enumerate(side)]
    for relax in (1.0, 2.0):
        assert [i for i, _ in got(neighbours.nearest(table(spark, rows), F.col("vec_id") == 0, relax=relax))[0]] == list(range(1, 21))


def recall(found, wanted):
    return sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted) / sum(map(len, wanted.values()))


def test_lengths_of_all_sorts(spark):
    """One vector a thousand times longer, lognormal lengths, and components too large to be squared."""
    rng = np.random.default_rng(6)
    usual = rng.normal(size=(2000, 24))
    cases = [
        [*usual, 1e3 * rng.normal(size=24)],
        list(on_sphere(2500, 24, 8) * rng.lognormal(0, 0.7, (2500, 1))),
        [*usual[:300], *(usual[300:303] * 1e200), *(usual[303:306] * 1e-200)],
    ]
    for vectors in cases:
        rows = list(enumerate(vectors))
        with np.errstate(over="ignore"):
            wanted = brute(rows, 20)
        found = got(neighbours.nearest(table(spark, rows), query()))
        assert found.keys() == wanted.keys() and all(len(found[q]) == 20 for q in found)
        assert recall(found, wanted) >= 0.9
    exact = got(neighbours.nearest(table(spark, rows), query(), relax=1.0))
    assert {q: [i for i, _ in x] for q, x in exact.items()} == {q: [i for i, _ in x] for q, x in wanted.items()}


def test_queries_far_from_the_vectors(spark):
    """Vectors lie close together and the queries elsewhere, so every distance is long beside the size of the tree."""
    rng = np.random.default_rng(11)
    middle, aside = np.eye(16)[0], np.eye(16)[1]
    rows = [(i, (aside if i % 20 == 0 else middle) + 0.05 * rng.normal(size=16)) for i in range(2000)]
    rows = [(i, v) for i, v in rows if i % 20 or i < 200]
    found, wanted = got(neighbours.nearest(table(spark, rows), query())), brute(rows, 20)
    assert recall(found, wanted) == 1.0


def test_awkward_rows(spark):
    bad = [(20, None), (40, []), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 2.0]), (100, [float("nan"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0])]
    good = [(120, [1.0, 0.0, 0.5]), (121, [1.0, 1.0, 1.0]), (122, [1.0, 1.0, 1.0]), (140, [-1.0, 2.0, 0.0]), (141, [5.0, 1.0])]
    rows = got(neighbours.nearest(table(spark, bad + good + good[:1]), query()))
    same = [r for r in good if len(r[1]) == 3]
    assert rows == brute(same, 20)
    assert neighbours.nearest(table(spark, []), query()).count() == 0
    assert neighbours.nearest(table(spark, bad), query()).count() == 0
    assert neighbours.nearest(table(spark, good[:1]), query()).count() == 0


@pytest.mark.parametrize("n", [1, 127, 128, 129, 300])
def test_small_trees(n):
    data = np.ones((n, 2)) / np.sqrt(2)
    best, rows = neighbours.Tree(data).search(data[:1], min(3, n), 1.0, products(data[:1], data), np.arange(n)[::-1])
    assert rows[0].tolist() == list(range(n))[::-1][: min(3, n)] and np.allclose(best, 1)


def test_queries_are_numbered_alike_in_any_order():
    """A block made anew after a lost executor has its queries at the same places."""
    rng = np.random.default_rng(9)
    ids = [*range(50), 7, 7]  # an id with several vectors
    vectors = [rng.normal(size=4).astype("<f8").tobytes() for _ in ids]
    made = []
    for seed in range(5):
        order = np.random.default_rng(seed).permutation(len(ids))
        block = pa.table({"vec_id": pa.array([ids[k] for k in order]), "vec": pa.array([vectors[k] for k in order])})
        blob = neighbours.pack_queries((pa.scalar(4), pa.scalar(2)), block).column("queries")[0].as_py()
        stored = np.load(io.BytesIO(blob))
        made.append((stored["ids"].tolist(), stored["points"].tolist()))
    assert all(x == made[0] for x in made)
