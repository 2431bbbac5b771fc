import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_helpers import frame, prose, words_of
from pyspark.sql import functions as F

from wrenchlake.llm import jaccard
from wrenchlake.llm.components import components


def brute(rows, size, p, q):
    """Component of every row by comparing all pairs that share a shingle."""
    sets, firsts = [], defaultdict(list)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (_, text) in enumerate(rows):
        w = words_of(text)
        own = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
        sets.append(own)
        common = Counter(j for s in own for j in firsts[s])
        for s in own:
            firsts[s].append(k)
        for j, n in common.items():
            if q * n >= p * (len(own) + len(sets[j]) - n):
                a, b = root(k), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if sets[k] and doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return sorted(
        (repr(i), len(sets[k]), repr(least.get(root(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows)
    )


def got(df):
    return sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in df.collect())


def varied(seed, families=25, copies=8):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = prose(rng, rng.choice([3, 6, 9, 20, 45, 110, 400])).split(" ")
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = prose(rng, 1)
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, p, q", [(4, 85, 100), (5, 80, 100), (2, 50, 100)])
def test_against_all_pairs(spark, size, p, q):
    rows = varied(size)
    assert got(jaccard.near_duplicates(frame(spark, rows), size, (p, q))) == brute(rows, size, p, q)


def test_awkward_rows(messy, messy_rows, empty):
    assert got(jaccard.near_duplicates(messy, 4, (85, 100))) == brute(messy_rows, 4, 85, 100)
    assert jaccard.near_duplicates(empty).count() == 0
    assert jaccard.first_of_each(empty).count() == 0


def test_a_chain_of_similar_texts_is_one_component(spark):
    rng = random.Random(11)
    w, rows = prose(rng, 400).split(" "), []
    for k in range(40):
        rows.append((100 - k, " ".join(w)))
        w[10 * k % 400] = f"changed{k}"
    assert got(jaccard.near_duplicates(frame(spark, rows))) == brute(rows, 5, 80, 100)


def test_large_bucket_is_passed_on(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET_ROWS", 3)
    rows = varied(9, 6, 30)
    assert got(jaccard.near_duplicates(frame(spark, rows))) == brute(rows, 5, 80, 100)


def template_family(n, fields=30, seed=21):
    """Texts of one template below the threshold: a shared half, and fields of which neighbours share some."""
    rng = random.Random(seed)
    shared = prose(rng, 60).split(" ")
    base = [prose(rng, 1) + str(k) for k in range(fields)]
    rows = []
    for k in range(n):
        own = [b if rng.random() < 0.8 else f"{b}x{rng.randrange(4)}" for b in base]
        rows.append((k, " ".join(shared + own)))
    return rows


@pytest.mark.parametrize("block", [1_024, 16])
def test_a_template_family_below_the_threshold(spark, monkeypatch, block):
    """Members of many components in shared buckets are compared in blocks; links between any of them are found."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "LISTED", 3)
    rows = template_family(300)
    found = brute(rows, 4, 85, 100)
    assert 20 < len({r[2] for r in found}) < 300
    assert got(jaccard.near_duplicates(frame(spark, rows), 4, (85, 100))) == found


def test_thousands_from_one_template_make_no_pairs(spark):
    """None of 3,000 is similar to another; what passes a task is far less than the pairs of the group."""
    rng = random.Random(5)
    shared = prose(rng, 50)
    rows = [(k, shared + " " + prose(rng, 12)) for k in range(3000)]
    made = jaccard.near_duplicates(frame(spark, rows).repartition(4), 4, (85, 100))
    assert made.filter("component_id != doc_id").count() == 0


def test_blocks_meet_as_all_pairs_do():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 120).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.permutation(base)[: 120 - d], rng.integers(0, 2**63, d).astype(np.uint64)])) for d in rng.integers(0, 14, 60)]
    sketch = [jaccard.parity_sketch(s).view(np.uint64) for s in sets]
    side = {"member": np.arange(60), "component": rng.integers(0, 20, 60), "n": np.array([len(s) for s in sets]), "sketch": sketch,
            "listed": [np.unique(rng.integers(0, 9, 3)) for _ in range(60)]}
    got_pairs = {(x, y) for a, b in jaccard._met(side, side, True, 5, 85, 100) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    want = set()
    for x in range(60):
        for y in range(x + 1, 60):
            apart = int(np.bitwise_count(sketch[x] ^ sketch[y]).sum())
            n = len(sets[x]) + len(sets[y])
            below = [b for b in np.intersect1d(side["listed"][x], side["listed"][y]) if b < 5]
            if side["component"][x] != side["component"][y] and apart * 185 <= n * 15 and min(len(sets[x]), len(sets[y])) * 100 >= max(len(sets[x]), len(sets[y])) * 85 and not below:
                want.add((x, y))
    assert got_pairs == want and want


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    bands = jaccard.Bands(85, 100)
    for n in (1, 2, 5, 7, 30, 400, 1030, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        d = int(np.floor(len(a) * 0.08))
        b = np.unique(np.concatenate([a[d:], rng.integers(0, 2**63, d).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        x, y = jaccard.parity_sketch(a), jaccard.parity_sketch(b)
        while len(x) != len(y):  # halves of the longer one on each other
            x, y = sorted((x, y), key=len)
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
        assert 64 * len(jaccard.parity_sketch(a)) >= len(a)
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= apart
        if len(a) and len(np.intersect1d(a, b)) * 100 >= 85 * len(np.union1d(a, b)):
            top = max(bands.of(len(a)), bands.of(len(b)))
            assert abs(bands.of(len(a)) - bands.of(len(b))) <= 1 and apart <= bands.difference(top)
            assert np.intersect1d(jaccard.segment_keys(a, top, bands), jaccard.segment_keys(b, top, bands)).size


def test_first_of_each(spark, messy, messy_rows):
    kept = jaccard.first_of_each(messy, 4, (85, 100))
    assert kept.columns == messy.columns
    rows = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    blank = [(i, t) for i, t in messy_rows if not words_of(t)]
    assert all(rows[row] == blank.count(row) for row in blank)
    groups = jaccard.near_duplicates(messy, 4, (85, 100)).select("component_set").dropna().distinct().count()
    assert sum(rows.values()) == len(blank) + groups
    assert rows[6, messy_rows[6][1]] == 1 and not rows[7, messy_rows[7][1]]


def test_the_row_that_stays_is_the_same_in_every_run(spark):
    rng = random.Random(2)
    text = prose(rng, 50)
    rows = [(1, text), (1, re.sub("[a-z]", lambda m: m.group().upper(), text)), (1, text.replace(" ", "  ")), (None, text), (2, ""), (2, ""), (3, prose(rng, 30)), (3, "x")]
    seen = set()
    for parts in (1, 2, 5):
        docs = frame(spark, rows).repartition(parts).withColumn("_key", F.lit(1)).withColumn("_set_id", F.lit(2)).withColumn("M", F.create_map(F.lit(1), F.lit(2)))
        kept = jaccard.first_of_each(docs, 4, (85, 100))
        assert kept.columns == docs.columns
        seen.add(tuple(sorted((repr(r["doc_id"]), r["text"], r["_key"], r["_set_id"]) for r in kept.collect())))
    assert len(seen) == 1 and len(seen.pop()) == 5


def test_equal_rows_leave_one(spark):
    rows = [(1, "one two three four five six")] * 3 + [(4, "")] * 2
    assert sorted(tuple(r) for r in jaccard.first_of_each(frame(spark, rows)).select("doc_id", "text").collect()) == [(1, rows[0][1]), (4, ""), (4, "")]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), 300).collect()}
    assert found == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long"), 0).count() == 0
