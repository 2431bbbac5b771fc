import random
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_helpers import frame, prose

from wrenchlake.llm import texts, toxicity


def corpus(n=2500):
    rng = random.Random(21)
    bad = ["stupid", "clown", "vequda", "worthless"]
    rows, labels = [], []
    for k in range(n):
        words, toxic = prose(rng, rng.randint(20, 120)).split(" "), int(k % 5 == 0)
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = frame(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(toxicity.labelled(docs, marks).filter("doc_id % 3 != 0"))
    scored = {r["doc_id"]: r for r in toxicity.score(docs.drop("score"), model).collect()}
    held = [(toxic, scored[k]["predicted"]) for k, _, toxic in labels if k % 3 == 0]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored.values())


def test_presence_of_ngrams():
    column = pa.array(["Stupid", "", "abc", "stupid stupid"])
    found = list(toxicity._present(*texts.utf8(column)))
    assert len(found[1]) == 0 and len(found[2]) == 0
    assert len(found[0]) == sum(max(6 - n + 1, 0) for n in toxicity.ORDERS)
    assert set(found[0]) <= set(found[3])
    wanted = np.zeros(toxicity.BINS + 1, bool)
    wanted[found[0][:3]] = True
    again = list(toxicity._present(*texts.utf8(column), wanted))
    assert again[0].tolist() == found[0][:3].tolist() and len(again[1]) == 0


def test_awkward_rows(spark, messy, messy_rows, empty):
    rows, labels = corpus(200)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    train = toxicity.labelled(frame(spark, rows + [(5, None), (None, "x")]), marks)
    assert train.count() == 201
    model = toxicity.train(train)
    scored = toxicity.score(messy, model).collect()
    assert len(scored) == len(messy_rows)
    blank = {r["score"] for r in scored if not r["text"]}
    assert blank == {1 / (1 + np.exp(-model.intercept))}
    assert toxicity.score(empty, model).count() == 0
    one_class = toxicity.train(train.filter("y = 0"))
    assert all(r["predicted"] == 0 for r in toxicity.score(messy, one_class).collect())
    assert toxicity.train(train.limit(0)).intercept < 0


def test_long_texts_are_scored_by_their_worst_window(spark):
    rng = np.random.default_rng(4)
    million = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), 1_000_000))
    sizes = [0, 1, 60_000, 131_072, 131_073, 200_001, 1_000_000]
    data, offsets = texts.utf8(pa.array([million[:n] for n in sizes]))
    cut, ends, firsts = toxicity._windows(data, offsets)
    assert np.diff(ends).max() <= 131_072 and firsts[:5].tolist() == [0, 1, 2, 3, 4]
    own = cut[ends[firsts[-1]] :].tobytes().decode()
    stretches = [own[a : a + 131_072] for a in range(0, len(own), 131_072)]
    assert all(x[65_536:] == y[:65_536] for x, y in zip(stretches[:-2], stretches[1:-1], strict=True))
    assert stretches[0] + "".join(x[65_536:] for x in stretches[1:]) == million
    # Every bin weighs a little: length alone must not make a text toxic.
    clean = million.replace(" ", "")
    column = texts.utf8(pa.array([clean]))
    lit = max(len(x) for x in toxicity._present(*toxicity._windows(*column)[:2]))
    whole = len(next(toxicity._present(*column)))
    model = toxicity.Model(np.full(toxicity.BINS, 0.001), -0.001 * (lit + whole) / 2)
    rows = frame(spark, [(1, clean), (2, "short"), (3, None)]).drop("score")
    assert lit < whole and [r["predicted"] for r in toxicity.score(rows, model).collect()] == [0, 0, 0]
    # A bad word late in a long text counts.
    weights = np.zeros(toxicity.BINS)
    weights[next(toxicity._present(*texts.utf8(pa.array(["~{|}~^"]))))] = 1.0
    late = frame(spark, [(1, "a" * 990_000 + "~{|}~^" + "a" * 10_000), (2, "a" * 1_000_000)]).drop("score")
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(late, toxicity.Model(weights, -3.0)).collect()} == {1: 1, 2: 0}


def plain_bins(text):
    """Bins of a text, gram by gram, as the module states them."""
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    out = set()
    for n in toxicity.ORDERS:
        for at in range(len(lowered) - n + 1):
            rolled = 0
            for b in lowered[at : at + n]:
                rolled = (rolled * 0x01000193 + b + 1) & 0xFFFFFFFF
            mixed = ((rolled ^ (rolled >> 15)) * 0x85EBCA6B + (n - 1) * 0x9E37) & 0xFFFFFFFF
            out.add((mixed ^ (mixed >> 13)) & (toxicity.BINS - 1))
    return out


def test_scores_equal_the_stated_formula(spark):
    """Counts, ratios and their errors, and scores, all by plain sets and sums; the fit is a stationary point."""
    rows, labels = corpus(600)
    rows, labels = rows + [(600, ""), (601, "Été BON")], labels + [(600, 1, 0), (601, 1, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(toxicity.labelled(frame(spark, rows).repartition(3), marks))
    bins, y = [plain_bins(text) for _, text in rows], [toxic for _, _, toxic in labels]
    sizes = [y.count(0), y.count(1)]
    counts = [Counter(b for own, t in zip(bins, y, strict=True) if t == c for b in own) for c in (0, 1)]
    scales = {}
    for b in counts[0].keys() | counts[1].keys():
        n = [counts[0][b], counts[1][b]]
        rate = [(n[c] + 1) / (sizes[c] + 2) for c in (0, 1)]
        ratio = np.log(rate[1]) - np.log(rate[0])
        error = np.sqrt((1 - rate[1]) / (n[1] + 1) + (1 - rate[0]) / (n[0] + 1))
        if sum(n) >= toxicity.LEAST_TEXTS and abs(ratio) / error >= toxicity.LEAST_Z:
            scales[b] = ratio
    assert set(np.flatnonzero(model.weights).tolist()) <= scales.keys() and len(scales) > 2
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, rows).drop("score"), model).collect()}
    margins = [model.intercept + sum(model.weights[b] for b in own) for own in bins]
    assert all(abs(scored[k] - 1 / (1 + np.exp(-m))) < 1e-9 for (k, _), m in zip(rows, margins, strict=True))
    wrong = [1 / (1 + np.exp(-m)) - t for m, t in zip(margins, y, strict=True)]
    assert abs(np.mean(wrong)) < 1e-3
    for b, scale in scales.items():
        slope = scale * sum(w for w, own in zip(wrong, bins, strict=True) if b in own) / len(y) + toxicity.RIDGE * model.weights[b] / scale
        assert abs(slope) < 1e-3


def test_fit_finds_the_least_loss(spark):
    rng = np.random.default_rng(3)
    found = [np.sort(rng.choice(40, rng.integers(0, 9), replace=False)).astype("<i4") for _ in range(80)]
    y, scale, by_class = rng.integers(0, 2, 80), rng.normal(size=40), np.array([0.01, 0.02])
    table = spark.createDataFrame([(int(a), b.tobytes()) for a, b in zip(y, found, strict=True)], "y int, found binary").repartition(3)
    coef, bias = toxicity._fit(table, scale, by_class)
    design = np.zeros((80, 40))
    for k, own in enumerate(found):
        design[k, own] = scale[own]
    wrong = by_class[y] * (1 / (1 + np.exp(-(design @ coef + bias))) - y)
    assert np.abs(design.T @ wrong + toxicity.RIDGE * coef).max() < 5e-4 and abs(wrong.sum()) < 5e-4
