import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_helpers import frame, prose

from wrenchlake.llm import lexical

ITEMS = "item_id string, text string, doc_id long, n long, terms string, key long, score double"


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, best=10):
    bags = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n_docs, length = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in set(terms_of(text)) if t in bag
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scored[:best], 1)]
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, "x", 3, 1.5) for i, t in items], ITEMS)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n=160):
    rng = random.Random(seed)
    rows = [(k, prose(rng, rng.choice([1, 4, 20, 60, 200]))) for k in range(n)]
    rows += [(1000 + k, rows[k % 7][1]) for k in range(40)]  # copies: ties
    rng.shuffle(rows)
    return rows, [(f"q{k}", prose(rng, rng.choice([1, 3, 10, 40]))) for k in range(25)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_scores(spark, seed):
    docs, items = corpus(seed)
    assert got(lexical.rank(frame(spark, docs).repartition(5), items_frame(spark, items))) == brute(docs, items)


def test_small_shards_blocks_and_passes(spark, monkeypatch):
    docs, items = corpus(3)
    expected = brute(docs, items)
    monkeypatch.setattr(lexical, "PASS_ITEMS", 8)
    rows, frames = frame(spark, docs).repartition(2), items_frame(spark, items)
    own = []
    for asked in lexical.passes(frames, pass_items=8):
        assert len(asked.items) <= 16
        index = lexical.forward_index(rows, asked.terms)
        found = lexical.search(index, asked, shard_docs=13, shard_postings=300).collect()
        by_item = {}
        for r in found:
            by_item.setdefault(r["item"], []).append((-r["score"], r["doc_id"]))
        for k, pairs in by_item.items():
            own += [(asked.items[k][0], rank, d, -s) for rank, (s, d) in enumerate(sorted(pairs)[:10], 1)]
    assert sorted(own, key=repr) == expected


@pytest.mark.parametrize("block_docs, together", [(1, 1), (4, 50), (64, 10_000)])
def test_blocks_skip_without_loss(block_docs, together):
    """One shard against the scores of all its documents; with clustered texts most blocks are skipped."""
    rng = np.random.default_rng(block_docs)
    topics = [rng.choice(400, 25, replace=False) for _ in range(12)]
    bags = []
    for _ in range(600):
        own = np.unique(rng.choice(topics[rng.integers(12)], 12))
        bags.append((own, rng.integers(1, 1000, len(own))))
    ids = rng.integers(0, 300, 600)
    cuts = np.cumsum([0, *(len(t) for t, _ in bags)])
    shard = lexical.Shard(ids, np.zeros(600, bool), cuts, np.concatenate([t for t, _ in bags]), np.concatenate([c for _, c in bags]))
    weight = rng.integers(0, 50, 400)
    items = [np.unique(rng.choice(topics[k % 12], 8)) for k in range(30)]
    ranking = lexical.Ranking(items, weight, 10)
    shard.search(ranking, block_docs, together)
    for q, own in enumerate(items):
        scores = [sum(int(weight[t]) * int(c) for t, c in zip(*bag, strict=True) if t in own) for bag in bags]
        expected = sorted((-s, False, int(i)) for s, i in zip(scores, ids, strict=True) if s > 0)[:10]
        assert ranking.found[q] == expected
    assert block_docs == 64 or ranking.skipped > ranking.blocks * 0.2  # lists of one block leave nothing to skip


def test_awkward_rows(spark, messy, messy_rows, empty):
    items = [("a", "one two THREE"), ("b", messy_rows[6][1]), ("b", messy_rows[6][1]), ("c", None), ("d", "***"), (None, "one"), ("e", "nowhere to be seen qq"), ("f", "中文字 12")]
    assert got(lexical.rank(messy, items_frame(spark, items))) == brute(messy_rows, items)
    assert got(lexical.rank(empty, items_frame(spark, items))) == []
    assert got(lexical.rank(messy, items_frame(spark, []))) == []
    assert lexical.rank(messy, items_frame(spark, items)).columns == ["item_id", "rank", "doc_id", "score"]
