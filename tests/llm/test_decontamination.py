import hashlib
import random
import re

import numpy as np
import pytest
from conftest_helpers import frame, prose

from wrenchlake.llm import decontamination, texts

ITEMS = "item_id string, text string, doc_id long, twin long, n_hit long, items string, length int"
EMPTY = hashlib.sha256(b"").hexdigest()


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, span=10):
    windows = {}
    for item_id, text in items:
        w = words_of(text)
        n = min(span, len(w))
        if item_id is not None and n:
            for k in range(len(w) - n + 1):
                windows.setdefault((n, tuple(w[k : k + n])), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for n in {n for n, _ in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get((n, tuple(w[k : k + n])))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x", 4) for i, t in items], ITEMS)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def planted(seed):
    """Documents with pieces of items of many lengths, also one word short, at many places."""
    rng = random.Random(seed)
    items = [(f"i{k}", prose(rng, rng.choice([1, 2, 3, 4, 5, 7, 9, 10, 11, 14, 25, 60]))) for k in range(60)]
    items += [("same", items[3][1]), ("i5", items[6][1]), ("shared", items[10][1] + " " + items[11][1])]
    docs = []
    for k in range(250):
        w = words_of(prose(rng, rng.choice([0, 5, 40, 200])))
        for _ in range(rng.randint(0, 3)):
            own = words_of(rng.choice(items)[1])
            n = rng.randint(1, len(own))
            at, start = rng.randint(0, len(w)), rng.randint(0, len(own) - n)
            w[at:at] = own[start : start + n]
        docs.append((k, rng.choice([" ", "  ", ", "]).join(x.upper() if rng.random() < 0.1 else x for x in w)))
    return docs, items


@pytest.mark.parametrize("seed, span, gram", [(1, 10, 5), (2, 10, 3), (3, 4, 4), (4, 12, 20)])
def test_against_every_window(spark, seed, span, gram):
    docs, items = planted(seed)
    done = decontamination.contamination(frame(spark, docs).repartition(4), items_frame(spark, items), span, gram)
    assert got(done) == brute(docs, items, span)


def test_every_shared_span_shares_a_fingerprint():
    """The guarantee of winnowing: a span keeps its fingerprint whatever surrounds it."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        length = int(rng.integers(1, 14))
        span = rng.integers(0, 4, length).astype(np.uint64)  # few different words: many equal minima
        prints = []
        for _ in range(2):
            before, after = (rng.integers(0, 4, rng.integers(0, 9)).astype(np.uint64) for _ in range(2))
            whole = np.concatenate([before, span, after])
            places, found = decontamination.windows(whole, np.array([len(whole)]), length)
            prints.append(found[places.tolist().index(len(before))])
        assert prints[0] == prints[1]


def test_windows_stay_inside_their_row():
    hashes, counts = texts.mix(np.arange(30, dtype=np.uint64)), np.array([0, 12, 3, 0, 10, 5])
    places, _ = decontamination.windows(hashes, counts, 10)
    assert places.tolist() == [0, 1, 2, 15]


def test_awkward_rows(spark, messy, messy_rows, empty):
    base = messy_rows[6][1]
    items = [("a", base), ("a", "one two three"), (None, base), ("c", None), ("d", "..."), ("e", "中文字 12"), ("f", "a"), ("f", "a")]
    assert got(decontamination.contamination(messy, items_frame(spark, items))) == brute(messy_rows, items)
    assert got(decontamination.contamination(empty, items_frame(spark, items))) == []
    none = got(decontamination.contamination(messy, items_frame(spark, [])))
    assert none == brute(messy_rows, []) and all(r[4] == EMPTY for r in none)
