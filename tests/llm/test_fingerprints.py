import hashlib
import random

import numpy as np
from conftest_helpers import frame, prose
from pyspark.sql import functions as F

from wrenchlake.llm import fingerprints as fp
from wrenchlake.llm import texts


def test_neighbouring_labels_differ():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 5, 5000).astype(np.uint64)
    symbols = symbols[np.append(True, symbols[1:] != symbols[:-1])]
    first = np.array([0, 100, 101, 2000])
    labels = fp._toss(symbols, first)
    differ = labels[1:] != labels[:-1]
    differ[first[1:] - 1] = True
    assert differ.all() and labels.max() <= 2


def test_equal_substrings_share_names_at_any_offset():
    rng = random.Random(5)
    common = prose(rng, 400)
    a, b = fp.name_sets([prose(rng, 33) + common, prose(rng, 7) + "x" + common])
    far = fp.name_sets([prose(rng, 400)])[0]
    assert fp.likeness(a, b) > 0.7 and fp.likeness(a, far) < 0.1


def test_a_text_is_parsed_alike_beside_any_other():
    rng = random.Random(6)
    texts = ["a", "ab", "aaaa", "", "short one", prose(rng, 50), prose(rng, 3000), "=" * 999]
    together = fp.name_sets(texts)
    for text, names in zip(texts, together, strict=True):
        assert (fp.name_sets([text])[0] == names).all()
        assert bool(len(names)) == bool(text)


def test_likeness_is_jaccard_of_small_sets():
    a, b = np.array([1, 2, 3, 4], np.uint32), np.array([3, 4, 5], np.uint32)
    assert fp.likeness(a, b) == 2 / 5
    none = np.zeros(0, np.uint32)
    assert fp.likeness(none, none) == 1 and fp.likeness(a, none) == 0


def test_compare_with_next(spark, messy, messy_rows, empty):
    unique = [(i, t) for i, t in messy_rows if i is not None and i not in (6, 15)]
    rows = {r["doc_id"]: r for r in fp.compare_with_next(frame(spark, unique).repartition(4)).collect()}
    order = sorted(unique, key=lambda r: -r[0])
    assert len(rows) == len(unique)
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        new = fp.edited(text, following)
        r = rows[doc_id]
        own, other, nxt = fp.name_sets([text]), fp.name_sets([new]), fp.name_sets([following])
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == own[0].astype(">u4").tobytes().hex()
        assert r["near_edited"] == fp.likeness(own[0], other[0]) and r["near_next"] == fp.likeness(own[0], nxt[0])
    assert fp.compare_with_next(messy).count() == len(messy_rows)
    assert fp.compare_with_next(empty).count() == 0
    lone = fp.compare_with_next(frame(spark, [(1, "just this text here")])).collect()
    assert len(lone) == 1 and lone[0]["near_next"] == 1.0
    assert {r["doc_id"]: r["fingerprint"] for r in fp.fingerprint(frame(spark, unique)).collect()} == {i: r["fingerprint"] for i, r in rows.items()}


def mixed(x):
    return int(texts.mix(np.array([x % 2**64], np.uint64))[0])


def lowest(a, b):
    """Twice the lowest bit in which a and b differ, plus a's bit there."""
    bit = next(i for i in range(64) if (a ^ b) >> i & 1)
    return 2 * bit + (a >> bit & 1)


def parsed_plainly(symbols, level):
    """One level up, symbol by symbol."""
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    symbols = [s if n == 1 else mixed(s + n * 0xA0761D6478BD642F) for s, n in runs]
    labels = [lowest(s, symbols[i - 1] if i else s ^ (2**64 - 1)) for i, s in enumerate(symbols)]
    for _ in range(3):
        labels = [lowest(x, labels[i - 1] if i else x ^ 1) for i, x in enumerate(labels)]
    for high in (3, 4, 5):
        beside = [labels[max(i - 1, 0) : i] + labels[i + 1 : i + 2] for i in range(len(labels))]
        labels = [min({0, 1, 2} - set(near)) if x == high else x for x, near in zip(labels, beside, strict=True)]
    inner = range(1, len(labels) - 1)
    begins = [0] + [i for i in inner if labels[i - 1] < labels[i] > labels[i + 1]] + [len(labels)]
    phrases = [symbols[a:b] for a, b in zip(begins, begins[1:], strict=False) if a < b]
    return [mixed(sum(s * mixed(i + 1) for i, s in enumerate(phrase)) + level) for phrase in phrases]


def names_plainly(text):
    symbols, found, level = [mixed(ord(c) + 0x9E3779B97F4A7C15) for c in text], {}, 0
    while len(symbols) > 1:
        level += 1
        symbols = parsed_plainly(symbols, level)
        below = max(3 - level, 0)
        for name in symbols:
            found[(name >> 34) * 16**below, below] = (name >> 34) * 4 + below
    if not level:
        return [(mixed(ord(c)) >> 34) * 4 + 2 for c in text]
    return [found[at] for at in sorted(found)][:64]


def test_the_parse_by_hand():
    rng = random.Random(8)
    some = ["a", "ab", "aa", "aab", "abab", "", "aaaa" * 40, "short one", "中文字 👍 x", prose(rng, 12), prose(rng, 60), prose(rng, 900), "ab" * 300]
    some += ["".join(rng.choice("abc") for _ in range(n)) for n in range(2, 40)]
    for text, names in zip(some, fp.name_sets(some), strict=True):
        assert names.tolist() == names_plainly(text), text[:40]


def test_one_more_word_at_any_length():
    """Likeness grows with the length and makes no jump where a text becomes long enough for upper levels."""
    rng = random.Random(9)
    means = []
    for words in (6, 8, 10, 14, 20, 30, 45, 70, 100):
        pairs = [(t, t + " extra") for t in (prose(rng, words) for _ in range(150))]
        a, b = fp.name_sets([x for x, _ in pairs]), fp.name_sets([y for _, y in pairs])
        means.append(sum(map(fp.likeness, a, b)) / len(pairs))
    assert means[0] > 0.55 and means[-1] > 0.8
    assert all(later > earlier - 0.04 for earlier, later in zip(means, means[1:], strict=False)), means


def test_clashing_names_ties_and_repeated_rows(spark):
    rows = [(1, "one text of some words"), (1, "one text of some words"), (1, "another text"), (None, None), (None, "x")]
    plain = frame(spark, rows).repartition(3)
    clash = plain
    for name in ("task", "head_text", "tail_text", "following", "next_task", "names", "fingerprint", "n_chars"):
        clash = clash.withColumn(name, F.lit("theirs"))
    found = [sorted(fp.compare_with_next(x).collect(), key=repr) for x in (plain, clash, plain.coalesce(1))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 5
