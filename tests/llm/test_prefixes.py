import hashlib
import random
import zlib

import pytest

from wrenchlake.llm import prefixes

DDL = "conv_id long, turn int, role string, text string, pos long, depth int, _node string, owner long"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "x", 9) for r in rows], DDL).repartition(3)


def brute(rows, group=100, most=6):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in turns.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = {}
    for c, way in made.items():
        for d in range(len(way) + 1):
            nodes.setdefault(way[:d], []).append(c)
    kids, out = {}, []
    for way in nodes:
        if way:
            kids.setdefault(way[:-1], []).append(way)

    leaves, saved = {}, {}
    for way in sorted(nodes, key=len, reverse=True):
        below = kids.get(way, [])
        leaves[way] = sum(leaves[k] for k in below) if below else 1
        own_chars = len(way[-1][1]) if way else 0
        saved[way] = (len(nodes[way]) - 1) * own_chars + sum(saved[k] for k in below)
    for way, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(made[c]) == len(way))
        out.append((
            min(members), len(way), min(nodes[way[:-1]]) if way else None, len(members), len(kids.get(way, [])), leaves[way], saved[way],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=repr)


def varied(seed, n=150, deepest=14, words=3):
    """Conversations with few different turns, so that prefixes are shared at every depth."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(1, 700), n):
        for turn in range(rng.randint(1, deepest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if words > 1 else "user", rng.choice(["a", "bb", "ccc", "é👍"][:words])))
    return rows


@pytest.mark.parametrize("seed, first, most, words", [(1, 8, 32, 2), (2, 1, 2, 1), (3, 3, 3, 2), (4, 2, 32, 1)])
def test_against_plain_trie(spark, seed, first, most, words):
    rows = varied(seed, words=words)
    assert got(prefixes.nodes(conversations(spark, rows), first_columns=first, most_columns=most)) == brute(rows)


def test_copies_and_long_chains(spark, monkeypatch):
    """Copies of one long conversation are one chain; two that part late share blocks of columns."""
    rng = random.Random(9)
    long = [rng.choice(["x", "yy", "zzz"]) for _ in range(130)]
    rows = [(c, t, "user", text) for c in (100, 200, 300, 307) for t, text in enumerate(long)]
    rows += [(c, t, "user", text) for c in (400, 500) for t, text in enumerate([*long[:90], str(c), *long[:5]])]
    expected = brute(rows)
    assert got(prefixes.nodes(conversations(spark, rows))) == expected
    monkeypatch.setattr(prefixes, "SLICE_TURNS", 16)
    turns = prefixes.numbered_turns(conversations(spark, rows), slice_turns=16)
    assert sorted(r["pos"] for r in turns.filter("conv_id = 100").collect()) == list(range(1, 131))


def test_awkward_rows(spark):
    rows = [
        (None, 1, "user", "nobody"), (1, None, None, None), (1, 3, "user", "b"), (1, 3, "user", "b"), (1, 3, None, "a"), (2, 0, "user", ""),
        (3, 5, "u", "ser"), (4, 5, "us", "er"), (100, 0, "user", "head"), (100, 1, "user", "next"), (101, 0, "user", "x"), (102, 9, "user", "only"),
        (-7, 0, "user", "below"), (-107, 1, "user", "below"), (5, 2**31 - 1, "user", "late"), (5, -3, "user", "early"),
    ]
    assert got(prefixes.nodes(conversations(spark, rows))) == brute(rows)
    assert got(prefixes.nodes(conversations(spark, rows[:1]))) == []
    assert got(prefixes.nodes(conversations(spark, []))) == []
    single = [(102, 9, "user", "only")]
    assert got(prefixes.nodes(conversations(spark, single))) == brute(single)
