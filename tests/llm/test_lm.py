import math
import random
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest_helpers import frame, prose, words_of
from pyspark.sql import functions as F

from wrenchlake.llm import lm


def fold(doc_id):
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def brute(rows, order, mass):
    counts = [Counter() for _ in range(order + 1)]
    starts = Counter()
    for doc_id, text in rows:
        if fold(doc_id) == 1:
            continue
        tokens = [*words_of(text), None]
        padded = ["<s>"] * (order - 1) + tokens
        starts[1] += 1
        for n in range(1, order + 1):
            for k in range(len(tokens)):
                counts[n][tuple(padded[order - 1 + k - n + 1 : order + k])] += 1
    total, types = sum(counts[1].values()), len(counts[1])
    out = []
    for doc_id, text in rows:
        tokens = [*words_of(text), None]
        padded = ["<s>"] * (order - 1) + tokens
        base = score = 0.0
        for k, token in enumerate(tokens):
            p = (counts[1][(token,)] + 0.5) / (total + 0.5 * (types + 1))
            base += math.log10(p)
            for n in range(2, order + 1):
                gram = tuple(padded[order - 1 + k - n + 1 : order + k])
                history = starts[1] if set(gram[:-1]) == {"<s>"} else counts[n - 1][gram[:-1]]
                p = (counts[n][gram] + mass * p) / (history + mass)
            score += math.log10(p)
        known = sum(counts[1][(t,)] > 0 for t in tokens)
        out.append((repr(doc_id), fold(doc_id) == 1, len(tokens), known, total, round(base, 6), round(score, 6)))
    return sorted(out)


def got(df):
    return sorted(
        (repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
        for r in df.collect()
    )


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 1


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_counts(messy, messy_rows, order):
    assert got(lm.score(messy, held(), order, 4.0, block_bytes=40_000)) == brute(messy_rows, order, 4.0)


def test_one_block_equals_many(spark):
    rng = random.Random(17)
    rows = [(k, prose(rng, 80)) for k in range(60)]
    docs = frame(spark, rows)
    assert got(lm.score(docs, held())) == got(lm.score(docs, held(), block_bytes=2_000)) == brute(rows, 2, lm.BACKOFF_MASS)


@pytest.mark.parametrize("order, stretch", [(2, 1), (2, 7), (3, 1), (3, 2), (4, 5), (1, 3)])
def test_stretches_arrive_in_the_state_of_the_whole_text(monkeypatch, order, stretch):
    rng = random.Random(order)
    rows = [(k, " ".join(rng.choices("abcd", k=rng.randrange(30)))) for k in range(40)]
    table = pa.table({"doc_id": [k for k, _ in rows], "text": [t for _, t in rows], "held_out": [fold(k) == 1 for k, _ in rows]})
    asked = lm._questions(table, 0, order, 3)
    answers = pa.concat_tables([lm._answers(asked.filter(pc.and_(pc.equal(asked["n"], n), pc.equal(asked["part"], p)))) for n in range(1, order + 1) for p in range(3)])
    want = brute(rows, order, 2.0)
    monkeypatch.setattr(lm, "STRETCH", stretch)
    types = len({t for k, text in rows if fold(k) != 1 for t in [*words_of(text), None]})
    done = lm._scored(table, answers, order, 3, want[0][4], types, 2.0).to_pylist()
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in done) == want


def test_no_rows(empty, spark):
    assert lm.score(empty, held()).count() == 0
    none = lm.score(frame(spark, [(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {r["train_tokens"] for r in none} == {0} and {r["n_known"] for r in none} == {0}
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in none)


def test_many_equal_rows_are_gathered_and_given_out_again(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(k, prose(rng, 30)) for k in range(40)]
    rows += [(None, rows[0][1])] * 150 + [(None, None)] * 60 + [(7, rows[7][1])] * 90 + [(9, "")] * 2
    monkeypatch.setattr(lm, "_DEAL", 40)
    df = frame(spark, rows).repartition(5)
    wanted = brute(rows, 2, 8.0)
    for hot_bytes in (0, 600, 1 << 30):
        assert got(lm.score(df, held(), 2, 8.0, block_bytes=900, hot_bytes=hot_bytes)) == wanted
    most = lm._gathered(df.withColumn("held_out", F.lit(False)).select("doc_id", "text", "held_out"), 600)
    assert most.agg(F.sum("copies")).first()[0] == len(rows)
    assert most.count() == 40 + 1 + 60 + 2  # the 60 rows without text hold 480 bytes and go singly


def test_clashing_names(spark):
    rows = [(1, "one two one"), (2, "two three"), (3, None)]
    plain = frame(spark, rows)
    clash = plain
    for name in ("key", "copies", "block", "size", "held_out", "n", "from", "copy", "part", "counts"):
        clash = clash.withColumn(name, F.lit("theirs"))
    assert got(lm.score(clash, held())) == got(lm.score(plain, held()))
