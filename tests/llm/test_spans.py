import random
import re
from collections import defaultdict

import numpy as np
from conftest_helpers import frame, prose, words_of
from pyspark.sql import functions as F

from wrenchlake.llm import spans


def plain_sentences(text):
    """(first character, words) of each sentence, without cutting long ones."""
    out, new = [], True
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if new:
            out.append((m.start(), []))
        out[-1][1].append(words_of(m.group())[0])
        after = re.match(r"[\x20\x09-\x0D]*", text[m.end() :]).group()
        tail = m.group()
        for _ in range(2):
            if len(tail) > 1 and tail[-1] in "\"')]}":
                tail = tail[:-1]
        new = tail[-1] in ".!?" or "\n" in after
    return out


def brute(rows, run, least):
    """Kept text of each row, for texts without long sentences."""
    seen, covered = defaultdict(list), defaultdict(set)
    for i, text in sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0)):
        cut = plain_sentences(text)
        for a in range(len(cut)):
            b = a + run
            while b <= len(cut) and sum(len(w) for _, w in cut[a:b]) < least:
                b += 1
            if b <= len(cut):
                seen[tuple(w for _, s in cut[a:b] for w in s)].append((i, text, a, b))
    for found in seen.values():
        for i, text, a, b in found[1:]:
            covered[i, text].update(range(a, b))
    out = []
    for i, t in rows:
        text = t or ""
        cut, gone = plain_sentences(text), covered[i, text]
        if not gone:
            out.append((repr(i), t, len(cut), 0))
            continue
        ends = [c[0] for c in cut[1:]] + [len(text)]
        out.append((repr(i), "".join(text[c[0] : e] for k, (c, e) in enumerate(zip(cut, ends, strict=True)) if k not in gone).rstrip(), len(cut), len(gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((repr(r["doc_id"]), r["text"], r["_sentences"], r["_removed"]) for r in df.collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(8)
    passages = [prose(rng, 60) for _ in range(5)] + ["Short. Lines. Here.\nAnd (more). \"Quoted.\" End!"]
    rows = []
    for k in range(120):
        parts = [prose(rng, rng.randint(0, 80)) + ". " for _ in range(3)]
        if k % 3:
            parts.insert(rng.randint(0, 3), rng.choice(passages).rstrip(" .!\n") + ".\n")
        rows.append((200 - k, "".join(parts)))
    rows += [(500, rows[4][1]), (3, rows[4][1])]
    done = got(spans.remove_repeated(frame(spark, rows).repartition(7), 3, 12))
    assert done == brute(rows, 3, 12)
    assert sum(r[3] for r in done) > 100


def test_passage_inside_a_sentence_and_without_marks(spark):
    """A passage of over 50 words goes from the later document, but for a few words at its ends."""
    rng = random.Random(12)
    def plain(n):
        return re.sub(r"[.!\n]+", "", prose(rng, n))

    for passage in (plain(60), prose(rng, 60)):
        rows = [(k, f"{plain(30)} {passage} {plain(30)} and {prose(rng, 50)}") for k in range(4)]
        kept = {r["doc_id"]: r["text"] for r in spans.remove_repeated(frame(spark, rows)).collect()}
        assert kept[0] == rows[0][1]
        for k in (1, 2, 3):
            lost = len(words_of(rows[k][1])) - len(words_of(kept[k]))
            assert 20 <= lost <= 64


def test_clean_documents_stay(spark):
    rng = random.Random(13)
    rows = [(k, prose(rng, rng.randint(1, 200))) for k in range(300)]
    assert {r["doc_id"]: r["text"] for r in spans.remove_repeated(frame(spark, rows)).collect()} == dict(rows)


def test_awkward_rows(messy, messy_rows, empty):
    done = spans.remove_repeated(messy)
    assert done.columns == [*messy.columns, "_sentences", "_removed"]
    rows = done.collect()
    assert len(rows) == len(messy_rows)
    base = messy_rows[6][1]
    assert [r["text"] for r in rows if r["doc_id"] == 6] == [base, base]  # a repeated row is one document
    assert [r["text"] for r in rows if r["doc_id"] == 7] == [""]
    assert [r["text"] for r in rows if r["doc_id"] == 0] == [None]
    assert spans.remove_repeated(empty).count() == 0


def test_every_fifty_words_inside_sentences_go(spark):
    """Of a passage that begins and ends inside a sentence at least 31 of 50 words go, with marks and without."""
    for marks in (True, False):
        rng = random.Random(14)

        def words(n):
            made = [f"w{rng.randrange(5000)}" for _ in range(n)]
            k = rng.randint(5, 25)
            while marks and k < n - 5:
                made[k] += "."
                k += rng.randint(5, 25)
            return " ".join(made)

        rows, sizes = [], {}
        for k in range(1000):
            sizes[k] = rng.randint(50, 60)
            passage = words(sizes[k])
            rows += [(2 * k + j, f"{words(rng.randint(30, 90))} {passage} {words(rng.randint(30, 90))}") for j in (0, 1)]
        kept = {r["doc_id"]: r["text"] for r in spans.remove_repeated(frame(spark, rows)).collect()}
        for k, size in sizes.items():
            first, second = rows[2 * k][1], rows[2 * k + 1][1]
            assert kept[2 * k] == first
            assert 31 <= len(second.split()) - len(kept[2 * k + 1].split()) <= size


def test_internal_names_are_free(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, 40)) for k in range(3)]
    rows += [(9, rows[0][1])]
    docs = frame(spark, rows)
    plain = spans.remove_repeated(docs)
    for name in ("_doc", "_content", "_gone", "_cut", "_sentences", "_removed"):
        docs = docs.withColumn(name, F.lit(name))
    done = spans.remove_repeated(docs)
    assert done.columns[:-2] == docs.columns
    texts_of = lambda df: sorted((r["doc_id"], r["text"], r[-2], r[-1]) for r in df.collect())
    assert texts_of(done) == texts_of(plain) and {r["_cut"] for r in done.select("_cut").collect()} == {"_cut"}


def plain_anchors(hashes):
    """Words that are the least of some REACH consecutive ones, of equal ones the last; all by comparing."""
    out, reach = set(), spans.REACH
    for at in range(len(hashes) - reach + 1):
        window = hashes[at : at + reach]
        out.add(at + max(k for k, h in enumerate(window) if h == min(window)))
    return sorted(out)


def test_anchored_runs_word_by_word():
    """Runs of WINDOW words begin at the anchors, stay in their row and are equal where their words are."""
    rng = np.random.default_rng(12)
    counts = np.array([0, 200, 19, 33, 0, 120, 31, 50])
    hashes = rng.integers(0, 90, int(counts.sum())).astype(np.uint64)
    passage = rng.integers(0, 2**63, 60).astype(np.uint64)
    hashes[40:100], hashes[270:330] = passage, passage
    anchors, at = [], 0
    for n in counts.tolist():
        anchors += [at + k for k in plain_anchors(hashes[at : at + n].tolist())]
        at += n
    assert spans.anchors(hashes, counts).tolist() == anchors
    starts, stops = np.cumsum(counts) - counts, np.cumsum(counts)
    row = np.repeat(np.arange(len(counts)), counts)
    found, begin, size, rows = spans.runs(hashes, counts, starts[counts > 0], (counts > 0).astype(int), 10**6, 12)
    assert begin.tolist() == [a for a in anchors if a + spans.WINDOW <= stops[row[a]]] and set(size.tolist()) == {spans.WINDOW}
    assert rows.tolist() == row[begin].tolist()
    words = {}
    for span, a in zip(found.tolist(), begin.tolist(), strict=True):
        words.setdefault(span, set()).add(tuple(hashes[a : a + spans.WINDOW].tolist()))
    assert all(len(x) == 1 for x in words.values())
    both = [a for a in begin.tolist() if 40 <= a and a + spans.WINDOW <= 100]
    assert both and {a + 230 for a in both} <= set(begin.tolist())
