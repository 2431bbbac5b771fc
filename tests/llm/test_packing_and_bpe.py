import base64
import hashlib
import json
import pathlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from wrenchlake.llm import bpe, packing, words

FILE, RANKS = str(P.path("byte_bpe_50k.json")), str(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(3)
    alphabet = ["a", "b", "  ", "\n", "\t", "é", "中文", "'s", "'ll", "12", " ", "\x85", "\x1c", "😀", "!!", "²", "<|endoftext|>", "aaa", "\r\n", "٣"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)] + ["a" * 3000, "=" * 3000, "", "ab" * 900]


def test_word_ids_equal_the_tokenizers(tokenizer, reference):
    texts = odd_texts()
    assert words.tokenizer_ids(FILE, P.PATTERN)(texts) == [
        np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)
    ]
    assert words.tokenizer_ids(FILE, P.PATTERN)(["x<|endoftext|>y"])[0] == np.array([87, 50256, 88], "<u4").tobytes()
    replay = words.WordIds(P.PATTERN, bpe.MergeReplay(bpe.read_ranks(RANKS)))
    assert replay.of(texts) == [np.array(reference.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_memory_of_words_may_start_over(monkeypatch, reference):
    monkeypatch.setattr(words, "REMEMBERED", 20)
    replay = words.WordIds(P.PATTERN, bpe.MergeReplay(bpe.read_ranks(RANKS)))
    for text in odd_texts()[:50]:
        assert replay.of([text, text]) == [np.array(reference.encode_ordinary(text), "<u4").tobytes()] * 2


def test_replay_takes_a_lower_rank_first():
    """A merge that makes a pair of lower rank than itself gives way to it, as word by word."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 400, b"abcbc": 260, b"xa": 270}
    made = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    replay = bpe.MergeReplay(ranks)
    for word in ("abcbc", "bcbcabc", "xabcbc", "abcabcbcbc"):
        assert np.frombuffer(replay([word])[0], "<u4").tolist() == made.encode_ordinary(word)


def test_ranks_and_file_agree_on_all_sorts_of_characters(tokenizer):
    rng = random.Random(8)
    encode = words.tokenizer_ids(FILE, P.PATTERN)
    texts = []
    for _ in range(3000):
        c = [chr(x) for x in (rng.randrange(0x110000) for _ in range(6)) if not 0xD800 <= x < 0xE000] + ["x", " ", "1", "\n", "  "]
        texts.append("".join(rng.choices(c, k=14)))
    assert encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ranks_are_refused_where_merges_say_otherwise(tokenizer):
    made = json.loads(pathlib.Path(FILE).read_text())
    assert words._ranks(made, tokenizer, P.PATTERN) and words._ranks(made, tokenizer, "[a-z]+") is None
    made["model"]["merges"][5:7] = made["model"]["merges"][6:4:-1]
    assert words._ranks(made, tokenizer, P.PATTERN) is None
    assert words._ranks(made | {"normalizer": {"type": "NFC"}}, tokenizer, P.PATTERN) is None


def test_pieces_are_powers_of_two():
    totals = np.array([1, 2, 3, 0, 1023, 1024, 1025, 4097, 6, 1])
    row, start, size = packing.pieces(totals)
    for k, n in enumerate(totals.tolist()):
        own = np.flatnonzero(row == k)
        assert start[own].tolist() == np.append(0, np.cumsum(size[own])).tolist()[: len(own)] and size[own].sum() == n
        assert all(p & (p - 1) == 0 and p <= 1024 for p in size[own].tolist()) and sorted(size[own], reverse=True) == size[own].tolist()
        assert len(own) == n // 1024 + bin(n % 1024).count("1")


def test_pack(spark, messy, messy_rows, empty, tokenizer):
    rows = packing.pack(messy, FILE, P.PATTERN).collect()
    ids = {r["sequence_id"] for r in rows}
    assert len(ids) == len(rows) and all(r["offset"] == 0 and 1 << r["bucket"] == r["length"] for r in rows)
    in_order = [r["bucket"] for r in sorted(rows, key=lambda r: r["sequence_id"])]
    assert in_order == sorted(in_order)
    found = {}
    for r in rows:
        found.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"], r["ids_crc32"], r["length"]))
    whole = {}
    for doc_id, text in messy_rows:
        want = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        whole.setdefault((doc_id, len(want) // 4), []).append(want)
    assert found.keys() == whole.keys()
    for key, wanted in whole.items():
        if len(wanted) > 1:
            continue
        joined, at = b"", 0
        for start, piece, crc, length in sorted(found[key]):
            assert start == at and length == len(piece) // 4 and crc == zlib.crc32(piece)
            joined, at = joined + piece, at + length
        assert joined == wanted[0]
    assert packing.pack(empty, FILE, P.PATTERN).count() == 0
    assert "ids" not in packing.pack(messy, FILE, P.PATTERN, with_ids=False).columns
    with pytest.raises(ValueError):
        packing.pack(messy, FILE, P.PATTERN, longest=1000)


def test_buckets_hold_one_length(spark, messy, tmp_path):
    packing.write_buckets(packing.pack(messy, FILE, P.PATTERN), str(tmp_path / "b"))
    one = spark.read.parquet(str(tmp_path / "b" / "length=64"))
    assert {len(r["ids"]) for r in one.collect()} == {256}


def test_encode_and_decode(messy, messy_rows, empty, reference):
    encoded = bpe.encode_documents(messy, RANKS, P.PATTERN)
    rows = bpe.decode_documents(encoded, RANKS, P.PATTERN).collect()
    want = sorted((repr(i), np.array(reference.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in messy_rows)
    assert sorted((repr(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == want
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in rows)
    assert bpe.decode_documents(bpe.encode_documents(empty, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0
    assert bpe.sha256_hex(b"a") == hashlib.sha256(b"a").hexdigest()
