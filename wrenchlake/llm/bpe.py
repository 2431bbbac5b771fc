"""Byte-level BPE by merge replay over a corpus of words.

The distinct words of a block of documents form one corpus. Their bytes lie in
one long array with links to the left and right neighbour, and an inverted
index leads from each token pair's rank to the positions where it stands. All
merges are then applied in rank order over the whole corpus at once; a merge
touches only the two pairs beside it. Words that a worker has met before keep
their ids and do not enter the next corpus.

Blocks are bounded by bytes of text, not by the table, so memory stays bounded
and no word has to be shuffled.

Defined cases: null or empty text has no ids and decodes to empty bytes. Ids
must decode to the bytes they came from, whatever the text holds. Equal rows
get equal results. A vocabulary without some single byte raises ``ValueError``
when that byte occurs.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wrenchlake.llm import texts
from wrenchlake.llm.words import WordIds

_loaded: dict[tuple[str, str], tuple[WordIds, list[bytes]]] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class MergeReplay:
    """Replays the merges of a rank table on lists of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self._ranks = ranks
        self._bytes = {rank: token for token, rank in ranks.items()}
        single = [ranks.get(bytes([b]), -1) for b in range(256)]
        self._single = np.array(single, np.int64)
        self._pairs: dict[tuple[int, int], int] = {}
        self._first = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int64)

    def _rank(self, left: int, right: int) -> int:
        """Rank of the merged pair, -1 if it is no token."""
        found = self._pairs.get((left, right))
        if found is None:
            found = self._ranks.get(self._bytes[left] + self._bytes[right], -1)
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            self._pairs[left, right] = found
        return found

    def __call__(self, words: list[str]) -> list[bytes]:
        """The id bytes of each word."""
        if not words:
            return []
        encoded = [word.encode() for word in words]
        data = np.frombuffer(b"".join(encoded), np.uint8)
        ends = np.cumsum([len(word) for word in encoded])
        starts = ends - [len(word) for word in encoded]
        if (self._single[data] < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        n = len(data)
        tokens = self._single[data].tolist()
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[starts] = -1
        index = self._index(data, after)
        self._merge(tokens, before.tolist(), after.tolist(), index)
        merged = np.array(tokens)
        alive = merged >= 0
        sizes = np.concatenate([[0], np.cumsum(alive)])
        ids = merged[alive].astype("<u4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(sizes[starts].tolist(), sizes[ends].tolist(), strict=True)]

    def _index(self, data: np.ndarray, after: np.ndarray) -> dict[int, list[int]]:
        """Positions of the byte pairs that can merge, by rank."""
        left = np.flatnonzero(after >= 0)
        ranks = self._first[data[left], data[left + 1]]
        left, ranks = left[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        left, ranks = left[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        first = ranks[np.concatenate([[0], cuts])].tolist() if len(ranks) else []
        return dict(zip(first, (part.tolist() for part in np.split(left, cuts)), strict=False))

    def _merge(self, tokens: list[int], before: list[int], after: list[int], index: dict[int, list[int]]) -> None:
        rank_of = self._rank
        waiting = list(index)
        heapify(waiting)
        while waiting:
            rank = heappop(waiting)
            spots = sorted(index.pop(rank))
            for done, spot in enumerate(spots, 1):
                left = tokens[spot]
                gone = after[spot]
                if left < 0 or gone < 0 or rank_of(left, tokens[gone]) != rank:
                    continue  # a neighbour has been merged since
                tokens[spot], tokens[gone] = rank, -1
                after[spot] = right = after[gone]
                lower = False
                if right >= 0:
                    before[right] = spot
                    lower = self._note(rank_of(rank, tokens[right]), spot, rank, index, waiting)
                if (other := before[spot]) >= 0:
                    lower |= self._note(rank_of(tokens[other], rank), other, rank, index, waiting)
                if lower and done < len(spots):  # a pair that ranks lower goes first
                    if rank not in index:
                        index[rank] = []
                        heappush(waiting, rank)
                    index[rank] += spots[done:]
                    break

    @staticmethod
    def _note(found: int, spot: int, rank: int, index: dict[int, list[int]], waiting: list[int]) -> bool:
        """Enter a new pair into the index; true if it goes before the merge at hand."""
        if found < 0:
            return False
        if found in index:
            index[found].append(spot)
        else:
            index[found] = [spot]
            heappush(waiting, found)
        return found < rank


def _codec(path: str, pattern: str) -> tuple[WordIds, list[bytes]]:
    if (path, pattern) not in _loaded:
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _loaded[path, pattern] = WordIds(pattern, MergeReplay(ranks)), tokens
    return _loaded[path, pattern]


def decode(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _codec(ranks_path, pattern)
        for batch in batches:
            for part in texts.slices(batch):
                ids = encoder.of(part.column("text").to_pylist())
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), counts], ["doc_id", "ids", "n_tokens"])

    return texts.id_and_text(docs).mapInArrow(run, "doc_id long, ids binary, n_tokens long")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The frame of ``encode_documents`` with the decoded bytes as ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokens = _codec(ranks_path, pattern)
        for batch in batches:
            for part in texts.slices(batch, "ids"):
                decoded = [decode(x, tokens) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], [*part.schema.names, "decoded"])

    return encoded.select("doc_id", "ids", "n_tokens").mapInArrow(run, "doc_id long, ids binary, n_tokens long, decoded binary")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
