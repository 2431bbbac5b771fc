"""Token ids of whole texts: put together from the ids of their distinct words, or by a tokenizer file."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import regex

# Words remembered by one Python worker; beyond that it starts over, which costs time only.
REMEMBERED = 300_000

# The usual splitting pattern of byte-level BPE (a fixed value).
USUAL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts whose characters are all ASCII or Latin letters, in classes that the standard module knows.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_LATIN_WORDS = re.compile(
    rf" ?[{_LATIN}]++|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]++| ?[^\t-\r {_LATIN}0-9]++|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
_NOT_LATIN = re.compile(rf"[^\x00-\x1b\x20-\x7f{_LATIN}]")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of the pattern, by a quicker way where a text allows it."""
    exact = regex.compile(pattern).findall
    if pattern != USUAL_PATTERN:
        return exact
    return lambda text: exact(text) if _NOT_LATIN.search(text) else _LATIN_WORDS.findall(text)


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``encode_new`` turns a list of distinct, not yet seen words into their id
    bytes. Byte-level BPE never merges across the matches of its splitting
    pattern, so a text's ids are the ids of its words, one after another.
    """

    def __init__(self, pattern: str, encode_new: Callable[[list[str]], Sequence[bytes]]):
        self._split = splitter(pattern)
        self._encode_new = encode_new
        self._known: dict[str, bytes] = {}

    def of(self, texts: Sequence[str]) -> list[bytes]:
        split = [self._split(text) for text in texts]
        flat = list(chain.from_iterable(split))
        ids = list(map(self._known.get, flat))
        if None in ids:
            unknown = [word for word, found in zip(flat, ids, strict=True) if found is None]
            new = list(dict.fromkeys(unknown))
            made = dict(zip(new, self._encode_new(new), strict=True))
            rest = map(made.__getitem__, unknown)
            ids = [next(rest) if found is None else found for found in ids]
            if len(self._known) + len(made) > REMEMBERED:
                self._known = {}
            self._known.update(made)
        out, at = [], 0
        for found in split:
            out.append(b"".join(ids[at : at + len(found)]))
            at += len(found)
        return out


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the rest follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ranks(made: dict, tokenizer, pattern: str) -> dict[bytes, int] | None:
    """The vocabulary as bytes to rank, if merging by rank gives what the file's own merges give; else None.

    That is so where ids rise with the merges and every token comes out of its
    own bytes: two neighbouring tokens whose bytes together are a token can only
    be the pair by which that token is made.
    """
    model, before = made.get("model", {}), made.get("pre_tokenizer") or {}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges", "fuse_unk")
    plain = (
        pattern == USUAL_PATTERN
        and made.get("normalizer") is None
        and model.get("type") == "BPE"
        and not any(model.get(name) for name in odd)
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
    )
    if not plain:
        return None
    added = {token["content"] for token in made.get("added_tokens", ())}
    letters, vocabulary = _byte_letters(), {k: v for k, v in model["vocab"].items() if k not in added}
    if any(c not in letters for token in vocabulary for c in token) or any(c not in vocabulary for c in letters):
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocabulary.get("".join(pair), -1) for pair in pairs]
    if any(a >= b for a, b in zip([-1, *ids], ids)):
        return None
    if any(len(tokenizer.model.tokenize(token)) != 1 for token in vocabulary):
        return None
    return {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items()}


def tokenizer_ids(path: str, pattern: str) -> Callable[[Sequence[str]], list[bytes]]:
    """Encoder of texts by a ``tokenizers`` file.

    Plain byte-level files are encoded by their ranks, which gives the same ids
    in less time. Texts that hold an added token, and all texts of other files,
    go to the tokenizer itself.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def by_file(texts: Sequence[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    ranks = _ranks(made, tokenizer, pattern)
    if ranks is None:
        return by_file
    import tiktoken

    by_ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    added = [token["content"] for token in made.get("added_tokens", ())]

    def ids_of(texts: Sequence[str]) -> list[bytes]:
        return [
            by_file([text])[0] if any(token in text for token in added) else by_ranks.encode_to_numpy(text).astype("<u4").tobytes()
            for text in texts
        ]

    return ids_of
