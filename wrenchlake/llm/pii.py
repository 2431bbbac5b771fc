"""Personal data by weak supervision.

Candidate spans come from the exact patterns of four kinds (the base) and from
looser shapes of the same kinds. Three sorts of labelers vote on each: regex
(the exact pattern, the shape's plausibility), gazetteers (words, top-level
domains and prefixes that speak for or against a kind) and context (what
touches the span, what stands near it). Expectation-maximisation over all
candidates of the table estimates how reliable each labeler is and how likely
each combination of votes is personal data; those probabilities then train a
logistic classifier over the span's own features, which decides.

A candidate is described by a small code of votes and features, so estimation
and training need only the number of candidates per code: at most CODES rows,
however large the table. Base spans always stay; a looser span is added where
the classifier accepts it and no base span overlaps it.

Defined cases: a null or empty text has no span (redaction keeps a null). Equal
rows are treated alike, ids are only carried. Without any candidate the model
is empty and accepts nothing but base spans. Texts are searched whole; every
pattern is written to pass over a text once.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.llm import texts
from wrenchlake.session import materialise

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive or anchored where that changes no match but spares retries.
_MAIL_AFTER = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAIL_BEFORE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser shapes, by kind, and what the lower-cased text must hold for one (none: always tried).
_LOOSE = (
    (0, re.compile(r"\b[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63})+", re.I), ("[at]", "(at)")),
    (1, re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"), (":",)),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])"), None),
    (3, re.compile(r"(?<![0-9+])(?:00[1-9]|\(?0?[0-9]{2,4}\)?)[ ./-][0-9][0-9 ./()-]{4,18}[0-9](?![0-9])"), None),
)

# Gazetteers: words within reach before the span, by kind; words that name other numbers; common domains.
_WORDS_FOR = (
    "mail e-mail email contact contacto kontakt courriel correo write",
    "ip host server address adresse dirección addr client",
    "card visa mastercard amex credit karte kreditkarte carte tarjeta",
    "phone tel telephone call mobile cell fax telefon handy téléphone teléfono móvil",
)
_WORDS_AGAINST = frozenset("isbn issn version v order invoice no nr page id doi token key hash build release section art artikel article".split())
_DOMAINS = frozenset("com org net edu gov info io de fr es uk eu it nl ch at be pt us ca au example test".split())
_FOR = tuple(frozenset(words.split()) for words in _WORDS_FOR)
_WORD = re.compile(r"\w[\w-]*")
REACH = 32

# A code holds kind (2 bits), exact, and six votes or features of 3 bits at most: this many codes can occur.
CODES = 1 << 20


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches; each holds one @ with the longest possible run before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        found = _MAIL_AFTER.match(text, at)
        start = at
        while start > done and text[start - 1] in _MAIL_BEFORE:
            start -= 1
        if found and start < at:
            yield start, found.end()
            done = found.end()
            at = text.find("@", done)
        else:
            done = max(done, start)
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the exact patterns, ordered by start and kind."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.group().split(".")):
            out.append((found.start(), 1, found.end()))
    for found in _CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((found.start(), 2, found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in found.group()) <= 15:
                out.append((found.start(), 3, found.end()))
    return sorted(out)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Looser shapes that overlap no base span."""
    out, lower = [], text.lower()
    starts = [start for start, _, _ in base]
    furthest = list(accumulate((end for _, _, end in base), max))  # end of all base spans up to each
    for kind, pattern, needs in _LOOSE:
        if needs and not any(x in lower for x in needs):
            continue
        for found in pattern.finditer(text):
            a, b = found.span()
            before = bisect_left(starts, b)
            if not before or furthest[before - 1] <= a:
                out.append((a, kind, b))
    return sorted(out)


def code_of(text: str, start: int, kind: int, end: int, exact: bool, near: bool) -> int:
    """Votes and features of a candidate as one small number."""
    own = text[start:end]
    digits = "".join(c for c in own if "0" <= c <= "9")
    words = [w.lower() for w in _WORD.findall(text[max(0, start - REACH) : start])[-3:]]
    speaks = 2 if any(w in _FOR[kind] for w in words) else 1 if any(w in _WORDS_AGAINST for w in words) else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    touched = int(left.isalnum() or left in ("_", "=", "/", "-", '"')) + int(right.isalnum() or right in ("_", "=", "/", "-", '"'))
    if kind == 0:
        valid = int(re.split(r"[.\])\s]+", own.rstrip("])"))[-1].lower() in _DOMAINS)
        size = min(len(own) // 8, 7)
    elif kind == 1:
        valid = int(not own.startswith(("0.", "0:")))
        size = min(len(digits) // 2, 7)
    elif kind == 2:
        valid = int(luhn(digits) and digits[:1] in "3456")
        size = min(max(len(digits) - 12, 0), 7)
    else:
        valid = int(own.startswith(("+", "00", "0", "(")))
        size = min(max(len(digits) - 7, 0), 7)
    varied = min(len(set(digits)), 7) if kind else int(any(c.isdigit() for c in own))
    marks = sum(1 << k for k, c in enumerate(" -.") if c in own)
    code = kind
    for value, bits in ((exact, 1), (speaks, 2), (touched, 2), (valid, 1), (near, 1), (size, 3), (varied, 3), (marks, 3)):
        code = code << bits | int(value)
    return code


def unpack_code(code: int) -> dict[str, int]:
    out = {}
    for name, bits in (("marks", 3), ("varied", 3), ("size", 3), ("near", 1), ("valid", 1), ("touched", 2), ("speaks", 2), ("exact", 1)):
        out[name] = code & ((1 << bits) - 1)
        code >>= bits
    return out | {"kind": code}


def votes(code: int) -> list[int]:
    """Each labeler's vote: 1 personal data, 0 not, -1 abstains."""
    c = unpack_code(code)
    plausible = {0: c["size"] >= 1, 1: c["size"] >= 2, 2: 2 <= c["size"] <= 7, 3: 2 <= c["size"] <= 7}[c["kind"]]
    return [
        1 if c["exact"] else -1,  # regex: the exact pattern
        int(plausible),  # regex: as long as its kind usually is
        {0: -1, 1: 0, 2: 1}[c["speaks"]],  # gazetteer: words before it
        1 if c["valid"] else 0,  # gazetteer: domain, prefix, issuer and check digit
        0 if c["touched"] else -1,  # context: glued to other text
        1 if c["near"] else -1,  # context: another candidate close by
        0 if c["kind"] and c["varied"] <= 2 else -1,  # context: a filler number
    ]


@dataclass(frozen=True)
class Model:
    """Probability of every code that occurred, and the estimated reliability of each labeler (share of right votes)."""

    accepted: dict[int, float] = field(default_factory=dict)
    reliability: tuple[float, ...] = ()


def fit(counts: dict[int, int], rounds: int = 50, steps: int = 500) -> Model:
    """Estimate labelers and train the classifier from the number of candidates per code."""
    if not counts:
        return Model()
    codes = sorted(counts)
    weight = np.array([counts[c] for c in codes], float)
    cast = np.array([votes(c) for c in codes])
    kinds = np.array([unpack_code(c)["kind"] for c in codes])
    exact = np.array([unpack_code(c)["exact"] for c in codes], bool)
    says = np.stack([cast == v for v in (0, 1, -1)], axis=2).astype(float)  # code, labeler, vote
    # Start from the majority; exact spans are known to be personal data.
    truth = np.where(exact, 1.0, 0.1 + 0.8 * ((cast == 1).sum(1) + 0.5) / ((cast >= 0).sum(1) + 1.0))
    for _ in range(rounds):
        # Maximisation: vote frequencies of each labeler under either truth, and the prior of each kind.
        table = np.stack([((weight * t)[:, None, None] * says).sum(0) + 1.0 for t in (1 - truth, truth)])
        table /= table.sum(2, keepdims=True)
        prior = np.array([((weight * truth)[kinds == k].sum() + 1) / (weight[kinds == k].sum() + 2) for k in range(len(KINDS))])
        # Expectation. The exact pattern is the anchor, so its own vote does not enter.
        log_odds = np.log(prior / (1 - prior))[kinds] + (says * (np.log(table[1]) - np.log(table[0]))[None])[:, 1:].sum((1, 2))
        truth = np.where(exact, 1.0, 1 / (1 + np.exp(-np.clip(log_odds, -30, 30))))
    right = (table[1][:, 1] + table[0][:, 0]) / np.maximum(table[:, :, :2].sum((0, 2)), 1e-9)
    # The span classifier sees features, not who voted; "exact" is not among them.
    columns = []
    for code in codes:
        c = unpack_code(code)
        on = [("kind", c["kind"])] + [(name, c["kind"], c[name]) for name in ("speaks", "touched", "valid", "near", "size", "varied", "marks")]
        columns.append(on)
    # One feature of each sort is on, so a code is eight places; codes times features would be gigabytes at the bound.
    names = {name: k for k, name in enumerate(sorted({x for on in columns for x in on}, key=repr))}
    design = np.array([[names[x] for x in on] for on in columns])
    coef, share = np.zeros(len(names)), weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(coef[design].sum(1), -30, 30)))
        pull = np.repeat(share * (p - truth), design.shape[1])
        coef -= 1.0 * (np.bincount(design.ravel(), pull, len(names)) + 1e-4 * coef)
    p = 1 / (1 + np.exp(-np.clip(coef[design].sum(1), -30, 30)))
    return Model({c: float(x) for c, x in zip(codes, p, strict=True)}, tuple(float(x) for x in right))


def candidates_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], list[int]]:
    """Base spans, looser spans, and the code of each, base first."""
    if not text or not any(c in text for c in "0123456789@:") and "at" not in text.lower():
        return [], [], []
    base = base_spans(text)
    loose = loose_spans(text, base)
    every = [(x, True) for x in base] + [(x, False) for x in loose]
    places = sorted(x[0] for x, _ in every)
    codes = []
    for (start, kind, end), exact in every:
        at = bisect_left(places, start)
        near = (at > 0 and start - places[at - 1] < 80) or (at + 1 < len(places) and places[at + 1] - start < 80)
        codes.append(code_of(text, start, kind, end, exact, near))
    return base, loose, codes


def accepted_spans(base: list, loose: list, codes: list[int], accepted: dict[int, float]) -> list[tuple[int, int, int]]:
    """All base spans, and of the looser ones the accepted; of overlapping ones the more likely."""
    kept: list[tuple[int, int, int]] = []  # in order; they do not overlap, so a new one meets its neighbours only
    ranked = sorted(zip(loose, codes[len(base) :], strict=True), key=lambda x: (-accepted.get(x[1], 0.0), x[0]))
    for span, code in ranked:
        if accepted.get(code, 0.0) < 0.5:
            break
        at = bisect_left(kept, span)
        if (at == 0 or kept[at - 1][2] <= span[0]) and (at == len(kept) or span[2] <= kept[at][0]):
            kept.insert(at, span)
    return sorted(base + kept)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id with base and looser spans (flat start, kind, end triples) and codes of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.int32())] * 3
        for batch in batches:
            for part in texts.slices(batch):
                found = [candidates_of(text) for text in part.column("text").to_pylist()]
                flat = [[[n for span in x for n in span] for x in (base, loose)] + [codes] for base, loose, codes in found]
                columns = [pa.array([row[k] for row in flat], kinds[k]) for k in range(3)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "base", "loose", "codes"])

    return texts.id_and_text(docs).mapInArrow(run, "doc_id long, base array<int>, loose array<int>, codes array<int>")


def train(found: DataFrame) -> Model:
    """Model from the frame of ``candidates``: one count per code (at most CODES) reaches the driver."""
    counts = found.select(F.explode("codes").alias("code")).groupBy("code").count().collect()
    return fit({row["code"]: row["count"] for row in counts})


def _triples(flat: list[int]) -> list[tuple[int, int, int]]:
    return list(zip(flat[::3], flat[1::3], flat[2::3], strict=True))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base (string), spans (string) of every row."""
    found = materialise(candidates(docs), "candidates")
    accepted = train(found).accepted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(x).to_pylist() for x in ("base", "loose", "codes")), strict=True)
            counts, base_text, all_text = [[] for _ in KINDS], [], []
            for base, loose, codes in rows:
                base = _triples(base)
                for kind in range(len(KINDS)):
                    counts[kind].append(sum(x[1] == kind for x in base))
                base_text.append(_written(base))
                all_text.append(_written(accepted_spans(base, _triples(loose), codes, accepted)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(base_text, pa.string()), pa.array(all_text, pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base", "spans"],
            )

    return found.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{kind} long" for kind in KINDS) + ", base string, spans string")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets; fits a model on them if none is given."""
    accepted = (model or train(candidates(docs))).accepted

    def clean(text: str | None) -> str | None:
        spans = accepted_spans(*candidates_of(text), accepted) if text else []
        out, done = [], 0
        for start, kind, end in spans:
            if end <= done:
                continue
            out += [text[done : max(start, done)], f"<{KINDS[kind].upper()}>" if start >= done else ""]
            done = end
        return "".join([*out, text[done:]]) if spans else text

    def run(series: Iterator) -> Iterator:
        import pandas as pd

        for column in series:
            yield pd.Series([clean(x) if isinstance(x, str) else None for x in column], dtype=object)

    one = F.pandas_udf(run, "string", functionType=F.PandasUDFType.SCALAR_ITER)
    return docs.withColumn("text", one(F.col("text").cast("string")))

