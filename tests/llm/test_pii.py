import random
import re
import time

from conftest_helpers import frame

from wrenchlake.llm import pii

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE) for m in re.finditer(p, text) if holds(kind, m.group())]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def odd_texts():
    rng = random.Random(9)
    atoms = ["a@b.c", "@", ".", "..", "x.y", "@d.e@f.g", "1", "22", "255", "256", "0007", " ", "-", "+", "(", ")", "é", "a", "%", "4111111111111111",
             "+49 30 1234567", "10.0.0.1", "1.2.3.4.5", "\n", "--", "_"]
    return ["".join(rng.choices(atoms, k=rng.randint(0, 25))) for _ in range(4000)]


def test_base_spans_equal_the_plain_patterns():
    for text in [*odd_texts(), "a" * 20_000, "1" * 20_000, "+" * 5000, "@" * 5000, "1." * 5000, "+1" + " " * 5000]:
        assert pii._written(pii.base_spans(text)) == brute(text), text[:80]


def test_codes_unpack():
    text = "call phone (030) 123 4567 or x"
    start = text.index("(")
    code = pii.code_of(text, start, 3, start + 14, False, True)
    parts = pii.unpack_code(code)
    assert 0 <= code < pii.CODES
    assert (parts["kind"], parts["exact"], parts["speaks"], parts["near"], parts["valid"]) == (3, 0, 2, 1, 1)


def labelled_table(spark):
    """Exact and looser phones beside phone words, and look-alike numbers beside other words."""
    rng = random.Random(2)
    rows, truth = [], {}
    for k in range(600):
        a, b, c = rng.randint(200, 989), rng.randint(100, 999), rng.randint(1000, 9999)
        kind = k % 3
        if kind == 0:
            text = f"please call phone +1 ({a}) {b}-{c} soon"
        elif kind == 1:
            text = f"please call phone ({a}) {b}-{c} soon"
        else:
            text = f"see order no {a}-000-0000-{a}x soon"
        rows.append((k, text))
        truth[k] = kind == 1
    return frame(spark, rows), truth


def test_weak_supervision_adds_spans(spark):
    docs, truth = labelled_table(spark)
    rows = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for k, adds in truth.items():
        extra = set(filter(None, rows[k]["spans"].split(","))) - set(filter(None, rows[k]["base"].split(",")))
        assert bool(extra) == adds, (k, rows[k])
    model = pii.train(pii.candidates(docs))
    assert len(model.reliability) == 7 and all(0 <= x <= 1 for x in model.reliability)
    text = pii.redact(docs, model).filter("doc_id = 1").first()["text"]
    assert text == "please call phone <PHONE> soon"


def test_find(messy, messy_rows, empty):
    rows = pii.find(messy).collect()
    assert sorted((repr(r["doc_id"]), r["base"]) for r in rows) == sorted((repr(i), brute(t or "")) for i, t in messy_rows)
    found = next(r for r in rows if r["doc_id"] == 14)
    assert [found[f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    assert set(found["base"].split(",")) <= set(found["spans"].split(","))
    assert pii.find(empty).count() == 0


def test_redact(messy, messy_rows, empty):
    clean = pii.redact(messy)
    assert clean.columns == messy.columns
    rows = clean.collect()
    assert len(rows) == len(messy_rows)
    assert next(r["text"] for r in rows if r["doc_id"] == 14) == "mail <EMAIL> or <PHONE>, <IP> and <CARD>."
    assert next(r["text"] for r in rows if r["doc_id"] == 0) is None
    assert pii.redact(empty).count() == 0


def test_prefilters_let_every_loose_shape_through():
    for text in ("JOE [AT] EXAMPLE [DOT] COM", "Joe [At] Example [Dot] Com", "joe (At) example (dot) com", "JOE(aT)EXAMPLE(dOT)ORG"):
        base, loose, codes = pii.candidates_of(text)
        assert (base, loose) == ([], [(0, 0, len(text))]) and len(codes) == 1
    hexes = "fe:dc:ba:ab:cd:ef:fa:ce"
    assert pii.candidates_of(hexes)[1] == [(0, 1, len(hexes))]


def test_a_long_text_takes_linear_time():
    """10 MB of numbers that look like phones: every loose span meets its neighbours only."""
    rng = random.Random(6)
    lines = [f"({rng.randint(10, 999)}) {rng.randint(200, 999)} {rng.randint(1000, 9999)} or +49 30 {rng.randint(100000, 9999999)}, " for _ in range(300_000)]
    text = "".join(lines)
    assert len(text) > 9_000_000
    start = time.process_time()
    base, loose, codes = pii.candidates_of(text)
    kept = pii.accepted_spans(base, loose, codes, dict.fromkeys(codes, 0.9))
    assert time.process_time() - start < 120 and len(base) > 200_000 and len(loose) > 200_000
    assert all(a[2] <= b[0] for a, b in zip(kept, kept[1:]))


def test_overlaps_equal_the_plain_ones():
    rng = random.Random(7)
    for _ in range(200):
        base = sorted((a, rng.randrange(4), a + rng.randint(1, 9)) for a in rng.sample(range(200), 12))
        text = "".join(rng.choices("0123 ()-+./", k=220))
        plain = [(m.start(), k, m.end()) for k, p, needs in pii._LOOSE if not needs or any(x in text for x in needs) for m in p.finditer(text)]
        plain = sorted(x for x in plain if not any(x[0] < end and start < x[2] for start, _, end in base))
        assert pii.loose_spans(text, base) == plain
        codes = [rng.randrange(40) for _ in [*base, *plain]]
        accepted = {c: rng.random() for c in codes}
        kept = []
        for span, code in sorted(zip(plain, codes[len(base) :], strict=True), key=lambda x: (-accepted[x[1]], x[0])):
            if accepted[code] >= 0.5 and not any(span[0] < b and a < span[2] for a, _, b in kept):
                kept.append(span)
        assert pii.accepted_spans(base, plain, codes, accepted) == sorted(base + kept)
