"""Texts and frames that the tests of this folder share."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, hash long, block int, span string, set_id long"


def prose(rng: random.Random, n: int) -> str:
    syllables = ["an", "the", "ou", "re", "ti", "on", "sh", "ing", "ble", "é", "ß"]
    out = []
    for k in range(n):
        word = "".join(rng.choices(syllables, k=rng.randint(1, 4)))
        out.append(word.capitalize() if k % 9 == 0 else word)
        if k % 9 == 8:
            out[-1] += rng.choice([".", ".", "!", ".\n"])
    return " ".join(out)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def frame(spark, rows):
    full = [(i, t, "en", "src0", None if t is None else len(t), 1.5, 7, 3, "x", 9) for i, t in rows]
    return spark.createDataFrame(full, DOCS)
