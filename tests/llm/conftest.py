"""Small awkward tables for the training-text operators."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from conftest_helpers import frame, prose  # noqa: E402

from wrenchlake.session import ready_for_python  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ready_for_python(spark)


@pytest.fixture(scope="session")
def messy_rows():
    """Null, empty, blank, tiny, long, repeated and near-equal texts; null and repeated ids."""
    rng = random.Random(7)
    base = prose(rng, 300)
    near = base.split(" ")
    near[50] = "other"
    texts = [
        None, "", "  \n\t ", "a", "one two three", "UPPER Case words HERE now", base, base, " ".join(near),
        base + "\n" + prose(rng, 200), prose(rng, 30_000), "=" * 3000, "aaaa " * 500, "中文字 👍 <|endoftext|> it's 12,5",
        "mail a.b@c.de or +49 (30) 1234-5678, 10.0.0.1 and 4111 1111 1111 1111.", prose(rng, 120), prose(rng, 120),
    ]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(6, base), (None, base), (None, None), (15, prose(rng, 40)), (15, prose(rng, 40))]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return frame(spark, messy_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
