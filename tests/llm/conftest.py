from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{k % 7001}x{k % 13}" for k in range(60_000))
ODD_TEXTS = [
    None, "", " \t\n", "one", "One two", "a b c d", "x y 　z", "\U0001f600 café naïve", "line\nline\n\nline\r\nlast", "A" * 5000, LONG,
    "the same text occurs twice in this table of odd ones", "the same text occurs twice in this table of odd ones",
]


@pytest.fixture(scope="session")
def given(spark):
    """A given table by name, at the smallest size."""
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, with a null id, a repeated row and columns whose names clash with helpers of the operators."""
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "a row without an id has this text"), (3, "one")]
    schema = "doc_id long, text string, lang string, n long, c double, key string, row int, shard int, _verdict int, _counts int, rep long"
    return spark.createDataFrame([(i, t, None if (i or 0) % 4 == 0 else "en", 1, 0.5, "k", 2, 3, 4, 5, 6) for i, t in rows], schema)
