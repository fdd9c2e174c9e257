import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, rank int"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns with clashing names."""
    long_text = " ".join(f"word{i % 997} mail{i}@example.com" for i in range(3000))
    rows = [
        (1, None, "en", "a", None, "x", 1),
        (2, "", None, None, 0, None, None),
        (3, "One two three", "en", "a", 13, "x", 2),
        (3, "One two three", "en", "a", 13, "x", 2),
        (4, "one TWO three", "de", "b", 13, None, 3),
        (5, long_text, "en", "a", None, "x", 4),
        (6, "  \t\n ", "de", "b", 4, "x", 5),
        (7, "mit license, MIT License; GNU General  Public License v3 10.0.0.1", "en", "a", 1, "x", 6),
        (None, "no id here +1 (555) 555-7713, 4111 1111 1111 1111", None, "a", 1, "x", 7),
        (8, "1234567 !!", "fr", None, 10, "x", 8),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
