import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textmill.llm.common import read_table  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = " ".join(f"word{i % 3001} of" for i in range(20_000)) + "\nThe same Line of text\n"
COPY = "One text that Several rows hold, long enough for shingles and for lines\nsecond line of it\n"


@pytest.fixture(scope="session")
def documents(spark):
    return read_table(spark, SF_DIR, "documents").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and very long texts, copies, ties and columns named like results."""
    rows = [
        (1, COPY, "a", 1),
        (2, COPY.upper(), "a", 2),
        (3, COPY, None, 3),
        (3, COPY, None, 3),
        (4, None, "b", 4),
        (5, "", "b", 5),
        (6, " \t\n", "b", 6),
        (7, LONG, "c", 7),
        (8, LONG + "tail", "c", 8),
        (9, "Ä Key \U0001f600 password: hunter2 KEY", "é", 9),
        (None, COPY, "a", 10),
        (None, None, None, 11),
        (10, "the same line of text  \n<|endoftext|> a  b", None, None),
    ]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    names = ["shard", "slot", "target", "taken", "copies", "kept", "keep_id", "component", "component_id", "n_words", "n_lines", "spans", "rule", "h1", "h2", "rep", "length", "tokens"]
    for name in names:
        plain = plain.withColumn(name, plain["size"])
    return plain.cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
