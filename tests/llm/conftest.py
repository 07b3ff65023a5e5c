import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from motefield.llm.shipping import ship_package  # noqa: E402
from motefield.llm.workspace import Workspace  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# Texts that every operator on documents has to take: nulls, empty and long ones, ties, control characters, several scripts.
ODD_TEXTS = [
    None, "", "   ", "a", "A", "\n\t", "one two three", "ONE two three", "one two three", "é É ß İ Σς", "日本語 テキスト", "x\x1cy z",
    "<|endoftext|> </s> [INST]", "token = \"0123456789abcdef0123456789abcdef\"", "word " * 20_000, "z" * 30_000, " " * 9_000, "'s 't don't 12 345",
]


@pytest.fixture
def work(spark):
    ship_package(spark)
    return Workspace(spark, "llm-tests")


@pytest.fixture
def odd(spark):
    """Odd texts as documents; two ids are repeated, one is null, and other columns bear names the operators use themselves."""
    rows = [(i, t, "x", i) for i, t in enumerate(ODD_TEXTS)] + [(5, "other", "y", 1), (6, "one two three", "y", 2), (None, "one two three", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, name string, count long")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, name string, count long")
