from pathlib import Path

import pytest

SF = Path("/root/testdata/sf0.001")

# Texts every operator has to take: empty, blank, missing, one word, controls, other alphabets, a long line.
ODD = ["", None, " ", "\n", "\n\n\n", "word", "Two words", "a b c", "ÄÖÜ ß É", "\x00\x01\x7f", "😀 😀",
       "x" * 50_000, "tab\tand\r\nline", "same line\nsame line\nsame line", ". . . !", "  \u0085"]


@pytest.fixture
def odd_docs(spark):
    """Odd texts, one of them twice under one key, a missing key, and columns named like results."""
    rows = [(i, t, "xx", None, 0, "kept", -1) for i, t in enumerate(ODD)]
    rows += [rows[6], (None, "no key", None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score string, bits int")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def sf():
    if not SF.exists():
        pytest.skip("test tables not present")
    return str(SF)
