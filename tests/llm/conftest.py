import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from annoflow.session import build_session
    s = build_session("local[4]", app="annoflow-llm-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls in every column, empty and long texts, ties, repeats and columns that clash."""
    rows = [(1, "one two three", "en", "s"), (1, "one two three", "en", "s"), (2, None, None, None), (None, "no id here", "en", None),
            (None, None, None, None), (3, "", "", ""), (4, " \t\n \n", "en", "s"), (5, "word " * 30000, "en", "s"),
            (1, "same id, other text", "de", "s"), (6, "é́ ß x\x1cy <|endoftext|> \\n <|im_end|> 𝔘", "de", "s")]
    df = spark.createDataFrame([(*r, 0) for r in rows], DOCS)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in ("h", "start", "n_words", "leaf", "fp", "row", "ids", "n")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
