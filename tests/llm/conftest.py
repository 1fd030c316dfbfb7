import os
import re

import pytest

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# columns that clash with names the operators use inside
CLASHING = ("id", "body", "score", "n", "topic", "n_tokens", "component", "shard", "size", "key", "label", "node")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("driver tables are not here")
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def clashing(df):
    """``df`` with more columns than asked for."""
    return df.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHING if c not in df.columns))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def odd_documents(spark):
    """Null, empty, blank, one-word, very long, repeated and tied texts, a null id, null language and source."""
    long_text = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = [
        (1, None, "en", "src0", 0),
        (2, "", "en", "src0", 0),
        (3, " \t\n ", None, None, 4),
        (4, "one", "en", "src1", 3),
        (5, "One", "en", "src1", 3),
        (6, long_text, "en", "src2", len(long_text)),
        (7, long_text + " tail", "en", "src2", len(long_text) + 5),
        (8, f"before it {passage} after it", "de", "src0", 9),
        (9, f"{passage} x y z", "de", "src0", 9),
        (10, f"q {passage} x y z", "de", "src0", 9),
        (10, f"q {passage} x y z", "de", "src0", 9),
        (11, "x" * 300 + " é ñ z " + "y" * 40, "fr", "new", 9),
        (None, f"{passage} x y z", "fr", "src0", 9),
        (12, "12 34 !!", "es", "src3", 8),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def odd(spark):
    return clashing(odd_documents(spark))


@pytest.fixture(scope="session")
def none(spark):
    return clashing(spark.createDataFrame([], DOCS))
