import pytest
from pyspark.sql import functions as F

from ..conftest import SF_ORACLE, SF_SMALL, spark  # noqa: F401

ODD_TEXTS = [None, "", "   ", "\n\t", "a", "A a", " lead and  trail ", "x ▁y ▁▁ z", "<|endoftext|> </s> <s>", "élan Vital, naïve; ÉTÉ",
             "日本語 テキスト", "tab\tand\nline\r\nend", "123 456", "!!! ???", "a　b  c", "x" * 5000, "word " * 3000, "word " * 3000,
             "one two three four five six", "one two three four five six"]


@pytest.fixture(scope="session")
def docs(spark):  # noqa: F811
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):  # noqa: F811
    """Null and repeated ids, odd and repeated texts, null sources and languages, clashing extra columns."""
    rows = [(None if i % 7 == 3 else i, t, ("en", None, "fr")[i % 3], (None, "s0", "s1")[i % 3], 1, 5, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[0], rows[-1], rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, score string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter(F.lit(False))


@pytest.fixture(scope="session")
def oracle_dir():
    return SF_ORACLE
