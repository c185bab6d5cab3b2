import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; documents may have them too.
CLASHING = "key size m n head tail salt run part place label node turn times rank words ids target kept source_size".split()

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix liquid jade boxes near a frozen river bank "


def cases():
    long = " ".join(f"w{i}" for i in range(60_000))
    return [
        (1, PROSE * 3, "en", "a", 1),
        (2, PROSE * 3, "en", "a", 1),
        (3, PROSE.upper() * 3, "en", "b", 1),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, None, "en", None, 0),
        (7, long, "en", "c", 5),
        (8, " \n\t ", None, "a", 4),
        (9, "Mail jane.doe@mail.example.com or +1 (171) 555-2028, card 4539578763621486, host 10.0.0.255", "en", "b", 1),
        (9, "Mail jane.doe@mail.example.com or +1 (171) 555-2028, card 4539578763621486, host 10.0.0.255", "en", "b", 1),
        (None, "no id here", "fr", "c", 1),
        (10, "Ünïcödé wörds ßind schön 日本語 " * 20, "de", "c", 1),
        (11, "Ünïcödé wörds ßind schön 日本語 " * 20, "de", None, 1),
        (12, "x" * 30_000, "en", "c", 1),
        (13, "one", "en", "a", 1),
        (14, "Released under the MIT License.\n" + PROSE, "en", "a", 1),
        (14, "other text with the same id", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def rows():
    return cases()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def wide(docs):
    """The documents with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit(name).alias(name) for name in CLASHING))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """Some hundreds of the generated documents, with copies and near copies among them."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
