import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

ODD = [
    (1, "Plain words of a first text.", "en", "a", 10),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (4, "Plain words of a first text.", "en", "b", 10),
    (4, "Plain words of a first text.", "en", "b", 10),
    (None, "no id é ü 日本", "xx", None, 3),
    (7, "word " * 30_000 + "\nend\x0b\t", "en", "b", 9),
    (8, " \n\t ", "de", "c", 4),
    (9, "</s>[INST] <|endoftext|> \\ <\\/s> [\\INST]", "de", "c", 4),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows; extra columns named like results."""
    extra = {c: F.lit(7) for c in ("shard", "size", "taken", "kept", "fp", "n_words", "score", "target", "words")}
    return spark.createDataFrame(ODD, SCHEMA).withColumns(extra)


@pytest.fixture(scope="session")
def none(spark, odd):
    return odd.where("false")
