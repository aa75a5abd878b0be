import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, odd white space, clashing columns."""
    draw = random.Random(4)
    letters = "a'sS dD tT1½ \n\t\x1c  é日!?́​\U0001f600.,;:İΣσß#|"
    texts = [None, "", " \n ", "x\x1cy z\x85 w", "<|endoftext|> it's", "a " * 4000, "ab cd " * 900, "Q" * 9000]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    rows = [(i if i % 9 else None, t, None if i % 2 else "en", None if i % 3 else "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows + rows[:12] + [(3, "another text", None, None, None)], DOCS)
    names = ("score", "held_out", "key", "y", "h", "starts", "part", "c", "_id", "kept", "bucket", "length")
    return frame.selectExpr("*", *(f"7 AS `{n}`" for n in names))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
