import random

import pytest
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators' internal or output names could clash with.
CLASHES = ["digest", "content", "KEEP_ID", "n", "salt", "replica", "order_key", "mix_source", "mix_draw", "score", "lang_pred", "predicted", "ids", "decoded", "media", "n_bytes", "payload", "starts", "key", "token", "label", "item", "dropped_id", "html_text", "h", "k"]


def passage(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, white space of every kind, copies, near copies, repeated rows."""
    long_ = passage(1, 3000)
    common = passage(2, 40)
    out = [
        (1, "One two  three\tfour", "en", "a", 3),
        (2, "one two three four", "en", "a", None),
        (3, "One two three four", None, "b", 3),
        (4, None, "en", None, None),
        (5, "", "de", "a", 0),
        (6, " \n\t ", "de", "b", 1),
        (7, long_, "fr", "a", 1),
        (8, long_.replace(" ", "\n"), "fr", "a", 1),
        (9, long_ + " end", None, None, 1),
        (10, "▁odd \U0001f600 \x00 café 漢字", "xx", "b", 1),
        (11, "one", "en", "b", 1),
        (12, "One", "en", "b", 1),
        (13, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "en", "b", 1),
        (None, "no id " + common, "en", "a", 1),
        (None, "One two three four", "en", "a", 1),
        (14, common, "en", "a", 1),
        (15, passage(3, 30) + " " + common + " " + passage(4, 30), "en", "a", 1),
        (16, common + " " + passage(5, 9), "en", "c", 1),
        (17, passage(6, 60), "en", "c", 1),
        (17, passage(6, 60), "en", "c", 1),
    ]
    near = passage(7, 90).split()
    for k in range(8):
        words = list(near)
        words[10 * k + 3] = f"w{k}"
        out.append((100 + k, " ".join(words), "en", "c", 1))
    r = random.Random(9)
    for k in range(60):
        out.append((200 + k, " ".join(r.choice("red green blue dog cat".split()) for _ in range(r.randint(0, 24))), "en", "d", 1))
    return out


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")
