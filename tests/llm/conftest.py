"""Rows every operator must bear: nulls, empty and long texts, ties, repeats, clashing columns."""

import pytest

SF = "/root/testdata/sf0.001"

TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "Two words",
    "a  b   c    d",
    "same text as another one here",
    "same text as another one here",
    "SAME text as ANOTHER one here",
    "ÀÉÎ Straße İstanbul ΣΑΣ é J̌  x y z\u0085",
    "你好 😀👩‍💻 สวัสดี ▁▁ a▁b",
    "it's we'll I'M <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> <s> <0x41>",
    "12 3456 ½ x² 1.5, 2,5... !!! ?! a.b. c,d,",
    "\x00\x01 nul\x00inside \x1c sep",
    "Licensed under CC BY-NC 4.0. Released under the MIT License.",
    "x" * 3000,
    "long " * 4000 + "ende",
    "ab" * 1500 + " " + "é" * 800,
]
SCHEMA = "doc_id bigint, text string, id string, fp bigint, chunk int, kind string, hash int, _stats int, _id int, _bad int, n int, key int, bit int"


def wide(spark, rows):
    """(doc_id, text) rows among columns whose names the operators use inside."""
    extra = ("z", 1, 2, "k", 3, 4, 5, 6, 7, 8, 9)
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)


EDGE_ROWS = [*enumerate(TEXTS), (3, "one"), (3, "one"), (4, "other text, same id"), (None, "no id"), (None, None)]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE_ROWS


@pytest.fixture(scope="session")
def edges(spark):
    return wide(spark, EDGE_ROWS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return wide(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def both(documents, edge_rows):
    """The rows of the given table and of the edge table."""
    return {
        "documents": [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()],
        "edges": edge_rows,
    }
