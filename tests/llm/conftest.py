import random

import pytest

from tests.conftest import MEDIUM, SMALL


@pytest.fixture(scope="session")
def medium(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


#: Texts that every operator on documents must take.
ODD = [
    None,
    "",
    " \n\t ",
    "one",
    "ONE",
    "two words",
    "a\x00b \x0b c\x1cd\x85e\xa0f",
    "émigré Ünïcode 漢字 \U0001f600 éx",
    "same line of five words here\n" * 3,
    "word " * 30_000,
    "x" * 200_000,
]


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts with nulls, empty and very long texts, ties and repeated rows."""
    rows = [(i, text) for i, text in enumerate(ODD)]
    return rows + [(len(ODD), "two words"), (len(ODD) + 1, "two words")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with further columns whose names an operator might use itself."""
    rows = [(i, text, "en", "src1", 0, "x", "y", "z") for i, text in odd_rows]
    rows += [(None, "no id here at all", None, None, None, "x", "y", "z")] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, body string, key string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def edited(medium):
    """Ids and texts of the table with a few hundred edited copies."""
    docs = sorted((row.doc_id, row.text) for row in medium.collect())
    rnd = random.Random(5)
    for k in range(300):
        _, text = rnd.choice(docs[:400] if k < 200 else docs[:8])
        found = text.split(" ")[: rnd.choice([12, 20, 60, 400])]
        for _ in range(rnd.choice([0, 1, 1, 2, len(found) // 40, len(found) // 25])):
            i = rnd.randrange(len(found))
            change = rnd.randrange(3)
            if change == 0:
                found[i] = f"z{rnd.randrange(1000)}"
            elif change == 1:
                found.insert(i, "yyy")
            elif len(found) > 1:
                del found[i]
        docs.append((10_000 + k, " ".join(found)))
    return docs
