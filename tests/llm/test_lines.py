import random

import pytest
from pyspark.sql import functions as F
from tests.llm import plain
from txnrisk.llm import lines


def run(spark, rows, parts=5):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()}


def edited_lines(rows, rnd, count=120):
    rows = list(rows)
    for k in range(count):
        line = rnd.choice(rnd.choice(rows[:150])[1].split("\n"))
        found = line.split(" ")
        i = rnd.randrange(len(found))
        change = rnd.randrange(4)
        if change == 0:
            found[i] = f"z{rnd.randrange(3)}"
        elif change == 1:
            found.insert(i, "yyy")
        elif change == 2:
            del found[i]
        else:
            found[i : i + 1] = ["a", "b"]
        rows.append((5000 + k, " ".join(found) + f"\na short line with number {rnd.randrange(40)}"))
    return rows


def test_against_all_pairs(spark, small, odd_rows, monkeypatch):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    rows = edited_lines(rows, random.Random(3)) + [(9000 + i, text) for i, text in odd_rows]
    want = plain.near_lines(rows)
    assert run(spark, rows) == want
    assert len(want) < len(rows)
    # A full bitmap of shared halves costs keys and changes nothing.
    monkeypatch.setattr(lines, "_shared_halves", lambda found: b"\xff" * (lines.LEAST_BITS // 8))
    assert run(spark, rows, 2) == want


def test_equal_keys_are_no_proof(spark, small, monkeypatch):
    """Where keys and hashes say little, lines are told by their words: no line goes that has no near one earlier."""
    rows = edited_lines([(r.doc_id, r.text) for r in small.collect()], random.Random(9))
    want = plain.near_lines(rows)
    monkeypatch.setattr(lines, "_witnesses", lambda found, real=lines._witnesses: real(all_the_same(found)))
    left = run(spark, rows)
    for doc, text in want.items():
        assert set((text or "").split("\n")) <= set((left[doc] or "").split("\n"))


def all_the_same(found):
    """As if a quarter of all keys were equal."""
    return found.withColumn("key", F.when(F.col("key") % 4 == 0, F.lit(0)).otherwise(F.col("key")))


@pytest.mark.parametrize("seed", range(3))
def test_one_edit(spark, seed):
    rnd = random.Random(seed)
    pairs = []
    for _ in range(2000):
        a = [rnd.choice("abc") for _ in range(rnd.randrange(1, 9))]
        b = list(a)
        for _ in range(rnd.randrange(3)):
            i, change = rnd.randrange(len(b) + 1), rnd.randrange(3)
            if change == 0:
                b.insert(i, rnd.choice("abc"))
            elif change == 1 and len(b) > 1:
                del b[min(i, len(b) - 1)]
            elif i < len(b):
                b[i] = rnd.choice("abc")
        pairs.append((" ".join(a), "\t ".join(b)))

    def near(a, b):
        if a == b:
            return True
        drops = [[x[:i] + x[i + 1 :] for i in range(len(x))] for x in (a, b)]
        return a in drops[1] or b in drops[0] or (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)

    frame = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines._one_edit(F.col("a"), F.col("b")).alias("near"))
    for row in frame.collect():
        assert row.near == near(row.a.split(), row.b.split()), (row.a, row.b)


def test_text_ids_and_null_ids(spark, small):
    """Ids of any type are ordered as they are; null ids come last."""
    a = "one two three four five six seven eight"
    rows = [("b", a), (None, a + " nine"), ("a", a.replace("one", "1")), (None, "other line of five words")]
    found = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id string, text string"))
    assert {(r.doc_id, r.text) for r in found.collect()} == {rows[2], rows[3]}


def test_intermediate_tables_are_deleted(spark, small, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr("txnrisk.sources.tables.shared_dir", lambda _: str(folder))
    lines.repeated_lines(small).count()
    assert [p.name.split("-")[0] for p in folder.iterdir()] == ["gone"]


def test_bound_and_order(spark):
    a = "one two three four five six seven eight"
    rows = [
        (3, a),
        (1, a.replace("four", "4") + "\nkept"),
        (2, a + " nine"),  # one word from 3, two from 1
        (4, "one two three four five six seven"),  # too short for an edit
        (5, "ONE two\tthree  four five six seven"),  # the same words
        (6, "short line"),
        (7, "short line"),
    ]
    assert run(spark, rows) == {
        1: rows[1][1],
        2: rows[2][1],
        4: rows[3][1],
        6: "short line",
        7: "short line",
    }


def test_many_lines_one_word_apart(spark):
    rows = [(i, f"page {i} of the long report about nothing at all") for i in range(3000)]
    assert run(spark, rows, 8) == {0: rows[0][1]}


def test_odd_tables(spark, odd):
    out = lines.drop_repeated_lines(odd)
    assert out.columns == odd.columns
    assert lines.drop_repeated_lines(odd.limit(0)).count() == 0
    rows = {r.doc_id: r.text for r in out.collect()}
    assert rows[0] is None and rows[1] == "" and rows[8] == "same line of five words here\n"
    assert sum(r.doc_id is None for r in out.collect()) == 2  # rows that repeat id and text stay together
