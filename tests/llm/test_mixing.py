from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from txnrisk.llm import mixing


def domain():
    return F.when(F.crc32("source") % 2 == 0, "even").otherwise("odd")


WEIGHTS = {"even": 5, "odd": 1, "*/en": 3, "odd/de": 4}


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", domain(), "lang", "source").collect()]


@pytest.mark.parametrize(("total", "epochs"), [(None, 4), (None, 1), (1, 2), (5_000, 1), (10**9, 3), (0, 2)])
def test_against_plain(small, total, epochs):
    plan = mixing.Plan(WEIGHTS, total, epochs, seed=11)
    found = mixing.selection(small, plan, domain()).select("doc_id", "epoch", "take_tokens").collect()
    assert Counter(map(tuple, found)) == plain.mixed(rows_of(small), WEIGHTS, total, epochs, 11)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(1, "w " * 10, "en", "a"), (2, "w " * 500, "en", "b"), (3, "w " * 500, "de", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    plan = mixing.Plan({"*/a": 9}, total=400, max_epochs=1)
    taken = {r.doc_id: r.take_tokens for r in mixing.selection(docs, plan, F.lit("d")).collect()}
    assert taken == {1: 10, 2: 190, 3: 200}


def test_order_does_not_hang_on_partitions(small):
    plan = mixing.Plan(WEIGHTS, 3_000, 2)
    one = mixing.selection(small.coalesce(1), plan, domain()).collect()
    many = mixing.selection(small.repartition(7), plan, domain()).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, many))


def test_odd_tables_and_clashing_names(odd):
    plan = mixing.Plan({"*/en": 2}, max_epochs=2)
    clash = odd
    for name in ("row", "mix_id", "mix_key", "mix_tokens", "leaf_lang", "mix_epochs", "take_tokens", "budget"):
        clash = clash.withColumn(name, F.lit("kept"))
    out = mixing.mix(clash, plan, F.lit("d"))
    assert out.columns == clash.columns
    rows = out.collect()
    assert {r.mix_key for r in rows} == {r.leaf_lang for r in rows} == {"kept"}
    assert not {r.doc_id for r in rows} & {0, 1, 2}  # no tokens
    assert mixing.mix(odd.limit(0), plan, F.lit("d")).count() == 0
