import hashlib
from statistics import mean, stdev

from pyspark.sql import functions as F

from tests.llm import plain
from txnrisk.llm import fingerprints as fp


def edited_texts(rows):
    rows = sorted(rows)
    out = {}
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        out[doc] = (text, text[: len(text) - half] + following[:half], following)
    return out


def test_edited_texts_and_estimates(spark, medium, odd_rows, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 50)
    rows = [(r.doc_id, r.text) for r in medium.collect()] + [(2000 + 7 * i, text) for i, text in odd_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = edited_texts(rows)
    found = fp.edited_pairs(docs).collect()
    assert len(found) == len(rows)
    errors, prints = [], {}
    for row in found:
        text, edited, following = want[row.doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        if text.isascii() and edited.isascii() and following.isascii():
            a, b, c = (plain.shingles(t.lower(), 5) for t in (text, edited, following))
            for other, near in ((b, row.near_edited), (c, row.near_next)):
                true = len(a & other) / len(a | other) if a | other else 1.0
                errors.append(abs(true - near))
                assert 0 <= near <= 1
    assert mean(errors) < 0.02 and max(errors) < 0.2


def test_parts_merge_to_the_whole(spark, medium):
    """Sketches of parts, a third of them under one key, merge to that of all shingles of the key."""
    parts = medium.select(
        F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("doc_id") % 50).alias("k"), "text"
    ).repartition(9)
    merged = {r.k: r.fingerprint for r in fp.merge_by(fp.with_fingerprint(parts), ["k"]).collect()}
    whole = (
        parts.select("k", F.explode(fp.shingle_hashes(F.col("text"))).alias("h"))
        .groupBy("k")
        .agg(fp.bottom(F.collect_set("h")).alias("want"))
    )
    for row in whole.collect():
        assert merged[row.k] == row.want


def test_estimates_of_the_number_of_shingles(spark, medium):
    """Over several hashes of the same shingles the estimate is right on average, and as close as its size allows."""
    hashes = (
        medium.select(F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("doc_id") % 50).alias("k"), "text")
        .select("k", F.explode(fp.shingle_hashes(F.col("text"))).alias("h"))
        .distinct()
        .select("k", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("seed"), "h")
    )
    found = (
        hashes.groupBy("k", "seed")
        .agg(F.count("*").alias("n"), fp.bottom(F.collect_set(F.xxhash64("h", "seed"))).alias("smallest"))
        .select("n", fp.distinct_shingles(F.col("smallest")).alias("estimate"))
        .collect()
    )
    errors = [row.estimate / row.n - 1 for row in found]
    assert len(errors) > 200 and min(row.n for row in found) > fp.K
    spread = 1 / (fp.K - 2) ** 0.5
    assert abs(mean(errors)) < 4 * spread / len(errors) ** 0.5
    assert 0.8 * spread < stdev(errors) < 1.2 * spread


def test_buckets_are_even_whatever_the_ids(spark, monkeypatch):
    """One far-off id, or none at all, does not put the others into one bucket."""
    monkeypatch.setattr(fp, "BUCKET_ROWS", 50)
    ids = [*range(4000), *range(10**15, 10**15 + 4000), 2**62, -(2**62)] + [None] * 2000
    rows = [(i, f"text {n}") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, body string").repartition(4)
    followed = fp.with_next(docs, "doc_id", "body", ["doc_id"])
    found = {r.body: r.next.doc_id for r in followed.collect()}
    named = [r for r in rows if r[0] is not None]
    order = sorted(named)
    for (_, text), (after, _) in zip(order, order[1:]):
        assert found[text] == after
    assert len(found) == len(rows) and found[order[-1][1]] is None
    sizes = []
    real = fp._bucket

    def spy(*args):
        column = real(*args)
        keyed = docs.withColumn("next_order", F.struct(F.col("doc_id").alias("id"), F.xxhash64("body").alias("hash")))
        sizes.extend(r["count"] for r in keyed.groupBy(column.alias("b")).count().collect())
        return column

    monkeypatch.setattr(fp, "_bucket", spy)
    fp.with_next(docs, "doc_id", "body", ["doc_id"])
    assert max(sizes) < 500


def test_small_sketches_are_exact(spark):
    docs = spark.createDataFrame([("a b c d e f g", "a b c d e f x"), ("", None), ("", "a")], "a string, b string")
    a, b = fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))
    rows = docs.select(
        fp.resemblance(a, b).alias("r"), fp.containment(a, b).alias("c"), fp.distinct_shingles(a).alias("n")
    ).collect()
    assert rows[0] == (0.5, 2 / 3, 3.0)
    assert rows[1] == (1.0, 1.0, 0.0)
    assert rows[2] == (0.0, 1.0, 0.0)


def test_odd_tables(spark, odd):
    assert fp.with_fingerprint(odd).columns == [*odd.columns, "fingerprint"]
    assert fp.edited_pairs(odd.limit(0)).count() == 0
    assert fp.edited_pairs(odd).count() == odd.count()
    one = fp.edited_pairs(odd.filter("doc_id = 5")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"two wtwo ").hexdigest()


def test_no_python_in_the_plan(medium):
    plan = fp.edited_pairs(medium)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
