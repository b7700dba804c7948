"""URL filters: association rules mined from labelled URLs by FP-growth, and explicit rules for hosts and paths.

Baskets are the tokens of labelled URLs, with a mark as one more item where the URL is blocked. Spark's FP-growth
finds all token combinations, of any length, that enough URLs have, alone and together with the mark. A combination becomes a rule
if enough blocked URLs have it and its share of blocked ones is clearly above that of all URLs, beyond
chance; a rule is pruned if a part of it is as confident.

Tokens that all URLs have, or that exactly the same URLs have as another token, tell nothing more and would double the
combinations each, so they are left out first; a rule that could name any of several such tokens names the first of
them. Rarer tokens than the least support cannot be in a rule. The work still grows with the number of
frequent combinations, which nested tokens multiply.

Each rule is indexed under its rarest token: a URL meets only rules indexed under one of its
tokens, and fits those whose other tokens it has as well. Spark decides by size whether to broadcast the rules.

Defined results: a null or unreadable URL has an empty host and path, no tokens and no rule, and is
allowed; repeated rows are judged alike; without labels nothing is mined; extra columns are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import stored

#: Part of the host, start of the path, verdict.
EXPLICIT = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Blocked rows that a rule must be in, whatever the number of rows.
MIN_ROWS = 5
#: The least share of blocked rows of a rule, as a multiple of that of all rows; for a high share
#: of all rows, the least divisor of the share that is not blocked.
MIN_LIFT = 1.5
#: The chance that any combination at all becomes a rule if labels are dealt out at random, at most.
MAX_CHANCE = 0.05
#: The item of blocked URLs; tokens begin with a letter.
BLOCKED = "\N{WHITE SQUARE}blocked"
NUMBER = "#"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(host: Column, path: Column) -> Column:
    """The labels of the host and the parts of the path; numbers count as one token."""
    labels = F.transform(F.split(host, r"[.:]"), lambda t: F.concat(F.lit("h:"), t))
    parts = F.transform(
        F.split(F.lower(path), r"[^\p{L}\p{N}]+"),
        lambda t: F.concat(F.lit("p:"), F.regexp_replace(t, r"^[0-9]+$", NUMBER)),
    )
    return F.filter(F.array_distinct(F.concat(labels, parts)), lambda t: F.char_length(t) > 2)


def explicit_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = EXPLICIT) -> Column:
    """The longest explicit rule that fits, as a struct of its text and verdict, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for part, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == part) | host.endswith("." + part)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(part + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def mine_rules(
    labelled: DataFrame,
    tokens_col: str = "tokens",
    blocked_col: str = "blocked",
    min_rows: int = MIN_ROWS,
    min_lift: float = MIN_LIFT,
    max_chance: float = MAX_CHANCE,
) -> DataFrame:
    """Pruned rules: ``rule_tokens``, ``index_token``, ``support`` (share of blocked rows that have it) and ``confidence``.

    The chance of a share of blocked rows as high as a rule's is bounded by Chernoff, and that of any among all
    combinations by their number.
    """
    blocked = F.coalesce(F.col(blocked_col), F.lit(False)).cast("long").alias("blocked")
    items = F.array_distinct(F.array_compact(F.coalesce(tokens_col, F.array().cast("array<string>"))))
    baskets = stored(labelled.select(F.monotonically_increasing_id().alias("row_key"), items.alias("items"), blocked), "url-baskets")
    total, base = baskets.agg(F.count("*"), F.avg("blocked")).first()
    if not total or not 0 < base < 1:
        return _no_rules(labelled)
    counts = stored(_combinations(_telling(baskets, min_rows, total), min_rows, total), "url-combinations")
    tests = counts.count()
    if not tests:
        return _no_rules(labelled)
    share = F.col("confidence")
    evidence = F.col("rows") * (
        share * F.ln(share / base) + F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - base))).otherwise(0.0)
    )
    rules = (
        counts.filter(F.col("blocked") >= min_rows)
        .filter(share >= min(base * min_lift, 1 - (1 - base) / min_lift))
        .filter(evidence >= log(tests / max_chance))
        .select("rule_tokens", (F.col("blocked") / total).alias("support"), "confidence")
    )
    single = counts.filter(F.size("rule_tokens") == 1).select(F.col("rule_tokens")[0].alias("token"), "rows")
    rarest = (
        rules.select("rule_tokens", F.explode("rule_tokens").alias("token"))
        .join(single, "token")
        .groupBy("rule_tokens")
        .agg(F.min_by("token", F.struct("rows", "token")).alias("index_token"))
    )
    return prune(rules.join(rarest, "rule_tokens")).select("rule_tokens", "index_token", "support", "confidence")


def _no_rules(any_frame: DataFrame) -> DataFrame:
    schema = "rule_tokens array<string>, index_token string, support double, confidence double"
    return any_frame.sparkSession.createDataFrame([], schema)


def _telling(baskets: DataFrame, min_rows: int, total: int) -> DataFrame:
    """The baskets with one token of each set of rows that has at least ``min_rows`` of them and not all."""
    tokens = baskets.select("row_key", F.explode("items").alias("token"))
    key = F.xxhash64("row_key")
    # Two sums over hashes of the rows tell sets of rows apart.
    sets = tokens.groupBy("token").agg(
        F.count("*").alias("rows"), F.bit_xor(key).alias("x"), F.sum(key.cast("decimal(38,0)")).alias("s")
    )
    kept = sets.filter((F.col("rows") >= min_rows) & (F.col("rows") < total)).groupBy("rows", "x", "s").agg(F.min("token").alias("token"))
    of_row = tokens.join(kept.select("token"), "token").groupBy("row_key").agg(F.collect_list("token").alias("telling"))
    mark = F.when(F.col("blocked") == 1, F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>"))
    telling = F.coalesce("telling", F.array().cast("array<string>"))
    return baskets.join(of_row, "row_key", "left").select(F.concat(telling, mark).alias("items"))


def _combinations(baskets: DataFrame, min_rows: int, total: int) -> DataFrame:
    """``rule_tokens``, ``rows``, ``blocked`` and their share, of every token combination in at least ``min_rows`` rows."""
    growth = FPGrowth(itemsCol="items", minSupport=(min_rows - 0.5) / total)
    found = growth.fit(stored(baskets, "url-items")).freqItemsets
    marked = F.array_contains("items", BLOCKED)
    tokens = F.array_sort(F.array_remove("items", BLOCKED)).alias("rule_tokens")
    alone = found.filter(~marked).select(tokens, F.col("freq").alias("rows"))
    with_mark = found.filter(marked & (F.size("items") > 1)).select(tokens, F.col("freq").alias("blocked"))
    blocked = F.coalesce("blocked", F.lit(0))
    return alone.join(with_mark, "rule_tokens", "left").select(
        "rule_tokens", "rows", blocked.alias("blocked"), (blocked / F.col("rows")).alias("confidence")
    )


def prune(rules: DataFrame) -> DataFrame:
    """Leave out each rule of which a part is a rule as confident as the whole; parts are found by their index token."""
    parts = rules.select(
        "index_token", F.col("rule_tokens").alias("part"), F.col("confidence").alias("part_confidence")
    )
    better = (
        rules.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("index_token"))
        .join(parts, "index_token")
        .filter(F.size("part") < F.size("rule_tokens"))
        .filter((F.size(F.array_except("part", "rule_tokens")) == 0) & (F.col("part_confidence") >= F.col("confidence")))
    )
    return rules.join(better.select("rule_tokens").distinct(), "rule_tokens", "left_anti")


def judge(
    pages: DataFrame,
    mined: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    explicit: list[tuple[str, str, str]] = EXPLICIT,
) -> DataFrame:
    """Host, path, explicit rule and verdict of every URL.

    An explicit rule decides where one fits. Elsewhere a URL is blocked if a mined rule fits it;
    ``mined_rule`` and ``confidence`` tell the most confident one.
    """
    host, path = F.col("host"), F.col("path")
    rows = (
        pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
        .withColumns(
            {
                "row_key": F.monotonically_increasing_id(),
                "explicit": explicit_rule(host, path, explicit),
                "tokens": tokens_of(host, path),
            }
        )
        .withColumn("index_token", F.explode_outer("tokens"))
    )
    fits = F.size(F.array_except("rule_tokens", "tokens")) == 0
    hit = F.when(fits, F.struct("confidence", F.array_join("rule_tokens", " ").alias("mined_rule")))
    keys = ["row_key", id_col, "host", "path", "explicit"]
    return (
        rows.join(mined, "index_token", "left")
        .select(*keys, hit.alias("hit"))
        .groupBy("row_key")
        .agg(*[F.first(c).alias(c) for c in keys[1:]], F.max("hit").alias("hit"))
        .select(
            id_col,
            "host",
            "path",
            F.col("explicit.rule").alias("rule"),
            F.coalesce("explicit.verdict", F.when(F.col("hit").isNotNull(), "block").otherwise("allow")).alias("verdict"),
            "hit.mined_rule",
            "hit.confidence",
        )
    )


def labelled_by_document(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """Tokens and label of each page whose path names a labelled document: low quality or toxic is blocked."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(
        tokens_of(host, path).alias("tokens"),
        F.regexp_extract(path, r"^/[a-z]+/([0-9]{1,18})", 1).try_cast("long").alias("doc_id"),
    ).filter(F.col("doc_id").isNotNull())
    blocked = (F.col("quality") == 0) | (F.col("toxic") == 1)
    verdicts = labels.select("doc_id", F.coalesce(blocked, F.lit(False)).alias("blocked"))
    return rows.join(verdicts.groupBy("doc_id").agg(F.max("blocked").alias("blocked")), "doc_id")
