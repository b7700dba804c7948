"""Mixing sources to target weights by budgets on a tree of domain, language and source.

A total of tokens goes down the tree. A node's budget is shared among its children by weight; a child
that cannot use its share, because all its documents repeated ``max_epochs`` times hold fewer tokens,
leaves the rest to its siblings, and only what a whole subtree cannot use goes to the siblings of
its root. Each leaf takes a prefix of its tokens: whole epochs first, then the documents of one more
epoch in seeded order until the budget is reached, the last of them cut.

The tree is a table of one row per leaf and is never collected; it is joined by size. Seeded
order is a checksum, so it splits each leaf into 4096 even buckets: only the bucket in which the
budget ends is sorted, and a leaf with a third of all rows is no hot key.

Defined results: null names of a level count as one child of their own; documents without tokens
are never taken; rows that repeat id and text have one place in the order and are taken or left
together; an empty table gives an empty result; extra columns are kept by ``mix``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import stored

LEVELS = ("domain", "lang", "source")
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Plan:
    """Weights by path (``web/en``) or for a name under any parent (``*/en``); others weigh 1.

    ``total`` is the number of tokens to take, or None for as many as there are.
    """

    weights: dict[str, int] = field(default_factory=dict)
    total: int | None = None
    max_epochs: int = 4
    seed: int = 1


def _weight(plan: Plan, path: list[str]) -> Column:
    names = [F.coalesce(F.col(name), F.lit("")) for name in path]
    if not plan.weights:
        return F.lit(1.0)
    given = F.create_map(*[F.lit(x) for item in plan.weights.items() for x in (item[0], float(item[1]))])
    return F.coalesce(given[F.concat_ws("/", *names)], given[F.concat(F.lit("*/"), names[-1])], F.lit(1.0))


def _share(nodes: DataFrame, parent: list[str], plan: Plan, name: str) -> DataFrame:
    """Each child's budget, from its parent's ``budget``, its own ``capacity`` and its weight."""
    by = Window.partitionBy(*parent)
    upward = by.orderBy("fill", name)
    rest = upward.rowsBetween(0, Window.unboundedFollowing)
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    capacity = F.col("capacity").cast("double")
    full = capacity * F.sum("weight").over(rest) <= (
        F.col("budget").cast("double") - F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast("double")
    ) * F.col("weight")
    left = F.col("budget").cast("double") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(by).cast("double")
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(by)
    return (
        nodes.withColumn("weight", _weight(plan, [*parent, name]))
        .withColumn("fill", capacity / F.col("weight"))
        .withColumn("full", full)
        .withColumn(
            "budget",
            F.when(F.col("full"), F.col("capacity")).otherwise(F.floor(left * F.col("weight") / open_weight)).cast("long"),
        )
        .drop("weight", "fill", "full")
    )


def leaf_budgets(leaves: DataFrame, plan: Plan) -> DataFrame:
    """Add ``capacity`` and ``budget`` to one row per leaf with its ``supply`` of tokens."""
    leaves = leaves.withColumn("capacity", F.col("supply") * plan.max_epochs)
    everything = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("budget"))
    if plan.total is not None:
        everything = everything.select(F.lit(plan.total).cast("long").alias("budget"))
    budgets = None
    for depth, name in enumerate(LEVELS):
        parent = list(LEVELS[:depth])
        nodes = leaves.groupBy(*LEVELS[: depth + 1]).agg(F.sum("capacity").alias("capacity"))
        if budgets is None:
            nodes = nodes.join(everything)  # one row
        else:
            nodes = nodes.join(budgets, parent)
        budgets = _share(nodes, parent, plan, name)
        if depth < len(LEVELS) - 1:
            budgets = budgets.drop("capacity")
    return leaves.drop("capacity").join(budgets, list(LEVELS))


def order_key(plan: Plan, epoch: Column, id_col: str, text_md5: Column) -> Column:
    """The seeded place of a document in an epoch, as text in hexadecimal digits."""
    seeded = F.concat_ws(":", F.lit(str(plan.seed)), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.concat(F.md5(seeded), text_md5)


def leaf_cuts(sizes: DataFrame, plan: Plan, id_col: str = "doc_id") -> DataFrame:
    """Per leaf the whole epochs to take, and the place in the next epoch up to which to take documents.

    ``sizes`` has the three levels, ``id_col``, ``n_tokens`` and ``text_md5`` of each document.
    ``cut_key`` is the last document taken in epoch ``epochs`` and ``cut_tokens`` what is taken of it;
    both are null where the budget ends with a whole epoch.
    """
    levels = list(LEVELS)
    used = sizes.filter("n_tokens > 0")
    leaves = used.groupBy(*levels).agg(F.sum("n_tokens").alias("supply"))
    budgets = leaf_budgets(leaves, plan).select(
        *levels,
        "supply",
        "budget",
        F.floor(F.col("budget") / F.col("supply")).cast("long").alias("epochs"),
        (F.col("budget") % F.col("supply")).alias("rest"),
    )
    budgets = stored(budgets, "mix-budgets")
    keyed = (
        used.join(budgets.select(*levels, "epochs", "rest").filter("rest > 0"), levels)
        .withColumn("order_key", order_key(plan, F.col("epochs"), id_col, F.col("text_md5")))
        .withColumn("bucket", F.left(F.col("order_key"), F.lit(BUCKET_DIGITS)))
    )
    along = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        keyed.groupBy(*levels, "bucket")
        .agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
        .withColumn("before", F.coalesce(F.sum("tokens").over(along), F.lit(0)))
        .filter("before < rest AND rest <= before + tokens")
        .select(*levels, "bucket", "before")
    )
    inside = Window.partitionBy(*levels).orderBy("order_key").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        keyed.join(ends, [*levels, "bucket"])
        .withColumn("before", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .filter("before < rest AND rest <= before + n_tokens")
        .select(*levels, F.col("order_key").alias("cut_key"), (F.col("rest") - F.col("before")).alias("cut_tokens"))
    )
    return stored(budgets.join(cuts, levels, "left"), "mix-cuts")


def _taken(rows: DataFrame, cuts: DataFrame, plan: Plan, id_col: str) -> DataFrame:
    """One row per document and epoch in which it is taken, with ``take_tokens``."""
    last = F.col("mix_key") <= F.col("mix_cut_key")
    epochs = F.filter(F.sequence(F.lit(0), F.col("mix_epochs")), lambda e: (e < F.col("mix_epochs")) | F.coalesce(last, F.lit(False)))
    cut_here = (F.col("mix_epoch") == F.col("mix_epochs")) & (F.col("mix_key") == F.col("mix_cut_key"))
    limits = cuts.select(
        *[F.col(name).alias(f"mix_{name}") for name in LEVELS],
        *[F.col(name).alias(f"mix_{name}") for name in ("epochs", "cut_key", "cut_tokens")],
    )
    same = [F.col(f"leaf_{name}") == F.col(f"mix_{name}") for name in LEVELS]
    return (
        rows.filter("mix_tokens > 0")
        .join(limits, same)
        .withColumn("mix_key", order_key(plan, F.col("mix_epochs"), id_col, F.col("mix_md5")))
        .withColumn("mix_epoch", F.explode(epochs))
        .withColumn("take_tokens", F.when(cut_here, F.col("mix_cut_tokens")).otherwise(F.col("mix_tokens")))
    )


def _prepared(docs: DataFrame, domain: Column, tokens: Column, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Each document as ``row``, apart from the columns worked out here, so that no name can clash."""

    def name(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(""))

    return docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("mix_id"),
        name(domain).alias("leaf_domain"),
        name(F.col(lang_col)).alias("leaf_lang"),
        name(F.col(source_col)).alias("leaf_source"),
        F.coalesce(tokens.cast("long"), F.lit(0)).alias("mix_tokens"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("mix_md5"),
    )


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def first_words(text: Column, count: Column) -> Column:
    """``text`` up to the end of its word number ``count``, from 1, as it is written."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")


def _sizes(prepared: DataFrame) -> DataFrame:
    return prepared.select(
        "mix_id",
        *[F.col(f"leaf_{name}").alias(name) for name in LEVELS],
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_md5").alias("text_md5"),
    )


def mix(
    docs: DataFrame,
    plan: Plan,
    domain: Column,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cut: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """The documents to train on, one row for each epoch that takes it, with the columns of ``docs``.

    The text at which a leaf's budget ends is cut to the tokens that are left. Tokens other than words
    need a ``cut`` that shortens a text to a number of them. Other columns stay, also a length.
    Sizes are worked out once and stored; the texts themselves are not shuffled as long as Spark
    finds the table of leaves small enough to broadcast.
    """
    if tokens is not None and cut is None:
        raise ValueError("tokens other than words need a cut")
    cut = cut or first_words
    tokens = word_count(F.col(text_col)) if tokens is None else tokens
    prepared = _prepared(docs, domain, tokens, id_col, text_col, lang_col, source_col)
    cuts = leaf_cuts(stored(_sizes(prepared), "mix-sizes"), plan, "mix_id")
    text, count = F.col("row")[text_col], F.col("take_tokens")
    text = F.when(count < F.col("mix_tokens"), cut(text, count)).otherwise(text)
    return _taken(prepared, cuts, plan, "mix_id").select(
        *[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    )


def selection(
    docs: DataFrame,
    plan: Plan,
    domain: Column,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """What ``mix`` takes, without the texts: the leaf, the epoch and the tokens taken of each document."""
    tokens = word_count(F.col(text_col)) if tokens is None else tokens
    prepared = _prepared(docs, domain, tokens, id_col, text_col, lang_col, source_col)
    sizes = stored(_sizes(prepared), "mix-sizes")
    cuts = leaf_cuts(sizes, plan, "mix_id")
    rows = sizes.select(
        "mix_id",
        *[F.col(name).alias(f"leaf_{name}") for name in LEVELS],
        F.col("n_tokens").alias("mix_tokens"),
        F.col("text_md5").alias("mix_md5"),
    )
    return _taken(rows, cuts, plan, "mix_id").select(
        F.col("mix_id").alias(id_col),
        *[F.col(f"leaf_{name}").alias(name) for name in LEVELS],
        F.col("mix_epoch").cast("long").alias("epoch"),
        F.col("mix_tokens").alias("n_tokens"),
        "take_tokens",
    )
