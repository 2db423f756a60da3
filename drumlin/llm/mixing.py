"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

A tree of domains, languages and sources gets a token budget from the top. A node deals its budget
to its children by weight; a child that holds less than its share (its documents, repeated for
``epochs`` epochs at most) gives what it holds, and the shortage goes to its siblings by weight, and
only if none of them has room to the children of the ancestors. As a node's capacity is the sum
below it, one pass from the top does both.

A leaf reads whole epochs, then the prefix of the next one: documents in an order seeded by the
epoch, as long as the sum of their tokens stays within the leaf's budget. The prefix is found in
two levels, by bucket of the order and then within one bucket, so a leaf with a third of all rows
is many tasks; the texts are never shuffled.

Results for edge cases: null domains, languages and sources are nodes of their own; null text
counts as no token, and such documents go with any prefix; weights of 0 get nothing; ties in the
seeded order are ordered by doc_id and tokens; repeated rows stand or fall together at the cut;
with no tokens at all, no partial epoch is read; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from drumlin.llm.common import staged

LEVELS = ("domain", "lang", "source")
WIDE = DecimalType(38, 0)
#: Leading hexadecimal digits of the seeded order that name its bucket.
BUCKET = 3


def tokens(text: Column) -> Column:
    """Tokens of a text as budgeted: a quarter of its bytes, rounded up."""
    return F.coalesce(F.floor((F.octet_length(text) + 3) / 4), F.lit(0)).cast("long")


def seeded(seed: int, epoch: Column) -> Column:
    """Place of a document in the order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _same(left: str, right: str, columns: tuple[str, ...]) -> Column:
    found = F.lit(True)
    for c in columns:
        found &= F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return found


def deal(nodes: DataFrame, parent: tuple[str, ...], child: str) -> DataFrame:
    """Deals each parent's ``budget`` to its children by ``weight`` within their ``capacity``; adds ``share``.

    With children ordered by capacity over weight, those before the first that has room for its
    share of what the ones before it left are full.
    """
    ratio = F.col("capacity") / F.col("weight")
    order = W.partitionBy(*parent).orderBy(ratio, child)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    known = nodes.where("weight > 0").select("*", left.cast(WIDE).alias("_left"), weights.cast(WIDE).alias("_weights"))
    room = F.col("_left") * F.col("weight") <= F.col("capacity").cast(WIDE) * F.col("_weights")
    known = known.withColumn("_room", room)
    everyone = W.partitionBy(*parent)
    chosen = F.min(F.when(F.col("_room"), F.struct(ratio.alias("r"), F.col(child).alias("c"), F.col("_left").alias("l"), F.col("_weights").alias("w")))).over(everyone)
    level = known.withColumn("_cut", chosen).drop("_left", "_weights")
    share = F.when(
        F.col("_room") & F.col("_cut").isNotNull(),
        F.expr("cast((_cut.l * weight) div _cut.w as bigint)"),
    ).otherwise(F.col("capacity"))
    return level.withColumn("share", share).drop("_cut", "_room")


def budgets(leaves: DataFrame, budget: int, weights: dict[str, Column]) -> DataFrame:
    """``share`` of each leaf. leaves: domain, lang, source, capacity; weights: whole-number weight
    of a node by level, from the node's own columns."""
    held: DataFrame | None = None
    for depth, level in enumerate(LEVELS, 1):
        keys, above = LEVELS[:depth], LEVELS[: depth - 1]
        nodes = leaves.groupBy(*keys).agg(F.sum("capacity").cast("long").alias("capacity"))
        nodes = nodes.withColumn("weight", weights[level].cast("long"))
        if held is None:
            nodes = nodes.withColumn("budget", F.least(F.lit(budget).cast("long"), F.sum("capacity").over(W.partitionBy())))
        else:
            nodes = (
                nodes.alias("a")
                .join(held.select(*above, F.col("share").alias("budget")).alias("b"), _same("a", "b", above))
                .select("a.*", "b.budget")
            )
        held = deal(nodes, above, level)
    return held


def mix(
    docs: DataFrame,
    *,
    domain: Column,
    weights: dict[str, Column],
    budget: Column,
    epochs: int = 2,
    seed: int = 11,
) -> DataFrame:
    """The rows drawn for the budget, with ``epoch`` (0, 1, ...): a row stands once for each epoch
    it is read in. Needs doc_id, text, lang, source. budget: tokens to draw, from ``total``."""
    names = [c for c in docs.columns if c != "epoch"]
    held = docs.select(
        domain.alias("domain"), "lang", "source", "doc_id", tokens(F.col("text")).alias("tokens")
    )
    leaves = staged(held.groupBy(*LEVELS).agg(F.sum("tokens").cast("long").alias("held")), "mix-leaves")
    total = leaves.agg(F.coalesce(F.sum("held"), F.lit(0)).alias("total")).select(budget.cast("long")).first()[0]
    shares = budgets(leaves.withColumn("capacity", F.col("held") * epochs), total, weights)
    plan = staged(
        shares.alias("a")
        .join(leaves.alias("b"), _same("a", "b", LEVELS))
        .select("a.domain", "a.lang", "a.source", "share", "held")
        .withColumn("whole", F.when(F.col("held") > 0, F.expr("share div held")).otherwise(F.lit(0)).cast("int"))
        .withColumn("rest", F.col("share") - F.col("whole") * F.col("held")),
        "mix-plan",
    )
    # The prefix: buckets of the seeded order that fit as a whole, then rows of the bucket after them.
    placed = (
        held.alias("a")
        .join(plan.alias("b"), _same("a", "b", LEVELS))
        .select("a.domain", "a.lang", "a.source", "doc_id", "tokens", "whole", "rest")
        .withColumn("place", seeded(seed, F.col("whole")))
        .withColumn("bucket", F.substring("place", 1, BUCKET))
    )
    buckets = placed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = F.sum("tokens").over(W.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    cut = (
        buckets.withColumn("upto", upto)
        .where(F.col("upto") > F.col("rest"))
        .groupBy(*LEVELS)
        .agg(F.min_by(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "bucket").alias("cut"))
        .select(*LEVELS, "cut.bucket", "cut.left")
    )
    cut = staged(cut, "mix-cut")
    edge = (
        placed.alias("a")
        .join(cut.alias("b"), _same("a", "b", (*LEVELS, "bucket")))
        .select("a.domain", "a.lang", "a.source", "a.bucket", "a.place", "a.doc_id", "a.tokens", "b.left")
    )
    running = F.sum("tokens").over(W.partitionBy(*LEVELS, "bucket").orderBy("place", "doc_id", "tokens"))
    over = (
        edge.withColumn("running", running)
        .where(F.col("running") > F.col("left"))
        .groupBy(*LEVELS, "bucket")
        .agg(F.min(F.struct("place", "doc_id", "tokens")).alias("stop"))
    )
    stops = plan.alias("a").join(over.alias("b"), _same("a", "b", LEVELS), "left").select("a.*", "b.stop")
    stops = staged(stops, "mix-stops")

    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        domain.alias("domain"), "lang", "source", "doc_id", tokens(F.col("text")).alias("tokens"),
    )
    place = F.struct(seeded(seed, F.col("whole")).alias("place"), F.col("doc_id"), F.col("a.tokens").alias("tokens"))
    partial = (F.col("rest") > 0) & (F.col("stop").isNull() | (place < F.col("stop")))
    read = F.col("whole") + F.when(partial, 1).otherwise(0)
    return (
        own.alias("a")
        .join(stops.alias("b"), _same("a", "b", LEVELS))
        .select("_row", read.alias("_read"))
        .where("_read > 0")
        .select("_row.*", F.explode(F.sequence(F.lit(0), F.col("_read") - 1)).alias("epoch"))
    )


def registered(docs: DataFrame) -> DataFrame:
    """The registered mix: three quarters of all tokens; the smaller domain and English weigh more."""
    books = F.col("source").isin("src1", "src2", "src3", "src4", "src5", "src6")
    weights = {
        "domain": F.when(F.col("domain") == "books", 40).otherwise(60),
        "lang": F.when(F.col("lang") == "en", 2).otherwise(1),
        "source": F.lit(1),
    }
    return mix(
        docs,
        domain=F.when(books, "books").otherwise("web"),
        weights=weights,
        budget=F.expr("total * 3 div 4"),
    )
