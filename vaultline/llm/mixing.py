"""Mixing sources to target weights: hierarchical token budgets, filled from seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.tables import WORD, written

LEVELS = ["mix_domain", "mix_lang", "mix_source"]
BUCKET_ROWS = 4096  # documents of a leaf in one slice of its order, about
KEY_BITS = 60
ADDED = ["epoch", "n_tokens", "taken_tokens"]


def _ratio(top: Column, bottom: Column) -> Column:
    """Their quotient, or 0 above nothing."""
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _water_filled(nodes: DataFrame, parents: list[str], node: str) -> DataFrame:
    """Adds ``share``: the parent's ``budget`` by weight, none above a node's ``capacity``.

    What a node cannot use rises the level for its siblings. In order of capacity by weight, the level
    that fills the rest is highest at the first node that it does not fill, so its maximum is the level.
    Nodes of weight 0 have no capacity; siblings that all have weight 0 have no level.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ranked = siblings.orderBy(_ratio(F.col("capacity"), F.col("weight")), node)
    before = F.coalesce(F.sum("capacity").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
    level = _ratio(F.col("budget") - before, left).alias("level")
    highest = F.max("level").over(siblings)
    share = F.least(F.col("capacity"), F.floor(highest * F.col("weight")))
    return nodes.select("*", level).withColumn("share", F.greatest(share, F.lit(0))).drop("level")


def leaf_budgets(leaves: DataFrame, weights: list[Column], percent: int, epochs: int) -> DataFrame:
    """``leaves`` (the levels, tokens, docs) with ``budget``: tokens to take from each.

    weights: whole numbers of at least 0 for a domain, a language in its domain and a source in both, over
    the level columns. The whole budget is ``percent`` of all tokens. A subtree's capacity is ``epochs``
    times its tokens, so a shortage goes to the siblings below the same parent first, and only what a whole
    subtree cannot use goes to its parent's siblings. Rounding down loses less than one token for each node.
    """
    zero = F.least(*(F.coalesce(w.cast("long"), F.lit(0)) for w in weights)) <= 0
    budgets = leaves.withColumn("capacity", F.when(zero, 0).otherwise(F.col("tokens") * epochs))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    above = None
    for depth, weight in enumerate(weights):
        parents, keys = LEVELS[:depth], LEVELS[: depth + 1]
        nodes = budgets.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", F.greatest(F.coalesce(weight.cast("long"), F.lit(0)), F.lit(0)))
        given = nodes.join(above, parents) if depth else nodes.withColumn("budget", F.lit(total * percent // 100))
        above = _water_filled(given, parents, keys[-1]).select(*keys, F.col("share").alias("budget"))
    return leaves.join(above, LEVELS)


def mix_sources(
    docs: DataFrame, domain: Column, weights: list[Column], percent: int = 60, epochs: int = 3, seed: int = 1
) -> DataFrame:
    """The documents chosen for a training set: the columns of ``docs`` (doc_id, text, lang, source, any
    others) with ``epoch`` (from 1), ``n_tokens`` (words of the text) and ``taken_tokens``; columns of
    these names are replaced.

    domain: an expression over the columns of ``docs``; for ``weights``, ``percent`` and ``epochs`` see
    leaf_budgets. Each leaf's budget is a prefix of its token stream: whole epochs, each with all documents
    once, then the first documents of the next epoch in its seeded order; the last of them may count in
    part, by taken_tokens. The order is cut into slices whose sizes are summed first, and only the slice
    that holds the end of the prefix is sorted, so a leaf with a third of all rows is never in one task.

    A null domain, language or source is the node ''. Null and empty texts have no tokens; they are taken
    along by the epochs that reach them. A leaf without tokens gives nothing. Rows that share a doc_id are
    next to each other in the order, those with fewer tokens first. An empty table gives no rows.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    levels = [F.coalesce(c.cast("string"), F.lit("")) for c in (domain, F.col("lang"), F.col("source"))]
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("string").alias("mix_id"),
        words.alias("mix_tokens"),
        *(c.alias(name) for c, name in zip(levels, LEVELS)),
    )
    leaves = rows.groupBy(*LEVELS).agg(F.sum("mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    plan = written(
        leaf_budgets(written(leaves, "mix-leaves"), weights, percent, epochs)
        .where("tokens > 0 and budget > 0")
        .select(
            *LEVELS,
            F.expr("budget div tokens").alias("whole"),
            F.expr("budget % tokens").alias("rest"),
            F.expr(f"greatest(0, cast(ceil(log2(docs / {BUCKET_ROWS})) as int))").alias("slice_bits"),
        ),
        "mix-plan",
    )
    name = F.concat_ws(":", F.lit(str(seed)), (F.col("whole") + 1).cast("string"), "mix_id")
    planned = (
        rows.join(plan, LEVELS)
        .withColumn("place", F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long"))
        .withColumn("slice", F.expr(f"shiftright(place, {KEY_BITS} - slice_bits)"))
    )
    sums = planned.where("rest > 0").groupBy(*LEVELS, "slice", "rest").agg(F.sum("mix_tokens").alias("sum"))
    running = F.sum("sum").over(Window.partitionBy(*LEVELS).orderBy("slice"))
    ends = written(
        sums.withColumn("until", running)
        .where("until - sum < rest and until >= rest")
        .select(*LEVELS, F.col("slice").alias("end_slice"), F.expr("rest - (until - sum)").alias("end_rest")),
        "mix-ends",
    )
    placed = planned.join(ends, LEVELS, "left")
    full = F.expr("transform(sequence(0, whole), e -> e + 1)")
    kept = F.when(F.col("slice") < F.col("end_slice"), full).otherwise(F.slice(full, F.lit(1), F.col("whole").cast("int")))
    all_taken = placed.select("row", "mix_tokens", F.explode(kept).alias("mix_epoch"), F.col("mix_tokens").alias("mix_taken"))
    order = Window.partitionBy(*LEVELS).orderBy("place", "mix_id", "mix_tokens")
    before = F.coalesce(F.sum("mix_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (
        placed.where(F.col("slice") == F.col("end_slice"))
        .withColumn("before", before)
        .where("before < end_rest")
        .select(
            "row",
            "mix_tokens",
            (F.col("whole") + 1).alias("mix_epoch"),
            F.least("mix_tokens", F.col("end_rest") - F.col("before")).alias("mix_taken"),
        )
    )
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED]
    added = (F.col(c).alias(name) for c, name in zip(("mix_epoch", "mix_tokens", "mix_taken"), ADDED))
    return all_taken.unionByName(last).select(*own, *added)
