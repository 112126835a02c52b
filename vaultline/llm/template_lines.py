"""Line dedup by a log-template tree: lines whose template recurs across documents are dropped."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.spans import chunks, mix, span_hashes, word_spans
from vaultline.llm.tables import BUCKETS, near_keys, written

WHITE = r"[\x20\x09-\x0D]+"
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"  # a token with a digit
FIELD = "<*>"
ODD = np.uint64(0x9E3779B97F4A7C15)
DEPTH = 4  # leading tokens that, after the token count, lead down the tree
MIN_TOKENS = 4  # shorter lines recur by chance
MIN_EQUAL = 6  # tokens that a line must have in common with a template that it isn't equal to
SIMILAR = 80  # per cent of them
HEADS, MOST_HEADS = 16, 256  # lines of a leaf that one round settles: at first, and after doubling
ADDED = ["n_lines", "n_dropped"]


def _indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``doc_id, place, leaf, content`` of all lines with enough tokens; a token with a digit is a field."""
    for frame in frames:
        texts = frame["text"].tolist()
        for part in chunks(texts):
            encoded = [(t or "").encode("utf-8", "surrogatepass") + b"\n" for t in texts[part]]
            buffer = np.frombuffer(b"".join(encoded), dtype=np.uint8)
            line_ends = np.flatnonzero(buffer == 10)
            bounds = np.searchsorted(line_ends, np.cumsum([0, *(len(e) for e in encoded)]))
            starts, ends = word_spans(buffer)
            tokens = span_hashes(buffer, starts, ends)
            digits = np.concatenate([[0], np.cumsum((buffer >= ord("0")) & (buffer <= ord("9")))])
            tokens[digits[ends] > digits[starts]] = 0
            line_of = np.searchsorted(line_ends, starts)
            count = np.bincount(line_of, minlength=len(line_ends))
            first = np.cumsum(count) - count
            within = (np.arange(len(tokens)) - first[line_of]).astype(np.uint64)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens + within * ODD), dtype=np.uint64)])
            lines = np.flatnonzero(count >= MIN_TOKENS)
            size = count[lines].astype(np.uint64)
            leaf = size
            for k in range(DEPTH):
                leaf = mix(leaf * ODD + tokens[first[lines] + k])
            content = mix(sums[first[lines] + count[lines]] - sums[first[lines]] + size)
            document = np.searchsorted(bounds, lines, side="right") - 1
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].iloc[part].to_numpy()[document],
                    "place": lines - bounds[document],
                    "leaf": leaf.view(np.int64),
                    "content": content.view(np.int64),
                }
            )


def _alike(one: Column, two: Column) -> Column:
    """Whether masked lines of one leaf share a template."""
    ours, theirs = F.split(one, " "), F.split(two, " ")
    equal = F.size(F.filter(F.zip_with(ours, theirs, lambda x, y: x == y), lambda x: x))
    return (equal >= MIN_EQUAL) & (100 * equal >= SIMILAR * F.size(ours))


def _with_partners(lines: DataFrame) -> DataFrame:
    """Without lines that surely no other of their leaf is like.

    The tokens after those that lead to the leaf are cut into one part more than a template has free
    places, so lines that are alike agree in one part at least.
    """
    free = f"((100 - {SIMILAR}) * size(tokens) div 100)"
    rest = f"(size(tokens) - {DEPTH})"
    start, end = (f"cast({k} * {rest} div ({free} + 1) as int)" for k in ("k", "(k + 1)"))
    parts = f"transform(sequence(0, cast({free} as int)), k -> xxhash64(k, slice(tokens, {DEPTH} + 1 + {start}, {end} - {start})))"
    long_ = lines.withColumn("tokens", F.split("masked", " ")).where(F.size("tokens") >= MIN_EQUAL)
    keys = long_.select("leaf", "content", F.explode(F.expr(parts)).alias("part"))
    several = keys.groupBy("leaf", "part").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    partners = keys.join(several.where("low != high"), ["leaf", "part"], "left_semi").select("content")
    return long_.drop("tokens").join(partners, "content", "left_semi")


def _learnt(contents: DataFrame, docs: DataFrame) -> DataFrame:
    """``content, template`` for the lines that may share a template with free fields.

    In each leaf the line that most documents have becomes a template, and takes in the lines that agree
    with it in most places; then again for those that are left, until none is. A round settles the first
    HEADS lines of each leaf, in the same order as one by one, and all lines that are like one of them.
    """
    leaves = contents.groupBy("leaf").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    leaves = written(leaves.where("low != high").select("leaf"), "line-leaves")
    several = near_keys(contents, ["leaf"], leaves).join(leaves, "leaf", "left_semi")
    several = several.select(F.col("at.doc_id").alias("doc_id"), F.col("at.place").alias("place"), "leaf", "content", "n")
    masked = F.regexp_replace(F.regexp_replace("line", f"^{WHITE}|{WHITE}$", ""), VARIABLE, FIELD)
    several = written(several, "line-several")
    split = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    texts = (
        near_keys(split, ["doc_id", "place"], several)
        .join(several, ["doc_id", "place"])
        .select("leaf", "content", "n", F.regexp_replace(masked, WHITE, " ").alias("masked"))
    )
    left = written(texts.dropDuplicates(["content"]), "line-texts")
    found = left.select("content", F.col("content").alias("template")).limit(0)
    size = HEADS
    while True:
        left = written(_with_partners(left), "line-left")
        if left.isEmpty():
            return found
        order = Window.partitionBy("leaf").orderBy(F.desc("n"), F.desc("content"))
        first = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
        ranked = first.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("rank", "content", "masked"))).alias("lines"))
        none = F.slice("lines", 1, 0)
        heads = F.aggregate(
            "lines",
            none,
            lambda taken, line: F.when(
                F.exists(taken, lambda head: _alike(head["masked"], line["masked"])), taken
            ).otherwise(F.concat(taken, F.array(line))),
        )
        heads = written(ranked.select("leaf", heads.alias("heads")), "line-heads")
        own = F.filter("heads", lambda head: (head["content"] == F.col("content")) | _alike(head["masked"], F.col("masked")))
        compared = written(
            left.join(heads, "leaf").select("leaf", "content", "n", "masked", F.get(own, F.lit(0))["content"].alias("template")),
            "line-templates",
        )
        found = found.unionByName(compared.where("template is not null").select("content", "template"))
        left = compared.where("template is null").drop("template")
        size = min(2 * size, MOST_HEADS)


def drop_recurring_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, any others), ``text`` without the lines that recur, with
    ``n_lines`` and ``n_dropped`` (long); columns of these names are replaced.

    The tree: tokens with a digit are fields; below the number of tokens, the first DEPTH tokens lead to a
    leaf; in a leaf a line belongs to a template that it equals in SIMILAR per cent of the places and at
    least MIN_EQUAL of them. A template found in two or more documents recurs: the document with the
    smallest doc_id keeps its lines, all others lose them, so every passage stays in the corpus once.
    Lines of fewer than MIN_TOKENS tokens never count. No task holds the lines of a leaf: they are counted
    by content first, and compared with one template each.

    A document that loses all lines has an empty text. Null and empty texts stay as they are, as do rows
    with a null doc_id, which also count for nothing. Rows that share a doc_id are one document. A line
    that is repeated within one document only stays. An empty table gives no rows.
    """
    whole = docs.where("doc_id is not null").selectExpr("cast(doc_id as long) doc_id", "text")
    index = written(whole.mapInPandas(_indexed, "doc_id long, place int, leaf long, content long"), "line-index")
    contents = written(
        index.groupBy("leaf", "content").agg(
            F.min(F.struct("doc_id", "place")).alias("at"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")
        ),
        "line-contents",
    )
    learnt = written(_learnt(contents, whole), "line-learnt")
    spans = contents.select("content", F.col("at.doc_id").alias("lo"), "hi")
    named = written(near_keys(spans, ["content"], learnt).join(learnt, "content"), "line-named")
    templates = named.groupBy("template").agg(F.min("lo").alias("first_doc"), F.max("hi").alias("last_doc"))
    shared = named.join(templates.where("first_doc != last_doc"), "template").where("not (lo = hi and lo = first_doc)")
    alone = spans.where("lo != hi").join(named.select("content"), "content", "left_anti")
    recurring = written(
        shared.select("content", "first_doc").unionByName(alone.select("content", F.col("lo").alias("first_doc"))),
        "line-recurring",
    )
    dropped = (
        near_keys(index.select("doc_id", "place", "content"), ["content"], recurring)
        .join(recurring, "content")
        .where("doc_id != first_doc")
        .groupBy("doc_id")
        .agg(F.collect_set("place").alias("places"))
        .select(F.col("doc_id").alias("line_doc"), "places")
    )
    drops = written(dropped, "line-drops")
    # Texts that surely keep all their lines need no shuffle.
    bucket = F.pmod(F.xxhash64("line_doc"), F.lit(BUCKETS))
    taken = F.broadcast(drops.select(bucket.alias("bucket")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("line_doc"))
    # The drops grow with the corpus, so they are joined in the same way at every size.
    touched = rows.join(taken, bucket == taken["bucket"], "left_semi").join(drops.hint("merge"), "line_doc", "left")
    others = rows.join(taken, bucket == taken["bucket"], "left_anti")
    joined = touched.select("row", "places").unionByName(
        others.select("row", F.lit(None).cast("array<int>").alias("places"))
    )
    split = F.split(F.col("row.text"), "\n")
    kept = F.filter(split, lambda line, place: ~F.array_contains("places", place))
    lost = F.col("places").isNotNull()
    # In a step of its own, as the columns of docs may have any names.
    cleaned = joined.select(
        "row",
        F.when(lost, F.array_join(kept, "\n")).otherwise(F.col("row.text")).alias("line_text"),
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("line_count"),
        F.when(lost, F.size(split) - F.size(kept)).otherwise(0).cast("long").alias("line_lost"),
    )
    own = [
        F.col("line_text").alias(c) if c == "text" else F.col("row").getField(c).alias(c)
        for c in docs.columns
        if c not in ADDED
    ]
    return cleaned.select(*own, *(F.col(c).alias(name) for c, name in zip(("line_count", "line_lost"), ADDED)))
