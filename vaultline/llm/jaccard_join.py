"""Near-duplicate documents by the Jaccard similarity of their word shingles, by multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.components import components
from vaultline.llm.spans import Words, chunks, mix, windows
from vaultline.llm.tables import written

WIDTH = 5
PERCENT = 80
SKETCH_BITS = 48  # of a shingle's hash in the first, coarse step; more bits pass fewer documents on
BUCKETS = 1 << 20  # bound of the broadcast filter on document ids


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, without words none."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    runs = windows(hashes, width).view(np.int64)
    sets = []
    for start, end in zip(words.first[:-1], words.first[1:]):
        if end - start >= width:
            sets.append(np.unique(runs[start : end - width + 1]))
        else:
            sets.append(windows(hashes[start:end], end - start).view(np.int64) if end > start else runs[:0])
    return sets


def _needed(n, percent: int):
    """How many of n shingles any partner must share."""
    return (percent * n + 99) // 100


def _sketch_size(n, percent: int):
    """The one-match prefix and an eighth more, so that several shingles of it must be shared."""
    first = n - _needed(n, percent) + 1
    return first + first // 8 + 4


def _sketches(width: int, percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for part in chunks(texts):
                rows = []
                for shingles in shingle_sets(texts[part], width):
                    n, bits = len(shingles), shingles.view(np.uint64)
                    prefix = (bits >> np.uint64(64 - SKETCH_BITS)).view(np.int64)
                    prefix = np.sort(prefix)[: _sketch_size(n, percent)]
                    one = bits.sum(dtype=np.uint64).view(np.int64)
                    two = np.bitwise_xor.reduce(mix(bits)).view(np.int64) if n else np.int64(0)
                    rows.append((n, int(one), int(two), prefix))
                out = pd.DataFrame(rows, columns=["n", "one", "two", "prefix"])
                out.insert(0, "doc_id", frame["doc_id"].iloc[part].to_numpy())
                yield out

    return run


def _sets(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for part in chunks(texts):
                yield pd.DataFrame(
                    {"rep": frame["doc_id"].iloc[part].to_numpy(), "shingles": shingle_sets(texts[part], width)}
                )

    return run


def _similar(shared: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n + m - shared)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link. Each pair is judged by the whole sets of both documents."""
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"))
    same = F.size(F.array_intersect("shared_a", "shared_b"))
    return (
        pairs.join(one, "a").join(two, "b").where(_similar(same, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")
    )


def _family(sketches: DataFrame, percent: int) -> DataFrame:
    """``rep``: the documents that may have a partner at all.

    Of the smallest shingle hashes of a document, all but as many as a partner may lack must occur in
    another document too. A clash of shortened hashes only lets more documents through.
    """
    tokens = sketches.select("doc_id", "n", F.explode("prefix").alias("token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token")
    most = F.least(F.expr(str(_sketch_size_sql(percent))), F.col("n"))
    lacking = F.col("n") - F.expr(_needed_sql(percent))
    return (
        tokens.join(common, "token", "left_semi")
        .groupBy("doc_id", "n")
        .agg(F.count(F.lit(1)).alias("shared"))
        .where(F.col("shared") >= most - lacking)
        .select(F.col("doc_id").alias("rep"))
    )


def _needed_sql(percent: int) -> str:
    return f"(({percent} * n + 99) div 100)"


def _sketch_size_sql(percent: int) -> str:
    first = f"(n - {_needed_sql(percent)} + 1)"
    return f"({first} + {first} div 8 + 4)"


def _shared_sets(docs: DataFrame, family: DataFrame, width: int, percent: int) -> DataFrame:
    """``rep, n, lonely, shared``: shingles that another document of the family has, rarest first.

    lonely: how many shingles no other document has. With too many of them there is no partner.
    """
    buckets = family.select(F.expr(f"pmod(xxhash64(rep), {BUCKETS})").alias("bucket")).distinct()
    texts = (
        docs.join(F.broadcast(buckets), F.expr(f"pmod(xxhash64(doc_id), {BUCKETS})") == buckets["bucket"], "left_semi")
        .join(family, docs["doc_id"] == family["rep"], "left_semi")
        .select("doc_id", "text")
    )
    sets = written(texts.mapInPandas(_sets(width), "rep long, shingles array<long>"), "shingle-sets")
    tokens = sets.select("rep", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).cast("int").alias("df")).where("df > 1")
    listed = (
        tokens.join(counts, "token")
        .groupBy("rep", "n")
        .agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("found"))
    )
    return written(
        listed.select(
            "rep",
            "n",
            (F.col("n") - F.size("found")).alias("lonely"),
            F.col("found.token").alias("shared"),
            F.col("found.df").alias("dfs"),
        ).where(f"lonely <= n - {_needed_sql(percent)}"),
        "shared-shingles",
    )


def _prefixes(percent: int, index_cost: float = 1.0, verify_cost: float = 8.0, most: int = 16):
    """Adds ``matches``, how many shared shingles a document asks for, and the prefix that belongs to it.

    With a prefix longer by one shingle a partner must share one more of them. Longer prefixes cost more
    rows in the index and leave fewer candidates; the estimate weighs both by document frequencies.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            matches, prefixes = [], []
            for n, lonely, shared, dfs in zip(frame["n"], frame["lonely"], frame["shared"], frame["dfs"]):
                first = int(n - _needed(n, percent) + 1 - lonely)
                last = min(len(shared), first + most - 1)
                rows = np.cumsum(np.asarray(dfs[:last], dtype=float))
                asked = np.arange(1, last - first + 2)
                cost = index_cost * rows[first - 1 :] + verify_cost * rows[first - 1 :] / asked
                ask = int(asked[int(np.argmin(cost))]) if len(asked) else 1
                matches.append(ask)
                prefixes.append(shared[: first + ask - 1])
            yield pd.DataFrame(
                {"rep": frame["rep"], "n": frame["n"], "lonely": frame["lonely"], "matches": matches, "prefix": prefixes}
            )

    return run


def _candidates(index: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """``a, b``: first the pairs of each document with the best pivot of its lists, then, given the
    components of these, all pairs of different components that pass the prefix test."""
    tokens = index.select("rep", "n", "lonely", F.posexplode("prefix").alias("place", "token"))
    if labels is None:
        # The document with the fewest shingles of its own stands in the middle of its copies.
        pivots = tokens.groupBy("token").agg(
            F.min(F.struct(F.expr("lonely / n").alias("own"), "rep")).alias("pivot"), F.count(F.lit(1)).alias("df")
        )
        near = tokens.join(pivots.where("df > 1").select("token", F.col("pivot.rep").alias("pivot")), "token")
        counted = near.where("pivot != rep").groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("met"))
        best = counted.groupBy("rep").agg(F.max(F.struct("met", (-F.col("pivot")).alias("low"))).alias("best"))
        return best.select(F.col("rep").alias("a"), (-F.col("best.low")).alias("b"))
    tokens = tokens.join(labels, tokens["rep"] == labels["id"], "left").select(
        "token", "rep", "place", F.coalesce("component", "rep").alias("component")
    )
    mixed = tokens.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = tokens.join(mixed.where("low != high").select("token"), "token", "left_semi")
    left_over = (F.col("n") - F.col("lonely") - F.col("place")).alias("left_over")  # this shingle and all later ones
    rows = rows.join(index, "rep").select("token", "component", "rep", "n", left_over, "matches", "prefix")
    left, right = (rows.select("token", *(F.col(c).alias(c + s) for c in rows.columns[1:])) for s in ("_a", "_b"))
    may_share = F.least("left_over_a", "left_over_b")  # if this is the first shingle that both have
    met = F.array_intersect("prefix_a", "prefix_b")
    return (
        left.join(right, "token")
        .where((F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b")))
        .where(_similar(may_share, F.col("n_a"), F.col("n_b"), percent))
        .where((F.size(met) >= F.least("matches_a", "matches_b")) & (F.get(met, F.lit(0)) == F.col("token")))
        .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    )


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs`` (doc_id, text; other columns are not read).

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their distinct shingles of ``width``
    lower-cased (A-Z) words; ``component_id`` is the smallest doc_id that links reach. No link that joins
    two components is missed, and none is made below the threshold:

    1. Copies fold: documents with the same set stand behind the smallest id.
    2. A sketch, the smallest hashes of each set, drops every document that too few others share.
    3. For the rest, shingles are ordered rarest first, and each document picks the length of its prefix by
       estimated cost; a longer one asks for more shared shingles.
    4. Each document is compared with the best pivot of its lists; then, across the components found so
       far, every pair of a list that shares enough of the prefixes. Pairs within a component need no
       comparison, so a large group of copies costs about one comparison for each member.

    Empty and null texts have an empty set and link with nothing. Rows with a null doc_id link with nothing
    and have a null component. Rows that share a doc_id stand for one document, which folds with others by the
    largest of their sets; each row keeps its own n_shingles. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = written(
        docs.mapInPandas(_sketches(width, percent), "doc_id long, n long, one long, two long, prefix array<long>"),
        "shingle-sketches",
    )
    usable = sketches.where("n > 0 and doc_id is not null")
    documents = usable.groupBy("doc_id").agg(F.max(F.struct("n", "one", "two")).alias("content"))
    classes = documents.groupBy("content").agg(F.min("doc_id").alias("rep"))
    members = written(documents.join(classes, "content").select("doc_id", "content", "rep"), "shingle-classes")
    copies = members.where("doc_id != rep").select("doc_id")
    firsts = usable.join(copies, "doc_id", "left_anti")
    family = written(_family(firsts, percent), "shingle-family")
    sets = _shared_sets(docs, family, width, percent)
    index = written(
        sets.mapInPandas(_prefixes(percent), "rep long, n long, lonely long, matches int, prefix array<long>"),
        "shingle-prefixes",
    )
    links = written(_verified(_candidates(index, None, percent), sets, percent), "shingle-links")
    labels = written(components(links, "a", "b"), "shingle-components")
    rest = written(_verified(_candidates(index, labels, percent), sets, percent), "shingle-links")
    if not rest.isEmpty():
        labels = written(components(links.unionByName(rest), "a", "b"), "shingle-components")
    found = members.join(labels, members["rep"] == labels["id"], "left").select(
        "doc_id", F.coalesce("component", "rep").alias("found")
    )
    return sketches.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id")
    )
