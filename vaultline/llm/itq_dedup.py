"""Near-duplicate vectors: balanced binary codes by iterative quantisation, multi-index Hamming tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.components import components
from vaultline.llm.tables import written

BITS = 64
TABLE_BITS = (11, 11, 11, 11, 10, 10)  # of the substrings that the tables hold
RADIUS = 16  # bits of a code in which pairs may differ, for lengths of vectors that the sample lacks
FOUND = 0.98  # of the sample's pairs at the threshold must be found
MOST_CODES = 24  # more codes than these cost more than comparing all pairs
SAMPLE = 4096  # vectors that the rotations are learnt from
TRIED = 2048  # of them that get a partner at the threshold
ROUNDS = 40
SEED = 7


def _masks() -> list[int]:
    """The bits of each substring, as signed 64-bit numbers."""
    masks, start = [], 0
    for size in TABLE_BITS:
        mask = ((1 << size) - 1) << start
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
        start += size
    return masks


def rotation(vectors: np.ndarray, rounds: int = ROUNDS, draw: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection whose signs are the code: principal axes, turned until they suit signs.

    With fewer dimensions than bits, or too few vectors, the axes are seeded random ones, as for all further draws.
    """
    count, size = vectors.shape
    random = np.random.default_rng([SEED, size, draw] if draw else [SEED, size])
    if count < 2 * BITS:
        return np.zeros(size), random.standard_normal((size, BITS))
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    if size < BITS or draw:
        axes = random.standard_normal((size, BITS))
    else:
        axes = np.linalg.svd(centred, full_matrices=False)[2][:BITS].T
    projected = centred @ axes
    turn = np.linalg.qr(random.standard_normal((axes.shape[1], axes.shape[1])))[0]
    for _ in range(rounds):
        signs = np.where(projected @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(projected.T @ signs)
        turn = left @ right
    return mean, axes @ turn


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _by_size(column: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and vectors, for each length of vector."""
    sizes = column.map(len).to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, np.stack(column.iloc[rows].to_numpy()).astype(np.float64)


@dataclass
class Codes:
    """mean, axes: of each code; radius: bits of all codes in which a pair may differ; exact: whether the codes
    would lose too many pairs at the threshold, so that all pairs are compared."""

    mean: np.ndarray
    axes: list[np.ndarray]
    radius: int
    exact: bool = False

    def of(self, vectors: np.ndarray) -> list[np.ndarray]:
        powers = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        return [((vectors - self.mean) @ axes >= 0) @ powers for axes in self.axes]


def _partners(vectors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Sample vectors, and for each one that lies at the threshold from it.

    The partner's way off the sample's mean is turned towards the difference of two others, so what all
    vectors have in common stays common.
    """
    random = np.random.default_rng([SEED, 1])
    a = vectors[random.permutation(len(vectors))[:TRIED]]
    mean = vectors.mean(axis=0)
    own = a - mean
    other = vectors[random.integers(0, len(vectors), len(a))] - vectors[random.integers(0, len(vectors), len(a))]
    size = (own * own).sum(axis=1, keepdims=True)
    other = other - own * (other * own).sum(axis=1, keepdims=True) / np.maximum(size, 1e-300)
    length = np.linalg.norm(other, axis=1, keepdims=True)
    usable = ((length > 1e-9) & (size > 1e-18)).ravel()
    a, own, size = a[usable], own[usable], size[usable]
    other = other[usable] / length[usable] * np.sqrt(size)
    low, high = np.zeros((len(a), 1)), np.ones((len(a), 1))
    for _ in range(40):
        share = (low + high) / 2
        b = _unit(mean + share * own + np.sqrt(1 - share * share) * other)
        near = (a * b).sum(axis=1, keepdims=True) >= threshold
        low, high = np.where(near, low, share), np.where(near, share, high)
    return a, _unit(mean + high * own + np.sqrt(1 - high * high) * other)


def _linked(vectors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The sample's own pairs that are close to the threshold."""
    top = (1 + threshold) / 2
    found = []
    for start in range(0, len(vectors), 512):
        cosines = vectors[start : start + 512] @ vectors.T
        one, two = np.nonzero((cosines >= threshold) & (cosines < top))
        one += start
        some = np.column_stack([one, two])[one < two]
        found.append(np.random.default_rng([SEED, 2, start]).permutation(some)[:TRIED])
    pairs = np.concatenate(found)
    pairs = np.random.default_rng([SEED, 2]).permutation(pairs)[:TRIED]
    return vectors[pairs[:, 0]], vectors[pairs[:, 1]]


def _apart(codes: Codes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits in which pairs differ, and whether a table holds them."""
    total, held = np.zeros(len(a), dtype=int), np.zeros(len(a), dtype=bool)
    for one, two in zip(codes.of(a), codes.of(b)):
        total += np.bitwise_count(one ^ two)
        for mask in _masks():
            held |= np.bitwise_count((one ^ two) & np.uint64(mask % (1 << 64))) <= 1
    return total, held


def found_share(codes: Codes, a: np.ndarray, b: np.ndarray) -> float:
    total, held = _apart(codes, a, b)
    return float((held & (total <= codes.radius)).mean()) if len(a) else 1.0


def fitted(vectors: np.ndarray, threshold: float, least: int = 1) -> Codes:
    """So many codes, ``least`` or more, that pairs of unit ``vectors`` at the threshold are found."""
    pairs = [_partners(vectors, threshold)]
    linked = _linked(vectors, threshold)
    if len(linked[0]) >= 100:
        pairs.append(linked)
    codes = None
    for draw in range(max(least, MOST_CODES)):
        mean, axes = rotation(vectors, draw=draw)
        codes = Codes(mean, [*(codes.axes if codes else []), axes], 0)
        if draw + 1 < least:
            continue
        # A few vectors say little about how far codes of others may differ.
        codes.radius = RADIUS * (draw + 1) if len(vectors) < 2 * BITS else 0
        codes.radius = max(codes.radius, *(int(np.quantile(_apart(codes, a, b)[0], 0.995)) + 1 if len(a) else 0 for a, b in pairs), 0)
        if all(found_share(codes, a, b) >= FOUND for a, b in pairs):
            return codes
    # Not even so many: one code for the form's sake, or as many as other lengths need.
    return Codes(codes.mean, codes.axes[:least], BITS * least, exact=True)


def _coded(models: dict[int, Codes], draws: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            codes = np.zeros((draws, len(frame)), dtype=np.uint64)
            for rows, vectors in _by_size(frame["embedding"]) if len(frame) else ():
                model = models.get(vectors.shape[1])
                if model is None:
                    drawn = [rotation(vectors[:0], draw=draw) for draw in range(draws)]
                    model = Codes(drawn[0][0], [axes for _, axes in drawn], RADIUS * draws)
                for code, found in zip(codes, model.of(_unit(vectors))):
                    code[rows] = found
            yield frame.assign(**{f"code{i}": code.view(np.int64) for i, code in enumerate(codes)})

    return run


def _candidates(nodes: DataFrame, models: dict[int, Codes], draws: int) -> DataFrame:
    """``a, b``: pairs of one label whose codes differ in at most the radius of their length, each found once.

    Each code stands in six tables by a substring; the other code looks there for its own substring and
    for all that differ in one bit. A pair is taken from the first table that holds it. Where the codes
    would lose too many, all pairs of a label are taken.
    """
    masks = _masks()
    codes = [f"code{i}" for i in range(draws)]
    index, probes = [], []
    for i, code in enumerate(codes):
        start = 0
        for t, (size, mask) in enumerate(zip(TABLE_BITS, masks), i * len(masks)):
            own = F.col(code).bitwiseAND(F.lit(mask))
            index.append(F.struct(F.lit(t).alias("t"), own.alias("key")))
            flips = [0, *(1 << b if b < 63 else -(1 << 63) for b in range(start, start + size))]
            probes += [F.struct(F.lit(t).alias("t"), own.bitwiseXOR(F.lit(f)).alias("key")) for f in flips]
            start += size
    keys = ["label", "size", "t", "key"]
    narrow = nodes.select("node", "label", F.size("embedding").alias("size"), *codes)
    exact = [size for size, model in models.items() if model.exact]
    coded = narrow.where(~F.col("size").isin(exact)) if exact else narrow
    asking, stored = (
        coded.select("label", "size", F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in codes), F.inline(F.array(*rows)))
        for side, rows in (("a", probes), ("b", index))
    )
    apart = [F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")) for c in codes]
    first = F.coalesce(
        *(
            F.when(F.bit_count(bits.bitwiseAND(F.lit(m))) <= 1, F.lit(i * len(masks) + t))
            for i, bits in enumerate(apart)
            for t, m in enumerate(masks)
        )
    )
    differ = reduce(lambda x, y: x + y, (F.bit_count(bits) for bits in apart))
    radius = F.lit(RADIUS * draws)
    for size, model in models.items():
        radius = F.when(F.col("size") == size, F.lit(model.radius)).otherwise(radius)
    pairs = (
        asking.join(stored, keys)
        .where((F.col("a") < F.col("b")) & (differ <= radius) & (first == F.col("t")))
        .select("a", "b")
    )
    if exact:
        whole = narrow.where(F.col("size").isin(exact))
        one, two = (whole.select("label", "size", F.col("node").alias(side)) for side in "ab")
        pairs = pairs.unionByName(one.join(two, ["label", "size"]).where("a < b").select("a", "b"))
    return pairs


def itq_components(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors`` (vec_id, embedding, label).

    Rows of one label, not null, link when the cosine of their vectors, in double precision, is at least
    ``threshold``. Candidates come from Hamming tables over binary codes, so a link may be missed; none is made
    below the threshold. The rotations are learnt from at most SAMPLE vectors, as are the radius and the
    number of codes, so that FOUND of the sample's pairs at the threshold are found; where MOST_CODES codes
    find fewer, all pairs of a label are compared. All vectors are coded and compared. Equal vectors fold before the
    search and are counted again in ``n_links``, the number of other rows that a row links with.
    ``component_id`` is the smallest vec_id that links reach; ``kept`` marks the row that has it.

    Vectors that are null, empty, zero, or hold null or non-finite values link with nothing, as do vectors
    of different lengths. A null vec_id counts as a row of its own and is larger than any id. Repeated
    rows link with each other. An empty table gives no rows.
    """
    finite = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
    usable = rows.where("label is not null and embedding is not null").where(finite)
    usable = usable.where("exists(embedding, x -> x != 0)")
    sample = usable.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).toPandas()
    samples = [_unit(v) for _, v in _by_size(sample["embedding"])] if len(sample) else []
    models = {v.shape[1]: fitted(v, threshold) for v in samples}
    draws = max((len(m.axes) for m in models.values()), default=1)
    models = {v.shape[1]: m if len(m.axes) == draws else fitted(v, threshold, draws) for v, m in zip(samples, models.values())}
    classes = usable.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    largest = F.array_max(F.transform("embedding", F.abs))
    scaled = F.transform("embedding", lambda x: x / F.col("largest"))
    length = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x))
    nodes = (
        classes.withColumn("largest", largest)
        .withColumn("scaled", scaled)
        .withColumn("length", length)
        .select("label", "embedding", "rep", "copies", "scaled", "length", F.monotonically_increasing_id().alias("node"))
    )
    nodes = written(
        nodes.mapInPandas(_coded(models, draws), ", ".join([_ddl(nodes), *(f"code{i} long" for i in range(draws))])),
        "vector-codes",
    )
    ends = nodes.select("node", "scaled", "length", "copies")
    one, two = (ends.select(*(F.col(c).alias(f"{c}_{side}") for c in ends.columns)) for side in "ab")
    dot = F.aggregate(F.zip_with("scaled_a", "scaled_b", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    links = written(
        _candidates(nodes, models, draws)
        .join(one, F.col("a") == F.col("node_a"))
        .join(two, F.col("b") == F.col("node_b"))
        .where(dot / (F.col("length_a") * F.col("length_b")) >= threshold)
        .select("a", "b", "copies_a", "copies_b"),
        "vector-links",
    )
    met = links.select(F.col("a").alias("node"), F.col("copies_b").alias("n")).unionByName(
        links.select(F.col("b").alias("node"), F.col("copies_a").alias("n"))
    )
    degrees = met.groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(links, "a", "b").withColumnRenamed("id", "node")
    known = written(
        nodes.join(degrees, "node", "left")
        .join(labels, "node", "left")
        .select(
            "label",
            "embedding",
            "rep",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "vector-classes",
    )
    lowest = known.groupBy("component").agg(F.min("rep").alias("lowest"))
    judged = known.join(lowest, "component").select(
        F.col("label").alias("of_label"), F.col("embedding").alias("of_embedding"), "n_links", "lowest"
    )
    found = rows.join(
        judged, (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding")), "left"
    )
    # A row that is in no class keeps its own id; in a class without any id the component is null.
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("lowest"))
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
