"""Document quality by a linear-chain conditional random field that labels every line good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.fitting import logistic_fit, minimise, sigmoid, summed
from vaultline.llm.spans import WHITE, chunks, span_hashes, word_spans
from vaultline.llm.tables import held_out, written

SAMPLE = 8000  # labelled documents that the field is fitted on
SEED = 3
RIDGE = 1e-4
KINDS = ("lower", "upper", "digit", "space", "stop", "shout", "bar", "sign", "other", "beyond")


def _kind_table() -> np.ndarray:
    table = np.full(256, KINDS.index("other"), dtype=np.uint8)
    table[WHITE] = KINDS.index("space")
    table[128:] = KINDS.index("beyond")
    for first, last, kind in (("a", "z", "lower"), ("A", "Z", "upper"), ("0", "9", "digit")):
        table[ord(first) : ord(last) + 1] = KINDS.index(kind)
    for chars, kind in ((".,;:?", "stop"), ("!", "shout"), ("|", "bar"), ("#*$%&<>=_~^", "sign")):
        table[[ord(c) for c in chars]] = KINDS.index(kind)
    return table


_KIND = _kind_table()
OWN = len(KINDS) + 7  # features of a line by itself
FEATURES = 3 * OWN + 3  # with those of both neighbours, the ends of the document, and a constant


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and bytes of every line, and the bounds of each text's lines; an empty text is one line."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    buffer = np.frombuffer(b"".join(encoded), dtype=np.uint8)
    ends = np.flatnonzero(buffer == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    bounds = np.searchsorted(ends, np.cumsum([0, *(len(e) for e in encoded)]))
    sizes = ends - starts
    kinds = _KIND[buffer]
    total = np.maximum(sizes, 1)
    columns = [np.add.reduceat(kinds == k, starts, dtype=np.int32) / total for k in range(len(KINDS))] if len(ends) else []

    word_starts, word_ends = word_spans(buffer)
    hashes = span_hashes(buffer, word_starts, word_ends)
    line_of = np.searchsorted(ends, word_starts)
    count = np.bincount(line_of, minlength=len(ends))
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    repeated = np.bincount(line_of, weights=again, minlength=len(ends)) / np.maximum(count, 1)
    signature = np.zeros(len(ends), dtype=np.uint64)
    np.add.at(signature, line_of, hashes)
    document = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((np.arange(len(ends)), signature, document))
    same = np.zeros(len(ends))
    same[order[1:]] = (
        (signature[order[1:]] == signature[order[:-1]]) & (document[order[1:]] == document[order[:-1]]) & (count[order[1:]] > 0)
    )
    last = kinds[np.maximum(ends - 1, starts)] if len(ends) else kinds
    own = np.column_stack(
        [
            *columns,
            np.log1p(sizes) / 5,
            np.minimum(sizes / np.maximum(count, 1), 30) / 10,
            repeated,
            same,
            count < 5,
            (last == KINDS.index("stop")) | (last == KINDS.index("shout")),
            count == 0,
        ]
    ).astype(np.float64)
    first = np.zeros(len(ends), dtype=bool)
    first[bounds[:-1]] = True
    final = np.zeros(len(ends), dtype=bool)
    final[bounds[1:] - 1] = True
    above, below = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    above[first], below[final] = 0, 0
    return np.column_stack([own, above, below, first, final, np.ones(len(ends))]), sizes, bounds


def _steps(bounds: np.ndarray) -> Iterator[np.ndarray]:
    """For each place in a chain, the lines there, of the longest chains first."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    sorted_sizes, heads = sizes[order], bounds[:-1][order]
    for step in range(int(sorted_sizes[0]) if len(sizes) else 0):
        yield heads[: np.searchsorted(-sorted_sizes, -step, side="left")] + step


def chain_marginals(scores: np.ndarray, turns: np.ndarray, bounds: np.ndarray):
    """Forward and backward sums over all chains at once.

    scores: of each line for being good (bad scores 0); turns: [[bad, bad], [bad, good], ...] scores of
    neighbours. Returns each line's probability of being good, the expected turns after each line, and
    the log of each chain's total.
    """
    lines = len(scores)
    ahead, behind = np.zeros((lines, 2)), np.zeros((lines, 2))
    places = list(_steps(bounds))
    emit = np.column_stack([np.zeros(lines), scores])
    for step, at in enumerate(places):
        if step == 0:
            ahead[at] = emit[at]
        else:
            into = np.logaddexp(ahead[at - 1][:, :1] + turns[0], ahead[at - 1][:, 1:] + turns[1])
            ahead[at] = into + emit[at]
    for at in reversed(places[1:]):
        out = emit[at] + behind[at]
        behind[at - 1] = np.logaddexp(turns[:, 0] + out[:, :1], turns[:, 1] + out[:, 1:])
    totals = np.logaddexp(ahead[bounds[1:] - 1][:, 0], ahead[bounds[1:] - 1][:, 1])
    line_total = np.repeat(totals, np.diff(bounds))
    good = np.exp(ahead[:, 1] + behind[:, 1] - line_total)
    inner = np.ones(lines, dtype=bool)
    inner[bounds[1:] - 1] = False
    at = np.flatnonzero(inner)
    joint = ahead[at][:, :, None] + turns + (emit[at + 1] + behind[at + 1])[:, None, :] - line_total[at][:, None, None]
    return good, at, np.exp(joint), totals


@dataclass
class Field:
    """scale: of the features; weights: of a good line; turns: of neighbours; slope, lift: from the mean
    marginal of a document to its score."""

    scale: np.ndarray
    weights: np.ndarray
    turns: np.ndarray
    slope: float = 1.0
    lift: float = 0.0

    def document_means(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Length-weighted mean marginal of each text, and the share of bytes on lines more likely good."""
        features, sizes, bounds = line_features(texts)
        good, *_ = chain_marginals((features / self.scale) @ self.weights, self.turns, bounds)
        weight = (sizes + 1).astype(float)
        sums = np.add.reduceat(np.column_stack([good * weight, (good >= 0.5) * weight, weight]), bounds[:-1], axis=0)
        return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]

    def scores(self, means: np.ndarray) -> np.ndarray:
        kept = np.clip(means, 1e-6, 1 - 1e-6)
        return sigmoid(self.slope * np.log(kept / (1 - kept)) + self.lift)


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Features of many documents in a row, for the fit."""
    for frame in frames:
        texts, labels = frame["text"].tolist(), frame["quality"].to_numpy()
        for part in chunks(texts, 200_000):
            features, _, bounds = line_features(texts[part])
            yield pd.DataFrame(
                {"features": [features.tobytes()], "bounds": [bounds.tobytes()], "labels": [labels[part].astype(float).tobytes()]}
            )


def _unpacked(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for features, bounds, labels in zip(frame["features"], frame["bounds"], frame["labels"]):
        yield np.frombuffer(features).reshape(-1, FEATURES), np.frombuffer(bounds, dtype=np.int64), np.frombuffer(labels)


def fit_field(docs: DataFrame, labels: DataFrame) -> Field:
    """Fits on at most SAMPLE labelled documents outside the held-out third, chosen by a hash of their id.

    All lines of a document get its label, each document counts the same. The features stay in a Spark
    table; a step of the fit brings one gradient back from each of its tasks. Then slope and lift are fitted
    on the documents' mean marginals. Labels other than 0 and 1 are not used; without usable labels every
    score is 0.5, with one kind of label the field leans to it.
    """
    usable = labels.where("quality in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", "quality")
    chosen = usable.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SAMPLE)
    chosen = written(chosen, "quality-labels")
    sample = written(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "quality"), "quality-sample")
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    blocks = written(
        sample.repartition(tasks).mapInPandas(_blocks, "features binary, bounds binary, labels binary"), "quality-blocks"
    )

    def spread(frame: pd.DataFrame) -> np.ndarray:
        return sum(np.append((f**2).sum(axis=0), len(f)) for f, _, _ in _unpacked(frame))

    squares = summed(blocks, spread, FEATURES + 1)
    scale = np.sqrt(np.maximum(squares[:-1], 1e-12) / max(1.0, squares[-1]))
    scale[scale < 1e-5] = 1.0

    def loss(parameters: np.ndarray) -> tuple[float, np.ndarray]:
        weights, turns = parameters[:FEATURES], parameters[FEATURES:].reshape(2, 2)

        def part(frame: pd.DataFrame) -> np.ndarray:
            out = np.zeros(FEATURES + 6)
            for features, bounds, label in _unpacked(frame):
                features = features / scale
                good, at, joint, totals = chain_marginals(features @ weights, turns, bounds)
                sizes = np.diff(bounds)
                each = np.repeat(1 / sizes, sizes)
                line = np.repeat(label, sizes)
                truth = line.astype(int)
                score = (features @ weights) * line
                pairs = turns[truth[at], truth[at]] if len(at) else np.zeros(0)
                chain = np.add.reduceat(score, bounds[:-1])
                chain += np.bincount(np.searchsorted(bounds, at, side="right") - 1, weights=pairs, minlength=len(sizes))
                out[0] += ((totals - chain) / sizes).sum()
                out[1] += len(sizes)
                out[2 : 2 + FEATURES] += features.T @ (each * (good - line))
                wanted = np.zeros((len(at), 2, 2))
                wanted[np.arange(len(at)), truth[at], truth[at]] = 1
                out[2 + FEATURES :] += ((joint - wanted) * each[at][:, None, None]).sum(axis=0).ravel()
            return out

        sums = summed(blocks, part, FEATURES + 6)
        count = max(1.0, sums[1])
        return sums[0] / count + RIDGE * parameters @ parameters, sums[2:] / count + 2 * RIDGE * parameters

    best = minimise(loss, np.zeros(FEATURES + 4))
    field = Field(scale, best[:FEATURES], best[FEATURES:].reshape(2, 2))

    def means(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in chunks(texts := frame["text"].tolist()):
                yield pd.DataFrame({"mean": field.document_means(texts[part])[0], "quality": frame["quality"].iloc[part]})

    found = sample.mapInPandas(means, "mean double, quality int").toPandas()  # at most SAMPLE rows, or copies of them
    if found["quality"].nunique() == 2:
        kept = np.clip(found["mean"].to_numpy(), 1e-6, 1 - 1e-6)
        slope, lift = logistic_fit(np.log(kept / (1 - kept))[:, None], found["quality"].to_numpy().astype(float))
        field.slope, field.lift = max(float(slope), 0.0), float(lift)
    return field


def judged(text: Column, field: Field) -> Column:
    """A struct of ``score`` and ``good_share`` for whole texts, to be used beside any other columns."""

    @F.pandas_udf("score double, good_share double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts, parts = texts.tolist(), [(np.zeros(0), np.zeros(0))]
            for part in chunks(texts):
                means, share = field.document_means(texts[part])
                parts.append((field.scores(means), share))
            scores, shares = (np.concatenate(x) for x in zip(*parts))
            yield pd.DataFrame({"score": scores, "good_share": shares})

    return judge(text)


def score_quality(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, held_out, score, predicted, good_share`` for each row of ``docs`` (doc_id, text; others are
    not read).

    score: from the length-weighted mean of the probabilities that the lines are good, higher for better
    documents; predicted: 1 from 0.5; good_share: of the bytes, on lines more likely good than bad. The
    whole text counts. A null or empty text is one empty line. Repeated rows are scored each; an empty
    table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), judged(F.col("text"), field).alias("found")).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "found.score",
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        "found.good_share",
    )
