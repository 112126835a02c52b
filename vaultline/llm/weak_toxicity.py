"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.fitting import logistic_fit, minimise, sigmoid, summed
from vaultline.llm.tables import held_out, written

SAMPLE = 20_000  # labelled documents that voters and features are found in
FIT_SAMPLE = 50_000  # documents, labelled or not, that the classifier is fitted on
FEATURES, VOTERS = 2048, 256
LEAST = 5  # documents of the sample that a term must be in
PRECISION = 0.8  # share of toxic documents among those of the sample on which a learnt term votes
STEMS = (3, 4, 5, 6)  # leading letters that make a pattern
ROUNDS = 12  # of the label model
SEED = 5
CACHE = 500_000

# A general lexicon, which votes whatever the labels say.
LEXICON = ("idiot", "moron", "stupid", "scum", "loser", "trash", "pathetic", "worthless", "disgusting")

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def terms_of(word: str) -> list[str]:
    """A word itself, for lexicons, and its stems with a star, for patterns."""
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


def _term_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    toxic, clean = Counter(), Counter()
    for frame in frames:
        for text, label in zip(frame["text"], frame["toxic"]):
            found = {term for word in words_of(text) for term in terms_of(word)}
            (toxic if label else clean).update(found)
        if len(toxic) + len(clean) > 2_000_000:
            yield from _drained(toxic, clean)
    yield from _drained(toxic, clean)


def _drained(toxic: Counter, clean: Counter) -> Iterator[pd.DataFrame]:
    terms = list(toxic.keys() | clean.keys())
    for start in range(0, len(terms), 100_000):
        part = terms[start : start + 100_000]
        yield pd.DataFrame({"term": part, "toxic": [toxic[t] for t in part], "clean": [clean[t] for t in part]})
    toxic.clear()
    clean.clear()


def _chosen_terms(sample: DataFrame) -> tuple[list[str], int]:
    """The most telling terms; the first so many of them vote for toxic."""
    sizes = {bool(r["toxic"]): r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    counts = sample.mapInPandas(_term_counts, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = counts.where(F.col("toxic") + F.col("clean") >= LEAST)
    expected = (F.col("toxic") + F.col("clean")) * (toxic / max(1, toxic + clean))
    telling = F.abs(F.col("toxic") - expected) / F.sqrt(expected + 1)
    best = counts.withColumn("telling", telling).orderBy(F.desc("telling"), "term").limit(FEATURES).collect()
    votes = [r["term"] for r in best if r["toxic"] >= LEAST and r["toxic"] / (r["toxic"] + r["clean"]) >= PRECISION]
    voters = list(dict.fromkeys([*LEXICON, *votes]))[: VOTERS + len(LEXICON)]
    rest = [r["term"] for r in best if r["term"] not in set(voters)]
    return [*voters, *rest], len(voters)


def _found_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, terms``: for each row, which of the terms its whole text has."""
    ids = {term: i for i, term in enumerate(terms)}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for frame in frames:
            rows = []
            for text in frame["text"]:
                found: set[int] = set()
                for word in words_of(text):
                    hit = known.get(word)
                    if hit is None:
                        hit = known[word] = tuple(ids[t] for t in terms_of(word) if t in ids)
                    if hit:
                        found.update(hit)
                rows.append(np.array(sorted(found), dtype=np.int32))
                if len(known) > CACHE:
                    known.clear()
            yield pd.DataFrame({"doc_id": frame["doc_id"], "terms": rows})

    return docs.mapInPandas(run, "doc_id long, terms array<int>")


def _flat(lists: pd.Series, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and term ids under ``below``, side by side."""
    sizes = lists.map(len).to_numpy()
    ids = np.concatenate([np.zeros(0, dtype=np.int64), *lists]).astype(np.int64)
    rows = np.repeat(np.arange(len(lists)), sizes)
    return rows[ids < below], ids[ids < below]


@dataclass
class LabelModel:
    """fires, misfires: how often each voter votes on toxic and on other documents; share: of toxic ones;
    related: correlations of the voters."""

    share: float
    fires: np.ndarray
    misfires: np.ndarray
    related: np.ndarray

    def posterior(self, rows: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
        """A silent voter says nothing. Of voters that fire together and are correlated, each counts for a
        part, so that a word and its stem aren't two witnesses."""
        vote = np.log(self.fires) - np.log(self.misfires)
        used, row = np.unique(rows, return_inverse=True)
        fired = np.zeros((len(used), len(vote)), dtype=np.float32)
        fired[row, ids] = 1
        shared = (fired @ self.related.astype(np.float32))[row, ids]
        prior = np.log(self.share) - np.log1p(-self.share)
        return sigmoid(prior + np.bincount(rows, weights=vote[ids] / shared, minlength=count))


def _correlations(votes: DataFrame, voters: int) -> np.ndarray:
    """Of the voters with each other, over the documents on which any of them votes."""

    def part(frame: pd.DataFrame) -> np.ndarray:
        rows, ids = _flat(frame["terms"], voters)
        used, rows = np.unique(rows, return_inverse=True)
        matrix = np.zeros((len(used), voters), dtype=np.float32)
        matrix[rows, ids] = 1
        return np.concatenate([[len(used)], matrix.sum(axis=0), (matrix.T @ matrix).ravel()])

    sums = summed(votes, part, 1 + voters + voters * voters)
    count = max(1.0, sums[0])
    mean, joint = sums[1 : voters + 1] / count, sums[voters + 1 :].reshape(voters, voters) / count
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    related = np.clip((joint - np.outer(mean, mean)) / np.outer(spread, spread), 0, 1)
    np.fill_diagonal(related, 1)
    return related


def fit_label_model(votes: DataFrame, voters: int) -> LabelModel:
    """Expectation and maximisation over the votes of all documents (``terms``, and ``label`` where known).

    The classes are tied to the known labels; all other documents count by their posterior.
    """
    related = _correlations(votes, voters)
    # To begin with, two voters or more say that a document is toxic.
    model = None
    for _ in range(ROUNDS):

        def part(frame: pd.DataFrame, model=model) -> np.ndarray:
            rows, ids = _flat(frame["terms"], voters)
            count = len(frame)
            if model is None:
                belief = np.where(np.bincount(rows, minlength=count) > 1, 0.9, 0.02)
            else:
                belief = model.posterior(rows, ids, count)
            label = frame["label"].to_numpy(dtype=float)
            belief = np.where(np.isnan(label), belief, label)
            on = np.bincount(ids, weights=belief[rows], minlength=voters)
            off = np.bincount(ids, weights=1 - belief[rows], minlength=voters)
            return np.concatenate([[count, belief.sum()], on, off])

        sums = summed(votes, part, 2 + 2 * voters)
        count, toxic = sums[0], sums[1]
        model = LabelModel(
            float((toxic + 1) / (count + 2)),
            np.minimum((sums[2 : voters + 2] + 0.1) / (toxic + 1), 0.999),
            np.minimum((sums[voters + 2 :] + 0.1) / (count - toxic + 1), 0.999),
            related,
        )
    return model


def _fit_classifier(votes: DataFrame, model: LabelModel, voters: int, size: int) -> np.ndarray:
    """Weights of all features and a constant, from the posteriors of the label model."""

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def part(frame: pd.DataFrame) -> np.ndarray:
            count = len(frame)
            belief = model.posterior(*_flat(frame["terms"], voters), count)
            label = frame["label"].to_numpy(dtype=float)
            belief = np.where(np.isnan(label), belief, label)
            rows, ids = _flat(frame["terms"], size)
            z = np.clip(np.bincount(rows, weights=weights[ids], minlength=count) + weights[-1], -60, 60)
            error = sigmoid(z) - belief
            value = (np.logaddexp(0, z) - belief * z).sum()
            return np.concatenate([[count, value], np.bincount(ids, weights=error[rows], minlength=size), [error.sum()]])

        sums = summed(votes, part, size + 3)
        count = max(1.0, sums[0])
        ridge = 2e-5 * np.append(weights[:-1], 0)
        return sums[1] / count + ridge @ weights, sums[2:] / count + 2 * ridge

    return minimise(loss, np.zeros(size + 1), 40)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_votes`` for each row of ``docs`` (doc_id, text; others are not
    read), given ``labels`` (doc_id, toxic).

    Voters: a fixed lexicon, and words and word stems that go with toxic in at most SAMPLE labelled
    documents outside the held-out third. The label model covers the votes of all documents; the classifier
    over FEATURES terms is fitted on at most FIT_SAMPLE of them. score: its probability from the whole text;
    predicted: 1 from 0.7; n_votes: voters that fired. Labels other than 0 and 1 are not used. Null and empty
    texts have no terms, which scores as such. Rows that share a doc_id are scored each. An empty table gives
    no rows, and without labels the fixed lexicon votes alone.
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    known = labels.where("toxic in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    known = known.dropDuplicates(["doc_id"])
    chosen = written(known.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SAMPLE), "toxic-labels")
    sample = written(rows.join(chosen, "doc_id").select("text", "toxic"), "toxic-sample")
    terms, voters = _chosen_terms(sample)
    found = written(_found_terms(rows, terms), "toxic-terms")
    labelled = found.join(known.select("doc_id", F.col("toxic").cast("double").alias("label")), "doc_id", "left")
    votes = written(labelled.select("doc_id", "terms", "label"), "toxic-votes")
    model = fit_label_model(votes.select("terms", "label"), voters)
    order = F.xxhash64("doc_id", F.lit(SEED + 1))
    fitted = written(votes.orderBy(order, "doc_id").limit(FIT_SAMPLE).select("terms", "label"), "toxic-fit")
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    fitted = written(fitted.repartition(tasks), "toxic-fit")
    weights = _fit_classifier(fitted, model, voters, len(terms))

    def margins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            where, ids = _flat(frame["terms"], len(terms))
            z = np.bincount(where, weights=weights[ids], minlength=len(frame)) + weights[-1]
            yield pd.DataFrame({"margin": z, "label": frame["label"]})

    # Slope and lift of the margins, from the labelled sample again: at most SAMPLE documents.
    judged = votes.join(chosen.select("doc_id"), "doc_id", "left_semi").select("terms", "label")
    judged = judged.mapInPandas(margins, "margin double, label double").toPandas()
    slope, lift = 1.0, 0.0
    if judged["label"].nunique() == 2:
        slope, lift = logistic_fit(judged[["margin"]].to_numpy(), judged["label"].to_numpy())
        slope = max(float(slope), 0.0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            where, ids = _flat(frame["terms"], len(terms))
            z = np.bincount(where, weights=weights[ids], minlength=len(frame)) + weights[-1]
            fired = np.bincount(where[ids < voters], minlength=len(frame))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": sigmoid(slope * z + lift), "n_votes": fired})

    scored = found.mapInPandas(run, "doc_id long, score double, n_votes long")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_votes",
    )
