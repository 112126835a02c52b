"""Quality by perplexity: a modified Kneser-Ney model of character runs, counted over the whole corpus by language.

A model of words has seen few of the words of an unseen text, so its figures tell apart little but copies; runs of
characters, blanks between words among them, tell a language, its spelling, its order of signs and how often it
says the same again. Runs that only one text of the corpus has (or its exact copies) are no part of the model, so no
text vouches for itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.spans import chunks, mix
from vaultline.llm.tables import batches_of, written

ORDER = 5  # characters of a run
MIN_WORDS, REPEATED_PERCENT = 50, 50
SIGNS = "#*$%&|<>"
FENCE = 4.0  # width of a band, in standard deviations as the quartiles tell them
LEAST_SPREAD = 0.005  # bits a character
LEAST_TEXTS = 32  # of a length class, to have bands of its own
BIN = 0.002  # bits a character; quartiles are exact up to it
FREQUENT = 1 << 19  # runs that are broadcast, at most; all others are joined
HELD = 1 << 21  # counts that a task holds before it adds them up
RANGE = 1 << 16  # runs of the model in one range of hashes, about
SALTS = 64  # parts in which the runs of a language meet its discounts

BLANK, ODD = 0x20, np.uint64(0x9E3779B97F4A7C15)


def base_measures(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text; words end at ASCII white space."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    white = sum(raw.count(bytes([c])) for c in b" \t\n\x0b\x0c\r")
    signs = sum(raw.count(c.encode()) for c in SIGNS)
    lines = Counter(line for line in raw.split(b"\n") if line.split())
    trios = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(trios)) < len(trios):
        seen = Counter(trios)
        until = 0  # words before this place are counted
        for place, trio in enumerate(trios):
            if seen[trio] > 1:
                repeated += place + 3 - max(place, until)
                until = place + 3
    return len(words), len(text) - white, signs, sum(lines.values()) - len(lines), repeated


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- runs of characters ---------------------------------------------------------------------------------


@dataclass
class Runs:
    """The runs of some texts, one for each character and the blank behind the last.

    key: hash of the tongue and the run; text: whose it is; line: characters of all texts, blank behind blank
    taken out, and ORDER - 1 blanks before each; at: place of a run's last character in it.
    """

    key: np.ndarray
    text: np.ndarray
    line: np.ndarray
    at: np.ndarray

    def characters(self, which: np.ndarray) -> np.ndarray:
        """The runs as rows of ORDER characters."""
        return self.line[self.at[which][:, None] - np.arange(ORDER - 1, -1, -1)]


def run_keys(tongue: np.ndarray, characters: np.ndarray) -> np.ndarray:
    key = tongue.astype(np.int64).view(np.uint64)
    for k in range(characters.shape[1]):
        key = (key + characters[:, k].astype(np.uint64) + np.uint64(1)) * ODD
    return mix(key)


def runs_of(texts: list[str | None], tongues: np.ndarray) -> Runs:
    """White space counts as one blank; a text without words has no runs. A zero character counts as U+FFFD."""
    joined = "\n".join(["", *(t or "" for t in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t or "") + 1 for t in texts], dtype=np.int64)
    white = (codes == BLANK) | (codes - np.uint32(9) <= np.uint32(4))
    codes = np.where(white, np.uint32(BLANK), np.where(codes == 0, np.uint32(0xFFFD), codes))
    # Of a run of blanks the first stays, as the end of the text before it; none stay in front of a text.
    owner = np.concatenate([np.repeat(np.arange(len(texts)), sizes), [len(texts)]])  # the blank before a text is its own
    stays = ~white
    stays[1:] |= white[1:] & ~white[:-1]
    owner = np.where(white, np.concatenate([[0], owner[:-1]]), owner)
    stays[0] = False
    at = np.flatnonzero(stays)
    codes, owner = codes[at], owner[at]
    if not len(owner):
        nothing = np.zeros(0, dtype=np.int64)
        return Runs(nothing.view(np.uint64), nothing, codes, nothing)
    at = np.arange(len(owner)) + (ORDER - 1) * (1 + np.concatenate([[0], np.cumsum(owner[1:] != owner[:-1])]))
    line = np.full(int(at[-1]) + 1, BLANK, dtype=np.uint32)
    line[at] = codes
    key = np.zeros(len(line), dtype=np.uint64)
    key[at] = tongues[owner].astype(np.int64).view(np.uint64)
    plus = line.astype(np.uint64) + np.uint64(1)
    for back in range(ORDER - 1, -1, -1):
        key[back:] += plus[: len(line) - back]
        key *= ODD
    return Runs(mix(key[at]), owner, line, at)


def _added_up(parts: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    """Key, tongue, characters, count, least and greatest text of each run once."""
    key, tongue, characters, n, low, high = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    if not len(first):
        return []
    some = order[first]
    return [
        (
            key[first],
            tongue[some],
            characters[some],
            np.add.reduceat(n[order], first),
            np.minimum.reduceat(low[order], first),
            np.maximum.reduceat(high[order], first),
        )
    ]


def _counted(texts: list[str | None], tongues: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, ...]:
    runs = runs_of(texts, tongues)
    order = np.argsort(runs.key)
    key = runs.key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    some = order[first]
    name = names[runs.text[order]]
    if not len(first):
        nothing = np.zeros(0, dtype=np.int64)
        return key, nothing, np.zeros((0, ORDER), dtype=np.uint32), nothing, nothing, nothing
    return (
        key[first],
        tongues[runs.text[some]],
        runs.characters(some),
        np.diff(np.append(first, len(key))),
        np.minimum.reduceat(name, first),
        np.maximum.reduceat(name, first),
    )


def count_runs(docs: DataFrame) -> DataFrame:
    """``tongue, run, n, shared`` of ``docs`` (tongue, text, name: a hash of the text): how often each run is there,
    and whether two different texts have it. Tasks add up their own counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def emitted() -> Iterator[pa.RecordBatch]:
            for _, tongue, characters, n, low, high in held:
                names = np.ascontiguousarray(characters.astype("<u4")).view(f"<U{ORDER}").ravel()
                columns = {"tongue": tongue, "run": names, "n": n, "low": low, "high": high}
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

        for batch in batches:
            texts = batch.column("text").to_pylist()
            tongues, names = (batch.column(c).to_numpy() for c in ("tongue", "name"))
            for part in chunks(texts):
                held.append(_counted(texts[part], tongues[part], names[part]))
                if sum(len(h[0]) for h in held) > HELD:
                    held = _added_up(held)
                    if held and len(held[0][0]) > HELD // 2:
                        yield from emitted()
                        held = []
        if held:
            held = _added_up(held)
            yield from emitted()

    counted = docs.mapInArrow(run, "tongue long, run string, n long, low long, high long")
    summed = counted.groupBy("tongue", "run").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return summed.select("tongue", "run", "n", (F.col("low") != F.col("high")).alias("shared"))


# --- the model ------------------------------------------------------------------------------------------


def _discounts(level: DataFrame, count: str) -> DataFrame:
    """``tongue, d1, d2, d3``: what counts of one, two, and three or more give away; half where there is no estimate."""
    kinds = level.groupBy("tongue").agg(*(F.count_if(F.col(count) == k).alias(f"n{k}") for k in (1, 2, 3, 4)))
    of = [F.greatest(F.col(f"n{k}"), F.lit(1)).cast("double") for k in (1, 2, 3, 4)]
    ratio = of[0] / (of[0] + 2 * of[1])
    found = [k - (k + 1) * ratio * of[k] / of[k - 1] for k in (1, 2, 3)]
    usable = (F.when((d > 0) & (d < k), d).otherwise(F.lit(0.5 * k)).alias(f"d{k}") for k, d in zip((1, 2, 3), found))
    return kinds.select("tongue", *usable)


def _probabilities(level: DataFrame, discounts: DataFrame, shorter: DataFrame | None, order: int) -> DataFrame:
    """``tongue, run, p`` of the runs of a level, by their counts ``c`` and the level below.

    A run's context is all but its last character. A context without counts leaves the character to the
    run without its first one.
    """
    context = Window.partitionBy("tongue", F.substring("run", 1, order - 1))
    c = F.col("c")
    discount = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).when(c > 2, F.col("d3")).otherwise(0.0)
    salted = level.withColumn("salt", F.pmod(F.xxhash64("run"), F.lit(SALTS)).cast("int"))
    spread = discounts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    counted = salted.join(spread, ["tongue", "salt"]).select("tongue", "run", "c", discount.alias("discount"))
    sums = {"total": F.sum("c").over(context), "taken": F.sum("discount").over(context)}
    if shorter is None:
        sums["below"] = 1 / (F.count(F.lit(1)).over(context) + 1)
    ready = counted.withColumns(sums)
    if shorter is not None:
        below = shorter.select(F.col("tongue").alias("of_tongue"), F.col("run").alias("end"), F.col("p").alias("below"))
        same = (F.col("tongue") == F.col("of_tongue")) & (F.substring("run", 2, order - 1) == F.col("end"))
        ready = ready.join(below, same)
    own = (F.col("c") - F.col("discount") + F.col("taken") * F.col("below")) / F.col("total")
    return ready.select("tongue", "run", F.when(F.col("total") > 0, own).otherwise(F.col("below")).alias("p"))


def fit_model(counts: DataFrame) -> DataFrame:
    """``tongue, run, n, p`` of all runs counted: the last character's probability after the others.

    The model is made of the shared runs. Shorter runs count by how many different characters come before them
    in those. Runs that are not shared have a probability too, by what the model knows of their parts.
    """
    level = counts.select("tongue", "run", F.when(F.col("shared"), F.col("n")).otherwise(0).alias("c"), "n")
    levels = {ORDER: level}
    discounts = {ORDER: _discounts(level, "n")}
    for order in range(ORDER - 1, 0, -1):
        ends = levels[order + 1].groupBy("tongue", F.substring("run", 2, order).alias("run"))
        levels[order] = written(ends.agg(F.count_if(F.col("c") > 0).alias("c")), f"runs-of-{order}")
        discounts[order] = _discounts(levels[order], "c")
    found = None
    for order in range(1, ORDER + 1):
        found = _probabilities(levels[order], discounts[order], found, order)
    return found.join(counts.select("tongue", "run", "n"), ["tongue", "run"])


def hashed_model(model: DataFrame) -> DataFrame:
    """``key, bits, n``: the hash of each run's tongue and characters, as in ``runs_of``, and its cost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = np.array(batch.column("run").to_pylist(), dtype=f"<U{ORDER}")
                characters = names.view("<u4").reshape(len(names), ORDER)
                key = run_keys(batch.column("tongue").to_numpy(), characters).view(np.int64)
                bits = -np.log2(batch.column("p").to_numpy())
                yield pa.RecordBatch.from_pydict({"key": key, "bits": bits, "n": batch.column("n")})

    return model.select("tongue", "run", "p", "n").mapInArrow(run, "key long, bits double, n long")


class SortedArrays:
    """Costs by sorted hashes. As hashes are spread evenly, their first bits lead close to the place."""

    def __init__(self, key: np.ndarray, bits: np.ndarray):
        order = np.argsort(key)
        self.key, self.bits = key[order], bits[order]
        self.shift = np.uint64(64 - max(1, int(len(key)).bit_length()))
        slots = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.first = np.append(np.searchsorted(self.key, slots), len(key))
        self.most = int(np.diff(self.first).max()) if len(key) else 0

    def find(self, key: np.ndarray) -> np.ndarray:
        """The cost of each key; NaN for those that are not here."""
        out = np.full(len(key), np.nan)
        slot = (key >> self.shift).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        for _ in range(self.most):
            hit = self.key[at] == key[left]
            out[left[hit]] = self.bits[at[hit]]
            more = ~hit & (at + 1 < end)
            left, at, end = left[more], at[more] + 1, end[more]
            if not len(left):
                break
        return out


# --- scores -----------------------------------------------------------------------------------------------

FACTS = "row long, doc_id long, tongue long, name long, " + ", ".join(f"{m} long" for m in MEASURES) + ", n_runs long, bits double"


def _frequent(model: DataFrame) -> tuple[Column, DataFrame]:
    """A condition for the most frequent runs of the model, FREQUENT of them at most, and the table itself.

    Counts are taken in steps of an eighth of a doubling, so the bound is kept by counting, not by sorting.
    """
    step = F.floor(F.log2(F.col("n")) * 8).cast("int")
    sizes = {r["step"]: r["count"] for r in model.groupBy(step.alias("step")).count().collect()}  # at most 512 rows
    least, total = max(sizes, default=0) + 1, 0
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > FREQUENT:
            break
        least = s
    return step >= least, model


def score_runs(docs: DataFrame, model: DataFrame) -> DataFrame:
    """The columns FACTS for each row of ``docs``: base measures, runs, and their cost under the model, in bits.

    The most frequent runs, a bounded number, are broadcast as sorted arrays; the other runs of each document go to
    the range of hashes that they fall in, where the model's own lie in sorted arrays, and only sums come back.
    """
    spark = docs.sparkSession
    frequent, model = _frequent(model)
    hot = model.where(frequent).select("key", "bits").toArrow()
    arrays = hot["key"].to_numpy().astype(np.int64).view(np.uint64), hot["bits"].to_numpy()
    given = spark.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = SortedArrays(*given.value), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tongues = batch.column("tongue").to_numpy()
            for part in chunks(texts):
                runs = runs_of(texts[part], tongues[part])
                count = part.stop - part.start
                bits = known.find(runs.key)
                rare = np.isnan(bits)
                sums = np.bincount(runs.text, np.where(rare, 0.0, bits), minlength=count).astype(float)  # also without runs
                measures = np.array([base_measures(t) for t in texts[part]], dtype=np.int64).reshape(count, len(MEASURES))
                rows = row + np.arange(count)
                row += count
                none = pa.nulls(count, pa.int64())
                yield pa.RecordBatch.from_pydict(
                    {"row": rows, **{c: batch.column(c).slice(part.start, count) for c in ("doc_id", "tongue", "name")}}
                    | {m: measures[:, k] for k, m in enumerate(MEASURES)}
                    | {"n_runs": np.bincount(runs.text, minlength=count).astype(np.int64), "bits": sums, "key": none, "n": none}
                )
                owner, key = runs.text[rare], runs.key[rare]
                if len(key):
                    order = np.lexsort((key, owner))
                    owner, key = owner[order], key[order]
                    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]))
                    own = pa.nulls(len(first), pa.int64())
                    yield pa.RecordBatch.from_pydict(
                        {"row": rows[owner[first]], **{c: own for c in ("doc_id", "tongue", "name", *MEASURES, "n_runs")}}
                        | {"bits": pa.nulls(len(first), pa.float64()), "key": key[first].view(np.int64), "n": np.diff(np.append(first, len(key)))}
                    )

    with batches_of(spark):
        staged = written(docs.mapInArrow(run, f"{FACTS}, key long, n long"), "run-scores")
    facts = staged.where("key is null").drop("key", "n")
    ranges = max(1, model.where(~frequent).count() // RANGE)
    part = F.pmod(F.shiftrightunsigned("key", 8), F.lit(ranges)).alias("part")
    asked = staged.where("key is not null").select(part, "row", "key", "n")
    held = model.where(~frequent).select(part.alias("of_part"), "key", "bits")

    def looked_up(questions: pa.Table, entries: pa.Table) -> pa.Table:
        arrays = SortedArrays(entries["key"].to_numpy().view(np.uint64), entries["bits"].to_numpy())
        cost = arrays.find(questions["key"].to_numpy().view(np.uint64)) * questions["n"].to_numpy()
        rows, which = np.unique(questions["row"].to_numpy(), return_inverse=True)
        return pa.table({"asker": rows, "more": np.bincount(which, cost, minlength=len(rows)).astype(float)})

    sums = asked.groupBy("part").cogroup(held.groupBy("of_part")).applyInArrow(looked_up, "asker long, more double")
    sums = sums.groupBy("asker").agg(F.sum("more").alias("more"))
    joined = facts.join(sums, F.col("row") == F.col("asker"), "left")
    return joined.withColumn("bits", F.col("bits") + F.coalesce("more", F.lit(0.0))).drop("asker", "more")


# --- bands ------------------------------------------------------------------------------------------------


def bands(scored: DataFrame, fence: float) -> DataFrame:
    """``tongue, size, lower, upper``: limits of the bits a character of a language's texts of like length.

    Taken from ``scored`` (tongue, size: the doublings of the length, name, cost), each different text once: the
    median, and the quartiles' distances from it on either side, which give a standard deviation each. A length with
    few texts takes the limits of the next shorter one that has enough, or else of the next longer one; a
    language that has none has no limits.
    """
    texts = scored.groupBy("tongue", "size", "name").agg(F.min(F.floor(F.col("cost") / BIN)).alias("bin"))
    bins = texts.groupBy("tongue", "size", "bin").agg(F.count(F.lit(1)).alias("texts"))
    whole = Window.partitionBy("tongue", "size")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumns({"upto": F.sum("texts").over(upto), "all": F.sum("texts").over(whole)})
    at = {q: F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("bin"))) for q, share in QUARTILES.items()}
    found = bins.groupBy("tongue", "size").agg(F.max("all").alias("all"), *(c.alias(q) for q, c in at.items()))
    middle = (F.col("q2") + 0.5) * BIN
    spread = [F.greatest(d * BIN / 0.6745, F.lit(LEAST_SPREAD)) for d in (F.col("q2") - F.col("q1"), F.col("q3") - F.col("q2"))]
    enough = F.col("all") >= LEAST_TEXTS
    limits = found.select(
        "tongue", "size",
        F.when(enough, middle - fence * spread[0]).alias("lower"),
        F.when(enough, middle + fence * spread[1]).alias("upper"),
    )
    shorter = Window.partitionBy("tongue").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    longer = Window.partitionBy("tongue").orderBy("size").rowsBetween(0, Window.unboundedFollowing)
    near = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(shorter), F.first(c, ignorenulls=True).over(longer))
        for c in ("lower", "upper")
    }
    return limits.select("tongue", "size", *(e.alias(c) for c, e in near.items()))


QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def judge_perplexity(docs: DataFrame, fence: float = FENCE) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, perplexity, kept``
    for each row of ``docs`` (doc_id, text, lang; others are not read).

    base_failed: fewer than 50 words, or over half of them in three-word runs that the text repeats.
    perplexity: per character, white space taken as one blank, with the end as one more, of the whole text under the
    model of its language; null without words. The model is one of modified Kneser-Ney over runs of ORDER
    characters, counted over all texts of the language; runs that only one text has, or its exact copies, are
    left out. kept: not base_failed, and the log perplexity lies within ``fence`` standard deviations of the
    median, both ways, as the quartiles of the language's different texts of like length that pass the base rules
    tell them. A language with fewer than LEAST_TEXTS texts of any length has no bands and keeps them. A null
    language is one of its own, apart from ''. Null and empty texts have no words and fail the base rules. Repeated
    rows are judged each, and count as one text. An empty table gives no rows.
    """
    tongue = F.xxhash64(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tongue.alias("tongue"), F.xxhash64("text").alias("name"))
    with batches_of(docs.sparkSession):
        counts = written(count_runs(rows.select("tongue", "text", "name")), "runs")
    model = written(hashed_model(fit_model(counts)), "run-model")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    scored = score_runs(rows, model).withColumns(
        {
            "base_failed": failed,
            "cost": F.when(F.col("n_runs") > 0, F.col("bits") / F.col("n_runs")),
            "size": F.when(F.col("n_runs") > 0, F.floor(F.log2("n_runs")).cast("int")),
        }
    )
    scored = written(scored.drop("row", "bits", "n_runs"), "perplexities")
    limits = written(bands(scored.where("not base_failed"), fence), "perplexity-bands")
    within = F.coalesce(F.col("cost").between(F.col("lower"), F.col("upper")), F.lit(True))
    return scored.join(limits, ["tongue", "size"], "left").select(
        "doc_id",
        *MEASURES,
        "base_failed",
        F.pow(F.lit(2.0), F.col("cost")).alias("perplexity"),
        (~F.col("base_failed") & within).alias("kept"),
    )
