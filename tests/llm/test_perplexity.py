"""The model of character runs behind the perplexities against brute force, and what its bands must tell apart."""

import collections
import math
import random
import re

import numpy as np
import pytest

from vaultline.llm.kneser_ney import ORDER, SortedArrays, judge_perplexity, run_keys, runs_of
from vaultline.llm.tables import table

COLUMNS = "doc_id long, text string, lang string"


def plain(text):
    return re.sub(r"[ \t-\r]+", " ", text or "").strip(" ").replace("\0", "\ufffd")


def runs(text, order=ORDER):
    line = " " * (order - 1) + plain(text) + " "
    return [line[i : i + order] for i in range(len(line) - order + 1)] if plain(text) else []


def discounts_of(counts):
    of = [max(1, sum(n == k for n in counts)) for k in (1, 2, 3, 4)]
    ratio = of[0] / (of[0] + 2 * of[1])
    found = [k - (k + 1) * ratio * of[k] / of[k - 1] for k in (1, 2, 3)]
    return [0.0, *(d if 0 < d < k else k / 2 for k, d in zip((1, 2, 3), found))]


class Brute:
    """Of the texts of one language."""

    def __init__(self, texts):
        counts, owners = collections.Counter(), collections.defaultdict(set)
        for text in texts:
            for run in runs(text):
                counts[run] += 1
                owners[run].add(text)
        self.tables = {ORDER: {r: n if len(owners[r]) > 1 else 0 for r, n in counts.items()}}
        self.discounts = {ORDER: discounts_of(counts.values())}
        for order in range(ORDER - 1, 0, -1):
            longer = self.tables[order + 1]
            self.tables[order] = {r[1:]: 0 for r in longer}
            for run, n in longer.items():
                self.tables[order][run[1:]] += n > 0
            self.discounts[order] = discounts_of(self.tables[order].values())
        self.known = {}

    def probability(self, run):
        if run not in self.known:
            order = len(run)
            below = self.probability(run[1:]) if order > 1 else 1 / (len(self.tables[1]) + 1)
            same = [n for r, n in self.tables[order].items() if r[:-1] == run[:-1]]
            cut = [self.discounts[order][min(n, 3)] for n in same]
            own = self.tables[order].get(run, 0)
            own -= self.discounts[order][min(own, 3)]
            self.known[run] = (own + sum(cut) * below) / sum(same) if sum(same) else below
        return self.known[run]

    def log_perplexity(self, text):
        found = [-math.log(self.probability(r)) for r in runs(text)]
        return sum(found) / len(found) if found else None


def test_perplexity_by_brute_force(spark, monkeypatch):
    draw = random.Random(8)
    texts = [("".join(draw.choice(list("abcé  \n\t漢\0😀")) for _ in range(draw.randint(0, 60))), lang) for lang in ["en", "de", None, ""] * 8]
    texts += [texts[0], texts[0], ("  ", "en"), (None, "en"), ("only one of its language", "xx"), ("x", "xx")]
    frame = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], COLUMNS).repartition(3)
    models = {lang: Brute([t for t, l in texts if l == lang and t]) for lang in ("en", "de", None, "", "xx")}
    expected = {i: models[lang].log_perplexity(text) for i, (text, lang) in enumerate(texts)}
    for frequent in (1 << 19, 40, 0):  # all runs broadcast, some, none
        monkeypatch.setattr("vaultline.llm.kneser_ney.FREQUENT", frequent)
        monkeypatch.setattr("vaultline.llm.kneser_ney.RANGE", 50)
        found = {r.doc_id: r.perplexity for r in judge_perplexity(frame).collect()}
        assert set(found) == set(expected)
        for i, want in expected.items():
            assert (found[i] is None) == (want is None)
            assert want is None or math.log(found[i]) == pytest.approx(want)


def test_probabilities_of_all_characters_add_up():
    model = Brute(["the cat sat on the mat", "the dog sat on the log", "a cat and a dog"])
    characters = [*model.tables[1], "?"]  # all known ones, and what stands for any other
    for context in ("the ", "at o", "sat ", "zzzz"):
        assert sum(model.probability(context + c) for c in characters) == pytest.approx(1)


def test_runs_of_texts():
    texts = ["  ab\n\nc ", "", None, "\t", "é漢😀", "a", " \x0b x\u00a0y"]
    found = runs_of(texts, np.arange(len(texts)))
    got = collections.defaultdict(list)
    rows = found.characters(np.arange(len(found.key)))
    for text, row in zip(found.text.tolist(), rows.tolist()):
        got[text].append("".join(map(chr, row)))
    assert {i: got[i] for i in range(len(texts))} == {i: runs(t) for i, t in enumerate(texts)}
    assert (run_keys(found.text, rows) == found.key).all()


def test_sorted_arrays_find_what_they_hold():
    draw = np.random.default_rng(3)
    for size in (0, 1, 2, 1000):
        key = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
        arrays = SortedArrays(key[::-1], np.arange(len(key))[::-1].astype(float))
        assert (arrays.find(key) == np.arange(len(key))).all()
        assert np.isnan(arrays.find(draw.integers(0, 2**64, 50, dtype=np.uint64))).all()


def test_tasks_that_emit_early_count_the_same(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(i, "".join(draw.choice("abc ") for _ in range(200)), "en") for i in range(30)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(2)
    expected = {r.doc_id: r.perplexity for r in judge_perplexity(frame).collect()}
    monkeypatch.setattr("vaultline.llm.kneser_ney.HELD", 100)
    monkeypatch.setattr("vaultline.llm.spans.CHUNK", 300)
    found = {r.doc_id: r.perplexity for r in judge_perplexity(frame).collect()}
    assert found == pytest.approx(expected)


def planted(spark, folder, lang, draw):
    """Shuffled words, random letters, and texts of other languages, labelled as one language."""
    docs = table(spark, folder, "documents").where("text is not null").collect()
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    clean = [r for r in docs if labels.get(r.doc_id) == 1 and len(r.text.split()) >= 60]
    own = [r for r in clean if r.lang == lang and len(r.text.split()) <= 1000]
    letters = "abcdefghijklmnopqrstuvwxyz"

    def shuffled(text):
        words = text.split()
        draw.shuffle(words)
        return " ".join(words)

    count = sum(r.lang == lang for r in docs) // 100
    others = [r for r in clean if r.lang != lang and len(r.text.split()) <= 1000]
    kinds = {
        "shuffled": [shuffled(r.text) for r in draw.sample(own, count)],
        "letters": ["".join(c if c.isspace() else draw.choice(letters) for c in r.text) for r in draw.sample(own, count)],
        "foreign": [r.text for r in draw.sample(others, count)],
    }
    return docs, clean, kinds


@pytest.mark.parametrize("lang, most_shuffled", [("en", 0.25), ("de", 0.25), ("fr", 0.25), ("es", 0.5)])
def test_bands_reject_what_is_no_text_of_the_language(spark, lang, most_shuffled):
    """On the documents of the middle size, with one of each kind planted for a hundred documents of the language.

    Words of these documents are drawn one by one, so shuffling them only shows where sentences begin and end: the
    more texts of a language there are to learn from, the more such texts are found.
    """
    docs, clean, kinds = planted(spark, "/root/testdata/sf0.1", lang, random.Random(4))
    extra = [(-1 - i, text, kind) for i, (kind, text) in enumerate((k, t) for k, ts in kinds.items() for t in ts)]
    rows = [(i, text, lang) for i, text, _ in extra]
    frame = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in docs if r.lang == lang] + rows, COLUMNS)
    kept = {r.doc_id for r in judge_perplexity(frame.repartition(8)).where("kept").collect()}
    share = {kind: sum(i in kept for i, _, k in extra if k == kind) / len(texts) for kind, texts in kinds.items()}
    good = [r.doc_id for r in clean if r.lang == lang]
    rejected = sum(i not in kept for i in good) / len(good)
    assert share["letters"] == 0 and share["foreign"] <= 0.1 and share["shuffled"] <= most_shuffled, share
    assert rejected <= 0.03, rejected


def test_copies_fare_like_their_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    copies = docs.withColumn("doc_id", docs["doc_id"] + 10**6)
    found = {r.doc_id: (r.kept, r.perplexity) for r in judge_perplexity(docs.unionByName(copies)).collect()}
    assert all(found[i] == pytest.approx(found[i + 10**6]) for i in found if i < 10**6)


def test_shuffled_words_and_other_languages_are_out_of_band(spark):
    random = np.random.default_rng(9)

    def speech(prefix):
        words = [f"{prefix}{i}" for i in range(200)]
        after = {w: list(random.choice(words, 3)) for w in words}

        def text():
            line = [str(random.choice(words))]
            while len(line) < 120:
                line.append(str(random.choice(after[line[-1]])))
            return line

        return text

    english, german = speech("e"), speech("ü")
    rows = [(i, " ".join(english()), "en") for i in range(200)] + [(200 + i, " ".join(german()), "de") for i in range(200)]
    rows += [(400 + i, " ".join(random.permutation(english())), "en") for i in range(5)]
    rows += [(410 + i, " ".join(german()), "en") for i in range(5)]
    kept = {r.doc_id for r in judge_perplexity(spark.createDataFrame(rows, COLUMNS)).where("kept").collect()}
    assert len([i for i in kept if i < 400]) >= 392 and not [i for i in kept if i >= 400]
