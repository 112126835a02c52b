"""Weights of 0 take nothing, on any level of the tree."""

import pytest
from pyspark.sql import functions as F

from vaultline.llm.mixing import leaf_budgets, mix_sources

WORDS = {("d1", "en", "a"): 40, ("d1", "en", "b"): 30, ("d1", "fr", "a"): 20, ("d2", "en", "a"): 60, ("d2", "de", "c"): 10}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (n * 100 + i, "w w", lang, source, domain)
        for n, ((domain, lang, source), words) in enumerate(WORDS.items())
        for i in range(words // 2)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")


def taken(docs, weights, percent=50, epochs=1):
    mixed = mix_sources(docs, F.col("domain"), [F.expr(w) for w in weights], percent, epochs)
    rows = mixed.groupBy("domain", "lang", "source").agg(F.sum("taken_tokens").alias("n")).collect()
    return {(r.domain, r.lang, r.source): r.n for r in rows}


def test_a_domain_of_weight_0(docs):
    got = taken(docs, ["if(mix_domain = 'd1', 0, 1)", "1", "1"])
    assert got == {("d2", "en", "a"): 60, ("d2", "de", "c"): 10}  # all there is, less than the budget of 80


def test_a_language_of_weight_0(docs):
    got = taken(docs, ["1", "if(mix_lang = 'en', 0, 1)", "1"])
    assert got == {("d1", "fr", "a"): 20, ("d2", "de", "c"): 10}


def test_a_source_of_weight_0_leaves_its_share_to_its_siblings(docs):
    got = taken(docs, ["1", "1", "if(mix_source = 'b', 0, 1)"], percent=25)
    assert got == {("d1", "en", "a"): 10, ("d1", "fr", "a"): 10, ("d2", "en", "a"): 10, ("d2", "de", "c"): 10}


@pytest.mark.parametrize("weights", [["0", "1", "1"], ["1", "0", "1"], ["1", "1", "0"], ["0", "0", "0"], ["-1", "null", "1"]])
def test_nothing_has_a_weight(docs, weights):
    assert taken(docs, weights) == {}


def test_budgets_of_weight_0_are_0(spark):
    leaves = spark.createDataFrame(
        [(*k, words, 1) for k, words in WORDS.items()], "mix_domain string, mix_lang string, mix_source string, tokens long, docs long"
    )
    weights = [F.lit(1), F.lit(1), F.expr("if(mix_source = 'a', 0, 2)")]
    budgets = {(r.mix_domain, r.mix_lang, r.mix_source): r.budget for r in leaf_budgets(leaves, weights, 100, 1).collect()}
    assert budgets == {k: 0 if k[2] == "a" else n for k, n in WORDS.items()}
