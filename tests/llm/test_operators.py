"""The corpus operators against brute force, on the edge rows and on the smallest tables."""

import collections
import math
import zlib

import numpy as np
import pytest
from edge_rows import EDGE_TEXTS, edge_docs  # noqa: F401

from vaultline.llm import queries
from vaultline.llm.components import components
from vaultline.llm.crf_quality import chain_marginals, fit_field, score_quality
from vaultline.llm.itq_dedup import itq_components
from vaultline.llm.jaccard_join import jaccard_components
from vaultline.llm.kneser_ney import base_measures, judge_perplexity
from vaultline.llm.longest_match import build, count_tokens, piece_counts, read_pieces
from vaultline.llm.mixing import mix_sources
from vaultline.llm.piece_matching import Encoder, encode_documents, load_pieces
from vaultline.llm.spans import Words
from vaultline.llm.tables import table
from vaultline.llm.template_lines import drop_recurring_lines
from vaultline.llm.url_trie import RuleTrie, judge_urls
from vaultline.llm.weak_toxicity import score_toxicity

@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(3, 0, 1), (4, 1, 0), (4, 1, 0), (5, 1, 0), (6, None, None), (None, 1, 1), (7, 2, 5), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_jaccard(texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in smallest_reachable(ids, links).items()}


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 200), (200, 300), (7, 7), (None, 3)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}


def test_jaccard_on_the_tables(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.jaccard_join(spark, sf_dir).collect()}
    assert found == brute_jaccard(texts, 4, 85)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_on_edited_copies(spark, seed):
    random = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    texts = {}
    for family in range(6):
        base = list(random.choice(words, 60))
        for _ in range(12):
            copy = list(base)
            for _ in range(random.integers(0, 4)):
                copy[random.integers(0, 60)] = str(random.choice(words))
            texts[len(texts)] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, 4, 85).collect()}
    assert found == brute_jaccard(texts, 4, 85)


def test_jaccard_edges(edge_docs):
    rows = jaccard_components(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, None: None}
    assert jaccard_components(edge_docs.limit(0)).count() == 0


def test_vectors(spark):
    random = np.random.default_rng(4)
    rows = []
    for _ in range(30):
        base = random.standard_normal(64)
        rows += [(base + 0.2 * random.standard_normal(64), 1) for _ in range(8)]
    odd = [None, [0.0] * 64, [float("nan")] * 64, [1.0, None], [], [1.0, 2.0], [1.0, 2.0]]
    data = [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]
    data += [(len(data) + i, v, 1) for i, v in enumerate(odd)] + [(1000, data[0][1], None), (1001, data[0][1], 2)]
    data += [data[0], (None, data[0][1], 1)]
    frame = spark.createDataFrame([(*d, "x") for d in data], "vec_id long, embedding array<double>, label int, node string")
    found = itq_components(frame).collect()
    assert len(found) == len(data)
    wide = [d for d in data if d[1] and len(d[1]) == 64 and d[2] == 1 and all(math.isfinite(x) for x in d[1]) and any(d[1])]
    unit = np.array([d[1] for d in wide])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & ~np.eye(len(unit), dtype=bool)
    by_id = collections.defaultdict(set)
    for r in found:
        by_id[r.vec_id].add(r.n_links)
    wanted = sum(near.sum(axis=1))
    got = sum(sum(by_id[d[0]]) for d in wide)
    assert 0.9 * wanted <= got <= wanted
    assert by_id[240] == {0} and by_id[245] == by_id[246] == {1} and by_id[1000] == by_id[1001] == {0}
    assert itq_components(frame.limit(0)).count() == 0


def test_chain_marginals_against_all_labellings():
    random = np.random.default_rng(3)
    scores, turns, bounds = random.standard_normal(4), random.standard_normal((2, 2)), np.array([0, 3, 4])
    good, at, joint, totals = chain_marginals(scores, turns, bounds)
    weights = {}
    for code in range(8):
        y = [code >> i & 1 for i in range(3)]
        weights[tuple(y)] = math.exp(sum(scores[i] * y[i] for i in range(3)) + turns[y[0], y[1]] + turns[y[1], y[2]])
    total = sum(weights.values())
    assert totals[0] == pytest.approx(math.log(total))
    for i in range(3):
        assert good[i] == pytest.approx(sum(w for y, w in weights.items() if y[i]) / total)
    assert joint[0, 0, 1] == pytest.approx(sum(w for y, w in weights.items() if y[:2] == (0, 1)) / total)
    assert list(at) == [0, 1]


def held_out_accuracy(spark, sf_dir, rows, label):
    labels = {r.doc_id: r[label] for r in table(spark, sf_dir, "labels").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    return sum(r.predicted == labels[r.doc_id] for r in held) / len(held)


def test_quality(spark, sf_dir, edge_docs, edge_labels):
    assert held_out_accuracy(spark, sf_dir, queries.crf_quality(spark, sf_dir).collect(), "quality") >= 0.9
    rows = score_quality(edge_docs, fit_field(edge_docs, edge_labels)).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = edge_docs.limit(0)
    assert score_quality(empty, fit_field(empty, edge_labels.limit(0))).count() == 0


def test_toxicity(spark, sf_dir, edge_docs, edge_labels):
    assert held_out_accuracy(spark, sf_dir, queries.weak_toxicity(spark, sf_dir).collect(), "toxic") >= 0.85
    rows = score_toxicity(edge_docs, edge_labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert score_toxicity(edge_docs.limit(0), edge_labels.limit(0)).count() == 0


def test_perplexity(edge_docs):
    rows = judge_perplexity(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert judge_perplexity(edge_docs.limit(0)).count() == 0


def brute_measures(text):
    words = (text or "").encode().split()
    trios = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if trios[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    earlier = sum(line in lines[:i] for i, line in enumerate(lines))
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), earlier, len(covered)


@pytest.mark.parametrize("text", [*EDGE_TEXTS, "a a a a", "a b c x a b c b c x\na b\n\na b\n a b", "x\u00a0y z"])
def test_base_measures(text):
    assert base_measures(text) == brute_measures(text)


def test_urls(spark):
    rows = [(1, None), (2, "no mark"), (3, "http://A.Example.ORG:80/en/12?x#y"), (4, "x://example.org/en/1"),
            (5, "x://notexample.org/en/1"), (6, "x://shop.com/de"), (7, "x://shop.com/de/x"), (8, "x://org"), (None, "x://org/"),
            (4, "x://example.org/en/1")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string")
    found = [(r.page_id, r.host, r.rule, r.verdict) for r in judge_urls(frame, queries.RULES).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, "", None, "allow"), (2, "", None, "allow"), (3, "a.example.org:80", None, "allow"),
         (4, "example.org", "example.org/en/1", "block"), (4, "example.org", "example.org/en/1", "block"),
         (5, "notexample.org", "org/", "allow"), (6, "shop.com", None, "allow"), (7, "shop.com", "com/de/", "block"),
         (8, "org", None, "allow"), (None, "org", "org/", "allow")], key=str)
    trie = RuleTrie([("allow", "a.b/"), ("block", "a.b/"), ("allow", "b/x/yy")])
    assert trie.find("c.a.b", "/x/yyz") == ("allow", "b/x/yy") and trie.find("a.b", "/") == ("block", "a.b/")
    assert judge_urls(frame.limit(0), queries.RULES).count() == 0


def test_template_lines(spark, edge_docs):
    passage = " ".join(f"word{chr(97 + i % 26)}" for i in range(55))
    rows = [(1, f"Page 3 of 10 in this book\n{passage}\nonly here is this first line", "k"),
            (2, f"Page 44 of 99 in this book\nonly there is another second line\n{passage}", None),
            (3, "the quick brown fox jumps over the lazy dog and runs home today\nshort one", None),
            (4, "the quick brown fox jumps over the sleepy dog and runs home today\nshort one", None),
            (5, "twice in one document only\ntwice in one document only", None), (None, passage, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, places string")
    found = {r.doc_id: (r.text, r.n_dropped) for r in drop_recurring_lines(frame).collect()}
    assert found[1] == (rows[0][1], 0) and found[2] == ("only there is another second line", 2)
    assert found[3] == (rows[2][1], 0) and found[4] == ("short one", 1)
    assert found[5] == (rows[4][1], 0) and found[None] == (passage, 0)
    edges = drop_recurring_lines(edge_docs)
    assert edges.count() == edge_docs.count() and set(edge_docs.columns) < set(edges.columns)
    assert drop_recurring_lines(edge_docs.limit(0)).count() == 0


def test_mixing(spark, edge_docs):
    from pyspark.sql import functions as F

    rows = [(i, "w " * 10, "en" if i < 60 else "fr", "a" if i % 2 else "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    weights = [F.lit(1), F.expr("case mix_lang when 'en' then 3 else 1 end"), F.lit(1)]
    taken = mix_sources(docs, F.lit("all"), weights, 50, 1).groupBy("lang").agg(F.sum("taken_tokens").alias("n"))
    assert {r.lang: r.n for r in taken.collect()} == {"en": 374, "fr": 124}  # each of two sources rounds down
    # English can give no more than it has; the shortage goes to its sibling.
    taken = mix_sources(docs, F.lit("all"), weights, 90, 1).groupBy("lang").agg(F.sum("taken_tokens").alias("n"))
    assert {r.lang: r.n for r in taken.collect()} == {"en": 600, "fr": 300}
    edges = mix_sources(edge_docs, F.col("source"), weights, 100, 2)
    assert set(edge_docs.columns) < set(edges.columns)
    assert mix_sources(edge_docs.limit(0), F.col("source"), weights).count() == 0


def test_sentencepiece(edge_docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    pieces = load_pieces(queries.PIECE_MODEL)
    random = np.random.default_rng(5)
    texts = ["".join(random.choice(list("abcdetinrs  é漢😀\n"), random.integers(0, 90))) for _ in range(800)]
    encoder = Encoder(pieces)
    tokens, bounds = encoder.encode(texts)
    assert [tokens[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == library.encode(texts)
    assert encoder.decode(tokens, bounds) == texts
    rows = encode_documents(edge_docs, pieces).collect()
    wanted = sorted(str(library.encode(r.text or "")) for r in edge_docs.collect())
    assert sorted(str(list(r.token_ids)) for r in rows) == wanted
    assert encode_documents(edge_docs.limit(0), pieces).count() == 0


def greedy(word, pieces):
    word, start, count = b" " + word, 0, 0
    while start < len(word):
        end = next((e for e in range(len(word), start, -1) if word[start:e] in pieces), None)
        if end is None:
            return -1
        start, count = end, count + 1
    return count


def test_longest_match(edge_docs):
    random = np.random.default_rng(6)
    for _ in range(200):
        pieces = {bytes(random.choice(list(b"ab "), random.integers(1, 5))) for _ in range(random.integers(1, 9))}
        words = Words([" ".join(bytes(random.choice(list(b"abc"), random.integers(1, 9))).decode() for _ in range(20))])
        text = words.buffer.tobytes()
        found = piece_counts(build(pieces), words.buffer, words.starts, words.ends)
        assert found.tolist() == [greedy(text[a:b], pieces) for a, b in zip(words.starts, words.ends)]
    pieces = read_pieces(queries.PIECE_LIST)
    known = set(pieces)
    rows = sorted((r.doc_id or -1, r.n_tokens) for r in count_tokens(edge_docs, pieces).collect())
    wanted = sorted((r.doc_id or -1, sum(greedy(w, known) for w in (r.text or "").encode().split())) for r in edge_docs.collect())
    assert rows == wanted
    assert count_tokens(edge_docs.limit(0), pieces).count() == 0
