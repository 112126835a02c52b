"""Alignment, byte-pair encoding and whitening against the libraries and plain versions."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from edge_rows import edge_docs  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vaultline.llm import alignment, queries
from vaultline.llm.alignment import KIND, align_documents, fragment, links_of, packed, ranges, read_piece_model, score_links, unpacked
from vaultline.llm.byte_pairs import PairEncoder, encode_byte_pairs, load_byte_pairs, model_digest
from vaultline.llm.tables import table
from vaultline.llm.whitening import fit_whitening, pivoted_cholesky, principal, turned_columns, whiten, whole_vector

SYMBOLS = [*" \n\t'stmdrevlxA9é中!.  ́😀 \0", "the", "ing", "'s", "'ll", "'re", "Ⅷ", "࢏", "  ", "Ünd", "<|endoftext|>", "<|endoftext|"]


def random_texts(count, extra=(), seed=1, most=60):
    draw = random.Random(seed)
    symbols = [*SYMBOLS, *extra]
    return ["".join(draw.choice(symbols) for _ in range(draw.randint(0, most))) for _ in range(count)]


@pytest.fixture(scope="module")
def byte_model():
    return load_byte_pairs(queries.BYTE_MODEL)


@pytest.fixture(scope="module")
def piece_model():
    return read_piece_model(queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def plain_library():
    """The library with the texts of added tokens as plain text."""
    tokenizer = Tokenizer.from_file(queries.BYTE_MODEL)
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(encoder, texts):
    tokens, bounds = encoder.encode(texts)
    return [tokens[a:b].tolist() for a, b in zip(bounds, bounds[1:])], encoder.decode(tokens, bounds)


# --- byte pairs ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("special", [True, False])
def test_ids_and_texts_are_those_of_the_library(byte_model, special):
    library = Tokenizer.from_file(queries.BYTE_MODEL)
    library.encode_special_tokens = not special
    texts = random_texts(4000)
    found, decoded = ids_of(PairEncoder(byte_model, special), texts)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert found == expected
    assert decoded == [library.decode(ids, skip_special_tokens=False) for ids in expected] == texts


def test_long_fragments_without_any_cut(byte_model, plain_library):
    draw = random.Random(3)
    texts = ["a" * 30_000, "".join(draw.choice("abcdefgh") for _ in range(20_000)), "é中" * 5_000, "=" * 25, "=" * 24]
    found, _ = ids_of(PairEncoder(byte_model), texts)
    assert found == [plain_library.encode(t, add_special_tokens=False).ids for t in texts]


def test_no_token_reaches_over_a_sure_cut(byte_model):
    for i in range(byte_model.count - 1):
        raw = byte_model.text[byte_model.offset[i] : byte_model.offset[i + 1]].astype(int)
        assert byte_model.inside[raw[:-1] * 256 + raw[1:]].all()
    assert not byte_model.inside.all()


def test_forgetting_changes_nothing(byte_model, monkeypatch):
    texts = random_texts(300, seed=4)
    expected, _ = ids_of(PairEncoder(byte_model), texts)
    monkeypatch.setattr("vaultline.llm.byte_pairs.CACHE", 10)
    encoder = PairEncoder(byte_model)
    for _ in range(3):
        assert ids_of(encoder, texts)[0] == expected


def test_refused_vocabularies(tmp_path):
    with pytest.raises(ValueError):
        load_byte_pairs("/opt/tokenizers/word_bpe_49k.json")


def test_encode_byte_pairs_rows(spark, edge_docs, byte_model):
    library = Tokenizer.from_file(queries.BYTE_MODEL)
    rows = encode_byte_pairs(edge_docs, byte_model).collect()
    expected = [
        (r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids, r.text or "") for r in edge_docs.collect()
    ]
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]))
    assert sorted(((r.doc_id, r.token_ids, r.decoded) for r in rows), key=key) == sorted(expected, key=key)
    assert all(r.n_tokens == len(r.token_ids) for r in rows)
    assert encode_byte_pairs(edge_docs.limit(0), byte_model).count() == 0


def test_byte_pairs_query(spark, sf_dir):
    library = Tokenizer.from_file(queries.BYTE_MODEL)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = {}
    for row in table(spark, sf_dir, "documents").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[row.doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(decoded))
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.byte_pairs(spark, sf_dir).collect()}
    assert found == expected


# --- alignment ----------------------------------------------------------------------------------------


class Plain:
    """Alignment token by token."""

    def __init__(self, byte_model, plain_library):
        self.model, self.library = byte_model, plain_library
        self.names = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)

    def b_bytes(self, i):
        name = self.names.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.names.is_byte(i) else name.replace("▁", " ").encode()

    def __call__(self, text):
        nothing = (0, 0, 0, 0, "", {})
        if not text:
            return nothing
        a, b = self.library.encode(" " + text, add_special_tokens=False).ids, self.names.encode(text)
        offset = self.model.offset
        a_raw, b_raw = [self.model.text[offset[i] : offset[i + 1]].tobytes() for i in a], [self.b_bytes(i) for i in b]
        if b"".join(a_raw) != (" " + text).encode() or b"".join(b_raw) != (" " + text).encode():
            return nothing
        a_ends, b_ends = np.cumsum([len(x) for x in a_raw]).tolist(), np.cumsum([len(x) for x in b_raw]).tolist()
        groups, low = [], 0
        for high in sorted(set(a_ends) & set(b_ends)):
            sides = ([i for i, e in zip(ids, ends) if low < e <= high] for ids, ends in ((a, a_ends), (b, b_ends)))
            groups.append("|".join(",".join(map(str, side)) for side in sides))
            low = high
        kinds, j = collections.Counter(), 0
        for i, (start, end) in enumerate(zip([0, *a_ends], a_ends)):
            while b_ends[j] <= start:
                j += 1
            k = j
            while k < len(b) and (b_ends[k - 1] if k else 0) < end:
                kinds[a[i] * int(KIND) + b[k]] += 1
                k += 1
        return len(a), len(b), len(groups), sum(kinds.values()), ";".join(groups), dict(kinds)


@pytest.fixture(scope="module")
def plain(byte_model, plain_library):
    return Plain(byte_model, plain_library)


@pytest.fixture(scope="module")
def sides(byte_model, piece_model):
    return alignment.byte_side(byte_model.parts(), model_digest(byte_model)), alignment.piece_side(piece_model)


def test_fragments_compose_in_any_order(plain, sides):
    draw = random.Random(5)
    for text in random_texts(150, ["▁"], seed=6) + ["x" * 500, "word " * 60, "a ", "a  b", " "]:
        if not text:
            continue
        expected = plain(text)
        for size in (1, 2, 5, 17, 100):
            parts = [fragment(part, *sides) for part in ranges(" " + text, size)]
            while len(parts) > 1:
                i = draw.randrange(len(parts) - 1)
                parts[i : i + 2] = [parts[i].then(parts[i + 1])]
            if not parts[0].whole:
                assert expected[0] == 0
                continue
            whole = parts[0].finished()
            kinds = dict(zip(whole.kinds.tolist(), whole.counts.tolist()))
            assert (whole.n_a, whole.n_b, whole.n_groups, sum(kinds.values()), whole.groups.rstrip(";"), kinds) == expected


def test_fragments_are_open_at_both_ends(sides):
    text = " " + " ".join(random_texts(40, seed=9)).replace("▁", "")
    parts = [fragment(part, *sides) for part in ranges(text, 40)]
    assert any(len(p.prefix.a) > 1 for p in parts) and any(len(p.suffix.a) for p in parts[:-1])
    assert all(p.cut for p in parts) and sum(p.n_groups for p in parts)


def test_ranges_cover_a_text_and_reach_to_sure_cuts():
    for text in [" one two\n three  four five", " " + "x" * 50 + " y", " a" * 30, " ▁ ▁ b c"]:
        encoded = text.encode()
        for size in (1, 4, 10, 1000):
            parts = ranges(text, size)
            covered = b"".join(p.text.encode()[p.low : p.high] for p in parts)
            assert covered == encoded


def aligned_rows(df):
    return [
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, dict(zip(r.kinds, r.counts))) for r in df.collect()
    ]


@pytest.mark.parametrize("size", [20, alignment.RANGE])
def test_align_documents(spark, edge_docs, byte_model, piece_model, plain, size):
    texts = random_texts(60, ["▁"], seed=7) + ["word and " * 300]
    docs = edge_docs.unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"), allowMissingColumns=True
    )
    found = aligned_rows(align_documents(docs, byte_model, piece_model, size))
    expected = [(r.doc_id, *plain(r.text)) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert all(list(kinds) == sorted(kinds) for *_, kinds in found)


def plain_scores(rows):
    corpus = collections.Counter()
    for *_, kinds in rows:
        corpus.update(kinds)
    highest = collections.Counter()
    for kind, count in corpus.items():
        highest[kind % int(KIND)] = max(highest[kind % int(KIND)], count)
    return sorted(
        (
            (row[0] is None, row[0] or 0, row[1]),
            sum(n for kind, n in row[-1].items() if corpus[kind] == highest[kind % int(KIND)]),
            sum(n * corpus[kind] for kind, n in row[-1].items()),
        )
        for row in rows
    )


@pytest.mark.parametrize("block", [1, 500, alignment.BLOCK])
def test_score_links(spark, edge_docs, byte_model, piece_model, block, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", block)
    aligned = align_documents(edge_docs, byte_model, piece_model)
    found = score_links(aligned).collect()
    assert "kinds" not in found[0] and "counts" not in found[0]
    scores = sorted(((r.doc_id is None, r.doc_id or 0, r.n_a), r.n_best, r.count_sum) for r in found)
    assert scores == plain_scores(aligned_rows(aligned))


def test_alignment_of_nothing(spark, edge_docs, byte_model, piece_model):
    assert score_links(align_documents(edge_docs.limit(0), byte_model, piece_model)).count() == 0
    empty = align_documents(edge_docs.where("text is null or text = ''"), byte_model, piece_model)
    assert {(r.n_a, r.n_links, r.n_best, r.count_sum) for r in score_links(empty).collect()} == {(0, 0, 0, 0)}


def test_alignment_query(spark, sf_dir, plain):
    rows = [(r.doc_id, *plain(r.text)) for r in table(spark, sf_dir, "documents").collect()]
    digest = {r[0]: hashlib.sha256(r[5].encode()).hexdigest() if r[1] else "" for r in rows}
    found = queries.alignment(spark, sf_dir).collect()
    assert {r.doc_id: r.groups_sha256 for r in found} == digest
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links) for r in found} == {r[0]: r[1:5] for r in rows}
    assert sorted(((False, r.doc_id, r.n_a), r.n_best, r.count_sum) for r in found) == plain_scores(rows)


def test_packed_numbers():
    draw = np.random.default_rng(8)
    numbers = np.concatenate([[0, 1, 127, 128, 16383, 16384, 2**62, 2**63 - 1], draw.integers(0, 2**40, 200)])
    data, places = packed(numbers)
    assert (unpacked(data) == numbers).all() and places[-1] == len(data)
    held = alignment._Numbered()
    kinds = [sorted(draw.choice(50, size=n, replace=False).tolist()) for n in (5, 0, 30, 1, 50)]
    for _ in range(2):
        counts = [draw.integers(1, 400, len(k)).tolist() for k in kinds]
        bounds = np.cumsum([0, *map(len, kinds)])
        links = held.add(np.concatenate(kinds).astype(np.int64), np.concatenate(counts).astype(np.int64), bounds)
        name = np.empty(len(held.kinds), dtype=np.int64)
        name[held.numbers] = held.kinds
        for entry, k, c in zip(links.to_pylist(), kinds, counts):
            numbers, n = links_of(entry)
            assert dict(zip(name[numbers].tolist(), n.tolist())) == dict(zip(k, c))


# --- whitening ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("size, rank", [(1, 1), (2, 2), (7, 7), (16, 5), (33, 33)])
def test_cholesky_and_jacobi(size, rank):
    draw = np.random.default_rng(size)
    half = draw.normal(size=(size, rank)) * np.logspace(0, -3, rank)
    matrix = half @ half.T
    lower, order = pivoted_cholesky(matrix)
    assert lower.shape == (size, rank) and np.allclose(lower, np.tril(lower))
    assert np.allclose(lower @ lower.T, matrix[np.ix_(order, order)], atol=1e-12)
    turned = turned_columns(lower)
    cross = turned.T @ turned
    assert np.abs(cross - np.diag(np.diag(cross))).max() < 1e-12
    values, vectors = principal(matrix)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-6)
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12)


def test_a_matrix_of_zeros_has_no_component():
    values, vectors = principal(np.zeros((3, 3)))
    assert values.shape == (0,) and vectors.shape == (3, 0)


def plain_whitening(vectors, count=16):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:count], components[:, ::-1][:, :count]
    white = (x - sums / n) @ (components / np.sqrt(values))
    return n, ((n * x - sums) ** 2).sum(axis=1), np.abs(white), values / np.trace(centred.T @ centred / n)


def test_whitening_query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    n, deviation, white, explained = plain_whitening([r.embedding for r in rows])
    found = queries.whitening(spark, sf_dir).orderBy("vec_id", "component").toPandas()
    assert found.columns[:7].tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(found) == 16 * len(rows) and set(found["n"]) == {n}
    assert (found["deviation"].to_numpy().reshape(-1, 16) == deviation[:, None]).all()
    assert np.allclose(np.abs(found["whitened"].to_numpy().reshape(-1, 16)), white, atol=1e-8)
    assert np.allclose(found["explained"].to_numpy().reshape(-1, 16), explained, rtol=1e-9)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-9


EDGE_VECTORS = [
    (1, [0.5, -0.25, 0.125]), (2, [0.5, -0.25, 0.125]), (2, [0.5, -0.25, 0.125]), (3, None), (4, [1.0, None, 2.0]),
    (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]), (7, []), (8, [0.1, 0.2]), (9, [1.5, 0.75, -3.0]),
    (None, [0.0, 0.5, 0.25]), (10, [1e300, 0.0, 0.0]), (11, [-0.01, 0.02, 0.0]),
]


def test_whitening_edge_rows(spark):
    df = spark.createDataFrame(EDGE_VECTORS, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "1 as n", "2 as x", "'a' as component")
    found = whiten(df).collect()
    kept = [(i, v) for i, v in EDGE_VECTORS if i in (1, 2, 9, None, 11)]
    n, deviation, white, explained = plain_whitening([v for _, v in kept], 3)
    assert n == 4 and len(found) == 3 * len(kept)
    expected = sorted(
        ((i is None, i or 0), k + 1, int(deviation[j]), round(float(white[j, k]), 6))
        for j, (i, _) in enumerate(kept)
        for k in range(3)
    )
    got = sorted(((r.vec_id is None, r.vec_id or 0), r.component, r.deviation, round(abs(r.whitened), 6)) for r in found)
    assert got == expected
    assert {r.n for r in found} == {4} and all(r.identity_error < 1e-9 for r in found)


def test_whitening_without_variance_or_rows(spark):
    same = spark.createDataFrame([(i, [0.5, 0.5]) for i in range(3)], "vec_id long, embedding array<float>")
    assert whiten(same).count() == 0
    assert whiten(same.limit(0)).count() == 0
    assert whiten(same.where("vec_id = 0").withColumn("embedding", same["embedding"].cast("array<double>"))).count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    far = spark.createDataFrame([(1, [2.0**28, 0.0]), (2, [-(2.0**28), 1.0]), (3, [0.5, 2.0])], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.deviation for r in whiten(far).collect()}
    x = [[int(64 * a) + 10**6 for a in v] for v in ([2**28, 0], [-(2**28), 1], [0.5, 2])]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert found == {i + 1: e if e < 2**63 else None for i, e in enumerate(exact)}
    assert None in found.values()


def test_covariance_does_not_depend_on_partitions(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(whole_vector(F.col("embedding")).alias("x"))
    one, two = fit_whitening(vectors.repartition(1)), fit_whitening(vectors.repartition(5))
    assert (one.eigenvalues == two.eigenvalues).all() and (one.components == two.components).all()
