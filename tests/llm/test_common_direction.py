"""Near-duplicate vectors that share a direction, as embeddings do, against brute force."""

import numpy as np
import pytest

from vaultline.llm import itq_dedup
from vaultline.llm.itq_dedup import itq_components


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked(spark, common, size=64, count=600):
    """Links found and wanted, of pairs planted around a cosine of 0.93; ``common``: share of the squared norm."""
    random = np.random.default_rng(5)
    own = unit(random.standard_normal((count, size)))
    alike = (0.935 - common) / (1 - common)
    half = count // 2
    own[half:] = alike * own[:half] + np.sqrt(1 - alike**2) * own[half:]
    direction = unit(random.standard_normal((1, size)))
    vectors = unit(np.sqrt(common) * direction + np.sqrt(1 - common) * unit(own))
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sum(r.n_links for r in itq_components(frame).collect())
    return found, int(((vectors @ vectors.T >= 0.93) & ~np.eye(count, dtype=bool)).sum())


@pytest.mark.parametrize("common", [0.5, 0.8])
def test_links_beside_a_common_direction(spark, common):
    found, wanted = linked(spark, common)
    assert wanted > 200 and 0.95 * wanted <= found <= wanted


def test_all_pairs_where_codes_find_too_few(spark, monkeypatch):
    monkeypatch.setattr(itq_dedup, "MOST_CODES", 1, raising=False)
    found, wanted = linked(spark, 0.8)
    assert found == wanted
