"""Line dedup learns all templates of a leaf, however many there are."""

import numpy as np
import pytest

from vaultline.llm import template_lines
from vaultline.llm.template_lines import drop_recurring_lines


@pytest.mark.parametrize("heads", [2, 16])
def test_every_template_of_a_leaf(spark, monkeypatch, heads):
    monkeypatch.setattr(template_lines, "HEADS", heads, raising=False)
    random = np.random.default_rng(3)
    # Six families in one leaf: the leading tokens hold digits. Each variant has one free word.
    families = [[f"f{chr(97 + f)}{chr(97 + k)}" for k in range(8)] for f in range(6)]
    texts, own = {}, {}
    for i in range(60):
        tail = list(families[i % 6])
        tail[random.integers(0, 8)] = "free" + "".join(chr(97 + int(c)) for c in str(i))
        texts[i] = f"{i} 1{i} 2{i} 3{i} " + " ".join(tail)
        own[i] = f"alone {'x' * (i + 1)} as no other line of these is it"
    rows = [(i, f"{text}\n{own[i]}") for i, text in texts.items()]
    found = {r.doc_id: r for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # Lines of a family differ in two of twelve places at most, lines of others in seven at least.
    first = {f: min(i for i in texts if i % 6 == f) for f in range(6)}
    for i in texts:
        assert found[i].n_dropped == (i != first[i % 6])
        assert found[i].text == (f"{texts[i]}\n{own[i]}" if i == first[i % 6] else own[i])
