"""The plans for tables too large to be sent to all executors give the same rows."""

import numpy as np
import pytest
from llm_rows import edge_docs, prose

from wardflow.llm import blocks, probminhash, projections


@pytest.fixture
def nothing_is_sent(monkeypatch):
    for module, name in ((blocks, "BROADCAST_GROUPS"), (probminhash, "BROADCAST_IDS"), (projections, "BROADCAST_LABELS")):
        monkeypatch.setattr(module, name, -1)


def embeddings(spark):
    rng = np.random.default_rng(8)
    rows = []
    for label in range(3):
        common = rng.normal(size=16) * 2
        for _ in range(60):
            x = rng.normal(size=16) + common
            rows += [(len(rows) + k, (x + rng.normal(size=16) * .05 * k).tolist(), label) for k in range(3)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def documents(spark):
    texts = [prose(i, 80) for i in range(12)]
    rows = [(100 + i, t.replace(t.split()[k], f"other{k}", 1)) for i, (t, k) in enumerate((t, k) for t in texts for k in range(6))]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    return edge_docs(spark).select("doc_id", "text").union(more).repartition(3)


FOUND = {}


@pytest.mark.parametrize("large", [False, True])
def test_embeddings(spark, large, request):
    if large:
        request.getfixturevalue("nothing_is_sent")
    rows = projections.embedding_duplicates(embeddings(spark), block=32, window=4, passes=3).collect()
    assert FOUND.setdefault("embeddings", sorted(map(tuple, rows))) == sorted(map(tuple, rows)) and any(r["n_links"] for r in rows)


@pytest.mark.parametrize("large", [False, True])
def test_documents(spark, large, request):
    if large:
        request.getfixturevalue("nothing_is_sent")
    rows = sorted(map(tuple, probminhash.near_duplicates(documents(spark)).collect()), key=str)
    assert FOUND.setdefault("documents", rows) == rows
