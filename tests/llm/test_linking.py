"""Bucket linking finds the components of all linked pairs that share a bucket, in every way of dividing the work."""

import numpy as np
import pytest

from strandline.llm import components


@pytest.mark.parametrize("large,size", [(2, 64), (3, 8 << 20), (1000, 64), (1000, 8 << 20)])
def test_components_of_shared_buckets(spark, monkeypatch, large, size):
    monkeypatch.setattr(components, "LARGE", large)
    monkeypatch.setattr(components, "BLOCK_BYTES", size)
    rng = np.random.default_rng(8)
    n = 120
    place = rng.integers(0, 400, n)
    keys = [[int(k) for k in {1_000 + place[i] // 100, 2_000 + (place[i] + 50) // 100, 3_000 + i % 7}] for i in range(n)]
    linked = lambda a, b: abs(int(a) - int(b)) <= 2
    label = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(i):
                if set(keys[i]) & set(keys[j]) and linked(place[i], place[j]):
                    label[i] = label[j] = min(label[i], label[j])
    want = {i: label[i] for i in range(n) if label.count(label[i]) > 1}
    nodes = spark.createDataFrame([(i, keys[i]) for i in range(n)], "node long, keys array<long>").repartition(4)
    data = spark.createDataFrame([(i, int(place[i]).to_bytes(8, "little")) for i in range(n)], "node long, data binary")
    near = spark.createDataFrame([(i, j) for i in range(n) for j in range(n) if linked(place[i], place[j])], "a long, b long")

    def prepare(items):
        values = np.array([int.from_bytes(x, "little") for x in items])
        return lambda one: np.abs(values - int.from_bytes(one, "little")) <= 2

    found = components.link_buckets(
        nodes, lambda ids: data.join(ids, "node", "left_semi"), lambda both: both.select("a", "b").join(near, ["a", "b"], "left_semi"), prepare
    )
    assert {r.node: r.component for r in found.collect()} == want
