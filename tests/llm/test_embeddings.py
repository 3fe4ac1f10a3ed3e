import numpy as np
import pytest

from lanemesh.llm import embeddings, graph

DDL = "vec_id long, embedding array<float>, label int, rep string, x string"


def corpus():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in range(3):
        for size in (300, 40, 1, 1, 7):
            center = rng.standard_normal(32)
            for _ in range(size):
                v = center + rng.standard_normal(32) * rng.choice([0.02, 0.08, 0.14])
                rows.append((k, [float(np.float32(x)) for x in v], label, "r", "y"))
                k += 1
    rows += [(9000 + i, rows[3][1], rows[3][2], None, None) for i in range(20)]
    rows += [(9100, None, 1, None, None), (9101, [], 1, None, None), (9102, [0.0] * 32, 1, None, None), (9103, [float("nan")] * 32, 1, None, None), (9104, [1.0, None] * 16, 1, None, None), (9105, rows[3][1], None, None, None)]
    return rows + [(9106, [float("inf")] * 32, 1, None, None), (9107, [1e30] * 32, 2, None, None), (9108, [1e30] * 32, 2, None, None), (9109, [1e-30] * 32, 2, None, None), (None, rows[3][1], 0, None, None), rows[5], rows[5]]


def brute(rows, threshold=0.98):
    good, seen = [], set()
    for i, v, label, *_ in rows:
        if i is not None and i not in seen and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, float) / np.abs(v).max()
            good.append((i, x / np.linalg.norm(x), label))
        seen.add(i)
    links, comp = {}, {i: i for i, *_ in rows if i is not None}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, (i, x, m) in enumerate(good):
        for j, y, n in good[a + 1 :]:
            if m == n and len(x) == len(y) and x @ y >= threshold:
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                p, q = sorted((root(i), root(j)))
                comp[q] = p
    return {i: (links.get(i, 0), root(i) if i is not None else None) for i, *_ in rows}


@pytest.mark.parametrize("block", [2048, 50])
def test_equals_all_pairs(spark, block):
    rows = corpus()
    got = embeddings.linked(spark.createDataFrame(rows, DDL).repartition(3), block=block).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    found = sum(r.n_links == want[r.vec_id][0] for r in got)
    assert found >= 0.99 * len(got)  # a pair is missed with probability 1e-4 at most
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert sum(r.component_id == want[r.vec_id][1] for r in got) >= 0.99 * len(got)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_exact_without_misses(spark):
    rows = corpus()
    got = embeddings.linked(spark.createDataFrame(rows, DDL).repartition(3), miss=0, block=100).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


def test_recall_of_large_labels_tables(spark):
    """With as many bits and tables as labels of 400 million vectors get, on pairs just above the threshold."""
    rng = np.random.default_rng(6)
    bits, tables = embeddings.plan_tables(400_000_000, 0.98, 1e-4)
    assert bits == 24 and tables > 30
    rows = []
    for k in range(400):
        x = rng.standard_normal(32)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(32)
        y -= (x @ y) * x
        c = 0.98 + rng.random() * 0.004 + 1e-6
        rows += [(2 * k, x.tolist(), 1), (2 * k + 1, (c * x + np.sqrt(1 - c * c) * y / np.linalg.norm(y)).tolist(), 1)]
    got = embeddings.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), least_bits=24).collect()
    assert sum(r.n_links for r in got) >= 0.995 * 800


def test_empty_table(spark):
    assert embeddings.linked(spark.createDataFrame([], DDL)).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1001 + i) for i in range(300)] + [(2000 + i, 2000 + (i + 1) % 17) for i in range(17)] + [(5, 5), (1005, 1000)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1301)} | {i: 2000 for i in range(2000, 2017)}


def test_edges_without_an_end(spark):
    edges = [(1, 2), (None, 5), (7, None), (2, 3), (2, 3)]
    assert {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()} == {1: 1, 2: 1, 3: 1}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
