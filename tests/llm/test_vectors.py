import numpy as np

from fundtrail.llm import registry, vectors
from tests.conftest import SF_SMALL
from tests.llm.helpers import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(ids, rows, threshold=0.9):
    x = np.array(rows, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    return dict(zip(ids, near.sum(axis=1).tolist(), strict=True)), components(ids, [(ids[i], ids[j]) for i, j in zip(a, b, strict=True)])


def clusters(rng, sizes, spread, d=32):
    out = []
    for n in sizes:
        centre = rng.standard_normal(d)
        out += [centre + spread * rng.standard_normal(d) for _ in range(n)]
    return [np.float32(v).tolist() for v in out]


def run(spark, ids, rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in zip(ids, rows, strict=True)], SCHEMA)
    return {r["vec_id"]: r for r in vectors.near_vectors(frame).collect()}


def test_recall_and_no_false_links(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_MEMBERS", 8)
    rng = np.random.default_rng(3)
    rows = clusters(rng, [40, 20, 10, 5, 3, 2, 2, 2], 0.3) + clusters(rng, [60], 0.05) + clusters(rng, [1] * 150, 0)
    rows += [rows[0]] * 4 + [rows[200]] * 3
    ids = [int(i) for i in rng.permutation(len(rows)) * 2 + 1]
    degree, component = brute_force(ids, rows)
    got = run(spark, ids, rows)
    assert all(got[i]["n_links"] <= degree[i] for i in ids)
    assert sum(r["n_links"] for r in got.values()) >= 0.95 * sum(degree.values())
    assert np.mean([got[i]["component_id"] == component[i] for i in ids]) > 0.97
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in got.values())


def test_dense_groups_and_parts(spark, monkeypatch):
    """Balls, parted cells and small blocks give what brute force gives."""
    monkeypatch.setattr(vectors, "PART_MEMBERS", 16)
    monkeypatch.setattr(vectors, "BLOCK", 8)
    rng = np.random.default_rng(4)
    rows = clusters(rng, [80], 0.02) + clusters(rng, [60], 0.3) + clusters(rng, [1] * 30, 0)
    ids = list(range(1, len(rows) + 1))
    degree, component = brute_force(ids, rows)
    got = run(spark, ids, rows)
    assert {i: r["n_links"] for i, r in got.items()} == degree
    assert {i: r["component_id"] for i, r in got.items()} == component


def test_registered_query(spark):
    frame = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    degree, component = brute_force(frame["vec_id"].tolist(), np.stack(frame["embedding"]).tolist())
    got = registry.op6_embedding_dedup(spark, SF_SMALL).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == degree
    assert {r["vec_id"]: r["component_id"] for r in got} == component


def test_traversal_is_in_order_of_summed_distance():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = vectors.MultiIndex(x, 100_000, 0.9)
    index.visits = 37
    cells = index.traverse(x)
    a, b = index.halves(x)
    sums = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    got = np.take_along_axis(sums, cells, axis=1)
    assert np.allclose(got, np.sort(sums, axis=1)[:, :37])
    assert all(len(set(r)) == 37 for r in cells.tolist())
    assert (cells[:, 0] == index.cells(x)).mean() > 0.99


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [0.0, 0.0], 0), (5, [nan, 1.0], 0),
        (6, [inf, 1.0], 0), (7, [None, 1.0], 0), (8, [], None), (9, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (10, [0.0, 1.0], 0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as v", "2 as id", "3 as size")
    got = [tuple(r) for r in vectors.near_vectors(frame).collect()]
    assert len(got) == len(rows)
    assert sorted(r for r in got if r[0] in (1, 2)) == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)]
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert (i, 0, i, True) in got
    assert (None, 0, None, False) in got
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_an_id_shared_by_two_groups(spark):
    """Id 1 stands on an equal vector of each of two groups and near one of a third; every group is still linked."""
    rng = np.random.default_rng(8)
    one, two, three = (np.float32(rng.standard_normal(16)).tolist() for _ in range(3))
    near = [three[0] + 0.01, *three[1:]]
    data = [(1, one), (1, two), (1, near), (30, three)] + [(k, one) for k in range(2, 12)] + [(k, two) for k in range(12, 22)]
    got = vectors.near_vectors(spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)).collect()
    assert {r["component_id"] for r in got} == {1}
    assert sorted((r["vec_id"], r["n_links"]) for r in got) == sorted(
        [(1, 10), (1, 10), (1, 1), (30, 1)] + [(k, 10) for k in range(2, 22)]
    )


def unit(rng, n, d=64):
    x = rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_single_partners_at_the_threshold_are_found_at_every_size():
    """Index only: random vectors, none of them used to fit, partners at cosine 0.902 in a random direction."""
    rng = np.random.default_rng(12)
    for members in (51_282, 1_000_000, 20_000_000):
        sample = max(vectors.SAMPLE, vectors.SAMPLE_PER_CODE * vectors._codes(members)) + vectors.HELD_OUT
        index = vectors.MultiIndex(unit(rng, sample), members, 0.9)
        x = unit(rng, 2000)
        y = index.partners(x, 0.902, rng)
        there, back = index.traverse(x) == index.cells(y)[:, None], index.traverse(y) == index.cells(x)[:, None]
        found = there.any(axis=1) | back.any(axis=1)
        assert found.mean() >= 0.97


def test_links_count_at_both_ends(spark, monkeypatch):
    """Few visits, so that many links are found from one side only; dense groups, whole balls and blocks among them."""
    monkeypatch.setattr(vectors, "CELL_MEMBERS", 4)
    monkeypatch.setattr(vectors, "PART_MEMBERS", 16)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors.MultiIndex.__init__, "__defaults__", (0.6,))
    rng = np.random.default_rng(13)
    x = unit(rng, 300, 32)
    noise = unit(rng, 300, 32)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    rows = [*x.tolist(), *(0.93 * x + np.sqrt(1 - 0.93**2) * noise).tolist()]
    rows = [np.float32(r).tolist() for r in rows]
    got = run(spark, list(range(600)), rows)
    ends = [(got[i]["n_links"], got[i + 300]["n_links"]) for i in range(300)]
    assert all(a == b for a, b in ends)
    assert 0 < sum(a for a, _ in ends) < 300
    dense = clusters(rng, [90], 0.05) + clusters(rng, [60], 0.3)
    degree, _ = brute_force(list(range(150)), dense)
    got = run(spark, list(range(150)), dense)
    assert sum(r["n_links"] for r in got.values()) % 2 == 0
    assert all(got[i]["n_links"] <= degree[i] for i in degree)


def test_every_length_is_linked(spark):
    rng = np.random.default_rng(14)
    rows = [np.float32(v).tolist() for d in (16, 5, 1, 40) for v in clusters(rng, [6, 4, 1, 1], 0.05, d)]
    ids = list(range(1, len(rows) + 1))
    expected = {}
    for d in (16, 5, 1, 40):
        mine = [i for i in ids if len(rows[i - 1]) == d]
        degree, component = brute_force(mine, [rows[i - 1] for i in mine])
        expected |= {i: (degree[i], component[i]) for i in mine}
    got = run(spark, ids, rows)
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == expected
