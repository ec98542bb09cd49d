import random

import numpy as np
import pytest

from fundtrail.llm import neardup, registry
from fundtrail.llm.components import connected_components
from tests.conftest import SF_SMALL
from tests.llm.helpers import components, near_duplicate_components, odd_documents, shingle_set


def variants(rng, n, edits, length=60):
    base = [f"w{rng.randint(0, 400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(length)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, size, percent):
    rng = random.Random(size)
    texts = []
    for edits in (1, 2, 3, 4, 6):
        texts += variants(rng, 25, edits)
    texts += variants(rng, 10, 1, length=6) + ["a b", "a b", "a", "A", "", None, " a  b "] + ["solo text here now"] * 5
    rng.shuffle(texts)
    docs = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=size, percent=percent)
    rows = {r["doc_id"]: r for r in got.collect()}
    want = near_duplicate_components(docs, size, percent)
    assert {i: r["component_id"] for i, r in rows.items()} == want
    for i, t in docs:
        assert rows[i]["n_shingles"] == len(shingle_set(t, size))
        assert rows[i]["kept"] == (want[i] == i)


def test_blocks_of_a_crowded_bucket(spark, monkeypatch):
    """Many members of different components in shared buckets, in blocks of four."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 4)
    rng = random.Random(9)
    texts = variants(rng, 60, 9, length=80)
    docs = list(enumerate(texts, 1))
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=3, percent=85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == near_duplicate_components(docs, 3, 85)


def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op4_minhash_dedup(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == near_duplicate_components(docs, 3, 85)
    assert registry.op4_minhash_dedup(spark, SF_SMALL).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_odd_rows(spark):
    rows = neardup.near_duplicates(odd_documents(spark)).collect()
    assert len(rows) == 14
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in by_id[1]] == [1, 1] and by_id[2][0]["component_id"] == 1
    assert by_id[8][0]["component_id"] == 7  # nearly equal very long texts
    for i in (3, 4, 5):
        assert by_id[i][0]["n_shingles"] == 0 and by_id[i][0]["component_id"] == i and by_id[i][0]["kept"]
    assert all(r["component_id"] is None and not r["kept"] for r in by_id[None])
    assert neardup.near_duplicates(odd_documents(spark).limit(0)).count() == 0


def test_estimate_follows_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.5, 0.8, 0.9):
        for _ in range(30):
            common = np.unique(rng.integers(0, 2**63, int(2000 * share)).astype(np.uint64) * np.uint64(2))
            a = np.unique(np.concatenate([common, rng.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2) + np.uint64(1)]))
            ra = neardup._registers(a, np.array([0, len(a)]))
            rc = neardup._registers(common, np.array([0, len(common)]))
            est, _ = neardup._estimate(ra, rc, np.array([len(a)]), np.array([len(common)]))
            errors.append(est[0] - len(common) / len(a))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(1, 300), rng.randint(1, 300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 500)]
    edges += [(1, None), (7, 7)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    clean = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = components(sorted({x for e in clean for x in e}), clean)
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_shared_by_two_groups(spark):
    """Id 1 stands on a copy of each of two texts and on a near copy of a third; every group is still linked."""
    rng = random.Random(21)
    one, two, three = (variants(rng, 1, 0)[0] for _ in range(3))
    near = three.split()
    near[0] = "changed"
    docs = [(1, one), (1, two), (1, " ".join(near)), (30, three)] + [(k, one) for k in range(2, 12)] + [(k, two) for k in range(12, 22)]
    rows = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(rows) == len(docs)
    assert {r["component_id"] for r in rows} == {1}
    assert sorted(r["doc_id"] for r in rows if r["kept"]) == [1, 1, 1]
