import hashlib
import math

import numpy as np
import pytest

from fundtrail.llm import ballcodes, registry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """[(codes, error)] in the order of ``rows`` (id, vector), and the entries, by comparing everything."""
    x = [[math.floor(scale * c) for c in v] for _, v in rows]
    size = len(x[0]) // parts
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for v in x]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, x[k]))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            for e, members in groups.items():
                books[p][e] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    return [([e for _, e in f], sum(d for d, _ in f)) for f in found], books


def sha(books):
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def check(spark, rows, **kw):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    found = ballcodes.ball_codes(frame, **kw)
    want, books = plain_codes(rows, **kw)
    got = sorted((r["id"] is None, r["id"] or 0, r["code"], r["error"]) for r in found.rows.collect())
    assert got == sorted((i is None, i or 0, c, e) for (i, _), (c, e) in zip(rows, want, strict=True))
    assert found.books.sha256 == sha(books)


def test_equals_plain_k_means(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 8))
    rows = [(int(i), (centres[i % 12] + 0.2 * rng.standard_normal(8)).tolist()) for i in rng.permutation(400)]
    check(spark, rows, entries=32)
    check(spark, rows[:100], entries=5, rounds=1)


def test_ties_repeats_and_few_vectors(spark):
    # few distinct values on a coarse grid: equal entries, equal distances, entries without parts
    rng = np.random.default_rng(2)
    rows = [(int(i // 2), (rng.integers(-2, 3, 8) / 2).tolist()) for i in range(120)]
    rows += [(None, [0.5] * 8), (None, [-0.5] * 8)]
    check(spark, rows, entries=40, scale=2)
    check(spark, rows[:3])
    check(spark, [(7, [0.25] * 8)] * 5)


def test_balls_decide_as_all_entries_do():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-900, 900, (40, 6)) + rng.integers(-40, 40, (50, 1, 6))]).reshape(-1, 6)
    entries = x[:128].copy()
    first, near, all_distances = ballcodes.PartAssigner(entries, None).assign(x, None)
    reach = np.zeros(128, np.int64)
    np.maximum.at(reach, first, near)
    sums, counts = np.zeros((128, 6), np.int64), np.bincount(first, minlength=128)
    np.add.at(sums, first, x)
    books = ballcodes.Codebooks(entries[None]).moved(sums[None], counts[None], reach[None])
    # the bound holds
    after = ((x - books.entries[0][first]) ** 2).sum(axis=1)
    assert (after <= books.reach[0][first]).all()
    best, least, compared = ballcodes.PartAssigner(books.entries[0], books.reach[0]).assign(x, first)
    want = ballcodes.squared_distances(x, books.entries[0])
    assert (best == np.argmin(want, axis=1)).all() and (least == want.min(axis=1)).all()
    assert compared < all_distances / 2


def test_distances_are_exact_for_large_integers():
    x = np.array([[ballcodes.MAX_COMPONENT, -ballcodes.MAX_COMPONENT, 12345]])
    e = np.array([[-ballcodes.MAX_COMPONENT + 1, ballcodes.MAX_COMPONENT - 3, 54321]])
    assert ballcodes.squared_distances(x, e)[0, 0] == sum((int(a) - int(b)) ** 2 for a, b in zip(x[0], e[0], strict=True))


def test_odd_rows(spark):
    good = [0.1, 0.2, -0.3, 0.4]
    rows = [
        (1, good, 1),
        (1, good, 1),
        (2, None, 1),
        (3, [0.1, None, 0.2, 0.3], 2),
        (4, [0.1, float("nan"), 0.2, 0.3], 2),
        (5, [0.1, float("inf"), 0.2, 0.3], None),
        (6, [0.5, 0.5, 0.5, 0.5], None),
        (7, [0.5, 0.5], None),
        (None, [-0.5, -0.5, -0.5, -0.5], None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'c' as id", "'c' as v", "'c' as x", "1 as code", "2 as kind")
    found = ballcodes.ball_codes(frame)
    got = ballcodes.with_label_errors(found.rows).collect()
    by_id = {r["id"]: r for r in got}
    assert sorted((r["id"] is None, r["id"] or 0) for r in got) == [(False, 1), (False, 1), (False, 6), (False, 7), (True, 0)]
    assert by_id[7]["code"] is None and by_id[7]["error"] is None
    assert by_id[1]["label_error"] == 2 * by_id[1]["error"]
    assert by_id[6]["label_error"] == by_id[7]["label_error"] == by_id[6]["error"] + by_id[None]["error"]
    none = ballcodes.ball_codes(frame.limit(0))
    assert none.books is None and none.rows.collect() == []
    assert ballcodes.ball_codes(frame.where("vec_id = 2")).rows.collect() == []
    empty = ballcodes.ball_codes(spark.createDataFrame([(1, [], 0), (2, [], 0)], SCHEMA))
    assert [(r["code"], r["error"]) for r in empty.rows.collect()] == [([0] * 4, 0)] * 2
    with pytest.raises(ValueError):
        ballcodes.ball_codes(spark.createDataFrame([(1, [1e9] * 4, 0)], SCHEMA))


def test_registered_query_equals_sql(spark):
    name = "op12_ball_codes"
    assert compare(spark, name, SF_SMALL, registry.queries()[name], registry.oracle_sql()[name])["ok"]
