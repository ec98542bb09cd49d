import random

import pyarrow as pa
import pytest

from fundtrail.llm import decontam, registry
from tests.conftest import SF_SMALL
from tests.llm.helpers import edit_distance_to_best_stretch, odd_documents, words


def brute_force(docs, items):
    out = {}
    for i, t in docs:
        w = words(t)
        for k, it in items:
            v = words(it)
            if len(v) >= decontam.MIN_WORDS:
                edits = edit_distance_to_best_stretch(v, w)
                if edits <= int(decontam.MAX_EDITS_SHARE * len(v)):
                    out[i, k] = edits
    return out


def test_planted_copies_and_clean_documents(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate((6, 9, 15, 18, 25, 31, 40, 46, 55, 70, 120, 4))]
    docs, near = [], []
    for d in range(240):
        text = rng.choices(vocabulary, k=rng.randint(0, 120))
        if d % 2:
            k, it = items[d % len(items)]
            w = it.split()
            edits = rng.choice((0, 0, 0, 1, 2)) if len(w) >= 15 else 0
            for _ in range(edits):
                j = rng.randrange(len(w))
                w[j : j + 1] = rng.choice(([], ["changed"], [w[j], "added"]))
            near.append(d)
            at = rng.randint(0, len(text))
            text[at:at] = [x.upper() if rng.random() < 0.1 else x + rng.choice(("", ",", "!")) for x in w]
        docs.append((d, " ".join(text)))
    got = decontam.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    want = brute_force(docs, items)
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in got}
    assert len(found) == len(got)
    assert set(found) <= set(want)
    assert len(found) >= 0.98 * len(want)
    exact = {k for k, e in want.items() if e == 0}
    assert exact <= set(found)
    assert all(found[k] >= want[k] for k in found)


def test_blocks_of_items_give_the_same(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    one = decontam.find_leaks(docs, items).toPandas()
    many = decontam.find_leaks(docs, items, block_item_words=300).toPandas()
    key = ["doc_id", "item_id"]
    assert one.sort_values(key).values.tolist() == many.sort_values(key).values.tolist()


def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in registry.op7_decontamination(spark, SF_SMALL).collect()}
    want = set()
    for i, t in docs:
        w = words(t)
        grams = {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
        for k, it in items:
            v = words(it)
            if sum(tuple(v[j : j + 3]) in grams for j in range(len(v) - 2)) >= 0.3 * len(v):
                if edit_distance_to_best_stretch(v, w) <= int(0.2 * len(v)):
                    want.add((i, k))
    assert got == want and want


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame(
        [(1, None), (None, "a b c d e f"), (2, ""), (3, "one two"), (4, "alpha beta gamma delta epsilon zeta"), (4, "lazy dog and runs away again the quick")],
        "item_id long, text string",
    )
    rows = decontam.find_leaks(docs, items).collect()
    assert sorted({(r["doc_id"] or 0, r["item_id"]) for r in rows}) == [(0, 4), (1, 4), (2, 4), (7, 4), (8, 4)]
    assert decontam.find_leaks(docs, items.limit(0)).count() == 0
    assert decontam.find_leaks(docs.limit(0), items).count() == 0


def _edited(rng, item, edits, spread):
    """The item with so many words replaced, left out or added: at random places, or every fifth word."""
    out = list(item)
    places = sorted(rng.sample(range(len(item)), edits)) if not spread else [k * len(item) // edits for k in range(edits)]
    for j in reversed(places):
        out[j : j + 1] = rng.choice((["changed"], [], [out[j], "added"]))
    return out


def _found(items, texts):
    """(text, item) found among texts, without Spark."""
    scan = decontam._scanner(list(range(len(items))), [" ".join(i) for i in items])
    batch = pa.RecordBatch.from_pydict(
        {"_id": pa.array(range(len(texts)), pa.int64()), "_text": pa.array([" ".join(t) for t in texts], pa.string())}
    )
    return {(r["id"], r["item_id"]) for out in scan(iter([batch])) for r in out.to_pylist()}


@pytest.mark.parametrize("length", [15, 18, 20, 25, 29, 30, 40, 46, 59, 60, 100, 150, 200])
@pytest.mark.parametrize("share,spread", [(0, False), (0.1, False), (0.2, False), (0.2, True)])
def test_recall_at_heavy_edits(length, share, spread):
    """Leaks with a tenth and a fifth of the words edited, insertions and deletions too."""
    rng = random.Random(length * 10 + int(10 * share))
    vocabulary = [f"w{k}" for k in range(20000)]
    items = [rng.choices(vocabulary, k=length) for _ in range(200)]
    texts = []
    for item in items:
        before, after = rng.choices(vocabulary, k=rng.randint(0, 30)), rng.choices(vocabulary, k=rng.randint(0, 30))
        texts.append(before + _edited(rng, item, int(share * length), spread) + after)
    got = _found(items, texts)
    found = sum((k, k) in got for k in range(len(items)))
    assert found >= 0.995 * len(items) if length >= decontam.WALK_WORDS and share else found == len(items)


def test_short_items_are_all_found():
    """Items of 5 to 39 words with as many edits as a leak may have, at any place in the text."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [rng.choices(vocabulary, k=5 + k % 35) for k in range(140)]
    texts = []
    for item in items:
        edited = _edited(rng, item, rng.randint(0, int(0.2 * len(item))), False)
        texts.append(rng.choices(vocabulary, k=rng.randint(0, 9)) + edited + rng.choices(vocabulary, k=rng.randint(0, 9)))
    want = {
        (d, k)
        for d, t in enumerate(texts)
        for k, v in enumerate(items)
        if edit_distance_to_best_stretch(v, t) <= int(0.2 * len(v))
    }
    assert {(k, k) for k in range(len(items))} <= want
    assert _found(items, texts) == want
