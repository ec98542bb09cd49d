import random

import corpus_pipeline
from fundtrail.llm import decontam
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import edit_distance_to_best_stretch, has_letter, near_duplicate_components, odd_documents, words


def test_stages(spark):
    """Each stage against a plain version of its decision, on its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "near_duplicates", "decontamination", "bpe"]
    before, frames = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, before, SF_SMALL), "test-stage")
        if name != "bpe":
            assert after.columns == docs.columns
        frames[name] = (before, after)
        before = after
    rows = {n: ([tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()]) for n, (a, b) in frames.items()}
    given, kept = rows["language_id"]
    assert {r[0] for r in kept} <= {r[0] for r in given if has_letter(r[1])} and len(kept) > 0.97 * len(given)
    given, kept = rows["near_duplicates"]
    want = near_duplicate_components([(r[0], r[1]) for r in given], 5, 80)
    assert {r[0] for r in kept} == {i for i, c in want.items() if i == c}
    given, kept = rows["decontamination"]
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    grams = {tuple(v[k : k + 8]) for v in items for k in range(len(v) - 7)}
    dirty = {r[0] for r in given if any(tuple(words(r[1])[k : k + 8]) in grams for k in range(len(words(r[1])) - 7))}
    assert {r[0] for r in given} - {r[0] for r in kept} <= dirty
    assert {r[0] for r in kept} & dirty == {r[0] for r in kept if r[0] in dirty}
    given, out = rows["bpe"]
    assert sorted(r[0] for r in out) == sorted(r[0] for r in given)


def test_toxic_documents_go(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.toxic(spark, docs, SF_MID).select("doc_id").collect()}
    toxic = [i for i, y in labels.items() if y == 1]
    clean = [i for i, y in labels.items() if y == 0]
    assert sum(i in kept for i in toxic) < 0.15 * len(toxic)
    assert sum(i in kept for i in clean) > 0.99 * len(clean)


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    out = entry.queries()["pipeline"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() <= 200
    assert "pipeline" not in entry.oracle_sql()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in entry.queries()) == 1


def test_odd_rows_and_empty_tables(spark, tmp_path):
    docs = odd_documents(spark)
    spark.createDataFrame([(9, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, str(tmp_path))
            assert name == "bpe" or out.columns == docs.columns
            rows = out.collect()
            assert len(rows) <= given.count()
            if name == "near_duplicates" and rows:
                ids = [r["doc_id"] for r in rows]
                # the copy without id goes too; the row without id and text stays
                assert ids.count(1) == 1 and 2 not in ids and 8 not in ids and ids.count(None) == 1
    assert decontam.MIN_WORDS == 5


def test_every_row_has_its_own_verdict(spark, tmp_path):
    """Rows without id, and rows that share one, go or stay by their own text."""
    item = "seven small boats left the quiet harbour before the storm came over the hills"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = "a plain text about bread and butter that nobody would ever look for in a test"
    docs = spark.createDataFrame([(None, item), (5, item), (5, clean), (None, clean)], "doc_id long, text string")
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == [(0, clean), (5, clean)]

    one = "first text of many words that has copies on other rows of this table"
    two = "second text of as many words whose copies carry other numbers than these"
    rows = [(5, one), (5, two), (5, clean), (5, clean), (7, one), (8, two), (None, one), (None, item), (None, item), (None, None), (None, "")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    want = [(5, one), (5, two), (5, clean), (None, item), (None, None), (None, "")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_every_brute_force_leak_is_gone(spark):
    """Documents of the small tables that hold an item within the edits allowed, heavily edited copies included."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    given = [tuple(r) for r in docs.collect()]
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").limit(25).collect()]
    rng = random.Random(4)
    rows = []
    for k, row in enumerate(given):
        text = words(row[1])
        if k % 2:
            item = list(items[k % len(items)])
            for j in sorted(rng.sample(range(len(item)), int(0.2 * len(item))), reverse=True):
                item[j : j + 1] = rng.choice((["changed"], [], [item[j], "added"]))
            text[5:5] = item
        rows.append((row[0], " ".join(text), *row[2:]))
    dirty = set()
    for row in rows:
        text = words(row[1])
        if any(len(v) >= 5 and edit_distance_to_best_stretch(v, text[:80]) <= int(0.2 * len(v)) for v in items):
            dirty.add(row[0])
    assert len(dirty) >= 60
    kept = corpus_pipeline.decontamination(spark, spark.createDataFrame(rows, docs.schema), SF_SMALL).collect()
    assert not dirty & {r["doc_id"] for r in kept}
