import random
import re
import time

from fundtrail.llm import licenses, registry
from tests.conftest import SF_SMALL
from tests.llm.helpers import odd_documents, words


def base_places(text):
    w = words(text)
    out = []
    for phrase, label in licenses.BASE_PHRASES:
        p = phrase.split()
        out += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    return sorted(out)


def test_rules_are_many_and_ordered():
    rules = licenses.build_rules()
    assert len(rules) >= 300
    for rule in rules:
        re.compile(rule.pattern)
        assert rule.keyword.encode() in rule.pattern.replace(b"\\", b"")


def test_registered_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = registry.op1_license_scan(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = base_places(docs[r["doc_id"]])
        assert r["n_words"] == len(words(docs[r["doc_id"]]))
        assert r["n_base"] == len(base)
        assert r["first_word"] == (base[0][0] if base else None)
        assert r["last_word"] == (base[-1][0] if base else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in base}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def scan(spark, texts):
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return {r["doc_id"]: r for r in rows.collect()}


def test_priority_and_containment(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License)",
        "see the GNU Lesser General Public License version 2.1, or the GPL",
        "MIT-license; mit\nlicense and commit licenses",
        "This work is licensed under the CC BY-NC-SA 4.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
        "unlicensed mitlicense apache-licensed",
    ]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        assert [(b["word"], b["label"]) for b in sorted(got[i]["base"])] == base_places(t)
        hits = [(d["first_word"], d["end_word"]) for d in got[i]["detections"]]
        for a in hits:
            assert not any(a != b and b[0] <= a[0] and a[1] <= b[1] and b[1] - b[0] > a[1] - a[0] for b in hits) or len(
                set(hits)
            ) == len(hits)
    labels = {i: [d["label"] for d in got[i]["detections"]] for i in got}
    assert "apache" in labels[0] and got[0]["detections"][0]["confidence"] == 0.98
    assert "lgpl" in labels[1] and labels[1].count("gpl") == 1  # the one that is not inside the lesser license
    assert labels[2] == ["mit", "mit"]
    assert "cc-by-nc-sa" in labels[3]
    assert labels[4] == ["mit"]
    assert labels[5] == [] and got[5]["base"] == []


def test_equal_intervals_go_to_the_earlier_rule():
    rules = [licenses.Rule("first", b"x y", 1, 0.5, "x"), licenses.Rule("second", b"x y", 1, 0.9, "x"), licenses.Rule("part", b"y", 0, 0.1, "y")]
    _, hits = licenses.Scanner(rules).scan(b"x y")
    assert hits == [(0, 3, "first", 0.5), (2, 3, "part", 0.1)]


def test_suppression_equals_comparing_all():
    rng = random.Random(2)
    for _ in range(200):
        found = []
        for k in range(rng.randint(0, 40)):
            start = rng.randint(0, 30)
            end = start + rng.randint(1, 12)
            found.append((rng.randint(0, 3), start - end, start, end, k))
        taken = []
        for hit in sorted(found):
            if not any(a <= hit[2] and hit[3] <= b for _, _, a, b, _ in taken):
                taken.append(hit)
        assert licenses._resolve(found) == sorted(taken, key=lambda h: (h[2], h[3], h[4]))


def test_many_mentions_stay_quick():
    text = b"the mit license, or the apache license. " * 50_000
    started = time.perf_counter()
    base, hits = licenses.Scanner(licenses.build_rules()).scan(text)
    assert len(base) == len(hits) == 100_000
    assert time.perf_counter() - started < 30


def test_identifiers_and_notices(spark):
    texts = [
        "// SPDX-License-Identifier: MIT",
        "# SPDX-License-Identifier: Apache-2.0",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND",
        "SPDX-License-Identifier: NOASSERTION",
    ]
    got = scan(spark, texts)
    labels = [sorted({d["label"] for d in got[i]["detections"]}) for i in range(len(texts))]
    assert labels == [["mit"], ["apache"], ["bsd"], ["gpl"], ["bsd"], ["mit"], []]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = licenses.scan_licenses(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["base"] == [] and r["detections"] == [] for r in rows)
    assert sorted(r["n_words"] for r in rows if r["doc_id"] in (3, 4, 5, 10)) == [0, 0, 0, 1]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
