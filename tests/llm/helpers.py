"""Plain-Python versions of what the operators compute, and small tables with odd rows."""

import re
import unicodedata

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", lower_ascii(text))


def shingle_set(text, size):
    w = tokens(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1)))


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicate_components(docs, size, percent):
    """doc_id -> component by all pairs; ids must be unique."""
    sets = {i: shingle_set(t, size) for i, t in docs}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            common = len(x & y)
            if x and y and 100 * common >= percent * (len(x) + len(y) - common):
                links.append((a, b))
    return components(ids, links)


def edit_distance_to_best_stretch(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def has_letter(text):
    return any(unicodedata.category(c).startswith("L") for c in text or "")


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, an extra column with a clashing name."""
    long_text = "the quick brown fox jumps over the lazy dog and runs away again " * 8000
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 1),
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 1),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", None, None),
        (3, None, "en", "a", 0),
        (4, "", "en", "a", 0),
        (5, "   \n\t ", None, "a", 4),
        (6, "1234 !!! 5678", "en", "a", 4),
        (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 1),
        (7, long_text, "en", "b", len(long_text)),
        (8, long_text + "end", "en", "b", len(long_text)),
        (9, "été garçon où naïve 漢字 🙂 Straße", "fr", "c", 5),
        (10, "one", "en", "c", 3),
        (11, "x" * 3000, "en", "c", 3000),
        (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    return docs.selectExpr("*", "'clash' as score", "7 as _text", "8 as _id", "9 as id", "'z' as n")
