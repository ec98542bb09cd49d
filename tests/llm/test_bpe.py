import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from fundtrail.llm import bpe
from fundtrail.llm.registry import tokenizer_path
from tests.llm.helpers import odd_documents


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.read_tokenizer(tokenizer_path()))


def check(own, library, texts):
    got = own.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        ids = np.frombuffer(ids, np.int32).tolist()
        assert ids == want, text[:60]
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_equals_the_library(own, library):
    rng = random.Random(3)
    alphabet = "abcdefghijklmnopqrstuvwxyz   '’.,!?0123ÀéñßŒ\t\n\x1c\x1f\x85 ΣςИ漢字🙂́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(400)]
    texts += [None, "", "it's we're I'M <|endoftext|>x<|startoftext|>", "ΑΣ ΣΑΣ İ", "é ﬁ Å", "  ", "'s't"]
    check(own, library, texts)


def test_every_code_point(own, library):
    """Alone and inside a word, capitals that Python's tables do not know included."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 4096):
        part = points[a : a + 4096]
        texts = [*part, *(f"a{c}b" for c in part if ord(c) < 0x20000)]
        got = own.encode(texts)
        for text, want, ids in zip(texts, library.encode_batch(texts, add_special_tokens=False), got, strict=True):
            assert np.frombuffer(ids, np.int32).tolist() == want.ids, hex(ord(max(text)))


def test_long_fragments_and_cache_turnover(own, library, monkeypatch):
    rng = random.Random(4)
    long = ["".join(rng.choice("abehinorst") for _ in range(n)) for n in (2, 255, 256, 257, 3000, 20000)]
    check(own, library, long)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    check(own, library, ["one two three four five six seven eight nine ten eleven", "one twelve"] * 3)


def test_forced_boundaries_never_cut_a_token(own):
    # inside a vocabulary token no pair is a boundary
    chars = {c: b for b, c in enumerate(bpe.byte_characters())}
    for token in list(own.tokens.values())[:5000]:
        if token in own.special:
            continue
        body = token.removesuffix("</w>")
        ends = token.endswith("</w>")
        for k in range(len(body) - 1):
            last = ends and k == len(body) - 2
            assert own.inside[int(last), chars[body[k]], chars[body[k + 1]]]


def test_other_tokenizers_are_refused(tmp_path):
    import json

    spec = json.load(open(tokenizer_path()))
    spec["model"]["byte_fallback"] = True
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.read_tokenizer(str(path))


def test_odd_rows(spark, library):
    docs = odd_documents(spark)
    rows = bpe.encode_decode(docs, tokenizer_path()).collect()
    assert len(rows) == docs.count()
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    by_id = {i: t for i, t in texts if i is not None}
    for r in rows:
        if r["doc_id"] is not None:
            want = library.encode(by_id[r["doc_id"]] or "", add_special_tokens=False).ids
            assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(docs.limit(0), tokenizer_path()).count() == 0
