import random

import pytest
from tokenizers import Tokenizer

from fundtrail.llm import counts, registry
from fundtrail.llm.registry import tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.helpers import odd_documents

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def spec():
    return counts.read_byte_bpe(PATH)


@pytest.fixture(scope="module")
def own(spec):
    return counts.TokenCounter(spec, counts.whole_tokens(spec))


def want(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_equals_the_library(own, library):
    rng = random.Random(3)
    alphabet = "abcdefghijklmnopqrstuvwxyz   '’.,!?0123ÀéñßŒ\t\n\r\x0b\x1c\x1f\x85\xa0 　 ΣςИ漢字🙂́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(400)]
    texts += [None, "", " ", "  ", "\n\n x", "it's we're I'M 's't", "a<|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  y"]
    for text in texts:
        assert own.count(text) == want(library, text), text


def test_every_kind_of_character(own, library):
    for c in [*range(0, 0x3100), *range(0xA000, 0xAC00, 3), *range(0xF900, 0x1FC00, 5), *range(0x1F000, 0x110000, 997)]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}! {chr(c)}{chr(c)} 1{chr(c)}2 {chr(c)} "
            assert own.count(text) == want(library, text), hex(c)


def test_long_pieces_full_cache_and_long_texts(own, library, spec, monkeypatch):
    rng = random.Random(4)
    long = ["".join(rng.choice("abehinorst") for _ in range(n)) for n in (2, 127, 128, 129, 3000, 60000)]
    long += [" " * 5000 + "x", "!" * 3000, "漢" * 2000]
    for text in long:
        assert own.count(text) == want(library, text)
    monkeypatch.setattr(counts, "CACHE_CHUNKS", 5)
    monkeypatch.setattr(counts, "LONG_TEXT", 20)
    small = counts.TokenCounter(spec, own.proven)
    for text in ["onex twox threex fourx fivex sixx sevenx eightx ninex tenx", *long]:
        assert small.count(text) == want(library, text)
    assert len(small.rest) <= 5


def test_proof_of_whole_tokens(own, library, spec):
    rng = random.Random(5)
    for text in rng.sample(sorted(own.proven), 4000):
        assert want(library, text) == 1
    # what is not proven is not one token alone, or no text of its own
    byte = {c: b for b, c in enumerate(counts.byte_characters())}
    for token in spec["vocab"]:
        raw = bytes(map(byte.__getitem__, token))
        text = raw.decode("utf-8", "replace")
        if text.encode() == raw and text not in own.proven:
            assert want(library, text) != 1, token


def test_both_merges_agree(spec):
    rng = random.Random(6)
    chars = counts.byte_characters()
    for _ in range(300):
        piece = [rng.choice(chars[97:123] + chars[:40]) for _ in range(rng.randint(1, 100))]
        assert counts.merged_count(list(piece), spec["ranks"]) == counts._merged_count_long(list(piece), spec["ranks"])


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        counts.read_byte_bpe(tokenizer_path())


def test_odd_rows(spark, library):
    docs = odd_documents(spark)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in counts.count_tokens(docs, PATH).collect())
    texts = [(r["doc_id"] or 0, r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    assert got == sorted((i, len(t.encode()), want(library, t)) for i, t in texts)
    assert counts.count_tokens(docs.limit(0), PATH).collect() == []


def test_registered_query(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs}
    rows = registry.op11_token_counts(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = want(library, texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)
