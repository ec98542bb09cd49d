"""Token counts with a whole-token shortcut.

Most pre-tokens of ordinary text are themselves strings of the vocabulary, and
nearly all of those encode alone as one token. Which ones do is proved once, on
the driver, by merging every vocabulary string (``whole_tokens``); it is not
true of each: the merge order can lead elsewhere. A pre-token found among the
proven strings counts as one token without any merge. Only the rest is merged.

A text is first cut into chunks, a run of other characters with the one space
before it: no pre-token reaches beyond a chunk, so a chunk among the proven
strings is one token as it stands. Other chunks are split into pre-tokens, the
proven ones counted, the others merged, and the sum kept in a bounded cache.

The tokenizer file (the ``tokenizers`` JSON format) is read on the driver; what
goes to the tasks is bounded by its vocabulary. Supported, and checked when
loading: a byte-level BPE model without normalizer, dropout, unknown token or
byte fallback, whose added tokens are matched in the raw text.

Texts are never cut and rows never shuffled. Edge cases: a null text counts as
empty and has no tokens; the string of an added token inside a text counts as
that one token, as the library has it by default; repeated rows and null ids
are counted like any others; further columns are left out.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.bpe import _not_yet_known, _own_classes, byte_characters

CACHE_CHUNKS = 300_000
#: Longer texts are taken one chunk at a time, so that no list of all of them is held.
LONG_TEXT = 1 << 20
#: Longer pre-tokens are merged by a heap, so that a text without spaces takes n log n steps.
LONG_PIECE = 128
# The split pattern of byte-level BPE, and white space as it sees it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: No pre-token reaches beyond a chunk: white space only starts one, and only as a single space.
CHUNKS = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def read_byte_bpe(path: str) -> dict:
    """Vocabulary, merge ranks, split pattern and added tokens of a byte-level BPE file; raises on other kinds."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    odd = (
        model["type"] != "BPE"
        or any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        or spec["normalizer"] is not None
        or (split.get("type"), split.get("add_prefix_space"), split.get("use_regex")) != ("ByteLevel", False, True)
        or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )
    if odd:
        raise ValueError(f"{path}: a tokenizer of another kind")
    pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
    return {
        "vocab": list(model["vocab"]),
        "ranks": {pair: rank for rank, pair in enumerate(pairs)},
        "pattern": _own_classes(SPLIT, _not_yet_known(path)),
        "added": [t["content"] for t in spec["added_tokens"]],
    }


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Tokens left when the pair of lowest rank (leftmost on a tie) is merged until none is left.

    ``symbols`` is used up.
    """
    if len(symbols) > LONG_PIECE:
        return _merged_count_long(symbols, ranks)
    none = len(ranks)
    rank = ranks.get
    near = [rank(pair, none) for pair in zip(symbols, symbols[1:])]  # noqa: B905
    while near:
        least = min(near)
        if least == none:
            break
        i = near.index(least)
        symbols[i] += symbols.pop(i + 1)
        del near[i]
        if i:
            near[i - 1] = rank((symbols[i - 1], symbols[i]), none)
        if i < len(near):
            near[i] = rank((symbols[i], symbols[i + 1]), none)
    return len(symbols)


def _merged_count_long(symbols: list[str | None], ranks: dict[tuple[str, str], int]) -> int:
    """``merged_count`` by a heap over a linked list."""
    n = count = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]  # noqa: B905
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if symbols[i] is None or j == n or ranks.get((symbols[i], symbols[j])) != rank:
            continue  # one of the two was merged meanwhile
        symbols[i], symbols[j] = symbols[i] + symbols[j], None
        count -= 1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < n:
                new = ranks.get((symbols[left], symbols[after[left]]))
                if new is not None:
                    heapq.heappush(heap, (new, left))
    return count


def whole_tokens(spec: dict) -> set[str]:
    """The texts of the vocabulary strings that encode alone as one token, proved for each:
    the split leaves it whole and the merges end in one token.

    Strings that are not whole UTF-8 texts are left out: no pre-token equals one.
    """
    byte = {c: b for b, c in enumerate(byte_characters())}
    split = regex.compile(spec["pattern"])
    proven = set()
    for token in spec["vocab"]:
        try:
            text = bytes(map(byte.__getitem__, token)).decode()
        except UnicodeDecodeError:
            continue
        if split.findall(text) == [text] and merged_count(list(token), spec["ranks"]) == 1:
            proven.add(text)
    return proven


class _Rest(dict):
    """Chunk -> its number of tokens, found when first asked for; emptied when full."""

    def __init__(self, spec: dict, proven: set[str]):
        super().__init__()
        self.split, self.ranks, self.proven = regex.compile(spec["pattern"]), spec["ranks"], proven
        self.chars = byte_characters()

    def __missing__(self, chunk: str) -> int:
        count = 0
        for piece in self.split.findall(chunk):
            if piece in self.proven:
                count += 1
            else:
                count += merged_count([self.chars[b] for b in piece.encode()], self.ranks)
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        if len(chunk) <= LONG_PIECE:  # long ones hardly come again
            self[chunk] = count
        return count


class TokenCounter:
    """Counts the tokens of texts: proven pre-tokens at once, the rest by merging."""

    def __init__(self, spec: dict, proven: set[str]):
        added = sorted(spec["added"], key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.proven, self.rest = proven, _Rest(spec, proven)

    def _plain(self, text: str) -> int:
        if len(text) > LONG_TEXT:
            one_by_one = (m.group() for m in CHUNKS.finditer(text))
            return sum(1 if c in self.proven else self.rest[c] for c in one_by_one)
        chunks = CHUNKS.findall(text)
        rest = [c for c in chunks if c not in self.proven]
        return len(chunks) - len(rest) + sum(map(self.rest.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row's whole text; see the module for edge cases."""
    spec = read_byte_bpe(tokenizer_path)
    proven = whole_tokens(spec)
    spec = {k: v for k, v in spec.items() if k != "vocab"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(spec, proven)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.select(
        F.col(id_col).alias("_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text")
    ).mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("_id", id_col)
