"""BPE encoding and decoding with forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can never be merged
over, so the text is certainly cut there. Every pre-token is split at such
pairs, the fragments are encoded independently, and their ids concatenated.

The fragments of all pieces that an Arrow batch shows for the first time are
merged together: one numpy row per fragment, one merge per row and round (the
pair of lowest rank, leftmost on a tie). Pieces already seen come from a
bounded cache. Texts are never cut and rows are never shuffled.

The tokenizer file (the ``tokenizers`` JSON format) is read on the driver and
sent to the tasks. Supported, and checked when loading: a BPE model without
dropout, byte fallback or unknown token, an NFC / white-space / lower-case
normalizer, a regular-expression split followed by byte-level characters, and
no decoder (tokens joined by one space).

Edge cases: a null text counts as empty; an empty text has no ids and decodes
to the empty text. Special tokens in a text get their own id.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Lowercase

CACHE_PIECES = 200_000
#: Longer fragments are merged one by one, so that a text without spaces stays linear.
LONG_FRAGMENT = 256
NO_RANK = np.iinfo(np.int32).max
_HASH_BITS = 18
_SEPARATORS = regex.compile("[\x1c-\x1f]")
_WHITE = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, extra = [], 0
    for byte in range(256):
        if byte in plain:
            names.append(chr(byte))
        else:
            names.append(chr(256 + extra))
            extra += 1
    return names


def _not_yet_known(path: str) -> str:
    """Characters that ``regex`` knows as letters or numbers and the tokenizer's older Unicode tables do not.

    Python's tables are older still, so only characters that they lack can be
    in question; the tokenizer itself says where each of them belongs.
    """
    newer = regex.compile(r"[\p{L}\p{N}]")
    doubtful = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and newer.match(chr(c))]
    split = Tokenizer.from_file(path).pre_tokenizer
    found = [c for c in doubtful if split.pre_tokenize_str(f"a{chr(c)}!")[-1][1] == (1, 3)]
    spans, start = [], None
    for c, after in zip(found, [*found[1:], -1], strict=True):
        start = c if start is None else start
        if after != c + 1:
            spans.append(f"\\U{start:08X}-\\U{c:08X}")
            start = None
    return "".join(spans)


def _newer_capitals() -> dict[int, str]:
    """Capital letters that the tokenizer's library lower-cases and Python's older tables do not know."""
    lower = Lowercase().normalize_str
    unknown = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    return {ord(c): lower(c) for c in unknown if lower(c) != c}


def read_tokenizer(path: str) -> dict:
    """The parts of a tokenizer file that encoding needs; raises on features that it does not know."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    odd = (
        model["type"] != "BPE"
        or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        or kinds != ["NFC", "Replace", "Lowercase"]
        or (split["behavior"], split["invert"]) != ("Removed", True)
        or spec["decoder"] is not None
        or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )
    if odd:
        raise ValueError(f"{path}: a tokenizer of another kind")
    return {
        "vocab": model["vocab"],
        "merges": [m.split(" ") if isinstance(m, str) else m for m in model["merges"]],
        "suffix": model["end_of_word_suffix"] or "",
        "pattern": _own_classes(split["pattern"]["Regex"], _not_yet_known(path)),
        "special": {t["content"]: t["id"] for t in spec["added_tokens"]},
        "capitals": _newer_capitals(),
    }


def _own_classes(pattern: str, new: str) -> str:
    """The split pattern with \\p{L} and \\p{N} cut down to the characters that the tokenizer's tables know."""
    if not new:
        return pattern
    simple = pattern.replace("[^\\s\\p{L}\\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{new}])")
    for kind in ("L", "N"):
        simple = simple.replace(f"[\\p{{{kind}}}]", f"(?:(?![{new}])\\p{{{kind}}})")
    return simple


class Bpe:
    """Encoder and decoder built from ``read_tokenizer``."""

    def __init__(self, spec: dict):
        vocab, suffix = spec["vocab"], spec["suffix"]
        self.pattern = regex.compile(spec["pattern"])
        self.special = spec["special"]
        self.capitals = spec["capitals"]
        self.capital_pattern = regex.compile("[" + "".join(map(chr, self.capitals)) + "]") if self.capitals else None
        self.special_pattern = (
            regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
            if self.special
            else None
        )
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        chars = byte_characters()
        code = {c: b for b, c in enumerate(chars)}
        # first ids of the bytes: in the middle of a piece and at its end
        self.middle = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], np.int64)
        # pairs that stand inside some token; [1] where the second byte ends a piece
        self.inside = np.zeros((2, 256, 256), bool)
        for token in vocab:
            ends = bool(suffix) and token.endswith(suffix)
            body = [code[c] for c in (token[: -len(suffix)] if ends else token)]
            for k in range(len(body) - 1):
                self.inside[int(ends and k == len(body) - 2), body[k], body[k + 1]] = True
        if not suffix:
            self.inside[1] = self.inside[0]
        left = np.array([vocab[a] for a, _ in spec["merges"]], np.int64)
        right = np.array([vocab[b] for _, b in spec["merges"]], np.int64)
        merged = np.array([vocab[a + b] for a, b in spec["merges"]], np.int64)
        self._hash(left << 20 | right, merged)
        self.cache: dict[str, bytes] = {}

    def _hash(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Pair -> (rank, merged id): two tables, then a sorted rest, so that no lookup loops."""
        self.slots = []
        rank = np.arange(len(keys))
        for salt in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
            place = self._place(keys, salt)
            table = np.full(1 << _HASH_BITS, -1, np.int64)
            table[place[::-1]] = np.arange(len(keys))[::-1]
            mine = table[place] == np.arange(len(keys))
            found_key = np.full(1 << _HASH_BITS, -1, np.int64)
            found = np.full((1 << _HASH_BITS, 2), NO_RANK, np.int32)
            found_key[place[mine]] = keys[mine]
            found[place[mine], 0], found[place[mine], 1] = rank[mine], merged[mine]
            self.slots.append((salt, found_key, found))
            keys, merged, rank = keys[~mine], merged[~mine], rank[~mine]
        order = np.argsort(keys)
        self.rest = (keys[order], rank[order], merged[order])

    @staticmethod
    def _place(keys: np.ndarray, salt: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(salt)) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)

    def _lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs; NO_RANK where there is no merge."""
        rank = np.full(keys.shape, NO_RANK, np.int32)
        merged = np.full(keys.shape, -1, np.int32)
        for salt, found_key, found in self.slots:
            place = self._place(keys, salt)
            hit = found_key[place] == keys
            rank[hit], merged[hit] = found[place[hit], 0], found[place[hit], 1]
        known, known_rank, known_merged = self.rest
        if len(known):
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[at] == keys
            rank[hit], merged[hit] = known_rank[at[hit]], known_merged[at[hit]]
        return rank, merged

    def _merge(self, rows: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge each row's ids until no pair is left; -1 fills the rows."""
        width = rows.shape[1]
        out, out_lens = rows.copy(), lens.copy()
        live = np.flatnonzero(lens > 1)
        part, n = rows[live], lens[live]
        while len(live) and width > 1:
            a, b = part[:, :-1], part[:, 1:]
            rank, merged = self._lookup(np.where(b >= 0, a << 20 | b, -2))
            at = np.argmin(rank, axis=1)
            every = np.arange(len(at))
            ok = rank[every, at] != NO_RANK
            done = ~ok
            out[live[done], :width], out_lens[live[done]] = part[done], n[done]
            live, part, n, at = live[ok], part[ok], n[ok], at[ok]
            if not len(live):
                break
            new = merged[every[ok], at]
            part[np.arange(len(at)), at] = new
            # close the gap behind the merged pair
            shift = np.arange(width)[None, :] > at[:, None]
            moved = np.full_like(part, -1)
            moved[:, :-1] = part[:, 1:]
            part = np.where(shift, moved, part)
            n = n - 1
        return out, out_lens

    def _merge_long(self, ids: np.ndarray) -> list[int]:
        """The same merges for one long fragment, by a heap over a linked list."""
        token = ids.tolist()
        n = len(token)
        after, before, heap = [*range(1, n), -1], [*range(-1, n - 1)], []

        def offer(places: list[int]) -> None:
            pairs = np.array([token[p] << 20 | token[after[p]] for p in places], np.int64)
            for p, pair, rank, new in zip(places, pairs.tolist(), *(x.tolist() for x in self._lookup(pairs)), strict=True):
                if rank != NO_RANK:
                    heapq.heappush(heap, (rank, p, pair, new))

        offer(list(range(n - 1)))
        while heap:
            _, p, pair, new = heapq.heappop(heap)
            q = after[p]
            if q < 0 or token[p] < 0 or token[p] << 20 | token[q] != pair:
                continue  # one of the two was merged meanwhile
            token[p], token[q] = new, -1
            after[p] = after[q]
            if after[p] >= 0:
                before[after[p]] = p
            offer([x for x in (before[p], p) if x >= 0 and after[x] >= 0])
        return [t for t in token if t >= 0]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """ids (int32 as bytes) of each pre-token."""
        if not pieces:
            return []
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(lens)
        last = np.zeros(len(data), bool)
        last[ends - 1] = True
        ids = np.where(last, self.final[data], self.middle[data])
        # forced boundaries: behind every piece, and at pairs inside no token
        cut = last.copy()
        if len(data) > 1:
            cut[:-1] |= ~self.inside[last[1:].astype(np.int64), data[:-1], data[1:]]
        stops = np.flatnonzero(cut) + 1
        starts = np.concatenate([[0], stops[:-1]])
        sizes = stops - starts
        kept = sizes.copy()
        result = ids.copy()
        # rows of like length together, so that little is padded
        order = np.argsort(sizes, kind="stable")
        group = np.where(sizes <= 32, sizes, 32 + np.ceil(np.log2(np.maximum(sizes, 1) / 32)).astype(np.int64))[order]
        bounds = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if group[lo] <= 1:
                continue
            members = order[lo:hi]
            if sizes[members[0]] > LONG_FRAGMENT:
                for m in members:
                    done = self._merge_long(ids[starts[m] : stops[m]])
                    kept[m] = len(done)
                    result[starts[m] : starts[m] + len(done)] = done
                continue
            width = int(sizes[members].max())
            step = max(1, 400_000 // width)
            for k in range(0, len(members), step):
                some = members[k : k + step]
                where = starts[some][:, None] + np.arange(width)
                there = np.arange(width) < sizes[some][:, None]
                rows = np.where(there, ids[np.minimum(where, len(ids) - 1)], -1)
                rows, kept[some] = self._merge(rows, sizes[some])
                result[where[there]] = rows[there]
        result = result.astype(np.int32)
        # drop what the merges freed: the first ``kept`` places of each fragment stay
        within = np.arange(len(ids)) - np.repeat(starts, sizes)
        stay = within < np.repeat(kept, sizes)
        count = np.concatenate([[0], np.cumsum(stay)])
        packed = result[stay].tobytes()
        cuts = (count[np.concatenate([[0], ends])] * 4).tolist()
        return [packed[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _learn(self, chunks: set[str]) -> None:
        """Put the ids of new white-space-separated chunks into the cache."""
        plain = [c for c in chunks if c.isalpha()]
        self.cache.update(zip(plain, self._encode_pieces(plain), strict=True))
        mixed = [c for c in chunks if not c.isalpha()]
        pieces = list(map(self.pattern.findall, mixed))
        flat = list(set(chain.from_iterable(pieces)) - self.cache.keys())
        self.cache.update(zip(flat, self._encode_pieces(flat), strict=True))
        get = self.cache.__getitem__
        for chunk, parts in zip(mixed, pieces, strict=True):
            self.cache[chunk] = b"".join(map(get, parts))

    def _chunks(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower-casing looks at one character at a time: no final sigma
            text = text.replace("Σ", "σ")
        text = text.lower()
        if self.capital_pattern is not None and not text.isascii() and self.capital_pattern.search(text):
            text = text.translate(self.capitals)
        # str.split also splits at four control characters that are no white space
        return text.split() if not _SEPARATORS.search(text) else _WHITE.sub(" ", text).strip(" ").split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """ids of each text, as the bytes of int32 numbers."""
        split = []
        for text in texts:
            text = text or ""
            if self.special_pattern is not None and self.special_pattern.search(text):
                parts, at = [], 0
                for m in self.special_pattern.finditer(text):
                    parts += [self._chunks(text[at : m.start()]), m.group()]
                    at = m.end()
                split.append([*parts, self._chunks(text[at:])])
            else:
                split.append([self._chunks(text)])
        new = set()
        for parts in split:
            for part in parts:
                if not isinstance(part, str):
                    new.update(part)
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
        self._learn(new - self.cache.keys())
        get = self.cache.__getitem__
        out = []
        for parts in split:
            done = [
                np.int32(self.special[p]).tobytes() if isinstance(p, str) else b"".join(map(get, p)) for p in parts
            ]
            out.append(done[0] if len(done) == 1 else b"".join(done))
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def encode_decode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True
) -> DataFrame:
    """(id, ids array<int>, decoded) of every row's whole text; ``decoded`` is made from the ids alone."""
    spec = read_tokenizer(tokenizer_path)
    limit = 1 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(spec)
        for batch in batches:
            ids_col, column = batch.column("_id"), batch.column("_text")
            sizes = np.cumsum(_lengths(column))
            low = 0
            while low < batch.num_rows:
                base = sizes[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(sizes, base + limit, side="right")))
                packed = bpe.encode(column.slice(low, high - low).to_pylist())
                lens = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
                flat = np.frombuffer(b"".join(packed), np.int32)
                offsets = np.concatenate([[0], np.cumsum(lens)])
                texts = [None] * len(lens)
                if decode:
                    spans = zip(offsets[:-1], offsets[1:], strict=True)
                    texts = [bpe.decode(flat[a:b].tolist()) for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_col.slice(low, high - low),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                        pa.array(texts, pa.string()),
                    ],
                    ["_id", "ids", "decoded"],
                )
                low = high

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {kind}, ids array<int>, decoded string"
    )
    return out.withColumnRenamed("_id", id_col)


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
