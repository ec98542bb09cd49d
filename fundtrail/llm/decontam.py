"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and benchmark items are word sequences (lower-cased runs of letters,
digits and non-ASCII characters). A leak is an item of which some stretch of a
document is within a word edit distance of a fifth of the item's length.

* The CGK random walk reads a sequence from a start: at step t it emits the
  current word and moves on if a random bit of (t, word) says so. Two
  sequences at a small edit distance emit strings at a small Hamming distance.
* A window of a document starts at every ``STRIDE``-th word; items have a
  window at every word, so one of them starts where a document window does. The
  walk is short beside the item, so that among its windows some meet few of
  its edits.
* Bit-sampling LSH: each table hashes the words emitted at a few sampled
  steps. The number of tables per walk is measured at the most edits a leak may
  have (see ``TABLES``).
* Items under ``WALK_WORDS`` words are too short for windows that surely miss
  the edits. They are cut into one piece more than the edits allowed; one piece
  stands unedited in every leak, and all pieces are looked up at every word.
* Document windows whose key occurs among the items' keys are candidates. Those
  with too few words of the item around their place cannot be leaks; the others
  are verified exactly by dynamic programming over words (the item against the
  best stretch around its place).

Items come in blocks of bounded size, each sent to all tasks; documents are
scanned against every block and never shuffled, so neither copies nor hot
sources matter. Any number of items works, in more passes.

Edge cases: null or empty texts and items have no words and no leaks; items
with fewer than ``MIN_WORDS`` words are too short to count as evidence and are
left out; rows without an id are reported with a null id. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.textblocks import LOWER, U64, WORD_BYTES, blocks, mix, packed, run_hashes, runs, salts

MIN_WORDS = 5
STRIDE = 4
WALKS = 2
SAMPLED = 5
#: Items with fewer words are found by their pieces, those with as many or more by walks.
WALK_WORDS = 40
STEPS = 32
#: Tables per walk. Measured with exactly ``MAX_EDITS_SHARE`` of the words replaced, left out or added, at random or
#: evenly spread places: none of 500 leaks missed at 40, 45, 50, 60 and 100 words each (tests/llm/test_decontam.py).
TABLES = 16
MAX_EDITS_SHARE = 0.2
BLOCK_ITEM_WORDS = 200_000
_SCAN_BYTES = 1 << 18


def _allowed(item_words: int) -> int:
    """The most edits of a leak."""
    return int(MAX_EDITS_SHARE * item_words)


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (never 0) with one 0 behind each text, and the offsets of the texts in that array."""
    low = LOWER[data]
    starts, ends, first = runs(low, offs, WORD_BYTES)
    hashes = run_hashes(low, starts, ends) | U64(1)
    texts = len(offs) - 1
    out = np.zeros(len(hashes) + texts, U64)
    owner = np.repeat(np.arange(texts), np.diff(first))
    out[np.arange(len(hashes)) + owner] = hashes
    return out, first + np.arange(texts + 1)


def _samples(walk: int, steps: int, tables: int) -> np.ndarray:
    """(tables, SAMPLED) steps; every table samples over the whole walk."""
    rng = np.random.default_rng(walk * 1009 + steps)
    return np.array([np.sort(rng.choice(steps, min(SAMPLED, steps), replace=False)) for _ in range(tables)])


def _emit(words: np.ndarray, at: np.ndarray, walk: int, steps: int) -> Iterator[tuple[int, np.ndarray]]:
    """(step, words emitted) for the walks from the positions ``at``; 0 past the end of a text."""
    at = at.copy()
    random = salts(steps, 100 + walk)
    for t in range(steps):
        now = words[at]
        yield t, now
        at += ((now * random[t]) >> U64(63)).astype(np.int64)  # word 0 never moves


class _Keys:
    """Sorted keys of items' windows, with a bitmap that rules most other keys out."""

    def __init__(self, key: np.ndarray, owner: np.ndarray, offset: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.key, self.owner, self.offset = key[order], owner[order], offset[order]
        bits = min(22, max(12, int(64 * len(key)).bit_length()))
        self.shift = U64(64 - bits)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[key >> self.shift] = True

    def candidates(self, key: np.ndarray, at: np.ndarray) -> np.ndarray | None:
        """(place of the window, item, offset in the item) for the windows at ``at`` with these keys."""
        maybe = np.flatnonzero(self.bitmap[key >> self.shift])
        if not len(maybe):
            return None
        lo = np.searchsorted(self.key, key[maybe], side="left")
        many = np.searchsorted(self.key, key[maybe], side="right") - lo
        entry = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
        return np.stack([at[np.repeat(maybe, many)], self.owner[entry], self.offset[entry]], axis=1)


class _Index:
    """Keys of one block of items, and what they point to."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.salts = salts(len(words), 11)
        self.bag = np.unique(np.concatenate([mix(w + x) for w, x in zip(words, self.salts, strict=True)] or [np.zeros(0, U64)]))
        self.classes = {STEPS: TABLES} if (self.sizes >= WALK_WORDS).any() else {}
        self.keys: dict[tuple[int, int, int], _Keys] = {}
        for steps, tables in sorted(self.classes.items()):
            mine = [k for k, w in enumerate(words) if len(w) >= WALK_WORDS]
            flat = np.concatenate([np.append(words[k], U64(0)) for k in mine])
            starts, owner, offset = [], [], []
            base = 0
            for k in mine:
                n = len(words[k])
                starts.append(base + np.arange(n))
                owner.append(np.full(n, k))
                offset.append(np.arange(n))
                base += n + 1
            starts, owner, offset = map(np.concatenate, (starts, owner, offset))
            for walk in range(WALKS):
                picked = _samples(walk, steps, tables)
                sums, inside = _table_keys(flat, starts, walk, steps, picked)
                for table in range(tables):
                    # past an item's end a document goes on, so such windows cannot be equal
                    ok = inside[table]
                    self.keys[steps, walk, table] = _Keys(sums[table][ok], owner[ok], offset[ok])
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for k, w in enumerate(words):
            if len(w) < WALK_WORDS:
                count = _allowed(len(w)) + 1
                length = len(w) // count
                for start in range(0, count * length, length):
                    key = int(_piece_keys(w[start : start + length], np.zeros(1, np.int64), length)[0])
                    pieces.setdefault(length, []).append((key, k, start))
        self.pieces = {
            length: _Keys(np.array([r[0] for r in rows], U64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
            for length, rows in sorted(pieces.items())
        }


def _piece_keys(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Keys of the ``length`` words from each of the positions ``at``."""
    total = np.full(len(at), length, U64)
    for k, factor in enumerate(salts(length, 13)):
        total += words[at + k] * factor
    return mix(total)


def _plausible(words: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, index: _Index) -> np.ndarray:
    """Whether words[low:high] holds as many words of the item as a leak must keep."""
    many = high - low
    owner = np.repeat(np.arange(len(low)), many)
    at = np.arange(int(many.sum())) + np.repeat(low - (np.cumsum(many) - many), many)
    key = mix(words[at] + index.salts[item][owner])
    place = np.searchsorted(index.bag, key)
    place[place == len(index.bag)] = 0
    kept = np.bincount(owner, index.bag[place] == key, minlength=len(low))
    sizes = index.sizes[item]
    return kept >= sizes - (MAX_EDITS_SHARE * sizes).astype(np.int64)


def _table_keys(words, at, walk, steps, picked) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Keys of every table, and whether all sampled words are inside the text."""
    sums = [np.full(len(at), steps * 64 + walk * 8 + k, U64) for k in range(len(picked))]
    inside = [np.ones(len(at), bool) for _ in picked]
    uses: dict[int, list[int]] = {}
    for table, row in enumerate(picked):
        for t in row:
            uses.setdefault(int(t), []).append(table)
    factor = salts(steps, 7)
    for t, now in _emit(words, at, walk, max(uses) + 1):
        for table in uses.get(t, ()):
            sums[table] += now * factor[t]
            inside[table] &= now != 0
    return [mix(s) for s in sums], inside


def _best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of ``text`` nearest to ``item`` in word edit distance."""
    n = len(text)
    cost, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    for i, word in enumerate(item, 1):
        take = np.empty(n + 1, np.int64)
        origin = np.empty(n + 1, np.int64)
        take[0], origin[0] = i, 0
        swap = cost[:-1] + (text != word)
        drop = cost[1:] + 1
        better = swap <= drop
        take[1:] = np.where(better, swap, drop)
        origin[1:] = np.where(better, begin[:-1], begin[1:])
        # words of the text left out: a running minimum of cost - position
        packed_cost = (take - steps) * (n + 2) + steps
        low = np.minimum.accumulate(packed_cost)
        source = low % (n + 2)
        cost = take[source] + steps - source
        begin = origin[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_item_words: int = BLOCK_ITEM_WORDS,
) -> DataFrame:
    """(id, item_id, start_word, end_word, edits, item_words) for every leak; one row per row of ``docs`` and item.

    ``block_item_words`` bounds the words of items that one pass sends to the tasks.
    """
    id_kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema[item_id_col].dataType.simpleString()
    schema = f"id {id_kind}, item_id {item_kind}, start_word long, end_word long, edits int, item_words int"
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = None
    for ids, texts in _item_blocks(items, item_id_col, item_text_col, block_item_words):
        part = source.mapInArrow(_scanner(ids, texts), schema)
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("id", id_col).withColumnRenamed("item_id", item_id_col)


def _item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of about ``limit`` words (bytes / 2 bounds the words), streamed to the driver one at a time."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        "id is not null and text is not null"
    )
    ids, texts, size = [], [], 0
    for row in rows.orderBy("id", "text").toLocalIterator():
        if size and size + len(row["text"]) > 2 * limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["id"])
        texts.append(row["text"])
        size += len(row["text"])
    if ids:
        yield ids, texts


def _scanner(ids: list, texts: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, offs = packed(pa.array(texts, pa.string()))
        flat, cuts = _words(data, offs)
        words = [flat[a : b - 1] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        usable = [k for k, w in enumerate(words) if len(w) >= MIN_WORDS]
        index = _Index([ids[k] for k in usable], [words[k] for k in usable])
        for batch in batches:
            out: list[tuple] = []
            for low, _, data, offs in blocks(batch.column("_text"), _SCAN_BYTES):
                if index.words:
                    out += [(low + doc, *rest) for doc, *rest in _scan_block(data, offs, index)]
            rows = pa.array([r[0] for r in out], pa.int64())
            ends = list(zip(*[r[1:] for r in out], strict=True)) if out else [()] * 5
            item_type = pa.infer_type(index.ids) if index.ids else pa.int64()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(rows),
                    pa.array([index.ids[k] for k in ends[0]], item_type),
                    pa.array(ends[1], pa.int64()),
                    pa.array(ends[2], pa.int64()),
                    pa.array(ends[3], pa.int32()),
                    pa.array(ends[4], pa.int32()),
                ],
                ["id", "item_id", "start_word", "end_word", "edits", "item_words"],
            )

    return scan


def _scan_block(data, offs, index: _Index) -> list[tuple]:
    """(text, item, start word, end word, edits, item words) of the leaks in one block."""
    words, cuts = _words(data, offs)
    # windows at every STRIDE-th word of each text (the closing 0 is no word)
    within = np.arange(len(words)) - np.repeat(cuts[:-1], np.diff(cuts))
    at = np.flatnonzero((within % STRIDE == 0) & (words != 0))
    if not len(at):
        return []
    candidates = []
    for walk in range(WALKS if index.classes else 0):
        longest = max(index.classes)
        picks = {steps: _samples(walk, steps, tables) for steps, tables in index.classes.items()}
        uses: dict[int, list[tuple[int, int]]] = {}
        for steps, rows in picks.items():
            for table, row in enumerate(rows):
                for t in row:
                    uses.setdefault(int(t), []).append((steps, table))
        factor = salts(longest, 7)
        sums = {
            (steps, table): np.full(len(at), steps * 64 + walk * 8 + table, U64)
            for steps, rows in picks.items()
            for table in range(len(rows))
        }
        for t, now in _emit(words, at, walk, max(uses) + 1):
            wanted = uses.get(t)
            if wanted:
                term = now * factor[t]
                for name in wanted:
                    sums[name] += term
        for (steps, table), total in sums.items():
            candidates.append(index.keys[steps, walk, table].candidates(mix(total), at))
    ends = np.repeat(cuts[1:] - 1, np.diff(cuts))
    for length, keys in index.pieces.items():
        every = np.flatnonzero(np.arange(len(words)) + length <= ends)
        candidates.append(keys.candidates(_piece_keys(words, every, length), every))
    candidates = [c for c in candidates if c is not None]
    if not candidates:
        return []
    found = np.concatenate(candidates)
    text = np.searchsorted(cuts, found[:, 0], side="right") - 1
    # where the item would start; one candidate per (text, item, place)
    place = found[:, 0] - found[:, 2]
    todo = np.unique(np.stack([text, found[:, 1], place], axis=1), axis=0)
    slack = (MAX_EDITS_SHARE * index.sizes[todo[:, 1]]).astype(np.int64)
    low = np.maximum(cuts[todo[:, 0]], todo[:, 2] - slack)
    high = np.minimum(cuts[todo[:, 0] + 1] - 1, todo[:, 2] + index.sizes[todo[:, 1]] + slack)
    todo = todo[_plausible(words, low, high, todo[:, 1], index)]
    best: dict[tuple[int, int], tuple] = {}
    for doc, item, start in todo.tolist():
        mine = index.words[item]
        allowed = _allowed(len(mine))
        seen = best.get((doc, item))
        if seen and (seen[2] == 0 or abs(seen[0] + cuts[doc] - start) <= allowed):
            continue  # already found there, or found without an edit
        low = max(int(cuts[doc]), start - allowed)
        high = min(int(cuts[doc + 1]) - 1, start + len(mine) + allowed)
        edits, a, b = _best_stretch(mine, words[low:high])
        if edits <= allowed and (seen is None or edits < seen[2]):
            best[doc, item] = (low + a - int(cuts[doc]), low + b - int(cuts[doc]), edits, len(mine))
    return [(doc, item, *rest) for (doc, item), rest in sorted(best.items())]
