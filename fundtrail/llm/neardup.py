"""Near-duplicate documents by HyperMinHash, banding and exact verification.

1. Every whole text gives its set of distinct word shingles (64-bit hashes),
   a 128-bit digest of the set, and a HyperMinHash sketch: the shingles are
   split over 128 buckets, and each bucket keeps of its smallest hash the
   number of leading zeros and the 10 bits behind them.
2. Texts with equal sets form one class; only one member per class goes on, so
   thousands of copies cost as much as one.
3. Bands of six registers (empty buckets borrow from others) give bucket keys.
   Each bucket names its smallest member as hub and offers hub-member pairs,
   so a bucket of m members offers m - 1 pairs, not m * m.
4. Pairs whose collision-corrected Jaccard estimate is far below the threshold
   go; the others are verified on the full shingle sets, computed again from
   the two texts. Verified links give components.
5. Hub pairs can miss links among members of one bucket that are still in
   different components. Those members, and only those, are compared with the
   rest of their bucket by sketch, in blocks that hold the full sets; possible
   pairs are verified there, and a block returns at most one link per member. Every pair that shares a bucket is thus either already connected,
   ruled out by its estimate, or verified. No bucket is capped.

Edge cases: a null or empty text, or one without words, has no shingles and is
linked with nothing; a text with fewer words than a shingle is one shingle. A
row without id links with nothing and gets a null component. Where rows
repeat an id with different texts, each text is linked by its own set: classes
are numbered, and ids only name the components at the end (so two components
have the same name when one id is the smallest of both). An empty table gives
an empty result. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.components import connected_components
from fundtrail.llm.rows import NO_ID, only_rows, row_key, without_rows
from fundtrail.llm.textblocks import LOWER, TOKEN_BYTES, U64, blocks, distinct_sorted, mix, run_hashes, runs, shingles
from fundtrail.session import materialize

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND_ROWS = 6
BANDS = BUCKETS // BAND_ROWS
#: An estimate is ruled out when it lies so many standard deviations under the threshold.
DEVIATIONS = 4.0
#: Members of one side of a block of comparisons in step 5.
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 2_000_000

_rotations = np.array([(np.arange(BUCKETS) * 2 * k + 37 * k + np.arange(BUCKETS)) % BUCKETS for k in range(1, 17)])


def _sets(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block, and their offsets."""
    low = LOWER[data]
    starts, ends, first = runs(low, offs, TOKEN_BYTES)
    values, owner = shingles(run_hashes(low, starts, ends), first, size)
    return distinct_sorted(values, owner, len(offs) - 1)


def _registers(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of registers per text; 0 marks an empty bucket."""
    texts = len(offs) - 1
    out = np.zeros((texts, BUCKETS), np.uint16)
    if not len(values):
        return out
    owner = np.repeat(np.arange(texts), np.diff(offs))
    bucket = (values >> U64(64 - BUCKET_BITS)).astype(np.int64)
    # sorted by hash: the first of each (text, bucket) is the smallest of the bucket
    first = np.ones(len(values), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
    rest = (values[first] << U64(BUCKET_BITS)) >> U64(11)  # 53 bits, exact as a double
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    zeros = 53 - length
    # the bits behind the leading one
    shift = np.maximum(length - 1 - MANTISSA_BITS, 0).astype(U64)
    mantissa = (rest >> shift) & U64((1 << MANTISSA_BITS) - 1)
    packed = (np.minimum(zeros, 62) << MANTISSA_BITS) | mantissa.astype(np.int64)
    out[owner[first], bucket[first]] = (packed + 1).astype(np.uint16)
    return out


def _filled(registers: np.ndarray) -> np.ndarray:
    """Registers with empty buckets filled from others, the same way for every text."""
    out = registers.copy()
    todo = np.flatnonzero((registers == 0).any(axis=1) & (registers != 0).any(axis=1))
    if not len(todo):
        return out
    part, source = out[todo], registers[todo]
    for donor in _rotations:
        empty = part == 0
        if not empty.any():
            break
        part = np.where(empty, source[:, donor], part)
    step = 1
    while (part == 0).any():  # few buckets filled: the nearest one to the right
        part = np.where(part == 0, np.roll(source, -step, axis=1), part)
        step += 1
    out[todo] = part
    return out


def _band_keys(registers: np.ndarray) -> np.ndarray:
    """(texts, bands) 64-bit keys."""
    filled = _filled(registers).astype(U64)
    keys = np.empty((len(registers), BANDS), U64)
    for band in range(BANDS):
        key = np.full(len(registers), band + 1, U64)
        for k in range(BAND_ROWS):
            key = mix(key * U64(0x9E3779B97F4A7C15) + filled[:, band * BAND_ROWS + k])
        keys[:, band] = key
    return keys


def _estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of pairs of register rows, corrected for chance collisions, and the buckets used."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    large, small = np.maximum(na, nb), np.minimum(na, nb)
    ratio = large / np.maximum(small, 1)
    # two different minima agree with about this chance in a bucket that both fill
    chance = 0.1699194 * 2.0 ** (1 - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    share = same / np.maximum(used, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1), used


def _possible(a, b, na, nb, percent: int) -> np.ndarray:
    """Whether a pair may reach the threshold: by set sizes (exact) and by estimate (with a wide margin)."""
    t = percent / 100
    est, used = _estimate(a, b, na, nb)
    margin = DEVIATIONS * np.sqrt(t * (1 - t) / np.maximum(used, 1)) + 1e-9
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (est >= t - margin)


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, mark, n, digest, registers) per row; digest and registers are null without shingles.

    ``mark`` is a hash of the text, to find it again.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in blocks(batch.column("_text")):
                values, cuts = _sets(data, offs, size)
                registers = _registers(values, cuts)
                n = np.diff(cuts)
                digests = [
                    hashlib.blake2b(values[i:j].tobytes(), digest_size=16).digest() if j > i else None
                    for i, j in zip(cuts[:-1], cuts[1:], strict=True)
                ]
                rows = [row.tobytes() if k else None for row, k in zip(registers, n, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(a, b - a),
                        batch.column("mark").slice(a, b - a),
                        pa.array(n, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(rows, pa.binary()),
                    ],
                    ["id", "mark", "n", "digest", "registers"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("_text")
    ).mapInArrow(build, f"id {kind}, mark long, n long, digest binary, registers binary")


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, BUCKETS), np.uint16)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def band_rows(classes: DataFrame) -> DataFrame:
    """(key, rep): the bucket keys of each class."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _band_keys(_matrix(batch.column("registers")))
            reps = np.repeat(np.asarray(batch.column("rep")), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(reps)], ["key", "rep"]
            )

    return classes.select("rep", "registers").mapInArrow(explode, "key long, rep long")


def _screen(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may reach the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = _possible(
                _matrix(batch.column("ra")),
                _matrix(batch.column("rb")),
                np.asarray(batch.column("na")),
                np.asarray(batch.column("nb")),
                percent,
            )
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(keep, "a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold. ``texts``: (rep, text)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = np.asarray(batch.column("a")), np.asarray(batch.column("b"))
            ok = np.zeros(len(a), bool)
            # sorted by hub, so its set is built once for a run of its pairs
            last, hub = None, None
            for low, high, data, offs in blocks(batch.column("tb")):
                values, cuts = _sets(data, offs, size)
                for k in range(low, high):
                    if a[k] != last:
                        one = next(blocks(batch.column("ta").slice(k, 1)))
                        last, hub = a[k], _sets(one[2], one[3], size)[0]
                    other = values[cuts[k - low] : cuts[k - low + 1]]
                    at = np.searchsorted(hub, other)
                    at[at == len(hub)] = 0
                    common = int((hub[at] == other).sum()) if len(hub) else 0
                    ok[k] = 100 * common >= percent * (len(hub) + len(other) - common)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return joined.mapInArrow(check, "a long, b long")


def _common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with each of several non-empty sets."""
    values = np.concatenate(others)
    at = np.searchsorted(one, values)
    at[at == len(one)] = 0
    starts = np.cumsum([0] + [len(o) for o in others[:-1]])
    return np.add.reduceat((one[at] == values).astype(np.int64), starts)


def _full_sets(texts: DataFrame, size: int) -> DataFrame:
    """(rep, values): the full shingle set of each text, as bytes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in blocks(batch.column("text")):
                values, cuts = _sets(data, offs, size)
                rows = [values[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").slice(a, b - a), pa.array(rows, pa.binary())], ["rep", "values"]
                )

    return texts.mapInArrow(build, "rep long, values binary")


def _rest_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components inside buckets that still hold several.

    ``members``: (key, rep, comp, n, registers). The component with most
    members of a bucket is its main one; every other member is compared with
    all members of another component. Members of one component are connected
    already, so a pair is only verified while it is not, and a block returns at
    most one link per member. Both sides are dealt into blocks by hash, bounded
    in members and in shingles, whatever the bucket's size.
    """
    sizes = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    main = sizes.groupBy("key").agg(
        F.max(F.struct("m", "comp", "s")).alias("top"),
        F.sum("m").alias("total"),
        F.sum("s").alias("held"),
        F.count(F.lit(1)).alias("comps"),
    )

    def dealt(count, shingles):
        return F.ceil(F.greatest(count / BLOCK_MEMBERS, shingles / BLOCK_SHINGLES, F.lit(1.0))).cast("long")

    main = main.where("comps > 1").select(
        "key",
        F.col("top.comp").alias("main"),
        dealt(F.col("total"), F.col("held")).alias("all_blocks"),
        dealt(F.col("total") - F.col("top.m"), F.col("held") - F.col("top.s")).alias("few_blocks"),
    )
    tagged = members.join(materialize(main, "buckets"), "key").join(sets, "rep")
    place = F.xxhash64("rep", F.lit(5))
    few = tagged.where(F.col("comp") != F.col("main")).select(
        "key", "rep", "comp", "n", "registers", "values", F.lit(True).alias("few"),
        F.pmod(place, F.col("few_blocks")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1)).alias("j"),
    )
    every = tagged.select(
        "key", "rep", "comp", "n", "registers", "values", F.lit(False).alias("few"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("few_blocks") - 1)).alias("i"),
        F.pmod(place, F.col("all_blocks")).alias("j"),
    )

    def compare(group: pa.Table) -> pa.Table:
        side = group.column("few").to_numpy()
        rep, comp, n = (group.column(c).to_numpy() for c in ("rep", "comp", "n"))
        registers = _matrix(group.column("registers").combine_chunks())
        values = [np.frombuffer(v.as_buffer(), U64) for v in group.column("values")]
        name = {c: k for k, c in enumerate(sorted(set(comp.tolist())))}
        label = np.array([name[c] for c in comp.tolist()])  # component of each row, as joined so far
        right = np.flatnonzero(~side)
        found_a, found_b = [], []
        for x in np.flatnonzero(side):
            others = right[label[right] != label[x]]
            if not len(others):
                continue
            same = np.broadcast_to(registers[x], (len(others), BUCKETS))
            many = np.full(len(others), n[x])
            others = others[_possible(same, registers[others], many, n[others], percent)]
            step = 8
            while len(others):
                # the likeliest first: most pairs are settled by the first link
                likeness = (registers[others] == registers[x]).sum(axis=1) if step == 8 else None
                if likeness is not None:
                    others = others[np.argsort(-likeness, kind="stable")]
                part, others = others[:step], others[step:]
                common = _common(values[x], [values[y] for y in part])
                for y in part[100 * common >= percent * (n[x] + n[part] - common)]:
                    if label[y] != label[x]:
                        found_a.append(rep[x])
                        found_b.append(rep[y])
                        label[label == label[y]] = label[x]
                others = others[label[others] != label[x]]
                step = 128
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return few.union(every).groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row.

    Rows are linked when 100 * common shingles >= ``percent`` * all shingles of
    both. The component is the smallest id reachable by links; ``kept`` marks
    the row whose id it is.
    """
    kind = docs.schema[id_col].dataType
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.col("first.least").cast(kind), F.col("id")))
    return _with_first(docs, id_col, text_col, size, percent).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: one row of each group stays.

    It is the row of the smallest id, and of those the one whose text has the
    smallest hash. Every row gets its own verdict: rows that share an id are
    compared by their own texts, and rows without id are compared too (they
    come behind all others). Rows without words are linked with nothing and
    stay, but a row that repeats both id and text of another goes.
    """
    keyed = docs.select(row_key(id_col, text_col)["id"].alias("key"), F.col(text_col).alias("body"))
    found = materialize(_with_first(keyed, "key", "body", size, percent).select("id", "mark", "first"), "verdicts")
    leads = (F.col("id") == F.col("first.least")) & (F.col("mark") == F.col("first.mark"))
    gone = found.where(F.col("first").isNotNull() & ~leads).select("id", "mark").distinct()
    stay = found.where(F.when(F.col("first").isNull(), F.col("id") != NO_ID).otherwise(leads))
    repeated = stay.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "mark")
    repeated = materialize(repeated, "repeated")
    kept = without_rows(docs, gone, id_col, text_col)
    if repeated.isEmpty():
        return kept
    again = only_rows(kept, repeated, id_col, text_col).dropDuplicates([id_col, text_col])
    return without_rows(kept, repeated, id_col, text_col).union(again)


def _with_first(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(id, mark, n, first) per row: the smallest (least: id, mark) of the row's component, null without words."""
    rows = materialize(sketch(docs, id_col, text_col, size), "sketches")
    # one member per set of shingles; registers are equal within a class. Classes have numbers of their own (fixed
    # once written), as an id may stand on rows of several classes
    classes = materialize(
        rows.where("digest is not null and id is not null")
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("id").cast("long").alias("least"), "mark")).alias("first"),
            F.first("n").alias("n"),
            F.first("registers").alias("registers"),
        )
        .select(F.monotonically_increasing_id().alias("rep"), "digest", "first.least", "first.mark", "n", "registers"),
        "classes",
    )
    bands = materialize(band_rows(classes), "bands")
    # written, as are the other bucket tables: a join with a table can split a crowded bucket, one with an aggregate cannot
    hubs = materialize(
        bands.groupBy("key")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        .where("hub <> last")
        .select("key", "hub"),
        "buckets",
    )
    hub_pairs = (
        bands.join(hubs, "key")
        .where("rep <> hub")
        .select(F.col("hub").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    texts = docs.select(
        F.col(id_col).cast("long").alias("least"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )
    marks = classes.select("rep", "least", "mark")
    screened = materialize(_screen(hub_pairs, classes, percent), "pairs")
    paired = screened.select(F.col("a").alias("rep")).union(screened.select("b"))
    links = materialize(_verify(screened, _needed(texts, marks, paired), size, percent), "links")
    parts = materialize(connected_components(links), "parts")

    shared = bands.join(hubs.select("key"), "key", "left_semi")
    named = (
        shared.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("comp", F.coalesce("component", "rep"))
        .drop("component")
    )
    # in a bucket of two, the hub pair was all there was
    mixed = materialize(
        named.groupBy("key")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
        .where("lo <> hi and m > 2")
        .select("key"),
        "buckets",
    )
    members = named.join(mixed, "key", "left_semi").join(classes.select("rep", "n", "registers"), "rep")
    members = materialize(members, "members")
    sets = _full_sets(_needed(texts, marks, members.select("rep")), size)
    more = materialize(_rest_links(members, sets, percent), "links")
    final = connected_components(links.union(more)).withColumnRenamed("node", "rep")

    # the smallest id of each component
    linked = materialize(final.join(marks, "rep"), "linked")
    first = F.struct("least", "mark")
    names = materialize(linked.groupBy("component").agg(F.min(first).alias("name")), "names")
    named = linked.join(names, "component").select("rep", "name")
    found = classes.join(named, "rep", "left").select("digest", F.coalesce("name", first).alias("first"))
    return rows.join(found, "digest", "left").select("id", "mark", "n", "first")


def _needed(texts: DataFrame, marks: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, text) of the classes named in ``ids``."""
    wanted = ids.distinct()
    return (
        texts.join(marks.join(wanted, "rep", "left_semi"), ["least", "mark"])
        .dropDuplicates(["rep"])
        .select("rep", "text")
    )
