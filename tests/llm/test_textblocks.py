import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fundtrail.llm import textblocks as B
from tests.llm.helpers import shingle_set, tokens, words

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z9é漢\t\n.-\x0b", max_size=40)), min_size=1, max_size=12)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_runs_match_regular_expressions(rows):
    for kind, split in ((B.WORD_BYTES, words), (B.TOKEN_BYTES, tokens)):
        for low, high, data, offs in B.blocks(pa.array(rows, pa.string()), limit=16):
            small = B.LOWER[data]
            starts, ends, first = B.runs(small, offs, kind)
            raw = small.tobytes()
            got = [[raw[starts[k] : ends[k]].decode() for k in range(first[i], first[i + 1])] for i in range(high - low)]
            assert got == [split(t) for t in rows[low:high]]


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 5))
def test_shingle_sets(rows, size):
    seen = {}
    for low, high, data, offs in B.blocks(pa.array(rows, pa.string()), limit=64):
        small = B.LOWER[data]
        starts, ends, first = B.runs(small, offs, B.TOKEN_BYTES)
        values, owner = B.shingles(B.run_hashes(small, starts, ends), first, size)
        values, cuts = B.distinct_sorted(values, owner, high - low)
        for k in range(high - low):
            want = shingle_set(rows[low + k], size)
            mine = values[cuts[k] : cuts[k + 1]]
            assert len(mine) == len(want)
            # equal sets have equal hashes, whatever the block
            assert seen.setdefault(want, mine.tolist()) == mine.tolist()


def test_slices_and_nulls():
    column = pa.array(["abc", None, "", "d"]).slice(1)
    data, offs = B.packed(column)
    assert data.tobytes() == b"d" and offs.tolist() == [0, 0, 0, 1]
    assert B.packed(pa.array([], pa.string()))[1].tolist() == [0]
    assert len(np.unique(B.salts(1000, 3))) == 1000
