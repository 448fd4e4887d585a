"""Words, chunks and packed arrays."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from khodat.llm.common import narrow, pack, text_chunks, unpack, words_of


def check(texts):
    starts, ids, dictionary = words_of(texts)
    words = dictionary.to_pylist()
    got = [[words[i] for i in ids[a:b]] for a, b in zip(starts[:-1], starts[1:])]
    assert got == [[w.decode() for w in (t or "").encode().lower().split()] for t in texts.to_pylist()]


@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aZé日 \t\n\x0b\x0c\r\x1c\x85\xa0")))), st.integers(0, 5))
@settings(deadline=None)
def test_words(texts, offset):
    check(pa.array(texts, pa.string()).slice(min(offset, len(texts))))


def test_words_of_slices_of_real_texts():
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).combine_chunks()
    sizes = []
    for batch in table.to_batches():
        for chunk in text_chunks([batch], most=300_000):
            check(chunk.column("text"))
            sizes.append(chunk.num_rows)
    assert sum(sizes) == table.num_rows and len(sizes) > 5


def test_chunks_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"n": range(6), "text": ["", "abc", None, "x" * 50, "ab", "c"]})
    chunks = list(text_chunks([batch, batch.slice(6), batch], most=4))
    assert [c.column("n").to_pylist() for c in chunks] == [[0, 1, 2], [3], [4, 5]] * 2


def test_packed_arrays():
    arrays = [np.array([], np.uint64), np.array([2**64 - 1, 0], np.uint64), narrow(np.array([1, 300])), np.array([0.5], np.float32)]
    for a, b in zip(arrays, unpack(pack(*arrays))):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
    assert narrow(np.array([], np.int64)).dtype == np.uint8 and narrow(np.array([300])).dtype == np.uint16
