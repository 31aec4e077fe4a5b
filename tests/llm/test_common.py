import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from accesslens.llm.common import slices


@given(st.lists(st.integers(0, 400), max_size=60), st.integers(1, 20), st.integers(50, 2000))
@settings(max_examples=150, deadline=None)
def test_slices_keep_all_rows_and_hold_few_rows_and_bytes(sizes, rows, limit):
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in sizes], pa.string())], names=["text"])
    out = list(slices(iter([batch]), rows, limit))
    assert [x for b in out for x in b.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(b.num_rows <= rows and (b.num_rows == 1 or b.nbytes <= limit) for b in out)


def test_many_megabyte_texts_come_few_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array(["m" * (1 << 20)] * 40, pa.string())], names=["text"])
    assert max(b.nbytes for b in slices(iter([batch]))) <= 9 << 20
