"""What a Python worker keeps from task to task is dropped by operators that need the room."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shoppulse.llm import best_fit_packing, grouped_prefix_join, suffix_tree_dedup

TEXTS = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2]), "text": pa.array(["a b c d " * 5, "e f g"])})
LAYOUT = best_fit_packing.layout([({3: 1}, 1)], best_fit_packing.CAPACITY)
PIECES = pa.RecordBatch.from_pydict(
    {c: pa.array(np.zeros(0, np.int64)) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "rank")}
)
MAPS = {
    "repeats": (suffix_tree_dedup._histogram_map(13, (1, 2)), TEXTS),
    "shingles": (grouped_prefix_join._frequent_map(3), TEXTS),
    "places": (best_fit_packing._place(LAYOUT), PIECES),
}


@pytest.mark.parametrize("name", MAPS)
def test_tokenizers_do_not_stay_beside_other_operators(name):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = best_fit_packing.JsonCodec.of(path).encode(["one text"])[0].tolist()
    run, batch = MAPS[name]
    assert list(run(iter([batch])))
    assert not best_fit_packing.JsonCodec._made
    assert best_fit_packing.JsonCodec.of(path).encode(["one text"])[0].tolist() == ids
