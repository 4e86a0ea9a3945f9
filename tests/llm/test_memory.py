"""Bounds of what a worker holds at once."""

import tracemalloc

import numpy as np
import pyarrow as pa

from taxalith.llm import common, exchange, jaccard, toxicity


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_batches_become_python_values_in_slices():
    texts = [f"{i:05d}" * 2000 for i in range(1500)] + ["", None, "x" * 9_000_000]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(texts))), "text": texts})
    got = list(common.columns([batch.slice(0, 0), batch], "n", "text"))
    assert [n for ns, _ in got for n in ns] == list(range(len(texts)))
    assert [t for _, ts in got for t in ts] == texts
    assert max(sum(map(len, filter(None, ts[:-1]))) for _, ts in got) <= 4_100_000


def test_training_takes_bounded_room_per_word():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 20_000, 2000)) for _ in range(400)]
    labels = [i % 2 for i in range(400)]
    assert peak(lambda: toxicity.train(texts, labels, epochs=2, warm=1)) < 62 * 800_000


def test_sums_in_parts_equal_bincount():
    rng = np.random.default_rng(2)
    place, values = rng.integers(0, 50, 1234).astype(np.int32), rng.normal(size=1234)
    assert (toxicity.summed(place, lambda s: values[s], 60, 100) == np.bincount(place, values, 60)).all()


def test_packs_are_read_one_at_a_time():
    elements = np.arange(600_000, dtype=np.uint64)
    totals = exchange.planes(np.ones(600_000, np.uint64))
    packs = {"nodes": [[7]] * 8, "ns": [[600_000]] * 8, "ls": [[1]] * 8, "sizes": [[600_000]] * 8, "elements": [exchange.planes(elements)] * 8, "replies": [[totals]] * 8}
    batch = pa.RecordBatch.from_pydict(packs)

    def read():
        for nodes, _, _, starts, got, counts in jaccard.unpacked([batch]):
            assert nodes == [7] and starts.tolist() == [0, 600_000] and (got == elements).all() and (counts == 1).all()

    assert peak(read) < 80_000_000
