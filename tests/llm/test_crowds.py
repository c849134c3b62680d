"""Crowds of texts that share much and link with few; memory of tasks."""

import tracemalloc

import numpy as np
import pyarrow as pa

from lakeward.llm import jaccard, repeats, suffixes
from lakeward.llm import vectors as V


def test_only_near_pairs_become_rows():
    """Sets of 100 shingles that share one token: pairs of neighbours share 96,
    all others too little, and no row is made for them."""
    own = V.mix64(np.arange(20 * 100, dtype=V.U)).reshape(20, 100)
    own[1::2, 4:] = own[::2, 4:]
    hashes = np.sort(own, axis=1).ravel()
    table = pa.table(
        {
            "token": np.full(20, 7),
            "x1": np.arange(20),
            "n": np.full(20, 100),
            "at": np.zeros(20, np.int64),
            "root": np.arange(20),
            "bins": V.binary_array(jaccard.bin_counts(hashes, np.arange(21) * 100).ravel(), np.arange(21) * jaccard.BINS),
        }
    )
    found = jaccard._between(80, 0)((pa.scalar(0),), table)
    assert list(zip(*found.to_pydict().values(), strict=True)) == [(k, k + 1) for k in range(0, 20, 2)]


def test_full_bins_of_a_sketch_say_nothing():
    many, few = np.full((1, jaccard.BINS), 255, np.uint8), np.ones((1, jaccard.BINS), np.uint8)
    sizes = np.array([100_000]), np.array([256])
    assert jaccard.near_sketches(sizes[0], sizes[0], many, many, 80).tolist() == [True]
    assert jaccard.near_sketches(sizes[0], sizes[1], many, few, 80).tolist() == [False]


def _peak(run):
    run()  # powers of the polynomials stay
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_a_task_copies_small_parts_of_a_batch():
    """Distinct texts of a batch are taken part by part."""
    letters = np.random.default_rng(2).integers(97, 123, (2_000, 10_000), np.uint8)
    texts = [x.tobytes().decode() for x in letters]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2_000)), pa.array(range(2_000)), pa.array(texts)], ["x1", "x2", "text"])
    windows, most = suffixes.SampledSuffixes(), []
    units = windows.units
    windows.units = lambda data, offsets: (most.append(pa.total_allocated_bytes() - before), units(data, offsets))[1]
    before = pa.total_allocated_bytes()
    assert sum(len(b) for b in repeats._send_anchors(windows, 16)(iter([batch])))
    assert max(most) < batch.nbytes / 2


def test_keys_of_a_chunk_need_little_memory():
    """A chunk all of whose windows are candidates, as it sends their keys."""
    windows = suffixes.SampledSuffixes()
    data = np.random.default_rng(1).integers(97, 123, repeats.CHUNK_BYTES, np.uint8)
    # four texts of a block each, as a chunk has them
    cuts = np.arange(5) * repeats.BLOCK_BYTES
    parts = [windows.anchors(*windows.units(data[a:b], np.array([0, b - a]))[:2])[0] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    row = {"chunk": 0, "text": data.tobytes(), "x1": np.arange(4).tobytes(), "x2": np.arange(4).tobytes(), "offsets": cuts.astype(np.int64).tobytes()}
    row |= {"counts": np.array([len(p) for p in parts], np.int64).tobytes(), "pos": np.concatenate(parts).astype(np.uint32).tobytes()}
    peak = _peak(lambda: repeats.Chunk.of(row, windows).distinct())
    assert peak < 64 * repeats.CHUNK_BYTES
