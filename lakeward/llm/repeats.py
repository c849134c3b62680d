"""Repeated windows of a corpus: the flow behind the two substring operators.

A window is ``length`` consecutive units (bytes or words) of one text; it
repeats if the same units also start anywhere else, in the same text or another
one.  Every window is judged, exactly, in two rounds that never make pairs:

1. A thin sample of positions (an operator's ``anchors``) is hashed.  Anchors
   are chosen so that any two equal windows hold an equal anchor at the same
   place; a window none of whose anchors repeats is therefore unique.  Tasks
   send each anchor hash once per task to the buckets that find repeats.
2. Texts with a repeated anchor are gathered into chunks of a few MB.  Each
   chunk sends the keys of its candidate windows, once each, to buckets, and
   gets one bit per key back: whether another chunk has it too.  The chunk then
   marks its windows and reads off the covered units.

Only distinct texts take part: a text with a copy elsewhere is covered whole if
it has a window, and a group of copies costs one row per task.  A hash that is
found everywhere reaches a bucket at most once per task or chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .texts import Folder, distinct_texts, keyed, partitions

BLOCK_BYTES = 1 << 20
CHUNK_BYTES = 4 << 20
#: Anchors held by a task before they are sent.
FLUSH = 1 << 22
#: The sample for the splitters: keys of about so many chunks.
SAMPLED_CHUNKS = 32
KEYS_PER_CHUNK = 256

V.return_large_arrays()  # else workers keep what their largest chunk needed

_POLY = V.Polynomial(1)
_BYTES = V.Polynomial(2)


class Windows:
    """What an operator fixes: its units, window length and anchors."""

    length: int

    def units(self, data: np.ndarray, offsets: np.ndarray):
        """(64-bit value per unit, bounds of texts in units, starts, ends of
        the units in bytes)."""
        raise NotImplementedError

    def anchors(self, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors of texts with a window."""
        raise NotImplementedError

    def candidates(self, values: np.ndarray, bounds: np.ndarray, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold an anchor flagged in ``repeated``."""
        raise NotImplementedError

    def keys(self, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(32 bits of the window's first half, 64 bits of the whole window)."""
        sums = _POLY.sums(values)
        head = _POLY.spans(sums, starts, starts + self.length // 2) >> V.U(32)
        return head.astype(np.uint32), _POLY.spans(sums, starts, starts + self.length)


class WordUnits(Windows):
    def units(self, data, offsets):
        starts, ends, bounds = V.words(data, offsets)
        return V.word_hashes(data, starts, ends, _BYTES), bounds, starts, ends


class ByteUnits(Windows):
    def units(self, data, offsets):
        at = np.arange(len(data) + 1)
        return _BYTES.values[data], offsets, at[:-1], at[1:]


def _positions_by_text(x1: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.lexsort((pos, x1))
    x1, pos = x1[order], pos[order]
    cuts = np.flatnonzero(np.diff(x1)) + 1 if len(x1) else np.zeros(0, np.int64)
    first = np.concatenate([[0], cuts]).astype(np.int64) if len(x1) else cuts
    return x1[first], np.concatenate([first, [len(x1)]]).astype(np.int64), pos.astype(np.uint32)


SENT = "bucket int, hashes binary, x1 binary, pos binary"
FOUND = "x1 long, pos binary"


def _send_anchors(windows: Windows, buckets: int):
    """Tasks: anchors of their distinct texts, once per hash.  Anchors that
    repeat within a task are known already and travel as bucket -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def row(bucket: int, hashes, x1, pos) -> pa.RecordBatch:
            cells = [pa.array([bucket], pa.int32())]
            cells += [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (hashes, x1, V.narrow(pos))]
            return pa.RecordBatch.from_arrays(cells, ["bucket", "hashes", "x1", "pos"])

        def flush() -> Iterator[pa.RecordBatch]:
            hashes, x1, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(hashes, kind="stable")
            hashes, x1, pos = hashes[order], x1[order], pos[order]
            same = hashes[1:] == hashes[:-1]
            again = np.concatenate([[False], same])
            local = again | np.concatenate([same, [False]])
            if local.any():
                yield row(-1, np.zeros(0, np.uint32), x1[local], pos[local])
            hashes, x1, pos = hashes[~again], x1[~again], pos[~again]
            bucket = ((hashes >> V.U(32)) * V.U(buckets) >> V.U(32)).astype(np.int64)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in range(buckets):
                lo, hi = cuts[b], cuts[b + 1]
                if lo < hi:
                    by_text = lo + np.lexsort((pos[lo:hi], x1[lo:hi]))
                    low = hashes[by_text].astype(np.uint32)  # within a bucket
                    yield row(b, low, x1[by_text], pos[by_text])

        for part in (p for batch in batches for p in V.slices(batch)):
            keys = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
            fresh = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
            if not fresh:
                continue
            rows = part.take(pa.array(fresh))
            names = rows.column(0).to_numpy()
            for a, b, data, offsets in V.blocks(rows.column(2), BLOCK_BYTES):
                values, bounds, _, _ = windows.units(data, offsets)
                at, hashes = windows.anchors(values, bounds)
                if not len(at):
                    continue
                text = np.searchsorted(bounds, at, "right") - 1
                held.append((hashes, names[a:b][text], at - bounds[text]))
                size += len(at)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _find_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """A bucket: the anchors whose hash is found at two places or more."""
    parts = []
    for h, x, p in zip(table.column("hashes"), table.column("x1"), table.column("pos"), strict=True):
        x1 = np.frombuffer(x.as_buffer(), np.int64)
        parts.append((np.frombuffer(h.as_buffer(), np.uint32), x1, V.wide(p, len(x1))))
    x1, pos = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    if key[0].as_py() >= 0:
        hashes = np.concatenate([p[0] for p in parts])
        order = np.lexsort((pos, x1, hashes))
        hashes, x1, pos = hashes[order], x1[order], pos[order]
        if len(hashes):  # the same text may come from several tasks
            new = np.concatenate([[True], (np.diff(x1) != 0) | (np.diff(pos) != 0) | (hashes[1:] != hashes[:-1])])
            hashes, x1, pos = hashes[new], x1[new], pos[new]
        same = hashes[1:] == hashes[:-1]
        repeated = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(hashes) else same
        x1, pos = x1[repeated], pos[repeated]
    names, cuts, values = _positions_by_text(x1, pos)
    if not len(names):
        return pa.table({"x1": pa.array([], pa.int64()), "pos": pa.array([], pa.binary())})
    return pa.table({"x1": pa.array(names), "pos": V.binary_array(values, cuts)})


CHUNKS = "chunk long, x1 binary, x2 binary, offsets binary, text binary, counts binary, pos binary"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (x1, x2, text, [positions]) into chunk rows of about CHUNK_BYTES."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        for a, b, data, offsets in V.blocks(batch.column(2), CHUNK_BYTES):
            found = [
                np.unique(np.frombuffer(b"".join(x), np.uint32)) for x in batch.column(3).slice(a, b - a).to_pylist()
            ]
            cells = [
                batch.column(0).slice(a, b - a).to_numpy(),
                batch.column(1).slice(a, b - a).to_numpy(),
                offsets.astype(np.int64),
                data,
                np.array([len(x) for x in found], np.int64),
                np.concatenate(found).astype(np.uint32),
            ]
            arrays = [pa.array([part << 32 | seq], pa.int64())]
            arrays += [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cells]
            yield pa.RecordBatch.from_arrays(arrays, ["chunk", "x1", "x2", "offsets", "text", "counts", "pos"])
            seq += 1


@dataclass
class Chunk:
    """A chunk read back, with the keys of its candidate windows; the blocks
    are kept only for cutting."""

    number: int
    x1: np.ndarray
    x2: np.ndarray
    blocks: list[tuple]
    heads: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, row: dict, windows: Windows, cut: bool = False) -> Chunk:
        x1, x2 = np.frombuffer(row["x1"], np.int64), np.frombuffer(row["x2"], np.int64)
        offsets, data = np.frombuffer(row["offsets"], np.int64), np.frombuffer(row["text"], np.uint8)
        counts, pos = np.frombuffer(row["counts"], np.int64), np.frombuffer(row["pos"], np.uint32).astype(np.int64)
        ends = np.cumsum(counts)
        blocks, heads, keys = [], [], []
        a, n = 0, len(x1)
        while a < n:
            b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK_BYTES, "right")) - 1))
            part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            values, bounds, starts, stops = windows.units(part, cuts)
            begin = int(ends[a] - counts[a])
            text = np.repeat(np.arange(b - a), counts[a:b])
            repeated = np.zeros(len(values) + 1, bool)
            repeated[pos[begin : int(ends[b - 1])] + bounds[text]] = True
            at = windows.candidates(values, bounds, repeated)
            head, key = windows.keys(values, at)
            heads.append(head)
            keys.append(key)
            if cut:
                blocks.append((a, b, part, cuts, bounds, starts, stops, at))
            a = b
        return cls(row["chunk"], x1, x2, blocks, np.concatenate(heads), np.concatenate(keys))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(heads, keys, index of each window's key, whether it is found twice
        in the chunk), sorted by head and key.  The chunk's own go."""
        order = np.lexsort((self.keys, self.heads)).astype(np.uint32)
        heads, keys = self.heads[order], self.keys[order]
        self.heads, self.keys = heads[:0], keys[:0]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (heads[1:] != heads[:-1])
        index = np.empty(len(keys), np.uint32)
        index[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        del order
        heads, keys = heads[new], keys[new]
        return heads, keys, index, np.diff(np.append(np.flatnonzero(new), len(new))) > 1


def full_keys(heads: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Sort position of a key as 64 bits: its head, then the key's top."""
    return heads.astype(V.U) << V.U(32) | keys >> V.U(32)


WINDOW_KEYS = "bucket int, chunk long, heads binary, keys binary"
SHARED = "bucket int, chunk long, shared binary, first boolean, last boolean, head long, key long"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; binary cells as buffers, without a copy."""
    for batch in batches:
        for i in range(len(batch)):
            cells = zip(batch.schema.names, (c[i] for c in batch.columns), strict=True)
            yield {n: c.as_buffer() if pa.types.is_binary(c.type) else c.as_py() for n, c in cells}


def bucket_cuts(chunk: int, order: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """Where each bucket's keys begin in the sorted keys of a chunk.  A key
    equal to a splitter goes below or above it by the chunk's number, so a
    string that is found everywhere is shared between two buckets."""
    inner = np.searchsorted(order, splitters, "left" if chunk & 1 else "right")
    return np.concatenate([[0], inner, [len(order)]])


def _send_keys(windows: Windows, splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk.of(row, windows)
            heads, keys, _, _ = chunk.distinct()
            cuts = bucket_cuts(chunk.number, full_keys(heads, keys), splitters)
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full.astype(np.int32)),
                    pa.array(np.full(len(full), chunk.number), pa.int64()),
                    pa.array([heads[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()),
                    pa.array([keys[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()),
                ],
                ["bucket", "chunk", "heads", "keys"],
            )

    return run


def _sample_keys(windows: Windows, per_chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            heads, keys, _, _ = Chunk.of(row, windows).distinct()
            order = full_keys(heads, keys)
            picked = order[np.linspace(0, len(order) - 1, min(per_chunk, len(order))).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(picked.astype(np.int64))], ["key"])

    return run


def _sort_bucket(key: tuple, table: pa.Table) -> pa.Table:
    """One bucket, sorted as by multikey quicksort: by the heads first; only
    keys whose head is found again are compared further."""
    heads = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("heads")]
    keys = [np.frombuffer(x.as_buffer(), V.U) for x in table.column("keys")]
    sizes = np.array([len(x) for x in heads], np.int64)
    all_heads, all_keys = np.concatenate(heads), np.concatenate(keys)
    order = np.argsort(all_heads, kind="stable")
    ordered = all_heads[order]
    same = ordered[1:] == ordered[:-1]
    tied = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    run = order[tied]
    run = run[np.lexsort((all_keys[run], all_heads[run]))]
    equal = (all_keys[run[1:]] == all_keys[run[:-1]]) & (all_heads[run[1:]] == all_heads[run[:-1]])
    shared = np.zeros(len(all_heads), bool)
    shared[run[1:][equal]] = True
    shared[run[:-1][equal]] = True
    # the ends of the bucket, for the comparison with its neighbours
    order_keys = full_keys(all_heads, all_keys)
    ends = np.cumsum(sizes)
    rows: dict[str, list] = {n: [] for n in ("bucket", "chunk", "shared", "first", "last", "head", "key")}
    number = key[0].as_py()

    def add(chunk, bits, first, last, head=None, word=None):
        for n, v in zip(rows, (number, chunk, bits, first, last, head, word), strict=True):
            rows[n].append(v)

    for chunk, size, end in zip(table.column("chunk").to_pylist(), sizes, ends, strict=True):
        add(chunk, np.packbits(shared[end - size : end]).tobytes(), False, False)
    for first, edge in ((True, order_keys.min()), (False, order_keys.max())):
        at = np.flatnonzero(order_keys == edge)
        for h, w in {(int(all_heads[i]), int(all_keys[i].astype(np.int64))) for i in at}:
            add(None, None, first, not first, h, w)
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
    return pa.table([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))


RESULT = "x1 long, x2 long, n_units long, spans array<struct<start:int,length:int>>, n_removed long, kept binary"


def _mark(windows: Windows, splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk.of(row, windows, cut=True)
            heads, keys, index, shared = chunk.distinct()
            cuts = bucket_cuts(chunk.number, full_keys(heads, keys), splitters)
            for cell in row["bits"] or ():
                lo, hi = cuts[cell["bucket"]], cuts[cell["bucket"] + 1]
                shared[lo:hi] |= np.unpackbits(np.frombuffer(cell["shared"], np.uint8), count=hi - lo) > 0
            for cell in row["edges"] or ():  # strings that two neighbouring buckets hold
                word = np.int64(cell["key"]).astype(V.U)
                shared |= (heads == np.uint32(cell["head"])) & (keys == word)
            yield from _cut(chunk, windows, shared[index])

    return run


def _cut(chunk: Chunk, windows: Windows, repeated: np.ndarray) -> Iterator[pa.RecordBatch]:
    begin = 0
    for a, b, data, cuts, bounds, starts, stops, at in chunk.blocks:
        flags = repeated[begin : begin + len(at)]
        begin += len(at)
        total = int(bounds[-1])
        # a window lies within its text, so runs of covered units may touch but not cross bounds
        gone = V.covered(at[flags], windows.length, total)
        edge = np.zeros(total + 1, bool)
        edge[bounds] = True
        opens = gone.copy()
        opens[1:] &= ~gone[:-1] | edge[1:total]
        closes = gone.copy()
        closes[:-1] &= ~gone[1:] | edge[1:total]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        per_text = np.searchsorted(first, bounds)
        own = np.repeat(bounds[:-1], np.diff(per_text))
        spans = pa.StructArray.from_arrays(
            [pa.array((first - own).astype(np.int32)), pa.array((last - first).astype(np.int32))], ["start", "length"]
        )
        edges = np.concatenate([[0], np.cumsum(gone)])
        removed = np.zeros(len(data) + 1, np.int64)  # bytes of the covered units
        np.add.at(removed, starts[first] if len(first) else first, 1)
        np.add.at(removed, stops[last - 1] if len(last) else last, -1)
        keep = np.cumsum(removed)[: len(data)] == 0
        kept_at = np.concatenate([[0], np.cumsum(keep)])[cuts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chunk.x1[a:b]),
                pa.array(chunk.x2[a:b]),
                pa.array(np.diff(bounds)),
                pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), spans),
                pa.array(edges[bounds[1:]] - edges[bounds[:-1]]),
                V.binary_array(data[keep], kept_at),
            ],
            ["x1", "x2", "n_units", "spans", "n_removed", "kept"],
        )


def repeated_spans(docs: DataFrame, windows: Windows, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(classes, marked): every distinct text (x1, x2, copies), and those with
    a candidate window (x1, x2, n_units, spans in units, n_removed, and
    ``kept``: the text without the bytes from each span's first to last unit).

    A text with ``copies`` above one and at least one window is covered whole;
    the caller applies that, since its copies are not in ``marked`` twice."""
    spark = docs.sparkSession
    folder = Folder(spark, "repeats")
    buckets = max(16, partitions(spark))
    rows = keyed(docs, id_col, text_col)
    classes = rows.groupBy("x1", "x2").agg(F.count(F.lit(1)).alias("copies"))
    sent = rows.select("x1", "x2", "text").mapInArrow(_send_anchors(windows, buckets), SENT)
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("x1"), F.lit(buckets)).cast("int")).otherwise(F.col("bucket"))
    found = sent.withColumn("bucket", spread).groupBy("bucket").applyInArrow(_find_anchors, FOUND)
    by_text = found.groupBy("x1").agg(F.collect_list("pos").alias("pos"))
    wanted = by_text.join(classes, "x1").select("x1", "x2", "pos")
    gathered = distinct_texts(docs, text_col).join(wanted, ["x1", "x2"]).select("x1", "x2", "text", "pos")
    chunks = folder.keep(gathered.mapInArrow(_gather, CHUNKS), "chunks")
    # keys of a bounded number of chunks give the splitters
    stride = max(1, chunks.count() // SAMPLED_CHUNKS)
    some = chunks.filter(F.pmod(F.xxhash64("chunk"), F.lit(stride)) == 0)
    sample = some.mapInArrow(_sample_keys(windows, KEYS_PER_CHUNK), "key long").limit(4 * SAMPLED_CHUNKS * KEYS_PER_CHUNK)
    sample_sorted = np.sort(sample.toPandas()["key"].to_numpy().astype(np.int64).view(V.U))
    at = np.linspace(0, len(sample_sorted), buckets + 1).astype(np.int64)[1:-1]
    splitters = np.unique(sample_sorted[at]) if len(sample_sorted) else sample_sorted
    keys = chunks.mapInArrow(_send_keys(windows, splitters), WINDOW_KEYS)
    answers = folder.keep(keys.groupBy("bucket").applyInArrow(_sort_bucket, SHARED), "answers")
    bits = (
        answers.filter("chunk is not null")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("bucket", "shared")).alias("bits"))
    )
    edge = answers.filter("chunk is null").select("bucket", "last", "head", "key")
    low, high = edge.filter("last").drop("last"), edge.filter("not last").drop("last")
    both = (
        low.join(high.withColumn("bucket", F.col("bucket") - 1), ["bucket", "head", "key"])
        .select("head", "key")
        .distinct()
    )
    edges = [(r["head"], r["key"]) for r in both.collect()]  # fewer than there are buckets, twice
    cells = F.array(*[F.struct(F.lit(h).cast("long").alias("head"), F.lit(k).cast("long").alias("key")) for h, k in edges])
    none = F.lit(None).cast("array<struct<head:bigint,key:bigint>>")
    marked = (
        chunks.join(bits, "chunk", "left")
        .withColumn("edges", cells if edges else none)
        .mapInArrow(_mark(windows, splitters), RESULT)
    )
    return classes, marked
