"""Best-fit packing with large-item matching.

Documents are encoded, closed by an end id, and cut into pieces only if longer
than a sequence.  Pieces above a third of the capacity fit at most twice per
sequence: going from the longest down, each is matched with the longest partner
that still fits.  Shorter pieces then go, longest first, where the smallest
sufficient gap is.

Packing runs in groups of pieces dealt by a hash of their place in the input,
about ``GROUP_BYTES`` of text and at most about ``GROUP_PIECES`` documents
each, so no task grows with the corpus, whatever ids and texts repeat; a group
of thousands of sequences leaves about one of them partly filled.  The ids travel with their piece, so
the result holds the sequences themselves.

A null or empty text is its end id alone, equal documents are packed one by
one, rows with a null id keep it, an empty table gives an empty result, and
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_library
from . import vectors as V
from .tokens import Encoder, vocabulary_path, with_end

CAPACITY = 2048
END_ID = 0
GROUP_BYTES = 8 << 20

#: Pieces of a group on average, however short.
GROUP_PIECES = 1 << 16

PACKED = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
PIECES = PACKED.replace("sequence_id long, offset long", "row long")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece; ``lengths`` in descending order.

    Bit k of ``free`` says that a large piece of length k waits; bit g of
    ``gaps`` that a sequence with a gap of g is open."""
    sequence = np.full(len(lengths), -1, np.int64)
    offset = np.zeros(len(lengths), np.int64)
    large = int(np.searchsorted(-3 * lengths, -capacity, "left"))
    waiting: dict[int, list[int]] = {}
    for i in range(large - 1, -1, -1):
        waiting.setdefault(int(lengths[i]), []).append(i)
    free = sum(1 << size for size in waiting)
    open_at: dict[int, list[int]] = {}
    gaps = used = 0

    def take(size: int) -> int:
        nonlocal free
        i = waiting[size].pop()
        if not waiting[size]:
            free &= ~(1 << size)
        return i

    def leave(gap: int, number: int) -> None:
        nonlocal gaps
        if gap:
            open_at.setdefault(gap, []).append(number)
            gaps |= 1 << gap

    while free:
        first = take(free.bit_length() - 1)
        size = int(lengths[first])
        sequence[first] = used
        fits = free & ((2 << (capacity - size)) - 1)
        if fits:
            second = take(fits.bit_length() - 1)
            sequence[second], offset[second] = used, size
            size += int(lengths[second])
        leave(capacity - size, used)
        used += 1
    for i in range(large, len(lengths)):
        size = int(lengths[i])
        fits = gaps >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            number = open_at[gap].pop()
            if not open_at[gap]:
                gaps &= ~(1 << gap)
        else:
            gap, number, used = capacity, used, used + 1
        sequence[i], offset[i] = number, capacity - gap
        leave(gap - size, number)
    return sequence, offset


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder.of(path)
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b, _, _ in V.blocks(batch.column(1), 1 << 21):
                ids, offsets = with_end(*encoder.encode(batch.column(1).slice(a, b - a)), end_id)
                counts = -(-np.diff(offsets) // capacity)
                rows = np.repeat(np.arange(b - a), counts)
                number = V.ranges(np.zeros(b - a, np.int64), counts)
                begin = offsets[rows] + number * capacity
                end = np.minimum(begin + capacity, offsets[rows + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(rows)),
                        pa.array(number.astype(np.int32)),
                        pa.array(number * capacity),
                        pa.array(end - begin),
                        V.binary_array(ids, np.concatenate([begin[:1], end])),
                        pa.array(made + np.arange(len(rows))),
                    ],
                    ["doc_id", "piece", "start", "length", "ids", "row"],
                )
                made += len(rows)

    return run


def _pack(capacity: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = int(key[0].as_py())
        order = pc.sort_indices(table, [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        table = table.drop_columns(["dealt", "row"]).take(order)
        sequence, offset = best_fit(table.column("length").to_numpy(), capacity)
        return table.append_column("sequence_id", pa.array(sequence + (group << 32))).append_column(
            "offset", pa.array(offset)
        )

    return run


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_bytes: int = GROUP_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces with their ids (unsigned 32 bits, little-endian), sequence and
    place in it."""
    ship_library(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    groups = max(1, round((size["n"] or 0) / group_bytes), -(-size["rows"] // GROUP_PIECES))
    # by place: rows with one id, or with one text, go to all groups
    dealt = F.pmod(F.xxhash64("row"), F.lit(groups))
    pieces = rows.mapInArrow(_pieces(vocabulary or vocabulary_path(), end_id, capacity), PIECES)
    return pieces.withColumn("dealt", dealt).groupBy("dealt").applyInArrow(_pack(capacity), PACKED)


def piece_digests(packed: DataFrame) -> DataFrame:
    """``packed`` with the crc32 of each piece's ids in place of the ids."""
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
