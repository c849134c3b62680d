"""Substring dedup of bytes by range-partitioned, locally sorted suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  The strings are the heads of suffixes.  A thin sample of suffixes, at
positions that depend only on the bytes around them (the smallest hash of a
short string within each window), shows which texts can hold a repeat at all.
The suffixes of the windows around repeated samples then go through the suffix
sort: their leading tokens are hashes of the first half and of the whole head;
a bounded sample of keys gives splitters, chunks range-partition their suffixes
by them, every bucket sorts as multikey quicksort does (the second token is
compared only among equal first ones) and equal neighbours are repeats.  A key
equal to a splitter is shared between two buckets, so neighbouring buckets
compare their boundary keys.

A null text is empty and loses nothing, as does one shorter than ``length``.
Copies of a text (repeated rows as well) lose everything if they are long
enough; rows with a null id are documents like others; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_library
from . import vectors as V
from .repeats import _POLY, ByteUnits, repeated_spans
from .texts import keyed

LENGTH = 200
GRAM = 48
PLACE = V.U(40)


class SampledSuffixes(ByteUnits):
    """Windows of bytes; the sample is the least GRAM-byte string of each."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        if not 0 < gram < length:
            raise ValueError("gram must be shorter than a window")
        self.length, self.gram = length, gram

    def _least(self, values, bounds):
        """(window starts, position of the least gram in each, gram hashes)."""
        at, _ = V.window_starts(bounds, self.length)
        n = len(values) - self.gram + 1
        if not len(at):
            return at, at, np.zeros(0, V.U)
        where = np.arange(n)
        hashes = _POLY.spans(_POLY.sums(values), where, where + self.gram)
        # 24 bits of the hash, then the place: the leftmost of equal ones
        order = hashes >> PLACE << PLACE | where.astype(V.U)
        wide, span = self.length - self.gram + 1, 1
        while 2 * span <= wide:
            order = np.minimum(order[: len(order) - span], order[span:])
            span *= 2
        least = np.minimum(order[at], order[at + wide - span])
        return at, (least & ((V.U(1) << PLACE) - V.U(1))).astype(np.int64), hashes

    def anchors(self, values, bounds):
        at, least, hashes = self._least(values, bounds)
        chosen = np.unique(least)
        return chosen, hashes[chosen]

    def candidates(self, values, bounds, repeated):
        at, least, _ = self._least(values, bounds)
        return at[repeated[least]]


def byte_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(classes, marked) as ``repeats.repeated_spans`` gives them, in bytes."""
    return repeated_spans(docs, SampledSuffixes(length), id_col, text_col)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in V.blocks(batch.column(1)):
            raw = data.tobytes()
            shas = [hashlib.sha256(raw[offsets[i] : offsets[i + 1]]).hexdigest() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in (0, 2, 3)] + [pa.array(np.diff(offsets)), pa.array(shas)],
                ["doc_id", "x1", "x2", "n_bytes", "sha"],
            )


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans
    and the sha256 of the remaining bytes."""
    ship_library(docs.sparkSession)
    classes, marked = byte_repeats(docs, length)
    whole = (
        keyed(docs)
        .select("doc_id", "text", "x1", "x2")
        .mapInArrow(_whole, "doc_id long, x1 long, x2 long, n_bytes long, sha string")
    )
    partly = marked.filter("n_removed > 0").select(
        "x1", "x2", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha")
    )
    fate = classes.join(partly, ["x1", "x2"], "left").filter("copies > 1 or n_removed > 0")
    gone = (F.coalesce("copies", F.lit(1)) > 1) & (F.col("n_bytes") >= length)
    return whole.join(fate, ["x1", "x2"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept_sha", "sha"))
        .alias("kept_sha256"),
    )
