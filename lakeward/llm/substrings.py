"""Substring dedup of word passages by difference-cover anchors.

Windows of ``length`` words are found again by hashing short windows only at
the positions whose remainder modulo ``PERIOD`` is in a difference cover.  Any
difference of two remainders is a difference of two cover elements, so two
equal windows, wherever they start, hold an equal anchor at the same place
within their first ``PERIOD`` words; from such anchors the match is extended to
whole windows (``repeats``), and every word of a repeated window goes.

Nulls and empty texts have no words and lose nothing; so do texts shorter than
a window.  Repeated rows and other copies of a text are repeats of each other
and lose all words if they have a window; rows with a null id are documents
like others; an empty table gives an empty result; other columns are kept by
``without_repeats`` and ignored by ``word_repeats``.
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
from .repeats import _POLY, WordUnits, repeated_spans
from .texts import keyed, text_key

LENGTH = 35
PERIOD = 21
#: Every remainder of 21 is a difference of two of these (fixed values).
COVER = (0, 1, 4, 14, 16)


class CoverWords(WordUnits):
    """Windows of words with anchors at the cover's positions."""

    def __init__(self, length: int = LENGTH):
        if length < PERIOD + 2:
            raise ValueError(f"a window needs at least {PERIOD + 2} words")
        self.length = length
        self.anchor = length - PERIOD + 1

    def anchors(self, values, bounds):
        counts = np.diff(bounds)
        at, rows = V.window_starts(bounds, self.anchor)
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        chosen = cover[(at - bounds[rows]) % PERIOD] & (counts[rows] >= self.length)
        at = at[chosen]
        return at, _POLY.spans(_POLY.sums(values), at, at + self.anchor)

    def candidates(self, values, bounds, repeated):
        at, _ = V.window_starts(bounds, self.length)
        # a window may hold the anchor at any of its first PERIOD positions
        found = np.concatenate([[0], np.cumsum(repeated)])
        return at[found[np.minimum(at + PERIOD, len(repeated))] > found[at]]


def word_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(classes, marked) as ``repeats.repeated_spans`` gives them, in words."""
    return repeated_spans(docs, CoverWords(length), id_col, text_col)


def without_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated passage cut out of ``text_col``: the bytes
    from its first to its last word, so the white space around it stays.  All
    other columns and rows, and texts without repeats, are left as they are."""
    classes, marked = word_repeats(docs, length, docs.columns[0], text_col)
    n_words = F.size(F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    changed = marked.filter("n_removed > 0").select("x1", "x2", F.col("kept").cast("string").alias("kept"))
    fate = classes.join(changed, ["x1", "x2"], "left").filter("copies > 1 or kept is not null")
    fate = fate.select(F.struct("copies", "kept").alias("__fate"), F.struct("x1", "x2").alias("__key"))
    cut = F.when((F.col("__fate.copies") > 1) & (n_words >= length), F.lit("")).otherwise(
        F.coalesce("__fate.kept", F.col(text_col))
    )
    x1, x2 = text_key(text_col)
    rows = docs.withColumn("__key", F.struct(x1.alias("x1"), x2.alias("x2"))).join(fate, "__key", "left")
    return rows.withColumn(text_col, cut).select(*docs.columns)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, x1, x2, n_words, sha256 of all words joined by one space)."""
    for batch in batches:
        for a, b, data, offsets in V.blocks(batch.column(1)):
            _, _, bounds = V.words(data, offsets)
            raw = data.tobytes()
            shas = [
                hashlib.sha256(b" ".join(raw[offsets[i] : offsets[i + 1]].split())).hexdigest() for i in range(b - a)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in (0, 2, 3)] + [pa.array(np.diff(bounds)), pa.array(shas)],
                ["doc_id", "x1", "x2", "n_words", "sha"],
            )


def _kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shas = [hashlib.sha256(b" ".join(x.split())).hexdigest() for x in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(shas)], ["x1", "x2", "n_removed", "kept_sha"])


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed and the
    sha256 of the kept words joined by one space."""
    ship_library(docs.sparkSession)
    classes, marked = word_repeats(docs, length)
    whole = (
        keyed(docs)
        .select("doc_id", "text", "x1", "x2")
        .mapInArrow(_whole, "doc_id long, x1 long, x2 long, n_words long, sha string")
    )
    partly = marked.filter("n_removed > 0").select("x1", "x2", "n_removed", "kept")
    partly = partly.mapInArrow(_kept_words, "x1 long, x2 long, n_removed long, kept_sha string")
    fate = classes.join(partly, ["x1", "x2"], "left").filter("copies > 1 or n_removed > 0")
    gone = (F.coalesce("copies", F.lit(1)) > 1) & (F.col("n_words") >= length)
    return whole.join(fate, ["x1", "x2"], "left").select(
        "doc_id",
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept_sha", "sha"))
        .alias("kept_sha256"),
    )
