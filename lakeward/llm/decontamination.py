"""Benchmark decontamination by a broadcast set of normalised n-grams.

Benchmark items are cut into windows of ``n`` words (an item with fewer words
is one window).  Their hashes go to the tasks as a sorted set; tasks slide the
same windows over whole texts, look up the hashes and compare the words of each
hit with the item's before it counts.  A document word inside any occurrence of
a window is hit; a document is contaminated if at least a given share of its
words is.  Results remove the spans or the documents.

The set is sent only if the benchmark's texts have at most ``block_bytes``
bytes; a larger benchmark is dealt into blocks of about that size, and the
documents are read once per block, with the hits so far written in between.

Null and empty texts have no words and are never hit, nor are items without
words; a null item id is named by an empty string; repeated rows and items
count alike; an empty table or benchmark gives no hits.  All columns of the
documents are kept (a column named like one of the results is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_library
from . import vectors as V
from .texts import Folder

WINDOW = 13
BLOCK_BYTES = 16 << 20
#: Contaminated: 100 * hit words >= MIN_PERCENT * words, and at least one hit.
MIN_PERCENT = 5

#: Words are runs of digits, letters and all characters beyond ASCII.
TABLE = V.word_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_POLY = V.Polynomial(3)
_WORDS = V.Polynomial(4)
_FILTER_BITS = 20
_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)


@dataclass
class Grams:
    """Windows of one length: hashes in order, the words of each distinct
    window, and the items that hold it."""

    length: int
    hashes: np.ndarray
    texts: list[list[tuple[bytes, list[str]]]]
    filter: np.ndarray


def _prepared(data: np.ndarray, offsets: np.ndarray):
    low = V.lowered(data)
    starts, ends, bounds = V.words(low, offsets, TABLE)
    sums = _POLY.sums(V.word_hashes(low, starts, ends, _WORDS))
    return low.tobytes(), starts, ends, bounds, sums


def _joined(raw: bytes, starts, ends, at: int, length: int) -> bytes:
    return b" ".join(raw[a:b] for a, b in zip(starts[at : at + length], ends[at : at + length], strict=True))


def gram_sets(items: list[tuple[str, str]], n: int = WINDOW) -> list[Grams]:
    """The windows of (item id, text) pairs, by length."""
    found: dict[int, dict[int, dict[bytes, set[str]]]] = {}
    for _, _, data, offsets, names in _item_blocks(items):
        raw, starts, ends, bounds, sums = _prepared(data, offsets)
        for i, name in enumerate(names):
            count = int(bounds[i + 1] - bounds[i])
            if not count:
                continue
            length = min(n, count)
            at = np.arange(bounds[i], bounds[i + 1] - length + 1)
            hashes = _POLY.spans(sums, at, at + length)
            for p, h in zip(at.tolist(), hashes.tolist(), strict=True):
                same = found.setdefault(length, {}).setdefault(h, {})
                same.setdefault(_joined(raw, starts, ends, p, length), set()).add(name)
    sets = []
    for length, by_hash in sorted(found.items()):
        hashes = np.array(sorted(by_hash), V.U)
        flags = np.zeros(1 << _FILTER_BITS, bool)
        flags[(hashes >> V.U(64 - _FILTER_BITS)).astype(np.int64)] = True
        texts = [[(w, sorted(names)) for w, names in by_hash[h].items()] for h in hashes.tolist()]
        sets.append(Grams(length, hashes, texts, flags))
    return sets


def _item_blocks(items):
    column = pa.array([t for _, t in items], pa.large_string())
    for a, b, data, offsets in V.blocks(column):
        yield a, b, data, offsets, [items[i][0] for i in range(a, b)]


def _hits(data: np.ndarray, offsets: np.ndarray, sets: list[Grams]):
    """(words per text, flags of hit words, bounds, items per text, starts, ends)."""
    raw, starts, ends, bounds, sums = _prepared(data, offsets)
    hit = np.zeros(int(bounds[-1]), bool)
    items: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
    for grams in sets:
        at, rows = V.window_starts(bounds, grams.length)
        hashes = _POLY.spans(sums, at, at + grams.length)
        near = np.flatnonzero(grams.filter[(hashes >> V.U(64 - _FILTER_BITS)).astype(np.int64)])
        place = np.searchsorted(grams.hashes, hashes[near])
        place[place == len(grams.hashes)] = 0
        same = grams.hashes[place] == hashes[near]
        sure = []
        for p, row, k in zip(at[near[same]].tolist(), rows[near[same]].tolist(), place[same].tolist(), strict=True):
            words = _joined(raw, starts, ends, p, grams.length)
            for text, names in grams.texts[k]:
                if text == words:
                    sure.append(p)
                    items[row].update(names)
        if sure:
            hit |= V.covered(np.array(sure), grams.length, len(hit))
    return hit, bounds, items, starts, ends


_NEW = {"n_words": T.LongType(), "n_hit": T.LongType(), "hit_flags": T.BinaryType(), "items": T.ArrayType(T.StringType())}


def _mark(sets: list[Grams], text_index: int, earlier: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in V.blocks(batch.column(text_index)):
                rows = batch.slice(a, b - a)
                hit, bounds, items, _, _ = _hits(data, offsets, sets)
                flags = [np.packbits(hit[bounds[i] : bounds[i + 1]]).tobytes() for i in range(b - a)]
                if earlier:
                    old = rows.column("hit_flags").to_pylist()
                    flags = [
                        (np.frombuffer(x, np.uint8) | np.frombuffer(y, np.uint8)).tobytes()
                        for x, y in zip(flags, old, strict=True)
                    ]
                    items = [x | set(y) for x, y in zip(items, rows.column("items").to_pylist(), strict=True)]
                    rows = rows.select([n for n in rows.schema.names if n not in _NEW])
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns,
                        pa.array(np.diff(bounds)),
                        pa.array([int(_ONES[np.frombuffer(x, np.uint8)].sum()) for x in flags], pa.int64()),
                        pa.array(flags, pa.binary()),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    [*rows.schema.names, *_NEW],
                )

    return run


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_flags`` (a bit per word, first word in
    the highest bit) and ``items`` (ids of items with an occurring window)."""
    spark = docs.sparkSession
    ship_library(spark)
    docs = docs.drop(*[c for c in _NEW if c != text_col])
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.col(item_text_col).alias("text")
    ).dropna(subset=["text"])
    size = items.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    n_blocks = max(1, -(-size // block_bytes))
    folder = Folder(spark, "hits") if n_blocks > 1 else None
    schema = T.StructType([*docs.schema.fields, *[T.StructField(k, v) for k, v in _NEW.items()]])
    marked = docs
    for block in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block) if n_blocks > 1 else items
        sets = gram_sets([(r["id"], r["text"]) for r in part.collect()], n)  # about block_bytes
        at = marked.columns.index(text_col)
        marked = marked.mapInArrow(_mark(sets, at, block > 0), schema)
        if folder and block + 1 < n_blocks:
            marked = folder.keep(marked, f"block-{block}")
    return marked


def judged(hits: DataFrame, min_percent: int = MIN_PERCENT) -> DataFrame:
    """Hits with ``contaminated``."""
    rule = (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_percent * F.col("n_words"))
    return hits.withColumn("contaminated", rule)


def _without_spans(text_index: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in V.blocks(batch.column(text_index)):
                rows = batch.slice(a, b - a)
                starts, ends, bounds = V.words(V.lowered(data), offsets, TABLE)
                flags = rows.column("hit_flags").to_pylist()
                keep = np.ones(len(data), bool)
                for i, packed in enumerate(flags):
                    hit = np.unpackbits(np.frombuffer(packed, np.uint8), count=int(bounds[i + 1] - bounds[i]))
                    edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
                    own = bounds[i]
                    for p, q in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0), strict=True):
                        keep[starts[own + p] : ends[own + q - 1]] = False
                cuts = np.concatenate([[0], np.cumsum(keep)])[offsets]
                kept = V.binary_array(data[keep], cuts).cast(pa.string())
                kept = pc.if_else(rows.column(text_index).is_null(), rows.column(text_index), kept)
                yield rows.set_column(text_index, rows.schema.field(text_index).name, kept)

    return run


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``), or
    with the hit spans cut out of every text (``remove="spans"``)."""
    hits = find_hits(docs, benchmark, text_col=text_col, **options)
    if remove == "documents":
        return judged(hits).filter(~F.col("contaminated")).select(*docs.columns)
    if remove != "spans":
        raise ValueError("remove is documents or spans")
    at = hits.columns.index(text_col)
    return hits.mapInArrow(_without_spans(at), hits.schema).select(*docs.columns)
