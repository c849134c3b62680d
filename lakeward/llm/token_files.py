"""Token ids as wavelet-matrix shard files.

Documents are encoded in ascending id order and cut into shards of at most
about ``SHARD_TOKENS`` ids; every shard becomes one compressed file: a
directory of documents, then one bit-plane per bit of the largest id with the
counts of ones before every block.  From the file alone, ``WaveletMatrix``
answers access(i), count(id), rank(id, i) and occurrence(id, k).

A file is one row of a Parquet folder (part, seq, n_docs, n_tokens, file), so
it is written and read by Spark in any store it knows, committed atomically,
and rewritten by another executor if one is lost.  Rows with a null id come
first, a null or empty text has only its end id, equal ids keep the order of
their texts, and an empty table writes no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_library
from . import vectors as V
from .texts import partitions
from .tokens import Encoder, vocabulary_path, with_end

SHARD_TOKENS = 1 << 21
BLOCK_BITS = 512
_MAGIC = b"LKWM0001"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class WaveletMatrix:
    """Bit-planes of a sequence of ids, most significant bit first; each plane
    sorts the next stably by its bit (zeros before ones)."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        narrow = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for level in reversed(range(levels)):
            bits = narrow & narrow.dtype.type(1 << level) != 0
            plane = np.packbits(bits)
            plane = np.concatenate([plane, np.zeros(-len(plane) % (BLOCK_BITS // 8), np.uint8)])
            planes.append(plane)
            zeros.append(len(ids) - int(np.count_nonzero(bits)))
            ranks.append(cls._ranks(plane))
            narrow = np.concatenate([np.compress(~bits, narrow), np.compress(bits, narrow)])
        return cls(len(ids), planes, zeros, ranks)

    @staticmethod
    def _ranks(plane: np.ndarray) -> np.ndarray:
        per_block = _ONES[plane].reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.int64)
        return np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = divmod(i, BLOCK_BITS)
        at, bits = block * (BLOCK_BITS // 8), rest
        plane = self.planes[level]
        n = int(self.ranks[level][block]) + int(_ONES[plane[at : at + bits // 8]].sum())
        return n + (int(_ONES[plane[at + bits // 8] >> (8 - bits % 8)]) if bits % 8 else 0)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (7 - (i & 7))) & 1

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        lo, hi = 0, i
        top = len(self.planes) - 1
        if token >> (top + 1):
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (zeros + a, zeros + b) if token >> (top - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences among the first ``i`` ids."""
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) zero or one of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK_BITS - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        at = block * (BLOCK_BITS // 8)
        bits = np.unpackbits(self.planes[level][at : at + BLOCK_BITS // 8])
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def occurrence(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i, top = lo + k, len(self.planes) - 1
        for level in reversed(range(len(self.planes))):
            bit = token >> (top - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids in order, undoing the planes' sorting from the last one."""
        levels = len(self.planes)
        ids = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for level in reversed(range(levels)):
            bits = np.unpackbits(self.planes[level], count=self.n).view(bool)
            sorted_ids, ids, zeros = ids, np.empty_like(ids), self.zeros[level]
            ids[~bits] = sorted_ids[:zeros]
            ids[np.flatnonzero(bits)] = sorted_ids[zeros:] | ids.dtype.type(1 << (levels - 1 - level))
        return ids.astype(np.uint32)


def _packed(values: np.ndarray, level: int = 1) -> bytes:
    data = zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(values).tobytes())
    return struct.pack("<Q", len(data)) + data


def _unpacked(data: bytes, at: int, kind) -> tuple[np.ndarray, int]:
    (size,) = struct.unpack_from("<Q", data, at)
    raw = zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + size])
    return np.frombuffer(raw, kind), at + 8 + size


def to_file(ids: np.ndarray, doc_ids: np.ndarray, named: np.ndarray, sizes: np.ndarray) -> bytes:
    """One shard: its ids, and per document the id, whether it is not null,
    and the number of ids."""
    matrix = WaveletMatrix.of(ids)
    head = struct.pack("<8sQQI", _MAGIC, matrix.n, len(sizes), len(matrix.planes))
    steps = np.diff(doc_ids, prepend=doc_ids[:1] * 0)
    parts = [head, _packed(steps.astype(np.int64)), _packed(named.astype(np.uint8)), _packed(sizes.astype(np.uint32))]
    for plane, zeros, ranks in zip(matrix.planes, matrix.zeros, matrix.ranks, strict=True):
        parts += [struct.pack("<Q", zeros), _packed(plane), _packed(np.diff(ranks).astype(np.uint16))]
    return b"".join(parts)


def from_file(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """(matrix, document ids, not-null flags, sizes) of a shard file."""
    magic, n, _, levels = struct.unpack_from("<8sQQI", data)
    if magic != _MAGIC:
        raise ValueError("not a wavelet-matrix shard")
    at = struct.calcsize("<8sQQI")
    steps, at = _unpacked(data, at, np.int64)
    named, at = _unpacked(data, at, np.uint8)
    sizes, at = _unpacked(data, at, np.uint32)
    planes, zeros, ranks = [], [], []
    for _ in range(levels):
        zeros.append(struct.unpack_from("<Q", data, at)[0])
        plane, at = _unpacked(data, at + 8, np.uint8)
        counts, at = _unpacked(data, at, np.uint16)
        planes.append(plane)
        ranks.append(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.uint32))
    return WaveletMatrix(n, planes, zeros, ranks), np.cumsum(steps), named > 0, sizes.astype(np.int64)


FILE_SCHEMA = "part int, seq int, n_docs long, n_tokens long, file binary"


def _shards(path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            ids, docs, named, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            row = [part, seq, len(sizes), len(ids), to_file(ids, docs, named, sizes)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = ["part", "seq", "n_docs", "n_tokens", "file"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        encoder = Encoder.of(path)
        for batch in batches:
            ids_col, texts = batch.column(0), batch.column(1)
            for a, b, _, _ in V.blocks(texts, 1 << 21):
                ids, offsets = with_end(*encoder.encode(texts.slice(a, b - a)), end_id)
                docs = ids_col.slice(a, b - a)
                named = docs.is_valid().to_numpy(zero_copy_only=False)
                held.append((ids, docs.fill_null(0).to_numpy(), named, np.diff(offsets)))
                size += len(ids)
                if size >= shard_tokens:
                    yield flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode ``docs`` and write their shard files to the folder ``path``."""
    spark = docs.sparkSession
    ship_library(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # rows of one id (null, say) are ranged by text, equal rows by their place
    order = ["doc_id", "__text", "__place"]
    rows = rows.withColumn("__text", F.xxhash64("text")).withColumn("__place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    files = ordered.select("doc_id", "text").mapInArrow(_shards(vocabulary or vocabulary_path(), end_id, shard_tokens), FILE_SCHEMA)
    files.write.option("compression", "uncompressed").parquet(path)  # the files are compressed already


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seq, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            matrix, docs, named, sizes = from_file(data)
            ids = matrix.decode()
            ends = np.cumsum(sizes)
            cells = V.binary_array(ids, np.concatenate([[0], ends]))
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.full(n, seq, np.int32)),
                    pa.array(docs, mask=~named),
                    pa.array(ends - sizes),
                    pa.array(sizes),
                    pa.array([zlib.crc32(c.as_buffer()) for c in cells], pa.int64()),
                ],
                ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts ids over all files: totals per part are summed in one
    window over the parts (one row per range partition), then within each."""
    ship_library(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.select("part", "seq", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    starts = (
        sizes.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), none))
        .join(parts.withColumn("base", F.coalesce(F.sum("total").over(before), none)).drop("total"), "part")
        .select("part", "seq", (F.col("own") + F.col("base")).alias("base"))
    )
    kind = "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"
    found = files.select("part", "seq", "file").mapInArrow(_documents, kind)
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
