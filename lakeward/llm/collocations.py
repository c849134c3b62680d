"""Collocations by counting quotient filters.

1. A task cuts its texts into shards, blocks of one language and about
   ``SHARD_BYTES`` bytes, each with its distinct words, their counts, and the
   words' numbers in order of the text.  Shards are written to the shared
   folder.
2. Spark counts words over all shards; a phrase counted ``least`` times or more
   has only words that are, so only those get word ids, dense in each hash
   bucket.  The ids go back to the shards that hold the words: no dictionary is
   broadcast.
3. Of each shard, the phrases of two to four ids are packed and permuted by an
   invertible Feistel network.  A shard's phrases, sorted, make one counting
   quotient filter for every range of permuted keys: one bit per quotient (is it
   occupied), one bit per entry (does it end its quotient's run), the full
   remainder and a count of a byte, larger ones in a list.  Nothing is lost:
   quotient and remainder give the ids back.
4. The filters of a range, one per shard, are merged as sorted runs; phrases
   below ``least`` go.  Ranges are even as the permutation scatters the keys, a
   frequent phrase is one entry per shard, and their number follows the number
   of words.
5. The remaining phrases, which are few, are scored and compared with the
   longer ones that hold them by joins.

A null or empty text has no words, a null language is ``und``, repeated rows
count each for itself, texts of any length are counted whole (a longer one than
a shard makes a shard of its own), an empty table gives an empty result and
other columns are ignored.  Equal scores are ordered by count, then phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_library
from . import vectors as V
from .texts import Folder, partitions

#: Characters that end a piece, and those that part words inside one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_GAPS = b" \t"
LONGEST = 4
LEAST = 30
TOP = 2000
SHARD_BYTES = 6 << 20
#: Phrase occurrences per range of keys.
RANGE_ENTRIES = 1_000_000

SHARDS = "shard long, lang string, words array<string>, counts array<long>, numbers binary, opens binary"
FILTERS = "size int, part int, filter binary"
PHRASES = "ids array<long>, f long"
U = np.uint64


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def _mixed(x: np.ndarray, key: int, bits: int) -> np.ndarray:
    return V.mix64(x + U(0x9E3779B97F4A7C15 * (key + 1) & (1 << 64) - 1)) & _mask(bits)


class Permutation:
    """Invertible map of phrases of ``size`` ids of ``bits`` bits each to keys
    of two lanes; unequal Feistel rounds."""

    rounds = 4

    def __init__(self, size: int, bits: int):
        if bits > 32:
            raise ValueError("word ids have at most 32 bits")
        self.size, self.bits = size, bits
        self.left = size // 2 * bits
        self.right = size * bits - self.left

    def keys(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        half, shift = self.size // 2, U(self.bits)
        left, right = ids[0].astype(U), ids[half].astype(U)
        for x in ids[1:half]:
            left = left << shift | x.astype(U)
        for x in ids[half + 1 :]:
            right = right << shift | x.astype(U)
        for k in range(self.rounds):
            left = left ^ _mixed(right, 2 * k, self.left)
            right = right ^ _mixed(left, 2 * k + 1, self.right)
        return left, right

    def ids(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        for k in reversed(range(self.rounds)):
            right = right ^ _mixed(left, 2 * k + 1, self.right)
            left = left ^ _mixed(right, 2 * k, self.left)
        half, mask = self.size // 2, _mask(self.bits)
        out = [left >> U(self.bits * (half - 1 - i)) & mask for i in range(half)]
        rest = self.size - half
        return [*out, *(right >> U(self.bits * (rest - 1 - i)) & mask for i in range(rest))]


def counted(left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None, right_bits: int = 64):
    """Sorted distinct keys with their summed counts."""
    n = len(left)
    if not n:
        return left, right, np.zeros(0, np.int64)
    left_bits = int(left.max()).bit_length()
    if left_bits + right_bits <= 64:
        both = left << U(right_bits) | right
        if counts is None:
            both = np.sort(both)
        else:
            order = np.argsort(both, kind="stable")
            both, counts = both[order], counts[order]
        new = np.concatenate([[True], both[1:] != both[:-1]])
        first = np.flatnonzero(new)
        left, right = both[first] >> U(right_bits), both[first] & _mask(right_bits)
    else:
        # 64 bits decide all but keys that agree in them, which then differ only by chance
        spare = 64 - left_bits
        lead = left << U(spare) | right >> U(right_bits - spare)
        order = np.argsort(lead, kind="stable")
        same = lead[order[1:]] == lead[order[:-1]]
        if (right[order[1:]][same] != right[order[:-1]][same]).any():
            order = np.lexsort((right, left))
        left, right = left[order], right[order]
        counts = None if counts is None else counts[order]
        first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
        left, right = left[first], right[first]
    if counts is None:
        return left, right, np.diff(np.concatenate([first, [n]]))
    return left, right, np.add.reduceat(counts, first)


class QuotientFilter:
    """Sorted keys of one range: left lanes ``low`` <= x < ``high``."""

    def __init__(self, permutation: Permutation, low: int, high: int):
        self.p, self.low = permutation, low
        self.span = max(1, (high - low - 1).bit_length())

    def _layout(self, n: int) -> tuple[int, int, int]:
        """Quotient bits, remainder bytes of the left and of the right lane."""
        q = min(self.span, max(1, n.bit_length()))
        return q, -(-(self.span - q) // 8), -(-self.p.right // 8)

    def pack(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
        n = len(left)
        q, left_bytes, right_bytes = self._layout(n)
        rest = U(self.span - q)
        offset = left - U(self.low)
        quotient = (offset >> rest).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        ends = np.ones(n, bool)
        ends[:-1] = quotient[1:] != quotient[:-1]
        columns = [
            (offset & _mask(int(rest))).astype("<u8").view(np.uint8).reshape(n, 8)[:, :left_bytes],
            right.astype("<u8").view(np.uint8).reshape(n, 8)[:, :right_bytes],
        ]
        large = counts >= 255
        head = np.array([n, int(large.sum())], "<u4").tobytes()
        return b"".join(
            [
                head,
                np.packbits(occupied).tobytes(),
                np.packbits(ends).tobytes(),
                # column by column, which compresses better
                *(np.ascontiguousarray(c.T).tobytes() for c in columns),
                np.minimum(counts, 255).astype(np.uint8).tobytes(),
                counts[large].astype("<i8").tobytes(),
            ]
        )

    def unpack(self, raw: memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        n, n_large = (int(x) for x in take("<u4", 2))
        q, left_bytes, right_bytes = self._layout(n)
        occupied = np.flatnonzero(np.unpackbits(take("u1", -(-(1 << q) // 8)), count=1 << q))
        ends = np.unpackbits(take("u1", -(-n // 8)), count=n).astype(np.int64)
        run = np.cumsum(ends) - ends
        lanes = []
        for width in (left_bytes, right_bytes):
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :width] = take("u1", n * width).reshape(width, n).T
            lanes.append(wide.view("<u8").reshape(n).astype(U))
        counts = take("u1", n).astype(np.int64)
        counts[counts == 255] = take("<i8", n_large)
        left = (occupied[run].astype(U) << U(self.span - q) | lanes[0]) + U(self.low)
        return left, lanes[1], counts


def range_bounds(permutation: Permutation, parts: int) -> list[int]:
    """Limits of ``parts`` even ranges of the left lane."""
    return [(k << permutation.left) // parts for k in range(parts + 1)]


def _shards(shard_bytes: int):
    ends = V.word_table(PIECE_ENDS)
    inside = V.word_table(PIECE_ENDS + WORD_GAPS)

    def shard(number: int, lang: str, texts: list[pa.Array]) -> pa.RecordBatch:
        data, offsets = V.text_buffer(pa.concat_arrays(texts))
        data = V.lowered(data)
        starts, stops, _ = V.words(data, offsets, inside)
        sizes = stops - starts
        flat = data[V.ranges(starts, sizes)]
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        words = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(flat))]
        ).dictionary_encode()
        numbers = words.indices.to_numpy()
        # a word opens a piece if a piece ends, or a document begins, since the last word
        ended = np.concatenate([[0], np.cumsum(~ends[data])])
        opens = np.ones(len(starts), bool)
        document = np.searchsorted(offsets, starts, "right")
        opens[1:] = (ended[starts[1:]] != ended[stops[:-1]]) | (document[1:] != document[:-1])
        counts = np.bincount(numbers, minlength=len(words.dictionary))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]),
                pa.array([lang]),
                pa.ListArray.from_arrays(
                    pa.array([0, len(counts)], pa.int32()), words.dictionary.cast(pa.string())
                ),
                pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts, pa.int64())),
                pa.array([numbers.astype("<u4").tobytes()]),
                pa.array([np.packbits(opens).tobytes()]),
            ],
            [c.split()[0] for c in SHARDS.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[str, tuple[list[pa.Array], int]] = {}
        for batch in batches:
            langs = batch.column(0).cast(pa.string()).fill_null("und").dictionary_encode()
            texts = V.rebased(batch.column(1))
            sizes = np.diff(V.text_buffer(texts)[1])
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                rows = np.flatnonzero(langs.indices.to_numpy() == k)
                total = np.cumsum(sizes[rows])
                # runs of rows of about a quarter of a shard, added to what is held
                step = np.flatnonzero(np.diff(total // (shard_bytes // 4 + 1), prepend=0)) if len(rows) else []
                for part in np.split(rows, step):
                    if not len(part):
                        continue
                    kept, size = held.get(lang, ([], 0))
                    more = int(sizes[part].sum())
                    if kept and size + more > shard_bytes:
                        yield shard(number, lang, kept)
                        number, kept, size = number + 1, [], 0
                    held[lang] = ([*kept, texts.take(pa.array(part))], size + more)
            if sum(size for _, size in held.values()) > 2 * shard_bytes:
                # many languages: what is held stays bounded
                for lang in sorted(held, key=lambda x: -held[x][1]):
                    yield shard(number, lang, held.pop(lang)[0])
                    number += 1
                    if sum(size for _, size in held.values()) <= shard_bytes:
                        break
        for lang, (kept, _) in held.items():
            yield shard(number, lang, kept)
            number += 1

    return run


def _filters(bits: int, parts: dict[int, int]):
    layouts = {}
    for size, n in parts.items():
        p = Permutation(size, bits)
        layouts[size] = (p, range_bounds(p, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                numbers = np.frombuffer(batch.column("numbers")[i].as_buffer(), "<u4")
                opens = np.unpackbits(np.frombuffer(batch.column("opens")[i].as_buffer(), np.uint8), count=len(numbers))
                known = batch.column("known")[i].values
                ids = np.full(int(numbers.max()) + 1 if len(numbers) else 0, -1, np.int64)
                ids[known.field("number").to_numpy()] = known.field("id").to_numpy()
                ids = ids[numbers]
                piece = np.cumsum(opens, dtype=np.int64)
                good = ids >= 0
                for size, (p, bounds) in layouts.items():
                    if len(ids) < size:
                        continue
                    n = len(ids) - size + 1
                    at = piece[:n] == piece[size - 1 :]
                    for k in range(size):
                        at &= good[k : k + n]
                    at = np.flatnonzero(at)
                    left, right, counts = counted(*p.keys([ids[at + k] for k in range(size)]), None, p.right)
                    cuts = np.searchsorted(left, np.array(bounds[1:-1], U))
                    cuts = [0, *cuts.tolist(), len(left)]
                    made = [
                        (part, QuotientFilter(p, bounds[part], bounds[part + 1]).pack(left[a:b], right[a:b], counts[a:b]))
                        for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                        if b > a
                    ]
                    if made:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([size] * len(made), pa.int32()),
                                pa.array([m[0] for m in made], pa.int32()),
                                pa.array([m[1] for m in made]),
                            ],
                            ["size", "part", "filter"],
                        )

    return run


def _merge(bits: int, parts: dict[int, int], least: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, part = key[0].as_py(), key[1].as_py()
        p = Permutation(size, bits)
        bounds = range_bounds(p, parts[size])
        filters = QuotientFilter(p, bounds[part], bounds[part + 1])
        held, entries = [], 0
        for batch in batches:
            for cell in batch.column("filter"):
                run_ = filters.unpack(memoryview(cell.as_buffer()))
                held.append(run_)
                entries += len(run_[0])
                if entries > RANGE_ENTRIES and entries > 2 * len(held[0][0]):
                    held = [_merged(held, p)]
                    entries = len(held[0][0])
        left, right, counts = _merged(held, p)
        often = np.flatnonzero(counts >= least)
        if len(often):
            ids = np.stack(p.ids(left[often], right[often]), 1).astype(np.int64)
            offsets = np.arange(0, ids.size + 1, size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.ravel())), pa.array(counts[often])],
                ["ids", "f"],
            )

    return run


def _merged(runs: list, p: Permutation):
    """Sorted runs as one: the stable sort merges runs that are sorted."""
    if len(runs) == 1:
        return runs[0]
    left, right, counts = (np.concatenate([r[k] for r in runs]) for k in range(3))
    return counted(left, right, counts, p.right)


class Counted:
    """Counts of a corpus: ``words`` (lang, word, id, f) of all frequent words,
    ``totals`` (lang, n), ``phrases`` (lang, phrase, words, f) of one to
    ``LONGEST`` words, all counted ``least`` times or more."""

    def __init__(self, words: DataFrame, totals: DataFrame, phrases: DataFrame):
        self.words, self.totals, self.phrases = words, totals, phrases


def count_phrases(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    shard_bytes: int = SHARD_BYTES,
    lang_col: str = "lang",
    text_col: str = "text",
) -> Counted:
    """Exact counts of all words and phrases that occur ``least`` times."""
    spark = docs.sparkSession
    ship_library(spark)
    folder = Folder(spark, "phrases")
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    shards = folder.keep(rows.mapInArrow(_shards(shard_bytes), SHARDS), "shards")

    entries = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "shard", "lang", F.col("pos").alias("number"), "col.words", "col.counts"
    )
    by_word = entries.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f"))
    buckets = partitions(spark)
    numbered = (
        by_word.filter(F.col("f") >= least)
        .withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(buckets)))
        .withColumn("id", (F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word")) - 1) * buckets)
        .select("lang", "word", (F.col("id") + F.col("bucket")).alias("id"), "f")
    )
    words = folder.keep(numbered, "words")
    sizes = entries.groupBy("lang").agg(F.sum("counts").alias("n"))
    totals = folder.keep(sizes, "totals")

    summary = words.agg(F.max("id").alias("top")).first()["top"]
    occurrences = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    ones = words.select("lang", F.array("id").alias("ids"), F.col("word").alias("phrase"), F.array("word").alias("words"), "f")
    if summary is None or longest < 2:
        return Counted(words, totals, ones.select("lang", "phrase", "words", "f"))
    bits = max(1, int(summary).bit_length())
    parts = {
        size: min(1 << min(30, size // 2 * bits), max(1, -(-occurrences // RANGE_ENTRIES)))
        for size in range(2, longest + 1)
    }
    known = (
        entries.select("shard", "number", "lang", F.col("words").alias("word"))
        .join(words.select("lang", "word", "id"), ["lang", "word"])
        .groupBy("shard")
        .agg(F.collect_list(F.struct("number", "id")).alias("known"))
    )
    filters = shards.select("shard", "numbers", "opens").join(known, "shard").mapInArrow(_filters(bits, parts), FILTERS)
    merged = filters.groupBy("size", "part").applyInArrow(_merge(bits, parts, least), PHRASES)
    merged = folder.keep(merged, "merged")

    # ids back to words
    named = merged.select("ids", "f", F.posexplode("ids").alias("pos", "id"))
    spelled = (
        named.join(words.select("id", "lang", "word"), "id")
        .groupBy("ids")
        .agg(
            F.first("f").alias("f"),
            F.first("lang").alias("lang"),
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]).alias("words"),
        )
        .select("lang", F.array_join("words", " ").alias("phrase"), "words", "f")
    )
    phrases = spelled.unionByName(ones.select("lang", "phrase", "words", "f"))
    return Counted(words, totals, folder.keep(phrases, "counted"))


def scored(counts: Counted) -> DataFrame:
    """Phrases of two words and more with the cut that scores lowest: (lang,
    phrase, words, a, k, l, r, score)."""
    size = F.size("words")
    parts = counts.phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = (
        counts.phrases.filter(size > 1)
        .select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
        .select(
            "*",
            F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
            F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("rest"),
        )
    )
    left = parts.select("lang", F.col("part").alias("first"), F.col("part_f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("part_f").alias("r"))
    # decimals, as products may pass 64 bits
    score = F.expr("(CAST(2000000 AS DECIMAL(8,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    cut = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score.cast("long"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "cut.*")


def inside_longer(counts: Counted) -> DataFrame:
    """(lang, phrase, longer): the highest count of a longer phrase that holds
    a phrase of two words or more."""
    size = F.size("words")
    longer = counts.phrases.filter(size > 2).select("lang", "words", "f", size.alias("n"))
    starts = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("k"))
    pieces = starts.select("*", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("k") + 1)).alias("at"))
    phrase = F.array_join(F.slice("words", F.col("at"), F.col("k")), " ")
    return pieces.groupBy("lang", phrase.alias("phrase")).agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = count_phrases(docs, least, **options)
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * 80
    own = scored(counts).join(inside_longer(counts), ["lang", "phrase"], "left")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = (
        own.filter(F.col("longer").isNull() | ~covered)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .filter(F.col("rank") <= top)
    )
    return ranked.join(counts.totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
