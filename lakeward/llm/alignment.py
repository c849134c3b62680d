"""Alignment of two tokenizers through inverted pair bitmaps.

Both tokenizers encode a space and the text; token A and token B of a document
are linked if their byte ranges overlap, and byte offsets where tokens of both
end cut the document into groups.

Documents are numbered inside containers, runs of at most ``CONTAINER_DOCS``
documents and about ``CONTAINER_BYTES`` of text that one task reads.  A
container holds, for each pair of ids (A, B), the bitmap of its documents that
link the pair, as bit planes of the number of links: plane k has the documents
whose number of links has bit k set.  Planes are stored as gaps of a byte each
(wider ones in a list of their own).  A container is built block by block; the
blocks' bitmaps are OR-merged by pair.  As containers number different
documents, the merged bitmap of a pair is the list of its containers: its
population count gives the document count, the planes' counts times 2**k the
link count, and both are sums over containers, partly aggregated before the
shuffle.  Scores of pairs then go back along the postings: to each container
that lists the pair, and from its planes to the documents.  Only (container,
pair, counts) rows are shuffled by pair; a container's planes move once, to its
scores.  Containers are written to the shared folder, so a lost executor costs
a re-read of them.

Neither vocabulary joins what precedes a space or line feed with it, so tokens
of a text are those of its segments, cut before a space or line feed that
follows a visible character.  A worker aligns each distinct segment once.

A null or empty text, and one whose tokens do not spell it byte for byte (it
holds U+2581, the second vocabulary's space), has no tokens: its counts are 0
and its ``groups_sha256`` is ''.  Repeated rows count each for itself and equal
texts get equal results; a null id stays null, an empty table gives an empty
result, texts of any length are aligned whole and other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_library
from . import vectors as V
from .texts import Folder
from .tokens import _byte_letters, vocabulary_path

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: A container ends at either.
CONTAINER_DOCS = 1 << 16
CONTAINER_BYTES = 16 << 20
BLOCK_BYTES = 2 << 20
#: Distinct segments that a Python worker remembers before it starts afresh,
#: and the bytes of the longest one that it does.
MAX_KNOWN = 1 << 19
LONG_SEGMENT = 64

CONTAINERS = (
    "container long, planes binary, pairs array<long>, docs array<long>, links array<long>, doc_ids array<long>, "
    "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>"
)
SCORED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def segment_cuts(data: np.ndarray) -> np.ndarray:
    """Positions of a space or line feed after a character that surely is no
    white space; Unicode's wider spaces start with C2 or E1 to E3."""
    if len(data) < 4:
        return np.flatnonzero((data[1:] == 32) & (data[:-1] > 32) & (data[:-1] < 127)) + 1
    here = (data == 32) | (data == 10)
    before = np.zeros(len(data), bool)
    one, two, three = data[2:-1], data[1:-2], data[:-3]
    before[3:] = ((one > 32) & (one < 127)) | ((one >= 128) & (two != 0xC2) & ((three < 0xE1) | (three > 0xE3)))
    before[1:3] = (data[:2] > 32) & (data[:2] < 127)
    return np.flatnonzero(here & before)


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _ends_visibly(segment: bytes) -> bool:
    """Whether a following segment is cut off from this one, by the rule of
    ``segment_cuts``."""
    tail = segment[-3:]
    if tail[-1] < 128:
        return 32 < tail[-1] < 127
    return len(tail) > 2 and tail[1] != 0xC2 and not 0xE1 <= tail[0] <= 0xE3


class _Tokens:
    """Ids of a string and the bytes of each id."""

    def spell(self, ids: np.ndarray) -> np.ndarray:
        starts = self.offsets[ids]
        return self.bytes[V.ranges(starts, self.offsets[ids + 1] - starts)]

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.offsets[ids + 1] - self.offsets[ids]


class ByteLevel(_Tokens):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        size = self.library.get_vocab_size()
        back = {letter: byte for byte, letter in _byte_letters().items()}
        special = self.library.get_added_tokens_decoder()
        names = [self.library.id_to_token(i) or "" for i in range(size)]
        self.bytes, self.offsets = _flat(
            [n.encode() if i in special else bytes(back[c] for c in n) for i, n in enumerate(names)]
        )

    def encode(self, segments: list[bytes]) -> list[np.ndarray]:
        """Ids of runs of segments.  After a segment that ends visibly the next
        one is cut off anyway, so up to 128 of them go to the library as one
        text."""
        out, run = [], []
        for s in segments:
            run.append(s)
            if len(run) == 128 or not _ends_visibly(s):
                out.append(self._ids(run))
                run = []
        return [*out, self._ids(run)] if run else out

    def _ids(self, run: list[bytes]) -> np.ndarray:
        return np.asarray(self.library.encode(b"".join(run).decode(), add_special_tokens=False).ids, np.int64)


class Pieces(_Tokens):
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled = []
        for i in range(self.library.get_piece_size()):
            name = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                spelled.append(bytes([int(name[3:5], 16)]))
            else:
                spelled.append(name.replace("▁", " ").encode())
                if " " in spelled[-1].decode().lstrip(" ") or "\n" in name:
                    raise ValueError(f"the vocabulary joins words across white space: {name!r}")
        self.bytes, self.offsets = _flat(spelled)
        self.mark = len(self.library.encode("a"))

    def encode(self, segments: list[bytes]) -> list[np.ndarray]:
        """Ids of the segments, in order.  The library adds a space before a text; here
        it stands before a letter whose tokens are left out again."""
        found = self.library.encode(["a" + s.decode() for s in segments], num_threads=1)
        return [np.fromiter(chain.from_iterable(ids[self.mark :] for ids in found), np.int64)]


def _grown(a: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    if used + len(more) > len(a):
        a = np.concatenate([a, np.zeros(max(len(a), used + len(more) - len(a)), a.dtype)])
    a[used : used + len(more)] = more
    return a


class Ragged:
    """Rows of different lengths in one array that grows."""

    def __init__(self, dtype):
        self.values, self.offsets, self.rows = np.zeros(1 << 16, dtype), np.zeros(1 << 12, np.int64), 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.offsets[self.rows])
        self.values = _grown(self.values, used, values)
        self.offsets = _grown(self.offsets, self.rows + 1, used + np.cumsum(sizes))
        self.rows += len(sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the rows one after the other, their sizes)"""
        starts = self.offsets[rows]
        sizes = self.offsets[rows + 1] - starts
        return self.values[V.ranges(starts, sizes)], sizes


class Aligner:
    """Aligns segments; one per pair of vocabularies and Python worker."""

    _kept: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.shift = int(len(self.b.offsets) - 1).bit_length()
        self._forget()

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in cls._kept:
            cls._kept[path_a, path_b] = cls(path_a, path_b)
        return cls._kept[path_a, path_b]

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.links, self.groups = Ragged(np.int64), Ragged(np.uint8)
        self.counts = np.zeros((1 << 12, 4), np.int64)  # A tokens, B tokens, groups, spelled

    def _learn(self, segments: list[bytes]) -> None:
        """Align new segments and remember the result."""
        raw = np.frombuffer(b"".join(segments), np.uint8)
        ids = [np.concatenate(v.encode(segments)) for v in (self.a, self.b)]
        good = np.ones(len(segments), bool)
        if not all(np.array_equal(v.spell(i), raw) for v, i in zip((self.a, self.b), ids, strict=True)):
            # of a segment that is not spelled nothing counts
            each = [[np.concatenate(v.encode([s])) for v in (self.a, self.b)] for s in segments]
            for k, (s, found) in enumerate(zip(segments, each, strict=True)):
                good[k] = all(v.spell(i).tobytes() == s for v, i in zip((self.a, self.b), found, strict=True))
            ids = [
                np.concatenate([np.zeros(0, np.int64), *(x[side] for x, g in zip(each, good, strict=True) if g)])
                for side in (0, 1)
            ]
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        self._remember(segments, good, np.where(good, sizes, 0), *ids)

    def _remember(self, segments, good, sizes, ids_a, ids_b) -> None:
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ends_a, ends_b = np.cumsum(self.a.sizes(ids_a)), np.cumsum(self.b.sizes(ids_b))
        starts_a = ends_a - self.a.sizes(ids_a)
        starts_b = ends_b - self.b.sizes(ids_b)
        first = np.searchsorted(ends_b, starts_a, "right")
        last = np.searchsorted(starts_b, ends_a, "left")
        links = (np.repeat(ids_a, last - first) << self.shift) | ids_b[V.ranges(first, last - first)]
        of_a = np.searchsorted(bounds, ends_a, "left") - 1
        of_b = np.searchsorted(bounds, ends_b, "left") - 1
        n = len(segments)
        n_links = np.bincount(of_a, weights=last - first, minlength=n).astype(np.int64)
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.bincount(np.searchsorted(bounds, cuts, "left") - 1, minlength=n)
        # "a1,a2|b1;" group by group: A before B, each token with what follows it
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        side = np.concatenate([np.zeros(len(ids_a), np.int64), np.ones(len(ids_b), np.int64)])[order]
        closes = np.concatenate([np.isin(ends_a, cuts), np.isin(ends_b, cuts)])[order]
        digits = pc.cast(pa.array(np.concatenate([ids_a, ids_b])[order]), pa.large_string())
        after = pa.array([",", "|", ";"], pa.large_string()).take(pa.array(np.where(closes, 1 + side, 0)))
        shown = pc.binary_join_element_wise(digits, after, _text(""))
        raw, offsets = V.text_buffer(shown)
        lengths = np.bincount(np.concatenate([of_a, of_b])[order], weights=np.diff(offsets), minlength=n).astype(np.int64)
        base = len(self.known)
        self.links.extend(links, n_links)
        self.groups.extend(raw, lengths)
        rows = np.stack([np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n), n_groups, good], 1)
        if base + n > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros((max(len(self.counts), n), 4), np.int64)])
        self.counts[base : base + n] = rows
        self.known.update(zip(segments, range(base, base + n), strict=True))

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(counts of each document: A, B, groups, links; links one after the
        other; document of each link; digest of each document's groups)"""
        n = len(texts)
        texts = V.rebased(texts)
        empty = V.text_buffer(texts)[1]
        data, offsets = V.text_buffer(pc.binary_join_element_wise(_text(" "), texts, _text("")))
        opens = np.zeros(len(data), bool)
        opens[offsets[:-1]] = opens[segment_cuts(data)] = True
        bounds = np.flatnonzero(opens)
        cuts = np.concatenate([bounds, offsets[-1:]])
        segments = pa.Array.from_buffers(
            pa.large_binary(), len(bounds), [None, pa.py_buffer(np.ascontiguousarray(cuts)), pa.py_buffer(data)]
        )
        coded = segments.dictionary_encode()
        unique = coded.dictionary.to_pylist()
        if len(self.known) + len(unique) > MAX_KNOWN:
            self._forget()
        place = np.array([self.known.get(s, -1) for s in unique], np.int64)
        unknown = np.flatnonzero(place < 0)
        new = [unique[i] for i in unknown.tolist()]
        if new:
            place[unknown] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn(new)
        at = place[coded.indices.to_numpy()]
        of = np.searchsorted(offsets, bounds, "right") - 1
        spelled = np.bincount(of, weights=self.counts[at, 3] == 0, minlength=n) == 0
        has = spelled & (np.diff(empty) > 0)
        at, of = at[has[of]], of[has[of]]
        links, sizes = self.links.take(at)
        counts = np.zeros((n, 4), np.int64)
        for k in range(3):
            counts[:, k] = np.bincount(of, weights=self.counts[at, k], minlength=n)
        doc = np.repeat(of, sizes)
        counts[:, 3] = np.bincount(doc, minlength=n)
        shown, lengths = self.groups.take(at)
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, weights=lengths, minlength=n).astype(np.int64))])
        raw = memoryview(np.ascontiguousarray(shown))
        digests = [
            hashlib.sha256(raw[ends[i] : ends[i + 1] - 1]).hexdigest() if has[i] else "" for i in range(n)
        ]
        long = [s for s in new if len(s) > LONG_SEGMENT]
        if len(long) > 64 or sum(map(len, long)) > BLOCK_BYTES:
            self._forget()
        return counts, links, doc, digests


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, how often) of a sorted array."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.concatenate([first, [len(values)]]))


def write_planes(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, n_pairs: int) -> bytes:
    """Bit planes of ``times`` for entries sorted by (pair number, document)."""
    parts, plane = [], 0
    while (times >> plane).any():
        chosen = (times >> plane & 1).astype(bool)
        p, d = pair[chosen], doc[chosen]
        gaps = np.diff(d, prepend=-1)
        first = np.diff(p, prepend=-1) != 0
        gaps[first] = d[first] + 1
        wide = gaps >= 255
        head = np.array([len(p), int(wide.sum())], "<u4").tobytes()
        counts = np.bincount(p, minlength=n_pairs).astype("<u4").tobytes()
        parts.append(head + counts + np.minimum(gaps, 255).astype(np.uint8).tobytes() + gaps[wide].astype("<u4").tobytes())
        plane += 1
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def read_planes(blob: bytes, n_pairs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pair number, document) of each set bit, plane by plane."""
    raw, at = zstandard.ZstdDecompressor().decompress(blob), 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, n, at)
        at += out.nbytes
        return out

    while at < len(raw):
        n, n_wide = take("<u4", 2)
        counts = take("<u4", n_pairs).astype(np.int64)
        gaps = take("u1", int(n)).astype(np.int64)
        gaps[gaps == 255] = take("<u4", int(n_wide))
        total = np.concatenate([[0], np.cumsum(gaps)])
        base = total[np.cumsum(counts) - counts]
        yield np.repeat(np.arange(n_pairs), counts), total[1:] - np.repeat(base, counts) - 1


class _Container:
    """Blocks of documents, OR-merged by pair."""

    def __init__(self):
        self.ids, self.counts, self.digests, self.keys, self.times = [], [], [], [], []
        self.n = self.size = 0

    def add(self, ids: pa.Array, counts, links, doc, digests, size: int) -> None:
        keys = np.sort((links << 17) | (doc + self.n))
        keys, times = _runs(keys)
        self.ids.append(ids)
        self.counts.append(counts)
        self.digests += digests
        self.keys.append(keys)
        self.times.append(times)
        self.n += len(ids)
        self.size += size

    def row(self, number: int) -> pa.RecordBatch:
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        pairs, docs = _runs(keys >> 17)
        at = np.repeat(np.arange(len(pairs)), docs)
        starts = np.cumsum(docs) - docs
        links = np.add.reduceat(times, starts) if len(pairs) else np.zeros(0, np.int64)
        planes = write_planes(at, keys & ((1 << 17) - 1), times, len(pairs))
        counts = np.concatenate(self.counts)
        cell = lambda v: pa.array([v])
        long = lambda v: pa.ListArray.from_arrays(
            pa.array([0, len(v)], pa.int32()), pa.array(v, pa.int64())
        )
        doc_ids = pa.ListArray.from_arrays(pa.array([0, self.n], pa.int32()), pa.concat_arrays(self.ids))
        return pa.RecordBatch.from_arrays(
            [
                cell(number),
                cell(planes),
                long(pairs),
                long(docs),
                long(links),
                doc_ids,
                *(long(counts[:, k]) for k in range(4)),
                pa.array([self.digests], pa.list_(pa.string())),
            ],
            [c.split()[0] for c in CONTAINERS.split(", ")],
        )


def _build(path_a: str, path_b: str, max_docs: int, max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = Aligner.of(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        held = _Container()
        for batch in batches:
            ids, texts = batch.column(0).cast(pa.int64()), batch.column(1)
            for a, b, data, _ in V.blocks(texts, BLOCK_BYTES):
                for k in range(a, b, max_docs):
                    n = min(b - k, max_docs)
                    if held.n and (held.n + n > max_docs or held.size + len(data) > max_bytes):
                        yield held.row(number)
                        number, held = number + 1, _Container()
                    held.add(ids.slice(k, n), *aligner.block(texts.slice(k, n)), len(data))
        if held.n:
            yield held.row(number)

    return run


def containers(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    max_docs: int = CONTAINER_DOCS,
    max_bytes: int = CONTAINER_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Containers of all documents, written to the shared folder: pairs of ids
    (A << bits | B) with their numbers of documents and links, the planes, and
    per document its counts and groups' digest."""
    if not 0 < max_docs <= CONTAINER_DOCS:
        raise ValueError(f"a container numbers at most {CONTAINER_DOCS} documents")
    spark = docs.sparkSession
    ship_library(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    build = _build(
        path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B), max_docs, max_bytes
    )
    return Folder(spark, "aligned").keep(rows.mapInArrow(build, CONTAINERS), "containers")


def pair_bits(path_b: str | None = None) -> int:
    """Bits of a pair that hold the B id."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path_b or vocabulary_path(VOCABULARY_B))
    return int(library.get_piece_size()).bit_length()


def _postings(held: DataFrame) -> DataFrame:
    """(container, pair, docs, links), one row per pair of a container."""
    return held.select("container", F.inline(F.arrays_zip("pairs", "docs", "links"))).withColumnRenamed("pairs", "pair")


def pair_counts(held: DataFrame, bits: int | None = None) -> DataFrame:
    """(pair, a, b, docs, links, best): documents and links of every pair of
    ids in the corpus, and whether no other A id has more links with b."""
    bits = pair_bits() if bits is None else bits
    counts = _postings(held).groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    counts = counts.withColumn("a", F.shiftright("pair", bits)).withColumn("b", F.col("pair").bitwiseAND((1 << bits) - 1))
    # the rows of one b are at most as many as vocabulary A has ids
    return counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda name: batch.column(name)[i].values  # noqa: E731, B023
            numbers = lambda name: get(name).to_numpy().astype(np.int64)
            n = len(get("doc_ids"))
            pairs = numbers("pairs")
            scores = batch.column("scores")[i].values
            best, low, high = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            if scores is not None and len(pairs):
                order = np.argsort(scores.field("pair").to_numpy())
                links = scores.field("links").to_numpy()[order]
                is_best = scores.field("best").to_numpy(zero_copy_only=False)[order].astype(np.float64)
                for plane, (at, doc) in enumerate(read_planes(batch.column("planes")[i].as_py(), len(pairs))):
                    best += np.bincount(doc, weights=is_best[at], minlength=n).astype(np.int64) << plane
                    # two halves, as sums of whole counts may pass what a float holds exactly
                    low += np.bincount(doc, weights=(links[at] & 0xFFFFFF).astype(float), minlength=n) * (1 << plane)
                    high += np.bincount(doc, weights=(links[at] >> 24).astype(float), minlength=n) * (1 << plane)
            count_sum = low.astype(np.int64) + (high.astype(np.int64) << 24)
            yield pa.RecordBatch.from_arrays(
                [
                    get("doc_ids"),
                    *(get(c) for c in ("n_a", "n_b", "n_groups", "n_links")),
                    pa.array(best),
                    pa.array(count_sum),
                    get("groups"),
                ],
                [c.split()[0] for c in SCORED.split(", ")],
            )


def document_scores(held: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts of every document, its links whose pair is the best of its B id
    (ties included), and the sum of its links' pair counts."""
    returned = (
        _postings(held)
        .select("container", "pair")
        .join(counts.select("pair", "links", "best"), "pair")
        .groupBy("container")
        .agg(F.collect_list(F.struct("pair", "links", "best")).alias("scores"))
    )
    kept = held.drop("docs", "links")
    return kept.join(returned, "container", "left").drop("container").mapInArrow(_score, SCORED)


def align(docs: DataFrame, **options) -> DataFrame:
    """Aligned counts and scores of every document."""
    held = containers(docs, **options)
    counts = pair_counts(held, pair_bits(options.get("path_b")))
    counts = Folder(docs.sparkSession, "pairs").keep(counts, "counts")
    return document_scores(held, counts)
