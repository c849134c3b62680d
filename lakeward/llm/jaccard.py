"""N-gram Jaccard join with prefix filters under several global orders.

Documents are sets of word shingles; two link at a Jaccard similarity of at
least ``min_percent`` hundredths.  In any one global order of shingles, linked
sets share a shingle among the first few of each (the prefix, a fifth of the
set at 0.8).  Three orders are used: each puts the shingles that most documents
hold last, and otherwise sorts by a hash of its own.  A candidate must share a
prefix shingle in all three before its sets are compared.

Candidates are not all pairs of a shingle's documents.  First, where documents
share a prefix shingle, a few of them are centres and the others are compared
with those; what this verifies is joined into components, and the next round
takes other centres.  Then pairs of a shingle's documents that are still in
different components, and only those, are tested, so no link between components
is missed and components are exact.  Sketches test those pairs where they
meet, and only near ones become rows.

Links lie within components.  There all pairs are tested, in blocks: a large
component's texts are dealt to blocks, and every pair of blocks is one group of
its own that gives a number of links per text and not a row per link.

Nodes are distinct texts, named by 64 bits.  Texts without words have an empty
set and link with nothing, a null text is empty, copies and repeated rows share
a component, rows with a null id take part but never name a component unless
all its ids are null, an empty table gives an empty result, and other columns
are ignored by ``similar_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .components import connected_components
from .texts import Folder, keyed, mark_possible, partitions, text_key
from .tokens import Encoder

SHINGLE = 5
MIN_PERCENT = 80
#: Shingles put last in every order: at most so many, by document frequency.
MAX_COMMON = 1 << 18
#: A task reports a shingle that so many of its held documents have.
LOCAL_COMMON = 3
#: Shingles that a task holds: to find common ones, and to send prefixes.
FLUSH = 1 << 22
SEND_FLUSH = 1 << 20
#: Pairs that a task looks at together.
PAIRS = 1 << 18
#: Shingles of pairs that are compared together.
VERIFY_SHINGLES = 1 << 18
ORDERS = 3
#: Rounds of stars at most, and centres a shingle takes in each.
STAR_ROUNDS = 2
PIVOTS = 4  # one in the first round
#: A shingle with more texts takes them all as nodes, without a test.
MANY = 512
#: Texts and shingles of a block on average, and shingles compared at a time.
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 1 << 21
COLUMNS = 4096
#: Bins of a set's sketch, and pairs of them that are compared together.
BINS = 256
SKETCHES = 1 << 14

V.return_large_arrays()  # its tasks are many, and of very different sizes

_WORDS = V.Polynomial(5)
_POLY = V.Polynomial(6)
_SEEDS = [V.mix64(np.array([k + 1], V.U))[0] for k in range(ORDERS)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of each text, ascending."""
    low = V.lowered(data)
    starts, ends, bounds = V.words(low, offsets)
    sums = _POLY.sums(V.word_hashes(low, starts, ends, _WORDS))
    counts = np.diff(bounds)
    at, rows = V.window_starts(bounds, size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    hashes = np.concatenate([_POLY.spans(sums, at, at + size), _POLY.spans(sums, bounds[short], bounds[short + 1])])
    rows = np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    return hashes, np.searchsorted(rows, np.arange(len(offsets)))


def prefix_size(n: np.ndarray, min_percent: int) -> np.ndarray:
    """Shingles of a set of ``n`` that can't all be missing from a partner."""
    return np.where(n > 0, n - -(-n * min_percent // 100) + 1, 0)


def order_keys(hashes: np.ndarray, order: int, common: np.ndarray) -> np.ndarray:
    """Place of each shingle in a global order: common ones last."""
    keys = V.mix64(hashes ^ _SEEDS[order]) >> V.U(1)
    if len(common):
        at = np.searchsorted(common, hashes)
        at[at == len(common)] = 0
        keys |= (common[at] == hashes).astype(V.U) << V.U(63)
    return keys


def prefixes(hashes: np.ndarray, bounds: np.ndarray, order: int, common: np.ndarray, min_percent: int):
    """(row, shingle, position) of every set's prefix in an order."""
    sizes = np.diff(bounds)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    place = np.lexsort((order_keys(hashes, order, common), rows))
    at = np.arange(len(hashes)) - np.repeat(bounds[:-1], sizes)
    first = at < prefix_size(sizes, min_percent)[rows]
    return rows[first], hashes[place[first]], at[first]


def _fresh(batch: pa.RecordBatch, seen: set[int]) -> pa.RecordBatch:
    """Rows whose text key (column 0) the task has not met."""
    keys = batch.column(0).to_pylist()
    return batch.take(pa.array([i for i, k in enumerate(keys) if k not in seen and not seen.add(k)], pa.int64()))


SIZES = "doc_id long, x1 long, n long, shingle long, docs long"


def _sizes(size: int):
    """(doc_id, x1, n) of every row, and (shingle, docs) of shingles that are
    common among the distinct texts a task holds at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.release()
        seen: set[int] = set()
        held, total = [], 0

        def common() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= LOCAL_COMMON
            none = pa.nulls(int(often.sum()), pa.int64())
            cells = [none, none, none, pa.array(values[often].view(np.int64)), pa.array(counts[often])]
            return pa.RecordBatch.from_arrays(cells, names)

        names = ["doc_id", "x1", "n", "shingle", "docs"]
        for batch in batches:
            for a, b, data, offsets in V.blocks(batch.column(2), 1 << 20):
                hashes, bounds = shingle_sets(data, offsets, size)
                rows = batch.slice(a, b - a)
                none = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(np.diff(bounds)), none, none], names
                )
                new = [k not in seen and not seen.add(k) for k in rows.column(1).to_pylist()]
                held.append(hashes[np.repeat(np.array(new, bool), np.diff(bounds))])
                total += len(held[-1])
                if total >= FLUSH:
                    yield common()
                    held, total = [], 0
        if held:
            yield common()

    return run


SENT = "bucket int, low binary, x1 binary, at binary, n binary, shared boolean"


def _send_prefixes(size: int, min_percent: int, common: np.ndarray, buckets: int):
    """Tasks: prefix shingles of their distinct texts in the first order, with
    their positions.  A shingle that several of them have goes to its bucket
    once; all its holders follow as a row that is known to be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.release()
        seen: set[int] = set()
        held, total = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            shingles, x1, at, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((x1, shingles))
            shingles, x1, at, n = shingles[order], x1[order], at[order], n[order]
            same = shingles[1:] == shingles[:-1]
            later = np.concatenate([[False], same])
            several = later | np.concatenate([same, [False]])
            bucket = ((shingles >> V.U(32)) * V.U(buckets) >> V.U(32)).astype(np.int64)
            low = shingles.astype(np.uint32)
            for chosen, shared in ((~later, False), (several, True)):
                values = [v[chosen] for v in (low, x1, at, n)]
                cuts = np.searchsorted(bucket[chosen], np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cuts))
                cells = [[v[cuts[k] : cuts[k + 1]] for k in full] for v in values]
                cells = [[v.tobytes() for v in c] for c in cells[:2]] + [
                    [V.narrow(v).tobytes() for v in c] for c in cells[2:]
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        *(pa.array(c, pa.binary()) for c in cells),
                        pa.array(np.full(len(full), shared)),
                    ],
                    ["bucket", "low", "x1", "at", "n", "shared"],
                )

        for part in (p for batch in batches for p in V.slices(batch)):
            rows = _fresh(part, seen)
            if not len(rows):
                continue
            names = rows.column(0).to_numpy()
            for a, b, data, offsets in V.blocks(rows.column(1), 1 << 20):
                hashes, bounds = shingle_sets(data, offsets, size)
                row, shingle, at = prefixes(hashes, bounds, 0, common, min_percent)
                held.append((shingle, names[a:b][row], at, np.diff(bounds)[row]))
                total += len(row)
            if total >= SEND_FLUSH:
                yield from flush()
                held, total = [], 0
        if held:
            yield from flush()

    return run


SHARED = "token long, x1 long, at long, n long"


def _meet(key: tuple, table: pa.Table) -> pa.Table:
    """A bucket: (shingle, text, position, set size) where texts meet."""
    parts: dict[bool, list] = {False: [], True: []}
    for low, x, i, m, shared in zip(*(table.column(c) for c in ("low", "x1", "at", "n", "shared")), strict=True):
        x1 = np.frombuffer(x.as_buffer(), np.int64)
        parts[shared.as_py()].append(
            (np.frombuffer(low.as_buffer(), np.uint32), x1, V.wide(i, len(x1)), V.wide(m, len(x1)))
        )
    out = [np.zeros((0, 4), np.int64)]
    for shared, rows in parts.items():
        if not rows:
            continue
        low, x1, at, n = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.lexsort((x1, low))
        low, x1, at, n = low[order], x1[order], at[order], n[order]
        new = np.ones(len(low), bool)  # a text may come from several tasks
        new[1:] = (low[1:] != low[:-1]) | (x1[1:] != x1[:-1])
        low, x1, at, n = low[new], x1[new], at[new], n[new]
        if not shared:
            same = low[1:] == low[:-1]
            many = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            low, x1, at, n = low[many], x1[many], at[many], n[many]
        out.append(np.column_stack([low.astype(np.int64) | key[0].as_py() << 32, x1, at, n]))
    found = np.unique(np.concatenate(out), axis=0)
    return pa.table({c: found[:, i] for i, c in enumerate(("token", "x1", "at", "n"))})


SETS = "x1 long, n long, shingles binary, bins binary"


def bin_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A sketch of each set: how many shingles fall in each of ``BINS`` bins,
    255 at most.  The overlap of two sets is at most the sum of their bins'
    lesser counts (a bin that is full in both says nothing)."""
    n = len(bounds) - 1
    rows = np.repeat(np.arange(n), np.diff(bounds))
    bins = (V.mix64(hashes ^ V.U(BINS)) >> V.U(56)).astype(np.int64)
    return np.minimum(np.bincount(rows * BINS + bins, minlength=n * BINS), 255).astype(np.uint8).reshape(n, BINS)


def _sets(size: int):
    """Each text's set, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in V.blocks(batch.column(1), 1 << 20):
                hashes, bounds = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(bounds)),
                        V.binary_array(hashes, bounds),
                        V.binary_array(bin_counts(hashes, bounds).ravel(), np.arange(b - a + 1) * BINS),
                    ],
                    ["x1", "n", "shingles", "bins"],
                )

    return run


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _meets(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending arrays share a value."""
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return bool((a[at] == b).any())


def linked(a: np.ndarray, b: np.ndarray, pa_: list, pb: list, min_percent: int) -> bool:
    """Sizes, then prefixes in every order, then the sets themselves."""
    n, m = len(a), len(b)
    if 100 * min(n, m) < min_percent * max(n, m) or not n:
        return False
    if not all(_meets(x, y) for x, y in zip(pa_, pb, strict=True)):
        return False
    shared = _overlap(a, b)
    return 100 * shared >= min_percent * (n + m - shared)


def _prefix_cells(hashes: np.ndarray, bounds: np.ndarray, common: np.ndarray, min_percent: int) -> list[list]:
    """Each set's prefix in every order, ascending."""
    cuts = np.concatenate([[0], np.cumsum(prefix_size(np.diff(bounds), min_percent))])
    cells = []
    for k in range(ORDERS):
        rows, shingles, _ = prefixes(hashes, bounds, k, common, min_percent)
        shingles = shingles[np.lexsort((shingles, rows))]
        cells.append([shingles[cuts[i] : cuts[i + 1]] for i in range(len(cuts) - 1)])
    return [list(x) for x in zip(*cells, strict=True)]


def _verify(min_percent: int, common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [[np.frombuffer(c.as_buffer(), V.U) for c in batch.column(i)] for i in (2, 3)]
            good: list[bool] = []
            room = np.cumsum([len(a) + len(b) for a, b in zip(*cells, strict=True)]) // VERIFY_SHINGLES
            cuts = [0, *(np.flatnonzero(np.diff(room)) + 1).tolist(), len(room)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                sides = [c[lo:hi] for c in cells]
                firsts = []
                for side in sides:
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64)
                    firsts.append(_prefix_cells(np.concatenate(side), bounds, common, min_percent) if side else [])
                good += [linked(*x, min_percent) for x in zip(*sides, *firsts, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def near_sketches(n: np.ndarray, m: np.ndarray, left: np.ndarray, right: np.ndarray, min_percent: int) -> np.ndarray:
    """Pairs of sets whose sketches leave room for the overlap they need."""
    low = np.minimum(left, right)
    least = np.minimum(n, m)
    most = np.where((low == 255).any(axis=1), least, np.minimum(low.sum(1, dtype=np.int64), least))
    return 100 * most >= min_percent * (n + m - most)


def _sketches(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def _sketched(min_percent: int):
    """Pairs whose sketches are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
            good = near_sketches(n, m, *(_sketches(batch.column(c)) for c in ("ba", "bb")), min_percent)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good))

    return run


def _both(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of both sides' sets; sets that are
    surely in no pair are not moved."""
    named = pairs.select(F.col("a").alias("x1")).union(pairs.select("b"))
    sets = mark_possible(sets.select("x1", *columns), named, ["x1"]).filter("__possible")
    sides = [sets.select(F.col("x1").alias(s), *[F.col(c).alias(f"{c[0]}{s}") for c in columns]) for s in "ab"]
    both = pairs.join(sides[1], "b").join(sides[0], "a")
    return both.select("a", "b", *[f"{c[0]}{s}" for c in columns for s in "ab"])


def near(pairs: DataFrame, sets: DataFrame, folder: Folder, name: str, min_percent: int = MIN_PERCENT) -> DataFrame:
    """Candidate ``pairs`` (a, b) whose sketches are near."""
    return folder.keep(_both(pairs, sets, ["n", "bins"]).mapInArrow(_sketched(min_percent), CROSS), name)


def verified(pairs: DataFrame, sets: DataFrame, common: np.ndarray, min_percent: int = MIN_PERCENT) -> DataFrame:
    """The linked ones of near ``pairs`` (a, b); sets move only for these."""
    return _both(pairs, sets, ["shingles"]).mapInArrow(_verify(min_percent, common), CROSS)


CROSS = "a long, b long"


def _possible(n, at, m, other, min_percent):
    """Whether sets of n and m shingles can link if the first they share is at
    these positions: the overlap needed must still fit behind them."""
    need = -(-(n + m) * min_percent // (100 + min_percent))
    return (np.minimum(n - at, m - other) >= need) & (100 * np.minimum(n, m) >= min_percent * np.maximum(n, m))


class _Meetings:
    """Rows of a bucket by shingle, then set size: column arrays, the group of
    each row and the groups' bounds."""

    def __init__(self, table: pa.Table, *columns: str):
        values = {c: table.column(c).to_numpy() for c in ("token", "x1", "n", *columns)}
        self.order = order = np.lexsort((values["x1"], values["n"], values["token"]))
        for c, v in values.items():
            setattr(self, c, v[order])
        new = np.ones(len(order), bool)
        new[1:] = self.token[1:] != self.token[:-1]
        self.group = np.cumsum(new) - 1
        self.starts = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.starts, len(order)))

    def later(self, min_percent: int) -> np.ndarray:
        """For each row, how many later ones of its group are small enough."""
        wide = int(self.n.max()) * 2 + 2 if len(self.n) else 1
        upto = np.searchsorted(self.group * wide + self.n, self.group * wide + self.n * 100 // min_percent, "right")
        return np.maximum(upto - np.arange(len(self.n)) - 1, 0)

    def pairs(self, left: np.ndarray, first: np.ndarray, counts: np.ndarray, min_percent: int):
        """Chunks of possible pairs (i, j): rows ``left`` with the ``counts``
        rows from ``first`` on."""
        done = np.cumsum(counts)
        lo = 0
        while lo < len(left):
            hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + PAIRS, "right")))
            i, j = np.repeat(left[lo:hi], counts[lo:hi]), V.ranges(first[lo:hi], counts[lo:hi])
            can = _possible(self.n[i], self.at[i], self.n[j], self.at[j], min_percent)
            yield i[can], j[can]
            lo = hi


def _nodes(min_percent: int):
    """Texts with a possible partner for some shingle; all texts of a shingle
    that very many have."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        m = _Meetings(table, "at")
        many = m.sizes[m.group] > MANY
        keep = many.copy()
        few = np.flatnonzero(~many)
        for i, j in m.pairs(few, few + 1, m.later(min_percent)[few], min_percent):
            keep[i] = keep[j] = True
        return pa.table({"x1": np.unique(m.x1[keep])})

    return run


def _pivots(m: _Meetings, turn: int) -> np.ndarray:
    """Rows that are the centres of their shingle: a few texts of its largest
    component, others for every shingle and turn."""
    order = np.lexsort((m.root, m.group))
    new = np.ones(len(order), bool)
    new[1:] = (m.group[order][1:] != m.group[order][:-1]) | (m.root[order][1:] != m.root[order][:-1])
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(new) - 1
    lengths = np.bincount(run)
    most = np.maximum.reduceat(lengths[run], m.starts)
    # of components of one size the one with the least name; of single texts all
    single = most[m.group] == 1
    largest = lengths[run] == most[m.group]
    least = np.minimum.reduceat(np.where(largest, m.root, np.iinfo(np.int64).max), m.starts)
    can = np.flatnonzero(single | (largest & (m.root == least[m.group])))
    # at first the same centre for all shingles of a group of copies
    salt = V.mix64((m.token[can] if turn > 1 else np.zeros(len(can), np.int64)).view(V.U) + V.U(turn))
    dealt = V.mix64(m.x1[can].view(V.U) ^ salt)
    can = can[np.lexsort((dealt, m.group[can]))]
    first = np.ones(len(can), bool)
    first[1:] = m.group[can][1:] != m.group[can][:-1]
    rank = np.arange(len(can)) - np.maximum.accumulate(np.where(first, np.arange(len(can)), 0))
    return can[rank < (PIVOTS if turn > 1 else 1)]


def _between(min_percent: int, turn: int):
    """Per shingle: pairs of different components that can link with it as the
    first shared shingle.  At turn 0 all of them whose sketches are near, tested
    here, so that texts which share much but link with few give few rows; else
    only those with the shingle's centres."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        m = _Meetings(table, "root", "at")
        if turn:
            left = _pivots(m, turn)
            first, counts = m.starts[m.group[left]], m.sizes[m.group[left]]
        else:
            left = np.arange(len(m.n))
            first, counts = left + 1, m.later(min_percent)
            bins = _sketches(table.column("bins"))[m.order]
        found = np.zeros((0, 2), np.int64)
        held: list[np.ndarray] = []
        for i, j in m.pairs(left, first, counts, min_percent):
            apart = m.root[i] != m.root[j]
            i, j = i[apart], j[apart]
            if not turn:
                good = [np.zeros(0, bool)]
                for lo in range(0, len(i), SKETCHES):
                    p, q = i[lo : lo + SKETCHES], j[lo : lo + SKETCHES]
                    good.append(near_sketches(m.n[p], m.n[q], bins[p], bins[q], min_percent))
                i, j = (x[np.concatenate(good)] for x in (i, j))
            a, b = m.x1[i], m.x1[j]
            held.append(np.column_stack([np.minimum(a, b), np.maximum(a, b)]))
            if sum(map(len, held)) > PAIRS:
                found, held = np.unique(np.concatenate([found, *held]), axis=0), []
        found = np.unique(np.concatenate([found, *held]), axis=0)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return run


def _merged(roots: DataFrame, links: DataFrame, folder: Folder, turn: int) -> DataFrame:
    """Components after new ``links``, found on the components so far: many
    links between two components are one edge."""
    left = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
    right = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
    edges = links.join(left, "a", "left").join(right, "b", "left")
    edges = edges.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct()
    joined = connected_components(edges, folder, f"merge-{turn}").withColumnRenamed("root", "top")
    old = roots.join(joined.withColumnRenamed("id", "root"), "root", "left")
    new = joined.join(roots.select("id"), "id", "left_anti")
    both = old.select("id", F.coalesce("top", "root").alias("root")).union(new.select("id", "top"))
    return folder.keep(both, f"roots-{turn}")


def _incidence(values: np.ndarray, rows: np.ndarray, n: int, common: np.ndarray):
    """Per chunk of ``common``: which of ``n`` texts hold which shingle."""
    at = np.searchsorted(common, values)
    at[at == len(common)] = 0
    good = common[at] == values
    at, rows = at[good], rows[good]
    order = np.argsort(at, kind="stable")
    at, rows = at[order], rows[order]
    for lo in range(0, len(common), COLUMNS):
        a, b = np.searchsorted(at, [lo, lo + COLUMNS])
        chunk = np.zeros((n, min(COLUMNS, len(common) - lo)), np.float32)
        chunk[rows[a:b], at[a:b] - lo] = 1
        yield chunk


def all_links(left: list[np.ndarray], right: list[np.ndarray] | None, min_percent: int) -> np.ndarray:
    """Which sets of ``left`` link with which of ``right``, or with which
    others of ``left``; overlaps below 2^24 are exact."""
    sides = [left] if right is None else [left, right]
    values = [np.concatenate(s) for s in sides]
    sizes = [np.array([len(x) for x in s]) for s in sides]
    rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
    if right is None:
        found, counts = np.unique(values[0], return_counts=True)
        common = found[counts > 1]
    else:
        common = np.intersect1d(*values)
    shared = np.zeros((len(left), len(sides[-1])), np.float32)
    chunks = [_incidence(v, r, len(n), common) for v, r, n in zip(values, rows, sizes, strict=True)] if len(common) else []
    for a, *b in zip(*chunks, strict=True):
        shared += a @ (b[0] if b else a).T
    both = sizes[0][:, None] + sizes[-1][None, :]
    shared = shared.astype(np.int64)
    links = (shared > 0) & (100 * shared >= min_percent * (both - shared))
    if right is None:
        np.fill_diagonal(links, False)
    return links


def _count_links(min_percent: int):
    """(x1, links): rows that link with a text, per pair of blocks.  Rows of a
    pair of blocks follow one another."""

    def of(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held)
        x1, copies, second = (table.column(c).to_numpy() for c in ("x1", "copies", "second"))
        sets = [np.frombuffer(v.as_buffer(), V.U) for v in table.column("shingles")]
        a, b = np.flatnonzero(~second), np.flatnonzero(second)
        if table.column("p")[0].as_py() == table.column("q")[0].as_py():
            return x1, all_links(sets, None, min_percent) @ copies
        counts = np.zeros(len(x1), np.int64)
        if len(a) and len(b):
            links = all_links([sets[i] for i in a], [sets[i] for i in b], min_percent)
            counts[a], counts[b] = links @ copies[b], links.T @ copies[a]
        return x1, counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            if not len(batch):
                continue
            done = []
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("root", "p", "q")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                key = tuple(keys[lo])
                if held and key != last:
                    done.append(of(held))
                    held = []
                last = key
                held.append(batch.slice(lo, hi - lo))
            if done:
                x1, counts = (np.concatenate(v) for v in zip(*done, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x1), pa.array(counts)], ["x1", "links"])
        if held:
            x1, counts = of(held)
            yield pa.RecordBatch.from_arrays([pa.array(x1), pa.array(counts)], ["x1", "links"])

    return run


def text_links(named: DataFrame, sets: DataFrame, roots: DataFrame, folder: Folder, min_percent: int) -> DataFrame:
    """(x1, links) of texts in components of several: rows with another text
    that links with this one."""
    members = named.join(roots.select(F.col("id").alias("x1")), "x1", "left_semi")
    members = folder.keep(members.select("x1", "root", "copies"), "members")
    chosen = mark_possible(sets.select("x1", "n", "shingles"), members, ["x1"]).filter("__possible")
    chosen = chosen.join(members, "x1").drop("__possible")
    size = sets.select("x1", "n").join(members, "x1").groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    blocks = F.ceil(F.greatest(F.col("k") / BLOCK_TEXTS, F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    # every large component has many texts or shingles, so these are few; Spark
    # broadcasts them if their written size allows it
    large = folder.keep(size.select("root", blocks).filter("blocks > 1"), "large")
    dealt = chosen.join(large, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("x1"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = dealt.select(
        "root",
        F.least("own", "other").alias("p"),
        F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).alias("second"),
        "x1",
        "copies",
        "shingles",
    )
    pairs = pairs.repartition("root", "p", "q").sortWithinPartitions("root", "p", "q")
    counts = pairs.mapInArrow(_count_links(min_percent), "x1 long, links long")
    return folder.keep(counts.groupBy("x1").agg(F.sum("links").alias("links")), "counts")


def _grouped_texts(
    docs: DataFrame, shingle: int, min_percent: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, Folder]:
    """(doc_id, x1, n) of every row; (x1, first, copies, root) of every text
    with words: the least doc_id of its rows, their number, its component; the
    sets of texts with a possible partner; (id, root) of linked texts."""
    spark = docs.sparkSession
    folder = Folder(spark, "jaccard")
    buckets = max(16, partitions(spark))
    rows = keyed(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    sized = folder.keep(rows.select("doc_id", "x1", "text").mapInArrow(_sizes(shingle), SIZES), "sizes")
    often = sized.filter("shingle is not null").groupBy("shingle").agg(F.sum("docs").alias("docs"))
    top = often.orderBy(F.desc("docs"), "shingle").limit(MAX_COMMON).select("shingle").toPandas()
    common = np.sort(top["shingle"].to_numpy().astype(np.int64).view(V.U))
    plain = sized.filter("n is not null").select("doc_id", "x1", "n")

    sent = rows.select("x1", "text").mapInArrow(_send_prefixes(shingle, min_percent, common, buckets), SENT)
    shared = folder.keep(sent.groupBy("bucket").applyInArrow(_meet, SHARED), "shared")
    bucket = F.shiftright("token", 32).alias("bucket")
    nodes = shared.select("*", bucket).groupBy("bucket").applyInArrow(_nodes(min_percent), "x1 long").distinct()
    x1, _ = text_key(text_col)
    nodes = folder.keep(nodes, "nodes")
    texts = docs.select(x1.alias("x1"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = mark_possible(texts, nodes, ["x1"]).filter("__possible")
    texts = texts.groupBy("x1").agg(F.first("text").alias("text")).join(nodes, "x1")
    sets = folder.keep(texts.select("x1", "text").mapInArrow(_sets(shingle), SETS), "sets")
    meetings = folder.keep(shared.join(sets.select("x1"), "x1"), "meetings")
    folder.drop("shared", "nodes")

    # stars while they link, then every pair that is left between components
    tested = spark.createDataFrame([], CROSS)
    roots = spark.createDataFrame([], "id long, root long")
    turn, merged, last, joined = 1, 0, False, True
    while not last:
        last = turn > STAR_ROUNDS or not joined
        held = meetings.join(roots.withColumnRenamed("id", "x1"), "x1", "left")
        held = folder.keep(held.withColumn("root", F.coalesce("root", "x1")), f"held-{turn}")
        apart = held.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
        split = held.join(apart.select("token"), "token", "left_semi").select("*", bucket)
        if last:
            split = split.join(sets.select("x1", "bins"), "x1")
        step = _between(min_percent, 0 if last else turn)
        found = split.groupBy("bucket").applyInArrow(step, CROSS).distinct()
        fresh = folder.keep(found.join(tested, ["a", "b"], "left_anti"), f"pairs-{turn}")
        close = fresh if last else near(fresh, sets, folder, f"near-{turn}", min_percent)
        more = folder.keep(verified(close, sets, common, min_percent), f"links-{turn}")
        folder.drop(f"held-{turn}", f"near-{turn}")
        joined = not more.isEmpty()
        if joined:
            tested = tested.union(fresh)
            roots = _merged(roots, more, folder, turn)
            folder.drop(f"links-{turn}", f"roots-{merged}")
            merged = turn
        turn += 1
    folder.drop("meetings")

    firsts = plain.filter("n > 0").groupBy("x1").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    named = firsts.join(roots.withColumnRenamed("id", "x1"), "x1", "left").withColumn("root", F.coalesce("root", "x1"))
    return plain, named, sets, roots, folder


def similar_documents(
    docs: DataFrame,
    shingle: int = SHINGLE,
    min_percent: int = MIN_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id that links
    reach), n_links (other rows that link with it, copies included) and x1, the
    key of its text."""
    plain, named, sets, roots, folder = _grouped_texts(docs, shingle, min_percent, id_col, text_col)
    named = folder.keep(named, "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    links = text_links(named, sets, roots, folder, min_percent)
    n_links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    by_text = named.join(least, "root").join(links, "x1", "left").select("x1", "component_id", n_links)
    return plain.join(by_text, "x1", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "x1",
    )


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that with the least id, nulls last, then the
    least text key, then the least of all its columns; of rows that repeat one
    another one stays.  Texts without words all stay."""
    _, named, *_ = _grouped_texts(docs, SHINGLE, MIN_PERCENT, id_col, text_col)
    folder = Folder(docs.sparkSession, "gone")
    named = folder.keep(named, "texts")
    order = F.struct(F.col("first").isNull(), "first", "x1")
    best = named.groupBy("root").agg(F.min(order)["x1"].alias("best"))
    crowded = named.join(best, "root").filter("copies > 1 or x1 <> best")
    crowded = folder.keep(crowded.select(F.col("x1").alias("__x1"), (F.col("x1") == F.col("best")).alias("stays")), "crowded")

    x1, x2 = text_key(text_col)
    wordy = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    whole = F.struct(F.col(id_col).isNull(), F.col(id_col).cast("long"), x2, F.struct("*").alias("row"))
    rows = docs.select(whole.alias("__whole"), x1.alias("__x1"), wordy.alias("__wordy"))
    rows = mark_possible(rows, crowded, ["__x1"]).withColumn("__possible", F.col("__possible") & F.col("__wordy"))
    # a text that only the filter takes for crowded has one row, and keeps it
    firsts = rows.filter("__possible").groupBy("__x1").agg(F.min("__whole").alias("__whole"))
    firsts = firsts.join(crowded.filter("not stays"), "__x1", "left_anti")
    return rows.filter("not __possible").select("__whole").union(firsts.select("__whole")).select("__whole.row.*")
