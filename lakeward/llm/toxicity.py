"""Toxicity by a weighted finite-state pattern grammar over clauses.

Lexicon.  Insult patterns are whole words or word beginnings (finite-state
patterns such as ``abcde*``) that labelled texts show to be toxic: a pattern
must stand in more toxic training texts than chance explains, and in different
surroundings, so that copies of one text do not make their words insults.

Grammar.  A clause is read as symbols: insult, threat, target, negation,
report or other.  Three transducers are composed into one machine (their product
automaton): negation marks the matches within its reach, reported speech the
matches after its verb, a target the matches after it; the target's machine also
reads the clause backwards, as a target aims at all of its clause.  What the
machine accepts is a clause pattern, an insult or threat with its marks, and
each of these patterns has a weight of its own: a logistic model of the
documents' sums per pattern, fitted on the labelled texts and drawn towards
weights that damp negated and reported matches.  A lone insult is a pattern too
(without marks); other words count nothing.

Labels are used only from rows whose crc32(id as text) mod 4 is not 2, at most
``MAX_TRAIN`` of them (least hash of the id, one text each: the least of an id's
texts).  That sample bounds the patterns learned from it, each of which stands
in several of its texts, and with them what is sent to tasks.  Scores depend on
the text alone.  Null and empty texts have no matches and get the model's base
score, and so do all texts without usable labels; rows with a null id count as
not held out; repeated rows score alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_library
from . import vectors as V
from .texts import Folder

MAX_TRAIN = 20_000
#: Chance, per pattern, of being as toxic in the sample without being so, and
#: the least log odds of a pattern.
CHANCE = 1e-3
MIN_ODDS = 3.0
#: Bytes of the word beginnings tried as patterns; 0 is the whole word.
BEGINNINGS = (0, 4, 5, 6, 7, 8)
REACH = 3
THRESHOLD = 0.3

#: Words of the other transducers (fixed values).
NEGATIONS = "not no never nor without isn't aren't don't nicht kein keine nie ohne ne pas jamais sans nunca sin ni".split()
REPORTS = (
    "said says say told claims claimed wrote called quoted sagte sagt schrieb nannte dit disait affirme appelle "
    "dijo dice llama escribe"
).split()
TARGETS = (
    "you your yours they them their he she him her these those people du dich dein ihr euch sie vous tu toi votre "
    "ils elles usted ustedes vosotros ellos tus"
).split()
THREATS = (
    "kill hurt destroy burn shoot stab beat attack murder töten verletzen zerstören schlagen tuer détruire frapper "
    "brûler matar destruir golpear quemar"
).split()
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)

LETTERS = V.word_table(bytes([*range(0x27), *range(0x28, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_POLY = V.Polynomial(7)
_END = np.zeros(256, bool)
_END[list(b".!?;:\n|")] = True


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


class Transducer:
    """A deterministic finite-state transducer: (state, symbol) to (state,
    mark); a symbol without an arc keeps the state and the mark 0."""

    def __init__(self, arcs: dict[tuple, tuple], start=0):
        self.arcs, self.start = arcs, start

    def step(self, state, symbol: int) -> tuple:
        return self.arcs.get((state, symbol), (state, 0))

    def run(self, symbols: list[int]) -> list[int]:
        state, marks = self.start, []
        for symbol in symbols:
            state, mark = self.step(state, symbol)
            marks.append(mark)
        return marks


def compose(*machines: Transducer) -> Transducer:
    """Their product: one machine whose states are theirs together and whose
    marks are their marks as bits, the first machine's lowest."""
    start = tuple(m.start for m in machines)
    arcs, ahead, seen = {}, [start], {start}
    while ahead:
        state = ahead.pop()
        for symbol in range(OTHER + 1):
            steps = [m.step(s, symbol) for m, s in zip(machines, state, strict=True)]
            after, mark = tuple(s for s, _ in steps), sum(bit << k for k, (_, bit) in enumerate(steps))
            if after != state or mark:
                arcs[state, symbol] = (after, mark)
            if after not in seen:
                seen.add(after)
                ahead.append(after)
    return Transducer(arcs, start)


def _negation() -> Transducer:
    """Marks matches at most REACH symbols after a negation."""
    arcs = {(s, NEGATION): (REACH, 0) for s in range(REACH + 1)}
    for s in range(1, REACH + 1):
        for symbol in (INSULT, THREAT):
            arcs[s, symbol] = (s - 1, 1)
        for symbol in (TARGET, REPORT, OTHER):
            arcs[s, symbol] = (s - 1, 0)
    return Transducer(arcs)


def _after(opener: int) -> Transducer:
    """Marks matches after a symbol of a kind."""
    arcs = {(s, opener): (1, 0) for s in (0, 1)}
    arcs |= {(1, symbol): (1, 1) for symbol in (INSULT, THREAT)}
    return Transducer(arcs)


#: Marks of a match, as bits.
MARKS = ("negated", "reported", "aimed")
FORWARD = compose(_negation(), _after(REPORT), _after(TARGET))
BACKWARD = _after(TARGET)
#: Clause patterns that the machine accepts: an insult or a threat with marks.
PATTERNS = tuple(
    "_".join([kind, *(m for k, m in enumerate(MARKS) if bits >> k & 1)]) for kind in ("insult", "threat") for bits in range(8)
)
SUMS = (*PATTERNS, "clauses")


def clause_sums(symbols: list[int], weights: list[float]) -> list[float]:
    """The sums of one clause: weights of its matches by accepted pattern (an
    unaimed threat is none of anyone and counts nothing)."""
    out = [0.0] * len(SUMS)
    behind = BACKWARD.run(symbols[::-1])[::-1]
    for symbol, weight, marks, aimed in zip(symbols, weights, FORWARD.run(symbols), behind, strict=True):
        marks |= aimed << 2
        if symbol == INSULT:
            out[marks] += weight
        elif symbol == THREAT and marks >> 2:
            out[8 + marks] += 1.0
    out[-1] = float(any(out))
    return out


def _prior() -> np.ndarray:
    """Before any label: aimed matches raise the score most, negation and report
    damp them; then the clauses and the base."""
    weights = [
        1.0 * (1.2 if "aimed" in p else 1.0) * (0.4 if "negated" in p else 1.0) * (0.5 if "reported" in p else 1.0)
        for p in PATTERNS
    ]
    return np.array([*weights, 0.5, -3.0])


@dataclass
class Grammar:
    """Patterns (beginning's length, text) with weights, and the model."""

    patterns: dict[tuple[int, str], float]
    model: list[float]

    def tables(self):
        """Per beginning's length: (hashes in order, weights)."""
        found = {}
        for size in BEGINNINGS:
            own = [(t.encode(errors="surrogateescape"), w) for (s, t), w in self.patterns.items() if s == size]
            data = np.frombuffer(b"".join(t for t, _ in own), np.uint8)
            cuts = np.concatenate([[0], np.cumsum([len(t) for t, _ in own])]).astype(np.int64)
            hashes = _POLY.spans(_POLY.sums(_POLY.values[data]), cuts[:-1], cuts[1:])
            order = np.argsort(hashes)
            found[size] = hashes[order], np.array([w for _, w in own])[order]
        return found


_KINDS = {
    w.encode(): kind
    for kind, listed in ((NEGATION, NEGATIONS), (REPORT, REPORTS), (TARGET, TARGETS), (THREAT, THREATS))
    for w in listed
}


def _lookup(hashes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    keys, weights = table
    if not len(keys):
        return np.zeros(len(hashes))
    at = np.searchsorted(keys, hashes)
    at[at == len(keys)] = 0
    return np.where(keys[at] == hashes, weights[at], 0.0)


def text_sums(data: np.ndarray, offsets: np.ndarray, grammar: Grammar, tables=None) -> np.ndarray:
    """A row of SUMS for every text.  Words are looked up with numpy; only
    clauses with an insult or threat are read by the transducers."""
    tables = tables or grammar.tables()
    out = np.zeros((len(offsets) - 1, len(SUMS)))
    low = V.lowered(data)
    starts, ends, bounds = V.words(low, offsets, LETTERS)
    if not len(starts):
        return out
    sums = _POLY.sums(_POLY.values[low])
    whole = _POLY.spans(sums, starts, ends)
    weight = _lookup(whole, tables[0])
    for size in BEGINNINGS[1:]:
        long = np.flatnonzero(ends - starts > size)
        weight[long] = np.maximum(weight[long], _lookup(_POLY.spans(sums, starts[long], starts[long] + size), tables[size]))
    threats = np.isin(whole, _THREAT_HASHES)
    hits = np.flatnonzero((weight > 0) | threats)
    if not len(hits):
        return out
    # clauses: words between sentence ends, and never across texts
    breaks = np.concatenate([[0], np.cumsum(_END[low])])
    clause = breaks[starts] + np.searchsorted(bounds, np.arange(len(starts)), "right") * (len(low) + 1)
    raw = low.tobytes()
    first = np.unique(np.searchsorted(clause, clause[hits], "left"))
    last = np.searchsorted(clause, clause[first], "right")
    for lo, hi in zip(first.tolist(), last.tolist(), strict=True):
        symbols = [_KINDS.get(raw[a:b], OTHER) for a, b in zip(starts[lo:hi], ends[lo:hi], strict=True)]
        weights = weight[lo:hi].tolist()
        symbols = [INSULT if w > 0 else s for s, w in zip(symbols, weights, strict=True)]
        row = int(np.searchsorted(bounds, lo, "right")) - 1
        out[row] += clause_sums(symbols, weights)
    return out


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    cuts = np.concatenate([[0], np.cumsum([len(w.encode()) for w in words])]).astype(np.int64)
    return np.sort(_POLY.spans(_POLY.sums(_POLY.values[data]), cuts[:-1], cuts[1:]))


_THREAT_HASHES = _hash_words(THREATS)


def _patterns_of(raw: bytes, starts, ends) -> dict[tuple[int, bytes], set[int]]:
    """Every pattern of a text, with hashes of its surroundings."""
    words = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
    found: dict[tuple[int, bytes], set[int]] = {}
    for i, w in enumerate(words):
        near = (words[i - 1] if i else b"") + b" " + (words[i + 1] if i + 1 < len(words) else b"")
        code = int.from_bytes(near[:4] + near[-4:], "little") % (1 << 62)
        for size in BEGINNINGS:
            if not size or len(w) > size:
                found.setdefault((size, w[:size] if size else w), set()).add(code)
    return found


def _toxic_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in V.blocks(batch.column(0)):
            low = V.lowered(data)
            starts, ends, bounds = V.words(low, offsets, LETTERS)
            raw = low.tobytes()
            sizes, texts, codes = [], [], []
            for i in range(len(offsets) - 1):
                lo, hi = bounds[i], bounds[i + 1]
                for (size, text), near in _patterns_of(raw, starts[lo:hi], ends[lo:hi]).items():
                    sizes.append(size)
                    texts.append(text)
                    codes.append(min(near))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()), pa.array(texts, pa.binary()), pa.array(codes, pa.int64())],
                ["size", "text", "near"],
            )


def _count_patterns(wanted: list[tuple[int, bytes]]):
    """(size, text, docs): texts of a task that hold each wanted pattern."""
    sizes = {s: {t for k, t in wanted if k == s} for s in BEGINNINGS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            for _, _, data, offsets in V.blocks(batch.column(0)):
                low = V.lowered(data)
                starts, ends, bounds = V.words(low, offsets, LETTERS)
                raw = low.tobytes()
                for i in range(len(offsets) - 1):
                    words = {raw[a:b] for a, b in zip(starts[bounds[i] : bounds[i + 1]], ends[bounds[i] : bounds[i + 1]], strict=True)}
                    for size, texts in sizes.items():
                        own = {w[:size] for w in words if len(w) > size} if size else words
                        for t in own & texts:
                            counts[size, t] = counts.get((size, t), 0) + 1
        if counts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _ in counts], pa.int32()),
                    pa.array([t for _, t in counts], pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["size", "text", "docs"],
            )

    return run


def _tail(toxic: int, clean: int, rate: float) -> float:
    """Log chance of at least ``toxic`` of ``toxic + clean`` at a base rate
    (the first term bounds the sum well enough)."""
    n = toxic + clean
    pick = lgamma(n + 1) - lgamma(toxic + 1) - lgamma(clean + 1)
    return pick + toxic * log(rate) + clean * log(1 - rate)


def learn_patterns(sample: DataFrame) -> dict[tuple[int, str], float]:
    """Insult patterns and weights (log odds) from (text, toxic) rows."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return {}
    rate = toxic / (toxic + clean)
    least = max(2, int(log(CHANCE) / log(rate)) + 1)  # pure patterns need so many texts
    seen = sample.filter("toxic = 1").select("text").mapInArrow(_toxic_patterns, "size int, text binary, near long")
    varied = (
        seen.groupBy("size", "text")
        .agg(F.count(F.lit(1)).alias("docs"), F.count_distinct("near").alias("places"))
        .filter(F.col("places") >= least)
        .collect()
    )
    places = {(r["size"], bytes(r["text"])): r["places"] for r in varied}
    counted = (
        sample.filter("toxic = 0")
        .select("text")
        .mapInArrow(_count_patterns(list(places)), "size int, text binary, docs long")
        .groupBy("size", "text")
        .agg(F.sum("docs").alias("docs"))
        .collect()
    )
    others = {(r["size"], bytes(r["text"])): r["docs"] for r in counted}
    good = {}
    for (size, text), k in places.items():
        c = others.get((size, text), 0)
        odds = log((k + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1))
        if odds > MIN_ODDS and _tail(k, c, rate) < log(CHANCE):
            good[size, text.decode(errors="surrogateescape")] = odds
    return dict(sorted(good.items(), key=lambda x: (-x[1], x[0])))


def _features(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = grammar.tables()
        for batch in batches:
            for a, b, data, offsets in V.blocks(batch.column(0)):
                sums = text_sums(data, offsets, grammar, tables)
                rest = [batch.column(i).slice(a, b - a) for i in range(1, batch.num_columns)]
                names = [*batch.schema.names[1:], *SUMS]
                yield pa.RecordBatch.from_arrays([*rest, *(pa.array(c) for c in sums.T.copy())], names)

    return run


def _kind(columns: str) -> str:
    return columns + ", " + ", ".join(f"{s} double" for s in SUMS)


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Newton steps for a logistic model drawn towards ``prior``."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = prior.copy()
    pull = np.full(len(w), strength)
    pull[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


PRIOR = _prior()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """The grammar's patterns and model from labelled rows that are not held out."""
    known = labels.filter(~held_out(id_col) & F.col("toxic").isin(0, 1)).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(MAX_TRAIN)
    sample = (
        docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(chosen, id_col)
        .groupBy(id_col)
        .agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
        .select("text", "toxic")
    )
    sample = Folder(docs.sparkSession, "toxicity").keep(sample, "sample")
    grammar = Grammar(learn_patterns(sample), PRIOR.tolist())
    rows = sample.select("text", "toxic").mapInArrow(_features(grammar), _kind("toxic int")).toPandas()
    if rows["toxic"].nunique() == 2:
        x = np.log1p(rows[list(SUMS)].to_numpy())
        grammar.model = fit_logistic(x, rows["toxic"].to_numpy().astype(float), PRIOR).tolist()
    return grammar


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted and the document's sums."""
    ship_library(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    sums = rows.mapInArrow(_features(grammar), _kind("doc_id long"))
    total = F.lit(grammar.model[-1])
    for name, weight in zip(SUMS, grammar.model, strict=False):
        total = total + weight * F.log1p(name)
    scored = sums.withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        *SUMS,
    )


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from ``labels`` (id, toxic) and score every row of ``docs``."""
    return score(docs, learn(docs, labels, id_col, text_col), id_col, text_col)
