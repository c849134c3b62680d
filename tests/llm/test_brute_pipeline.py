"""Quality verdicts, shard placement, packing of hot ids and the pipeline from
end to end, each against a brute-force version of its own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from lakeward.llm import packing, quality, sharding, texts, token_files
from lakeward.llm.tokens import vocabulary_path

SPACES = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KIND = "doc_id long, text string, lang string, source string, n_chars int, slot int, shard string, words string, of string"


# ------------------------------------------------------------------ quality


def features(text, lang):
    text = text or ""
    words = re.findall(SPACES, text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    kinds = [r"[A-Z]", r"[0-9]", r"[\x20\x09-\x0D]", r"[!-/:-@\[-`{-~]", r"[^\x00-\x7f]"]
    classes = shares = None
    if len(text) >= 200:
        classes = [len(re.findall(k, text)) / len(text) for k in kinds]
        classes.append(1 - sum(classes))
    listed = quality.COMMON_WORDS.get(lang)
    common = None
    if listed and words:
        low = Counter(w.lower() for w in words)
        common = sum(low[w] for w in listed) / len(words)
        if len(words) >= 50:
            shares = [low[w] / len(words) for w in listed]
            shares.append(1 - sum(shares))
    return failed, classes, shares, common


def distance(p, q):
    if p is None or q is None:
        return None
    total = 0.0
    for a, b in zip(p, q, strict=True):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a > 0 else 0) / 2 + (b * math.log2(b / m) if b > 0 else 0) / 2
    return math.sqrt(max(total, 0))


def brute_quality(rows):
    """(failed, class distance, word distance, kept) of each (text, lang)."""
    found = [features(*r) for r in rows]
    parts = defaultdict(lambda: ([], []))
    for (_, lang), (failed, classes, shares, common) in zip(rows, found, strict=True):
        if not failed and (common is None or common >= 0.05):
            for held, value in zip(parts[lang], (classes, shares), strict=True):
                if value is not None:
                    held.append(value)
    means = {lang: [list(np.mean(h, axis=0)) if h else None for h in both] for lang, both in parts.items()}
    out = []
    for (_, lang), (failed, classes, shares, _) in zip(rows, found, strict=True):
        by_class, by_word = means.get(lang, (None, None))
        far, off = distance(classes, by_class), distance(shares, by_word)
        limit = distance([0.0] * 12 + [1.0], by_word)
        odd = (far or 0) > 0.31 or (off is not None and off > 0.975 * limit)
        out.append((failed, far, off, not failed and not odd))
    return out


def prose(rng, lang, n):
    made = ["".join(rng.choices("abcdefgeiou", k=rng.randint(2, 7))) for _ in range(n)]
    for k in range(n):
        if rng.random() < 0.3:
            made[k] = rng.choice(quality.COMMON_WORDS.get(lang, ["x"]))
    return " ".join(made) + "."


def quality_rows():
    rng = random.Random(8)
    rows = []
    for lang in ("en", "de", "fr", "es", None, "xx"):
        rows += [(prose(rng, lang, rng.choice([5, 30, 60, 200])), lang) for _ in range(14)]
        rows += [("".join(rng.choices("#$%*", k=400)) + " " + prose(rng, lang, 20), lang)]
        rows += [(" ".join("q" + "".join(rng.choices("wxyz", k=5)) for _ in range(90)), lang)]  # no common word
        rows += [("1234567890 " * 40, lang), (prose(rng, lang, 8) * 12, lang), ("LOUD " + prose(rng, lang, 60).upper(), lang)]
    return rows + [(None, "en"), ("", "de"), (" \n", None), ("long " * 4 + prose(rng, "en", 20000), "en"), rows[0], rows[0]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 3, 4, "x", "y", "z") for i, t, lang in rows], KIND).repartition(3)


def test_quality_verdicts(spark):
    rows = quality_rows()
    docs = frame(spark, [(k, t, lang) for k, (t, lang) in enumerate(rows)])
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    want = brute_quality(rows)
    assert len(got) == len(rows) and len({w[3] for w in want}) == 2
    for k, (failed, far, off, kept) in enumerate(want):
        r = got[k]
        assert (r.base_failed, r.kept) == (failed, kept), rows[k]
        for mine, theirs in ((far, r.class_distance), (off, r.word_distance)):
            assert (mine is None) == (theirs is None) and (mine is None or abs(mine - theirs) < 1e-9)


# ----------------------------------------------------------------- sharding


@pytest.mark.parametrize("weights", [None, {"b": 3, "d": 2}])
def test_the_table_is_filled_by_turns(weights):
    shards, slots = ("a", "b", "c", "d", "e"), 101
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    wishes = {
        s: [(number("offset:" + s) + j * (number("step:" + s) % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards
    }
    assert all(sorted(w) == list(range(slots)) for w in wishes.values())  # each is a permutation
    turns = [s for s in shards for _ in range((weights or {}).get(s, 1))]
    owner = {}
    while len(owner) < slots:
        for s in turns:
            slot = next((x for x in wishes[s] if x not in owner), None)
            if slot is not None:
                owner[slot] = s
    assert [shards[k] for k in sharding.fill_table(shards, slots, weights)] == [owner[x] for x in range(slots)]


def test_placement_of_odd_keys(spark):
    docs = frame(spark, [(k, "t", "en") for k in [1, 2, None, None, 2, 2**62]])
    got = [(r.doc_id, r.slot, r.shard) for r in sharding.place(docs).collect()]
    table = sharding.fill_table(sharding.SHARDS, sharding.SLOTS)
    for doc, slot, shard in got:
        assert slot == int(hashlib.md5(("" if doc is None else str(doc)).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert shard == sharding.SHARDS[table[slot]]
    assert len(got) == 6 and sharding.place(docs.limit(0)).collect() == []
    assert "words" in sharding.place(docs).columns


# ------------------------------------------------------- hot ids, empty texts


def test_hot_ids_and_empty_texts_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 500)
    rows = [(None, "", "en")] * 3000 + [(7, "same text again", "en")] * 1500 + [(k, f"text {k}", "en") for k in range(1500)]
    docs = frame(spark, rows)
    got = packing.piece_digests(packing.pack(docs)).toPandas()
    assert len(got) == 6000
    groups = Counter((got.sequence_id.to_numpy() >> 32).tolist())
    assert len(groups) >= 10 and max(groups.values()) < 2 * 6000 / len(groups) + 100
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 2048 and list(g.offset) == list(g.length.cumsum() - g.length)


def test_token_files_of_hot_ids(spark, tmp_path):
    rows = [(None, "null again", "en")] * 900 + [(5, f"five {k}", "en") for k in range(900)] + [(k, "x", "en") for k in range(900)]
    path = str(tmp_path / "files")
    token_files.write_token_files(frame(spark, rows), path)
    sizes = {r["part"]: r["count"] for r in spark.read.parquet(path).groupBy("part").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "count").collect()}
    assert len(sizes) > 4 and max(sizes.values()) < 2.5 * sum(sizes.values()) / len(sizes)
    got = sorted(((r.start, r.n_tokens, r.doc_id) for r in token_files.read_documents(spark, path).collect()))
    assert [s for s, _, _ in got] == list(np.cumsum([0, *(n for _, n, _ in got)])[:-1])
    ids = [d for _, _, d in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0)) and Counter(ids) == Counter(r[0] for r in rows)


def test_filters_grow_with_their_keys_up_to_a_bound(spark):
    assert texts.filter_blocks(0) == 64 and texts.filter_blocks(10**6) == 31250
    assert texts.filter_blocks(10**7) == texts.MAX_BLOCKS and texts.filter_blocks(10**8) == 0
    rows = spark.range(1000).withColumnRenamed("id", "k")
    marked = texts.mark_possible(rows, rows.filter("k < 100"), ["k"])
    assert marked.filter("k < 100 AND NOT __possible").count() == 0 and marked.filter("k >= 100 AND __possible").count() < 30


# ----------------------------------------------------------------- pipeline


def brute_pipeline(rows, bench):
    """Pieces (doc_id, piece, start, length, crc) of what the stages leave."""
    kept = [r for r, q in zip(rows, brute_quality([(t, lang) for _, t, lang in rows]), strict=True) if q[3]]
    sets = []
    for _, t, _ in kept:
        w = re.findall(SPACES, t.translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    group = list(range(len(kept)))
    for i, s in enumerate(sets):
        for j in range(i):
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for k, g in enumerate(group):
        rank = (kept[k][0] is None, kept[k][0] or 0, k)
        best[g] = min(best.get(g, rank), rank)
    kept = [kept[b[2]] for b in best.values()]
    words = [re.findall(SPACES, t) for _, t, _ in kept]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    left = []
    for w in words:
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        left.append(" ".join(x for i, x in enumerate(w) if i not in gone))
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = set()
    for t in bench:
        w = cut(t)
        n = min(13, len(w))
        grams |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1 if n else 0)}
    from tokenizers import Tokenizer

    library, out = Tokenizer.from_file(vocabulary_path()), Counter()
    for (doc, _, _), t in zip(kept, left, strict=True):
        w, hit = cut(t), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
        if hit and 20 * len(hit) >= len(w):
            continue
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            out[doc, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())] += 1
    return out


def pipeline_rows():
    rng = random.Random(12)
    rows = [(k, t, lang) for k, (t, lang) in enumerate(quality_rows())]
    lang = "en"
    passage, item, base = (prose(rng, lang, n) for n in (50, 40, 150))
    near = base.split()
    near[70] = "other"
    at = 1000
    for t in (
        base, " ".join(near), base, base.upper(), prose(rng, lang, 80) + "\n" + passage, passage + " " + prose(rng, lang, 90),
        prose(rng, lang, 60) + " " + item, prose(rng, lang, 3000) + " " + " ".join(item.split()[:13]), prose(rng, lang, 9000),
    ):
        rows.append((at, t, lang))
        at += 1
    clean = prose(rng, lang, 120)
    # a repeated row; an id with two texts; a null id beside a named near copy
    rows += [(2000, clean, lang)] * 3 + [(1000, prose(rng, lang, 70), lang), (None, base + " end", lang), (None, prose(rng, lang, 75), lang)]
    return rows, [item, None, "", "two words"]


def run_pipeline(spark, folder, rows, bench):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, folder).toPandas()


def test_the_pipeline_end_to_end(spark, tmp_path):
    rows, bench = pipeline_rows()
    got = run_pipeline(spark, str(tmp_path), rows, bench)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    none = got.doc_id.astype(object).where(got.doc_id.notna(), None)
    want = brute_pipeline(rows, bench)
    assert Counter(zip(none, *(got[c] for c in columns[1:]), strict=True)) == want
    assert any(k[1] > 0 for k in want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 2048 and list(g.offset) == list(g.length.cumsum() - g.length)


def test_the_pipeline_of_nothing(spark, tmp_path):
    assert len(run_pipeline(spark, str(tmp_path), [], ["x"])) == 0
