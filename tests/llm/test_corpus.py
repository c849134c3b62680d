"""Corpus operators against brute force on small fixtures and the smallest
tables: nulls, empty and long texts, ties, repeated rows, empty tables, and
extra columns with clashing names."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from lakeward.llm import decontamination, jaccard, packing, quality, sharding, substrings, suffixes, token_files, toxicity, urls
from lakeward.llm.tokens import vocabulary_path

SF = "/root/testdata/sf0.001"
SPACES = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgéß", k=rng.randint(2, 7)))
    prose = lambda n: " ".join(word() + rng.choice(["", "", ".", ","]) for _ in range(n))
    passage, base = prose(60), prose(120)
    near = base.split()
    near[50] = "other"
    texts = [None, "", " \n\t ", "One two.", base, base, " ".join(near), "x" * 900, "ab" * 400]
    texts += [prose(40) + "\n" + passage + "\n" + prose(30) for _ in range(3)]
    texts += [prose(rng.randint(1, 200)) for _ in range(20)] + [prose(6000), base.upper(), "a <|endoftext|> b"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[4], (None, base), (None, prose(50))]  # a repeated row, null ids


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame([(i, t, "en", "s", 7, 8, 9) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int, x1 int, block int")
    return frame.repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def found(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_word_repeats(docs, rows, empty):
    words = [re.findall(SPACES, t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = Counter()
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert found(substrings.repeat_digests(docs)) == want
    assert substrings.repeat_digests(empty).collect() == []
    cut = substrings.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)


def test_byte_repeats(docs, rows, empty):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    want = Counter()
    for (doc, _), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(b)])) if b else 0
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        want[doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert found(suffixes.repeat_digests(docs)) == want
    assert suffixes.repeat_digests(empty).collect() == []


def test_jaccard_components(docs, rows, empty):
    sets = []
    for _, t in rows:
        w = re.findall(SPACES, (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    names = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        names[find(i)].append(doc)
    want = Counter()
    for i, (doc, _) in enumerate(rows):
        known = [d for d in names[find(i)] if d is not None]
        want[doc, len(sets[i]), min(known) if known else None] += 1
    got = jaccard.similar_documents(docs).select("doc_id", "n_shingles", "component_id")
    assert found(got) == want
    assert jaccard.similar_documents(empty).collect() == []


def test_jaccard_counts_all_links(spark, monkeypatch):
    rng = random.Random(3)
    words = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    base, texts = words(120), []
    for k in range(25):  # one component in which many pairs do not link
        t = list(base)
        for at in range(0, k % 5):
            t[7 + 20 * at + k % 3] = f"x{k}"
        texts.append(" ".join(t))
    texts += [texts[0], texts[0], texts[7], " ".join(words(40)), "", "", None]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in ((t or "").split() for t in texts)]
    link = lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
    want = {i: sum(link(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}
    assert len(set(want.values())) > 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for size in (1024, 4):  # one block, and several
        monkeypatch.setattr(jaccard, "BLOCK_TEXTS", size)
        got = jaccard.similar_documents(docs).select("doc_id", "n_links").collect()
        assert len(got) == len(texts) and dict(map(tuple, got)) == want


def test_near_duplicates_keeps_one_row_a_group(spark):
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    swapped = lambda t, w: " ".join([*t.split()[:50], w, *t.split()[51:]])
    clean, a, b, c, d, lone, shared = (prose(100) for _ in range(7))
    rows = [(1, clean), (1, clean)]  # repeated rows
    rows += [(2, a), (3, swapped(a, "x")), (3, shared)]  # id 3 carries an unrelated text as well
    rows += [(4, b), (None, swapped(b, "x")), (None, lone)]  # only one null id is in a group
    rows += [(None, c), (None, swapped(c, "x")), (None, swapped(c, "y")), (None, c)]  # no id at all
    rows += [(5, d), (5, swapped(d, "x"))]  # one id, two near copies
    rows += [(6, ""), (6, ""), (None, " \n"), (None, " \n"), (7, None)]  # no words
    names = "doc_id long, text string, lang string, source string, n_chars int, place int"
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", 7, k) for k, (i, t) in enumerate(rows)], names)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in ((t or "").split() for _, t in rows)]
    group = list(range(len(rows)))
    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF).collect()]
    at = sorted(r[5] for r in got)
    assert all(r[:2] == rows[r[5]] and r[3] == f"s{r[5]}" for r in got)
    assert [k for k in at if not sets[k]] == [k for k, s in enumerate(sets) if not s]
    assert sorted(group[k] for k in at if sets[k]) == sorted({g for g, s in zip(group, sets, strict=True) if s})
    for k in at:
        ids = [rows[j][0] for j in range(len(rows)) if sets[k] and group[j] == group[k] and rows[j][0] is not None]
        assert rows[k][0] == min(ids, default=rows[k][0])
    # a clean document that was repeated is whole after the next stage
    kept = spark.createDataFrame(got, names)
    assert {r["text"] for r in corpus_pipeline.repeated_passages(spark, kept, SF).collect()} >= {clean, lone, shared}


def test_decontamination(spark, docs, rows, empty):
    items = [(1, rows[10][1]), (2, "One two."), (3, None), (4, "..."), (1, rows[10][1])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = defaultdict(set)
    for i, t in items:
        w = cut(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[k : k + n])].add(str(i))
    want = Counter()
    for doc, t in rows:
        w, hit, names = cut(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    names |= grams[tuple(w[k : k + n])]
        want[doc, len(w), len(hit), ",".join(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    for size in (1 << 20, 300):  # one block, and several
        hits = decontamination.judged(decontamination.find_hits(docs, bench, block_bytes=size))
        got = hits.selectExpr("doc_id", "n_words", "n_hit", "array_join(items, ',')", "contaminated")
        assert found(got) == want
    assert decontamination.decontaminate(docs, bench, "spans").columns == docs.columns
    assert decontamination.decontaminate(empty, bench).collect() == []


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def test_token_files(spark, docs, rows, empty, library, tmp_path):
    token_files.write_token_files(docs, str(tmp_path / "a"), shard_tokens=500)
    got = token_files.read_documents(spark, str(tmp_path / "a")).collect()
    start, want = 0, Counter()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for doc, t in order:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[doc, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert Counter(tuple(r) for r in got) == want
    token_files.write_token_files(empty, str(tmp_path / "b"))
    assert token_files.read_documents(spark, str(tmp_path / "b")).collect() == []


def test_wavelet_matrix():
    ids = np.random.default_rng(3).integers(0, 300, 3000).astype(np.uint32)
    data = token_files.to_file(ids, np.array([5, 9]), np.array([True, True]), np.array([1000, 2000]))
    m, docs, named, sizes = token_files.from_file(data)
    assert (m.decode() == ids).all() and list(docs) == [5, 9] and named.all() and list(sizes) == [1000, 2000]
    for i in (0, 511, 512, 2999):
        assert m.access(i) == ids[i]
    for token in (0, 17, 299, 5000):
        where = np.flatnonzero(ids == token)
        assert m.count(token) == len(where) and m.rank(token, 1500) == (where < 1500).sum()
        assert [m.occurrence(token, k) for k in range(len(where))] == list(where)


def test_packing(docs, rows, empty, library):
    got = packing.piece_digests(packing.pack(docs, capacity=64)).toPandas()
    want = Counter()
    for doc, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 64):
            want[doc, k, zlib.crc32(ids[k : k + 64].tobytes())] += 1
    assert Counter(zip(got.doc_id.astype(object).where(got.doc_id.notna(), None), got.start, got.ids_crc32, strict=True)) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 64 and list(g.offset) == list(g.length.cumsum() - g.length)
    assert packing.pack(empty).collect() == []


def test_best_fit_is_close_to_the_bound():
    lengths = np.sort(np.random.default_rng(1).integers(1, 2049, 4000))[::-1].copy()
    sequence, _ = packing.best_fit(lengths)
    assert sequence.max() + 1 <= 1.03 * max(lengths.sum() / 2048, (lengths > 1024).sum())


def test_quality_rules(docs, rows, empty):
    want = Counter()
    for doc, t in rows:
        t = t or ""
        w = re.findall(SPACES, t)
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(SPACES, x)]
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        want[doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed] += 1
    got = quality.judge(docs)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert found(got.select(*columns)) == want
    assert got.filter("base_failed and kept").count() == 0 and quality.judge(empty).collect() == []


@pytest.mark.parametrize("n_junk", [4, 60])
def test_quality_references_are_not_shifted_by_junk(spark, n_junk):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("bcfghjklmnoprstu", k=6))
    listed = quality.COMMON_WORDS["de"]
    prose = [" ".join(rng.choice(listed) if rng.random() < 0.2 else word() for _ in range(150)) for _ in range(40)]
    junk = [" ".join(word() for _ in range(150)) for _ in range(n_junk)]  # passes the base rules
    again = [" ".join([word()] * 150) for _ in range(n_junk)]  # does not
    texts = prose + junk + again + ["kurz", None]
    docs = spark.createDataFrame([(i, t, "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert {i for i, r in got.items() if r["kept"]} == set(range(40))
    assert not any(got[i]["base_failed"] for i in range(40 + n_junk))


def test_url_filter(spark):
    pages = [(1, None), (2, "no scheme"), (3, "http://A.net/x"), (4, "https://www.Example.com/p/?utm_x=1&b=2#f"), (5, "http://ok.org/fr/a"), (6, "http://z.com")]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id int, url string, block int")
    listed = spark.createDataFrame([("http://example.com/p?b=2",), (None,)], "url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.filter_urls(frame, listed, blocks=1).collect()}
    assert got == {1: (None, "allow"), 2: (None, "allow"), 3: ("net/", "block"), 4: (None, "block"), 5: ("org/fr/", "allow"), 6: (None, "allow")}
    assert urls.filter_urls(frame.limit(0), listed).collect() == []


def test_sharding(docs, rows):
    table = Counter(sharding.fill_table(sharding.SHARDS))
    assert max(table.values()) - min(table.values()) <= 1
    fewer = sharding.fill_table(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(sharding.fill_table(sharding.SHARDS), fewer, strict=True))
    assert moved < 0.15 * sharding.SLOTS
    assert sharding.place(docs).count() == len(rows)


def test_toxicity_learns_and_ignores_held_out(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("bcdfgaeiou", k=6))
    rows = []
    for i in range(400):
        words = [word() for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(30)] = "zogfool"
        rows.append((i, " ".join(words) + ".", int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 402 and got[900]["predicted"] == 0
    assert sum(got[i]["predicted"] == y for i, _, y in rows) >= 390
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_transducers():
    t = toxicity
    sums = dict(zip(t.SUMS, t.clause_sums([t.NEGATION, t.OTHER, t.INSULT], [0, 0, 2.0]), strict=True))
    assert sums["insult_negated"] == 2.0 and sums["insult"] == 0
    sums = dict(zip(t.SUMS, t.clause_sums([t.REPORT, t.INSULT, t.TARGET], [0, 1.0, 0]), strict=True))
    assert sums["insult_reported_aimed"] == 1.0
    sums = dict(zip(t.SUMS, t.clause_sums([t.INSULT, t.TARGET, t.THREAT], [3.0, 0, 0]), strict=True))
    assert sums["insult_aimed"] == 3.0 and sums["threat_aimed"] == 1.0
    assert not any(t.clause_sums([t.THREAT, t.OTHER], [0, 0]))


def test_the_composed_machine_against_the_rules():
    """Every clause of up to five symbols, by the rules in words."""
    t = toxicity
    for n in range(1, 6):
        for clause in itertools.product(range(t.OTHER + 1), repeat=n):
            want = dict.fromkeys(t.SUMS, 0.0)
            for i, symbol in enumerate(clause):
                if symbol not in (t.INSULT, t.THREAT):
                    continue
                marks = [
                    t.NEGATION in clause[max(0, i - t.REACH) : i],
                    t.REPORT in clause[:i],
                    t.TARGET in clause,
                ]
                if symbol == t.INSULT or marks[2]:
                    name = "insult" if symbol == t.INSULT else "threat"
                    want["_".join([name, *(m for m, on in zip(t.MARKS, marks, strict=True) if on)])] += 1.0
            want["clauses"] = float(any(want.values()))
            assert dict(zip(t.SUMS, t.clause_sums(list(clause), [1.0] * n), strict=True)) == want


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "fool you", 5, "x"), (1, "fool you", 5, "x"), (2, "word " * 30000, 5, "x"), (None, "y", 5, "x"), (3, "other", 5, "x")],
        "doc_id long, text string, toxic int, insult string",
    )
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = [tuple(r)[:4] for r in toxicity.toxicity(docs, none).collect()]
    assert len(got) == 5 and len({r[2] for r in got}) == 1 and not any(r[1] for r in got if r[0] is None)
    # an id with two texts counts once, repeated labels too, unusable ones not at all
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 7), (3, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, labels).count() == 5


def test_pipeline_runs_end_to_end(spark):
    kept = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, before, SF)
        if name != "packed_sequences":
            assert kept.columns == before.columns and kept.count() <= before.count()
    got = kept.toPandas()
    assert len(got) and got.groupby("sequence_id").length.sum().max() <= 2048
