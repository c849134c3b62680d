"""Alignment, collocations and page extraction against brute force: nulls,
empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import bisect
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeward.llm import alignment, collocations, extraction
from lakeward.llm.tokens import vocabulary_path

from .test_corpus import corpus, found

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    " ", "  ", "a  ", "  a", "a\n b", "\n\nx \n", "tab\there  x\t y", "é\xa0 x à b　 c", "a\x00 b", "▁x y", "x<|endoftext|> y",
    "<s> </s> <0x41>", "🙂 x ﬁ 日本語 です", "don't  we'll\r\nx;\r\n", "a\x85 b\x1c c", "same words same words",
]


def vocabularies():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))


def spelled(a, b, text):
    """(ids, bytes) of both sides by the libraries alone, token by token."""
    letters = {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for k, byte in enumerate([*plain, *(x for x in range(256) if x not in plain)]):
        letters[chr(byte) if k < len(plain) else chr(256 + k - len(plain))] = byte
    ia = a.encode(" " + text, add_special_tokens=False).ids
    ib = b.encode(text)
    ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
    bb = []
    for i in ib:
        piece = b.id_to_piece(i)
        bb.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    return ia, ba, ib, bb


def brute_alignment(texts):
    a, b = vocabularies()
    docs, links = [], Counter()
    for text in texts:
        ia, ba, ib, bb = spelled(a, b, text) if text else ([], [], [], [])
        if not text or b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            docs.append(None)
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        cuts = sorted(set(ea) & set(eb))
        groups = [([], []) for _ in cuts]
        for side, (ids, ends) in enumerate(((ia, ea), (ib, eb))):
            for i, e in zip(ids, ends, strict=True):
                groups[bisect.bisect_left(cuts, e)][side].append(str(i))
        shown = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        sa, sb = [0, *ea[:-1]], [0, *eb[:-1]]
        own, first = [], 0
        for i in range(len(ia)):
            while eb[first] <= sa[i]:
                first += 1
            j = first
            while j < len(ib) and sb[j] < ea[i]:
                own.append((ia[i], ib[j]))
                j += 1
        links.update(own)
        docs.append((len(ia), len(ib), len(cuts), own, hashlib.sha256(shown.encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_best = sum(links[p] == best[p[1]] for p in d[3])
        out.append((*d[:3], len(d[3]), n_best, sum(links[p] for p in d[3]), d[4]))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    alphabet = " \n\taé ., 　あ\r\x85\x1fB1'"
    noise = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    return corpus() + [(100 + k, t) for k, t in enumerate([*ODD, *noise, "long " * 30000, "x" * 50000])]


def frame(spark, rows):
    kind = "doc_id long, text string, container int, planes string, pairs long"
    return spark.createDataFrame([(i, t, 1, "p", 2) for i, t in rows], kind).repartition(3)


@pytest.mark.parametrize("max_docs", [alignment.CONTAINER_DOCS, 7])
def test_alignment(spark, rows, max_docs):
    got = found(alignment.align(frame(spark, rows), max_docs=max_docs))
    want = Counter((i, *x) for (i, _), x in zip(rows, brute_alignment([t for _, t in rows]), strict=True))
    assert got == want


def test_alignment_of_nothing(spark, rows):
    assert alignment.align(frame(spark, rows).limit(0)).collect() == []
    assert [tuple(r) for r in alignment.align(frame(spark, [(1, None), (None, "")])).orderBy("doc_id").collect()] == [
        (None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")
    ]
    with pytest.raises(ValueError, match="at most"):
        alignment.containers(frame(spark, rows), max_docs=1 << 17)


def test_pair_counts(spark, rows):
    held = alignment.containers(frame(spark, rows), max_docs=9)
    counts = {(r.a, r.b): (r.docs, r.links, r.best) for r in alignment.pair_counts(held).collect()}
    a, b = vocabularies()
    docs, links = Counter(), Counter()
    for _, t in rows:
        if not t or "▁" in t:
            continue
        ia, ba, ib, bb = spelled(a, b, t)
        ea, eb = np.cumsum([len(x) for x in ba]), np.cumsum([len(x) for x in bb])
        own = Counter()
        for i in range(len(ia)):
            lo = int(np.searchsorted(eb, ea[i] - len(ba[i]), "right"))
            hi = int(np.searchsorted(eb - [len(x) for x in bb], ea[i], "left"))
            own.update((ia[i], ib[j]) for j in range(lo, hi))
        docs.update(own.keys())
        links.update(own)
    most = defaultdict(int)
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    assert counts == {p: (docs[p], n, n == most[p[1]]) for p, n in links.items()}


def test_planes_round_trip():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 50 * 65536, 4000))
    times = rng.choice([1, 2, 3, 4, 700], len(keys))
    blob = alignment.write_planes(keys >> 16, keys & 65535, times, 60)
    back = Counter()
    for plane, (pair, doc) in enumerate(alignment.read_planes(blob, 60)):
        for p, d in zip(pair.tolist(), doc.tolist(), strict=True):
            back[p, d] += 1 << plane
    assert back == Counter({(int(k >> 16), int(k & 65535)): int(t) for k, t in zip(keys, times, strict=True)})


# ------------------------------------------------------------- collocations


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    f = {p: c for p, c in f.items() if c >= least}
    inside = set()
    for (lang, words), c in f.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                if 100 * c >= 80 * f[part]:
                    inside.add(part)
    by_lang = defaultdict(list)
    for (lang, words), a in f.items():
        if len(words) < 2 or (lang, words) in inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found_ in by_lang.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(found_)[:top])
    }


def phrase_rows():
    rng = random.Random(9)
    words = ["Der", "Hund", "ist", "gut", "é", "x\x0b", "a" * 300, "ﬁ", "😀", "zz", "B", "b\x1c"]
    texts = [" ".join(rng.choices(words[:6], k=rng.randint(1, 40))) + rng.choice([". ", ",\t", " ", "\n", ""]) for _ in range(300)]
    texts += ["new york city hall. " * 50, "new york, new york  new\tyork " * 40, None, "", " \t ", ". , !", "one word " * 20000]
    texts += [" ".join(rng.choices(words, k=12)) for _ in range(200)]
    langs = ["de", "en", None, "und", ""]
    return [(langs[k % 5], t) for k, t in enumerate(texts)] + [("de", texts[3])] * 4


@pytest.mark.parametrize(("least", "top", "shard"), [(30, 2000, 6 << 20), (2, 10**6, 4096), (5, 3, 1 << 16)])
def test_collocations(spark, least, top, shard):
    rows = phrase_rows()
    docs = spark.createDataFrame([(lang, t, 1, 2) for lang, t in rows], "lang string, text string, f int, words int").repartition(4)
    got = collocations.collocations(docs, least, top, shard_bytes=shard).collect()
    assert {tuple(r) for r in got} == brute_phrases(rows, least, top) and len(got) > 0


def test_collocations_of_nothing(spark):
    kind = "lang string, text string"
    assert collocations.collocations(spark.createDataFrame([], kind)).collect() == []
    assert collocations.collocations(spark.createDataFrame([("de", None), (None, "a b")], kind)).collect() == []


def test_many_ranges_merge_alike(spark, monkeypatch):
    rows = phrase_rows()[:300]
    monkeypatch.setattr(collocations, "RANGE_ENTRIES", 300)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = {tuple(r) for r in collocations.collocations(docs, 3, 10**6, shard_bytes=2048).collect()}
    assert got == brute_phrases(rows, 3, 10**6)


@pytest.mark.parametrize("bits", [1, 7, 17, 31, 32])
@pytest.mark.parametrize("size", [2, 3, 4])
def test_quotient_filters_lose_nothing(size, bits):
    rng = np.random.default_rng(size * 40 + bits)
    p = collocations.Permutation(size, bits)
    ids = [rng.integers(0, 1 << bits, 3000) for _ in range(size)]
    left, right, counts = collocations.counted(*p.keys(ids), None, p.right)
    assert int(counts.sum()) == 3000
    parts = min(5, 1 << p.left)
    bounds, back = collocations.range_bounds(p, parts), Counter()
    for k in range(parts):
        chosen = (left >= np.uint64(bounds[k])) & (left <= np.uint64(bounds[k + 1] - 1))
        big = counts[chosen] * 300
        f = collocations.QuotientFilter(p, bounds[k], bounds[k + 1])
        a, b, c = f.unpack(memoryview(f.pack(left[chosen], right[chosen], big)))
        assert (a == left[chosen]).all() and (b == right[chosen]).all() and (c == big).all()
        for row in zip(*(x.tolist() for x in p.ids(a, b)), (c // 300).tolist(), strict=True):
            back[row[:-1]] += row[-1]
    assert back == Counter(zip(*(x.tolist() for x in ids), strict=True))


# --------------------------------------------------------------- extraction

PAGES = [
    ("<article><p>a <b>b</b>c&amp;d&nbsp;e<br>f<p>g</article><p>x", "a bc&d e f\ng"),
    ("<body><nav>m</nav><p>x<p>y</p></body>", "x\ny"),
    ("<article><header><h1>T</h1><span>by</span><nav>n</nav></header><p>b</p><footer>f</footer><div class='comments'>c</div></article>", "T\nb"),
    ("<aside><article>only</article></aside>", "only"),
    ("<main><p>" + "long " * 30 + "</p><article class=teaser>t</article><article>u</article></main>", ("long " * 30).strip() + "\nu"),
    ("<nav><ul><li>a<article><p>T</article>", "T"),
    ("<article>a<script>if(a<b){'</p>'}</script>b<style>p{}</style></article>", "a\nb"),
    ("<article><span class='ad'><span>foo</span> bar</span>baz</article>", "baz"),
    ("<article><ul><li>1<li>2<ul><li>3</ul></ul>4 < 5 &am x &copy y &#233;&#x41;</article>", "1\n2\n3\n4 < 5 &am x © y éA"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<article class='post comments-open category-advertising'>k</article>", "k"),
    ("<form id=f><article>z</article></form>", "z"),
    ("<article>a<!-- x --><![CDATA[q]]><?php ?>b<div", "ab"),
    ("<div id='header'>h</div><div id='content'><p>c</p></div><div class='sidebar-left'>s</div><div role='contentinfo'>i</div>", "c"),
    ("<article><p>one</p></div></section></b><p>two</p></article>", "one\ntwo"),
    ("<ARTICLE><P>Up &LT; case</P></ARTICLE><FOOTER>f</FOOTER>", "Up < case"),
    ("<article><pre>a\n  b</pre><blockquote>q<p>r</blockquote><select><option>o</select><textarea><p>t</textarea></article>", "a b\nq\nr"),
    ("<section class='comments'><article>reader</article></section><article>text</article>", "text"),
    ("<body class='has-sidebar no-comments'><p>kept</p></body>", "kept"),
    ("", ""), (None, ""), ("<", "<"), ("plain  text", "plain text"), ("<article></article>", ""),
    ("<div>" * 30000 + "deep</p></span></section>" + "</div>" * 30000, "deep"),
    ("<article>" + "<p>w</p>" * 20000 + "</article>", "\n".join(["w"] * 20000)),
]


def test_extraction_of_odd_pages(spark):
    rows = [(k, f"http://host{k}.example/", page, "x", "y") for k, (page, _) in enumerate(PAGES)]
    rows += [rows[0], (None, None, PAGES[0][0], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, tree string").repartition(3)
    got = found(extraction.extract(pages))
    want = Counter((k, f"http://host{k}.example/", text) for k, (_, text) in enumerate(PAGES))
    want[0, "http://host0.example/", PAGES[0][1]] += 1
    want[None, None, PAGES[0][1]] += 1
    assert got == want
    assert extraction.extract(pages.limit(0)).collect() == []


def site(k, body, side="Subscribe to our letter"):
    return f"<body><div class='x'><p>{side}</p></div><div class='y'><h2>Title {k}</h2>{body}</div><div class='z'>All rights</div></body>"


def test_the_tree_removes_what_the_pages_of_a_host_share(spark):
    """No element or name declares anything here."""
    rng = random.Random(1)
    words = lambda: " ".join(rng.choices("abcdefgh", k=30))
    bodies = [f"<p>{words()}</p><div class='share'>Share this</div><p>{words()}</p>" for _ in range(12)]
    rows = [(k, "https://news.example/" + str(k), site(k, b)) for k, b in enumerate(bodies)]
    # copies of one page count once, so they make no text a part of the template
    rows += [(100 + k, f"https://copies.example/{k}", site(0, bodies[0])) for k in range(30)]
    rows += [(200, "https://alone.example/", site(0, bodies[0]))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    for k, body in enumerate(bodies):
        paragraphs = re.findall("<p>(.*?)</p>", body)
        assert got[k] == "\n".join([f"Title {k}", *paragraphs])
    whole = ["Subscribe to our letter", "Title 0", *re.findall("<p>(.*?)</p>", bodies[0]), "All rights"]
    # "share" is a name that tells, whatever the host's size
    assert got[100] == got[129] == got[200] == "\n".join(whole)


def test_entropies_of_a_tree(spark):
    """Importance by the definition, from the pages' own elements."""
    bodies = ["<p>a</p>", "<p>b</p><ul><li>c</ul>", "<p>d</p>", "<p>e</p>"]
    pages = spark.createDataFrame([(k, "http://h.example/", site(k, b, side=f"s{k % 2}")) for k, b in enumerate(bodies)], "page_id long, url string, html string")
    tree = {x.path: (x.presentation, x.content, x.styles) for x in extraction.style_trees(pages).first().tree}
    looks = extraction.Looks()
    read = [extraction.Page(site(k, b, side=f"s{k % 2}"), looks).nodes() for k, b in enumerate(bodies)]
    for path in set().union(*read):
        there = [nodes[path] for nodes in read if path in nodes]
        if len(there) == 1:
            assert path not in tree
            continue
        value = []
        for kind in (0, 1):
            p = np.array(list(Counter(x[kind] for x in there).values())) / len(there)
            value.append(float(-(p * np.log(p)).sum() / np.log(len(there))))
        if min(value) < 1 - 1e-12:
            got = tree[path]
            assert abs(got[0] - value[0]) < 1e-9 and abs(got[1] - value[1]) < 1e-9
            assert got[2] == len({x[0] for x in there})
