"""Charset detection, reachability and content checksums."""

import codecs
import random

import pytest
from pyspark.sql import functions as F

from lakeward.plans import contract, governance
from lakeward.sources import bundles, charsets

PROSE = {
    "fr": "L'été dernier, la fenêtre était restée ouverte et le garçon dînait à l'hôtel où naît la Loire.",
    "de": "Die Prüfung der Straße läuft schon länger als geplant, sagte der Bürgermeister größerer Städte.",
    "es": "El niño comió una piña mañana después de la reunión en la montaña; ¿cuándo volverá a jugar?",
    "pt": "A licitação não contém observações; a relação de órgãos públicos está disponível até amanhã.",
    "caps": "A RELAÇÃO DE ÓRGÃOS PÚBLICOS NÃO ESTÁ DISPONÍVEL ATÉ AMANHÃ, SEGUNDO O MINISTÉRIO.",
}
RUSSIAN = "Съешь же ещё этих мягких французских булок, да выпей чаю. Широкая электрификация губерний."


@pytest.mark.parametrize("charset", ["utf-8", "utf-16-le", "utf-16-be", "cp1252", "cp850"])
@pytest.mark.parametrize("lang", PROSE)
def test_latin_prose_comes_back(lang, charset):
    name, text = charsets.decode(PROSE[lang].encode(charset))
    assert text == PROSE[lang] and name == charset


@pytest.mark.parametrize("charset", ["utf-8", "utf-16-le", "utf-16-be", "cp1251", "koi8-r", "cp866"])
def test_cyrillic_prose_comes_back(charset):
    assert charsets.decode(RUSSIAN.encode(charset)) == (charset, RUSSIAN)


@pytest.mark.parametrize("charset", ["cp1252", "cp850", "utf-16-le"])
def test_short_cells_of_a_report(charset):
    """Lines of a CSV, a few words each: nearly all come back."""
    rng = random.Random(2)
    words = " ".join(PROSE.values()).replace(",", "").split()
    lines = [";".join(rng.choices(words, k=6)) + ";12,5\r\n" for _ in range(300)]
    right = sum(charsets.decode(x.encode(charset))[1] == x for x in lines)
    assert right >= (300 if charset == "utf-16-le" else 290)


def test_marks_decide_and_are_no_text():
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_BE, "utf-16-be"), (codecs.BOM_UTF32_LE, "utf-32-le")):
        assert charsets.decode(mark + "é;b".encode(name)) == (name, "é;b")


def test_odd_payloads():
    assert charsets.decode(b"") == ("utf-8", "")
    assert charsets.decode(b"plain ascii, 1;2") == ("utf-8", "plain ascii, 1;2")
    assert charsets.decode("日本語のテキスト".encode()) == ("utf-8", "日本語のテキスト")
    assert "\ufffd" in charsets.decode(b"\xff\xff\x81 \x8d")[1] or charsets.decode(b"\xff\xff\x81 \x8d")[0] in charsets.CODE_PAGES
    assert bundles.decode_payload(b" \n ") is None and bundles.decode_payload(None) is None
    assert bundles.decode_payload("a;ção\n".encode("utf-16-le")) == "a;ção\n"


def test_payloads_of_a_frame(spark):
    rows = [(1, "x", bytearray(PROSE["pt"].encode("cp1252"))), (2, None, None), (3, "z", bytearray(b""))]
    df = spark.createDataFrame(rows, "id long, text string, payload binary")
    got = {r.id: (r.charset, r.text) for r in charsets.decode_payloads(df).collect()}
    assert got == {1: ("cp1252", PROSE["pt"]), 2: (None, None), 3: ("utf-8", "")}
    assert charsets.decode_payloads(df.limit(0)).columns == ["id", "charset", "text"]


# -------------------------------------------------------------- reachability


@pytest.mark.parametrize("seed", [1, 2])
def test_reachability_against_a_search(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{k}" for k in range(40)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(55)]  # cycles and loops among them
    edges += [("hub", n) for n in nodes[:20]] + [(None, "n1"), ("n1", None)] + edges[:5]
    roots = ["n0", "hub", "alone", "n0", None]
    depth = {r: 0 for r in roots if r}
    ahead = list(depth)
    while ahead:
        ahead = sorted({d for s, d in edges if s in ahead and d and d not in depth})
        step = max(depth.values()) + 1
        depth.update(dict.fromkeys(ahead, step))
    graph = spark.createDataFrame(edges, "src string, dst string").repartition(3)
    start = spark.createDataFrame([(r,) for r in roots], "node string")
    assert {(r.node, r.depth) for r in governance.reachable_from(spark, graph, start).collect()} == set(depth.items())
    assert governance.reachable_from(spark, graph, start.limit(0)).collect() == []


# ------------------------------------------------------------------ checksums


def test_checksums_see_content_and_not_order(spark):
    rows = [(1, "a", None), (2, None, 0.5), (2, None, 0.5), (None, "", 1.0)]
    df = spark.createDataFrame(rows, "i int, s string, d double")
    assert contract.same_content(df, df.orderBy(F.desc("i")).repartition(3))
    assert contract.same_content(df, df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))
    for other in (
        rows[:-1],  # a row lost
        [*rows, rows[1], rows[1]],  # one twice more
        [(1, None, None), *rows[1:]],  # a null for a text
        [*rows[:3], (None, None, 1.0)],  # a null for an empty text
        [(1, "a", None), (2, "0.5", None), *rows[2:]],  # a value in another column
    ):
        assert not contract.same_content(df, spark.createDataFrame(other, "i int, s string, d double"))
    assert contract.same_content(df.limit(0), df.filter("i > 5"))


def test_checksums_of_files_add_up(spark, tmp_root):
    spark.range(100).withColumn("v", F.col("id") * 2).repartition(4).write.parquet(f"{tmp_root}/x")
    df = spark.read.parquet(f"{tmp_root}/x")
    files = contract.content_checksum(df, ["id", "v"], [F.col("_metadata.file_path").alias("file")]).collect()
    whole = contract.content_checksum(df).first()
    assert len(files) == 4 and sum(r.n_rows for r in files) == whole.n_rows == 100
    mixed = 0
    for r in files:
        mixed ^= r.mixed
    assert (sum(r.total for r in files), mixed) == (whole.total, whole.mixed)
