"""Mailed bundles: ZIP/CSV extraction, charsets, skiprows, mapping, selection."""

import datetime as dt
import io
import zipfile

import pytest

from lakeward.sources import bundles, messages


def zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()


def frame(spark, payloads):
    return spark.createDataFrame(
        [(f"b{i}", i, p) for i, p in enumerate(payloads)], "bundle_id string, bundle_ordinal long, content binary"
    )


def test_decode_payload():
    assert bundles.decode_payload(b"  \n") is None
    assert bundles.decode_payload("olá".encode("utf-8")) == "olá"
    assert bundles.decode_payload("olá".encode("cp1252")) == "olá"
    assert bundles.decode_payload(b"\xef\xbb\xbfa,b") == "a,b"


def test_parse_csv_text_rules():
    header, rows = bundles.parse_csv_text("junk\nA,B,A\n1,NA,3\n\n4,5\n", skiprows=1)
    assert header == ["A", "B", "A.1"] and list(rows) == [["1", None, "3"], ["4", "5", None]]
    with pytest.raises(bundles.EmptyCsv):
        bundles.parse_csv_text("only\n", skiprows=1)


def test_zip_first_valid_member(spark):
    z = zip_bytes([
        ("notes.txt", "x,y\n1,2\n"),
        ("empty.csv", "   \n"),
        ("DATA.CSV", "a;b\n1;2\n3;4\n"),
        ("later.csv", "a;b\n9;9\n"),
    ])
    long_rows = bundles.extract_bundle_rows(frame(spark, [z]), "zip", {0: "a", 1: "b"}, delimiter=";")
    out = bundles.bundle_rows_to_frame(long_rows, {0: "a", 1: "b"})
    assert [(r.a, r.b) for r in out.orderBy("row_ordinal").collect()] == [("a", "b"), ("1", "2"), ("3", "4")]
    assert {r.member for r in long_rows.collect()} == {"DATA.CSV"}
    every = bundles.extract_bundle_rows(frame(spark, [z]), "zip", {0: "a"}, delimiter=";", all_members=True)
    assert {r.member for r in every.collect()} == {"DATA.CSV", "later.csv"}


def test_zip_skiprows_and_positional_names(spark):
    z = zip_bytes([("r.csv", "title line\nx,y,z\n1,2,3\n")])
    long_rows = bundles.extract_bundle_rows(frame(spark, [z]), "zip", {0: "a", 2: "c"}, skiprows=1)
    out = bundles.bundle_rows_to_frame(long_rows, {0: "a", 2: "c"})
    assert out.columns[-3:] == ["a", "col_1", "c"]
    assert [(r.a, r.col_1, r.c) for r in out.orderBy("row_ordinal").collect()] == [("x", "y", "z"), ("1", "2", "3")]


def test_header_mode_union_by_name(spark):
    long_rows = bundles.extract_bundle_rows(frame(spark, [b"a,b\n1,2\n", b"b,c\n3,4\n"]), "csv", None)
    out = bundles.bundle_rows_to_frame(long_rows, None)
    assert out.columns[-3:] == ["a", "b", "c"]
    got = sorted(((r.a, r.b, r.c) for r in out.collect()), key=str)
    assert got == sorted([("1", "2", None), (None, "3", "4")], key=str)


def test_rejected_bundles(spark):
    bad_zip = zip_bytes([("x.txt", "no csv")])
    long_rows = bundles.extract_bundle_rows(frame(spark, [bad_zip, b"not a zip"]), "zip", None)
    rej = {r.bundle_id: r.error for r in bundles.rejected_bundles(long_rows).collect()}
    assert rej["b0"] == "no valid CSV" and "BadZipFile" in rej["b1"]
    csv_rows = bundles.extract_bundle_rows(frame(spark, [b"   ", b"h\n"]), "csv", None, skiprows=1)
    assert {r.error for r in bundles.rejected_bundles(csv_rows).collect()} == {"no valid CSV"}


def test_read_bundle_files(spark, tmp_root):
    import os

    os.makedirs(f"{tmp_root}/in", exist_ok=True)
    with open(f"{tmp_root}/in/r.zip", "wb") as fh:
        fh.write(zip_bytes([("r.csv", "a\n1\n")]))
    b = bundles.read_bundle_files(spark, f"{tmp_root}/in")
    out = bundles.bundle_rows_to_frame(bundles.extract_bundle_rows(b, "zip", None), None)
    assert [r.a for r in out.collect()] == ["1"]


def mail(spark):
    att = lambda n, p: (n, p)
    data = [
        (dt.date(2024, 1, 5), "Reports <bot@gov.br>", "Relatorio Diario 05/01", [att("r.ZIP", b"z1"), att("x.pdf", b"p"), att(None, b"n")]),
        (dt.date(2024, 1, 5), "other@x.org", "Relatorio Diario", [att("r.zip", b"z2")]),
        (dt.date(2024, 1, 4), "bot@gov.br", "Relatorio Diario", [att("r.zip", b"z3")]),
        (dt.date(2024, 1, 5), "bot@gov.br", None, [att("r.csv", b"c1")]),
    ]
    return spark.createDataFrame(
        data, "date date, sender string, subject string, attachments array<struct<filename: string, payload: binary>>"
    )


def test_select_attachments_rules(spark):
    m = mail(spark)
    got = messages.select_attachments(m, "bot@gov.br", "relatorio diario", dt.date(2024, 1, 5)).collect()
    assert [bytes(r.payload) for r in got] == [b"z1"]
    by_suffix = messages.select_attachments(m, "bot@gov.br", "ignored", dt.date(2024, 1, 5), subject_suffix="05/01")
    assert by_suffix.count() == 1
    assert messages.select_attachments(m, "bot@gov.br", None, dt.date(2024, 1, 5), subject_suffix="diario").count() == 0
    csvs = messages.select_attachments(m, "bot@gov.br", "relatorio", dt.date(2024, 1, 5), ext="csv")
    assert csvs.count() == 0  # the csv message has no subject
    with pytest.raises(ValueError):
        messages.select_attachments(m, "bot@gov.br")


def test_process_mailed_reports(spark):
    z1 = zip_bytes([("a.csv", "skip me\n1,x\n2,y\n")])
    z2 = zip_bytes([("b.txt", "nothing")])
    m = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "bot@gov.br", "Relatorio", [("r1.zip", z1), ("r2.zip", z2)])],
        "date date, sender string, subject string, attachments array<struct<filename: string, payload: binary>>",
    )
    rows, rejected = messages.process_mailed_reports(m, "bot@gov.br", "relatorio", {0: "id", 1: "name"}, skiprows=1, target_date=dt.date(2024, 1, 5))
    assert sorted((r.id, r.name) for r in rows.collect()) == [("1", "x"), ("2", "y")]
    assert rejected.count() == 1


def test_bad_row_rejects_whole_bundle(spark):
    good = b"a,b\n1,2\n"
    bad = b"a,b\n1,2\n3,4,5\n"
    long_rows = bundles.extract_bundle_rows(frame(spark, [good, bad]), "csv", None)
    out = bundles.bundle_rows_to_frame(long_rows, None)
    assert [(r.bundle_id, r.a, r.b) for r in out.collect()] == [("b0", "1", "2")]
    assert [r.bundle_id for r in bundles.rejected_bundles(long_rows).collect()] == ["b1"]


def test_corrupt_member_rejects_only_its_bundle(spark):
    good = zip_bytes([("a.csv", "x\n1\n")])
    bad = bytearray(zip_bytes([("a.csv", "x\n" + "2\n" * 200)]))
    # flip bytes inside the stored member data to break its CRC
    pos = bad.find(b"2\n2\n")
    bad[pos:pos + 4] = b"9\n9\n"
    long_rows = bundles.extract_bundle_rows(frame(spark, [good, bytes(bad)]), "zip", None)
    out = bundles.bundle_rows_to_frame(long_rows, None)
    assert [(r.bundle_id, r.x) for r in out.collect()] == [("b0", "1")]
    assert [r.bundle_id for r in bundles.rejected_bundles(long_rows).collect()] == ["b1"]


def test_long_fields_are_kept(spark):
    long_text = "y" * 300_000
    long_rows = bundles.extract_bundle_rows(frame(spark, [f"a,b\n1,{long_text}\n".encode()]), "csv", None)
    out = bundles.bundle_rows_to_frame(long_rows, None).collect()
    assert len(out) == 1 and len(out[0].b) == 300_000


def test_skiprows_counts_only_real_line_ends():
    text = "title\x0cstill title\r\nsecond\rx,y\n1,2\n"
    header, rows = bundles.parse_csv_text(text, skiprows=2)
    assert header == ["x", "y"] and list(rows) == [["1", "2"]]
