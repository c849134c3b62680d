"""Bad branches that once passed in silence."""

import codecs
import datetime as dt
import io
import zipfile

import pytest

from lakeward.plans import governance
from lakeward.sources import bundles, landing, messages, responses


def test_a_missing_status_is_not_a_good_response(spark):
    df = spark.createDataFrame([(None, '{"k":1}'), (None, None), (200, '{"k":2}')], "status int, body string")
    good, bad = responses.strict_payloads(df)
    assert good.count() == 1 and bad.count() == 2


def test_utf32_marks_come_before_utf16():
    for mark, name in ((codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be")):
        assert bundles.decode_payload(mark + "a;b".encode(name)).lstrip("\ufeff") == "a;b"


def test_unreadable_footers_fail_even_if_alike(spark, tmp_path):
    for name in ("a.parquet", "b.parquet"):
        (tmp_path / name).write_bytes(b"not a parquet file")
    files = [str(tmp_path / n) for n in ("a.parquet", "b.parquet")]
    for some in (files, files[:1]):
        with pytest.raises(ValueError, match="unreadable"):
            landing.assert_same_schema(spark, some)


def test_lineage_closure_is_whole_or_fails(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)], "src int, dst int")
    assert governance.lineage_closure(spark, edges).count() == 78
    with pytest.raises(ValueError, match="beyond 4"):
        governance.lineage_closure(spark, edges, max_depth=4)


def test_a_corrupt_mail_takes_no_rows_of_its_namesake(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("r.csv", "id;name\n1;x\n2;y\n")
    day = dt.date(2024, 1, 5)
    mails = [(day, "bot@gov.br", "Report", [("a.zip", raw)]) for raw in (buf.getvalue(), b"not a zip")]
    frame = spark.createDataFrame(
        mails, "date date, sender string, subject string, attachments array<struct<filename: string, payload: binary>>"
    )
    rows, rejected = messages.process_mailed_reports(frame, "bot@gov.br", "report", None, delimiter=";", target_date=day)
    assert sorted((r.id, r.name) for r in rows.collect()) == [("1", "x"), ("2", "y")]
    assert rejected.count() == 1
