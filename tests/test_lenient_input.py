"""Input that is not quite right: CSV lines, JSON bodies."""

import io
import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeward.session import SCALE_DEFAULTS
from lakeward.sources import bundles, responses

TEXTS = [
    "a,b\n1,2\n\n  \n\t\n3,4\n",  # blank lines, with white space or without
    "a\n1\n\n2\n",
    "a,b\nx,1,2\ny,3,4\n",  # one field more than names: a row label
    "a,b\nx,1,2\ny,3\nz\n",
    "a,b\n1,2,\n3,4,\n",  # a delimiter at the end of each row
    "a,b\nu,v,1,2\n",
    "a,b\n1\n2,3\n",
    "a,b\n",
    'a,b\n"",2\n',
]


@pytest.mark.parametrize("text", TEXTS)
def test_rows_as_pandas_reads_them(text):
    names, rows = bundles.parse_csv_text(text)
    want = pd.read_csv(io.StringIO(text), dtype=str)
    assert names == list(want.columns)
    assert list(rows) == [[None if pd.isna(v) else v for v in r] for r in want.itertuples(index=False, name=None)]


@pytest.mark.parametrize("text", ["a,b\n1,2\n1,2,3\n", "a,b\nx,1,2\n1,2,3,4\n"])
def test_a_longer_row_further_down_is_an_error(text):
    with pytest.raises(ValueError, match="fields"):
        list(bundles.parse_csv_text(text)[1])
    with pytest.raises(pd.errors.ParserError):
        pd.read_csv(io.StringIO(text))


def test_without_a_header_the_first_row_sets_the_width():
    assert list(bundles.parse_csv_text("1,2\n \n3\n", header=False)[1]) == [["1", "2"], ["3", None]]
    with pytest.raises(ValueError):
        list(bundles.parse_csv_text("1\n1,2\n", header=False)[1])


BODIES = [
    '{"a": NaN, "b": -Infinity, "c": "NaN"}', "[1, 2]", "5", " -1.5e3 ", '"text"', "true", "null", "NaN", '{"k": 1} x', "[1] [2]",
    "1] x", "1} x", '{"k": 1},2', "[1,", "{}", "[]", "x", '"a" "b"', '{"a": {"a": [1, {"a": null}]}}', "1,2", "12 3",
]


def test_bodies_as_a_json_reader_takes_them(spark):
    df = spark.createDataFrame([(i, 200, "application/json", b) for i, b in enumerate(BODIES)], "i int, status int, content_type string, body string")
    got = {r.i: r for r in responses.classify_responses(df).withColumn("j", F.to_json("payload")).collect()}
    for i, body in enumerate(BODIES):
        try:
            value = json.loads(body)
            assert got[i].kind == "json", body
            if value is not None and not (isinstance(value, float) and math.isnan(value)) and "NaN" not in body:
                assert json.loads(got[i].j) == value
        except json.JSONDecodeError:
            assert (got[i].kind, got[i].text) == ("invalid_json", body)
    numbers = responses.classify_responses(df).select(F.try_variant_get("payload", "$.b", "double").alias("b"))
    assert -math.inf in [r.b for r in numbers.collect()]


def test_of_repeated_keys_the_last_counts(spark):
    df = spark.createDataFrame([(200, "application/json", '{"a": 1, "b": 0, "a": 2}')], "status int, content_type string, body string")
    key = "spark.sql.variant.allowDuplicateKeys"
    assert SCALE_DEFAULTS[key] == "true"
    spark.conf.set(key, "true")
    try:
        row = responses.classify_responses(df).withColumn("j", F.to_json("payload")).first()
        assert row.kind == "json" and json.loads(row.j) == {"a": 2, "b": 0}
        assert responses.strict_payloads(df)[0].count() == 1
    finally:
        spark.conf.unset(key)
