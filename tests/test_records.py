"""Record projections: flatten, rename, sanitise, cast, combine, type."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from lakeward.functions import names
from lakeward.functions.text import iso_text, unique_index_name_col
from lakeward.operators import records
from lakeward.plans import tables


def test_flatten_order_and_depth(spark):
    d = spark.createDataFrame(
        [(1, {"q": 5, "r": {"s": "x"}}, ["a", "b"], "t")],
        "a long, z struct<q: long, r: struct<s: string>>, l array<string>, b string",
    )
    out = records.flatten(d)
    assert out.columns == ["a", "l", "b", "z__q", "z__r__s"]
    row = out.first()
    assert row.z__r__s == "x" and row.l == '["a","b"]'


def test_flatten_empty_struct_vanishes(spark):
    d = spark.createDataFrame([(1,)], "a long").withColumn("e", F.struct())
    assert records.flatten(d).columns == ["a"]


def test_flatten_json_discovers_union_of_keys(spark):
    d = spark.createDataFrame(
        [(1, '{"k": 1, "m": {"n": "x"}}'), (2, '{"k": 2, "o": true}'), (3, "not json")],
        "id long, props string",
    )
    out = records.flatten_json(d, "props")
    assert set(out.columns) == {"id", "props__k", "props__m__n", "props__o"}
    rows = {r.id: r for r in out.collect()}
    assert rows[1].props__m__n == "x" and rows[2].props__o == "true" and rows[3].props__k is None


def test_flatten_json_arrays_and_odd_keys(spark):
    d = spark.createDataFrame(
        [(1, '{"l": [1,2], "a.b": 3, "sp ace": {"x": true}}'), (2, '{"l": [], "k": "v"}')], "id long, p string"
    )
    out = records.flatten_json(d, "p")
    assert out.columns == ["id", "p__a.b", "p__k", "p__l", "p__sp ace__x"]
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["p__l"] == "[1,2]" and rows[1]["p__a.b"] == "3" and rows[1]["p__sp ace__x"] == "true"
    assert rows[2]["p__l"] == "[]" and rows[2]["p__k"] == "v"


def test_positional_rename(spark):
    d = spark.createDataFrame([(1, 2, 3)], "x long, y long, z long")
    assert records.positional_rename(d, {0: "a", 2: "c"}).columns == ["a", "col_1", "c"]


def test_cast_text(spark):
    d = spark.createDataFrame([(1, 2.5, True)], "a long, b double, c boolean")
    assert records.cast_text(d).first() == ("1", "2.5", "true")


def test_sanitize_strings_and_numbers(spark):
    d = spark.createDataFrame(
        [(" NaN", float("nan")), ("NaT", 1.0), ("a\x00b", 2.0), ("\tnat\u00a0", 3.0), (" keep ", None)],
        "s string, v double",
    )
    out = [tuple(r) for r in records.sanitize(d).collect()]
    assert out == [(None, None), (None, 1.0), ("ab", 2.0), (None, 3.0), (" keep ", None)]


def test_sanitize_temporal(spark):
    d = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2)), (dt.datetime(2024, 1, 2, 3, 4, 5, 120), dt.date(2024, 1, 3))],
        "ts timestamp_ntz, d date",
    )
    out = [tuple(r) for r in records.sanitize(d).collect()]
    assert out == [("2024-01-02T03:04:05", "2024-01-02"), ("2024-01-02T03:04:05.000120", "2024-01-03")]
    # same text as Python's isoformat
    assert out[1][0] == dt.datetime(2024, 1, 2, 3, 4, 5, 120).isoformat()


def test_iso_text_with_offset(spark):
    d = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz")
    out = d.select(iso_text(F.col("ts").cast("timestamp"), with_offset=True)).first()[0]
    assert out == "2024-01-02T03:04:05+00:00"


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k long, a string")
    b = spark.createDataFrame([(2, "y")], "k long, b string")
    out = records.union_by_name([a, b]).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, "x", None), (2, None, "y")]


def test_union_strict_rejects_mismatch(spark):
    a = spark.createDataFrame([(1,)], "k long")
    b = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(ValueError):
        records.union_strict([a, b])
    assert records.union_strict([a, a]).count() == 2


def test_apply_types_try_cast_and_rejects(spark):
    d = spark.createDataFrame([("1", "x"), ("zz", "y"), (None, "z")], "n string, s string")
    out = records.apply_types(d, {"n": "bigint"}, reject_column="rejects").collect()
    assert [(r.n, r.rejects) for r in out] == [(1, 0), (None, 1), (None, 0)]


def test_stamp_ingest_one_value_per_load(spark):
    d = records.stamp_ingest(spark.range(100))
    assert d.select("dt_ingest").distinct().count() == 1


def test_bronze_metadata(spark, tmp_root):
    spark.range(3).write.parquet(f"{tmp_root}/m")
    d = spark.read.parquet(f"{tmp_root}/m")
    out = records.add_bronze_metadata(d, "run9", F.col("_metadata.file_path"))
    r = out.first()
    assert r._run_id == "run9" and r._source_file.endswith(".parquet") and len(r._schema_hash) == 64


def test_standardize_names():
    assert names.standardize_name("Código do Órgão ") == "codigo_do_orgao"
    assert len(names.standardize_name("x" * 100)) == 63
    with pytest.raises(ValueError):
        names.standardize_names(["A b", "a_b"])


def test_unique_index_name_driver_and_column_agree(spark):
    cols = ["org id", "year"]
    expected = tables.index_name(spark, "very_long_table_name_" * 3, cols)
    assert len(expected) == 63 and expected.startswith("uq_very_long_table_name_")
    d = spark.createDataFrame([("very_long_table_name_" * 3, "org id", "year")], "t string, c1 string, c2 string")
    got = d.select(unique_index_name_col(F.col("t"), [F.col("c1"), F.col("c2")])).first()[0]
    assert got == expected


def test_unique_index_name_short(spark):
    digest = hashlib.sha1(b"uq_t1_k").hexdigest()[:8]
    assert tables.index_name(spark, "t1", ["k"]) == f"uq_t1_k_{digest}"
