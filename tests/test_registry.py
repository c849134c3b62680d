"""Source registry: JDBC (embedded in-memory Derby: no server, no port),
file sources, extraction metadata."""

import datetime as dt
import uuid

import pytest

from lakeward.sources import registry


@pytest.fixture()
def derby_url():
    return f"jdbc:derby:memory:lw{uuid.uuid4().hex[:8]};create=true"


DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_jdbc_round_trip_sanitised(spark, derby_url):
    d = spark.createDataFrame(
        [(1, " NaN", 1.5, dt.datetime(2024, 1, 2, 3, 4, 5)), (2, "ok", None, dt.datetime(2024, 1, 2, 3, 4, 5, 7))],
        "id int, name string, v double, ts timestamp",
    )
    registry.write_jdbc_table(d, derby_url, "T1", mode="overwrite", properties=DRIVER)
    out = registry.read_jdbc_table(spark, derby_url, "T1", partition_column="ID", num_partitions=2, properties=DRIVER)
    rows = sorted(tuple(r) for r in out.collect())
    assert rows[0][:3] == (1, None, 1.5) and rows[1][1:3] == ("ok", None)
    assert rows[0][3] == "2024-01-02T03:04:05" and rows[1][3] == "2024-01-02T03:04:05.000007"


def test_jdbc_custom_schema(spark, derby_url):
    d = spark.createDataFrame([(1, 42)], "id int, code int")
    registry.write_jdbc_table(d, derby_url, "T2", mode="overwrite", properties=DRIVER)
    out = registry.read_jdbc_table(spark, derby_url, "T2", properties=DRIVER, custom_schema="code STRING")
    assert dict(out.dtypes)["code"] == "string" and out.first()["code"] == "42"


def test_jdbc_empty_keeps_schema(spark, derby_url):
    registry.write_jdbc_table(spark.createDataFrame([], "id int, name string"), derby_url, "EMPTY", mode="overwrite", properties=DRIVER)
    out = registry.read_jdbc_table(spark, derby_url, "EMPTY", properties=DRIVER)
    assert out.count() == 0 and [c.upper() for c in out.columns] == ["ID", "NAME"]


def test_build_extraction(spark, tmp_root):
    spark.createDataFrame([("1", "a")], "x string, y string").write.option("header", "true").csv(f"{tmp_root}/c")
    df = registry.build_extraction(spark, {"type": "csv", "params": {"path": f"{tmp_root}/c"}})
    assert df.columns == ["x", "y"] and df.first().x == "1"
    spark.range(3).write.parquet(f"{tmp_root}/p")
    assert registry.build_extraction(spark, {"type": "parquet", "params": {"path": f"{tmp_root}/p"}}).count() == 3
    with pytest.raises(ValueError, match="Unknown source type"):
        registry.build_extraction(spark, {"type": "ftp"})
    with pytest.raises(NotImplementedError):
        registry.build_extraction(spark, {"type": "pdf"})


def test_metadata_and_incremental(spark):
    d = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 3))], "id long, ts timestamp_ntz")
    meta = registry.extraction_metadata(d, "ts")
    assert meta["row_count"] == 2 and meta["watermark"] == dt.datetime(2024, 1, 3) and len(meta["schema_hash"]) == 64
    assert registry.read_since(d, "ts", dt.datetime(2024, 1, 2)).count() == 1
    assert registry.read_since(d, "ts", None).count() == 2


def test_api_and_json_extractors(spark, tmp_root):
    spark.createDataFrame(
        [(200, "application/json", '{"a": 1}'), (204, "application/json", "")],
        "status int, content_type string, body string",
    ).write.parquet(f"{tmp_root}/api")
    out = registry.build_extraction(spark, {"type": "api", "params": {"path": f"{tmp_root}/api"}})
    assert sorted(r.kind for r in out.collect()) == ["json", "no_content"]
    spark.createDataFrame([(1, "x")], "id long, v string").write.json(f"{tmp_root}/j")
    j = registry.build_extraction(spark, {"type": "json", "params": {"path": f"{tmp_root}/j", "schema": "id long, v string"}})
    assert [tuple(r) for r in j.collect()] == [(1, "x")]
