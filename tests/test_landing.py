"""Landing zone: layout, immutable writes, listing, strict loading, runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeward.functions.text import landing_path_col, parse_landing_path
from lakeward.sources import landing, paths


def test_build_landing_path():
    p = paths.build_landing_path("my-bucket", "siape", "servidores", dt.date(2024, 3, 5), "abc123")
    assert p == "my-bucket/siape/servidores/2024/03/05/abc123.parquet"
    assert paths.build_landing_path("b", "s", "e", dt.date(2024, 3, 5), "r", ext="csv").endswith("r.csv")


def test_prefix_contains_day():
    assert "2024/03/07" in paths.landing_prefix("b", "s", "e", dt.date(2024, 3, 7))


def test_parse_landing_path_driver():
    p = paths.parse_landing_path("s3a://lake/siape/servidores/2024/03/05/abc123.parquet/part-0.snappy.parquet")
    assert p["source"] == "siape" and p["run_date"] == dt.date(2024, 3, 5) and p["run_id"] == "abc123"
    assert paths.parse_landing_path("not/a/landing/path") is None


def test_path_column_round_trip(spark):
    d = spark.createDataFrame([("siape", "servidores", dt.date(2024, 3, 5), "abc123")], "s string, e string, d date, r string")
    built = d.select(landing_path_col("lake", F.col("s"), F.col("e"), F.col("d"), F.col("r")).alias("p"))
    assert built.first().p == "lake/siape/servidores/2024/03/05/abc123.parquet"
    parsed = parse_landing_path(F.col("p"))
    row = built.select(*[c.alias(n) for n, c in parsed.items()]).first()
    assert (row.source, row.entity, row.run_date, row.run_id) == ("siape", "servidores", dt.date(2024, 3, 5), "abc123")
    part = spark.createDataFrame([("x/siape/servidores/2024/03/05/abc123.parquet/part-00000-1.snappy.parquet",), ("bad/path",)], "p string")
    rows = part.select(*[c.alias(n) for n, c in parse_landing_path(F.col("p")).items()]).collect()
    assert rows[0].run_id == "abc123" and rows[0].source == "siape"
    assert rows[1].source is None and rows[1].run_date is None


def test_day_prefixes_and_retention():
    ps = paths.day_prefixes("b", "s", "e", dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    assert [p[-10:] for p in ps] == ["2024/02/28", "2024/02/29", "2024/03/01"]
    old = paths.expired_prefixes("b", "s", "e", [dt.date(2024, 1, 1), dt.date(2024, 3, 1)], 30, dt.date(2024, 3, 10))
    assert old == ["b/s/e/2024/01/01"]


def test_write_read_round_trip_and_dtypes(spark, tmp_root):
    d = spark.createDataFrame([(1, True, 1.5), (2, False, 2.5)], "id long, active boolean, score double")
    path = landing.write_landing(d, f"{tmp_root}/src/ent/2024/01/01/run1.parquet")
    back = landing.read_parquet(spark, path)
    assert back.schema == d.schema and back.count() == 2


def test_landing_is_immutable(spark, tmp_root):
    d = spark.createDataFrame([(1,)], "id long")
    path = f"{tmp_root}/src/ent/2024/01/01/run1.parquet"
    landing.write_landing(d, path)
    with pytest.raises(Exception):
        landing.write_landing(d, path)


def test_list_files(spark, tmp_root):
    spark.createDataFrame([(1, 1.0)], "id long, val double").write.parquet(f"{tmp_root}/a/b/2024/01/01/r.parquet")
    files = landing.list_files(spark, f"{tmp_root}/a/b")
    assert files and all(f.endswith(".parquet") for f in files)
    assert landing.list_files(spark, f"{tmp_root}/missing") == []


def test_load_landing_concat_and_errors(spark, tmp_root):
    day = dt.date(2024, 3, 7)
    schema = "id long, name string"
    landing.write_landing(spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1), paths.build_landing_path(tmp_root, "s", "e", day, "r1"))
    landing.write_landing(spark.createDataFrame([(3, "c"), (4, "d"), (5, "e")], schema).coalesce(1), paths.build_landing_path(tmp_root, "s", "e", day, "r2"))
    files, d = landing.load_landing(spark, tmp_root, "s", "e", day)
    assert len(files) == 2 and d.count() == 5
    with pytest.raises(ValueError, match="No Parquet files found at"):
        landing.load_landing(spark, tmp_root, "s", "e", dt.date(2024, 3, 8))


def test_load_landing_strict_rejects_schema_drift(spark, tmp_root):
    day = dt.date(2024, 3, 7)
    landing.write_landing(spark.createDataFrame([(1, "a")], "id long, name string").coalesce(1), paths.build_landing_path(tmp_root, "s", "x", day, "r1"))
    landing.write_landing(spark.createDataFrame([(2,)], "id long").coalesce(1), paths.build_landing_path(tmp_root, "s", "x", day, "r2"))
    with pytest.raises(ValueError, match="do not share one schema"):
        landing.load_landing(spark, tmp_root, "s", "x", day)
    _, lenient = landing.load_landing(spark, tmp_root, "s", "x", day, strict=False)
    assert lenient.count() == 2


def test_latest_run(spark, tmp_root):
    import time

    day = dt.date(2024, 5, 1)
    landing.write_landing(spark.createDataFrame([(1,)], "id long"), paths.build_landing_path(tmp_root, "s", "e", day, "first"))
    time.sleep(1.1)
    landing.write_landing(spark.createDataFrame([(2,)], "id long"), paths.build_landing_path(tmp_root, "s", "e", day, "second"))
    files = landing.latest_run_files(spark, tmp_root, "s", "e", day)
    assert files and all("/second.parquet/" in f for f in files)


def test_resolve_storage():
    m = paths.resolve_storage({})
    assert m.backend == "minio" and m.base_uri == "s3a://data-lake"
    assert m.hadoop_options["fs.s3a.endpoint"] == "https://minio:9000"
    m2 = paths.resolve_storage({"MINIO_ENDPOINT": "minio.local:9000", "MINIO_BUCKET": "b"})
    assert m2.hadoop_options["fs.s3a.endpoint"] == "https://minio.local:9000" and m2.base_uri == "s3a://b"
    s3 = paths.resolve_storage({"STORAGE_BACKEND": "S3", "AWS_ACCESS_KEY_ID": "k"})
    assert "fs.s3a.endpoint" not in s3.hadoop_options and s3.hadoop_options["fs.s3a.access.key"] == "k"
    adls = paths.resolve_storage({"STORAGE_BACKEND": "adls", "ADLS_ACCOUNT_NAME": "acct"})
    assert adls.base_uri.startswith("abfss://data-lake@acct.")
    with pytest.raises(ValueError, match="Unknown STORAGE_BACKEND"):
        paths.resolve_storage({"STORAGE_BACKEND": "hdfs"})
    assert paths.session_options(m)["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_window_and_days(spark, tmp_root):
    for d, v in [(dt.date(2024, 1, 30), 1), (dt.date(2024, 1, 31), 2), (dt.date(2024, 2, 1), 3), (dt.date(2024, 2, 5), 4)]:
        landing.write_landing(spark.createDataFrame([(v,)], "id long").coalesce(1), paths.build_landing_path(tmp_root, "s", "w", d, "r1"))
    days = landing.landing_days(spark, tmp_root, "s", "w")
    assert days == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 5)]
    files, d = landing.load_window(spark, tmp_root, "s", "w", dt.date(2024, 1, 31), dt.date(2024, 2, 3))
    assert sorted(r.id for r in d.collect()) == [2, 3] and len(files) == 2
    old = paths.expired_prefixes(tmp_root, "s", "w", days, 3, dt.date(2024, 2, 6))
    assert [p[-10:] for p in old] == ["2024/01/30", "2024/01/31", "2024/02/01"]
    with pytest.raises(ValueError):
        landing.load_window(spark, tmp_root, "s", "w", dt.date(2023, 1, 1), dt.date(2023, 1, 2))


def test_load_landing_with_contract(spark, tmp_root):
    from pyspark.sql import types as T

    day = dt.date(2024, 6, 1)
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    landing.write_landing(spark.createDataFrame([(1, "a")], contract).coalesce(1), paths.build_landing_path(tmp_root, "s", "c", day, "r1"))
    files, d = landing.load_landing(spark, tmp_root, "s", "c", day, schema=contract)
    assert d.schema == contract and d.count() == 1
    landing.write_landing(spark.createDataFrame([(2, 3)], "id long, name long").coalesce(1), paths.build_landing_path(tmp_root, "s", "c", day, "r2"))
    with pytest.raises(ValueError, match="does not match the contract"):
        landing.load_landing(spark, tmp_root, "s", "c", day, schema=contract)


def test_latest_runs_per_day(spark, tmp_root):
    import time

    d1, d2 = dt.date(2024, 7, 1), dt.date(2024, 7, 2)
    landing.write_landing(spark.createDataFrame([(1,)], "id long"), paths.build_landing_path(tmp_root, "s", "l", d1, "a"))
    landing.write_landing(spark.createDataFrame([(2,)], "id long"), paths.build_landing_path(tmp_root, "s", "l", d2, "a"))
    time.sleep(1.1)
    landing.write_landing(spark.createDataFrame([(3,)], "id long"), paths.build_landing_path(tmp_root, "s", "l", d1, "rerun"))
    runs = {r.run_date: r.run_id for r in landing.latest_runs(spark, tmp_root, "s", "l").collect()}
    assert runs == {d1: "rerun", d2: "a"}
    _, df = landing.load_latest(spark, tmp_root, "s", "l", d1, d2)
    assert sorted(r.id for r in df.collect()) == [2, 3]


def test_unreadable_file_is_reported(spark, tmp_root):
    import os

    day = dt.date(2024, 8, 1)
    landing.write_landing(spark.createDataFrame([(1,)], "id long").coalesce(1), paths.build_landing_path(tmp_root, "s", "u", day, "r1"))
    bad_dir = f"{tmp_root}/s/u/2024/08/01/r2.parquet"
    os.makedirs(bad_dir)
    with open(f"{bad_dir}/part-0.parquet", "wb") as fh:
        fh.write(b"not parquet at all")
    with pytest.raises(ValueError, match="unreadable footer"):
        landing.load_landing(spark, tmp_root, "s", "u", day)
