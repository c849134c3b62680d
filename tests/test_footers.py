"""Footers: schemas as Spark wrote them, statistics, file skipping; listings."""

import datetime as dt
import decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.plans import contract, layers
from lakeward.sources import footers, landing, paths

TYPES = (
    "l long, i int, d double, s string, day date, at timestamp, ntz timestamp_ntz, dec decimal(12,2), b boolean, "
    "nested struct<x: int, y: array<timestamp>>"
)


def _frame(spark, n=3):
    return spark.range(n).select(
        F.col("id").alias("l"),
        F.col("id").cast("int").alias("i"),
        F.when(F.col("id") == 1, F.lit(float("nan"))).otherwise(F.col("id") / 2).alias("d"),
        F.concat(F.lit("é"), F.col("id").cast("string")).alias("s"),
        F.expr("date'2024-01-01' + cast(id as int)").alias("day"),
        F.expr("timestamp'2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("at"),
        F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("ntz"),
        (F.col("id") / 4).cast("decimal(12,2)").alias("dec"),
        (F.col("id") > 0).alias("b"),
        F.struct(F.lit(1).alias("x"), F.array(F.expr("timestamp'2024-01-01'")).alias("y")).alias("nested"),
    )


@pytest.mark.parametrize("instants", ["INT96", "TIMESTAMP_MICROS"])
def test_a_footer_tells_the_types_that_spark_wrote(spark, tmp_root, instants):
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", instants)
    try:
        _frame(spark).coalesce(1).write.parquet(f"{tmp_root}/erp/t/2024/01/01/r.parquet")
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", before)
    files = landing.list_files(spark, f"{tmp_root}/erp/t")
    row = footers.footers(spark, files).first()
    expected = T.StructType.fromDDL(TYPES)
    assert row.error is None and row.n_rows == 3 and row.row_groups == 1
    assert footers.schema_ddl(T.StructType.fromJson(__import__("json").loads(row.schema))) == footers.schema_ddl(expected)
    assert all(r.conforms for r in contract.file_conformance(spark, files, expected).collect())
    # the contract that names an instant accepts it, and only it
    loaded = landing.load_landing(spark, tmp_root, "erp", "t", dt.date(2024, 1, 1), schema=expected)[1]
    assert loaded.count() == 3
    other = T.StructType.fromDDL(TYPES.replace("ntz timestamp_ntz", "ntz timestamp"))
    with pytest.raises(ValueError, match="does not match the contract"):
        landing.load_landing(spark, tmp_root, "erp", "t", dt.date(2024, 1, 1), schema=other)
    bounds = {c["name"]: (c["nulls"], c["min"], c["max"]) for c in row["columns"]}
    assert bounds["l"] == (0, "0", "2") and bounds["day"][1:] == ("2024-01-01", "2024-01-03")
    assert bounds["dec"][1:] == ("0.00", "0.50") and bounds["b"][1:] == ("false", "true")
    assert bounds["ntz"][1:] == ("2024-01-01 10:00:00", "2024-01-03 10:00:00")
    assert bounds["d"][1:] == (None, None)  # a NaN leaves no bound to rely on
    assert bounds["at"][1] == (None if instants == "INT96" else "2024-01-01 10:00:00+00:00")
    assert "nested" not in bounds


def test_files_of_other_writers(spark, tmp_root):
    table = pa.table({
        "id": pa.array([1, 2], pa.int64()),
        "utc": pa.array([0, 1], pa.timestamp("us", tz="UTC")),
        "plain": pa.array([0, 1], pa.timestamp("us")),
        "tags": pa.array([["a"], []], pa.list_(pa.string())),
        "point": pa.array([{"x": 1.5}, None], pa.struct([("x", pa.float64())])),
    })
    pq.write_table(table, f"{tmp_root}/a.parquet")
    pq.write_table(table, f"{tmp_root}/old.parquet", use_deprecated_int96_timestamps=True)
    got = {r.path.rsplit("/", 1)[1]: r.schema for r in landing.file_schemas(spark, [f"{tmp_root}/a.parquet", f"{tmp_root}/old.parquet"]).collect()}
    assert got["a.parquet"] == "id: bigint, utc: timestamp, plain: timestamp_ntz, tags: array<string>, point: struct<x:double>"
    assert got["old.parquet"].startswith("id: bigint, utc: timestamp, plain: timestamp, ")


def test_a_store_that_only_spark_reaches(spark, tmp_root):
    assert footers.opens_from_python("s3a://b/k") and footers.opens_from_python("/x")
    assert not footers.opens_from_python("viewfs://store/x")
    _frame(spark).coalesce(1).write.parquet(f"{tmp_root}/in/r.parquet")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.footers.link./in", f"file://{tmp_root}/in")
    files = landing.list_files(spark, "viewfs://footers/in")
    assert files and files[0].startswith("viewfs://")
    row = footers.footers(spark, files).first()
    assert row.error is None and row.n_rows == 3


def test_s3_settings_come_from_the_session(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in (("access.key", "k"), ("secret.key", "s"), ("endpoint", "http://minio:9000")):
        conf.set(f"fs.s3a.{key}", value)
    try:
        assert footers.store_options(spark) == {
            "access_key": "k", "secret_key": "s", "endpoint_override": "minio:9000", "scheme": "http"
        }
    finally:
        for key in ("access.key", "secret.key", "endpoint"):
            conf.unset(f"fs.s3a.{key}")


def _landed_by_range(spark, root):
    """Eight files of 100 numbers each, one more of nulls, one without rows."""
    rows = spark.range(800).select("id", F.expr("date'2024-01-01' + cast(id div 100 as int)").alias("day"))
    rows.repartitionByRange(8, "id").write.parquet(f"{root}/ds/r1")
    none = spark.range(5).select(F.lit(None).cast("long").alias("id"), F.lit(None).cast("date").alias("day"))
    none.coalesce(1).write.parquet(f"{root}/ds/r2")
    none.limit(0).coalesce(1).write.parquet(f"{root}/ds/r3")
    return landing.list_files(spark, f"{root}/ds")


@pytest.mark.parametrize("checksums", [True, False])
def test_a_range_reads_only_files_that_can_match(spark, tmp_root, checksums):
    files = _landed_by_range(spark, tmp_root)
    manifest = contract.write_manifest(spark, f"{tmp_root}/ds", "1", files, checksums=checksums)
    assert manifest.count() == len(files) == 10 and (manifest.filter("sha256 IS NULL").count() == 0) is checksums
    assert manifest.agg(F.sum("n_rows")).first()[0] == 805
    read = contract.read_version(spark, f"{tmp_root}/ds", "1", ranges={"id": (250, 349)})
    assert sorted(r.id for r in read.collect()) == list(range(250, 350)) and len(read.inputFiles()) == 2
    day = dt.date(2024, 1, 8)
    read = contract.read_version(spark, f"{tmp_root}/ds", "1", ranges={"day": (day, None), "id": (None, 750)})
    assert sorted(r.id for r in read.collect()) == list(range(700, 751)) and len(read.inputFiles()) == 1
    none = contract.read_version(spark, f"{tmp_root}/ds", "1", ranges={"id": (5000, None)})
    assert none.count() == 0 and none.columns == ["id", "day"]
    # without a range every file counts, the ones of nulls too
    assert contract.read_version(spark, f"{tmp_root}/ds", "1").count() == 805


def test_a_manifest_needs_readable_footers(spark, tmp_root, tmp_path):
    (tmp_path / "x.parquet").write_bytes(b"nothing")
    with pytest.raises(ValueError, match="unreadable footer"):
        contract.write_manifest(spark, f"{tmp_root}/m", "1", [str(tmp_path / "x.parquet")])


def test_bounds_of_several_row_groups_and_unknown_ones(spark, tmp_root):
    pq.write_table(pa.table({"v": pa.array([3, 4, None, None, 1, 9], pa.int64())}), f"{tmp_root}/g.parquet", row_group_size=2)
    pq.write_table(pa.table({"v": pa.array([3], pa.int64())}), f"{tmp_root}/n.parquet", write_statistics=False)
    rows = {r.path.rsplit("/", 1)[1]: r["columns"][0].asDict() for r in footers.footers(spark, [f"{tmp_root}/g.parquet", f"{tmp_root}/n.parquet"]).collect()}
    assert rows["g.parquet"] == {"name": "v", "nulls": 2, "min": "1", "max": "9"}
    assert rows["n.parquet"]["min"] is None
    contract.write_manifest(spark, f"{tmp_root}/d", "1", [f"{tmp_root}/g.parquet", f"{tmp_root}/n.parquet"])
    assert len(contract.matching_files(spark, f"{tmp_root}/d", "1", {"v": (100, None)})) == 1
    assert len(contract.matching_files(spark, f"{tmp_root}/d", "1", {"missing": (1, 2)}, T.StructType.fromDDL("missing int"))) == 2


# ------------------------------------------------------------------ listings


def test_window_patterns_name_years_months_and_days():
    got = paths.window_patterns("/lake", "erp", "t{1}", dt.date(2022, 11, 29), dt.date(2024, 2, 2))
    two = "[0-9][0-9]"
    assert got == [
        f"/lake/erp/t\\{{1\\}}/{{2023}}/{two}/{two}",
        f"/lake/erp/t\\{{1\\}}/{{2022/12,2024/01}}/{two}",
        "/lake/erp/t\\{1\\}/{2022/11/29,2022/11/30,2024/02/01,2024/02/02}",
    ]
    assert paths.window_patterns("/lake", "a", "b", dt.date(2024, 1, 2), dt.date(2024, 1, 1)) == []


def test_a_window_lists_its_days_only(spark, tmp_root):
    days = [dt.date(2022, 12, 31), dt.date(2023, 5, 5), dt.date(2024, 1, 15), dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    for k, day in enumerate(days):
        layers.land(spark.createDataFrame([(k,)], "id long"), tmp_root, "erp", "t", day, "r")
    files, df = landing.load_window(spark, tmp_root, "erp", "t", dt.date(2023, 1, 1), dt.date(2024, 2, 1))
    assert sorted(r.id for r in df.collect()) == [1, 2, 3]
    # a file that is no Parquet outside the window is not even listed
    listed = landing.entity_files(spark, tmp_root, "erp", "t", dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert [str(r.run_date) for r in listed.select("run_date").distinct().orderBy("run_date").collect()] == ["2024-02-01", "2024-02-02"]
    with pytest.raises(ValueError, match="No Parquet files"):
        landing.load_window(spark, tmp_root, "erp", "t", dt.date(2020, 1, 1), dt.date(2020, 1, 3))
    with pytest.raises(ValueError, match="No Parquet files"):
        landing.load_window(spark, tmp_root, "erp", "t", dt.date(2024, 1, 3), dt.date(2024, 1, 1))


def test_the_newest_run_of_each_day_of_a_window(spark, tmp_root):
    for day in (1, 2, 3):
        for run in ("b-first", "a-again"):
            layers.land(spark.createDataFrame([(day, run)], "day int, run string"), tmp_root, "erp", "t", dt.date(2024, 1, day), run)
    _, df = landing.load_latest(spark, tmp_root, "erp", "t", dt.date(2024, 1, 2), dt.date(2024, 1, 31))
    assert sorted(tuple(r) for r in df.collect()) == [(2, "a-again"), (3, "a-again")]
