"""Contracts, file statistics, checksums and manifests."""

import hashlib

import pytest
from pyspark.sql import types as T

from lakeward.plans import contract as c


CONTRACT = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), True)])


def test_contract_violations(spark):
    d = spark.createDataFrame([(1, 2)], "id long, extra long")
    v = c.contract_violations(d.schema, CONTRACT.json())
    assert "missing field 'name'" in v and "field 'id' is nullable, contract says not null" in v
    assert "extra field 'extra'" in v
    ok = spark.createDataFrame([(1, "a")], CONTRACT)
    assert c.check_contract(ok, CONTRACT)[0].passed
    bad = spark.createDataFrame([("1", "a")], "id string, name string")
    assert "contract says bigint" in c.check_contract(bad, CONTRACT)[0].message


def test_manifest_round_trip(spark, tmp_root):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string").coalesce(1)
    d.write.parquet(f"{tmp_root}/ds/run1")
    from lakeward.sources.landing import list_files

    files = list_files(spark, f"{tmp_root}/ds")
    loose = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    conf = c.file_conformance(spark, files, loose).collect()
    assert all(r.conforms for r in conf) and sum(r.footer_rows for r in conf) == 2
    man = c.write_manifest(spark, f"{tmp_root}/ds", "1", files, loose)
    row = man.first()
    with open(row.path.replace("file:", ""), "rb") as fh:
        assert row.sha256 == hashlib.sha256(fh.read()).hexdigest()
    with pytest.raises(Exception):
        c.write_manifest(spark, f"{tmp_root}/ds", "1", files)
    assert c.read_version(spark, f"{tmp_root}/ds", "1", loose).count() == 2
    wrong = T.StructType([T.StructField("id", T.StringType())])
    with pytest.raises(ValueError, match="does not conform"):
        c.write_manifest(spark, f"{tmp_root}/ds", "2", files, wrong)


def test_file_stats(spark, tmp_root):
    spark.createDataFrame([(1,), (5,)], "v long").coalesce(1).write.parquet(f"{tmp_root}/fs/a")
    spark.createDataFrame([(7,)], "v long").coalesce(1).write.parquet(f"{tmp_root}/fs/b")
    d = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_root}/fs")
    got = sorted((r.n_rows, r.v__min, r.v__max) for r in c.file_stats(d, ["v"]).collect())
    assert got == [(1, 7, 7), (2, 1, 5)]
