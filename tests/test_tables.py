"""Destination tables: create, append, evolve, upsert, dedup, comments."""

import pytest

from lakeward.operators import dedup
from lakeward.plans import tables


def rows(spark, name, schema="raw", order="k"):
    return [tuple(r) for r in spark.table(f"{schema}.{name}").orderBy(order).collect()]


def test_append_creates_and_evolves(spark):
    tables.drop_table_if_exists(spark, "t_append")
    assert tables.insert_data(spark, spark.createDataFrame([], "k long"), "t_append") == 0
    assert not tables.table_exists(spark, "t_append", "raw")
    n = tables.insert_data(spark, spark.createDataFrame([(1, "a")], "k long, a string"), "t_append")
    assert n == 1
    tables.insert_data(spark, spark.createDataFrame([(2, "c", {"x": 5})], "k long, C2 string, s struct<x: long>"), "t_append")
    assert spark.table("raw.t_append").columns == ["k", "a", "C2", "s__x"]
    assert rows(spark, "t_append") == [("1", "a", None, None), ("2", None, "c", "5")]


def test_alter_table_case_insensitive(spark):
    tables.drop_table_if_exists(spark, "t_alter")
    tables.create_table_if_not_exists(spark, ["k", "Name"], "t_alter")
    assert tables.alter_table(spark, ["K", "name", "new"], "t_alter") == ["new"]
    assert spark.table("raw.t_alter").columns == ["k", "Name", "new"]


def test_upsert_updates_only_batch_columns(spark):
    tables.drop_table_if_exists(spark, "t_up")
    tables.insert_data(spark, spark.createDataFrame([("1", "a1", "b1"), ("2", "a2", "b2")], "k string, a string, b string"), "t_up", primary_key=["k"])
    tables.insert_data(spark, spark.createDataFrame([("2", "A2", "c2"), ("3", "A3", "c3")], "k string, a string, c string"), "t_up", conflict_fields=["k"])
    assert rows(spark, "t_up") == [("1", "a1", "b1", None), ("2", "A2", "b2", "c2"), ("3", "A3", None, "c3")]
    props = dict(spark.sql("SHOW TBLPROPERTIES raw.t_up").collect())
    name = tables.index_name(spark, "t_up", ["k"])
    assert name.startswith("uq_t_up_k_") and props[tables.UNIQUE_PROPERTY + name] == '["k"]'


def test_upsert_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "t"), (1, "x")], "k long, v string")
    b = spark.createDataFrame([(None, "b"), (1, "y")], "k long, v string")
    out = sorted((str(r.k), r.v) for r in tables.upsert_frames(t, b, ["k"]).collect())
    assert out == [("1", "y"), ("None", "b"), ("None", "t")]


def test_upsert_batch_duplicates(spark):
    t = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([(1, "y", 1), (1, "z", 2)], "k long, v string, seq long")
    with pytest.raises(ValueError, match="repeats key"):
        tables.upsert_frames(t, b, ["k"])
    out = tables.upsert_frames(t, b, ["k"], on_duplicate="last", order_by=["seq"]).collect()
    assert [(r.k, r.v, r.seq) for r in out] == [(1, "z", 2)]


def test_unique_constraint_rejects_duplicates(spark):
    tables.drop_table_if_exists(spark, "t_uq")
    tables.insert_data(spark, spark.createDataFrame([("1",), ("1",)], "k string"), "t_uq")
    with pytest.raises(RuntimeError, match="unique constraint"):
        tables.ensure_unique_constraint(spark, "t_uq", ["k"])
    assert tables.ensure_unique_constraint(spark, "t_uq", []) is None


def test_remove_duplicates_keeps_first(spark):
    tables.drop_table_if_exists(spark, "t_dd", "public")
    d = spark.createDataFrame(
        [("a", "1", "2024-01-02", "x"), ("a", "1", "2024-01-01", "y"), ("b", "2", "2024-01-01", "z")],
        "c1 string, c2 string, dt_ingest string, col_3 string",
    )
    tables.insert_data(spark, d, "t_dd", schema="public")
    kept = tables.remove_duplicates_table(spark, "t_dd", ["c1", "c2"], ["dt_ingest"], schema="public")
    assert kept == 2
    assert rows(spark, "t_dd", "public", "c1") == [("a", "1", "2024-01-01", "y"), ("b", "2", "2024-01-01", "z")]


def test_first_per_key_requires_order(spark):
    with pytest.raises(ValueError):
        dedup.first_per_key(spark.range(1), ["id"], [])


def test_full_refresh_and_comments(spark):
    tables.full_refresh(spark, spark.createDataFrame([(1, "a")], "k long, a string"), "t_ref")
    tables.full_refresh(spark, spark.createDataFrame([(2, "b")], "k long, a string"), "t_ref")
    assert rows(spark, "t_ref") == [("2", "b")]
    stmts = tables.apply_comments(spark, "raw", "t_ref", "it's here", {"a": "col 'a'", "k": ""})
    assert len(stmts) == 2
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE raw.t_ref").collect()}
    assert desc["a"] == "col 'a'"
    detail = dict((r.col_name, r.data_type) for r in spark.sql("DESCRIBE TABLE EXTENDED raw.t_ref").collect())
    assert detail["Comment"] == "it's here"


def test_execute_helpers(spark):
    assert tables.execute_query(spark, "SELECT 1 AS x").first().x == 1
    with pytest.raises(RuntimeError):
        tables.execute_non_query(spark, "DROP TABLE raw.does_not_exist_at_all")


def test_to_csv(spark, tmp_root):
    tables.to_csv(spark.createDataFrame([(1, "a")], "k long, a string"), f"{tmp_root}/out")
    back = spark.read.option("header", "true").csv(f"{tmp_root}/out")
    assert back.columns == ["k", "a"] and back.count() == 1


def test_dedup_hot_key_and_unorderable_columns(spark):
    # one key holds a third of the rows; a map column cannot be sorted
    n = 3000
    d = spark.createDataFrame(
        [((0 if i % 3 == 0 else i), i, {"i": i}) for i in range(n)], "k long, seq long, m map<string, long>"
    )
    out = dedup.remove_duplicates(d, ["k"], ["seq"])
    rows = {r.k: r.seq for r in out.collect()}
    assert len(rows) == n - n // 3 + 1 and rows[0] == 0


def test_upsert_many_null_keys_with_map_column(spark):
    t = spark.createDataFrame([(None if i % 2 else i, {"a": i}) for i in range(200)], "k long, m map<string, long>")
    b = spark.createDataFrame([(None, {"b": 1}), (0, {"c": 2})], "k long, m map<string, long>")
    out = tables.upsert_frames(t, b, ["k"]).collect()
    assert len(out) == 201
    assert [r.m for r in out if r.k == 0] == [{"c": 2}]


def test_upsert_without_salt_same_result(spark):
    t = spark.createDataFrame([(None, "t"), (1, "x"), (2, "y")], "k long, v string")
    b = spark.createDataFrame([(None, "b"), (1, "z")], "k long, v string")
    a = sorted(map(str, tables.upsert_frames(t, b, ["k"]).collect()))
    c = sorted(map(str, tables.upsert_frames(t, b, ["k"], salt_null_keys=False).collect()))
    assert a == c and len(a) == 4


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp_root):
    import os

    tables.drop_table_if_exists(spark, "t_bk")
    base = spark.createDataFrame([(str(i), f"a{i}") for i in range(200)], "k string, a string")
    tables.create_table_if_not_exists(spark, ["k", "a"], "t_bk", primary_key=["k"], key_buckets=16)
    tables.insert_data(spark, base, "t_bk")
    loc = spark.sql("DESCRIBE TABLE EXTENDED raw.t_bk").filter("col_name = 'Location'").first().data_type.replace("file:", "")

    def listing():
        out = {}
        for d in sorted(os.listdir(loc)):
            if d.startswith("_key_bucket="):
                out[d] = sorted(f for f in os.listdir(os.path.join(loc, d)) if f.endswith(".parquet"))
        return out

    before = listing()
    assert len(before) == 16
    batch = spark.createDataFrame([("5", "A5", "c"), ("999", "new", "d")], "k string, a string, c string")
    tables.insert_data(spark, batch, "t_bk", conflict_fields=["k"])
    after = listing()
    touched = {d for d in after if after[d] != before.get(d)}
    expected = {f"_key_bucket={r[0]}" for r in batch.select(tables.key_bucket(["k"], 16)).distinct().collect()}
    assert touched == expected
    got = {r.k: (r.a, r.c) for r in spark.table("raw.t_bk").collect()}
    assert len(got) == 201 and got["5"] == ("A5", "c") and got["999"] == ("new", "d") and got["7"] == ("a7", None)


def test_unique_constraint_recorded_once_and_enforced_on_append(spark):
    tables.drop_table_if_exists(spark, "t_uq2")
    tables.insert_data(spark, spark.createDataFrame([("1", "a")], "k string, v string"), "t_uq2")
    tables.insert_data(spark, spark.createDataFrame([("2", "b")], "k string, v string"), "t_uq2", conflict_fields=["k"])
    props = tables.table_properties(spark, "t_uq2", "raw")
    assert list(tables.unique_keys(props).values()) == [["k"]]
    with pytest.raises(RuntimeError, match="already exists"):
        tables.insert_data(spark, spark.createDataFrame([("1", "z")], "k string, v string"), "t_uq2")
    with pytest.raises(RuntimeError, match="repeat key"):
        tables.insert_data(spark, spark.createDataFrame([("7", "x"), ("7", "y")], "k string, v string"), "t_uq2")
    tables.insert_data(spark, spark.createDataFrame([(None, "n"), (None, "m"), ("8", "o")], "k string, v string"), "t_uq2")
    assert spark.table("raw.t_uq2").count() == 5


def test_remove_duplicates_null_keys_group_together(spark):
    d = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("x", 3, "c")], "k string, o long, v string")
    out = sorted((r.k or "", r.v) for r in dedup.remove_duplicates(d, ["k"], ["o"]).collect())
    assert out == [("", "a"), ("x", "c")]
