"""Several unique keys per table, key filters, balanced bucket writes, full
refresh that keeps what is known about a table."""

import os

import pytest
from pyspark.sql import functions as F

from lakeward.operators import keyfilter
from lakeward.plans import layers, tables
from lakeward.session import shared_dir

COLUMNS = "id long, mail string, name string"


def _fresh(spark, table, key_filter=False, buckets=4):
    tables.drop_table_if_exists(spark, table, "uk")
    tables.create_table_if_not_exists(spark, ["id", "mail", "name"], table, ["id"], "uk", buckets)
    for key in (["id"], ["mail"]):
        tables.ensure_unique_constraint(spark, table, key, "uk", key_filter=key_filter)
    _add(spark, table, [(1, "a@x", "A"), (2, "b@x", "B"), (None, None, "N"), (None, "n@x", "N")])


def _add(spark, table, rows, **more):
    return tables.insert_data(spark, spark.createDataFrame(rows, COLUMNS), table, schema="uk", **more)


def _rows(spark, table):
    got = [tuple(r) for r in spark.table(f"uk.{table}").select("id", "mail", "name").collect()]
    return sorted(got, key=lambda r: tuple(x or "" for x in r))


@pytest.mark.parametrize("key_filter", [False, True])
def test_repeats_of_either_key_are_refused(spark, key_filter):
    _fresh(spark, "people", key_filter)
    props = tables.table_properties(spark, "people", "uk")
    assert sorted(tables.unique_keys(props).values()) == [["id"], ["mail"]]
    before = _rows(spark, "people")
    for bad in (
        [(2, "new@x", "x")],  # a known id
        [(9, "b@x", "x")],  # a known mail
        [(8, "s@x", "x"), (8, "t@x", "x")],  # an id twice in the batch
        [(8, "s@x", "x"), (9, "s@x", "x")],  # a mail twice in the batch
    ):
        with pytest.raises(RuntimeError, match="Unique constraint"):
            _add(spark, "people", bad)
        assert _rows(spark, "people") == before
    # null parts never collide, and a batch may lack a key's column
    assert _add(spark, "people", [(None, None, "N"), (3, "c@x", "C"), (4, None, "D"), (5, None, "E")]) == 4
    only_ids = spark.createDataFrame([(6, "F")], "id long, name string")
    assert tables.insert_data(spark, only_ids, "people", schema="uk") == 1
    with pytest.raises(RuntimeError, match="Unique constraint"):
        _add(spark, "people", [(6, "z@x", "x")])


@pytest.mark.parametrize("key_filter", [False, True])
def test_an_upsert_keeps_the_other_key(spark, key_filter):
    _fresh(spark, "upserted", key_filter)
    before = _rows(spark, "upserted")
    for bad in ([(1, "b@x", "x")], [(7, "a@x", "x")], [(7, "q@x", "x"), (8, "q@x", "x")], [(7, "n@x", "x")]):
        with pytest.raises(RuntimeError, match="Unique constraint"):
            _add(spark, "upserted", bad, conflict_fields=["id"])
        assert _rows(spark, "upserted") == before
    # keys that change places are unique afterwards
    _add(spark, "upserted", [(1, "b@x", "A2"), (2, "a@x", "B2"), (3, "c@x", "C")], conflict_fields=["id"])
    assert [r for r in _rows(spark, "upserted") if r[0]] == [("1", "b@x", "A2"), ("2", "a@x", "B2"), ("3", "c@x", "C")]
    with pytest.raises(RuntimeError, match="Unique constraint"):
        _add(spark, "upserted", [(9, "c@x", "x")])


def test_existing_repeats_are_named(spark):
    tables.drop_table_if_exists(spark, "dup", "uk")
    tables.create_table_if_not_exists(spark, ["id", "mail", "name"], "dup", None, "uk")
    _add(spark, "dup", [(1, "a", "x"), (1, "b", "y"), (None, "c", "z"), (None, "c", "z")])
    with pytest.raises(RuntimeError, match="duplicate key"):
        tables.ensure_unique_constraint(spark, "dup", ["id"], "uk")
    assert tables.ensure_unique_constraint(spark, "dup", [], "uk") is None
    tables.ensure_unique_constraint(spark, "dup", ["id", "mail"], "uk")
    assert list(tables.unique_keys(tables.table_properties(spark, "dup", "uk")).values()) == [["id", "mail"]]


def test_an_append_of_new_keys_reads_no_old_one(spark, monkeypatch):
    _fresh(spark, "filtered", key_filter=True)
    looked_up = []
    real = tables._refuse_existing
    monkeypatch.setattr(tables, "_refuse_existing", lambda *a: (looked_up.append(1), real(*a)))
    _add(spark, "filtered", [(k, f"m{k}", "x") for k in range(100, 120)])
    assert not looked_up
    with pytest.raises(RuntimeError):
        _add(spark, "filtered", [(110, "other", "x")])
    assert looked_up


def test_a_full_filter_is_built_anew(spark, monkeypatch):
    monkeypatch.setattr(keyfilter, "blocks_for", lambda keys: max(1, keys // keyfilter.KEYS_PER_BLOCK))
    _fresh(spark, "grown", key_filter=True)
    name = tables.index_name(spark, "grown", ["id"])
    state = lambda: __import__("json").loads(tables.table_properties(spark, "grown", "uk")[tables.FILTER_PROPERTY + name])
    small = state()["blocks"]
    _add(spark, "grown", [(k, f"m{k}", "x") for k in range(100, 300)])
    assert state()["blocks"] > small
    with pytest.raises(RuntimeError):
        _add(spark, "grown", [(250, "zz", "x")])


def test_filters_never_miss_and_seldom_err(spark):
    have = spark.range(20000).select(F.col("id"), F.when(F.col("id") % 7 == 0, None).otherwise(F.lit("x")).alias("part"))
    blocks = keyfilter.blocks_for(20000)
    halves = [keyfilter.build(have.filter(c), ["id", "part"], blocks) for c in ("id < 9000", "id >= 9000")]
    rows = keyfilter.merge(*halves)
    keyed = have.filter("part IS NOT NULL")
    assert keyfilter.possible(have, ["id", "part"], rows, blocks).count() == keyed.count()
    others = spark.range(100000, 140000).withColumn("part", F.lit("x"))
    assert keyfilter.possible(others, ["id", "part"], rows, blocks).count() < 200
    # the text form decides, so typed and text keys are the same
    assert keyfilter.possible(keyed.select(F.col("id").cast("string"), "part"), ["id", "part"], rows, blocks).count() == keyed.count()


def _files(spark, table):
    where = spark.sql(f"DESCRIBE TABLE EXTENDED uk.{table}").filter("col_name = 'Location'").first().data_type
    root = where.replace("file:", "")
    return {d: len([f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")]) for d in os.listdir(root) if "=" in d}


def test_bucketed_writes_make_few_files(spark):
    tables.drop_table_if_exists(spark, "wide", "uk")
    tables.create_table_if_not_exists(spark, ["id", "mail", "name"], "wide", ["id"], "uk", 8)
    many = spark.range(0, 4000, 1, 16).select(
        F.expr("if(id % 3 = 0, null, id)").alias("id"), F.lit("m").alias("mail"), F.lit("n").alias("name")
    )
    assert tables.insert_data(spark, many, "wide", schema="uk") == 4000
    assert len(_files(spark, "wide")) == 8 and max(_files(spark, "wide").values()) <= 2  # not 16 tasks x 8 buckets
    batch = spark.createDataFrame([(1, "M", "N"), (None, "m", "n")], COLUMNS)
    tables.insert_data(spark, batch, "wide", conflict_fields=["id"], schema="uk")
    assert spark.table("uk.wide").count() == 4001 and spark.table("uk.wide").filter("mail = 'M'").count() == 1
    plan = tables._balanced(spark.table("uk.wide"))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_staged_copies_go_when_the_counts_agree(spark):
    _fresh(spark, "staged")
    _add(spark, "staged", [(1, "q@x", "Q")], conflict_fields=["id"])
    staging = shared_dir(spark, "staging", "uk.staged").replace("file:", "")
    assert not os.path.isdir(staging) or os.listdir(staging) == []
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_full_refresh_keeps_what_is_known(spark):
    _fresh(spark, "refreshed", key_filter=True)
    spark.sql("ALTER TABLE uk.refreshed SET TBLPROPERTIES ('owner_team' = 'people')")
    tables.apply_comments(spark, "uk", "refreshed", "who we know", {"mail": "address", "name": "full name"})
    new = spark.createDataFrame([(1, "z@x", 5), (4, "y@x", 6)], "id long, mail string, age int")
    assert tables.full_refresh(spark, new, "refreshed", "uk") == 2
    props = tables.table_properties(spark, "refreshed", "uk")
    assert props["owner_team"] == "people" and props[tables.BUCKETS_PROPERTY] == "4"
    assert sorted(tables.unique_keys(props).values()) == [["id"], ["mail"]]
    assert sorted(c.name for c in spark.catalog.listColumns("uk.refreshed")) == ["_key_bucket", "age", "id", "mail"]
    comments = {c.name: c.description for c in spark.catalog.listColumns("uk.refreshed")}
    assert comments["mail"] == "address" and spark.catalog.getTable("uk.refreshed").description == "who we know"
    with pytest.raises(RuntimeError, match="already exists"):
        tables.insert_data(spark, spark.createDataFrame([(9, "y@x", 1)], "id long, mail string, age int"), "refreshed", schema="uk")
    assert tables.insert_data(spark, spark.createDataFrame([(2, "a@x", 1)], "id long, mail string, age int"), "refreshed", schema="uk") == 1
    with pytest.raises(RuntimeError, match="repeat key"):
        tables.full_refresh(spark, spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id long, mail string, age int"), "refreshed", "uk")
    assert spark.table("uk.refreshed").count() == 3


def test_comments_change_only_what_differs(spark):
    _fresh(spark, "noted")
    assert len(tables.apply_comments(spark, "uk", "noted", "t", {"ID": "key", "name": ""})) == 2
    assert tables.apply_comments(spark, "uk", "noted", "t", {"id": "key"}) == []
    with pytest.raises(RuntimeError, match="no column"):
        tables.apply_comments(spark, "uk", "noted", "other", {"nope": "x"})
    assert spark.catalog.getTable("uk.noted").description == "t"


# ----------------------------------------------------------- rejected cells


def test_rejected_cells_are_a_table_and_a_gate(spark):
    for t in ("s", "s_rejects"):
        tables.drop_table_if_exists(spark, t, "uk_silver")
    bronze = spark.createDataFrame([("1", "x", "2024-01-01"), ("2", "2.5", "soon"), ("2", "3", "2024-01-02"), (None, "", None)], "`Item Id` string, Price string, `On` string")
    contract = {"item_id": "bigint", "price": "double", "on": "date"}
    args = (spark, bronze, "s", "uk_silver", contract, ["item_id"], ["on"])
    blocked = layers.promote_to_silver(*args, max_reject_share=0.5)
    assert not blocked.passed and (blocked.rows_read, blocked.rejected_rows, blocked.rejected_cells) == (4, 3, 3)
    assert not tables.table_exists(spark, "s", "uk_silver")
    cells = sorted((r.item_id or "", r.column, r.value, r.type) for r in spark.table("uk_silver.s_rejects").collect())
    assert cells == [("", "price", "", "double"), ("1", "price", "x", "double"), ("2", "on", "soon", "date")]
    done = layers.promote_to_silver(*args, max_reject_share=0.75)
    assert done.passed and done.rows_written == 3 and abs(done.share - 0.75) < 1e-12
    got = sorted((r.item_id or 0, r.price, str(r.on)) for r in spark.table("uk_silver.s").collect())
    assert got == [(0, None, "None"), (1, None, "2024-01-01"), (2, 2.5, "None")]
    empty = layers.promote_to_silver(spark, bronze.limit(0), "s", "uk_silver", contract, ["item_id"], ["on"])
    assert empty.passed and empty.rows_written == 0 and spark.table("uk_silver.s").count() == 0
