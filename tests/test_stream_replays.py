"""Replayed micro-batches, quarantines of several checkpoints, bounded state."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeward.plans import layers, tables
from lakeward.streaming import incremental

DAY = dt.date(2024, 3, 1)
COLUMNS = "id long, name string, seen long"
RUNS = [
    [(1, "a", 1), (2, "b", 2), (2, "late", 3), (None, "n", 4), (None, "n", 4)],
    [(2, "again", 5), (3, "c", 6), (None, "n", 4)],
]


def _spec(schema, **more):
    values = {"order_by": ["seen"], "key_buckets": 4, **more}
    return incremental.StreamSpec("s", "t", schema, ["id", "name", "seen"], ["name"], ["id"], **values)


def _land(spark, root, runs=RUNS, first=0):
    for k, rows in enumerate(runs):
        layers.land(spark.createDataFrame(rows, COLUMNS).coalesce(1), root, "erp", "t", DAY, f"r{k + first}")


def _run(spark, root, spec, checkpoint):
    schema = spark.createDataFrame([], COLUMNS).schema
    return incremental.run_available_now(
        spark, f"{root}/erp/t", schema, spec, checkpoint_location=checkpoint, max_files_per_trigger=1, timeout_seconds=120
    )


def _rows(spark, schema):
    spark.catalog.refreshTable(f"{schema}.t")
    key = lambda r: (r[0] or "", r[1], r[2])
    return sorted((tuple(r) for r in spark.table(f"{schema}.t").select("id", "name", "seen").collect()), key=key)


def _clean(spark, schema):
    for t in ("t", incremental.RESULTS):
        tables.drop_table_if_exists(spark, t, schema)


def _forget(spark, schema, batch_id):
    """Drop a batch's record."""
    for r in spark.table(f"{schema}.{incremental.RESULTS}").filter(F.col("batch_id") == batch_id).collect():
        where = f"stream = '{r.stream}', checkpoint = '{r.checkpoint}', batch_id = {batch_id}"
        spark.sql(f"ALTER TABLE {schema}.{incremental.RESULTS} DROP PARTITION ({where})")


# runs are streamed in order of their files' age; every key keeps one row
UNION = [(None, "n", "4")] * 3 + [("1", "a", "1"), ("2", "b", "2"), ("3", "c", "6")]


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_replay_writes_nothing_twice(spark, tmp_path, buckets):
    schema = f"replay_{buckets}"
    _clean(spark, schema)
    spec, checkpoint = _spec(schema, key_buckets=buckets), str(tmp_path / "ck")
    _land(spark, str(tmp_path))
    _run(spark, str(tmp_path), spec, checkpoint)
    once = _rows(spark, schema)
    assert once == sorted(UNION, key=lambda r: (r[0] or "", r[1], r[2]))
    # as after a failure: the rows are written, neither record nor commit is
    _forget(spark, schema, 1)
    os.remove(f"{checkpoint}/commits/1")
    if os.path.exists(f"{checkpoint}/commits/.1.crc"):
        os.remove(f"{checkpoint}/commits/.1.crc")
    results = _run(spark, str(tmp_path), spec, checkpoint)
    assert _rows(spark, schema) == once
    assert sorted((r.batch_id, r.n_rows) for r in results.collect()) == [(0, 4), (1, 2)]


def test_a_replay_replaces_what_a_broken_attempt_left(spark, tmp_path):
    _clean(spark, "replay_partial")
    spec, checkpoint = _spec("replay_partial"), str(tmp_path / "ck")
    _land(spark, str(tmp_path), RUNS[:1])
    _run(spark, str(tmp_path), spec, checkpoint)
    once = _rows(spark, "replay_partial")
    name = incremental.batch_name(incremental.checkpoint_id(spark, checkpoint), 1)
    half = spark.createDataFrame([("9", "half", "9")], "id string, name string, seen string")
    incremental._replace_partition(
        spark, half.withColumn("_key_bucket", F.lit(0)), "replay_partial.t", {"_stream_batch": f"'{name}'"}, ["_key_bucket"]
    )
    batch = spark.createDataFrame(RUNS[1], COLUMNS)
    for _ in range(2):
        _forget(spark, "replay_partial", 1)
        incremental.gate_batch(spec, checkpoint)(batch, 1)
        assert len(_rows(spark, "replay_partial")) == len(once) + 2
        assert not spark.table("replay_partial.t").filter("name = 'half'").count()


def test_quarantines_of_two_checkpoints_and_schemas_stay_apart(spark, tmp_path):
    bad = {("qa", "c1"): [(1, None, 1)], ("qa", "c2"): [(7, None, 7)], ("qb", "c3"): [(8, None, 8)]}
    for (schema, ck), rows in bad.items():
        root = str(tmp_path / ck)
        _land(spark, root, [rows])
        _run(spark, root, _spec(schema, quarantine=str(tmp_path / "q")), f"{root}-checkpoint")
    kept = spark.read.parquet(str(tmp_path / "q"))
    assert sorted(r.id for r in kept.collect()) == [1, 7, 8]
    assert incremental.quarantine_root(spark, _spec("qa")) != incremental.quarantine_root(spark, _spec("qb"))


def test_a_batch_with_repeated_keys_can_be_rejected(spark, tmp_path):
    _clean(spark, "strict")
    _land(spark, str(tmp_path))
    spec = _spec("strict", duplicates="reject", quarantine=str(tmp_path / "q"))
    results = _run(spark, str(tmp_path), spec, str(tmp_path / "ck"))
    assert sorted((r.batch_id, r.passed) for r in results.collect()) == [(0, False), (1, True)]
    assert "no_duplicates" in results.filter("NOT passed").first().messages
    assert [r[0] for r in _rows(spark, "strict")] == [None, "2", "3"]
    with pytest.raises(ValueError, match="duplicates"):
        _spec("strict", duplicates="ignore")


def test_a_table_without_batches_is_refused(spark, tmp_path):
    _clean(spark, "plain")
    tables.create_table_if_not_exists(spark, ["id", "name", "seen"], "t", ["id"], "plain")
    _land(spark, str(tmp_path), RUNS[:1])
    with pytest.raises(Exception, match="_stream_batch"):
        _run(spark, str(tmp_path), _spec("plain"), str(tmp_path / "ck"))


def test_bounded_state_with_late_rows_and_a_restart(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 12) + dt.timedelta(minutes=m)
    schema = "id long, ts timestamp"
    runs = [
        [(1, at(0)), (1, at(2)), (2, at(3))],
        [(2, at(5)), (3, at(30))],  # 2 repeats; the watermark then is 12:20
        [(4, at(1)), (3, at(31)), (5, at(32)), (1, at(33))],  # 4 is late, 3 repeats, 1 was forgotten
    ]
    root, args = str(tmp_path / "in"), (str(tmp_path / "out"), ["id"], "ts", "10 minutes", str(tmp_path / "ck"))

    def run(k):
        rows = spark.createDataFrame(runs[k], schema).coalesce(1)
        layers.land(rows, root, "erp", "e", DAY, f"r{k}")
        out = incremental.first_within_watermark(spark, f"{root}/erp/e", rows.schema, *args, timeout_seconds=120)
        return sorted(r.id for r in out.collect())

    assert run(0) == [1, 2]
    assert run(1) == [1, 2, 3]  # another query that goes on from the checkpoint's state
    assert run(2) == [1, 1, 2, 3, 5]
    # nothing new: nothing is written again
    out = incremental.first_within_watermark(spark, f"{root}/erp/e", spark.createDataFrame([], schema).schema, *args)
    assert sorted(r.id for r in out.collect()) == [1, 1, 2, 3, 5]


def test_a_part_file_without_rows_is_no_empty_run(spark, tmp_path):
    """A run's first task may have no rows, and then writes a file of none; a
    run without any rows is blocked as before."""
    root, schema, checkpoint = str(tmp_path / "lake"), "stream_parts", str(tmp_path / "ckpt")
    rows = spark.range(0, 8, 1, 2).selectExpr("id", "'a' AS name", "id AS seen")
    layers.land(rows.filter("id >= 4"), root, "erp", "t", DAY, "r0")
    spec = _spec(schema)
    results = _run(spark, root, spec, checkpoint)
    assert sorted((r.passed, r.n_rows) for r in results.collect()) == [(True, 0), (True, 4)]
    for batch_id in (0, 1):
        incremental.replay(spark, spec, checkpoint, batch_id, rows.schema)
    assert _rows(spark, schema) == [(str(i), "a", str(i)) for i in range(4, 8)]
    layers.land(rows.filter("id < 0"), root, "erp", "t", DAY, "r1")
    assert sorted((r.batch_id, r.passed) for r in _run(spark, root, spec, checkpoint).collect())[2:] == [(2, False)]
    _clean(spark, schema)
