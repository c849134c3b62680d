"""Layer promotion and incremental (streaming) promotion."""

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.plans import layers, tables
from lakeward.session import durable_dir
from lakeward.sources import landing, paths
from lakeward.streaming import incremental

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_promote_landing_to_bronze(spark, tmp_root):
    day = dt.date(2024, 3, 7)
    good = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    layers.land(good, tmp_root, "erp", "clientes", day, "r1")
    tables.drop_table_if_exists(spark, "clientes", "bronze")
    res = layers.promote_landing_to_bronze(spark, tmp_root, "erp", "clientes", day, "clientes", "bronze", ["id", "name"], ["id"], ["id"], "r1")
    assert res.passed and res.rows_written == 2
    cols = spark.table("bronze.clientes").columns
    assert {"_run_id", "_source_file", "_schema_hash", "_ingested_at"} <= set(cols)
    assert spark.table("bronze.clientes").filter("_source_file like '%r1.parquet%'").count() == 2
    bad_day = dt.date(2024, 3, 8)
    layers.land(spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA), tmp_root, "erp", "clientes", bad_day, "r1")
    res2 = layers.promote_landing_to_bronze(
        spark, tmp_root, "erp", "clientes", bad_day, "clientes", "bronze", ["id"], ["id"], ["id"], "r1",
        results_table="quality_history",
    )
    assert not res2.passed and res2.rows_written == 0 and spark.table("bronze.clientes").count() == 2
    hist = spark.table("bronze.quality_history").collect()
    assert len(hist) == 4 and {h.run_date for h in hist} == {bad_day}
    assert [h.check_name for h in hist if not h.passed] == ["no_duplicates:['id']"]


def test_bronze_to_silver(spark):
    b = spark.createDataFrame(
        [("1", "10.5", "2024-01-02"), ("1", "11", "2024-01-01"), ("2", "x", "2024-01-01")],
        T.StructType([T.StructField(n, T.StringType()) for n in ("Código", "Valor", "Data")]),
    )
    s = layers.bronze_to_silver(b, {"codigo": "bigint", "valor": "double", "data": "date"}, ["codigo"], ["data"])
    assert s.columns == ["codigo", "valor", "data"]
    got = sorted((r.codigo, r.valor, str(r.data)) for r in s.collect())
    assert got == [(1, 11.0, "2024-01-01"), (2, None, "2024-01-01")]


def test_ingest_mailed_report(spark):
    def z(text):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("r.csv", text)
        return buf.getvalue()

    mail = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "bot@gov.br", "Relatorio", [("a.zip", z("t\n1,x\n1,x\n2,y\n")), ("b.zip", z("t\n2,y\n3,z\n"))])],
        "date date, sender string, subject string, attachments array<struct<filename: string, payload: binary>>",
    )
    tables.drop_table_if_exists(spark, "relatorio", "public")
    appended, kept = layers.ingest_mailed_report(
        spark, mail, "bot@gov.br", "relatorio", {0: "id", 1: "nome"}, "relatorio", skiprows=1, target_date=dt.date(2024, 1, 5)
    )
    assert (appended, kept) == (5, 3)
    got = sorted((r.id, r.nome) for r in spark.table("public.relatorio").collect())
    assert got == [("1", "x"), ("2", "y"), ("3", "z")]


def test_ingest_mailed_report_bucketed(spark):
    def z(text):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("r.csv", text)
        return buf.getvalue()

    schema = "date date, sender string, subject string, attachments array<struct<filename: string, payload: binary>>"
    tables.drop_table_if_exists(spark, "relatorio_b", "public")
    day = dt.date(2024, 1, 5)
    first = spark.createDataFrame([(day, "bot@gov.br", "R", [("a.zip", z("1,x\n2,y\n"))])], schema)
    layers.ingest_mailed_report(spark, first, "bot@gov.br", "r", {0: "id", 1: "nome"}, "relatorio_b", target_date=day, key_buckets=8)
    second = spark.createDataFrame([(day, "bot@gov.br", "R", [("b.zip", z("2,y\n3,z\n"))])], schema)
    appended, kept = layers.ingest_mailed_report(spark, second, "bot@gov.br", "r", {0: "id", 1: "nome"}, "relatorio_b", target_date=day, key_buckets=8)
    assert appended == 2
    got = sorted((r.id, r.nome) for r in spark.table("public.relatorio_b").collect())
    assert got == [("1", "x"), ("2", "y"), ("3", "z")]


def test_incremental_promotion(spark, tmp_root):
    root = f"{tmp_root}/lake"
    entity_root = f"{root}/erp/pedidos"
    spec = incremental.StreamSpec("pedidos", "pedidos", "bronze_stream", ["id", "name"], ["id"], ["id"], order_by=["id"])
    tables.drop_table_if_exists(spark, "pedidos", "bronze_stream")
    ckpt = f"{tmp_root}/ckpt"
    landing.write_landing(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA).coalesce(1), paths.build_landing_path(root, "erp", "pedidos", dt.date(2024, 1, 1), "r1"))
    incremental.run_available_now(spark, entity_root, SCHEMA, spec, checkpoint_location=ckpt, timeout_seconds=120)
    assert spark.table("bronze_stream.pedidos").count() == 2
    # second run: one key already present, one new; a bad run goes to quarantine
    landing.write_landing(spark.createDataFrame([(2, "b"), (3, "c")], SCHEMA).coalesce(1), paths.build_landing_path(root, "erp", "pedidos", dt.date(2024, 1, 2), "r1"))
    incremental.run_available_now(spark, entity_root, SCHEMA, spec, checkpoint_location=ckpt, timeout_seconds=120)
    assert sorted(r.id for r in spark.table("bronze_stream.pedidos").collect()) == ["1", "2", "3"]
    landing.write_landing(spark.createDataFrame([(None, "x")], SCHEMA).coalesce(1), paths.build_landing_path(root, "erp", "pedidos", dt.date(2024, 1, 3), "r1"))
    quarantine = f"{tmp_root}/quarantine"
    spec_q = incremental.StreamSpec("pedidos", "pedidos", "bronze_stream", ["id", "name"], ["id"], ["id"], quarantine=quarantine)
    incremental.run_available_now(spark, entity_root, SCHEMA, spec_q, checkpoint_location=ckpt, timeout_seconds=120)
    assert spark.table("bronze_stream.pedidos").count() == 3
    assert spark.read.parquet(quarantine).count() == 1
    batches = spark.table("bronze_stream._stream_batches").orderBy("batch_id").collect()
    assert [b.passed for b in batches] == [True, True, False]
    # replaying a recorded batch is a no-op
    incremental.gate_batch(spec, ckpt)(spark.createDataFrame([(9, "z")], SCHEMA), batches[0].batch_id)
    spark.catalog.refreshTable("bronze_stream.pedidos")
    assert spark.table("bronze_stream.pedidos").count() == 3


def test_dedup_within_watermark(spark, tmp_root):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    src = f"{tmp_root}/events"
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0)), (1, dt.datetime(2024, 1, 1, 0, 1)), (2, dt.datetime(2024, 1, 1, 0, 2))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/a")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    out = incremental.dedup_within_watermark(stream, ["id"], "ts", "10 minutes")
    q = out.writeStream.format("memory").queryName("dedup_wm").option("checkpointLocation", f"{tmp_root}/ck").start()
    try:
        q.processAllAvailable()
        assert sorted(r.id for r in spark.table("dedup_wm").collect()) == [1, 2]
    finally:
        q.stop()


def _docs(spark, business_question):
    models = spark.createDataFrame(
        [("kpi", "gold", "orders per region", "team_a", "erp", "interno", business_question)],
        "model string, layer string, description string, owner string, origin string, classification string, business_question string",
    )
    cols = spark.createDataFrame(
        [("kpi", "region", "region name", None, False), ("kpi", "n", "orders", "count of orders", True)],
        "model string, column string, description string, calculation_rule string, is_calculated boolean",
    )
    return models, cols


def test_publish_gold_gate(spark):
    import pytest

    df = spark.createDataFrame([("north", 3)], "region string, n long")
    models, cols = _docs(spark, "How many orders per region?")
    assert layers.publish_gold(spark, df, "kpi", "gold_demo", "kpi", models, cols) == 1
    assert spark.table("gold_demo.kpi").count() == 1
    models_bad, cols = _docs(spark, None)
    with pytest.raises(ValueError, match="not documented"):
        layers.publish_gold(spark, df, "kpi2", "gold_demo", "kpi", models_bad, cols)


def test_write_table_counts_rows(spark):
    tables.drop_table_if_exists(spark, "promoted", "raw")
    assert tables.write_table(spark.createDataFrame([(1,), (2,), (3,)], "id long"), "promoted", "raw") == 3


def test_merge_into_silver_incremental(spark):
    import os

    tables.drop_table_if_exists(spark, "itens", "silver_inc")
    contract = {"codigo": "bigint", "valor": "double", "data": "date"}
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("Código", "Valor", "Data")])
    first = spark.createDataFrame([("1", "10", "2024-01-01"), ("1", "11", "2024-01-02"), ("2", "20", "2024-01-01"), (None, "0", "2024-01-01")], schema)
    assert layers.merge_into_silver(spark, first, "itens", "silver_inc", contract, ["codigo"], ["data"], key_buckets=8) == 3
    loc = spark.sql("DESCRIBE TABLE EXTENDED silver_inc.itens").filter("col_name = 'Location'").first().data_type.replace("file:", "")
    before = {d: sorted(os.listdir(os.path.join(loc, d))) for d in os.listdir(loc) if d.startswith("_key_bucket=")}
    second = spark.createDataFrame([("2", "99", "2024-01-05"), ("3", "30", "2024-01-05"), (None, "5", "2024-01-05")], schema)
    assert layers.merge_into_silver(spark, second, "itens", "silver_inc", contract, ["codigo"], ["data"], key_buckets=8) == 1
    got = sorted((r.codigo if r.codigo is not None else -1, r.valor) for r in spark.table("silver_inc.itens").collect())
    assert got == [(-1, 0.0), (1, 10.0), (2, 20.0), (3, 30.0)]
    after = {d: sorted(os.listdir(os.path.join(loc, d))) for d in os.listdir(loc) if d.startswith("_key_bucket=")}
    changed = {d for d in after if after[d] != before.get(d)}
    assert len(changed) == 1  # only the bucket of the new key 3 got a file


def test_incremental_promotion_bucketed(spark, tmp_root):
    root = f"{tmp_root}/lake"
    spec = incremental.StreamSpec("b", "pedidos_b", "bronze_b", ["id", "name"], ["id"], ["id"], order_by=["id"], key_buckets=4)
    tables.drop_table_if_exists(spark, "pedidos_b", "bronze_b")
    ckpt = f"{tmp_root}/ckpt"
    landing.write_landing(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA).coalesce(1), paths.build_landing_path(root, "erp", "p", dt.date(2024, 1, 1), "r1"))
    landing.write_landing(spark.createDataFrame([(2, "b"), (3, "c")], SCHEMA).coalesce(1), paths.build_landing_path(root, "erp", "p", dt.date(2024, 1, 2), "r1"))
    incremental.run_available_now(spark, f"{root}/erp/p", SCHEMA, spec, checkpoint_location=ckpt, max_files_per_trigger=1, timeout_seconds=120)
    assert tables.table_properties(spark, "pedidos_b", "bronze_b")[tables.BUCKETS_PROPERTY] == "4"
    assert sorted(r.id for r in spark.table("bronze_b.pedidos_b").collect()) == ["1", "2", "3"]


def test_a_new_checkpoint_skips_no_new_run(spark, tmp_root, tmp_path):
    """A second application without the first one's checkpoint sees all runs
    again from batch 0; keys that bronze holds stay single, new ones arrive."""
    day = dt.date(2024, 5, 1)
    tables.drop_table_if_exists(spark, "pedidos_c", "bronze_c")
    tables.drop_table_if_exists(spark, "_stream_batches", "bronze_c")
    spec = incremental.StreamSpec("c", "pedidos_c", "bronze_c", ["id", "name"], ["id"], ["id"], order_by=["id"])
    for run, ids in (("r1", range(0, 10)), ("r2", range(5, 20))):
        layers.land(spark.createDataFrame([(i, run) for i in ids], SCHEMA).coalesce(1), tmp_root, "erp", "c", day, run)
        incremental.run_available_now(
            spark, f"{tmp_root}/erp/c", SCHEMA, spec, checkpoint_location=str(tmp_path / run),
            max_files_per_trigger=1, timeout_seconds=120,
        )
    got = sorted((r.id, r.name) for r in spark.table("bronze_c.pedidos_c").select(F.col("id").cast("long"), "name").collect())
    assert got == [(i, "r1" if i < 10 else "r2") for i in range(20)]
    done = spark.table("bronze_c._stream_batches").groupBy("checkpoint").count().collect()
    assert sorted(r["count"] for r in done) == [1, 2]


def test_durable_folder_has_no_part_of_one_application(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    assert durable_dir(spark, "streams", "x") == f"{root}/streams/x"
