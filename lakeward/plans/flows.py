"""Registered flows over landed runs: streams, manifests, contracts, windows.

Each lands driver tables whole, as runs of the kind the operator is for, and
returns what the operator makes of them; the SQL beside it computes the same
from the tables.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from ..sources import charsets, landing
from ..streaming import incremental
from . import contract, governance, layers, tables


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lake(spark: SparkSession) -> str:
    return shared_dir(spark, "lake", unique=True)


def _scratch_schema(spark: SparkSession) -> str:
    path = shared_dir(spark, "schemas", unique=True)
    name = f"flow_{path.rstrip('/').rsplit('/', 1)[1]}"
    tables.create_schema(spark, name, path)
    return name


DAY = date(2024, 1, 1)

# ---------------------------------------------------------- T01 incremental


def q_incremental_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental promotion with Structured Streaming over two landed runs of
    all orders' columns that share keys (urgent orders come in both) and hold
    rows without a key (orders of low priority, whose key is not informed).
    Each file is a gated micro-batch; afterwards the last batch is replayed
    from its checkpoint, which must change nothing.  Equals the union of the
    runs, one row per key."""
    root, schema = _lake(spark), _scratch_schema(spark)
    orders = _table(spark, sf_dir, "orders")
    orders = orders.withColumn("o_orderkey", F.expr("if(o_orderpriority = '5-LOW', null, o_orderkey)"))
    finished, urgent = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    layers.land(orders.filter(finished), root, "erp", "orders", DAY, "finished")
    layers.land(orders.filter(~finished | urgent), root, "erp", "orders", DAY, "open")
    spec = incremental.StreamSpec(
        "orders", "orders", schema, orders.columns, ["o_custkey", "o_orderstatus"], ["o_orderkey"],
        order_by=["o_orderdate"], key_buckets=4,
    )
    checkpoint = shared_dir(spark, "streams", unique=True)
    batches = incremental.run_available_now(
        spark, f"{root}/erp/orders", orders.schema, spec, checkpoint_location=checkpoint, max_files_per_trigger=1
    )
    state = batches.agg(F.max("batch_id").alias("last"), F.bool_and("passed").alias("passed")).first()
    if not state["passed"]:
        raise RuntimeError("a micro-batch was blocked")
    incremental.replay(spark, spec, checkpoint, state["last"], orders.schema)
    return spark.table(tables.fq_name("orders", schema)).select(*orders.columns)


_INCREMENTAL = """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
       CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
"""

# ------------------------------------------------------- T02 bounded state

CUTS = (datetime(2024, 1, 11), datetime(2024, 1, 21))


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming de-duplication with bounded state over all events in three
    landed runs, each a restart of the query from its checkpoint.  A run repeats
    the last day of the one before (dropped: the state still knows the keys);
    errors of the first ten days arrive with the third run only, when the
    watermark, two days behind, has passed them (dropped as late)."""
    root, checkpoint, out = _lake(spark), shared_dir(spark, "streams", unique=True), shared_dir(spark, "out", unique=True)
    events = _table(spark, sf_dir, "events")
    first, second = (F.expr(f"TIMESTAMP_NTZ '{c}'") for c in CUTS)
    held = (F.col("event_type") == "error") & (F.col("ts") < first)
    day = F.expr("INTERVAL 1 DAY")
    runs = [
        events.filter((F.col("ts") < first) & ~held),
        events.filter((F.col("ts") >= first - day) & (F.col("ts") < second) & ~held),
        events.filter((F.col("ts") >= second - day) | held),
    ]
    # a watermark needs an instant; the table's times are without a zone
    runs = [r.withColumn("ts", F.col("ts").cast("timestamp")) for r in runs]
    for k, run in enumerate(runs):
        layers.land(run, root, "web", "events", DAY, f"run{k}")
        kept = incremental.first_within_watermark(
            spark, f"{root}/web/events", run.schema, out, ["event_id"], "ts", "2 days", checkpoint, max_files_per_trigger=None
        )
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_STREAM_DEDUP = f"SELECT * FROM events WHERE NOT (event_type = 'error' AND ts < TIMESTAMP '{CUTS[0]}')"

# ------------------------------------------------------- L06 / L07 manifest

RANGE = (datetime(1995, 1, 1), datetime(1996, 6, 30))


def q_manifest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in files of different order dates, approved as a version
    whose manifest holds the footers' statistics, and read back for a range of
    dates: files that cannot match are not opened (checked here)."""
    root = _lake(spark)
    orders = _table(spark, sf_dir, "orders").repartitionByRange(16, "o_orderdate")
    layers.land(orders, root, "erp", "orders", DAY, "r1")
    prefix = f"{root}/erp/orders"
    files = landing.list_files(spark, prefix)
    contract.write_manifest(spark, prefix, "1", files, orders.schema)
    read = contract.read_version(spark, prefix, "1", orders.schema, {"o_orderdate": RANGE})
    if len(files) > 4 and len(read.inputFiles()) > len(files) // 2:
        raise RuntimeError(f"{len(read.inputFiles())} of {len(files)} files were opened")
    return read


_MANIFEST = f"SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'"

# ----------------------------------------------------- Q08 / U01 contracts


def q_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footers of three landed runs of all events against a contract with both
    kinds of timestamp: one conforms, one holds the instant without its zone,
    one lost a column and gained another."""
    root = _lake(spark)
    events = _table(spark, sf_dir, "events").withColumn("seen_at", F.col("ts").cast("timestamp"))
    drifted = events.withColumn("seen_at", F.col("ts"))
    runs = {"as_agreed": events, "no_zone": drifted, "other": events.drop("props").withColumn("host", F.lit("a"))}
    for run, frame in runs.items():
        layers.land(frame, root, "web", "events", DAY, run)
    agreed = T.StructType.fromJson(events.schema.jsonValue())
    found = contract.file_conformance(spark, landing.list_files(spark, f"{root}/web/events"), agreed)
    run = F.regexp_extract("path", r"([^/]+)\.parquet/", 1).alias("run")
    return found.groupBy(run).agg(
        F.sum("footer_rows").alias("n_rows"), F.bool_and("conforms").alias("conforms"), F.max("ddl").alias("ddl")
    )


_CONTRACT_DDL = "event_id: bigint, ts: timestamp_ntz, user_id: bigint, event_type: string, value: double"
_CONTRACT = f"""
SELECT run, (SELECT count(*) FROM events) AS n_rows, run = 'as_agreed' AS conforms, ddl
FROM (VALUES ('as_agreed', '{_CONTRACT_DDL}, props: string, seen_at: timestamp'),
             ('no_zone', '{_CONTRACT_DDL}, props: string, seen_at: timestamp_ntz'),
             ('other', '{_CONTRACT_DDL}, seen_at: timestamp, host: string')) runs(run, ddl)
"""

# --------------------------------------------------- L08 / W03 windows, runs


def _land_by_day(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Orders by priority, one day each around a turn of the year; a first run
    holds all open orders only, a later one every order of the day."""
    orders = _table(spark, sf_dir, "orders")
    for k, day in enumerate(WINDOW_DAYS):
        own = orders.filter(F.substring("o_orderpriority", 1, 1) == str(k + 1))
        layers.land(own.filter("o_orderstatus <> 'F'"), root, "erp", "orders", day, "b-first")
        layers.land(own, root, "erp", "orders", day, "a-second")


WINDOW_DAYS = [date(2023, 11, 30), date(2023, 12, 5), date(2024, 1, 1), date(2024, 1, 31), date(2024, 2, 1)]
WINDOW = (date(2023, 12, 1), date(2024, 1, 31))


def q_window_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of the days of a window, re-runs included; only the window's
    day folders are listed."""
    root = _lake(spark)
    _land_by_day(spark, sf_dir, root)
    return landing.load_window(spark, root, "erp", "orders", *WINDOW)[1]


def q_load_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run of each day of a window."""
    root = _lake(spark)
    _land_by_day(spark, sf_dir, root)
    return landing.load_latest(spark, root, "erp", "orders", *WINDOW)[1]


_LATEST = "SELECT * FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('2', '3', '4')"
_WINDOW = f"{_LATEST} UNION ALL {_LATEST} AND o_orderstatus <> 'F'"

# ------------------------------------------------------------- Q14 lineage


def q_lineage_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that building customers lead to, with the fewest steps:
    orders, parts, their suppliers, nations and regions."""
    t = lambda name: _table(spark, sf_dir, name)
    node = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    hops = [
        (t("orders"), ("c", "o_custkey"), ("o", "o_orderkey")),
        (t("lineitem"), ("o", "l_orderkey"), ("p", "l_partkey")),
        (t("lineitem"), ("p", "l_partkey"), ("s", "l_suppkey")),
        (t("supplier"), ("s", "s_suppkey"), ("n", "s_nationkey")),
        (t("nation"), ("n", "n_nationkey"), ("r", "n_regionkey")),
    ]
    edges = [df.select(node(*a).alias("src"), node(*b).alias("dst")) for df, a, b in hops]
    roots = t("customer").filter("c_mktsegment = 'BUILDING'").select(node("c", "c_custkey").alias("node"))
    return governance.reachable_from(spark, reduce(DataFrame.unionByName, edges), roots)


_REACH = """
WITH c AS (SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING'),
o AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT k FROM c)),
p AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_orderkey IN (SELECT k FROM o)),
s AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_partkey IN (SELECT k FROM p)),
n AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_suppkey IN (SELECT k FROM s)),
r AS (SELECT DISTINCT n_regionkey AS k FROM nation WHERE n_nationkey IN (SELECT k FROM n))
SELECT 'c' || k AS node, 0 AS depth FROM c UNION ALL SELECT 'o' || k, 1 FROM o UNION ALL SELECT 'p' || k, 2 FROM p
UNION ALL SELECT 's' || k, 3 FROM s UNION ALL SELECT 'n' || k, 4 FROM n UNION ALL SELECT 'r' || k, 5 FROM r
"""

# ------------------------------------------------------ K10 / Q09 checksums


def q_content_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as two runs, promoted to bronze, then with one price
    changed: rows of each, and whether the order-free checksum of all columns
    equals that of the landed files' sums."""
    root, schema = _lake(spark), _scratch_schema(spark)
    orders = _table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == "F"
    layers.land(orders.filter(finished), root, "erp", "orders", DAY, "finished")
    layers.land(orders.filter(~finished), root, "erp", "orders", DAY, "open")
    columns = orders.columns
    done = layers.promote_landing_to_bronze(
        spark, root, "erp", "orders", DAY, "orders", schema, columns, ["o_orderkey"], ["o_orderkey"], "r", key_buckets=4
    )
    if not done.passed:
        raise RuntimeError(f"promotion blocked: {done.results}")
    landed = landing.load_landing(spark, root, "erp", "orders", DAY)[1]
    per_file = contract.content_checksum(landed, columns, [F.col("_metadata.file_path").alias("file")])
    whole = per_file.agg(
        F.sum("n_rows").alias("n_rows"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed")
    )
    bronze = spark.table(tables.fq_name("orders", schema))
    first = orders.agg(F.min("o_orderkey").cast("string").alias("k")).first()["k"]
    price = F.when(F.col("o_orderkey") == first, F.lit("0.01")).otherwise(F.col("o_totalprice"))
    stages = {"landed": whole, "bronze": contract.content_checksum(bronze, columns)}
    stages["changed"] = contract.content_checksum(bronze.withColumn("o_totalprice", price), columns)
    rows = reduce(DataFrame.unionByName, [df.withColumn("stage", F.lit(k)) for k, df in stages.items()])
    same = F.struct("n_rows", "total", "mixed").alias("sum")
    agreed = whole.select(F.lit("landed").alias("base"), same.alias("agreed"))
    found = rows.select("stage", "n_rows", same, F.lit("landed").alias("base")).join(agreed, "base")
    return found.select("stage", "n_rows", (F.col("sum") == F.col("agreed")).alias("same"))


_CHECKSUM = """
SELECT stage, (SELECT count(*) FROM orders) AS n_rows, stage <> 'changed' AS same
FROM (VALUES ('landed'), ('bronze'), ('changed')) stages(stage)
"""

# ------------------------------------------------------------ S06 charsets

ENCODED_AS = {"en": "utf-16-le", "de": "utf-16-be", "fr": "cp1252", "es": "cp1252"}


@F.pandas_udf(T.BinaryType())
def _encoded(text: pd.Series, charset: pd.Series) -> pd.Series:
    # Stand-in input: each document as bytes in a charset of its language, with
    # no mark; texts that the charset cannot hold stay UTF-8.
    def one(value, name):
        if value is None:
            return None
        try:
            return value.encode(name)
        except UnicodeEncodeError:
            return value.encode()

    return pd.Series([one(t, c) for t, c in zip(text, charset)], dtype=object)


def q_decode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as bytes in charsets of their languages (UTF-16 of both
    byte orders, a Latin code page), detected and decoded back."""
    docs = _table(spark, sf_dir, "documents")
    name = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ENCODED_AS.items() for x in kv]), F.col("lang")), F.lit("utf-8"))
    raw = docs.select("doc_id", "lang", _encoded("text", name).alias("payload"))
    return charsets.decode_payloads(raw).select("doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


_DECODED = "SELECT doc_id, lang, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS n_chars FROM documents"

QUERIES = {
    "incremental_bronze": q_incremental_bronze,
    "stream_dedup": q_stream_dedup,
    "manifest_version": q_manifest_version,
    "contract_check": q_contract_check,
    "window_load": q_window_load,
    "load_latest": q_load_latest,
    "lineage_reach": q_lineage_reach,
    "content_checksum": q_content_checksum,
    "decode_documents": q_decode_documents,
}
SQL = {
    "incremental_bronze": _INCREMENTAL,
    "stream_dedup": _STREAM_DEDUP,
    "manifest_version": _MANIFEST,
    "contract_check": _CONTRACT,
    "window_load": _WINDOW,
    "load_latest": _LATEST,
    "lineage_reach": _REACH,
    "content_checksum": _CHECKSUM,
    "decode_documents": _DECODED,
}
