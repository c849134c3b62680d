"""Registered queries: each runs one library operator over the driver tables
(whole tables), and ``ORACLE_SQL`` holds the equivalent DuckDB SQL.

Where an operator needs input of a particular shape (a target and a batch
for an upsert, null cells for a null check, mail messages for attachment
selection), the query builds that input from the tables with plain
projections; the operator itself is always the library code.
"""

from __future__ import annotations

import io
import zipfile
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import iso_text, landing_path_col, parse_landing_path, unique_index_name_col
from ..operators import dedup, quality, records
from ..sources import bundles, landing, messages, responses
from ..session import shared_dir
from . import contract, flows, governance, layers, rules, tables


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ quality checks

ORDERS_EXPECTED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_NOT_NULL = ["o_orderkey", "o_custkey", "o_orderpriority"]


def _orders_with_missing_priority(spark, sf_dir):
    # Stand-in input: the tables hold no nulls, so priority '5-LOW' is read
    # as "not informed" to give the null checks something to find.
    o = _t(spark, sf_dir, "orders")
    return o.withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')"))


def q_validate_orders(spark, sf_dir):
    """Standard suite (schema, row count, not-null, duplicates) in one job."""
    df = _orders_with_missing_priority(spark, sf_dir)
    return quality.validation_frame(df, ORDERS_EXPECTED, ORDERS_NOT_NULL, ["o_orderkey"])


def q_not_null(spark, sf_dir):
    """``not_null`` per column, including one the frame does not have."""
    df = _orders_with_missing_priority(spark, sf_dir)
    return quality.checks_frame(df, not_null=["o_orderkey", "o_orderpriority", "o_comment"])


def q_null_rate(spark, sf_dir):
    """``null_rate`` against two limits (one passes, one fails)."""
    df = _orders_with_missing_priority(spark, sf_dir)
    return quality.checks_frame(df, null_rates=[("o_orderpriority", 0.25), ("o_orderpriority", 0.1)])


def q_no_duplicates(spark, sf_dir):
    """Row count and composite-key duplicates of ``lineitem`` in one job."""
    li = _t(spark, sf_dir, "lineitem")
    return quality.checks_frame(li, key_columns=["l_orderkey", "l_linenumber"], min_rows=1)


def q_duplicate_keys(spark, sf_dir):
    """Key tuples that repeat (unique-index rule: null key parts excluded)."""
    return quality.duplicate_keys(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_relationships(spark, sf_dir):
    """Line items whose order is not among the finished orders."""
    li = _t(spark, sf_dir, "lineitem")
    finished = _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return quality.relationships(li, finished, ["l_orderkey"], ["o_orderkey"])


def q_column_stats(spark, sf_dir):
    """Row count and per-column nulls/min/max in one aggregation."""
    o = _t(spark, sf_dir, "orders")
    return quality.column_stats(o, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])


# -------------------------------------------------------- landing round trip

FLOW_DAY = date(2024, 1, 1)


def q_landing_flow(spark, sf_dir):
    """Land ``orders`` as two runs of one day (finished and open orders, as
    two extract runs would), load the day back with the strict concat check
    (the runs' Parquet footers are compared on the executors) and run the
    standard suite on it."""
    root = shared_dir(spark, "lake", unique=True)
    o = _orders_with_missing_priority(spark, sf_dir)
    finished = F.col("o_orderstatus") == "F"
    landing.write_landing(o.filter(finished), f"{root}/erp/orders/2024/01/01/finished.parquet")
    landing.write_landing(o.filter(~finished), f"{root}/erp/orders/2024/01/01/open.parquet")
    _, df = landing.load_landing(spark, root, "erp", "orders", FLOW_DAY)
    return quality.validation_frame(df, ORDERS_EXPECTED, ORDERS_NOT_NULL, ["o_orderkey"])


BRONZE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def _land_orders_day(spark, sf_dir, root):
    o = _t(spark, sf_dir, "orders").select(*BRONZE_COLUMNS)
    finished = F.col("o_orderstatus") == "F"
    layers.land(o.filter(finished), root, "erp", "orders", FLOW_DAY, "finished")
    layers.land(o.filter(~finished), root, "erp", "orders", FLOW_DAY, "open")


def q_bronze_promotion(spark, sf_dir):
    """Landing → bronze: two runs of one day are loaded (strict concat), the
    suite gates the day in one job, and the rows are appended to an all-text
    bronze table with technical metadata (run id shown; ingest time, source
    file and schema hash are written but not compared)."""
    root = shared_dir(spark, "lake", unique=True)
    _land_orders_day(spark, sf_dir, root)
    schema = _scratch_schema(spark)
    res = layers.promote_landing_to_bronze(
        spark, root, "erp", "orders", FLOW_DAY, "orders", schema, BRONZE_COLUMNS, ["o_orderkey"], ["o_orderkey"], "run-20240101",
        key_buckets=4,
    )
    if not res.passed:
        raise RuntimeError(f"promotion blocked: {res.results}")
    return spark.table(tables.fq_name("orders", schema)).select(*BRONZE_COLUMNS, "_run_id")


# ------------------------------------------------------- dedup / upsert / set


def q_remove_duplicates(spark, sf_dir):
    """First line item per (order, line number) by ship date."""
    li = _t(spark, sf_dir, "lineitem")
    return dedup.remove_duplicates(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_latest_run(spark, sf_dir):
    """Latest event per type and day (newest run of a source/entity/day)."""
    ev = _t(spark, sf_dir, "events").withColumn("run_date", F.to_date("ts"))
    latest = dedup.latest_per_group(ev, ["event_type", "run_date"], "ts", ["event_id"])
    return latest.select("event_type", "run_date", "event_id", "ts", "user_id", "value")


CUTOVER = "1999-01-01"


def _customer_summaries(spark, sf_dir):
    # Stand-in input: per-customer order summaries before the cutover are the
    # table, summaries after it are the incoming batch (with one column the
    # table does not have yet).
    o = _t(spark, sf_dir, "orders")
    target = (
        o.filter(F.col("o_orderdate") < CUTOVER)
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_orderdate"))
    )
    batch = (
        o.filter(F.col("o_orderdate") >= CUTOVER)
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("last_orderdate"), F.max("o_orderpriority").alias("top_priority"))
    )
    return target, batch


def q_upsert(spark, sf_dir):
    """Upsert of the batch summaries into the table summaries."""
    target, batch = _customer_summaries(spark, sf_dir)
    return tables.upsert_frames(target, batch, ["o_custkey"])


def q_last_per_user(spark, sf_dir):
    """Last write wins: each user's latest event (ties on ``ts`` broken by the
    greater event id)."""
    ev = _t(spark, sf_dir, "events")
    return dedup.last_per_key(ev, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value"
    )


def _scratch_schema(spark) -> str:
    # a fresh schema whose tables live under the shared checkpoint folder
    name = "lw_" + shared_dir(spark, unique=True).rsplit("/", 1)[-1][:12]
    tables.create_schema(spark, name, shared_dir(spark, "warehouse", name))
    return name


def q_append_evolve(spark, sf_dir):
    """Append into an all-text table: the first load creates it, the second
    brings a column the table lacks (add-only evolution) and lacks one the
    table has (null there)."""
    schema = _scratch_schema(spark)
    o = _t(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == "F"
    tables.insert_data(spark, o.filter(finished).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), "orders_raw", schema=schema)
    tables.insert_data(spark, o.filter(~finished).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "orders_raw", schema=schema)
    return spark.table(tables.fq_name("orders_raw", schema))


def q_upsert_table(spark, sf_dir):
    """Upsert into a key-bucketed all-text table: only the buckets the batch
    touches are read and rewritten (staged, then swapped in)."""
    schema = _scratch_schema(spark)
    target, batch = _customer_summaries(spark, sf_dir)
    tables.create_table_if_not_exists(spark, target.columns, "customer_summary", ["o_custkey"], schema, key_buckets=4)
    tables.insert_data(spark, target, "customer_summary", schema=schema)
    tables.insert_data(spark, batch, "customer_summary", conflict_fields=["o_custkey"], schema=schema)
    return spark.table(tables.fq_name("customer_summary", schema)).drop(tables.KEY_BUCKET_COLUMN)


def q_union_by_name(spark, sf_dir):
    """Customers and suppliers combined by column name; absent columns null."""
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    s = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
    )
    return records.union_by_name([c, s])


# ------------------------------------------------------------- projections


def q_flatten_events(spark, sf_dir):
    """Event properties (JSON text) flattened to ``props__{key}`` text columns."""
    return records.flatten_json(_t(spark, sf_dir, "events"), "props")


def q_flatten_nested(spark, sf_dir):
    """Nested order records flattened to ``a__b__c`` columns."""
    # Stand-in input: orders as nested records, the shape a document source
    # or an API delivers.
    o = _t(spark, sf_dir, "orders")
    nested = o.select(
        F.struct(F.col("o_orderkey").alias("key"), F.struct(F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("priority")).alias("meta")).alias("order"),
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_custkey").alias("key")).alias("customer"),
        F.col("o_totalprice").alias("total"),
    )
    return records.flatten(nested)


def _orders_with_text_tokens(spark, sf_dir):
    # Stand-in input: some priorities arrive as the text tokens a relational
    # export writes for missing values (with stray whitespace around them).
    o = _t(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    raw = (
        F.when(p == "5-LOW", F.lit(" NaN\t"))
        .when(p == "4-NOT SPECIFIED", F.lit("NaT"))
        .when(p == "1-URGENT", F.lit("\u00a0nan"))
        .otherwise(p)
    )
    return o.select("o_orderkey", "o_orderstatus", raw.alias("o_orderpriority"), "o_orderdate", "o_totalprice")


def q_sanitize(spark, sf_dir):
    """Cell sanitiser over every column (text tokens, NaN, temporal values)."""
    return records.sanitize(_orders_with_text_tokens(spark, sf_dir))


def q_iso_text(spark, sf_dir):
    """Event times as ISO-8601 text (fraction only when non-zero)."""
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", iso_text(F.col("ts")).alias("ts_iso"))


def q_positional_rename(spark, sf_dir):
    """Positional names for line items; unmapped positions become col_i."""
    return records.positional_rename(
        _t(spark, sf_dir, "lineitem"), {0: "order_key", 3: "line_number", 4: "quantity"}
    )


def q_cast_text(spark, sf_dir):
    """Every column of the conversations as text."""
    return records.cast_text(_t(spark, sf_dir, "conversations"))


def q_constraint_names(spark, sf_dir):
    """Deterministic key-constraint name per part (type as table, brand and name as columns)."""
    p = _t(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        unique_index_name_col(F.col("p_type"), [F.col("p_brand"), F.col("p_name")]).alias("constraint_name"),
    )


def q_landing_paths(spark, sf_dir):
    """Landing path per event, then parsed back into source/entity/date/run."""
    ev = _t(spark, sf_dir, "events")
    path = landing_path_col(
        "data-lake", F.col("event_type"), F.lit("events"), F.to_date("ts"),
        F.concat(F.lit("run"), F.col("event_id").cast("string")),
    )
    with_path = ev.select("event_id", path.alias("path"))
    parsed = parse_landing_path(F.col("path"))
    return with_path.select("event_id", "path", *[c.alias(n) for n, c in parsed.items()])


def q_row_checksums(spark, sf_dir):
    """MD5 of each order row's canonical text."""
    o = _t(spark, sf_dir, "orders")
    text = F.concat_ws(
        "|",
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus",
        iso_text(F.col("o_orderdate")), "o_orderpriority",
    )
    return o.select("o_orderkey", F.md5(text).alias("row_md5"))


def q_allowlist_pages(spark, sf_dir):
    """Pages whose URL a selector text includes (no deeper folder after the match)."""
    selector = "\n".join(
        [
            "# pages to publish",
            "",
            r"example\.com/en/",
            r"^blog\.[a-z]+\.example\.org/",
            "/fr/",
        ]
    )
    pages = _t(spark, sf_dir, "pages").select("page_id", "url")
    return governance.select_paths(pages, "url", selector, "https://")


# -------------------------------------------------------------- sources


def _messages_from_events(spark, sf_dir):
    # Stand-in input: each event is a mailed report; the event's properties
    # travel as a small CSV attachment.
    ev = _t(spark, sf_dir, "events")
    csv_text = F.concat(
        F.lit("event_id,user_id,event_type\n"),
        F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type"),
        F.lit("\n"),
    )
    ext = F.when(F.col("event_type") == "purchase", F.lit(".CSV")).otherwise(F.lit(".csv"))
    attachment = F.struct(
        F.concat(F.lit("report_"), F.col("event_id").cast("string"), ext).alias("filename"),
        F.encode(csv_text, "UTF-8").alias("payload"),
    )
    note = F.struct(F.lit("readme.txt").alias("filename"), F.encode(F.lit("see attached"), "UTF-8").alias("payload"))
    return ev.select(
        F.col("event_id").alias("message_id"),
        F.to_date("ts").alias("date"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@reports.example.org")).alias("sender"),
        F.concat(F.lit("Daily report "), F.col("event_type")).alias("subject"),
        F.array(attachment, note).alias("attachments"),
    )


def q_message_select(spark, sf_dir):
    """CSV attachments of one day's matching messages."""
    msgs = _messages_from_events(spark, sf_dir)
    att = messages.select_attachments(
        msgs, "@REPORTS.example.org", subject="REPORT PUR", target_date=date(2024, 1, 15), ext="csv"
    )
    return att.select("message_id", "date", "sender", "subject", "filename", F.col("payload").cast("string").alias("payload_text"))


def q_mailed_reports(spark, sf_dir):
    """Select one day's CSV attachments, parse them (Python worker, header
    mode), stamp the ingest time, and keep the first loaded report per
    (user, event type)."""
    msgs = _messages_from_events(spark, sf_dir)
    schema = _scratch_schema(spark)
    layers.ingest_mailed_report(
        spark, msgs, "@reports.example.org", "daily report", None, "reports", schema, target_date=date(2024, 1, 15),
        key_columns=["user_id", "event_type"], ext="csv", id_columns=["message_id"],
    )
    return spark.table(tables.fq_name("reports", schema)).select("event_id", "user_id", "event_type")


@F.pandas_udf(T.BinaryType())
def _turn_as_zip(conv_id: pd.Series, turn: pd.Series, role: pd.Series) -> pd.Series:
    # Stand-in input: each conversation turn mailed as a ZIP holding a note,
    # a blank CSV and the report CSV (a title line, then the data line).
    out = []
    for c, t, r in zip(conv_id, turn, role):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("README.txt", "monthly export")
            zf.writestr("blank.csv", "  \n")
            zf.writestr(f"turn_{c}_{t}.CSV", f"conversation export\n{c},{t},{r}\n")
        out.append(buf.getvalue())
    return pd.Series(out)


def q_zip_reports(spark, sf_dir):
    """ZIP bundles: first valid CSV member per archive (case-insensitive
    extension, blank members skipped), one title line skipped, positional
    column names; parsed in the Python worker, combined in Spark."""
    conv = _t(spark, sf_dir, "conversations")
    zips = conv.select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("bundle_id"),
        F.lit(0).cast("long").alias("bundle_ordinal"),
        _turn_as_zip("conv_id", "turn", "role").alias("content"),
    )
    mapping = {0: "conv_id", 1: "turn", 2: "role"}
    # parsed once, checkpointed; column discovery and the result read it
    rows = bundles.materialize(bundles.extract_bundle_rows(zips, "zip", mapping, skiprows=1))
    return bundles.bundle_rows_to_frame(rows, mapping).select("conv_id", "turn", "role", "member")


def _responses_from_tables(spark, sf_dir):
    # Stand-in input: captured API calls.  Event properties come back as JSON,
    # pages as HTML, documents mislabelled as JSON, error events as 204s.
    ev = _t(spark, sf_dir, "events").select(
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("call_id"),
        F.when(F.col("event_type") == "error", F.lit(204)).otherwise(F.lit(200)).alias("status"),
        F.lit("application/json; charset=utf-8").alias("content_type"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("props")).alias("body"),
    )
    pages = _t(spark, sf_dir, "pages").select(
        F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("call_id"),
        F.lit(200).alias("status"), F.lit("text/html").alias("content_type"), F.col("html").alias("body"),
    )
    docs = _t(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("call_id"),
        F.lit(200).alias("status"), F.lit("Application/JSON").alias("content_type"), F.col("text").alias("body"),
    )
    return ev.unionByName(pages).unionByName(docs)


def q_response_classify(spark, sf_dir):
    """Tolerant classification of captured API responses."""
    out = responses.classify_responses(_responses_from_tables(spark, sf_dir))
    return out.select(
        "call_id", "status", "kind",
        F.variant_get("payload", "$.k", "bigint").alias("payload_k"),
        F.md5("text").alias("text_md5"),
    )


def q_strict_payloads(spark, sf_dir):
    """Strict rules: 2xx with a JSON object/array body, arrays exploded; the
    rest is quarantined (error events come back as 500s, pages as HTML)."""
    ev = _t(spark, sf_dir, "events").select(
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("call_id"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("props"), F.lit("]")))
        .otherwise(F.col("props")).alias("body"),
    )
    pages = _t(spark, sf_dir, "pages").select(
        F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("call_id"), F.lit(200).alias("status"),
        F.col("html").alias("body"),
    )
    good, bad = responses.strict_payloads(ev.unionByName(pages))
    return good.select(
        "call_id", "element", F.variant_get("record", "$.k", "bigint").alias("k")
    ).unionByName(
        bad.select("call_id", F.lit(None).cast("int").alias("element"), F.lit(None).cast("bigint").alias("k"))
    ).withColumn("valid", F.col("element").isNotNull())


def q_file_stats(spark, sf_dir):
    """Per-file row count and key ranges (manifest statistics)."""
    li = _t(spark, sf_dir, "lineitem")
    stats = contract.file_stats(li, ["l_orderkey", "l_shipdate"])
    return stats.select(F.regexp_extract("path", r"[^/]+$", 0).alias("file_name"), *[c for c in stats.columns if c != "path"])


def q_source_watermark(spark, sf_dir):
    """Extraction metadata: row count and the ``ts`` watermark range."""
    ev = _t(spark, sf_dir, "events")
    return ev.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("watermark")
    )


# ---------------------------------------------------------------- layers


def q_silver_lineitem(spark, sf_dir):
    """Bronze text → silver: names to standardise, typed by contract with the
    rejected cells beside it (the tax of returned lines reads "n/a"),
    de-duplicated; returns the silver table after its counts are checked."""
    schema = _scratch_schema(spark)
    result = _promote_lineitem(spark, sf_dir, schema)
    if not result.passed or result.rejected_cells != result.rejected_rows:
        raise RuntimeError(f"promotion to silver: {result}")
    return spark.table(tables.fq_name("lineitem", schema))


def q_silver_rejects(spark, sf_dir):
    """Cells that the promotion of ``lineitem`` could not type."""
    schema = _scratch_schema(spark)
    _promote_lineitem(spark, sf_dir, schema)
    return spark.table(tables.fq_name("lineitem_rejects", schema)).drop("rejected_at")


def _promote_lineitem(spark, sf_dir, schema):
    bronze = records.cast_text(_t(spark, sf_dir, "lineitem"))
    bronze = bronze.withColumn("l_tax", F.expr("if(l_returnflag = 'R', 'n/a', l_tax)"))
    bronze = bronze.toDF(*[c.replace("l_", "L ").replace("key", " Key") for c in bronze.columns])
    contract = {
        "l_order_key": "bigint", "l_part_key": "bigint", "l_supp_key": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_shipdate": "timestamp_ntz",
    }
    return layers.promote_to_silver(
        spark, bronze, "lineitem", schema, contract, ["l_order_key", "l_linenumber"], ["l_shipdate"], max_reject_share=0.9
    )


def q_gold_region_revenue(spark, sf_dir):
    """Gold: revenue and order count per region and order year.

    Orders are aggregated per (customer, year) before the join, so the join
    sees one row per customer-year instead of one per order; nation and
    region are tiny dimensions that Spark broadcasts by its size check."""
    o = _t(spark, sf_dir, "orders")
    per_cust = o.groupBy("o_custkey", F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("rev")
    )
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = (
        per_cust.join(c, per_cust.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("r_name", "order_year").agg(
        F.sum("n").alias("n_orders"), F.sum("rev").cast("double").alias("revenue")
    )


QUERIES = {
    "validate_dataframe": q_validate_orders,
    "check_not_null": q_not_null,
    "landing_flow": q_landing_flow,
    "bronze_promotion": q_bronze_promotion,
    "check_null_rate": q_null_rate,
    "check_no_duplicates": q_no_duplicates,
    "duplicate_keys": q_duplicate_keys,
    "relationships": q_relationships,
    "column_stats": q_column_stats,
    "remove_duplicates": q_remove_duplicates,
    "latest_run": q_latest_run,
    "upsert_partial": q_upsert,
    "append_evolve": q_append_evolve,
    "upsert_table": q_upsert_table,
    "last_per_user": q_last_per_user,
    "union_by_name": q_union_by_name,
    "flatten_nested": q_flatten_nested,
    "strict_payloads": q_strict_payloads,
    "file_stats": q_file_stats,
    "flatten_records": q_flatten_events,
    "sanitize_values": q_sanitize,
    "iso_text": q_iso_text,
    "positional_rename": q_positional_rename,
    "cast_text": q_cast_text,
    "constraint_name": q_constraint_names,
    "landing_paths": q_landing_paths,
    "row_checksum": q_row_checksums,
    "allowlist_paths": q_allowlist_pages,
    "message_select": q_message_select,
    "mailed_reports": q_mailed_reports,
    "zip_reports": q_zip_reports,
    "response_classify": q_response_classify,
    "source_watermark": q_source_watermark,
    "silver_lineitem": q_silver_lineitem,
    "silver_rejects": q_silver_rejects,
    "gold_region_orders": q_gold_region_revenue,
    **flows.QUERIES,
    **rules.QUERIES,
}
