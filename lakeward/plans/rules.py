"""Registered queries of the governance rules, extraction and exports.

The rules work on metadata tables; here those are derived from the driver
tables by projections and joins, so that their rows grow with the data:
customers as models with their orders as columns, suppliers as pipelines that
feed orders, events as pipelines with tags.  The SQL beside each computes the
same violations from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import records
from ..session import shared_dir
from ..sources import landing, registry
from . import governance, tables


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nullif(value: str, column: str):
    return F.expr(f"nullif({column}, '{value}')")


# ------------------------------------------------------------ Q11, Q12, Q13


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = F.expr("CASE c_mktsegment WHEN 'BUILDING' THEN 'bronze' WHEN 'MACHINERY' THEN 'silver' ELSE 'gold' END")
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("model"),
        layer.alias("layer"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("description"),
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey").cast("string")).otherwise(F.lit(" ")).alias("owner"),
        F.lit("erp").alias("origin"),
        F.col("c_mktsegment").alias("classification"),
        F.when(F.col("c_nationkey") > 12, F.lit("why")).alias("business_question"),
    )


def q_documentation_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documentation rules by layer: customers are models, orders their columns."""
    columns = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("model"),
        F.col("o_orderkey").cast("string").alias("column"),
        _nullif("5-LOW", "o_orderpriority").alias("description"),
        _nullif("O", "o_orderstatus").alias("calculation_rule"),
        (F.col("o_totalprice") > 100000).alias("is_calculated"),
    )
    return governance.documentation_violations(_models(spark, sf_dir), columns)


_GAPS = """
WITH m AS (
  SELECT CAST(c_custkey AS VARCHAR) AS model, c_nationkey,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'bronze' WHEN 'MACHINERY' THEN 'silver' ELSE 'gold' END AS layer,
         CASE WHEN c_acctbal > 0 THEN c_name END AS description FROM customer),
c AS (SELECT m.model, m.layer, CAST(o_orderkey AS VARCHAR) AS col, o_orderpriority, o_orderstatus, o_totalprice
      FROM orders JOIN m ON m.model = CAST(o_custkey AS VARCHAR))
SELECT model, CAST(NULL AS VARCHAR) AS "column", 'model_description' AS rule FROM m WHERE description IS NULL OR trim(description) = ''
UNION ALL SELECT model, NULL, 'model_owner' FROM m WHERE c_nationkey = 7
UNION ALL SELECT model, NULL, 'gold_business_question' FROM m WHERE layer = 'gold' AND c_nationkey <= 12
UNION ALL SELECT model, col, 'column_description' FROM c WHERE layer IN ('silver', 'gold') AND o_orderpriority = '5-LOW'
UNION ALL SELECT model, col, 'gold_calculation_rule' FROM c
  WHERE layer = 'gold' AND o_totalprice > 100000 AND o_orderstatus = 'O'
"""


def q_model_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most restrictive class of each model: orders are models, line items their
    columns, their return flags and line states the classes (some undeclared)."""
    kind = F.expr(
        "CASE WHEN l_returnflag = 'A' THEN 'publico' WHEN l_linestatus = 'O' THEN 'interno' "
        "WHEN l_tax > 0.06 THEN 'pessoal_sensivel' END"
    )
    columns = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("model"), F.col("l_linenumber").cast("string").alias("column"),
        kind.alias("classification"),
    )
    return governance.model_classification(columns)


_CLASSES = """
SELECT CAST(l_orderkey AS VARCHAR) AS model,
       ['publico', 'interno', 'pessoal', 'pessoal_sensivel'][max(
         CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_linestatus = 'O' THEN 2 WHEN l_tax > 0.06 THEN 4 ELSE 3 END)] AS classification
FROM lineitem GROUP BY l_orderkey
"""


def q_owner_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines (suppliers) whose owner (nation) is not that of the models
    (orders, by their customers' nations) they feed."""
    t = lambda name: _table(spark, sf_dir, name)
    pipelines = t("supplier").select(F.col("s_suppkey").alias("pipeline_id"), F.col("s_nationkey").cast("string").alias("owner"))
    outputs = t("lineitem").select(F.col("l_suppkey").alias("pipeline_id"), F.col("l_orderkey").alias("model")).distinct()
    owners = t("customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("owner"))
    orders = t("orders").select(F.col("o_orderkey").alias("model"), "o_custkey")
    models = orders.join(owners, F.col("o_custkey") == F.col("c_custkey"), "left").select("model", "owner")
    return governance.owner_mismatches(pipelines, outputs, models)


_OWNERS = """
SELECT DISTINCT l_suppkey AS pipeline_id, l_orderkey AS model, CAST(s_nationkey AS VARCHAR) AS pipeline_owner,
       CAST(c_nationkey AS VARCHAR) AS model_owner
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN customer ON c_custkey = o_custkey
WHERE s_nationkey IS DISTINCT FROM c_nationkey
"""

# -------------------------------------------------------- Q14, P10, P11, L09


def q_lineage_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs that nothing reads: parts that no bulk line item holds."""
    parts = _table(spark, sf_dir, "part")
    outputs = parts.select(
        F.col("p_brand").alias("pipeline_id"), F.col("p_partkey").alias("dataset"),
        F.when(F.col("p_size") > 25, F.lit("Gold")).otherwise(F.lit("silver")).alias("layer"),
    )
    bulk = _table(spark, sf_dir, "lineitem").filter("l_quantity >= 49")
    inputs = bulk.select(F.col("l_orderkey").alias("pipeline_id"), F.col("l_partkey").alias("dataset"))
    return governance.lineage_breaks(outputs, inputs)


_BREAKS = """
SELECT p_brand AS pipeline_id, p_partkey AS dataset, CASE WHEN p_size > 25 THEN 'Gold' ELSE 'silver' END AS layer
FROM part WHERE p_size <= 25 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)
"""


def q_name_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naming rules over a listing of as many objects as there are parts."""
    objects = _table(spark, sf_dir, "part").select(
        F.expr("CASE WHEN p_size > 40 THEN concat('gold_', p_brand) ELSE concat('002_slv_', lower(replace(p_brand, '#', '_'))) END").alias("schema_name"),
        F.expr("CASE WHEN p_size < 5 THEN concat('slv_', p_partkey) WHEN p_size < 10 THEN p_name ELSE concat('vw_', p_partkey) END").alias("object_name"),
        F.expr("if(p_size < 20, 'TABLE', 'view')").alias("object_type"),
    )
    return governance.name_violations(objects)


_NAMES = r"""
WITH o AS (
  SELECT CASE WHEN p_size > 40 THEN concat('gold_', p_brand) ELSE concat('002_slv_', lower(replace(p_brand, '#', '_'))) END AS schema_name,
         CASE WHEN p_size < 5 THEN concat('slv_', p_partkey) WHEN p_size < 10 THEN p_name ELSE concat('vw_', p_partkey) END AS object_name,
         p_size < 20 AS is_table FROM part)
SELECT schema_name, object_name, 'schema_layer_prefix' AS rule FROM o
  WHERE NOT regexp_matches(schema_name, '^(000_ref|001_bnz|002_slv|003_gld)_[a-z0-9_]+$')
UNION ALL SELECT schema_name, object_name, 'schema_too_long' FROM o WHERE strlen(schema_name) > 63
UNION ALL SELECT schema_name, object_name, 'object_not_snake_case' FROM o WHERE NOT regexp_matches(object_name, '^[a-z0-9_]+$')
UNION ALL SELECT schema_name, object_name, 'object_too_long' FROM o WHERE strlen(object_name) > 63
UNION ALL SELECT schema_name, object_name, 'table_has_layer_prefix' FROM o
  WHERE is_table AND regexp_matches(object_name, '^(ref|bnz|slv|gld|bronze|silver|gold)_')
UNION ALL SELECT schema_name, object_name, 'view_name_pattern' FROM o
  WHERE NOT is_table AND NOT regexp_matches(object_name, '^vw_[a-z0-9]+(_[a-z0-9]+)*_[a-z0-9]+$')
"""


def q_tag_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag rules over events as pipelines: errors lack the system's tag, views
    carry an unknown dimension."""
    tags = F.expr(
        "CASE event_type WHEN 'error' THEN array('camada:bronze') WHEN 'view' THEN array('sistema:web', concat('tela:', user_id)) "
        "WHEN 'signup' THEN NULL ELSE array('sistema:web', concat('dominio:u', user_id)) END"
    )
    return governance.tag_violations(_table(spark, sf_dir, "events").select(F.col("event_id").alias("pipeline_id"), tags.alias("tags")))


_TAGS = """
SELECT event_id AS pipeline_id, concat('tela:', user_id) AS tag, 'tag_format' AS rule FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, NULL, 'missing_sistema_tag' FROM events WHERE event_type IN ('error', 'signup')
"""


def q_layer_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges against the one-way rule: an order's state and priority name the
    layers of its source and target."""
    layer = "CASE {} WHEN 'F' THEN 'landing' WHEN 'O' THEN 'Bronze' WHEN 'P' THEN 'silver' END"
    to = "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'bronze' WHEN '2' THEN 'silver' WHEN '3' THEN 'gold' WHEN '4' THEN 'landing' ELSE 'mart' END"
    edges = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("src"), F.expr(layer.format("o_orderstatus")).alias("src_layer"),
        F.col("o_orderkey").alias("dst"), F.expr(to).alias("dst_layer"),
    )
    return governance.layer_flow_violations(edges)


_FLOW = """
SELECT * FROM (
  SELECT o_custkey AS src, CASE o_orderstatus WHEN 'F' THEN 'landing' WHEN 'O' THEN 'Bronze' WHEN 'P' THEN 'silver' END AS src_layer,
         o_orderkey AS dst, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'bronze' WHEN '2' THEN 'silver' WHEN '3' THEN 'gold'
           WHEN '4' THEN 'landing' ELSE 'mart' END AS dst_layer FROM orders)
WHERE NOT coalesce((lower(src_layer), dst_layer) IN (('landing', 'bronze'), ('bronze', 'silver'), ('silver', 'gold')), false)
"""

# ------------------------------------------------------ P02, S19, K09, K13


def q_lists_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested lists as JSON text beside flattened scalars: each customer's
    orders."""
    orders = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.struct(F.sort_array(F.collect_list("o_orderkey")).alias("keys"), F.count(F.lit(1)).alias("n")).alias("orders")
    )
    return records.flatten(orders, lists_as_json=True)


_LISTS = """
SELECT o_custkey, '[' || string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) || ']' AS orders__keys, count(*) AS orders__n
FROM orders GROUP BY o_custkey
"""


def q_read_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental extraction: the first days' events give the watermark, the
    second read takes what is newer."""
    events = _table(spark, sf_dir, "events")
    first = events.filter("ts < TIMESTAMP_NTZ '2024-01-20 12:00:00'")
    meta = registry.extraction_metadata(first, "ts")
    return registry.read_since(events, "ts", meta["watermark"])


_SINCE = """
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20 12:00:00')
"""


def q_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV files with a header, and read back."""
    customers = _table(spark, sf_dir, "customer")
    path = tables.to_csv(customers, shared_dir(spark, "export", unique=True))
    files = landing.list_files(spark, path, "csv")
    return spark.read.schema(customers.schema).option("header", "true").option("enforceSchema", "false").csv(files)


QUERIES = {
    "documentation_gaps": q_documentation_gaps,
    "model_classes": q_model_classes,
    "owner_mismatches": q_owner_mismatches,
    "lineage_breaks": q_lineage_breaks,
    "name_lint": q_name_lint,
    "tag_lint": q_tag_lint,
    "layer_flow": q_layer_flow,
    "lists_as_text": q_lists_as_text,
    "read_since": q_read_since,
    "csv_export": q_csv_export,
}
SQL = {
    "documentation_gaps": _GAPS,
    "model_classes": _CLASSES,
    "owner_mismatches": _OWNERS,
    "lineage_breaks": _BREAKS,
    "name_lint": _NAMES,
    "tag_lint": _TAGS,
    "layer_flow": _FLOW,
    "lists_as_text": _LISTS,
    "read_since": _SINCE,
    "csv_export": "SELECT * FROM customer",
}
