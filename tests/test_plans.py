"""Plan-shape tests: the scale properties the design relies on, read from
``explain()`` so a refactor that loses them fails here."""

import contextlib
import io

from pyspark.sql import functions as F

from lakeward.operators import dedup, quality, records
from lakeward.plans import governance, tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def nodes(p: str, name: str) -> int:
    """Number of plan nodes called ``name`` (detail entries ``(n) name``)."""
    return sum(1 for line in p.splitlines() if line.startswith("(") and line.split(") ", 1)[-1].startswith(name))


def test_dedup_limits_rows_before_the_exchange(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(dedup.remove_duplicates(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert nodes(p, "WindowGroupLimit") == 2 and ", Partial" in p and ", Final" in p
    assert nodes(p, "Exchange") == 1
    # in the tree the partial limit (lower) is printed after the exchange
    tree = p.split("\n\n", 1)[0]
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_fused_suite_is_one_pruned_scan(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(quality.validation_frame(o, ["o_orderkey"], ["o_custkey"], ["o_orderkey"]))
    assert nodes(p, "Scan parquet") == 1
    read_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "o_orderkey" in read_schema and "o_custkey" in read_schema and "o_totalprice" not in read_schema


def test_path_selection_has_no_join(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    p = plan(governance.select_paths(pages, "url", "a/\nb/\n", "https://"))
    assert "Join" not in p and "Exchange" not in p


def test_upsert_is_one_join(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    t = c.select("c_custkey", "c_name")
    b = c.select("c_custkey", F.upper("c_mktsegment").alias("seg"))
    p = plan(tables.upsert_frames(t, b, ["c_custkey"], on_duplicate="last", order_by=["seg"]))
    joins = [line for line in p.splitlines() if line.startswith("(") and "Join" in line]
    assert len(joins) == 1 and "FullOuter" in p


def test_flatten_json_is_a_projection(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(records.flatten_json(ev, "props"))
    assert "Exchange" not in p and "Join" not in p


def test_filters_reach_the_scan(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    from lakeward.sources.registry import read_since

    p = plan(read_since(ev, "ts", "2024-01-10"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p
