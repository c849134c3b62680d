"""Layer promotion: land → bronze → silver → gold, and the mailed-report load.

Each step is a short composition of the library's operators; the gate
between layers is the quality suite, whose single aggregation decides on the
driver whether the write happens.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, quality, records
from ..operators.quality import CheckResult
from ..session import remove_folder, shared_dir
from ..sources import bundles, landing, messages
from ..sources.paths import build_landing_path
from . import governance, tables

log = logging.getLogger(__name__)


@dataclass
class PromotionResult:
    passed: bool
    results: list[CheckResult]
    files: list[str] = field(default_factory=list)
    rows_written: int = 0


def land(df: DataFrame, root: str, source: str, entity: str, run_date: date, run_id: str) -> str:
    """Extract output → one immutable landing run; returns its path."""
    return landing.write_landing(df, build_landing_path(root, source, entity, run_date, run_id))


def promote_landing_to_bronze(
    spark: SparkSession,
    root: str,
    source: str,
    entity: str,
    run_date: date,
    table: str,
    schema: str,
    expected_columns: list[str],
    not_null_columns: list[str],
    key_columns: list[str],
    run_id: str,
    min_rows: int = 1,
    contract=None,
    results_table: str | None = None,
    key_buckets: int | None = None,
) -> PromotionResult:
    """Read the day (strict concat), run the suite in one job, and only when
    every check passes append the rows with bronze metadata (ingest time,
    run id, source file, schema hash).  ``results_table`` keeps the check
    results of every promotion (passed or not) in the same schema.
    ``key_buckets`` creates a new bronze table partitioned by a bucket of
    ``key_columns``, so later upserts and key checks stay bucket-local.

    The check job reads only the columns the checks need; the write scans
    the files again (column pruning makes the first scan cheap, and nothing
    is pinned in memory)."""
    files, df = landing.load_landing(spark, root, source, entity, run_date, schema=contract)
    passed, results = quality.validate_dataframe(df, expected_columns, not_null_columns, key_columns, min_rows)
    if results_table:
        _record_results(spark, results_table, schema, source, entity, run_date, run_id, results)
    if not passed:
        log.warning("Promotion of %s/%s %s blocked: %s", source, entity, run_date, [r for r in results if not r.passed])
        return PromotionResult(False, results, files, 0)
    with_meta = records.add_bronze_metadata(df, run_id, F.col("_metadata.file_path"))
    if key_buckets and key_columns and not tables.table_exists(spark, table, schema):
        tables.create_table_if_not_exists(spark, with_meta.columns, table, key_columns, schema, key_buckets)
    n = tables.insert_data(spark, with_meta, table, schema=schema)
    return PromotionResult(True, results, files, n)


def _record_results(spark, table, schema, source, entity, run_date, run_id, results) -> None:
    """Append one row per check to ``schema.table`` (the quality history)."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    rows = [(source, entity, run_date, run_id, r.check_name, bool(r.passed), r.message) for r in results]
    frame = spark.createDataFrame(
        rows, "source string, entity string, run_date date, run_id string, check_name string, passed boolean, message string"
    ).withColumn("checked_at", F.current_timestamp())
    name = tables.fq_name(table, schema)
    if tables.table_exists(spark, table, schema):
        frame.write.insertInto(name)
    else:
        frame.write.format("parquet").saveAsTable(name)


def bronze_to_silver(
    bronze: DataFrame,
    contract: dict,
    key_columns: list[str],
    order_by: list,
) -> DataFrame:
    """Standardise names, type by contract (``try_cast``), keep the first row
    per business key.  No aggregation, no joins."""
    std = records.standardize_columns(bronze)
    typed = records.apply_types(std, contract)
    return dedup.remove_duplicates(typed, key_columns, order_by)


@dataclass
class SilverResult:
    """``rejected_rows`` are rows with a cell that did not convert; the cells
    are in the reject table, whether the promotion passed or not."""

    passed: bool
    rows_read: int
    rejected_rows: int
    rejected_cells: int
    rows_written: int = 0

    @property
    def share(self) -> float:
        return self.rejected_rows / self.rows_read if self.rows_read else 0.0


def promote_to_silver(
    spark: SparkSession,
    bronze: DataFrame,
    table: str,
    schema: str,
    contract: dict,
    key_columns: list[str],
    order_by: list,
    max_reject_share: float = 0.0,
    reject_table: str | None = None,
) -> SilverResult:
    """Bronze → silver with the rejected cells as a table beside it.

    Names are standardised and cells typed in one pass over bronze, which
    writes the typed rows once and counts rows, rejected rows and rejected
    cells on the way.  From there go two sinks: ``reject_table`` (default
    ``{table}_rejects``) gets one row per rejected cell with the row's keys,
    column, text and type; silver gets the first row per key, with null in
    rejected cells, if no more than ``max_reject_share`` of the rows had one.
    Otherwise silver stays as it was."""
    typed = records.typed_with_rejects(records.standardize_columns(bronze), contract)
    seen = Observation("typed")
    count = F.size(records.REJECTS)
    staging = shared_dir(spark, "staging", f"{schema}.{table}", unique=True)
    typed.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(count > 0).alias("bad"), F.coalesce(F.sum(count), F.lit(0)).alias("cells")
    ).write.parquet(staging)
    n = seen.get
    staged = spark.read.schema(typed.schema).parquet(staging)
    result = SilverResult(True, n["rows"], n["bad"], n["cells"])
    result.passed = result.share <= max_reject_share
    if result.rejected_cells:
        keys = [F.col(f"`{k}`").cast("string").alias(k) for k in key_columns]
        cells = staged.filter(count > 0).select(*keys, F.inline(records.REJECTS))
        _append(spark, cells.withColumn("rejected_at", F.current_timestamp()), reject_table or f"{table}_rejects", schema)
        log.warning("%s.%s: %d cells of %d rows did not convert", schema, table, result.rejected_cells, result.rejected_rows)
    if result.passed:
        first = dedup.remove_duplicates(staged.drop(records.REJECTS), key_columns, order_by)
        result.rows_written = tables.replace_content(spark, first, table, schema)
    remove_folder(spark, staging)
    return result


def _append(spark: SparkSession, frame: DataFrame, table: str, schema: str) -> int:
    """Append a typed frame to a table, created when missing; returns the
    number of rows, observed during the write."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    seen = Observation("appended")
    frame.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").format("parquet").saveAsTable(
        tables.fq_name(table, schema)
    )
    return seen.get["n"]


def publish_gold(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    schema: str,
    model: str,
    models: DataFrame,
    columns: DataFrame,
    violations_table: str | None = None,
) -> int:
    """Write a gold table only when its documentation is complete (model
    description, owner, origin, class, business question; every column
    described, calculated columns with their rule).  What is missing goes to
    ``violations_table`` (default ``{table}_documentation_gaps``), all of it.
    The table keeps its properties and comments when it is replaced."""
    gaps = governance.documentation_violations(models.filter(F.col("model") == model), columns.filter(F.col("model") == model))
    if not gaps.isEmpty():
        where = violations_table or f"{table}_documentation_gaps"
        n = _append(spark, gaps.withColumn("checked_at", F.current_timestamp()), where, schema)
        raise ValueError(f"Gold model {model} is not documented: {n} gap(s), listed in {schema}.{where}")
    return tables.replace_content(spark, df, table, schema)


def ingest_mailed_report(
    spark: SparkSession,
    mail: DataFrame,
    sender_email: str,
    subject: str | None,
    column_mapping: dict[int, str] | None,
    table: str,
    schema: str = "public",
    skiprows: int = 0,
    target_date: date | None = None,
    subject_suffix: str | None = None,
    delimiter: str | None = None,
    key_buckets: int | None = None,
    key_columns: list[str] | None = None,
    **selection,
) -> tuple[int, int]:
    """Mailed ZIP reports → table: select, extract, stamp ``dt_ingest``,
    append, then remove duplicates on ``key_columns`` (default: the mapped
    business columns, or all) keeping the first loaded row.  Returns ``(rows
    appended, rows kept)``; ``(0, 0)`` when nothing valid arrived.  Rejected
    bundles go to ``{table}_rejected`` with their error.  ``selection`` goes to
    :func:`lakeward.sources.messages.process_mailed_reports` (``ext``,
    ``id_columns``).

    ``key_buckets`` (for a new table) buckets it by the business columns, so
    each load de-duplicates only the buckets it touched."""
    rows, rejected = messages.process_mailed_reports(
        mail, sender_email, subject, column_mapping, skiprows, target_date, subject_suffix, delimiter, **selection
    )
    if not rejected.isEmpty():
        n = _append(spark, rejected.withColumn("rejected_at", F.current_timestamp()), f"{table}_rejected", schema)
        log.warning("%d bundle(s) skipped, listed in %s.%s_rejected", n, schema, table)
    if rows.isEmpty():
        log.warning("No CSV processed")
        return 0, 0
    # Load order survives in the table as text: zero-padded so that text
    # order equals load order.
    load_key = F.concat_ws(
        "|", F.lpad(F.col("bundle_ordinal").cast("string"), 20, "0"), F.col("bundle_id"),
        F.lpad(F.col("row_ordinal").cast("string"), 20, "0"),
    )
    business = [c for c in rows.columns if c not in bundles.BUNDLE_KEYS]
    staged = records.stamp_ingest(rows.select(*[quality.qcol(c) for c in business], load_key.alias("_load_key")))
    keys = key_columns or (list(column_mapping.values()) if column_mapping else business)
    if key_buckets and not tables.table_exists(spark, table, schema):
        tables.create_table_if_not_exists(spark, staged.columns, table, keys, schema, key_buckets)
    appended = tables.insert_data(spark, staged, table, schema=schema)
    kept = tables.remove_duplicates_table(
        spark, table, keys, ["dt_ingest", "_load_key"], schema, touched_by=rows if key_buckets else None
    )
    return appended, kept


def merge_into_silver(
    spark: SparkSession,
    new_bronze: DataFrame,
    table: str,
    schema: str,
    contract: dict,
    key_columns: list[str],
    order_by: list,
    key_buckets: int | None = None,
) -> int:
    """Incremental bronze → silver with keep-first semantics.

    Only the new bronze rows are standardised, typed and de-duplicated; rows
    whose key silver already holds are dropped (the earlier row wins; null
    key parts compare equal, as in the full de-duplication), the rest are
    appended.  The work follows the size of the new rows: on a key-bucketed
    silver table only the touched buckets are read for the key check.
    Assumes loads arrive in ``order_by`` order (a late, older row for an
    existing key needs the full :func:`bronze_to_silver`).  Returns the
    number of rows appended."""
    typed = bronze_to_silver(new_bronze, contract, key_columns, order_by)
    name = tables.fq_name(table, schema)
    if key_buckets:
        typed = typed.withColumn(tables.KEY_BUCKET_COLUMN, tables.key_bucket(key_columns, key_buckets))
    obs = Observation("silver")
    if not tables.table_exists(spark, table, schema):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
        writer = typed.observe(obs, F.count(F.lit(1)).alias("n")).write.format("parquet")
        if key_buckets:
            writer = writer.partitionBy(tables.KEY_BUCKET_COLUMN).option(tables.OVERWRITE_OPTION, "dynamic")
        writer.saveAsTable(name)
        if key_buckets:
            lit = tables.sql_text
            spark.sql(
                f"ALTER TABLE {name} SET TBLPROPERTIES ({lit(tables.PK_PROPERTY)} = {lit(','.join(key_columns))}, "
                f"{lit(tables.BUCKETS_PROPERTY)} = {lit(str(int(key_buckets)))})"
            )
        return obs.get["n"]
    existing, _ = tables.bucket_scope(spark, table, schema, typed, key_columns)
    keys = existing.select(*[quality.qcol(k).alias(f"__k{i}") for i, k in enumerate(key_columns)]).distinct()
    cond = None
    for i, k in enumerate(key_columns):
        term = quality.qcol(k).eqNullSafe(F.col(f"__k{i}"))
        cond = term if cond is None else cond & term
    fresh = typed.join(keys, cond, "left_anti")
    cols = spark.table(name).columns
    fresh.select(*[quality.qcol(c) for c in cols]).observe(obs, F.count(F.lit(1)).alias("n")).write.insertInto(name)
    return obs.get["n"]
