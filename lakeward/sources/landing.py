"""Landing zone: immutable, date-addressed Parquet runs.

* :func:`write_landing` never overwrites a run (``errorifexists``).
* :func:`list_files` lists with Spark's ``binaryFile`` source, selecting only
  ``path, length, modificationTime`` so no file content is read.
* :func:`load_landing` reads one source/entity/day.  Spark's Parquet reader
  fills a column missing from one file with nulls; the reference contract is a
  *strict* concat, so the per-file footers are compared first.  Footers are
  read in parallel on the executors (one small task per batch of files), never
  by looping on the driver.
"""

from __future__ import annotations

import logging
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import parse_landing_path
from . import footers
from .paths import landing_prefix, window_patterns

log = logging.getLogger(__name__)

LISTING = "path string, length long, modificationTime timestamp"


def write_landing(df: DataFrame, path: str, overwrite: bool = False) -> str:
    """Write a frame as one landing run and return the path.

    Runs are immutable: an existing path raises unless ``overwrite``.
    """
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read one landing run (file or folder)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def list_files_df(spark: SparkSession, prefix: str, ext: str = "parquet") -> DataFrame:
    """Files under ``prefix`` (recursively) with extension ``ext``:
    ``path, length, modificationTime``.  A missing prefix gives no rows."""
    try:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*.{ext}")
            .load(prefix)
            .select("path", "length", "modificationTime")
        )
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], LISTING)
        raise


def list_files(spark: SparkSession, prefix: str, ext: str = "parquet") -> list[str]:
    """Sorted file paths under ``prefix``; ``[]`` when the prefix is missing.

    The list is as long as the number of files of the prefix (one day of one
    entity), which is what Spark's own file index holds on the driver too."""
    rows = list_files_df(spark, prefix, ext).select("path").collect()
    return sorted(r["path"] for r in rows)


# ------------------------------------------------------------ footers (U01)


def file_schemas(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(path, schema, error)`` of every file, from the footers; ``schema`` is
    its columns with Spark's types."""
    found = footers.footers(spark, files)
    return found.select("path", footers.ddl_of(F.col("schema")).alias("schema"), "error")


def assert_same_schema(spark: SparkSession, files: list[str]) -> None:
    """Raise ``ValueError`` unless every file has the same columns and types
    in the same order, and every footer can be read.  Only the distinct
    schemas (at most two) and one unreadable file reach the driver."""
    if not files:
        return
    read = (
        file_schemas(spark, files)
        .groupBy("schema", F.col("error").isNotNull().alias("bad"))
        .agg(F.min("path").alias("example"), F.min("error").alias("error"))
        .orderBy(F.desc("bad"))
        .limit(3)
        .collect()
    )
    if read and read[0]["bad"]:
        raise ValueError(f"Landing file {read[0]['example']} has an unreadable footer ({read[0]['error']})")
    distinct = read[:2]
    if len(distinct) > 1:
        a, b = distinct
        raise ValueError(
            "Landing files do not share one schema: "
            f"{a['example']} has [{a['schema']}] but {b['example']} has [{b['schema']}]"
        )


def assert_conforms(spark: SparkSession, files: list[str], contract: T.StructType) -> None:
    """Raise ``ValueError`` when a file's footer schema (names and types, in
    order) differs from the contract; footers are read on the executors and
    only the first offending file reaches the driver."""
    expected = footers.schema_ddl(contract)
    same = F.coalesce(F.col("schema") == F.lit(expected), F.lit(False))
    bad = file_schemas(spark, files).filter(~same).orderBy("path").limit(1).collect()
    if bad:
        has = bad[0]["schema"] or f"unreadable footer ({bad[0]['error']})"
        raise ValueError(f"Landing file does not match the contract: {bad[0]['path']} has [{has}]")


def _read_files(spark: SparkSession, files: list[str], schema: T.StructType | None, strict: bool = True) -> DataFrame:
    """Files as one frame, after the footer check."""
    if strict:
        if schema is not None:
            assert_conforms(spark, files, schema)
        else:
            assert_same_schema(spark, files)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*files)


def load_landing(
    spark: SparkSession,
    root: str,
    source: str,
    entity: str,
    run_date: date,
    schema: T.StructType | None = None,
    strict: bool = True,
) -> tuple[list[str], DataFrame]:
    """All Parquet files of one source/entity/day as one frame.

    Raises ``ValueError("No Parquet files found at: {prefix}")`` when the day
    is empty; with ``strict`` the files must share one schema, or match the
    contract ``schema`` file by file when one is given.  ``root`` is the lake
    root (bucket URI), given explicitly.
    """
    prefix = landing_prefix(root, source, entity, run_date)
    files = list_files(spark, prefix)
    if not files:
        raise ValueError(f"No Parquet files found at: {prefix}")
    df = _read_files(spark, files, schema, strict)
    log.info("Loaded %d file(s) under %s", len(files), prefix)
    return files, df


def runs_of_day(spark: SparkSession, root: str, source: str, entity: str, run_date: date) -> DataFrame:
    """One row per run folder of a day: ``run_path, run_id, files,
    modified`` (latest modification time of its files)."""
    prefix = landing_prefix(root, source, entity, run_date)
    files = list_files_df(spark, prefix)
    # The run folder sits directly under the two-digit day folder.
    run_path = F.regexp_extract("path", r"^(.*/\d{2}/[^/]+\.parquet)(?:/[^/]+)?$", 1)
    return (
        files.withColumn("run_path", run_path)
        .groupBy("run_path")
        .agg(
            F.collect_list("path").alias("files"),
            F.max("modificationTime").alias("modified"),
        )
        .withColumn("run_id", F.regexp_extract("run_path", r"([^/]+)\.parquet$", 1))
    )


def latest_run_files(
    spark: SparkSession, root: str, source: str, entity: str, run_date: date
) -> list[str]:
    """Files of the newest run of a day (a re-run adds a run, it does not
    replace one; readers that want one version take the latest)."""
    row = (
        runs_of_day(spark, root, source, entity, run_date)
        .orderBy(F.col("modified").desc(), F.col("run_id").desc())
        .select("files")
        .first()
    )
    return sorted(row["files"]) if row else []


def entity_files(
    spark: SparkSession, root: str, source: str, entity: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Landing files of an entity with their parsed ``run_date`` and ``run_id``
    (metadata only, no file content read).

    With a window only its days are listed: the layout has no ``key=value``
    folders that Spark could prune, so the days become path patterns
    (:func:`paths.window_patterns`), and days that do not exist cost nothing.
    Spark lists many folders in parallel, on the executors."""
    if start is not None and end is not None:
        patterns = window_patterns(root, source, entity, start, end)
        files = spark.createDataFrame([], LISTING)
        for pattern in patterns:
            files = files.unionByName(list_files_df(spark, pattern))
    else:
        files = list_files_df(spark, f"{root}/{source}/{entity}")
    parsed = parse_landing_path(F.col("path"))
    return files.select("path", "length", "modificationTime", parsed["run_date"].alias("run_date"), parsed["run_id"].alias("run_id"))


def landing_days(spark: SparkSession, root: str, source: str, entity: str) -> list[date]:
    """Days that hold at least one run (input for retention)."""
    rows = entity_files(spark, root, source, entity).select("run_date").distinct().collect()
    return sorted(r["run_date"] for r in rows if r["run_date"] is not None)


def _window_paths(files: DataFrame, what: str) -> list[str]:
    """Sorted paths of a window, which Spark's reader takes from the driver."""
    paths = sorted(r["path"] for r in files.select("path").collect())
    if not paths:
        raise ValueError(f"No Parquet files found for {what}")
    return paths


def load_window(
    spark: SparkSession,
    root: str,
    source: str,
    entity: str,
    start: date,
    end: date,
    schema: T.StructType | None = None,
    strict: bool = True,
) -> tuple[list[str], DataFrame]:
    """All runs of the days in ``[start, end]`` (window reprocessing); only
    those days are listed."""
    files = _window_paths(
        entity_files(spark, root, source, entity, start, end), f"{source}/{entity} between {start} and {end}"
    )
    return files, _read_files(spark, files, schema, strict)


def latest_runs(
    spark: SparkSession, root: str, source: str, entity: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """The newest run of every day of an entity (or of a window of days):
    ``run_date, run_id, modified, files`` (one row per day; a re-run adds a run
    rather than replacing one, so readers that want one version per day take
    this)."""
    from ..operators.dedup import latest_per_group

    runs = (
        entity_files(spark, root, source, entity, start, end)
        .filter(F.col("run_date").isNotNull())
        .groupBy("run_date", "run_id")
        .agg(F.max("modificationTime").alias("modified"), F.collect_list("path").alias("files"))
    )
    return latest_per_group(runs, ["run_date"], "modified", ["run_id"])


def load_latest(
    spark: SparkSession,
    root: str,
    source: str,
    entity: str,
    start: date,
    end: date,
    schema: T.StructType | None = None,
) -> tuple[list[str], DataFrame]:
    """Read only the newest run of each day in ``[start, end]``."""
    newest = latest_runs(spark, root, source, entity, start, end)
    files = _window_paths(
        newest.select(F.explode("files").alias("path")), f"{source}/{entity} between {start} and {end}"
    )
    return files, _read_files(spark, files, schema)
