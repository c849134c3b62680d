"""Parquet footers as a table: schema, row count and statistics of each file.

Footers are read on the executors, a few kilobytes per file and no data pages.
The schema of a file is the Spark schema that the writer kept in the footer's
key-value metadata, which tells TIMESTAMP and TIMESTAMP_NTZ (and every other
Spark type) apart; files of other writers are mapped from their Parquet types.

Where a path can be opened from Python, its store is opened with the session's
own settings (endpoint, keys, region of ``fs.s3a.*``).  Any other store is one
that only Spark reaches: its files are read with Spark's binary reader, whole.
"""

from __future__ import annotations

import datetime as dt
import decimal
import io
import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_library

#: Footer metadata key of Spark's writer.
SPARK_SCHEMA_KEY = b"org.apache.spark.sql.parquet.row.metadata"

FOOTERS = (
    "path string, error string, schema string, n_rows long, row_groups int, "
    "columns array<struct<name: string, nulls: long, min: string, max: string>>"
)
#: Settings of the session that a store is opened with, by pyarrow's name.
_S3_SETTINGS = {
    "access_key": "fs.s3a.access.key",
    "secret_key": "fs.s3a.secret.key",
    "session_token": "fs.s3a.session.token",
    "region": "fs.s3a.endpoint.region",
}


def store_options(spark: SparkSession) -> dict[str, str]:
    """Arguments of ``pyarrow.fs.S3FileSystem`` from the session's settings."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    options = {name: conf.get(key) for name, key in _S3_SETTINGS.items() if conf.get(key)}
    endpoint = conf.get("fs.s3a.endpoint")
    if endpoint:
        scheme, _, host = endpoint.rpartition("://")
        options["endpoint_override"] = host.rstrip("/")
        options["scheme"] = scheme or "https"
    return options


def opens_from_python(path: str) -> bool:
    return path.split("://")[0] in ("s3a", "s3") if "://" in path else True


def is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def open_file(path: str, options: dict[str, str]):
    """A random-access file of a local path or an S3 object."""
    import pyarrow.fs as fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    return fs.S3FileSystem(**options).open_input_file(path.split("://", 1)[1])


# ---------------------------------------------------------------- one footer


def _spark_type(t, physical: str | None) -> T.DataType:
    """Spark's type for an Arrow type of a file without a Spark schema."""
    import pyarrow.types as at
    from pyspark.sql.pandas.types import from_arrow_type

    if at.is_timestamp(t):
        # the 96-bit form always is an instant
        return T.TimestampType() if t.tz or physical == "INT96" else T.TimestampNTZType()
    if at.is_struct(t):
        return T.StructType([T.StructField(f.name, _spark_type(f.type, None)) for f in t])
    if at.is_list(t) or at.is_large_list(t):
        return T.ArrayType(_spark_type(t.value_type, None))
    if at.is_map(t):
        return T.MapType(_spark_type(t.key_type, None), _spark_type(t.item_type, None))
    return from_arrow_type(t)


def footer_schema(meta) -> T.StructType:
    """The Spark schema of a file's footer."""
    kept = (meta.metadata or {}).get(SPARK_SCHEMA_KEY)
    if kept:
        return T.StructType.fromJson(json.loads(kept))
    physical = {meta.schema.column(i).path: meta.schema.column(i).physical_type for i in range(len(meta.schema))}
    fields = meta.schema.to_arrow_schema()
    return T.StructType([T.StructField(f.name, _spark_type(f.type, physical.get(f.name))) for f in fields])


def _as_text(value) -> str | None:
    """A bound as text that Spark casts back to the column's type; None for
    kinds without such a text."""
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, str, dt.date, decimal.Decimal)):
        return str(value)
    return repr(value) if isinstance(value, float) else None


def footer_columns(meta, schema: T.StructType) -> list[dict]:
    """Nulls, minimum and maximum of each flat column over all row groups.  A
    bound is null where some row group has none (96-bit timestamps, NaN)."""
    at = {meta.schema.column(i).path: i for i in range(len(meta.schema))}
    out = []
    for name in schema.fieldNames():
        if name not in at:
            continue
        nulls, low, high, known = 0, None, None, True
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(at[name])
            stats = column.statistics if column.is_stats_set else None
            count = stats.null_count if stats is not None and stats.has_null_count else None
            nulls = None if count is None or nulls is None else nulls + count
            if count is not None and count == column.num_values:
                continue  # all null: no bound is missing
            if stats is None or not stats.has_min_max:
                known = False
                continue
            a, b = stats.min, stats.max
            if any(isinstance(x, float) and math.isnan(x) for x in (a, b)):
                known = False
                continue
            low = a if low is None or a < low else low
            high = b if high is None or b > high else high
        bounds = (_as_text(low), _as_text(high)) if known else (None, None)
        out.append({"name": name, "nulls": nulls, "min": bounds[0], "max": bounds[1]})
    return out


def _read(path: str, source) -> dict:
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(source).metadata
    schema = footer_schema(meta)
    return {
        "path": path, "error": None, "schema": schema.json(), "n_rows": meta.num_rows,
        "row_groups": meta.num_row_groups, "columns": footer_columns(meta, schema),
    }


_NAMES = ["path", "error", "schema", "n_rows", "row_groups", "columns"]


def _footer_reader(options: dict[str, str]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            contents = frame["content"] if "content" in frame else [None] * len(frame)
            for path, content in zip(frame["path"], contents, strict=True):
                try:
                    if content is not None:
                        rows.append(_read(path, io.BytesIO(content)))
                    else:
                        with open_file(path, options) as source:
                            rows.append(_read(path, source))
                except Exception as exc:  # reported per file, the caller decides
                    rows.append(dict.fromkeys(_NAMES) | {"path": path, "error": f"{type(exc).__name__}: {exc}"})
            frame = pd.DataFrame(rows, columns=_NAMES, dtype=object)
            yield frame.astype({"n_rows": "Int64", "row_groups": "Int32"})

    return run


def footers(spark: SparkSession, files: list[str]) -> DataFrame:
    """One row per file: its schema (JSON of a Spark schema), rows, row groups
    and columns' statistics, or the error that kept its footer unread."""
    ship_library(spark)
    reader = _footer_reader(store_options(spark))
    direct = [f for f in files if is_local(f) or opens_from_python(f)]
    others = [f for f in files if not (is_local(f) or opens_from_python(f))]
    parts = max(1, min(len(direct) // 16, 4 * spark.sparkContext.defaultParallelism))
    out = spark.createDataFrame([(f,) for f in direct], "path string").repartition(parts).mapInPandas(reader, FOOTERS)
    if others:
        whole = spark.read.format("binaryFile").load(others).select("path", "content")
        out = out.unionByName(whole.mapInPandas(reader, FOOTERS))
    return out


def schema_ddl(schema: T.StructType) -> str:
    """``name: type`` of each field, in order; nullability is left out, as
    files hold every column as nullable."""
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in schema.fields)


def ddl_of(schema_json) -> F.Column:
    """``schema_ddl`` of a column of schemas.  Files share few schemas, so the
    text is made once for each distinct one (a broadcast-free map)."""

    @F.pandas_udf("string")
    def convert(column: pd.Series) -> pd.Series:
        known = {x: schema_ddl(T.StructType.fromJson(json.loads(x))) for x in column.dropna().unique()}
        return pd.Series([known.get(x) for x in column], dtype=object)

    return convert(schema_json)


# ------------------------------------------------------------- file skipping


def bound(value, kind: T.DataType) -> F.Column:
    """A limit as a literal of a column's type.  Times go as text: a time
    without a zone means the same whatever zone Python or the session is in."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def may_match(name: str, kind: T.DataType, low=None, high=None) -> F.Column:
    """Whether a file with ``columns`` statistics can hold a row with ``name``
    between ``low`` and ``high`` (inclusive, None: open).  Unknown bounds can."""
    found = F.get(F.filter("columns", lambda c: c["name"] == name), F.lit(0))
    least, most = found["min"].try_cast(kind), found["max"].try_cast(kind)
    can = ~(F.coalesce(found["nulls"] == F.col("n_rows"), F.lit(False)))
    if low is not None:
        can = can & F.coalesce(most >= bound(low, kind), F.lit(True))
    if high is not None:
        can = can & F.coalesce(least <= bound(high, kind), F.lit(True))
    return can
