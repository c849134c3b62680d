"""Record-shaping projections: flatten, rename, cast, sanitise, stamp, combine.

All of them are pure projections (no shuffle) except :func:`discover_json_schema`,
which is one aggregation pass to learn the merged schema of a JSON column.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import positional_names, standardize_names
from ..functions.text import iso_text, sanitize_column
from .quality import qcol

# Fixed value: separator between the parts of a flattened field name.
SEPARATOR = "__"


# ------------------------------------------------------------------ flatten


def _leaves(dtype: T.StructType, path: list[str]) -> list[list[str]]:
    """Leaf paths of a struct in document order (depth first)."""
    out: list[list[str]] = []
    for f in dtype.fields:
        if isinstance(f.dataType, T.StructType):
            out.extend(_leaves(f.dataType, path + [f.name]))
        else:
            out.append(path + [f.name])
    return out


def flatten_plan(schema: T.StructType) -> list[list[str]]:
    """Flattened column order: top-level non-struct fields first, in schema
    order, then the leaves of each struct field depth first.  A struct with
    no fields contributes nothing."""
    top = [[f.name] for f in schema.fields if not isinstance(f.dataType, T.StructType)]
    nested: list[list[str]] = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            nested.extend(_leaves(f.dataType, [f.name]))
    return top + nested


def _path_col(path: list[str]) -> Column:
    c = qcol(path[0])
    for p in path[1:]:
        c = c.getField(p)
    return c


def flatten(df: DataFrame, sep: str = SEPARATOR, lists_as_json: bool = True) -> DataFrame:
    """Flatten nested structs into ``a__b__c`` columns (any depth).

    Arrays and maps become JSON text when ``lists_as_json`` (the bronze text
    convention); otherwise they are kept as they are.
    """
    cols = []
    for path in flatten_plan(df.schema):
        c = _path_col(path)
        dtype = _field_type(df.schema, path)
        if lists_as_json and isinstance(dtype, (T.ArrayType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(sep.join(path)))
    return df.select(*cols)


def _field_type(schema: T.StructType, path: list[str]) -> T.DataType:
    dtype: T.DataType = schema
    for p in path:
        assert isinstance(dtype, T.StructType)
        dtype = dtype[p].dataType
    return dtype


def _variant_type_to_ddl(text: str) -> str:
    # schema_of_variant_agg prints OBJECT<...>; the DDL parser wants STRUCT<...>.
    return text.replace("OBJECT<", "STRUCT<")


def discover_json_schema(df: DataFrame, column: str) -> T.DataType:
    """Merged schema of a JSON text column over the whole frame.

    One aggregation pass (``schema_of_variant_agg`` combines per task, so only
    one small schema string per task is shuffled).
    """
    row = df.select(F.expr(f"schema_of_variant_agg(try_parse_json(`{column}`))").alias("s")).first()
    ddl = _variant_type_to_ddl(row["s"]) if row and row["s"] else "STRUCT<>"
    return T.DataType.fromDDL(ddl)


def flatten_json(
    df: DataFrame,
    column: str,
    schema: T.StructType | None = None,
    sep: str = SEPARATOR,
    as_text: bool = True,
) -> DataFrame:
    """Replace a JSON text column by its flattened fields ``{column}__{key}``.

    ``schema`` is the contract; without one, the merged schema is learnt with
    :func:`discover_json_schema`.  ``as_text`` keeps every leaf as text (the
    bronze convention); invalid JSON gives nulls.
    """
    if schema is None:
        found = discover_json_schema(df, column)
        schema = found if isinstance(found, T.StructType) else T.StructType([])
    if as_text:
        schema = _leaves_as_text(schema)
    parsed = F.try_variant_get(F.try_parse_json(qcol(column)), "$", type_string(schema))
    keep = [qcol(c) for c in df.columns if c != column]
    nested = df.select(*keep, parsed.alias(column))
    # Only the JSON column is flattened; the other columns keep their order.
    leaf_cols = [_path_col(path).alias(sep.join(path)) for path in _leaves(schema, [column])]
    return nested.select(*keep, *leaf_cols)


def type_string(dtype: T.DataType) -> str:
    """SQL type text with every struct field name back-quoted (names may hold
    dots or spaces, which ``simpleString()`` leaves bare)."""
    if isinstance(dtype, T.StructType):
        inner = ",".join("`" + f.name.replace("`", "``") + "`:" + type_string(f.dataType) for f in dtype.fields)
        return f"struct<{inner}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{type_string(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{type_string(dtype.keyType)},{type_string(dtype.valueType)}>"
    return dtype.simpleString()


def _leaves_as_text(dtype: T.StructType) -> T.StructType:
    fields = []
    for f in dtype.fields:
        if isinstance(f.dataType, T.StructType):
            fields.append(T.StructField(f.name, _leaves_as_text(f.dataType), True))
        else:
            fields.append(T.StructField(f.name, T.StringType(), True))
    return T.StructType(fields)


# ------------------------------------------------------------ projections


def positional_rename(df: DataFrame, column_mapping: dict[int, str] | None) -> DataFrame:
    """Rename columns by position; unmapped positions become ``col_{i}``."""
    return df.toDF(*positional_names(column_mapping, len(df.columns)))


def cast_text(df: DataFrame) -> DataFrame:
    """Every column as text (the all-TEXT bronze table convention)."""
    return df.select(*[qcol(c).cast("string").alias(c) for c in df.columns])


def sanitize(df: DataFrame) -> DataFrame:
    """Apply the cell sanitiser to every column by type: strings lose NUL
    characters and ``nan``/``nat`` tokens, float NaN becomes null, temporal
    values become ISO-8601 text."""
    return df.select(
        *[sanitize_column(qcol(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def stamp_ingest(df: DataFrame, column: str = "dt_ingest") -> DataFrame:
    """Add the ingest time as ISO text (session time zone, no offset, the
    fraction only when not zero).  ``current_timestamp()`` is fixed per
    query, so every row of one load carries the same value, also when tasks
    are retried."""
    return df.withColumn(column, iso_text(F.current_timestamp()))


def schema_hash(schema: T.StructType) -> str:
    """SHA-256 of the schema's JSON text (schema version marker)."""
    return hashlib.sha256(schema.json().encode()).hexdigest()


def add_bronze_metadata(
    df: DataFrame, run_id: str, source_file: Column | None = None
) -> DataFrame:
    """Technical columns for bronze: ingest time, run id, source file and
    schema hash.  ``source_file`` defaults to the file the row was read from
    (for file sources)."""
    src = source_file if source_file is not None else F.input_file_name()
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.lit(run_id).alias("_run_id"),
        src.alias("_source_file"),
        F.lit(schema_hash(df.schema)).alias("_schema_hash"),
    )


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to the ``[a-z0-9_]`` standard (collisions raise)."""
    return df.toDF(*standardize_names(df.columns))


def apply_types(
    df: DataFrame, contract: dict[str, T.DataType | str], reject_column: str | None = None
) -> DataFrame:
    """Type columns with ``try_cast`` to the contract (bad values → null).

    ``reject_column`` adds the number of cells per row that were not null
    before and null after the cast, so the caller can count rejects.
    """
    cols = _typed_columns(df, contract)
    if reject_column:
        lost = [
            F.when(qcol(c).isNotNull() & qcol(c).try_cast(_kind(contract[c])).isNull(), 1).otherwise(0)
            for c in df.columns
            if c in contract
        ]
        cols.append(reduce(lambda a, b: a + b, lost, F.lit(0)).alias(reject_column))
    return df.select(*cols)


def _kind(target: T.DataType | str) -> T.DataType:
    return T.DataType.fromDDL(target) if isinstance(target, str) else target


def _typed_columns(df: DataFrame, contract: dict) -> list:
    return [qcol(c).try_cast(_kind(contract[c])).alias(c) if c in contract else qcol(c) for c in df.columns]


REJECTS = "_rejects"


def typed_with_rejects(df: DataFrame, contract: dict[str, T.DataType | str]) -> DataFrame:
    """Columns typed as :func:`apply_types` does, and ``_rejects``: for each
    cell that did not convert, its column, its text and the type it should
    have had."""
    cells = []
    for c in df.columns:
        if c in contract:
            kind = _kind(contract[c])
            cell = F.struct(
                F.lit(c).alias("column"), qcol(c).cast("string").alias("value"), F.lit(kind.simpleString()).alias("type")
            )
            cells.append(F.when(qcol(c).isNotNull() & qcol(c).try_cast(kind).isNull(), cell))
    none = F.array().cast("array<struct<column: string, value: string, type: string>>")
    rejects = F.filter(F.array(*cells), lambda x: x.isNotNull()) if cells else none
    return df.select(*_typed_columns(df, contract), rejects.alias(REJECTS))


# ---------------------------------------------------------------- set ops


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Lenient concat by name; a column missing in a frame is null there."""
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_strict(frames: list[DataFrame]) -> DataFrame:
    """Strict vertical concat: every frame must have the same column names and
    types in the same order (checked on schemas, no job)."""
    if not frames:
        raise ValueError("union_strict needs at least one frame")
    first = [(f.name, f.dataType) for f in frames[0].schema.fields]
    for i, other in enumerate(frames[1:], start=1):
        theirs = [(f.name, f.dataType) for f in other.schema.fields]
        if theirs != first:
            raise ValueError(
                f"Frame {i} does not match frame 0: {theirs} != {first}"
            )
    return reduce(lambda a, b: a.union(b), frames)
