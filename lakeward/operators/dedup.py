"""De-duplication and latest-record selection.

Spark has no physical row address, so "keep the first row" needs an explicit
order.  All three operators rank rows with ``row_number()`` inside the key
group and keep rank 1.  Because the filter is ``rank == 1``, Catalyst adds a
*partial* window group limit before the shuffle: each map task forwards at
most one row per key, so a key holding a third of all rows costs one row per
task in the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import qcol

_RANK = "__rank"


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort by a value of this type (maps and variants
    cannot, nor structs/arrays that contain them)."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True


def _as_cols(items) -> list[Column]:
    return [qcol(c) if isinstance(c, str) else c for c in items]


def first_per_key(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """Keep the first row of each key group by ``order_by`` (ascending unless
    a ``Column`` with ``.desc()`` is given).  Null keys form one group.

    ``order_by`` should be a total order within a group; if it is not, ties
    are broken by every remaining column so the survivor is deterministic.
    """
    if not order_by:
        raise ValueError("order_by is required: Spark rows have no physical order")
    used = {c for c in order_by if isinstance(c, str)} | {k for k in keys if isinstance(k, str)}
    tie_break = [qcol(f.name) for f in df.schema.fields if f.name not in used and orderable(f.dataType)]
    w = Window.partitionBy(*_as_cols(keys)).orderBy(*_as_cols(order_by), *tie_break)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def remove_duplicates(
    df: DataFrame, key_columns: list[str], order_by: list
) -> DataFrame:
    """Drop duplicate rows on the business columns ``key_columns``, keeping
    the earliest row by ``order_by`` (e.g. ingest time, then load ordinal).
    Columns outside the key (ingest stamps, unmapped ``col_i``) do not make
    rows distinct."""
    return first_per_key(df, key_columns, order_by)


def last_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Last write wins: the row with the greatest ``order_by`` per key."""
    return first_per_key(df, keys, [qcol(c).desc() for c in order_by])


def latest_per_group(
    df: DataFrame, group_columns: list, time_column: str, tie_breakers: list[str] | None = None
) -> DataFrame:
    """Latest row per group by ``time_column`` (descending), ties broken by
    ``tie_breakers`` descending.  Used to pick the newest run of a
    source/entity/day when a re-run added a file instead of replacing one."""
    order = [qcol(time_column).desc()] + [qcol(c).desc() for c in (tie_breakers or [])]
    return first_per_key(df, group_columns, order)
