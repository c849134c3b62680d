"""Destination tables: create, append, evolve, upsert, de-duplicate, comment.

Tables live in the session catalog as Parquet tables.  Bronze tables keep every
column as text.  Parquet tables have no ``MERGE`` and cannot be overwritten
while they are being read, so every rewrite is *staged*: the new content is
written once under the shared folder, checked, swapped in with an ``INSERT
OVERWRITE`` that reads the staged files, and removed when the counts agree.  Readers are not isolated
during the swap (no table format with snapshots is assumed).

Tables created with ``key_buckets`` are partitioned by a hash bucket of the
primary key; upserts, uniqueness checks and load de-duplication then read
and rewrite only the buckets the incoming rows touch (:func:`bucket_scope`).
A batch that is read several times (upserts, checked appends) is
materialised once in the checkpoint folder.
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import unique_index_name_col
from ..operators import keyfilter
from ..operators.dedup import last_per_key, orderable, remove_duplicates
from ..operators.quality import duplicate_keys, qcol
from ..operators.records import cast_text, flatten
from ..session import durable_dir, ensure_checkpoint_dir, remove_folder, shared_dir

log = logging.getLogger(__name__)

PK_PROPERTY = "lakeward.primary_key"
# One property per unique index: its name after the prefix, its columns as JSON;
# likewise for the key filters: folder, blocks and number of keys.
UNIQUE_PROPERTY = "lakeward.unique_index."
FILTER_PROPERTY = "lakeward.key_filter."
BUCKETS_PROPERTY = "lakeward.key_buckets"
KEY_BUCKET_COLUMN = "_key_bucket"
OVERWRITE_OPTION = "partitionOverwriteMode"
# Spread of rows whose key has a null part (they never match anything).
NULL_KEY_SALTS = 4096


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fq_name(table: str, schema: str = "raw") -> str:
    return f"{_q(schema)}.{_q(table)}"


def sql_text(text: str) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, table: str, schema: str = "raw") -> bool:
    return spark.catalog.tableExists(f"{_q(schema)}.{_q(table)}")


def table_properties(spark: SparkSession, table: str, schema: str = "raw") -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {fq_name(table, schema)}").collect()}


def key_bucket(columns: list, buckets: int):
    """Bucket of a key: ``pmod(xxhash64(key as text), buckets)``.  Hashing
    the text form gives a typed batch and the all-text table the same
    bucket."""
    return F.pmod(F.xxhash64(*[(qcol(c) if isinstance(c, str) else c).cast("string") for c in columns]), F.lit(buckets)).cast("int")


def bucket_scope(
    spark: SparkSession, table: str, schema: str, rows: DataFrame, keys: list[str], props: dict | None = None
) -> tuple[DataFrame, bool]:
    """The part of ``schema.table`` that ``rows`` can share a key with.

    On a key-bucketed table whose bucket key is covered by ``keys``: only the
    buckets the rows hash to (at most ``N`` small integers reach the driver
    and become a partition filter, so only those folders are read).
    Otherwise the whole table.  Returns ``(frame, restricted)``."""
    props = table_properties(spark, table, schema) if props is None else props
    frame = spark.table(fq_name(table, schema))
    buckets = int(props.get(BUCKETS_PROPERTY, "0"))
    bucket_key = props.get(PK_PROPERTY, "").split(",") if buckets else []
    if not buckets or not {k.lower() for k in bucket_key} <= {k.lower() for k in keys}:
        return frame, False
    by_lower = {c.lower(): c for c in rows.columns}
    ids = rows.select(key_bucket([by_lower[k.lower()] for k in bucket_key], buckets).alias("b")).distinct()
    touched = [r["b"] for r in ids.collect()]
    return frame.filter(F.col(KEY_BUCKET_COLUMN).isin(touched)), True


# ----------------------------------------------------------------- K02 / K08


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create a schema if missing, optionally with its folder (managed tables
    of the schema are stored under it)."""
    where = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_q(schema)}{where}")



def create_table_if_not_exists(
    spark: SparkSession,
    columns: list[str],
    table: str,
    primary_key: list[str] | None = None,
    schema: str = "raw",
    key_buckets: int | None = None,
    partition_columns: list[str] | None = None,
) -> None:
    """Create the schema and an all-text table if missing.  Spark does not
    enforce keys, so the primary key is kept as a table property and asserted
    on write (:func:`ensure_unique_constraint`).

    ``key_buckets`` partitions the table by a hash bucket of the primary key
    (``_key_bucket``): an upsert then rewrites only the buckets its batch
    touches instead of the whole table.  ``partition_columns`` (text) come
    before it."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_q(schema)}")
    parts = list(partition_columns or [])
    data_cols = [c for c in columns if c != KEY_BUCKET_COLUMN and c not in parts] + parts
    cols = ", ".join(f"{_q(c)} STRING" for c in data_cols)
    props = {}
    if primary_key:
        props[PK_PROPERTY] = ",".join(primary_key)
    if key_buckets:
        if not primary_key:
            raise ValueError("key_buckets needs a primary_key to hash")
        props[BUCKETS_PROPERTY] = str(int(key_buckets))
        cols += f", {KEY_BUCKET_COLUMN} INT"
        parts.append(KEY_BUCKET_COLUMN)
    partitioning = f" PARTITIONED BY ({', '.join(map(_q, parts))})" if parts else ""
    tbl = ""
    if props:
        tbl = " TBLPROPERTIES (" + ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in props.items()) + ")"
    # rewrites replace the buckets they hold, whatever the session's setting;
    # a table with further partitions is overwritten partition by partition
    options = f" OPTIONS ({OVERWRITE_OPTION} 'dynamic')" if key_buckets and not partition_columns else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {fq_name(table, schema)} ({cols}) USING parquet{options}{partitioning}{tbl}")


def drop_table_if_exists(spark: SparkSession, table: str, schema: str = "raw") -> None:
    spark.sql(f"DROP TABLE IF EXISTS {fq_name(table, schema)}")


# ----------------------------------------------------------------------- K05


def alter_table(spark: SparkSession, columns: list[str], table: str, schema: str = "raw") -> list[str]:
    """Add-only evolution: add missing columns as text, leave the rest.

    Names compare case-insensitively (as unquoted SQL identifiers do).
    Returns the added names; a failure raises."""
    existing = {c.lower() for c in spark.table(fq_name(table, schema)).columns}
    missing, seen = [], set()
    for c in columns:
        if c.lower() not in existing and c.lower() not in seen:
            missing.append(c)
            seen.add(c.lower())
    if missing:
        cols = ", ".join(f"{_q(c)} STRING" for c in missing)
        spark.sql(f"ALTER TABLE {fq_name(table, schema)} ADD COLUMNS ({cols})")
        log.info("Added columns %s to %s.%s", missing, schema, table)
    return missing


# ----------------------------------------------------------------------- K06


def index_name(spark: SparkSession, table: str, columns: list[str]) -> str:
    """Deterministic name of a unique index, by the column expression."""
    name = unique_index_name_col(F.lit(table), [F.lit(c) for c in columns])
    return spark.range(1).select(name.alias("name")).first()["name"]


def unique_keys(props: dict[str, str]) -> dict[str, list[str]]:
    """Unique indexes that a table's properties record: name -> columns."""
    return {
        k.removeprefix(UNIQUE_PROPERTY): json.loads(v) for k, v in sorted(props.items()) if k.startswith(UNIQUE_PROPERTY)
    }


def _set_property(spark: SparkSession, table: str, schema: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {fq_name(table, schema)} SET TBLPROPERTIES ({sql_text(key)} = {sql_text(value)})")


def ensure_unique_constraint(
    spark: SparkSession,
    table: str,
    columns: list[str],
    schema: str = "raw",
    frame: DataFrame | None = None,
    key_filter: bool = False,
) -> str | None:
    """Assert the key is unique (rows with a null key part never collide, as
    in a unique index) and record the index, under its deterministic name, as
    a table property; returns the name.  A table can have several.  Empty
    ``columns`` is a no-op.

    Like ``CREATE UNIQUE INDEX IF NOT EXISTS``, the full scan happens once:
    when the table already records the index, nothing is scanned (all later
    writes keep every recorded index).  With ``key_filter`` the scan's keys
    also go into a filter (:mod:`lakeward.operators.keyfilter`), which later
    appends probe first, so that they read existing keys only for possible
    clashes."""
    if not columns:
        return None
    name = index_name(spark, table, columns)
    props = table_properties(spark, table, schema) if frame is None else {}
    if unique_keys(props).get(name) == list(columns) and (not key_filter or FILTER_PROPERTY + name in props):
        return name
    df = frame if frame is not None else spark.table(fq_name(table, schema))
    clash = duplicate_keys(df, columns).limit(1).collect()
    if clash:
        raise RuntimeError(
            f"Failed to ensure unique constraint on {schema}.{table}: "
            f"duplicate key {[clash[0][c] for c in columns]}"
        )
    if frame is None:
        _set_property(spark, table, schema, UNIQUE_PROPERTY + name, json.dumps(list(columns)))
        if key_filter:
            _new_filter(spark, table, schema, name, columns, df)
    return name


def _store_filter(spark: SparkSession, table: str, schema: str, name: str, rows: DataFrame, blocks: int, keys: int) -> None:
    path = durable_dir(spark, "key_filters", f"{schema}.{table}", name, uuid.uuid4().hex)
    rows.coalesce(max(1, blocks // (1 << 20))).write.mode("errorifexists").parquet(path)
    _set_property(spark, table, schema, FILTER_PROPERTY + name, json.dumps({"path": path, "blocks": blocks, "keys": keys}))


def _new_filter(spark: SparkSession, table: str, schema: str, name: str, columns: list[str], df: DataFrame) -> None:
    keys = df.count()
    blocks = keyfilter.blocks_for(keys)
    _store_filter(spark, table, schema, name, keyfilter.build(df, columns, blocks), blocks, keys)


def _widen_filters(spark: SparkSession, table: str, schema: str, props: dict[str, str], batch: DataFrame, n: int) -> None:
    """Add a batch's keys to the table's filters.  This comes before the rows
    are written: a filter that knows too many keys costs a look-up, one that
    lacks a key would let a clash pass."""
    for name, columns in unique_keys(props).items():
        if FILTER_PROPERTY + name not in props:
            continue
        by_lower = {c.lower(): c for c in batch.columns}
        if not all(c.lower() in by_lower for c in columns):
            continue
        own = batch.select(*[qcol(by_lower[c.lower()]).alias(c) for c in columns])
        state = json.loads(props[FILTER_PROPERTY + name])
        keys = state["keys"] + n
        if keys > state["blocks"] * keyfilter.KEYS_PER_BLOCK:  # too full to tell much
            have = spark.table(fq_name(table, schema)).select(*[qcol(c) for c in columns])
            _new_filter(spark, table, schema, name, columns, have.unionByName(own))
            continue
        old = spark.read.parquet(state["path"])
        rows = keyfilter.merge(old, keyfilter.build(own, columns, state["blocks"]))
        _store_filter(spark, table, schema, name, rows, state["blocks"], keys)
        remove_folder(spark, state["path"])


def _non_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = qcol(k).isNotNull() if cond is None else cond & qcol(k).isNotNull()
    return df.filter(cond)


def _refuse_repeats(rows: DataFrame, keys: list[str]) -> None:
    clash = duplicate_keys(rows, keys).limit(1).collect()
    if clash:
        raise RuntimeError(f"Unique constraint violated: incoming rows repeat key {[clash[0][k] for k in keys]}")


def _refuse_existing(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> None:
    inc = _non_null_keys(incoming, keys).select(*[qcol(k) for k in keys])
    hit = inc.join(existing.select(*[qcol(k) for k in keys]), keys, "left_semi").limit(1).collect()
    if hit:
        raise RuntimeError(f"Unique constraint violated: key {[hit[0][k] for k in keys]} already exists")


def check_incoming_keys(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> None:
    """Unique-index check for an append: the incoming rows must not repeat a
    key among themselves nor hit a key already present (null key parts never
    collide).  Work is proportional to the incoming keys: a semi-join of the
    incoming keys against the existing ones (pass ``existing`` already
    restricted to the touched buckets on a bucketed table)."""
    _refuse_repeats(incoming, keys)
    _refuse_existing(existing, incoming, keys)


def check_append(spark: SparkSession, table: str, schema: str, batch: DataFrame, props: dict[str, str]) -> None:
    """Check a batch against every unique index of the table.  Where an index
    has a filter, only the keys that it may hold are looked up, in their
    buckets; usually there are none and the table is not read at all."""
    by_lower = {c.lower(): c for c in batch.columns}
    for name, columns in unique_keys(props).items():
        if not all(c.lower() in by_lower for c in columns):
            continue  # a missing column is null, and null keys never collide
        rows = batch.select(*[qcol(by_lower[c.lower()]).alias(c) for c in columns])
        _refuse_repeats(rows, columns)
        if FILTER_PROPERTY + name in props:
            state = json.loads(props[FILTER_PROPERTY + name])
            rows = keyfilter.possible(rows, columns, spark.read.parquet(state["path"]), state["blocks"])
            if rows.isEmpty():
                continue
        existing, _ = bucket_scope(spark, table, schema, rows, columns, props)
        _refuse_existing(existing, rows, columns)


def _check_rewrite(spark: SparkSession, table: str, schema: str, staged: DataFrame, rest: DataFrame, done: list[str]) -> None:
    """Check staged content, and what stays beside it, against the unique
    indexes other than ``done`` (which the merge keeps by itself)."""
    have = {c.lower() for c in staged.columns}
    for columns in unique_keys(table_properties(spark, table, schema)).values():
        if [c.lower() for c in columns] != [c.lower() for c in done] and all(c.lower() in have for c in columns):
            check_incoming_keys(rest, staged, columns)


# ------------------------------------------------------------------- upsert


def upsert_frames(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
    salt_null_keys: bool = True,
) -> DataFrame:
    """``INSERT … ON CONFLICT (keys) DO UPDATE`` as a DataFrame.

    * a batch row whose key matches a target row replaces **only the batch's
      columns**; the target's other columns keep their values;
    * unmatched batch rows are inserted (columns the batch lacks are null);
    * columns new in the batch are appended (add-only evolution);
    * null keys never match (unique-index semantics).

    Plan: one full outer equi-join on the keys.  Rows with a null key part
    can never match, but they would all hash to the same reducer (a third of
    the rows with a null key would sit in one task).  They get a salt taken
    from a hash of the whole row (deterministic, so a retried task sees the
    same value); matchable rows get salt 0 on both sides.  The join is on
    ``(keys, salt)``, which spreads the null-key rows without a second pass.
    When both inputs are already hash-partitioned by the keys (bucketed
    tables) and null keys are rare, ``salt_null_keys=False`` joins on the
    keys alone and saves the re-partitioning.

    ``on_duplicate``: ``"error"`` raises when a key repeats in the batch;
    ``"last"`` keeps the row with the greatest ``order_by``.
    """
    if on_duplicate == "last":
        if not order_by:
            raise ValueError('on_duplicate="last" needs order_by')
        batch = last_per_key(batch, keys, order_by)
    elif on_duplicate == "error":
        clash = duplicate_keys(batch, keys).limit(1).collect()
        if clash:
            raise ValueError(f"Batch repeats key {[clash[0][k] for k in keys]}")
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")

    t_cols, b_cols = target.columns, batch.columns
    b_lower = {c.lower(): c for c in b_cols}
    t_lower = {c.lower(): c for c in t_cols}
    out_cols = list(t_cols) + [c for c in b_cols if c.lower() not in t_lower]

    def salted(frame: DataFrame, prefix: str, cols: list[str], key_names: list[str]) -> DataFrame:
        null_key = None
        for k in key_names:
            term = qcol(k).isNull()
            null_key = term if null_key is None else null_key | term
        hashable = [qcol(f.name) for f in frame.schema.fields if orderable(f.dataType)]
        salt = F.when(null_key, F.pmod(F.xxhash64(*hashable), F.lit(NULL_KEY_SALTS)))
        if not salt_null_keys:
            salt = F.lit(None)
        return frame.select(
            *[qcol(c).alias(f"{prefix}{c}") for c in cols],
            F.lit(True).alias(f"{prefix}present"),
            F.coalesce(salt, F.lit(0)).alias(f"{prefix}salt"),
        )

    t_keys = [t_lower[k.lower()] for k in keys]
    b_keys = [b_lower[k.lower()] for k in keys]
    t = salted(target, "t__", t_cols, t_keys)
    b = salted(batch, "b__", b_cols, b_keys)
    cond = F.col("t__salt") == F.col("b__salt") if salt_null_keys else None
    for tk, bk in zip(t_keys, b_keys):
        term = F.col(f"t__{tk}") == F.col(f"b__{bk}")
        cond = term if cond is None else cond & term
    joined = t.join(b, cond, "full_outer")

    sel = []
    for c in out_cols:
        bc, tc = b_lower.get(c.lower()), t_lower.get(c.lower())
        if bc and tc:
            v = F.when(F.col("b__present"), F.col(f"b__{bc}")).otherwise(F.col(f"t__{tc}"))
        elif bc:
            v = F.col(f"b__{bc}")
        else:
            v = F.col(f"t__{tc}")
        sel.append(v.alias(c))
    return joined.select(*sel)


# ------------------------------------------------------------------ writes


def _balanced(frame: DataFrame) -> DataFrame:
    """Rows of a bucketed table dealt by bucket before they are written: a few
    files per bucket and not one per task and bucket.  Spark joins small
    partitions and splits large ones, such as the bucket of all null keys."""
    return frame.hint("rebalance", KEY_BUCKET_COLUMN) if KEY_BUCKET_COLUMN in frame.columns else frame


def _stage_and_swap(
    spark: SparkSession,
    new_content: DataFrame,
    table: str,
    schema: str,
    only_touched_partitions: bool = False,
    check=None,
    before_swap=None,
) -> int:
    """Write ``new_content`` under the shared folder, check it (``check`` gets
    the staged frame), then replace the table's rows with the staged files.
    Returns the row count (observed while the staged copy is written, no extra
    scan).

    Lost executors only retry tasks.  If the driver dies during the swap, the
    staged copy is complete (it was written first), so the swap can be re-run
    from it; it is removed once the rows that went into the table are counted
    to be the same."""
    name = fq_name(table, schema)
    path = shared_dir(spark, "staging", f"{schema}.{table}", unique=True)
    obs = Observation("staged")
    new_content.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
    n = obs.get["n"]
    staged = spark.read.schema(new_content.schema).parquet(path)
    if check is not None:
        check(staged)
    if before_swap is not None:
        before_swap(staged, n)
    cols = spark.table(name).columns
    swapped = Observation("swapped")
    rows = _balanced(staged.select(*[qcol(c) for c in cols])).observe(swapped, F.count(F.lit(1)).alias("n"))
    if only_touched_partitions and not _keeps_other_partitions(spark, table, schema):
        raise ValueError(f"{name} was created without {OVERWRITE_OPTION}: its buckets cannot be replaced one by one")
    rows.write.insertInto(name, overwrite=True)
    if swapped.get["n"] != n:
        raise RuntimeError(f"{name} got {swapped.get['n']} of {n} staged rows; they are kept in {path}")
    remove_folder(spark, path)
    return n


def _keeps_other_partitions(spark: SparkSession, table: str, schema: str) -> bool:
    """Whether an overwrite leaves the partitions alone that it does not hold."""
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {fq_name(table, schema)}").filter("col_name = 'Storage Properties'")
    row = detail.first()
    return bool(row and f"{OVERWRITE_OPTION}=dynamic".lower() in row["data_type"].lower())


def insert_data(
    spark: SparkSession,
    data: DataFrame,
    table: str,
    conflict_fields: list[str] | None = None,
    primary_key: list[str] | None = None,
    schema: str = "raw",
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
) -> int:
    """Append (or upsert on ``conflict_fields``) a batch into an all-text table.

    Empty batch → warning, nothing written.  Nested fields are flattened,
    values cast to text, the table created and evolved as needed.  Returns the
    number of batch rows written."""
    batch = cast_text(flatten(data))
    existing_props = table_properties(spark, table, schema) if table_exists(spark, table, schema) else {}
    reread = bool(conflict_fields) or bool(unique_keys(existing_props))
    if reread:
        # The batch is read several times below (emptiness, buckets, key
        # checks, merge, count): materialise it once in the checkpoint
        # folder, counting its rows in the same pass.
        ensure_checkpoint_dir(spark)
        counted = Observation("batch")
        batch = batch.observe(counted, F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
        batch_rows = counted.get["n"]
        empty = batch_rows == 0
    else:
        batch_rows = None
        empty = batch.isEmpty()
    if empty:
        log.warning("No data to insert into %s.%s", schema, table)
        return 0
    create_table_if_not_exists(spark, batch.columns, table, primary_key, schema)
    alter_table(spark, [c for c in batch.columns if c != KEY_BUCKET_COLUMN], table, schema)
    target_name = fq_name(table, schema)
    props = table_properties(spark, table, schema)
    buckets = int(props.get(BUCKETS_PROPERTY, "0"))
    bucket_key = props.get(PK_PROPERTY, "").split(",") if buckets else []
    if buckets:
        by_lower = {c.lower(): c for c in batch.columns}
        batch = batch.withColumn(KEY_BUCKET_COLUMN, key_bucket([by_lower[k.lower()] for k in bucket_key], buckets))

    if conflict_fields:
        ensure_unique_constraint(spark, table, conflict_fields, schema)
        target, local = bucket_scope(spark, table, schema, batch, conflict_fields, props)
        merged = upsert_frames(target, batch, conflict_fields, on_duplicate, order_by)
        props = table_properties(spark, table, schema)

        def check(staged: DataFrame) -> None:
            # what the swap does not replace: the buckets beside the staged ones
            whole = spark.table(target_name)
            rest = whole.join(staged.select(KEY_BUCKET_COLUMN).distinct(), KEY_BUCKET_COLUMN, "left_anti") if local else whole.limit(0)
            _check_rewrite(spark, table, schema, staged, rest, conflict_fields)

        _stage_and_swap(
            spark, merged, table, schema, only_touched_partitions=local, check=check,
            before_swap=lambda staged, n: _widen_filters(spark, table, schema, props, staged, batch_rows),
        )
        return batch_rows
    if unique_keys(props):
        check_append(spark, table, schema, batch, props)
        _widen_filters(spark, table, schema, props, batch, batch_rows)
    cols = spark.table(target_name).columns
    by_lower = {c.lower(): c for c in batch.columns}
    aligned = batch.select(
        *[
            (qcol(by_lower[c.lower()]) if c.lower() in by_lower else F.lit(None).cast("string")).alias(c)
            for c in cols
        ]
    )
    obs = Observation("appended")
    _balanced(aligned).observe(obs, F.count(F.lit(1)).alias("n")).write.insertInto(target_name)
    return obs.get["n"]


def remove_duplicates_table(
    spark: SparkSession,
    table: str,
    key_columns: list[str],
    order_by: list[str],
    schema: str = "public",
    touched_by: DataFrame | None = None,
) -> int:
    """Keep the first row per business key (by ``order_by``) in a table;
    returns the surviving row count (of the rewritten part).

    On a key-bucketed table whose bucket key is part of ``key_columns``,
    ``touched_by`` (the rows just loaded) limits the work to their buckets:
    new duplicates can only involve keys that were just loaded."""
    if touched_by is not None:
        df, local = bucket_scope(spark, table, schema, touched_by, key_columns)
    else:
        df, local = spark.table(fq_name(table, schema)), False
    return _stage_and_swap(spark, remove_duplicates(df, key_columns, order_by), table, schema, only_touched_partitions=local)


def _own_properties(props: dict[str, str]) -> dict[str, str]:
    """Properties that a user or this library set, without key filters, which
    belong to the rows."""
    return {
        k: v for k, v in props.items() if not k.startswith(("spark.", FILTER_PROPERTY)) and k not in ("transient_lastDdlTime", "comment")
    }


def replace_content(spark: SparkSession, content: DataFrame, table: str, schema: str) -> int:
    """Replace a table by new content, columns included, in one overwrite that
    keeps what is known about it: properties, its unique indexes (the content
    is checked against them first), key buckets, key filters (built anew), and
    the comments of the table and of the columns that remain.  Returns the row
    count, observed during the write."""
    name = fq_name(table, schema)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_q(schema)}")
    known = table_exists(spark, table, schema)
    props = table_properties(spark, table, schema) if known else {}
    note = spark.catalog.getTable(name).description if known else None
    comments = {c.name: c.description for c in spark.catalog.listColumns(name) if c.description} if known else {}
    by_lower = {c.lower(): c for c in content.columns}
    indexes = {i: k for i, k in unique_keys(props).items() if all(c.lower() in by_lower for c in k)}
    for columns in indexes.values():
        _refuse_repeats(content, [by_lower[c.lower()] for c in columns])
    writer_options = {}
    buckets, key = int(props.get(BUCKETS_PROPERTY, "0")), props.get(PK_PROPERTY, "").split(",")
    bucketed = bool(buckets) and all(k.lower() in by_lower for k in key)
    if bucketed:
        content = content.withColumn(KEY_BUCKET_COLUMN, key_bucket([by_lower[k.lower()] for k in key], buckets))
        writer_options[OVERWRITE_OPTION] = "dynamic"
    seen = Observation("refresh")
    writer = _balanced(content).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format("parquet")
    writer = writer.options(**writer_options)
    (writer.partitionBy(KEY_BUCKET_COLUMN) if bucketed else writer).saveAsTable(name)
    n = seen.get["n"]
    keep = _own_properties(props)
    if not bucketed:
        keep.pop(BUCKETS_PROPERTY, None)
    for i in unique_keys(props).keys() - indexes.keys():
        keep.pop(UNIQUE_PROPERTY + i, None)
    for k, v in keep.items():
        _set_property(spark, table, schema, k, v)
    for i, columns in indexes.items():
        if FILTER_PROPERTY + i in props:
            _new_filter(spark, table, schema, i, columns, spark.table(name))
    present = {c.lower() for c in content.columns}
    apply_comments(spark, schema, table, note, {c: t for c, t in comments.items() if c.lower() in present})
    return n


def full_refresh(spark: SparkSession, data: DataFrame, table: str, schema: str = "raw") -> int:
    """Replace a table by a new all-text load (:func:`replace_content`)."""
    return replace_content(spark, cast_text(flatten(data)), table, schema)


def write_table(df: DataFrame, table: str, schema: str) -> int:
    """Promote a frame into a table (append, all text) and return the row
    count, observed during the write."""
    return insert_data(df.sparkSession, df, table, schema=schema)


# -------------------------------------------------------- K09, K11-K13


def apply_comments(
    spark: SparkSession,
    schema: str,
    table: str,
    table_comment: str | None = None,
    column_comments: dict[str, str] | None = None,
) -> list[str]:
    """Bring a table's comments in line with the declared ones.  What is
    declared empty, or already says so, is left alone: a second call changes
    nothing.  A column that the table lacks fails before anything changes.
    Returns the statements run."""
    name = fq_name(table, schema)
    present = {c.name.lower(): (c.name, c.description or "") for c in spark.catalog.listColumns(name)}
    declared = {c: t for c, t in (column_comments or {}).items() if t}
    unknown = sorted(c for c in declared if c.lower() not in present)
    if unknown:
        raise RuntimeError(f"{name} has no column {', '.join(unknown)}")
    changed = [(present[c.lower()][0], t) for c, t in declared.items() if present[c.lower()][1] != t]
    statements = [f"ALTER TABLE {name} ALTER COLUMN {_q(c)} COMMENT {sql_text(t)}" for c, t in changed]
    if table_comment and spark.catalog.getTable(name).description != table_comment:
        statements.append(f"COMMENT ON TABLE {name} IS {sql_text(table_comment)}")
    for statement in statements:
        execute_non_query(spark, statement)
    return statements


def execute_query(spark: SparkSession, query: str) -> DataFrame:
    """Run a query; the result stays a lazy DataFrame."""
    return spark.sql(query)


def execute_non_query(spark: SparkSession, statement: str) -> None:
    """Run a statement; any failure becomes ``RuntimeError``."""
    try:
        spark.sql(statement)
    except AnalysisException as exc:
        raise RuntimeError("Failed to execute statement") from exc
    except Exception as exc:  # parse errors and runtime failures alike
        raise RuntimeError("Failed to execute statement") from exc


def to_csv(df: DataFrame, path: str) -> str:
    """Write the frame as CSV with a header row (no index column exists)."""
    df.write.mode("errorifexists").option("header", "true").csv(path)
    return path
