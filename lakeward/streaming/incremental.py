"""Incremental promotion with Structured Streaming.

Landing runs are immutable and a re-run adds a new run folder, so a file
stream over the entity root sees each run exactly once.  Each micro-batch is
gated by the quality suite: a passing batch goes to the bronze table
(de-duplicated against it when keys are given), a failing one to a quarantine
folder.

**Replays.**  Spark repeats a batch after a failure with the same id and the
same files.  The bronze table, the quarantine and the results table are
partitioned by the batch, named by its checkpoint's own id and its number, and
every write of a batch *replaces* that partition.  A replay therefore ends
with the same rows, whatever the first attempt left behind, rows without keys
included: what it compares itself with are the other batches' partitions only.
A record that was already written saves the work.  The checkpoint's id is the
one that Spark stores in it, so a deleted and newly started checkpoint is
another stream and replaces nothing.

**Repeated keys.**  Rows with a null key part equal no other row.  Of rows that
repeat a key the first by ``order_by`` stays (``duplicates="drop"``), or the
gate blocks a batch that repeats one (``duplicates="reject"``).

**Empty parts.**  Spark writes a part file without rows where a run's first
task had none, which happens once input files are split.  A batch of such files
only passes if their runs' other files hold rows; an empty run is blocked.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedup, quality
from ..operators.quality import qcol
from ..operators.records import cast_text, flatten
from ..plans import tables
from ..session import durable_dir, ensure_checkpoint_dir

log = logging.getLogger(__name__)

#: Partition column of a table that a stream fills.
BATCH_COLUMN = "_stream_batch"
RESULTS = "_stream_batches"
RESULT_COLUMNS = "passed BOOLEAN, n_rows BIGINT, messages STRING, stream STRING, checkpoint STRING, batch_id BIGINT"


@dataclass
class StreamSpec:
    name: str
    table: str
    schema: str
    expected_columns: list[str]
    not_null_columns: list[str]
    key_columns: list[str]
    order_by: list[str] | None = None
    min_rows: int = 1
    quarantine: str | None = None
    # create bronze partitioned by key bucket as well: the per-batch key check
    # then reads only the batch's buckets instead of every bronze key
    key_buckets: int | None = None
    duplicates: str = "drop"

    def __post_init__(self):
        if self.duplicates not in ("drop", "reject"):
            raise ValueError(f"duplicates must be 'drop' or 'reject', not {self.duplicates!r}")


def checkpoint_id(spark: SparkSession, location: str) -> str:
    """The id that Spark wrote into a checkpoint when it was created."""
    stored = spark.read.text(f"{location.rstrip('/')}/metadata")
    found = stored.select(F.get_json_object("value", "$.id").alias("id")).filter("id IS NOT NULL").first()
    if found is None:
        raise RuntimeError(f"{location} holds no stream checkpoint")
    return found["id"]


def batch_name(checkpoint: str, batch_id: int) -> str:
    """Partition value of a batch; batches of one checkpoint sort by number."""
    return f"{hashlib.sha1(checkpoint.encode()).hexdigest()[:12]}-{batch_id:012d}"


def _results_table(spark: SparkSession, schema: str) -> str:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    name = f"`{schema}`.`{RESULTS}`"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({RESULT_COLUMNS}) USING parquet PARTITIONED BY (stream, checkpoint, batch_id)"
    )
    return name


def _recorded(spark: SparkSession, results: str, stream: str, checkpoint: str, batch_id: int) -> bool:
    """Whether the batch's record exists; reads that partition only."""
    here = (F.col("stream") == stream) & (F.col("checkpoint") == checkpoint) & (F.col("batch_id") == batch_id)
    return not spark.table(results).filter(here).isEmpty()


def new_rows_only(batch: DataFrame, target: DataFrame, keys: list[str], order_by: list[str] | None) -> DataFrame:
    """Exact de-duplication of a batch: the first row per key inside it (by
    ``order_by``), without keys already in ``target``.  Rows with a null key
    part are all new.  The target holds text, so keys compare as text."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | qcol(k).isNull()
    first = dedup.remove_duplicates(batch.filter(~null_key), keys, order_by or keys)
    existing = target.select(*[qcol(k).alias(f"__{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (qcol(k).cast("string") == F.col(f"__{i}"))
    return first.join(existing, same, "left_anti").unionByName(batch.filter(null_key))


def _prepared_table(spark: SparkSession, spec: StreamSpec, batch: DataFrame) -> str:
    """The bronze table of the stream, created or evolved for ``batch``."""
    name = tables.fq_name(spec.table, spec.schema)
    if not tables.table_exists(spark, spec.table, spec.schema):
        tables.create_table_if_not_exists(
            spark, batch.columns, spec.table, spec.key_columns or None, spec.schema,
            spec.key_buckets if spec.key_columns else None, partition_columns=[BATCH_COLUMN],
        )
    spark.catalog.refreshTable(name)
    if BATCH_COLUMN not in spark.table(name).columns:
        raise ValueError(f"{name} has no column {BATCH_COLUMN}: a stream fills a table of its own")
    tables.alter_table(spark, batch.columns, spec.table, spec.schema)
    return name


def _replace_partition(spark: SparkSession, rows: DataFrame, table: str, fixed: dict[str, str], dynamic: list[str]) -> None:
    """Make ``rows`` the whole content of the partitions that ``fixed`` names."""
    columns = [c for c in spark.table(table).columns if c not in fixed and c not in dynamic]
    by_lower = {c.lower(): c for c in rows.columns}
    aligned = rows.select(
        *[
            (qcol(by_lower[c.lower()]) if c.lower() in by_lower else F.lit(None).cast("string")).alias(c)
            for c in [*columns, *dynamic]
        ]
    )
    view = f"batch_{uuid.uuid4().hex}"
    aligned.createOrReplaceTempView(view)
    spec = ", ".join([*[f"`{k}` = {v}" for k, v in fixed.items()], *[f"`{c}`" for c in dynamic]])
    try:
        spark.sql(f"INSERT OVERWRITE {table} PARTITION ({spec}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def commit_rows(spark: SparkSession, batch: DataFrame, spec: StreamSpec, name: str) -> int:
    """Make the batch's new rows the content of its partition of the bronze
    table; returns their number, observed during the write."""
    # the source can be read again, so the batch is not kept beside it
    text = cast_text(flatten(batch))
    target = _prepared_table(spark, spec, text)
    dynamic = []
    if spec.key_columns:
        # on a key-bucketed table only the batch's buckets are read
        existing, _ = tables.bucket_scope(spark, spec.table, spec.schema, text, spec.key_columns)
        existing = existing.filter(F.col(BATCH_COLUMN) != name)
        # the write must not read its own table: the keys that both have, which
        # are no more than the batch's, are written down first
        own = text.select(*[qcol(k) for k in spec.key_columns])
        both = own.join(existing.select(*[qcol(k) for k in spec.key_columns]), spec.key_columns, "left_semi")
        ensure_checkpoint_dir(spark)
        text = new_rows_only(text, both.distinct().checkpoint(), spec.key_columns, spec.order_by)
    buckets = int(tables.table_properties(spark, spec.table, spec.schema).get(tables.BUCKETS_PROPERTY, "0"))
    if buckets:
        text = text.withColumn(tables.KEY_BUCKET_COLUMN, tables.key_bucket(spec.key_columns, buckets))
        dynamic = [tables.KEY_BUCKET_COLUMN]
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    text = text.observe(seen, F.count(F.lit(1)).alias("n"))
    _replace_partition(spark, text, target, {BATCH_COLUMN: tables.sql_text(name)}, dynamic)
    return seen.get["n"]


def quarantine_root(spark: SparkSession, spec: StreamSpec) -> str:
    return spec.quarantine or durable_dir(spark, "quarantine", spec.schema, spec.name)


def _empty_parts(batch: DataFrame, checkpoint: str, batch_id: int) -> bool:
    """Whether a batch has no rows while each of its runs holds some."""
    if not batch.isEmpty():
        return False
    spark = batch.sparkSession
    runs = sorted({f.rsplit("/", 1)[0] for f in batch_files(spark, checkpoint, batch_id)})
    return bool(runs) and not any(spark.read.schema(batch.schema).parquet(r).isEmpty() for r in runs)


def gate_batch(spec: StreamSpec, checkpoint: str, redo: bool = False):
    """``foreachBatch`` function of the stream with the ``checkpoint``
    location; ``redo`` writes a batch again that has a record."""
    known: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not known:
            known.append(checkpoint_id(spark, checkpoint))
        results = _results_table(spark, spec.schema)
        if not redo and _recorded(spark, results, spec.name, known[0], batch_id):
            log.info("Batch %s of %s already processed; skipped", batch_id, spec.name)
            return
        name = batch_name(known[0], batch_id)

        def gated(min_rows: int):
            keys = spec.key_columns if spec.duplicates == "reject" else None
            return quality.run_checks(
                quality.evaluate(batch, spec.expected_columns, spec.not_null_columns, keys, min_rows)
            )

        passed, checks = gated(spec.min_rows)
        if not passed and _empty_parts(batch, checkpoint, batch_id):
            passed, checks = gated(0)
        n = 0
        if passed:
            n = commit_rows(spark, batch, spec, name)
        else:
            # a folder of the batch's own: no other checkpoint writes there
            batch.write.mode("overwrite").parquet(f"{quarantine_root(spark, spec)}/{BATCH_COLUMN}={name}")
        messages = "; ".join(f"{c.check_name}: {c.message}" for c in checks if not c.passed)
        record = spark.createDataFrame([(passed, n, messages)], "passed boolean, n_rows long, messages string")
        key = {"stream": tables.sql_text(spec.name), "checkpoint": tables.sql_text(known[0]), "batch_id": str(batch_id)}
        _replace_partition(spark, record, results, key, [])

    return run


def start_incremental_promotion(
    spark: SparkSession,
    entity_root: str,
    schema: T.StructType,
    spec: StreamSpec,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Stream the landing runs under ``entity_root`` into the bronze table.

    ``available_now`` processes everything present and stops (a scheduled
    incremental job); otherwise the query keeps running.  The checkpoint
    lives below ``spark.checkpoint.dir`` unless given, where the next
    application finds it.  The file source lists its path
    on every trigger; with a long history, point ``entity_root`` at a glob
    over the date folders still receiving runs (e.g. ``…/entity/2024/*/*``)
    so listing stays proportional to the open period, and bound each
    micro-batch with ``max_files_per_trigger``."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(entity_root)
    ckpt = checkpoint_location or durable_dir(spark, "streams", spec.schema, spec.name)
    writer = stream.writeStream.foreachBatch(gate_batch(spec, ckpt)).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """Files of a micro-batch, from the file source's log in the checkpoint."""
    entry = F.from_json("value", "path string, batchId long").alias("e")
    log_lines = spark.read.text(f"{checkpoint.rstrip('/')}/sources/0").filter(F.col("value").startswith("{"))
    rows = log_lines.select(entry).select("e.*").filter(F.col("batchId") == batch_id).distinct().collect()
    return sorted(unquote(r["path"]) for r in rows)


def replay(spark: SparkSession, spec: StreamSpec, checkpoint: str, batch_id: int, schema: T.StructType) -> None:
    """Gate and write a batch again from its files, whatever its record says:
    after a rule changed, or to prove that a replay changes nothing.  Later
    batches compare themselves with the batch as it was."""
    files = batch_files(spark, checkpoint, batch_id)
    if not files:
        raise ValueError(f"{checkpoint} has no batch {batch_id}")
    gate_batch(spec, checkpoint, redo=True)(spark.read.schema(schema).parquet(*files), batch_id)
    spark.catalog.refreshTable(tables.fq_name(spec.table, spec.schema))


def _finished(query, name: str, timeout_seconds: int | None) -> None:
    if query.awaitTermination(timeout_seconds) is False:
        query.stop()
        raise TimeoutError(f"stream {name} had not finished after {timeout_seconds} s; it was stopped")
    if query.exception() is not None:
        raise query.exception()


def run_available_now(
    spark: SparkSession,
    entity_root: str,
    schema: T.StructType,
    spec: StreamSpec,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
    timeout_seconds: int | None = None,
) -> DataFrame:
    """Process every landing run not seen before, then stop.  Returns this
    stream's batch results.  The stream writes through its own session, so
    the tables it touched are refreshed in the caller's session afterwards."""
    query = start_incremental_promotion(
        spark, entity_root, schema, spec, checkpoint_location, True, max_files_per_trigger
    )
    _finished(query, spec.name, timeout_seconds)
    results = f"`{spec.schema}`.`{RESULTS}`"
    for t in (tables.fq_name(spec.table, spec.schema), results):
        if spark.catalog.tableExists(t):
            spark.catalog.refreshTable(t)
    return spark.table(results).filter(F.col("stream") == spec.name)


# ------------------------------------------------------------ bounded state


def dedup_within_watermark(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Bounded-state alternative: drop repeats of a key seen within the
    watermark delay (state is purged once the watermark passes)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def first_within_watermark(
    spark: SparkSession,
    entity_root: str,
    schema: T.StructType,
    output: str,
    keys: list[str],
    event_time: str,
    delay: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = 1,
    timeout_seconds: int | None = None,
) -> DataFrame:
    """Stream the landed runs under ``entity_root`` into Parquet at ``output``,
    one row per key, with state that is bounded by ``delay``.

    The state store holds a key until the watermark (the latest event time
    less ``delay``) passes the key's first event time plus ``delay``; a repeat
    in that time is dropped.  A row whose event time is before the watermark is
    late and dropped, so ``delay`` bounds both the disorder that is tolerated
    and the keys that are kept.  The file sink commits each micro-batch in its
    log, so a query that stopped and starts again from ``checkpoint_location``
    neither repeats nor loses rows, and its state goes on where it was.  Rows
    without an event time are never late.  Processes what is present, then
    stops; returns the whole output."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    kept = dedup_within_watermark(reader.parquet(entity_root), keys, event_time, delay)
    writer = kept.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint_location)
    _finished(writer.trigger(availableNow=True).start(), output, timeout_seconds)
    return spark.read.schema(schema).parquet(output)
