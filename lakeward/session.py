"""Session construction and the shared working folder.

Everything that needs a scratch location (staged table rewrites, streaming
checkpoints, lineage cuts) asks :func:`shared_dir`.  On a cluster that folder
comes from ``spark.checkpoint.dir``, which the cluster configuration names and
every executor can reach.  Only when the setting is absent *and* Spark runs in
local mode do we create one ourselves (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins and partition counts from
# runtime statistics, splits skewed join partitions and coalesces small ones.
# The broadcast threshold is Spark's own size check: a join side is broadcast
# only when its measured (AQE) or estimated size is below it.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    # post-shuffle partitions sized by bytes: start from a generous
    # shuffle partition count and let AQE coalesce to ~128 MB each
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # instants as 64-bit numbers, whose minimum and maximum footers record
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # of repeated keys in a JSON object the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # materialised batches (DataFrame.checkpoint) are removed from the shared
    # folder once nothing references them; long-running streams would
    # otherwise accumulate one per micro-batch
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "lakeward",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` is left to ``spark-submit`` when ``None``.  On a cluster, size
    ``shuffle_partitions`` to the data (about 128-256 MB of shuffle per task);
    AQE then coalesces what is left over.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.ui.enabled", "false")
    else:
        # on a shared cluster, coalesce shuffle partitions to the advisory
        # size instead of maximising the number of tasks
        builder = builder.config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating one only for local sessions."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a folder every executor can reach"
        )
    local = tempfile.mkdtemp(prefix="lakeward-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the shared checkpoint location.

    ``unique=True`` appends a fresh id so concurrent jobs never collide.
    """
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    pieces = [p.strip("/") for p in parts if p]
    if unique:
        pieces.append(uuid.uuid4().hex)
    return os.path.join(base, *pieces) if pieces else base


def durable_dir(spark: SparkSession, *parts: str) -> str:
    """A folder that the next application finds again: below the configured
    ``spark.checkpoint.dir`` itself, not below the folder that Spark adds to it
    for each application.  Where nothing is configured (local sessions) it
    lasts as long as the application's own folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        return shared_dir(spark, *parts)
    return "/".join([configured.rstrip("/"), *(p.strip("/") for p in parts if p)])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, in whatever store it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Make ``lakeward`` importable in the Python workers of every executor.

    Operators that run Python workers (``mapInPandas``) pickle functions by
    reference to this package.  The package is zipped once per application
    and added with ``addPyFile``, which distributes it through Spark's own
    file server (the same as ``--py-files``)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="lakeward-lib-"), "lakeward.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in folder:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
