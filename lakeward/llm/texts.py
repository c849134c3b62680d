"""Digests of whole texts, distinct texts, and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_library
from .urls import bloom_block, bloom_blocks, bloom_hit


def text_key(column: Column | str) -> tuple[Column, Column]:
    """128 bits that name a text, as two longs; a null text counts as empty."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit("text"), text)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, x1, x2) of every row; null texts become empty."""
    x1, x2 = text_key(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        x1.alias("x1"),
        x2.alias("x2"),
    )


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row (x1, x2, text) per distinct text.  The partial aggregate keeps
    one copy per map task, so a group of copies that holds a third of all rows
    reaches the shuffle as one row per task."""
    x1, x2 = text_key(text_col)
    return (
        docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), x1.alias("x1"), x2.alias("x2"))
        .groupBy("x1", "x2")
        .agg(F.first("text").alias("text"))
    )


class Folder:
    """A fresh folder below ``spark.checkpoint.dir`` for written stages.

    Tables written here cut lineage: a lost executor costs a re-read, not a
    re-run of the stages before."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        ship_library(spark)
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions: the caller's sizing for the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Blocks of a broadcast filter at most (18 MB), and the keys for each.
MAX_BLOCKS = 1 << 18
KEYS_PER_BLOCK = 32


def filter_blocks(keys: int) -> int:
    """Blocks for a number of keys; 0 if ``MAX_BLOCKS`` would be so full that
    most foreign keys passed, which no filter is better than."""
    if keys > 4 * KEYS_PER_BLOCK * MAX_BLOCKS:
        return 0
    return min(MAX_BLOCKS, max(64, -(-keys // KEYS_PER_BLOCK)))


def mark_possible(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``__possible``: false only if no row of ``keys`` has the
    same ``columns``.  A blocked Bloom filter of 68 bytes a block is broadcast,
    sized by the number of keys: up to 8 million (``MAX_BLOCKS``) about one
    foreign key in 2,000 passes, beyond that more and more, and over 33 million
    all rows are possible, without a filter.  ``keys`` should be written."""
    blocks = filter_blocks(keys.count())
    if not blocks:
        return rows.withColumn("__possible", F.lit(True))
    code = F.xxhash64(*columns)
    bloom = bloom_blocks(keys.select(code.alias("canonical")), blocks)
    probed = rows.withColumn("__code", code).withColumn("block", bloom_block(F.col("__code"), blocks))
    probed = probed.join(F.broadcast(bloom), "block", "left")
    hit = F.coalesce(bloom_hit(F.col("__code")), F.lit(False))
    return probed.withColumn("__possible", hit).select(*rows.columns, "__possible")


def without_keys(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` whose ``columns`` (nulls equal) are not in ``keys``; only rows
    that pass the filter are shuffled to the exact anti-join."""
    marked = mark_possible(rows, keys, columns)
    listed = keys.select(*[F.col(c).alias(f"__{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    maybe = marked.filter("__possible").drop("__possible").join(listed, same, "left_anti")
    return marked.filter("not __possible").drop("__possible").unionByName(maybe)
