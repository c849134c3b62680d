"""Contracts, file statistics, checksums and manifests.

A *contract* is a Spark ``StructType`` (or its JSON).  A *manifest* is an
immutable list of the files that make up one approved version of a dataset,
with their size, checksum and row statistics; readers that go through a
manifest see exactly that version.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import CheckResult, qcol
from ..sources import footers


def as_struct(contract) -> T.StructType:
    if isinstance(contract, T.StructType):
        return contract
    if isinstance(contract, str):
        contract = json.loads(contract)
    return T.StructType.fromJson(contract)


def contract_violations(schema: T.StructType, contract) -> list[str]:
    """Differences between a schema and the contract: missing fields, type
    changes and nullability (a contract field declared non-null must not be
    nullable in the data).  Extra fields are reported too.  No job runs."""
    expected = as_struct(contract)
    have = {f.name: f for f in schema.fields}
    out = []
    for f in expected.fields:
        g = have.get(f.name)
        if g is None:
            out.append(f"missing field '{f.name}'")
            continue
        if g.dataType != f.dataType:
            out.append(
                f"field '{f.name}' is {g.dataType.simpleString()}, contract says {f.dataType.simpleString()}"
            )
        if not f.nullable and g.nullable:
            out.append(f"field '{f.name}' is nullable, contract says not null")
    names = {f.name for f in expected.fields}
    out += [f"extra field '{n}'" for n in have if n not in names]
    return out


def check_contract(df: DataFrame, contract, allow_extra: bool = True) -> list[CheckResult]:
    """``contract`` check result for a frame (schema only, no job)."""
    v = contract_violations(df.schema, contract)
    if allow_extra:
        v = [x for x in v if not x.startswith("extra field")]
    return [CheckResult("contract", not v, "Contract OK" if not v else "; ".join(v))]


def file_conformance(spark: SparkSession, files: list[str], contract) -> DataFrame:
    """Per file: does its footer schema (names and types, in order) equal the
    contract?  Output ``path, ddl, footer_rows, conforms``; a file whose footer
    cannot be read does not conform and has the reason as its ``ddl``."""
    found = footers.footers(spark, files)
    ddl = footers.ddl_of(F.col("schema"))
    return found.select(
        "path",
        F.coalesce(ddl, F.concat(F.lit("unreadable footer ("), "error", F.lit(")"))).alias("ddl"),
        F.col("n_rows").alias("footer_rows"),
        F.coalesce(ddl == F.lit(footers.schema_ddl(as_struct(contract))), F.lit(False)).alias("conforms"),
    )


def file_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count and per-column min/max per source file of a file-backed
    frame (``_metadata.file_path``): one grouped aggregation."""
    columns = columns or [c for c in df.columns]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs += [F.min(qcol(c)).alias(f"{c}__min"), F.max(qcol(c)).alias(f"{c}__max")]
    return df.select("*", F.col("_metadata.file_path").alias("path")).groupBy("path").agg(*aggs)


def file_checksums(spark: SparkSession, files: list[str]) -> DataFrame:
    """``path, length, sha256`` of each file (content read once, in
    parallel, one file per row)."""
    return (
        spark.read.format("binaryFile").load(files)
        .select("path", "length", F.sha2("content", 256).alias("sha256"))
    )


def content_checksum(df: DataFrame, columns: list[str] | None = None, by: list | None = None) -> DataFrame:
    """Rows and a checksum of their content that does not depend on their order
    or place: ``n_rows, total, mixed``, for the whole frame or per ``by``
    (columns, or ``_metadata.file_path`` of a file-backed frame).

    Each row gives two hashes of all ``columns`` in their text form, nulls told
    from empty text and from nulls elsewhere; ``total`` adds one up (exactly, as
    a decimal), ``mixed`` is the exclusive-or of the other.  A lost, repeated or
    changed row changes them; typed rows and their all-text copy agree.  Both
    combine map-side: one pass, a row per group and task in the shuffle."""
    parts = []
    for c in columns or df.columns:
        text = qcol(c).cast("string")
        parts += [F.coalesce(text, F.lit("")), text.isNull()]
    one, other = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    keys = [(F.col(k) if isinstance(k, str) else k) for k in by or []]
    hashed = df.select(*keys, one.alias("__one"), other.alias("__other"))
    return hashed.groupBy(*[c for c in hashed.columns if c not in ("__one", "__other")]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("__one").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"),
        F.bit_xor("__other").alias("mixed"),
    )


def same_content(one: DataFrame, other: DataFrame, columns: list[str] | None = None) -> bool:
    """Whether two frames hold the same rows, in any order, as text."""
    a, b = (content_checksum(df, columns or one.columns).first() for df in (one, other))
    return tuple(a) == tuple(b)


# ------------------------------------------------------------------ manifests

MANIFEST = footers.FOOTERS.replace("error string, ", "") + ", version string, length long, sha256 string"


def manifest_path(prefix: str, version: str) -> str:
    return f"{prefix.rstrip('/')}/_manifests/v={version}"


def write_manifest(
    spark: SparkSession, prefix: str, version: str, files: list[str], contract=None, checksums: bool = True
) -> DataFrame:
    """Write the manifest of one dataset version: a row per file with its
    schema, rows and the nulls, minimum and maximum of each column, all from
    the footers, its length and (``checksums``) the SHA-256 of its bytes, for
    which the files are read once, in parallel.  A version is written once
    (``errorifexists``); a file without a readable footer, or one that does not
    conform to the ``contract``, stops it.  Returns the manifest as read back."""
    found = footers.footers(spark, files)
    expected = None if contract is None else footers.schema_ddl(as_struct(contract))
    wrong = F.col("error").isNotNull()
    if expected is not None:
        wrong = wrong | F.coalesce(footers.ddl_of(F.col("schema")) != F.lit(expected), F.lit(True))
    bad = found.filter(wrong).orderBy("path").limit(1).collect()
    if bad:
        why = "has an unreadable footer" if bad[0]["error"] else "does not conform to the contract"
        raise ValueError(f"File {why}: {bad[0]['path']}")
    sizes = file_checksums(spark, files) if checksums else file_lengths(spark, files)
    rows = found.join(sizes.withColumnRenamed("path", "listed"), _plain_path(F.col("path")) == _plain_path(F.col("listed")))
    target = manifest_path(prefix, version)
    rows.withColumn("version", F.lit(version)).select(*T.StructType.fromDDL(MANIFEST).fieldNames()).write.mode(
        "errorifexists"
    ).json(target)
    return read_manifest(spark, prefix, version)


def _plain_path(path) -> F.Column:
    """A path without the scheme that only some of Spark's sources show."""
    return F.regexp_replace(path, r"^file:/*", "/")


def file_lengths(spark: SparkSession, files: list[str]) -> DataFrame:
    """``path, length, sha256`` (null) of each file; contents are not read."""
    listed = spark.read.format("binaryFile").load(files).select("path", "length")
    return listed.withColumn("sha256", F.lit(None).cast("string"))


def read_manifest(spark: SparkSession, prefix: str, version: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(manifest_path(prefix, version))


def read_manifest_files(spark: SparkSession, prefix: str, version: str) -> list[str]:
    """File list of a version (as long as the version's file count)."""
    rows = read_manifest(spark, prefix, version).select("path").collect()
    return sorted(r["path"] for r in rows)


def matching_files(spark: SparkSession, prefix: str, version: str, ranges: dict, contract=None) -> list[str]:
    """Files of a version whose statistics leave room for a row in all
    ``ranges``: column -> (least, most), inclusive, None for an open end."""
    manifest = read_manifest(spark, prefix, version)
    one = manifest.select("schema").first()
    if one is None:
        return []
    schema = as_struct(contract) if contract is not None else as_struct(one["schema"])
    can = F.lit(True)
    for name, (low, high) in ranges.items():
        can = can & footers.may_match(name, schema[name].dataType, low, high)
    return sorted(r["path"] for r in manifest.filter(can).select("path").collect())


def read_version(spark: SparkSession, prefix: str, version: str, contract=None, ranges: dict | None = None) -> DataFrame:
    """Read exactly the files of an approved version (optionally with the
    contract as read schema).

    With ``ranges`` (column -> (least, most), inclusive, None for an open end)
    only rows in all of them, from the files whose statistics in the manifest
    leave room for one; the others are not opened."""
    files = read_manifest_files(spark, prefix, version)
    if not files:
        raise ValueError(f"Manifest {version} under {prefix} lists no files")
    reader = spark.read
    if contract is not None:
        reader = reader.schema(as_struct(contract))
    if not ranges:
        return reader.parquet(*files)
    chosen = matching_files(spark, prefix, version, ranges, contract)
    df = reader.parquet(*(chosen or files[:1]))
    for name, (low, high) in ranges.items():
        kind = df.schema[name].dataType
        if low is not None:
            df = df.filter(qcol(name) >= footers.bound(low, kind))
        if high is not None:
            df = df.filter(qcol(name) <= footers.bound(high, kind))
    return df if chosen else df.limit(0)
