"""Mailed report bundles: ZIP archives and raw CSV attachments.

Spark's CSV reader cannot skip leading lines, take the first CSV member of a
ZIP or fall back between charsets, so the per-file work runs in a Python
worker through ``mapInPandas``: each input row is one bundle (a ZIP or a CSV
payload), each output row is one parsed CSV line as ``ARRAY<STRING>``.  The
naming of columns and the union of all bundles happen back in Spark.

Scale notes: a single ZIP cannot be split, so one bundle is one unit of work;
many bundles spread over all tasks.  Output rows are yielded in chunks so a
large CSV never sits in memory as one frame.  Keep
``spark.sql.execution.arrow.maxRecordsPerBatch`` low when bundles are large,
since a batch holds the raw payloads of that many bundles.
"""

from __future__ import annotations

import csv
import io
import itertools
import re
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import positional_names
from ..session import ensure_checkpoint_dir, ship_library
from . import charsets

# The cell texts pandas' CSV reader turns into missing values by
# default (its STR_NA_VALUES set).
PANDAS_NA_TOKENS = frozenset(
    [
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
        "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
        "n/a", "nan", "null",
    ]
)

BUNDLE_ROWS_SCHEMA = (
    "bundle_id string, bundle_ordinal long, member string, member_ordinal int, "
    "row_ordinal long, header array<string>, fields array<string>, error string"
)

_CHUNK = 20_000

# pandas' reader has no per-field size limit; the csv module's default is
# 128 KiB, which would reject valid reports with long text fields.
csv.field_size_limit(2**31 - 1)

# Provenance columns kept next to the parsed CSV columns.
BUNDLE_KEYS = ("bundle_id", "bundle_ordinal", "member", "member_ordinal", "row_ordinal")


class EmptyCsv(Exception):
    """No columns left to parse (blank text or everything skipped)."""


def decode_payload(raw: bytes) -> str | None:
    """Bytes → text, in whatever charset they show
    (:mod:`lakeward.sources.charsets`); bytes without a character are replaced.
    Blank input (before or after decoding) → ``None``."""
    if raw is None or not bytes(raw).strip():
        return None
    text = charsets.decode(bytes(raw))[1]
    return text if text.strip() else None


def _mangle(header: list[str]) -> list[str]:
    """pandas header rules: blank names → ``Unnamed: {i}``; repeats → ``.{k}``."""
    out, seen = [], {}
    for i, name in enumerate(header):
        name = name if name != "" else f"Unnamed: {i}"
        base = name
        k = seen.get(base, 0)
        while name in seen:
            k += 1
            name = f"{base}.{k}"
        seen[base] = k
        seen.setdefault(name, 0)
        out.append(name)
    return out


_LINE_END = re.compile(r"\r\n|\r|\n")


def _skip_lines(text: str, n: int) -> str:
    """Drop the first ``n`` lines; only ``\n``, ``\r\n`` and ``\r`` end a
    line (as in pandas' reader; form feeds and Unicode separators do not)."""
    pos = 0
    for _ in range(n):
        m = _LINE_END.search(text, pos)
        if m is None:
            return ""
        pos = m.end()
    return text[pos:]


def _is_blank(row: list[str]) -> bool:
    """A line that holds nothing, or spaces and tabs only; a quoted empty cell
    is a value."""
    return not row or (len(row) == 1 and row[0] != "" and not row[0].strip(" \t"))


def parse_csv_text(
    text: str, skiprows: int = 0, delimiter: str | None = None, header: bool = True,
    na_tokens=PANDAS_NA_TOKENS,
):
    """Parse CSV text → ``(header or None, iterator of rows)``.

    The first ``skiprows`` lines are dropped before parsing; blank lines are
    skipped; cells equal to a missing-value token become ``None``; short rows
    are padded.  With ``header`` the first remaining row names the columns; if
    the first data row has more fields than names, the leading ones are an
    unnamed row label in every row and are left out.  A later row that is longer
    than the first one raises ``ValueError``; :class:`EmptyCsv` is raised when
    no row is left.
    """
    reader = csv.reader(io.StringIO(_skip_lines(text, skiprows)), delimiter=delimiter or ",")
    rows = (r for r in reader if not _is_blank(r))
    names = next(rows, None)
    if names is None:
        raise EmptyCsv()
    first = next(rows, None) if header else names
    width = len(names) if first is None else max(len(names), len(first))
    labels = width - len(names)

    def cells(r: list[str]) -> list:
        if len(r) > width:
            raise ValueError(f"Expected {width} fields, saw {len(r)}")
        padded = r + [""] * (width - len(r))
        return [None if c in na_tokens else c for c in padded[labels:]]

    data = (cells(r) for r in itertools.chain([] if first is None else [first], rows))
    return (_mangle(names) if header else None), data


_COLUMNS = ("bundle_id", "bundle_ordinal", "member", "member_ordinal", "row_ordinal", "header", "fields", "error")


class _Out:
    """Row buffer shared by all bundles of one Arrow batch; flushed as one
    pandas frame every ``_CHUNK`` rows (not one frame per bundle)."""

    def __init__(self):
        self.cols = {c: [] for c in _COLUMNS}

    def add(self, *values):
        for c, v in zip(_COLUMNS, values):
            self.cols[c].append(v)

    def __len__(self):
        return len(self.cols["bundle_id"])

    def flush(self):
        frame = pd.DataFrame(self.cols)
        self.cols = {c: [] for c in _COLUMNS}
        return frame


def _bundle_worker(kind: str, has_header: bool, skiprows: int, delimiter, all_members: bool):
    def csv_members(content):
        if kind == "csv":
            yield None, 0, content
            return
        with zipfile.ZipFile(io.BytesIO(bytes(content))) as zf:
            for m_ord, name in enumerate(zf.namelist()):
                if name.lower().endswith(".csv"):
                    yield name, m_ord, zf.read(name)

    def run(batches):
        # Rows are emitted as they are parsed (chunked), never held as one
        # list: a CSV that turns out bad half-way emits a reject marker and
        # its rows are dropped downstream (anti-join on the rejected ids).
        out = _Out()
        for pdf in batches:
            for bundle_id, ordinal, content in zip(pdf["bundle_id"], pdf["bundle_ordinal"], pdf["content"]):
                emitted = False
                try:
                    for name, m_ord, raw in csv_members(content):
                        text = decode_payload(raw)
                        if text is None:
                            continue
                        try:
                            header, rows = parse_csv_text(text, skiprows, delimiter, has_header)
                        except EmptyCsv:
                            continue
                        for i, fields in enumerate(rows):
                            out.add(bundle_id, ordinal, name, m_ord, i, header, fields, None)
                            if len(out) >= _CHUNK:
                                yield out.flush()
                        emitted = True
                        if not all_members:
                            break
                except (zipfile.BadZipFile, zlib.error, ValueError, csv.Error, RuntimeError, NotImplementedError) as exc:
                    # corrupt archive, bad CRC, encrypted or unsupported
                    # member, malformed CSV: this bundle only is rejected
                    out.add(bundle_id, ordinal, None, None, None, None, None, f"{type(exc).__name__}: {exc}")
                    continue
                if not emitted:
                    out.add(bundle_id, ordinal, None, None, None, None, None, "no valid CSV")
        if len(out):
            yield out.flush()

    return run


def extract_bundle_rows(
    bundles: DataFrame,
    kind: str = "zip",
    column_mapping: dict[int, str] | None = None,
    skiprows: int = 0,
    delimiter: str | None = None,
    all_members: bool = False,
    spread: bool = False,
) -> DataFrame:
    """Parse bundles into one row per CSV line (long form, see
    ``BUNDLE_ROWS_SCHEMA``).  ``bundles`` needs ``bundle_id``,
    ``bundle_ordinal`` and ``content`` (binary).

    ``kind="zip"``: the first ``.csv`` member (case-insensitive, archive
    order) that is not blank and still has rows after ``skiprows``; with
    ``all_members`` every such member.  ``kind="csv"``: the payload itself.
    A bundle without a valid CSV yields one row with ``error`` set.
    """
    if kind not in ("zip", "csv"):
        raise ValueError("kind must be 'zip' or 'csv'")
    has_header = not column_mapping
    ship_library(bundles.sparkSession)
    worker = _bundle_worker(kind, has_header, skiprows, delimiter, all_members)
    src = bundles.select("bundle_id", "bundle_ordinal", "content")
    if spread:
        # For few, large bundles packed into few input splits (small files
        # merged by binaryFile, one day's mail in one scan task): hash them
        # over the shuffle partitions so the Python parsing uses every core.
        # Off by default: for many small bundles the extra Python workers
        # cost more than they save.
        src = src.repartition("bundle_id")
    return src.mapInPandas(worker, BUNDLE_ROWS_SCHEMA)


def materialize(rows: DataFrame) -> DataFrame:
    """Write the parsed rows once to the checkpoint folder (lineage cut), so
    the column discovery, the rows and the rejects all read the same result
    without parsing the bundles again.  Survives executor loss: the data is
    in the shared checkpoint folder, not on one executor."""
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint(eager=True)


def bundle_rows_to_frame(rows: DataFrame, column_mapping: dict[int, str] | None = None) -> DataFrame:
    """Long rows → one frame with named columns (lenient union by name over
    all bundles), keeping ``bundle_ordinal`` and ``row_ordinal`` for ordering.

    With a mapping: names by position (unmapped → ``col_{i}``), as wide as the
    widest CSV.  Without: each CSV's own header; columns in order of first
    appearance.  Either way one small aggregate decides the column list.
    """
    # Rows of a bundle that was rejected (even half-way) are dropped; the
    # rejected ids are one row per bad bundle.
    bad = rows.filter(F.col("error").isNotNull()).select("bundle_id").distinct()
    valid = rows.filter(F.col("error").isNull()).join(bad, "bundle_id", "left_anti")
    keep = [F.col(c) for c in BUNDLE_KEYS]
    if column_mapping:
        width = valid.agg(F.max(F.size("fields")).alias("w")).first()["w"] or 0
        names = positional_names(column_mapping, width)
        return valid.select(*keep, *[F.col("fields")[i].alias(n) for i, n in enumerate(names)])
    headers = (
        valid.groupBy("header")
        .agg(F.min(F.struct("bundle_ordinal", "bundle_id", "member_ordinal")).alias("first"))
        .orderBy("first")
        .select("header")
        .collect()
    )
    names: list[str] = []
    for h in headers:
        for n in h["header"]:
            if n not in names:
                names.append(n)
    m = F.map_from_arrays("header", "fields")
    return valid.select(*keep, *[F.element_at(m, F.lit(n)).alias(n) for n in names])


def rejected_bundles(rows: DataFrame) -> DataFrame:
    """Bundles skipped for holding no valid CSV, with the reason."""
    return rows.filter(F.col("error").isNotNull()).select("bundle_id", "bundle_ordinal", "error")


def read_bundle_files(spark, path: str, glob: str = "*.zip") -> DataFrame:
    """Bundles from files (``binaryFile``): ``bundle_id`` = path."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )
    # No global ranking (that would pull every payload into one task): the
    # bundle id (path) itself orders bundles after the shared ordinal 0.
    return files.select(
        F.col("path").alias("bundle_id"), F.lit(0).cast("long").alias("bundle_ordinal"), "content"
    )
