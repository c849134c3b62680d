"""Scalar column expressions.  All are built from Spark SQL functions, so they
stay inside whole-stage code generation; none needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's str.strip() removes every character for which str.isspace() holds:
# the Unicode White_Space set plus the four ASCII information separators
# U+001C..U+001F.  Java's (?U)\s covers the first part only.
_PY_SPACE = r"[\s\x{1C}-\x{1F}]"
_STRIP_RE = rf"(?U)^{_PY_SPACE}+|{_PY_SPACE}+$"


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` for a string column (Spark ``trim`` only drops spaces)."""
    return F.regexp_replace(c, _STRIP_RE, "")


# The text tokens the SQL Server cell sanitiser maps to null
# (compared after strip + lower).
NULL_TEXT_TOKENS = ("nat", "nan")


# "strip().lower() is a null token" as one anchored match: optional Python
# whitespace, the token in any case, optional whitespace.  Only ASCII letters
# lower-case to n, a or t, so ASCII case folding is exact here.
_NULL_TOKEN_RE = (
    rf"(?U)^{_PY_SPACE}*(?i:" + "|".join(NULL_TEXT_TOKENS) + rf"){_PY_SPACE}*$"
)


def sanitize_string(c: Column) -> Column:
    """Drop NUL characters; null when the stripped, lower-cased text is a
    null token; otherwise the cleaned, *unstripped* text."""
    cleaned = F.replace(c, F.lit("\x00"), F.lit(""))
    return F.when(cleaned.rlike(_NULL_TOKEN_RE), F.lit(None)).otherwise(cleaned)


def iso_text(c: Column, with_offset: bool = False) -> Column:
    """``datetime.isoformat()`` text: ``.ffffff`` only when the microseconds are
    not zero.  ``with_offset`` adds ``+HH:MM`` (zone-aware timestamps)."""
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    text = F.concat(base, F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(""))
    if with_offset:
        text = F.concat(text, F.date_format(c, "xxx"))
    return text


def sanitize_column(c: Column, dtype: T.DataType) -> Column:
    """Type-directed cell sanitiser (strings, NaN, temporal values)."""
    if isinstance(dtype, T.StringType):
        return sanitize_string(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(c), F.lit(None)).otherwise(c)
    if isinstance(dtype, T.TimestampNTZType):
        return iso_text(c)
    if isinstance(dtype, T.TimestampType):
        return iso_text(c, with_offset=True)
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c


def unique_index_name_col(table: Column, columns: list[Column]) -> Column:
    """Deterministic key-constraint name as a column expression:
    ``uq_{table}_{cols}`` with non-word characters replaced by ``_``, cut at
    54 characters, then ``_`` and the first 8 hex digits of its SHA-1."""
    from .names import CONSTRAINT_DIGEST, CONSTRAINT_KEEP, CONSTRAINT_PREFIX

    joined = F.concat(F.lit(f"{CONSTRAINT_PREFIX}_"), table, F.lit("_"), F.concat_ws("_", *columns))
    # "letter, digit or underscore" in any script (Java's (?U)\w would also
    # admit combining marks and connector punctuation)
    clean = F.regexp_replace(joined, r"[^\p{L}\p{N}_]", "_")
    return F.concat(
        F.substring(clean, 1, CONSTRAINT_KEEP), F.lit("_"), F.substring(F.sha1(clean), 1, CONSTRAINT_DIGEST)
    )


def landing_path_col(
    bucket: str, source: Column, entity: Column, day: Column, run_id: Column, ext: str = "parquet"
) -> Column:
    """Landing path ``{bucket}/{source}/{entity}/{yyyy}/{mm}/{dd}/{run_id}.{ext}``."""
    return F.concat_ws(
        "/",
        F.lit(bucket),
        source,
        entity,
        F.date_format(day, "yyyy"),
        F.date_format(day, "MM"),
        F.date_format(day, "dd"),
        F.concat(run_id, F.lit("." + ext)),
    )


def parse_landing_path(c: Column) -> dict[str, Column]:
    """Columns ``source, entity, run_date, run_id`` parsed from a landing path
    (the run file itself, or a part file inside the run folder); all null
    when the path does not fit the layout.

    Works on the ``/``-separated segments counted from the end, so each test
    is a short anchored match on one segment (no backtracking over the whole
    path)."""
    parts = F.split(c, "/")

    def seg(k):
        return F.try_element_at(parts, F.lit(-k))

    def is_day_folder(off):
        return (
            seg(2 + off).rlike(r"^\d{2}$") & seg(3 + off).rlike(r"^\d{2}$") & seg(4 + off).rlike(r"^\d{4}$")
        )

    # A part file sits one level below the run folder.
    off = F.when(is_day_folder(1) & seg(2).rlike(r"\.[A-Za-z0-9]+$"), F.lit(1)).otherwise(F.lit(0))

    def s(k):
        return F.try_element_at(parts, -(F.lit(k) + off))

    run_seg = s(1)
    valid = (
        (F.size(parts) >= F.lit(6) + off)
        & s(2).rlike(r"^\d{2}$") & s(3).rlike(r"^\d{2}$") & s(4).rlike(r"^\d{4}$")
        & run_seg.rlike(r"^.+\.[A-Za-z0-9]+$") & (F.length(s(5)) > 0) & (F.length(s(6)) > 0)
    )
    day = F.concat_ws("-", s(4), s(3), s(2)).try_cast("date")
    return {
        "source": F.when(valid, s(6)),
        "entity": F.when(valid, s(5)),
        "run_date": F.when(valid, day),
        "run_id": F.when(valid, F.regexp_extract(run_seg, r"^(.*)\.[A-Za-z0-9]+$", 1)),
    }
