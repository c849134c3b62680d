"""Mailed reports: picking messages and attachments from a landed mail table.

The mailbox pull itself is not done here; messages are expected as a table
``(date DATE, sender STRING, subject STRING,
attachments ARRAY<STRUCT<filename STRING, payload BINARY>>, ...)``.
Selection is a filter plus an ``explode`` of the attachments, so it runs on
every partition in parallel.  The attachments it returns feed
:mod:`lakeward.sources.bundles`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bundles

# Fixed value: the time zone that decides "today" for mailed reports.
REPORT_TIME_ZONE = "America/Sao_Paulo"


def today_in(zone: str = REPORT_TIME_ZONE) -> Column:
    """Today's date in ``zone`` (one value per query)."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), zone))


def select_attachments(
    messages: DataFrame,
    sender_email: str,
    subject: str | None = None,
    target_date: date | None = None,
    subject_suffix: str | None = None,
    ext: str = "zip",
) -> DataFrame:
    """Attachments with extension ``ext`` of the messages that match.

    * date = ``target_date`` (default: today in America/Sao_Paulo);
    * sender contains ``sender_email`` (mail-search rule: substring, any case);
    * ``subject_suffix`` given: subject (null → ``""``) ends with it, case
      sensitive, and ``subject`` is ignored; otherwise the subject contains
      ``subject`` in any case.  Neither given → ``ValueError``;
    * attachment file name ends with ``.{ext}`` in any case (null names never
      match).

    Output: the message columns except ``attachments``, plus
    ``attachment_ordinal``, ``filename`` and ``payload``.
    """
    if not subject and not subject_suffix:
        raise ValueError("subject or subject_suffix must be given")
    day = F.lit(target_date) if target_date is not None else today_in()
    cond = (F.col("date") == day) & F.lower(F.col("sender")).contains(sender_email.lower())
    if subject_suffix:
        cond = cond & F.coalesce(F.col("subject"), F.lit("")).endswith(F.lit(subject_suffix))
    else:
        cond = cond & F.lower(F.coalesce(F.col("subject"), F.lit(""))).contains(subject.lower())
    others = [c for c in messages.columns if c != "attachments"]
    exploded = messages.filter(cond).select(
        *others, F.posexplode("attachments").alias("attachment_ordinal", "att")
    )
    name = F.col("att.filename")
    return exploded.filter(
        name.isNotNull() & F.lower(name).endswith("." + ext.lower())
    ).select(*others, "attachment_ordinal", name.alias("filename"), F.col("att.payload").alias("payload"))


def attachments_as_bundles(
    attachments: DataFrame, id_columns: list[str], ordinal_columns: list[str]
) -> DataFrame:
    """Shape selected attachments for :func:`bundles.extract_bundle_rows`:
    ``bundle_id`` from ``id_columns`` (a null part is empty), the file name and
    a hash of the payload, so that two mails of one day with the same subject
    and file name are judged apart; ``bundle_ordinal`` from
    a deterministic hash-free ordering key (a long built from
    ``ordinal_columns``, most significant first)."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in id_columns]
    bundle_id = F.concat_ws("/", *named, F.col("filename"), F.sha2(F.coalesce(F.col("payload"), F.lit(b"")), 256))
    ordinal = F.lit(0).cast("long")
    for c in ordinal_columns:
        ordinal = ordinal * F.lit(1 << 16) + F.col(c).cast("long")
    return attachments.select(bundle_id.alias("bundle_id"), ordinal.alias("bundle_ordinal"), F.col("payload").alias("content"))


def process_mailed_reports(
    messages: DataFrame,
    sender_email: str,
    subject: str | None,
    column_mapping: dict[int, str] | None,
    skiprows: int = 0,
    target_date: date | None = None,
    subject_suffix: str | None = None,
    delimiter: str | None = None,
    ext: str = "zip",
    id_columns: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Select → extract → combine.  Returns ``(rows, rejected)``: the combined
    CSV rows (lenient union by name) and the bundles skipped for holding no
    valid CSV.  An empty ``rows`` means nothing was found."""
    att = select_attachments(messages, sender_email, subject, target_date, subject_suffix, ext)
    ids = id_columns or [c for c in ("date", "sender", "subject") if c in att.columns]
    b = attachments_as_bundles(att, ids + ["attachment_ordinal"], ["attachment_ordinal"])
    long_rows = bundles.materialize(
        bundles.extract_bundle_rows(b, "zip" if ext == "zip" else "csv", column_mapping, skiprows, delimiter)
    )
    return bundles.bundle_rows_to_frame(long_rows, column_mapping), bundles.rejected_bundles(long_rows)
