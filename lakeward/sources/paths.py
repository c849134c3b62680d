"""Landing-zone layout and storage locations.

Layout (not hive-style; the path *is* the partition key)::

    {root}/{source}/{entity}/{yyyy}/{mm}/{dd}/{run_id}.{ext}

Because the date folders are not ``key=value``, Catalyst cannot prune them
from a filter.  Readers therefore turn a date range into the exact list of day
prefixes (:func:`day_prefixes`) and read only those.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date, timedelta
from urllib.parse import urlsplit

# Default bucket name and the storage backends accepted.
DEFAULT_BUCKET = "data-lake"
BACKENDS = ("minio", "s3", "adls")


def landing_prefix(root: str, source: str, entity: str, run_date: date) -> str:
    """``{root}/{source}/{entity}/{yyyy}/{mm}/{dd}``."""
    return f"{root}/{source}/{entity}/{run_date.year}/{run_date.month:02d}/{run_date.day:02d}"


def build_landing_path(
    root: str, source: str, entity: str, run_date: date, run_id: str, ext: str = "parquet"
) -> str:
    """Full path of one run's file: ``{prefix}/{run_id}.{ext}``."""
    return f"{landing_prefix(root, source, entity, run_date)}/{run_id}.{ext}"


_PATH_RE = re.compile(
    r"(?P<source>[^/]+)/(?P<entity>[^/]+)/(?P<y>\d{4})/(?P<m>\d{2})/(?P<d>\d{2})/"
    r"(?P<run_id>[^/]+?)\.(?P<ext>[A-Za-z0-9]+)(?:/[^/]*)?$"
)


def parse_landing_path(path: str) -> dict | None:
    """Inverse of :func:`build_landing_path`; ``None`` when it does not fit."""
    m = _PATH_RE.search(path)
    if not m:
        return None
    return {
        "source": m["source"],
        "entity": m["entity"],
        "run_date": date(int(m["y"]), int(m["m"]), int(m["d"])),
        "run_id": m["run_id"],
        "ext": m["ext"],
    }


def day_prefixes(root: str, source: str, entity: str, start: date, end: date) -> list[str]:
    """Prefixes of every day in ``[start, end]`` (window reprocessing)."""
    if end < start:
        return []
    return [
        landing_prefix(root, source, entity, start + timedelta(days=i))
        for i in range((end - start).days + 1)
    ]


def _escaped(path: str) -> str:
    """A path whose characters mean nothing in a path pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def window_patterns(root: str, source: str, entity: str, start: date, end: date) -> list[str]:
    """Path patterns for the day folders in ``[start, end]``, at most three: one
    for whole years, one for whole months, one for single days.  A pattern
    names what may exist; folders that do not are no error."""
    base = "/".join([root, *(_escaped(x) for x in (source, entity))])
    years, months, days = [], [], []
    day = start
    while day <= end:
        next_year = date(day.year + 1, 1, 1)
        next_month = date(day.year + day.month // 12, day.month % 12 + 1, 1)
        if day.month == day.day == 1 and next_year - timedelta(days=1) <= end:
            years.append(f"{day.year:04d}")
            day = next_year
        elif day.day == 1 and next_month - timedelta(days=1) <= end:
            months.append(f"{day.year:04d}/{day.month:02d}")
            day = next_month
        else:
            days.append(f"{day.year:04d}/{day.month:02d}/{day.day:02d}")
            day += timedelta(days=1)
    two = "[0-9][0-9]"
    parts = [(years, f"/{two}/{two}"), (months, f"/{two}"), (days, "")]
    return [f"{base}/{{{','.join(found)}}}{rest}" for found, rest in parts if found]


def expired_prefixes(
    root: str, source: str, entity: str, days_present: list[date], keep_days: int, today: date
) -> list[str]:
    """Retention: prefixes of the given days older than ``keep_days``.

    Only the list is returned; deleting is left to the caller."""
    cutoff = today - timedelta(days=keep_days)
    return [landing_prefix(root, source, entity, d) for d in sorted(days_present) if d < cutoff]


@dataclass(frozen=True)
class StorageLocation:
    """Base URI of the lake plus the Hadoop options a session needs for it."""

    backend: str
    base_uri: str
    hadoop_options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class _Backend:
    """A kind of store: its base URI, and where its Hadoop options come from.
    ``{...}`` in URIs, options' names and values are settings."""

    uri: str
    options: dict[str, tuple[str, ...]] = field(default_factory=dict)
    fixed: dict[str, str] = field(default_factory=dict)
    endpoint: tuple[str, str, str] | None = None  # option, setting, default


_S3_KEYS = {
    "fs.s3a.access.key": ("MINIO_ACCESS_KEY", "AWS_ACCESS_KEY_ID"),
    "fs.s3a.secret.key": ("MINIO_SECRET_KEY", "AWS_SECRET_ACCESS_KEY"),
}
_STORES = {
    "minio": _Backend(
        "s3a://{MINIO_BUCKET}",
        _S3_KEYS,
        fixed={"fs.s3a.path.style.access": "true"},
        endpoint=("fs.s3a.endpoint", "MINIO_ENDPOINT", "https://minio:9000"),
    ),
    "s3": _Backend("s3a://{MINIO_BUCKET}", _S3_KEYS),
    "adls": _Backend(
        "abfss://{MINIO_BUCKET}@{ADLS_ACCOUNT_NAME}.dfs.core.windows.net",
        {"fs.azure.account.key.{ADLS_ACCOUNT_NAME}.dfs.core.windows.net": ("ADLS_ACCOUNT_KEY",)},
    ),
}


def resolve_storage(settings: dict | None = None) -> StorageLocation:
    """Base URI and Hadoop options of the store that ``STORAGE_BACKEND`` names
    (default ``minio``), from a deployment's settings: ``MINIO_BUCKET``,
    ``MINIO_ENDPOINT`` (https unless it says otherwise), the first that is set
    of ``MINIO_ACCESS_KEY``/``AWS_ACCESS_KEY_ID`` and of ``MINIO_SECRET_KEY``/
    ``AWS_SECRET_ACCESS_KEY``, ``ADLS_ACCOUNT_NAME``, ``ADLS_ACCOUNT_KEY``.
    Another backend raises ``ValueError``."""
    known = {"STORAGE_BACKEND": BACKENDS[0], "MINIO_BUCKET": DEFAULT_BUCKET, "ADLS_ACCOUNT_NAME": "", **(settings or {})}
    name = known["STORAGE_BACKEND"].lower()
    if name not in _STORES:
        raise ValueError(f"Unknown STORAGE_BACKEND '{name}'. Expected: {', '.join(BACKENDS)}.")
    store = _STORES[name]
    chosen = {option: next((known[k] for k in names if known.get(k)), None) for option, names in store.options.items()}
    options = {option.format_map(known): value for option, value in chosen.items() if value} | store.fixed
    if store.endpoint:
        option, setting, default = store.endpoint
        address = known.get(setting) or default
        options[option] = address if urlsplit(address).netloc else f"https://{address}"
    return StorageLocation(name, store.uri.format_map(known), options)


def session_options(location: StorageLocation) -> dict[str, str]:
    """The location's Hadoop options as ``spark.hadoop.*`` settings for
    :func:`lakeward.session.build_session` (``extra=``)."""
    return {f"spark.hadoop.{k}": v for k, v in location.hadoop_options.items()}
