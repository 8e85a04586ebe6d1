"""Column functions used by the reports.

Arguments are column names or SQL expressions. Each function is one SQL expression, so it stays in generated code;
the five that ad hoc SQL uses too are kept as text under ``DEFINITIONS``.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names and the step between them, the block size of a default server build, the label of a
# sample without a wait, and the text format in which report times are given.
BYTE_UNITS = ("bytes", "KB", "MB", "GB", "TB", "PB", "EB")
BYTE_STEP = 1024
BLOCK_SIZE = 8192
NO_WAIT = "CPU"
REPORT_TIME_FORMAT = "%m/%d/%Y %H:%M:%S"
REPORT_TIME_PATTERN = "MM/dd/yyyy HH:mm:ss"
DEFAULT_WINDOW_MINUTES = 120


def _or_one(divisor: str) -> str:
    return f"case when ({divisor}) = 0 then 1 else ({divisor}) end"


def _human_bytes(size: str) -> str:
    """Ties round to even, which is what C-style formatting does."""
    branches = []
    for power, unit in enumerate(BYTE_UNITS):
        scaled = f"format_string('%3.1f {unit}', bround(({size}) / {float(BYTE_STEP**power)!r}D, 1))"
        limit = f"({size}) < {float(BYTE_STEP ** (power + 1))!r}D" if unit != BYTE_UNITS[-1] else f"({size}) is not null"
        branches.append(f"when {limit} then {scaled}")
    return "case " + " ".join(branches) + " end"


DEFINITIONS = {
    "hit_ratio": lambda reads, hits: (
        f"case when ({reads}) = 0 and ({hits}) is not null then 100.0D "
        f"when ({reads}) + ({hits}) <> 0 then round(({hits}) * 100.0D / (({reads}) + ({hits})), 2) end"
    ),
    "per_unit": lambda units, total: f"round(({total}) / ({_or_one(units)}), 2)",
    "percent_of": lambda total, part: f"round(({part}) * 100.0D / ({_or_one(total)}), 2)",
    "blocks_to_bytes": lambda blocks, block_size=BLOCK_SIZE: f"({blocks}) * {int(block_size)}L",
    "human_bytes": _human_bytes,
}


def hit_ratio(reads: str, hits: str) -> Column:
    """Percentage of block requests served from cache. Without reads it is 100, also when nothing was requested."""
    return F.expr(DEFINITIONS["hit_ratio"](reads, hits))


def per_unit(units: str, total: str) -> Column:
    """``total / units`` to two digits; zero units count as one."""
    return F.expr(DEFINITIONS["per_unit"](units, total))


def percent_of(total: str, part: str) -> Column:
    """``part`` as a percentage of ``total`` to two digits; a zero total counts as one."""
    return F.expr(DEFINITIONS["percent_of"](total, part))


def whole_percent_of(total: str, part: str) -> Column:
    """``part`` as a whole percentage of ``total``, rounded half up; a zero total counts as one."""
    return F.expr(f"cast(round(({part}) * 100.0D / ({_or_one(total)}), 0) as bigint)")


def blocks_to_bytes(blocks: str, block_size: int = BLOCK_SIZE) -> Column:
    return F.expr(DEFINITIONS["blocks_to_bytes"](blocks, block_size))


def human_bytes(size: str) -> Column:
    """Display text such as ``1.2 KB``."""
    return F.expr(DEFINITIONS["human_bytes"](size))


def wait_or_cpu(wait: str) -> Column:
    return F.expr(f"coalesce({wait}, '{NO_WAIT}')")


def role_text(standby: str) -> Column:
    return F.expr(f"case when {standby} then 'True' when not {standby} then 'False' end")


def whole_seconds(ts) -> Column:
    return F.date_trunc("second", ts)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970 with millisecond precision, as a double."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts.cast("timestamp")) / F.lit(1000.0)


def truncated(value: str) -> Column:
    """Whole part of a number, toward zero."""
    return F.expr(f"cast({value} as bigint)")


def qualified_name(*parts: str) -> Column:
    """``a.b.c``; null as soon as one part is null."""
    return F.expr("concat(" + ", '.', ".join(parts) + ")")


def is_toast(schema_name: str) -> Column:
    """Fixed value: schemas that hold out-of-line values, matched in any case; the underscore is any one character."""
    return F.expr(f"{schema_name} ilike '%pg_toast%'")


def major_version(version: str) -> Column:
    """Leading number of the second word of a version text."""
    digits = F.regexp_extract(version, r"^\S+ (\d+)", 1)
    return F.when(digits != "", digits.cast("int"))


def version_label(version: str) -> Column:
    """First two words of a version text."""
    return F.regexp_extract(version, r"^(\S+ \S+)", 1)


def or_zero(value: str) -> Column:
    return F.expr(f"coalesce(cast({value} as bigint), 0L)")


def per_minute(seconds: str, events: str) -> Column:
    """Events per minute to two digits; zero seconds count as one."""
    return F.expr(f"round(({events}) * 60.0D / ({_or_one(seconds)}), 2)")


def report_time(text) -> Column:
    """Report boundary given as text, read in the session time zone (UTC)."""
    return F.to_timestamp(text, REPORT_TIME_PATTERN)


def parse_report_window(
    start: str | None = None, end: str | None = None, now: datetime | None = None
) -> tuple[datetime, datetime]:
    """Window of a report as two aware UTC datetimes; by default the last two hours up to now."""
    now = (now or datetime.now(timezone.utc)).replace(microsecond=0)

    def read(text):
        return datetime.strptime(text, REPORT_TIME_FORMAT).replace(tzinfo=timezone.utc)

    lower = read(start) if start else now - timedelta(minutes=DEFAULT_WINDOW_MINUTES)
    upper = read(end) if end else now
    if lower > upper:
        raise ValueError(f"report window ends before it starts: {lower} > {upper}")
    return lower, upper
