"""Column expressions: time buckets, null hygiene, parsing, labels."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Timeframes by name, in seconds.
TIMEFRAMES = {"1s": 1, "1m": 60, "5m": 300, "15m": 900, "1h": 3600, "1d": 86400}


def bucket(ts: Column | str, seconds: int) -> Column:
    """Start of the epoch-aligned bucket that holds ``ts``; keeps the timestamp type."""
    return F.window(ts, f"{seconds} seconds")["start"]


def bucket_or_null(ts: str, kind: str, seconds: int) -> Column:
    """Like ``bucket`` for a column of type ``kind``, but a row without a time stays, in a bucket of its own; a watermark does not reach it."""
    return F.timestamp_add("MICROSECOND", -F.pmod(since_1970(ts, kind), F.lit(seconds * 1_000_000)), F.col(ts))


def since_1970(ts: str, kind: str) -> Column:
    """Microseconds since 1970 of a time of type ``kind``, as its clock shows it."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts)) if kind == "timestamp_ntz" else F.unix_micros(ts)


def seconds_between(earlier: Column | str, later: Column | str) -> Column:
    """Seconds from one timestamp to another, with fractions."""
    return F.timestamp_diff("MICROSECOND", F.col(earlier) if isinstance(earlier, str) else earlier, F.col(later) if isinstance(later, str) else later) / 1e6


def clean(number: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(number), number)


def number(text: Column) -> Column:
    """A double where the text is one, else null; never an error."""
    return clean(text.cast("string").try_cast("double"))


def basis_points(part: Column, whole: Column) -> Column:
    """10,000 * part / whole, null where the whole is null or zero."""
    return part / F.nullif(whole, F.lit(0.0)) * 10_000


def instant(text: Column) -> Column:
    """ISO text with ``T`` or space, offset, ``Z`` or none (UTC), or a date; else null."""
    trimmed = F.nullif(F.trim(text), F.lit(""))
    zoned = F.when(trimmed.rlike(r"(Z|[+-]\d\d:?\d\d)$"), trimmed).otherwise(F.concat(trimmed, F.when(trimmed.rlike(r"^\d{4}-\d\d-\d\d$"), F.lit("T00:00:00Z")).otherwise(F.lit("Z"))))
    return F.regexp_replace(zoned, " ", "T").try_cast("timestamp")


def parse_instant(text: str | None, now: datetime | None = None) -> datetime | None:
    """The same on the driver for arguments, with TODAY and YESTERDAY; bad text is an error."""
    if not text or not text.strip():
        return None
    word, today = text.strip(), (now or datetime.now(UTC)).replace(hour=0, minute=0, second=0, microsecond=0)
    named = {"TODAY": today, "YESTERDAY": today - timedelta(days=1)}
    if word.upper() in named:
        return named[word.upper()]
    value = datetime.fromisoformat(word)
    return value.replace(tzinfo=UTC) if value.tzinfo is None else value.astimezone(UTC)


def day_range(day: str | None = None, start: str | None = None, end: str | None = None, now: datetime | None = None) -> tuple[datetime, datetime]:
    """Whole days [first, last) from a day, or from start to end (90 minutes after start unless given)."""
    if day:
        first = last = parse_instant(day, now)
    else:
        first = parse_instant(start, now)
        if first is None:
            raise ValueError("a day or a start is needed")
        last = parse_instant(end, now) or first + timedelta(minutes=90)
    midnight = {"hour": 0, "minute": 0, "second": 0, "microsecond": 0}
    return first.replace(**midnight), last.replace(**midnight) + timedelta(days=1)


def masked_password(url: Column) -> Column:
    """A connection URL without its password."""
    return F.regexp_replace(url, r":([^:@/]+)@", ":***@")


def gap_label(seconds: Column) -> Column:
    """``42s``, ``7m`` or ``3h``."""
    whole = seconds.cast("bigint")
    return F.when(whole < 60, F.format_string("%ds", whole)).when(whole < 3600, F.format_string("%dm", (whole / 60).cast("bigint"))).otherwise(F.format_string("%dh", (whole / 3600).cast("bigint")))


def freshness(age_seconds: Column) -> Column:
    """FRESH under 5 minutes, RECENT under an hour, else STALE."""
    return F.when(age_seconds < 300, "FRESH").when(age_seconds < 3600, "RECENT").otherwise("STALE")


def disk_alert(percent: Column) -> Column:
    """Alert level of a disk's use."""
    return F.when(percent >= 95, "EMERGENCY").when(percent >= 90, "CRITICAL").when(percent >= 80, "WARNING").otherwise("OK")


def retention_days(percent: Column, default: int = 7) -> Column:
    """Days to keep raw files, fewer as the disk fills."""
    return F.when(percent >= 95, 1).when(percent >= 90, 2).when(percent >= 80, 3).otherwise(default)


def candle_up(open_: Column, close: Column) -> Column:
    """Whether a candle closes no lower than it opened."""
    return close >= open_


def row_sample(columns: list[str]) -> Column:
    """A row as JSON text; NaN becomes null, timestamps ISO text."""
    return F.to_json(F.struct(*columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"})


def iso_times(df: DataFrame) -> DataFrame:
    """All times and dates as ISO text, as a service answers; a fraction of a second is told where there is one."""
    seconds = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    exact = lambda c: F.when(F.date_format(c, "SSSSSS") != "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(seconds(c))
    made = {"timestamp": lambda c: F.concat(exact(c), F.date_format(c, "xxx")), "timestamp_ntz": exact, "date": lambda c: F.date_format(c, "yyyy-MM-dd")}
    return df.select(*[made[kind](F.col(c)).alias(c) if kind in made else F.col(c) for c, kind in df.dtypes])
