"""Date and time functions. All results are UTC timestamps (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.text import strip

# Above this a bare number is milliseconds, below it seconds (fixed value).
MILLIS_THRESHOLD = 1_000_000_000_000

_DATE = r"\d{4}-\d{2}-\d{2}"
_CLOCK = r"\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?)?"
_OFFSET = r"[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?"
_ISO = f"^{_DATE}(?: {_CLOCK}(?:{_OFFSET})?)?$"
_LOOSE = r"^\d{4}-\d{1,2}-\d{1,2}(?: \d{1,2}:\d{1,2}:\d{1,2})?$"


def _from_number(n: Column) -> Column:
    scale = F.when(n > MILLIS_THRESHOLD, F.lit(1e3)).otherwise(F.lit(1e6))
    return F.timestamp_micros(F.round(n * scale).try_cast("bigint"))


def lenient_text_time(c: Column) -> Column:
    """ISO 8601 or the two plain formats; anything else is null. No offset means UTC."""
    text = F.replace(strip(c), F.lit("Z"), F.lit("+00:00"))
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=$|\D)", "$1-$2-$3")
    text = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2})\D(?=\d{2}(?:$|\D))", "$1 ")
    text = F.replace(text, F.lit(","), F.lit("."))
    return F.when(text.rlike(_ISO) | text.rlike(_LOOSE), F.try_to_timestamp(text))


def lenient_number_time(c: Column) -> Column:
    """Epoch seconds or milliseconds; zero counts as missing."""
    n = c.try_cast("double")
    return F.when(n != 0, _from_number(n))


def lenient_variant_time(v: Column) -> Column:
    """The same for a JSON value that may be a number or a string."""
    is_text = F.schema_of_variant(v) == "STRING"
    return F.when(is_text, lenient_text_time(F.try_variant_get(v, "$", "string"))).otherwise(
        lenient_number_time(F.try_variant_get(v, "$", "double"))
    )


def epoch_seconds(c: Column) -> Column:
    """Epoch seconds given as number or text; zero is valid, unparsable is null."""
    n = c.try_cast("double")
    return F.when(~F.isnan(n), F.timestamp_micros(F.round(n * 1e6).try_cast("bigint")))


def strict_time(c: Column) -> Column:
    """Stored value to timestamp; malformed text is an error under ANSI."""
    return c.cast("timestamp")


def effective_time(published: Column, fetched: Column) -> Column:
    return F.coalesce(published, fetched)


def window_start(as_of: Column, days: int) -> Column:
    """First day of an inclusive window of trailing days."""
    return F.date_sub(F.to_date(as_of), days - 1)


def trade_date(c: Column) -> Column:
    """Strict `yyyy-MM-dd HH:mm:ss` to date; malformed text is an error."""
    return F.to_date(F.to_timestamp(c, "yyyy-MM-dd HH:mm:ss"))


def duration_ms(started: Column, finished: Column) -> Column:
    """Null when either end is null."""
    return F.timestamp_diff("MILLISECOND", started, finished)


def duration_label(ms: Column) -> Column:
    """`N ms` under a second, `N.N s` under a minute, else `N.N m`; a dash when unknown.

    Rounds half up in integer arithmetic.
    """

    def tenths(unit_ms: int) -> Column:
        n = F.floor((ms + unit_ms // 20) / (unit_ms // 10)).cast("bigint")
        return F.concat(F.floor(n / 10).cast("string"), F.lit("."), F.pmod(n, F.lit(10)).cast("string"))

    return (
        F.when(ms.isNull(), F.lit("—"))
        .when(ms < 1000, F.concat(ms.cast("string"), F.lit(" ms")))
        .when(ms < 60_000, F.concat(tenths(1000), F.lit(" s")))
        .otherwise(F.concat(tenths(60_000), F.lit(" m")))
    )
