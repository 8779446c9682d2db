"""Repeatable scores and ids, and the text of event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms a version-4 UUID may have.
_HYPHENATED = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-4[0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}"
_PLAIN = "[0-9a-fA-F]{12}4[0-9a-fA-F]{3}[89abAB][0-9a-fA-F]{15}"
UUID4_PATTERN = rf"^(?:{_HYPHENATED}|{_PLAIN}|\{{{_HYPHENATED}\}}|urn:uuid:{_HYPHENATED})\z"


def uniform_of(text: Column) -> Column:
    """A number in [0, 1) that depends on the text alone: 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def uuid_of(text: Column) -> Column:
    """A version-4-shaped UUID that depends on the text alone."""
    return F.regexp_replace(
        F.md5(text), "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-4$3-8$4-$5"
    )


def event_time(zone: str = "utc", as_of: str | Column | None = None) -> Column:
    """The time of emission as text, microseconds included.

    `zone`: "utc" ends in `Z`, "local" has no zone, "offset" ends in the session zone's offset.
    `as_of`, for repeatable runs, is a text that is used as it stands or a timestamp column.
    """
    if isinstance(as_of, str):
        return F.lit(as_of)
    now = F.current_timestamp() if as_of is None else as_of
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    if zone == "utc":
        return F.date_format(F.to_utc_timestamp(now, F.current_timezone()), pattern + "'Z'")
    if zone == "local":
        return F.date_format(now, pattern)
    if zone == "offset":
        return F.date_format(now, pattern + "XXX")
    raise ValueError(f"zone must be utc, local or offset, not {zone!r}")
