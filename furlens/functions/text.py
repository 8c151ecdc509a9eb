"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def capture(line: Column, pattern: str) -> Column:
    """First group of the first match, NULL on a miss.

    ``regexp_extract`` alone gives '' for a miss as well as for an empty
    capture. The long text is searched once; the group is then read from the
    short match.
    """
    return F.regexp_extract(F.regexp_substr(line, F.lit(pattern)), pattern, 1)


def capture_value(line: Column, pattern: str, key: str) -> Column:
    """Like :func:`capture` for a bracketed group that ends the match ``"key": [...``.

    The key in front is trimmed off instead of matching the long text again.
    """
    match = F.regexp_substr(line, F.lit(pattern))
    return F.ltrim(match, F.lit(f'":{key} \t\n\x0b\f\r'))


def shorten(text: Column, width: int) -> Column:
    """Cut to ``width`` characters, the last three being dots, as ``show`` does."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(text)


def url_path(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def url_host(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))
