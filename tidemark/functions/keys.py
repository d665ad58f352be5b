"""Record keys: md5 over the identifying fields joined by an underscore."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms that enter the keys.
MISSING_TEXT = "None"
MISSING_DATE_TEXT = "NaT"


def _text(value: Column, missing: str = MISSING_TEXT) -> Column:
    return F.coalesce(value.cast("string"), F.lit(missing))


def record_key(*parts: Column) -> Column:
    """md5 of the parts. ``concat_ws`` drops NULLs, so each part is given a text first."""
    return F.md5(F.concat_ws("_", *[_text(p) for p in parts]))


def stock_key(ticket: Column, date: Column) -> Column:
    """The session's date enters as a zone-less time, ``yyyy-MM-dd HH:mm:ss``."""
    return record_key(ticket, _text(date.cast("timestamp_ntz"), MISSING_DATE_TEXT))


def news_key(company: Column, title: Column, published_text: Column) -> Column:
    """The publication time enters as the text it was delivered in."""
    return record_key(company, title, published_text)


def insider_key(
    symbol: Column, name: Column, transaction_date: Column, change: Column, share: Column
) -> Column:
    """Price and transaction code are not part of the key."""
    return record_key(symbol, name, transaction_date, change, share)
