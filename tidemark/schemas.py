"""Explicit schemas of the landed files."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(fields: str) -> T.StructType:
    """A schema from ``name type`` pairs; unlike a DDL string it needs no running session."""
    pairs = (field.split() for field in fields.split(", "))
    return T.StructType([T.StructField(name, _TYPES[type_]) for name, type_ in pairs])


# Landed files.
LANDED_BARS = _struct(
    "ticket string, date timestamp_ntz, close double, high double, low double, "
    "open double, volume bigint"
)
ARTICLE = _struct(
    "url string, title string, description string, publishedAt string"
)
NEWS_PAYLOAD = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("articles", T.ArrayType(ARTICLE)),
    ]
)
INSIDER_RECORD = _struct(
    "symbol string, name string, share bigint, change bigint, filingDate string, "
    "transactionDate string, transactionPrice double, transactionCode string"
)
INSIDER_PAYLOAD = T.StructType([T.StructField("data", T.ArrayType(INSIDER_RECORD))])

# The map of tickers to companies.
TICKER_MAP = _struct("ticket string, company string")
