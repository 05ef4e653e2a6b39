"""Surrogate keys: one MD5 over the text of several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.schemas import KEY_SEPARATOR, NULL_KEY_TOKEN


def timestamp_text(ts: Column) -> Column:
    """UTC text of an instant with 0, 3 or 6 fraction digits, as few as hold the value, then ``+00``."""
    micros = F.unix_micros(ts)
    text = (
        F.when(micros % 1_000_000 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(micros % 1_000 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return F.when(ts.isNotNull(), F.concat(text, F.lit("+00")))


def surrogate_key(*parts: Column) -> Column:
    """32 hex characters for the parts taken together; a NULL part counts as a text of its own.

    Timestamps have to be passed through :func:`timestamp_text`.
    """
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_TOKEN)) for part in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts).cast("binary"))
