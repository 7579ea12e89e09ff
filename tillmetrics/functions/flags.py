"""Yes/no flags from loosely typed columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillmetrics.fixed import DISCOUNT_YES
from tillmetrics.functions.num import parsed


def discount_flag(raw: Column) -> Column:
    """True for yes-words and for numbers above zero."""
    text = raw.cast("string")
    said_yes = F.lower(F.trim(text)).isin(DISCOUNT_YES)
    return F.coalesce(said_yes | (parsed(text) > 0), F.lit(False))
