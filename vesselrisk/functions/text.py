"""Text helpers: a full-text tokenizer expressed with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters/digits (the default full-text tokenizer)."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")
