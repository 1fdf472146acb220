"""The identity of a row by its id and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _told_apart(column: str) -> Column:
    """The value as text behind its length, so that values that follow each other are told apart; a null has none."""
    text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128 bits that are the same for rows of the same id and text only; a null differs from every value."""
    return F.unhex(F.md5(F.concat(_told_apart(id_col), _told_apart(text_col))))
