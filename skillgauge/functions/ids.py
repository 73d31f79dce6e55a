"""Identifiers that come out the same when a task is run again."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*parts: Column) -> Column:
    """Hash of the parts. Each part carries its length, so no two lists of
    parts run together, and a null differs from an empty string."""
    framed = []
    for part in parts:
        text = part.cast("string")
        framed += [
            F.coalesce(F.length(text).cast("string"), F.lit("-")),
            F.lit(":"),
            F.coalesce(text, F.lit("")),
        ]
    return F.sha2(F.concat(*framed), 256)
