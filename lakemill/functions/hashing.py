"""Content hashes of rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_hash(columns: Iterable[str]) -> Column:
    """md5 that keeps nulls and value borders apart.

    Each value is written as ``length:text`` and a null as ``-``, so that no two
    different rows give the same text.
    """

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.md5(F.concat_ws("|", *[part(c) for c in columns]))
